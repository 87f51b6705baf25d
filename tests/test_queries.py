"""Registered queries against their SQL, and the shape of their plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import queries
from checks.inputs import EVENTS, base
from checks.run import compare
from demandspark.operators import fill, lags, outliers, rolling, spine
from demandspark.operators.impute import ImputeConfig

SF = "/root/testdata/sf0.001"
SLOW = {n for n in entry.queries() if n.startswith(("tree_", "candidate_"))}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, name):
    ok, note = compare(spark, SF, name)
    assert ok, note


def test_imputation_runs_at_the_library_settings(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "impute_series", lambda df, k, config, bad: seen.append(config) or df.withColumn("is_imputed", F.lit(False)))
    queries.tree_impute(spark, SF)
    assert seen == [ImputeConfig()]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("build", [
    lambda b: spine.insert_missing(b, EVENTS), lambda b: spine.gap_blocks(b, EVENTS),
    lambda b: fill.fill_both(b, EVENTS), lambda b: fill.interpolate(b, EVENTS),
    lambda b: lags.add_lags(b, EVENTS, {"l": 96}), lambda b: rolling.rolling_trend(b, EVENTS, 672),
    lambda b: outliers.null_outliers(b, EVENTS),
])
def test_no_plan_gathers_the_data(spark, build):
    """No exchange to one partition, and windows over rows are by chunk, bucket or summary."""
    plan = build(base(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    physical = build(base(spark, SF))._jdf.queryExecution().sparkPlan().toString()
    assert "SinglePartition" not in physical
    for spec in re.findall(r"windowspecdefinition\(([^()]*)", plan):
        parts = [p for p in spec.split(", ") if " ASC" not in p and " DESC" not in p and "frame" not in p]
        if len(parts) == 1:  # by series only: must order one row per chunk or bucket
            assert re.search(r"(_chunk|_b)#\d+L? (ASC|DESC)", spec), spec
