import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions import scalar
from demandspark.keys import SeriesKeys
from demandspark.operators import contracts as con
from demandspark.sources import grid, pages, tables
from demandspark.streaming import jobs

C = con.SheetContract()
GOOD_ROWS = [("00:00 - 00:15", "100", "90.5"), ("00:15-00:30", "", "91"), ("00:30 - 00:45", "-3", "")]


def sheet(rows=GOOD_ROWS, title=C.title, date="05-Jan-2024", period="Period", forecast=C.forecast_heading, actual=C.actual_heading):
    head = [[title, "", "", "", ""], [""] * 5, ["Date", date, "", "", ""], ["", "", "", forecast, actual], ["", period, "", "", ""]]
    return head + [["", p, "", f, a] for p, f, a in rows]


def as_grid(spark, sheets):
    rows = [(k, i, cells) for k, s in sheets.items() for i, cells in enumerate(s)]
    return spark.createDataFrame(rows, con.GRID)


def reasons(spark, sheets):
    checks = con.check_sheets(as_grid(spark, sheets))
    return {r["partition_key"]: r["reason"] for r in checks.collect()}


def test_sheet_contract(spark):
    found = reasons(spark, {
        "2024/Jan/F_05-01-2024": sheet(),
        "cell date": sheet(date="05-Sept-2024"),
        "F_31-02-2024": sheet(),
        "bad measure": sheet([("00:00 - 00:15", "12x", "")]),
        "exponent": sheet([("00:00 - 00:15", "1e5", "")]),
        "comma": sheet([("00:00 - 00:15", "1,234", "")]),
        "blank row": sheet(GOOD_ROWS + [("", "", "")]),
        "trimmed heading": sheet(period="Period "),
        "wrong heading": sheet(period="period"),
        "short": sheet()[:4],
        "narrow": [r[:4] for r in sheet()],
        "no rows": sheet([]),
        "bad title": sheet(title="x"),
        "bad cell date": sheet(date="soon"),
    })
    assert found == {
        "2024/Jan/F_05-01-2024": None, "cell date": None, "F_31-02-2024": "date", "bad measure": "data rows",
        "exponent": "data rows", "comma": "data rows", "blank row": "data rows", "trimmed heading": None,
        "wrong heading": "period heading", "short": "short sheet", "narrow": "short sheet", "no rows": None,
        "bad title": "title", "bad cell date": "date",
    }


def test_primary_and_series(spark):
    g = as_grid(spark, {"2024/Jan/F_05-01-2024": sheet(), "b": sheet([("00:00 - 00:15", "7", "8")], date="5-Jan-2024"),
                        "c": sheet([("00:00 - 00:15", "12x", "")])})
    checks = con.check_sheets(g)
    assert con.counters(checks).first().asDict() == {
        "raw_partitions_total": 3, "raw_partitions_valid": 2, "raw_partitions_invalid": 1}
    primary = con.to_primary(g, checks)
    con.require_primary(primary.drop("source_key"))
    assert primary.count() == 4
    keys = SeriesKeys(ids=(), time="timestamp")
    rows = sorted(con.to_series(primary, keys).collect())
    d = datetime(2024, 1, 5)
    # the smaller source key wins at 00:00
    assert [tuple(r) for r in rows] == [
        (d, 90.5, 100.0), (d + timedelta(minutes=15), 91.0, None), (d + timedelta(minutes=30), None, -3.0)]


def test_no_valid_sheet_gives_a_typed_empty_table(spark):
    g = as_grid(spark, {"x": sheet(title="no")})
    primary = con.to_primary(g, con.check_sheets(g)).drop("source_key")
    assert con.require_primary(primary).count() == 0


def test_require_primary_refuses(spark):
    with pytest.raises(con.ContractError):
        con.require_primary(spark.createDataFrame([(1,)], "a int"))
    bad = spark.createDataFrame([(None, "00:00 - 00:15", 1.0, 1.0), (datetime(2024, 1, 1), "x", 1.0, 1.0)], C.primary_schema())
    with pytest.raises(con.ContractError, match="1 null dates, 1 bad periods"):
        con.require_primary(bad)


def values(spark, rows, f):
    return [r[0] for r in spark.createDataFrame([(v,) for v in rows], "v string").select(f(F.col("v"))).collect()]


def test_safe_numbers(spark):
    assert values(spark, ["1,234", " 7 ", "12.5", "", None, "x", "-3"], scalar.safe_int) == [1234, 7, 0, 0, 0, 0, -3]
    assert values(spark, ["49.98", "1,0.5", "", None, "nan"], scalar.safe_float) == [49.98, 10.5, 0.0, 0.0, 0.0]


def test_links_months_and_keys(spark):
    assert values(spark, ["/a", "a", "http://h/a", ""], lambda c: scalar.absolute_url(c, "http://b")) == [
        "http://b/a", "http://b/a", "http://h/a", ""]
    assert values(spark, ["January", "sep", "Archive"], lambda c: scalar.month_key(F.lit(2024), c)) == [
        "2024_01", "2024_09", "2024_Archive"]
    assert values(spark, ["F.xlsx", "G.XLSX"], lambda c: scalar.file_key(F.lit(2024), F.lit("Jan"), c)) == [
        "2024/Jan/F", "2024/Jan/G"]


def test_dates(spark):
    assert values(spark, ["05-Sept-2024", "5-Jan-2024", "05-01-2024", ""], scalar.date_from_cell) == [
        datetime(2024, 9, 5), datetime(2024, 1, 5), None, None]
    assert values(spark, ["x_05-01-2024_y", "F_31-02-2024", "none"], scalar.date_from_key) == [datetime(2024, 1, 5), None, None]
    day = F.lit("2024-01-05").cast("timestamp_ntz")
    assert values(spark, ["23:45 - 00:00", "24:00 - 00:15", "bad"], lambda c: scalar.period_timestamp(day, c, False)) == [
        datetime(2024, 1, 5, 23, 45), None, None]


def test_lenient_helpers(spark):
    assert values(spark, ["1.5", " 2 ", "x", ""], scalar.lenient_double) == [1.5, 2.0, None, None]
    row = spark.createDataFrame([([None, "a"],)], "c array<string>").select(scalar.text_or_empty(F.col("c"))).first()
    assert row[0] == ["", "a"]


def test_sheet_files(spark, tmp_path):
    folder = tmp_path / "2024" / "Jan"
    folder.mkdir(parents=True)
    (folder / "one.csv").write_text('a,b\r\n"x, y",2\n')
    rows = grid.read_sheets(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [(r["partition_key"], r["row_idx"], r["cells"]) for r in rows] == [
        ("2024/Jan/one", 0, ["a", "b"]), ("2024/Jan/one", 1, ['"x', ' y"', "2"])]
    quoted = grid.read_sheets(spark, str(tmp_path), width=2).orderBy("row_idx").collect()
    assert quoted[1]["cells"] == ["x, y", "2"]


def test_keyed_write_replaces_only_touched_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "v int, ym string"
    tables.write_keyed(spark.createDataFrame([(1, "2024_01"), (2, "2024_02")], schema), path, "ym")
    tables.write_keyed(spark.createDataFrame([(9, "2024_02")], schema), path, "ym")
    assert sorted(r["v"] for r in tables.read_keyed(spark, path).collect()) == [1, 9]


def test_append_csv_metrics_and_document(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    for _ in range(2):
        tables.append_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    for step, value in ((0, 5.0), (1, 4.0)):
        rows = spark.createDataFrame([("baseline", "m", "mape", step, value)], tables.METRICS)
        tables.append_metrics(rows, str(tmp_path / "metrics"))
    assert tables.latest_metrics(tables.read_table(spark, str(tmp_path / "metrics"))).first()["value"] == 4.0
    tables.write_document(df, str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in Path(tmp_path / "doc").glob("part-*"))
    assert json.loads(text) == {"a": 1, "b": "x"}


def test_pages(spark):
    html = ('<table><thead><tr><td>no</td></tr></thead><tbody><tr><td>F.xlsx</td><td>1 KB</td><td>d</td>'
            '<td><a href="/f/1">x</a></td></tr>\n<tr><td></td><td></td><td></td><td></td></tr></tbody></table>')
    df = spark.createDataFrame([(2024, "Jan", html)], "year int, month string, html string")
    rows = pages.with_keys(pages.table_listing(df, "html"), "http://b").collect()
    assert [(r["file_key"], r["download_link"], r["ym"]) for r in rows] == [
        ("2024/Jan/F", "http://b/f/1", "2024_01"), (None, "", "2024_01")]
    element = T.StructType([T.StructField("k", T.LongType())])
    texts = spark.createDataFrame([("[{\"k\":1},{\"k\":2}]",), ("oops",), ("[]",)], "t string")
    assert [r["k"] for r in pages.json_rows(texts, "t", element).collect()] == [1, 2]
    assert [r[0] for r in texts.select(pages.json_first(F.col("t"), element)["k"]).collect()] == [1, None, None]


def write_sheet(folder: Path, name: str, rows) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(",".join(r) for r in rows) + "\n")


def test_streamed_ingestion_takes_each_file_once(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    write_sheet(src / "2024" / "Jan", "F_05-01-2024.csv", sheet())
    write_sheet(src / "2024" / "Jan", "bad.csv", sheet(title="x"))

    def run():
        jobs.ingest_sheets(spark, str(src), f"{out}/primary", f"{out}/refused", f"{out}/cp").awaitTermination()
        return spark.read.parquet(f"{out}/primary").count(), spark.read.parquet(f"{out}/refused").count()

    assert run() == (3, 1)
    assert run() == (3, 1)
    write_sheet(src / "2024" / "Jan", "F_06-01-2024.csv", sheet(GOOD_ROWS[:2]))
    assert run() == (5, 1)


def test_plans_run_end_to_end(spark, tmp_path):
    """Eleven days of sheets through the weekly run, with a small search."""
    import math

    from demandspark.operators.impute import ImputeConfig
    from demandspark.operators.select import promoted
    from demandspark.operators.trees import SEARCH_RANGES
    from demandspark.plans.config import RunConfig
    from demandspark.plans.runs import weekly

    clock = lambda s: f"{s // 4 % 24:02d}:{s % 4 * 15:02d}"
    for day in range(1, 12):
        rows = [(f"{clock(s)} - {clock(s + 1)}", "5", "" if (day, s) == (4, 7) else f"{100 + 20 * math.sin(s / 15) + day % 7:.2f}")
                for s in range(96) if (day, s) != (3, 50)]
        write_sheet(tmp_path / "in" / "2024" / "Mar", f"F_{day:02d}-03-2024.csv", sheet(rows))
    cfg = RunConfig(
        root=str(tmp_path / "out"), sheets=str(tmp_path / "in"), impute=ImputeConfig(trees=3), test_days=1,
        variants=("stable",), trials=1, search_ranges={**SEARCH_RANGES, "trees": (3, 4, "int"), "depth": (3, 4, "int")})
    counts = weekly(spark, cfg)
    assert counts["ingest"] == {"raw_partitions_total": 11, "raw_partitions_valid": 11, "raw_partitions_invalid": 0, "sheets_read": 11}
    assert counts["process"] == {"rows": 11 * 96, "imputed": 2}
    assert counts["best_model"] in ("Baseline_Seasonal_Naive", "stable")
    assert spark.read.parquet(cfg.path("test")).count() == 96
    assert (Path(promoted(spark, cfg.path("best"))["folder"].removeprefix("file:")) / "model").exists()
    assert spark.read.parquet(cfg.path("analysis/drift")).count() == 2


def test_only_touched_sheets_are_read_again(spark, tmp_path):
    from demandspark.plans.config import RunConfig
    from demandspark.plans.runs import ingest, read_primary, sheet_checks

    cfg, jan = RunConfig(root=str(tmp_path / "out"), sheets=str(tmp_path / "in")), tmp_path / "in" / "2024" / "Jan"

    def rows():
        return {r["source_key"]: r["n"] for r in read_primary(spark, cfg).groupBy("source_key").agg(F.count(F.lit(1)).alias("n")).collect()}

    write_sheet(jan, "F_05-01-2024.csv", sheet())
    write_sheet(jan, "F_06-01-2024.csv", sheet(GOOD_ROWS[:2]))
    write_sheet(jan, "bad.csv", sheet(title="x"))
    assert ingest(spark, cfg) == {"raw_partitions_total": 3, "raw_partitions_valid": 2, "raw_partitions_invalid": 1, "sheets_read": 3}
    assert rows() == {"2024/Jan/F_05-01-2024": 3, "2024/Jan/F_06-01-2024": 2}
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    assert ingest(spark, cfg)["sheets_read"] == 0
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")} == before
    # one sheet grows, one turns bad, one is new, one goes
    write_sheet(jan, "F_06-01-2024.csv", sheet())
    write_sheet(jan, "F_05-01-2024.csv", sheet(title="y"))
    write_sheet(jan, "F_07-01-2024.csv", sheet(GOOD_ROWS[:1]))
    (jan / "bad.csv").unlink()
    assert ingest(spark, cfg) == {"raw_partitions_total": 3, "raw_partitions_valid": 2, "raw_partitions_invalid": 1, "sheets_read": 3}
    assert rows() == {"2024/Jan/F_06-01-2024": 3, "2024/Jan/F_07-01-2024": 1}
    (jan / "F_07-01-2024.csv").unlink()
    assert ingest(spark, cfg)["sheets_read"] == 0 and rows() == {"2024/Jan/F_06-01-2024": 3}
    write_sheet(jan, "F_07-01-2024.csv", sheet(GOOD_ROWS[:2]))
    assert ingest(spark, cfg)["sheets_read"] == 1 and rows()["2024/Jan/F_07-01-2024"] == 2
    assert {r["reason"] for r in sheet_checks(spark, cfg).collect()} == {None, "title"}


def test_a_failure_before_the_manifest_is_made_good(spark, tmp_path, monkeypatch):
    from demandspark.plans import runs
    from demandspark.plans.config import RunConfig

    cfg = RunConfig(root=str(tmp_path / "out"), sheets=str(tmp_path / "in"))
    write_sheet(tmp_path / "in" / "2024" / "Jan", "F_05-01-2024.csv", sheet())
    real = runs.write_keyed

    def failing(df, path, key):
        if path.endswith("manifest"):
            raise OSError("no space")
        real(df, path, key)

    monkeypatch.setattr(runs, "write_keyed", failing)
    with pytest.raises(OSError):
        runs.ingest(spark, cfg)
    monkeypatch.setattr(runs, "write_keyed", real)
    assert runs.ingest(spark, cfg)["sheets_read"] == 1 and runs.read_primary(spark, cfg).count() == 3


def test_large_sheets_equal_whole_ones(spark, tmp_path):
    for name, n in (("one", 400), ("two", 1), ("three", 57)):
        write_sheet(tmp_path / "2024" / "Jan", f"{name}.csv", [(f"{name}{i}", "x" * (i % 13), "") for i in range(n)])
    (tmp_path / "2024" / "Jan" / "four.csv").write_text("a,b\r\n\r\nc,d")
    whole = sorted(map(tuple, grid.read_sheets(spark, str(tmp_path)).collect()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        assert spark.read.text(str(tmp_path), recursiveFileLookup=True).rdd.getNumPartitions() > 8
        assert sorted(map(tuple, grid.read_large_sheets(spark, str(tmp_path)).collect())) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_large_sheet_in_sorted_parts(spark, tmp_path):
    """Parts of one sheet, each in blocks, are numbered on; they come from many sorted tasks."""
    path = str(tmp_path / "parts")
    lines = spark.range(500).select(F.expr("if(id % 3 = 0, 'a', 'b')").alias("k"), F.format_string("%04d,x", "id").alias("line"))
    lines.repartitionByRange(5, "k", "line").sortWithinPartitions("k", "line").write.partitionBy("k").text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = grid.read_large_sheets(spark, path, pattern=r"k=([^/]+)/", in_parts=True)
        got = sorted((r["partition_key"], r["row_idx"], r["cells"][0]) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    each = {k: [f"{i:04d}" for i in range(500) if (i % 3 == 0) == (k == "a")] for k in "ab"}
    assert got == [(k, i, v) for k in "ab" for i, v in enumerate(each[k])]


def test_promotion_is_whole_or_not_at_all(spark, tmp_path):
    from demandspark.operators import select

    path, schema = str(tmp_path / "best"), "model string, mape double, rmse double, nrmse double, score double"
    scores = spark.createDataFrame([("a", 0.2, 4.0, 0.5, 0.3), ("b", 0.1, 2.0, 0.2, 0.1)], schema)

    class Model:
        def __init__(self, n, fails=False):
            self.n, self.fails = n, fails

        def save(self, where):
            spark.range(self.n).write.parquet(where)
            if self.fails:
                raise OSError("half-way")

    def in_use():
        now = select.promoted(spark, path)
        record = json.loads(spark.read.text(f"{now['folder']}/model-metadata").first()["value"])
        return now["sequence"], now["model"], spark.read.parquet(f"{now['folder']}/model").count(), record

    assert select.promoted(spark, path) is None
    with pytest.raises(OSError):
        select.promote(scores, {"a": Model(1, True)}, path)
    assert select.promoted(spark, path) is None
    assert select.promote(scores, {"a": Model(3)}, path, "2026-01-01T00:00:00") == "a"
    sequence, model, n, record = in_use()
    assert (sequence, model, n, record["promotion_timestamp"]) == (1, "a", 3, "2026-01-01T00:00:00")
    assert record["all_compared_models"] == {"a": {"score": 0.3, "metrics": {"mape": 0.2, "rmse": 4.0, "nrmse": 0.5}}}
    with pytest.raises(OSError):
        select.promote(scores, {"a": Model(9), "b": Model(9, True)}, path)
    assert in_use()[:3] == (1, "a", 3)
    assert select.promote(scores, {"a": Model(9), "b": Model(5)}, path) == "b"
    assert in_use()[:3] == (2, "b", 5) and set(in_use()[3]["all_compared_models"]) == {"a", "b"}


def test_stream_keeps_the_least_in_any_order(spark, tmp_path):
    from demandspark.operators.dedup import keep_one

    rng = random.Random(3)
    rows = [(f"k{i % 5}", datetime(2024, 1, 1 + i % 7), (i * 37) % 211, float(i)) for i in range(200)]
    schema = "id string, ts timestamp, source int, v double"
    want = sorted(map(tuple, keep_one(spark.createDataFrame(rows, schema), ["id", "ts"], ["source"]).collect()))
    for order in range(2):
        rng.shuffle(rows)
        folder, out = tmp_path / f"in{order}", str(tmp_path / f"out{order}")
        for run in range(2):  # the second run goes on from the first one's state
            for part in range(2):
                at = (run * 2 + part) * 50
                spark.createDataFrame(rows[at:at + 50], schema).coalesce(1).write.parquet(str(folder / f"f{run}{part}"))
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(folder))
            best = jobs.keep_least(stream, ["id", "ts"], "ts", ["source"], "30 days")
            jobs.upsert_to(best, f"{out}/rows", f"{out}/cp").awaitTermination()
        got = jobs.latest(spark.read.parquet(f"{out}/rows"), ["id", "ts"]).select("id", "ts", "source", "v")
        assert sorted(map(tuple, got.collect())) == want
