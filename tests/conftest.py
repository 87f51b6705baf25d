import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.run import session  # noqa: E402
from demandspark.keys import SeriesKeys  # noqa: E402

T0 = datetime(2024, 3, 1)


@pytest.fixture(scope="session")
def spark():
    s = session(cpus=8, partitions=4)
    yield s
    s.stop()


@pytest.fixture
def series(spark):
    """Builder: {id: [value per slot]} or {id: {slot: value}} to a table and its keys."""

    def build(values, chunk=4, step=900, start=T0):
        rows = []
        for name, column in values.items():
            items = column.items() if isinstance(column, dict) else enumerate(column)
            rows += [(name, start + timedelta(seconds=step * i), None if v is None else float(v)) for i, v in items]
        df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")
        return df, SeriesKeys(step=step, chunk=chunk)

    return build


def column(df, name="y", ids="unique_id", time="ds"):
    """Values of one column per series, in time order."""
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r[ids], r[time])):
        out.setdefault(row[ids], []).append(row[name])
    return out


def slots(rows, name, step=900, start=T0):
    return [int((r[name] - start).total_seconds() // step) for r in rows]
