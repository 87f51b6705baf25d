"""Checks of cell grids and typed tables, and the reshaping of valid grids.

A grid is one row per sheet row: ``partition_key, row_idx, cells``. A sheet is
accepted or refused as a whole; refused sheets are listed with a reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.scalar import (
    date_from_cell, date_from_key, has_key_date, lenient_double, period_timestamp,
)
from demandspark.keys import SeriesKeys
from demandspark.operators.chunks import salted_join
from demandspark.operators.dedup import keep_one


class ContractError(ValueError):
    """A table does not have the promised columns, types or values."""


GRID = T.StructType([
    T.StructField("partition_key", T.StringType()),
    T.StructField("row_idx", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])


@dataclass(frozen=True)
class SheetContract:
    """Layout of one sheet. The defaults are fixed values: texts, cell positions
    (row, column), patterns and column names of the source's spreadsheets."""

    title: str = "Northern Regional Load Despatch Centre (NRLDC)"
    period_heading: str = "Period"
    forecast_heading: str = "Intraday Forcasted Demand (B)"
    actual_heading: str = "Actual Demand (C)"
    title_cell: tuple[int, int] = (0, 0)
    date_cell: tuple[int, int] = (2, 1)
    period_cell: tuple[int, int] = (4, 1)
    forecast_cell: tuple[int, int] = (3, 3)
    actual_cell: tuple[int, int] = (3, 4)
    first_data_row: int = 5
    period_column: int = 1
    forecast_column: int = 3
    actual_column: int = 4
    period_pattern: str = r"^\d{2}:\d{2}\s*-\s*\d{2}:\d{2}$"
    measure_pattern: str = r"^(-?\d+(\.\d+)?)?$"
    actual_name: str = "actual_demand_mw"
    forecast_name: str = "nrldc_intraday_forecasted_demand_mw"

    def primary_schema(self) -> T.StructType:
        return T.StructType([
            T.StructField("date", T.TimestampNTZType()),
            T.StructField("period", T.StringType()),
            T.StructField(self.actual_name, T.DoubleType()),
            T.StructField(self.forecast_name, T.DoubleType()),
        ])

    @property
    def least_width(self) -> int:
        cells = (self.title_cell, self.date_cell, self.period_cell, self.forecast_cell, self.actual_cell)
        return 1 + max(*(c for _, c in cells), self.period_column, self.forecast_column, self.actual_column)


def cell(column: int) -> Column:
    """Cell of the row as text; a missing one is empty."""
    return F.coalesce(F.get("cells", F.lit(column)), F.lit(""))


def lookup(position: tuple[int, int]) -> Column:
    """Trimmed cell at (row, column) of the sheet, as an aggregate; null without that row."""
    row, column = position
    return F.max(F.when(F.col("row_idx") == row, F.trim(cell(column))))


def check_sheets(grid: DataFrame, contract: SheetContract = SheetContract()) -> DataFrame:
    """One row per sheet: ``is_valid``, ``reason``, the date cell and the row count.

    A single aggregate; every sum is combined before the shuffle.
    """
    c = contract
    data = F.col("row_idx") >= c.first_data_row
    row_ok = (
        cell(c.period_column).rlike(c.period_pattern)
        & cell(c.forecast_column).rlike(c.measure_pattern)
        & cell(c.actual_column).rlike(c.measure_pattern)
    )
    seen = grid.groupBy("partition_key").agg(
        lookup(c.title_cell).alias("_title"), lookup(c.date_cell).alias("date_cell"),
        lookup(c.period_cell).alias("_period"), lookup(c.forecast_cell).alias("_forecast"),
        lookup(c.actual_cell).alias("_actual"), F.max(F.size("cells")).alias("_width"),
        F.count_if(data).alias("data_rows"), F.count_if(data & ~row_ok).alias("bad_rows"),
    )
    date = F.when(has_key_date(F.col("partition_key")), date_from_key(F.col("partition_key"))).otherwise(
        date_from_cell(F.col("date_cell")))
    # the first failing check names the reason
    reason = F.coalesce(
        F.when(F.coalesce(F.col("_width") < c.least_width, F.lit(True)) | F.col("_period").isNull(),
               F.lit("short sheet")),
        F.when(F.coalesce(F.col("_title"), F.lit("")) != c.title, F.lit("title")),
        F.when(F.coalesce(F.col("_period"), F.lit("")) != c.period_heading, F.lit("period heading")),
        F.when(F.coalesce(F.col("_forecast"), F.lit("")) != c.forecast_heading, F.lit("forecast heading")),
        F.when(F.coalesce(F.col("_actual"), F.lit("")) != c.actual_heading, F.lit("actual heading")),
        F.when(F.col("bad_rows") > 0, F.lit("data rows")),
    )
    return seen.select(
        "partition_key", reason.isNull().alias("is_valid"),
        F.coalesce(reason, F.when(date.isNull(), F.lit("date"))).alias("reason"),
        "data_rows", "bad_rows", "date_cell", date.alias("sheet_date"),
    )


def quarantine(checks: DataFrame) -> DataFrame:
    """Sheets that yield no rows, with the reason (a bad date included)."""
    return checks.filter(F.col("reason").isNotNull()).select("partition_key", "reason", "data_rows", "bad_rows")


def counters(checks: DataFrame) -> DataFrame:
    """Total, valid and invalid sheets, as a metrics-like single row."""
    return checks.agg(
        F.count(F.lit(1)).alias("raw_partitions_total"),
        F.count_if("is_valid").alias("raw_partitions_valid"),
        F.count_if(~F.col("is_valid")).alias("raw_partitions_invalid"),
    )


def valid_grid(grid: DataFrame, checks: DataFrame) -> DataFrame:
    """Rows of the sheets that passed."""
    good = checks.filter("is_valid").select("partition_key")
    return salted_join(grid, good, ["partition_key"], "left_semi", spread=["row_idx"])


def to_primary(grid: DataFrame, checks: DataFrame, contract: SheetContract = SheetContract()) -> DataFrame:
    """Typed rows of the valid sheets, with ``source_key`` kept as tie-break.

    No valid sheet gives an empty table of the same type. The few header values
    of a sheet are joined with the sheet's rows spread by row number, so a sheet
    of any size is handled by many tasks.
    """
    c = contract
    good = checks.filter(F.col("is_valid") & F.col("sheet_date").isNotNull()).select("partition_key", "sheet_date")
    data = grid.filter(F.col("row_idx") >= c.first_data_row)
    return salted_join(data, good, ["partition_key"], spread=["row_idx"]).select(
        F.col("sheet_date").alias("date"),
        cell(c.period_column).alias("period"),
        lenient_double(cell(c.actual_column)).alias(c.actual_name),
        lenient_double(cell(c.forecast_column)).alias(c.forecast_name),
        F.col("partition_key").alias("source_key"),
    )


def primary_violations(df: DataFrame, contract: SheetContract = SheetContract()) -> DataFrame:
    """Rows and violations of the primary table in one aggregate."""
    period_bad = ~F.coalesce(F.col("period").rlike(contract.period_pattern), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("date").isNull()).alias("null_dates"),
        F.count_if(period_bad).alias("bad_periods"),
    )


def require_primary(df: DataFrame, contract: SheetContract = SheetContract()) -> DataFrame:
    """Raise unless columns, order, types and values are as promised (runs one aggregate)."""
    want = [(f.name, f.dataType) for f in contract.primary_schema()]
    have = [(f.name, f.dataType) for f in df.schema]
    if want != have:
        raise ContractError(f"columns are {have}, expected {want}")
    seen = primary_violations(df, contract).first()
    if seen["null_dates"] or seen["bad_periods"]:
        raise ContractError(f"{seen['null_dates']} null dates, {seen['bad_periods']} bad periods of {seen['n_rows']} rows")
    return df


def to_series(primary: DataFrame, keys: SeriesKeys, contract: SheetContract = SheetContract(),
              strict: bool = True) -> DataFrame:
    """Primary rows to one row per timestamp, keeping that of the smallest source key.

    The result has ``keys.ids`` only if the primary table has these columns.
    """
    ids = [c for c in keys.ids if c in primary.columns]
    order = ["source_key"] if "source_key" in primary.columns else []
    stamped = primary.select(
        *ids, period_timestamp(F.col("date"), F.col("period"), strict).alias(keys.time),
        contract.actual_name, contract.forecast_name, *order,
    )
    kept = keep_one(stamped, [*ids, keys.time], [*order, contract.actual_name, contract.forecast_name], "first")
    return kept.drop(*order)
