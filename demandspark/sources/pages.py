"""Rows and records out of HTML and JSON text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.scalar import absolute_url, file_key, month_key, month_number, safe_float, safe_int

LISTING = T.StructType([T.StructField(n, T.StringType())
                        for n in ("file_name", "size", "file_date", "download_link")])

# Field name and element id on the dashboard page.
DASHBOARD_IDS = {
    "dashboard_timestamp": "Label6",
    "frequency": "Label1",
    "state_ui": "Label12",
    "state_demand": "Label5",
    "thermal": "lbl_thermal",
    "thermal_ipp": "lbl_thrmipp",
    "hydro": "lbl_hydro",
    "wind": "lbl_wind",
    "solar": "lbl_solar",
    "other_ncep": "lbl_other",
    "cgs_drawal": "Label3",
    "pavagada_kspdcl": "lblpvgslr",
    "bescom": "Label7",
    "hescom": "Label8",
    "gescom": "Label9",
    "cesc": "Label10",
    "mescom": "Label11",
}


def repeated_rows(df: DataFrame, html: str, row: str, fields: Mapping[str, tuple[str, int]]) -> DataFrame:
    """One row per match of ``row`` in the text, with its position and fields.

    ``fields`` maps a name to (pattern, group), applied inside the match; a field
    that does not occur is empty.
    """
    keep = [c for c in df.columns if c != html]
    found = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(row), F.lit(0))).alias("pos", "_hit"))
    return found.select(*keep, "pos", *[
        F.regexp_extract("_hit", pattern, group).alias(name) for name, (pattern, group) in fields.items()])


def plain_text(fragment: Column) -> Column:
    return F.trim(F.regexp_replace(fragment, r"(?s)<[^>]*>", ""))


def table_listing(df: DataFrame, html: str) -> DataFrame:
    """File listing rows of the tables in a page: four text cells, the last one's link."""
    keep = [c for c in df.columns if c != html]
    bodies = df.select(*keep, F.posexplode(F.regexp_extract_all(
        F.col(html), F.lit(r"(?s)<tbody\b.*?</tbody>"), F.lit(0))).alias("_t", "_body"))
    rows = bodies.select(*keep, F.explode(F.regexp_extract_all(
        F.col("_body"), F.lit(r"(?s)<tr\b.*?</tr>"), F.lit(0))).alias("_tr"))
    cells = rows.withColumn("_td", F.regexp_extract_all(F.col("_tr"), F.lit(r"(?s)<td\b[^>]*>(.*?)</td>"), F.lit(1)))

    def nth(i: int) -> Column:
        return F.get("_td", F.lit(i))

    return cells.select(*keep, plain_text(nth(0)).alias("file_name"), plain_text(nth(1)).alias("size"),
                        plain_text(nth(2)).alias("file_date"),
                        F.regexp_extract(nth(3), r'<a\b[^>]*\bhref="([^"]*)"', 1).alias("download_link"))


def month_folders(df: DataFrame, html: str, years: Sequence[int]) -> DataFrame:
    """Folder buttons that are months: not empty and not one of the year folders."""
    rows = repeated_rows(df, html, r"<button\b[^>]*\bdata-foldername=\"[^\"]*\"",
                         {"month": (r"data-foldername=\"([^\"]*)\"", 1)})
    return rows.filter((F.col("month") != "") & ~F.col("month").isin([str(y) for y in years]))


def calendar_order(df: DataFrame, month: str = "month") -> DataFrame:
    """Sorted from January to December, for a report."""
    return df.orderBy(month_number(F.col(month)), month)


def record_by_id(df: DataFrame, html: str, ids: Mapping[str, str]) -> DataFrame:
    """One column per element id, holding the element's text (empty if absent)."""
    keep = [c for c in df.columns if c != html]
    return df.select(*keep, *[
        F.trim(F.regexp_extract(html, rf'(?s)\bid="{element}"[^>]*>(.*?)<', 1)).alias(name)
        for name, element in ids.items()])


def dashboard_samples(pages: DataFrame, html: str, fetched_at: str) -> DataFrame:
    """Typed dashboard records: two times as text, frequency, fifteen whole numbers."""
    wide = record_by_id(pages, html, DASHBOARD_IDS)
    whole = [n for n in DASHBOARD_IDS if n not in ("dashboard_timestamp", "frequency")]
    return wide.select(
        F.date_format(fetched_at, "yyyy-MM-dd HH:mm:ss").alias("ingestion_timestamp"),
        F.trim("dashboard_timestamp").alias("dashboard_timestamp"),
        safe_float(F.col("frequency")).alias("frequency"),
        *[safe_int(F.col(n)).alias(n) for n in whole],
    )


def json_rows(df: DataFrame, text: str, element: T.StructType) -> DataFrame:
    """A JSON array of objects as rows; text that is not one gives none."""
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.inline(F.from_json(text, T.ArrayType(element))))


def json_first(text: Column, element: T.StructType) -> Column:
    """First object of a JSON array, null when there is none."""
    return F.get(F.from_json(text, T.ArrayType(element)), F.lit(0))


def with_keys(listing: DataFrame, base: str) -> DataFrame:
    """Listing rows (with ``year`` and ``month``) plus absolute link, month key and file key.

    Rows without link or name have no file and get no file key.
    """
    named = (F.col("download_link") != "") & (F.col("file_name") != "")
    return listing.select(
        *[c for c in listing.columns if c != "download_link"],
        absolute_url(F.col("download_link"), base).alias("download_link"),
        month_key(F.col("year"), F.col("month")).alias("ym"),
        F.when(named, file_key(F.col("year"), F.col("month"), F.col("file_name"))).alias("file_key"),
    )


def listing_window(listing: DataFrame, mode: str, start_year: int, as_of: datetime) -> DataFrame:
    """Backfill: all years from the first; live: only the month of ``as_of``. Filters on ``ym``."""
    if mode == "live":
        return listing.filter(F.col("ym") == f"{as_of:%Y_%m}")
    if mode != "backfill":
        raise ValueError("mode must be 'backfill' or 'live'")
    year = F.substring("ym", 1, 4).try_cast("int")
    return listing.filter((year >= start_year) & (year <= as_of.year))
