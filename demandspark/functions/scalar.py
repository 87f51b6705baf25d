"""Column functions for untrusted text, keys and dates. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandspark.keys import shift_time

# English month abbreviations in calendar order.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _plain_number(text: Column) -> Column:
    return F.trim(F.replace(text, F.lit(","), F.lit("")))


def safe_int(text: Column) -> Column:
    """Whole number with commas removed; 0 for anything else, also for '12.5'."""
    return F.coalesce(_plain_number(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def safe_float(text: Column) -> Column:
    """Number with commas removed; 0.0 for anything else, also for NaN."""
    value = _plain_number(text).try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def absolute_url(link: Column, base: str) -> Column:
    """Prefix the site to links that lack it; an empty link stays empty."""
    return (
        F.when(link == "", link)
        .when(link.startswith("/"), F.concat(F.lit(base), link))
        .when(~link.startswith("http"), F.concat(F.lit(base + "/"), link))
        .otherwise(link)
    )


def file_key(year: Column, month: Column, name: Column) -> Column:
    """``year/month/name`` without the spreadsheet extension."""
    bare = F.replace(F.replace(name, F.lit(".xlsx"), F.lit("")), F.lit(".XLSX"), F.lit(""))
    return F.concat_ws("/", year.cast("string"), month, bare)


def month_number(name: Column) -> Column:
    """1..12 from the first three letters, any case; null when not a month."""
    table = F.create_map(*[v for i, m in enumerate(MONTHS, 1) for v in (F.lit(m), F.lit(i))])
    return F.try_element_at(table, F.initcap(F.substring(name, 1, 3)))


def month_key(year: Column, name: Column) -> Column:
    """``YYYY_MM``, or ``YYYY_<name>`` when the name is not a month."""
    number = F.lpad(month_number(name).cast("string"), 2, "0")
    return F.concat_ws("_", year.cast("string"), F.coalesce(number, name))


def date_from_key(key: Column) -> Column:
    """Date written as dd-mm-yyyy anywhere in the text; null when none or impossible."""
    found = F.regexp_extract(key, r"(\d{2}-\d{2}-\d{4})", 1)
    return F.try_to_date(found, "dd-MM-yyyy").cast("timestamp_ntz")


def has_key_date(key: Column) -> Column:
    return key.rlike(r"\d{2}-\d{2}-\d{4}")


def date_from_cell(cell: Column) -> Column:
    """Date written as d-Mon-yyyy, with 'Sept' accepted for 'Sep'; null when bad."""
    text = F.replace(F.trim(cell), F.lit("-Sept-"), F.lit("-Sep-"))
    return F.try_to_date(text, "d-MMM-yyyy").cast("timestamp_ntz")


def period_start(period: Column) -> Column:
    """Start of 'HH:MM - HH:MM', with or without blanks around the dash."""
    return F.get(F.split(period, r"\s*-\s*"), F.lit(0))


def period_timestamp(date: Column, period: Column, strict: bool = True) -> Column:
    """Date plus period start. A bad time raises, or is null when not strict."""
    start = period_start(period)
    if strict:
        text = F.concat(F.to_date(date).cast("string"), F.lit(" "), start)
        return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm"))
    hour = F.regexp_extract(start, r"^(\d{2}):(\d{2})$", 1).try_cast("int")
    minute = F.regexp_extract(start, r"^(\d{2}):(\d{2})$", 2).try_cast("int")
    return F.when((hour < 24) & (minute < 60), shift_time(date, hour * 3600 + minute * 60))


def text_or_empty(cells: Column) -> Column:
    """Array of cells with nulls as empty text."""
    return F.transform(cells, lambda c: F.coalesce(c.cast("string"), F.lit("")))


def lenient_double(text: Column) -> Column:
    return F.trim(text).try_cast("double")
