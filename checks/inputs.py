"""Series and sheets that the registered queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.scalar import MONTHS
from demandspark.keys import SeriesKeys, epoch_seconds, from_epoch_seconds
from demandspark.operators.chunks import stage
from demandspark.operators.contracts import SheetContract
from demandspark.operators.fill import fill_both
from demandspark.operators.spine import insert_missing

# a chunk shorter than the series, so that the checks cross chunk borders
EVENTS = SeriesKeys(ids=("event_type",), time="ts", target="y", step=900, chunk=2048)
ORDERS = SeriesKeys(ids=("o_orderstatus",), time="ts", target="y", step=86400, chunk=512)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tidy(value, places: int = 6):
    """Rounded, with values that lie exactly between two results moved up."""
    return F.round(value + F.lit(10.0 ** -(places + 3)), places) + F.lit(0.0)


def floor_time(ts, seconds: int):
    s = epoch_seconds(ts)
    return from_epoch_seconds(s - F.pmod(s, F.lit(seconds)))


def base(spark: SparkSession, sf: str) -> DataFrame:
    """Mean value per event type and quarter of an hour; slots without events are absent."""
    return table(spark, sf, "events").groupBy("event_type", floor_time(F.col("ts"), 900).alias("ts")).agg(
        tidy(F.avg("value")).alias("y"))


def regular(spark: SparkSession, sf: str) -> DataFrame:
    """The same on its grid, null where there was no event.

    The means are read twice and are staged, so the events are read once.
    """
    return insert_missing(stage(base(spark, sf)), EVENTS)


def filled(spark: SparkSession, sf: str) -> DataFrame:
    """The grid series without nulls, staged as a repaired series would be."""
    return stage(fill_both(regular(spark, sf), EVENTS))


def daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Mean order price per status and day."""
    return table(spark, sf, "orders").groupBy(
        "o_orderstatus", F.to_date("o_orderdate").cast("timestamp_ntz").alias("ts")
    ).agg(tidy(F.avg("o_totalprice")).alias("y"))


def order_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Orders laid out as sheets, one per priority and day, with faults by priority:

    1 date in the key; 2 date only in the cell, 'Sept' spelled out; 3 month in the
    key replaced by February (some days impossible); 4 wrong title in July; 5 a
    letter in the measure of pending orders.
    """
    c = SheetContract()
    o = table(spark, sf, "orders")
    p = F.substring("o_orderpriority", 1, 1)
    d = F.col("o_orderdate")
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(d))
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    name = (
        F.when(p == "2", F.concat(F.lit("H_"), F.year(d).cast("string"), two(F.month(d)), two(F.dayofmonth(d))))
        .when(p == "3", F.concat(F.lit("F_"), two(F.dayofmonth(d)), F.lit("-02-"), F.year(d).cast("string"),
                                 F.lit("_"), month))
        .otherwise(F.concat(F.lit("F_"), two(F.dayofmonth(d)), F.lit("-"), two(F.month(d)), F.lit("-"),
                            F.year(d).cast("string")))
    )
    o = o.select(
        F.concat_ws("/", F.year(d).cast("string"), month, F.concat(name, F.lit("_p"), p)).alias("partition_key"),
        p.alias("p"), d.alias("d"), month.alias("m"), "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    slot = F.pmod("o_orderkey", F.lit(96))
    clock = lambda s: F.concat(two(F.floor(s / 4)), F.lit(":"), two(F.pmod(s, F.lit(4)) * 15))
    dash = F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.lit(" - ")).otherwise(F.lit("-"))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    actual = F.when(F.pmod("o_custkey", F.lit(10)) == 0, F.lit("")).when(
        (F.col("p") == "5") & (F.col("o_orderstatus") == "P"), F.concat(price, F.lit("x"))).otherwise(price)
    data = o.select(
        "partition_key", (F.col("o_orderkey") + c.first_data_row).alias("row_idx"),
        F.array(F.lit(""), F.concat(clock(slot), dash, clock(F.pmod(slot + 1, F.lit(96)))), F.lit(""),
                F.col("o_custkey").cast("string"), actual).alias("cells"))
    day_text = F.concat(F.dayofmonth("d").cast("string"), F.lit("-"),
                        F.when(F.col("m") == "Sep", F.lit("Sept")).otherwise(F.col("m")),
                        F.lit("-"), F.year("d").cast("string"))
    title = F.when((F.col("p") == "4") & (F.month("d") == 7), F.lit("Other Centre")).otherwise(F.lit(c.title))
    blank = F.lit("")
    rows = [
        [title, blank, blank, blank, blank],
        [blank, blank, blank, blank, blank],
        [F.lit("Date"), day_text, blank, blank, blank],
        [blank, blank, blank, F.lit(f" {c.forecast_heading} "), F.lit(c.actual_heading)],
        [blank, F.lit(f"{c.period_heading} "), blank, blank, blank],
    ]
    head = o.select("partition_key", "p", "d", "m").distinct().select("partition_key", F.posexplode(
        F.array(*[F.array(*r) for r in rows])).alias("row_idx", "cells"))
    head = head.withColumn("row_idx", F.col("row_idx").cast("bigint"))
    return head.unionByName(data)


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One small listing page per order: two files, and the folder buttons around them."""
    d = F.col("o_orderdate")
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(d))
    key = F.col("o_orderkey").cast("string")
    link = (F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.concat(F.lit("/files/"), key))
            .when(F.pmod("o_orderkey", F.lit(3)) == 1, F.concat(F.lit("files/"), key))
            .otherwise(F.concat(F.lit("https://other.example/"), key)))
    html = F.concat(
        F.lit('<div><button data-foldername="'), F.year(d).cast("string"), F.lit('">y</button><button class="b" data-foldername="'),
        month, F.lit('">m</button><button data-foldername="">-</button></div><table><thead><tr><th>n</th></tr></thead><tbody><tr><td>F_'),
        key, F.lit('.xlsx</td><td> '), F.col("o_custkey").cast("string"), F.lit(' KB</td><td>'), F.to_date(d).cast("string"),
        F.lit('</td><td><a class="l" href="'), link, F.lit('">get</a></td></tr>\n<tr><td><b>G_'), key,
        F.lit('</b>.XLSX</td><td>1 KB</td><td></td><td>none</td></tr></tbody></table>'))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year(d).alias("year"), month.alias("month"), html.alias("html"))


def dashboard_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One dashboard page per event."""
    v = F.col("value").cast("decimal(18,2)").cast("string")
    u = F.col("user_id").cast("string")
    html = F.concat(
        F.lit('<body><span id="Label6"> '), F.col("event_type"), F.lit(' </span><span id="Label1">'), v,
        F.lit('</span><b id="Label12" class="x">-'), u, F.lit('</b><td id="Label5">1,'), F.lpad(u, 3, "0"),
        F.lit('</td><i id="lbl_thermal">'), v, F.lit('</i><i id="lbl_hydro"></i><i id="lbl_wind">n/a</i></body>'))
    return table(spark, sf, "events").select("event_id", "ts", html.alias("html"))
