"""Continuous forms of ingestion and sampling as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from demandspark.operators.contracts import SheetContract, check_sheets, quarantine, to_primary
from demandspark.sources.grid import KEY_PATTERN, explode_sheets


def ingest_sheets(spark: SparkSession, source: str, primary: str, refused: str, checkpoint: str,
                  contract: SheetContract = SheetContract()) -> StreamingQuery:
    """Take in the sheet files that are new since the last run, then stop.

    Files must appear complete (write elsewhere, then rename). Each micro-batch
    holds whole files, so a sheet is judged as a whole. Output is partitioned by
    batch and overwritten per batch: a replayed batch does not double rows.
    """
    files = (
        spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
        .load(source)
        .select(F.regexp_extract(F.col("_metadata.file_path"), KEY_PATTERN, 1).alias("partition_key"), "value")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        grid = explode_sheets(batch).persist()  # the files are read and parsed once for all uses
        try:
            checks = check_sheets(grid, contract)
            for rows, path in ((to_primary(grid, checks, contract), primary), (quarantine(checks), refused)):
                (rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
                     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
        finally:
            grid.unpersist()

    return (files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def drop_repeats(samples: DataFrame, key: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """First arrived row per key; later copies within ``delay`` are dropped."""
    return samples.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def keep_least(samples: DataFrame, key: list[str], time: str, order: list[str], delay: str = "1 hour") -> DataFrame:
    """The row of each key that is first by ``order``, whatever order rows arrive in.

    The stream's form of keeping the first row per key. ``key`` must hold ``time``. The state
    of a key is its best row so far; a better one that arrives later is written as a
    correction (:func:`upsert_to`, :func:`latest`), and the state goes when the watermark,
    ``delay`` behind the latest time, has passed the key's.
    """
    if time not in key:
        raise ValueError("key must hold the time column, so that state can expire")
    rest = [c for c in samples.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return samples.withWatermark(time, delay).groupBy(*key).agg(best.alias("_row")).select(*key, "_row.*")


def tumbling_means(samples: DataFrame, ids: list[str], time: str, values: list[str],
                   width: str = "15 minutes", delay: str = "30 minutes") -> DataFrame:
    """Mean of each value per key and window; late rows beyond ``delay`` are dropped."""
    return (
        samples.withWatermark(time, delay)
        .groupBy(F.window(time, width), *ids)
        .agg(*[F.avg(v).alias(v) for v in values], F.count(F.lit(1)).alias("n"))
        .select(*ids, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                *values, "n")
    )


def append_to(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", **options) -> StreamingQuery:
    """Append a streaming table to files until the available input is used up."""
    writer = rows.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    for name, value in options.items():
        writer = writer.option(name, value)
    return writer.trigger(availableNow=True).start(path)


def upsert_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every change of a streaming aggregate, with its batch, until the available input is used up.

    Unlike appending, this also writes windows that the watermark has not closed, so
    the end of a bounded input is complete; the watermark still lets old state go. A
    replayed batch replaces its own rows. :func:`latest` reads the result.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    return (rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def latest(changes: DataFrame, key: list[str]) -> DataFrame:
    """The last written row of each key."""
    rest = [c for c in changes.columns if c not in (*key, "batch_id")]
    newest = changes.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
    return newest.select(*key, "_row.*")
