"""Reading and writing of tables: whole, keyed, appended, metrics, documents."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS = T.StructType([
    T.StructField("prefix", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


def write_keyed(df: DataFrame, path: str, key: str) -> None:
    """Replace only the keys that occur in ``df``, one directory per key."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(key).parquet(path))


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_keyed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All keys as one table; a filter on the key column prunes directories."""
    return read_table(spark, path, schema)


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows; every file carries the header, so the directory reads as one table."""
    df.write.mode("append").option("header", True).csv(path)


def append_metrics(rows: DataFrame, path: str) -> None:
    """Append to the metrics history."""
    rows.select(*[F.col(f.name).cast(f.dataType) for f in METRICS]).write.mode("append").parquet(path)


def latest_metrics(history: DataFrame) -> DataFrame:
    """The value with the highest step of each metric; of equal steps the larger value."""
    newest = F.max_by("value", F.struct("step", "value"))
    return history.groupBy("prefix", "model", "metric").agg(newest.alias("value"))


def next_step(history: DataFrame) -> int:
    """The step of a new run: one more than the highest so far."""
    highest = history.agg(F.max("step")).first()[0]
    return 0 if highest is None else highest + 1


def write_document(row: DataFrame, path: str) -> None:
    """Write a one-row table as a JSON document."""
    row.select(F.to_json(F.struct(*row.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``).

    A local session, whose executors are the driver, may do without.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = "/tmp/checkpoints"
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let fits that cut their lineage themselves do so in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "fit"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Written copy in the shared folder, so that repeated use neither recomputes nor depends on one executor.

    As a columnar table it can still be pruned and filtered at the scan.
    """
    path = shared_dir(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
