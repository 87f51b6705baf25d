"""Uniform sharding by a two-pass external shuffle.

The first pass scatters records over buckets that fit in memory by a seeded hash.
The second shuffles each bucket (Fisher-Yates) and gives its records the places
that follow those of the buckets before it. A shard is an even range of places, so
shards differ by one record at most and a bucket writes to few of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.common import shared_dir, table

SHARDS = 8
BUCKET_BYTES = 32 << 20
BROADCAST_BUCKETS = 100_000


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform order of 0..n-1: the last open place gets a random one of those up to it."""
    order = np.arange(n)
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)) if n > 1 else ()):
        order[i], order[j] = order[j], order[i]
    return order


def shuffle_to_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 42,
                      bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> DataFrame:
    """Write all records in random order as ``shards`` parts under ``path`` and read them back.

    Adds ``shard`` and ``slot`` (place in the shard, from 0), which replace columns
    of these names. Records are scattered by a hash of all their columns, so only
    records that are alike in every column share a bucket for that reason; equal
    texts are scattered like any others. The same input, seed and bucket count give
    the same shards. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1
    total, n = docs.agg(F.sum(size), F.count(F.lit(1))).first()
    buckets = max(-(-(total or 0) // bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns])
    scattered = docs.withColumn("_key", key).withColumn("_bucket", F.pmod(F.col("_key"), F.lit(buckets)))
    counts = scattered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket")  # over one row per bucket
    counts = counts.withColumn("_before", F.sum("_n").over(before) - F.col("_n")).drop("_n")
    if buckets <= BROADCAST_BUCKETS:
        counts = F.broadcast(counts)
    scattered = scattered.join(counts, "_bucket")
    out_schema = scattered.drop("_key", "_bucket", "_before").withColumn("_place", F.lit(0).cast("bigint")).schema
    names = out_schema.names[:-1]

    def run(bucket: pa.Table) -> pa.Table:
        bucket = bucket.take(pa.array(np.argsort(bucket["_key"].to_numpy(), kind="stable")))
        rng = np.random.default_rng([seed, bucket["_bucket"][0].as_py()])
        order = fisher_yates(bucket.num_rows, rng)
        first = bucket["_before"][0].as_py()
        return bucket.select(names).take(pa.array(order)).append_column("_place", pa.array(first + np.arange(len(order))))

    placed = scattered.groupBy("_bucket").applyInArrow(run, out_schema)
    # In whole numbers: shard s holds the places from ceil(s * n / shards) on.
    placed = placed.withColumn("shard", F.expr(f"cast((_place * {shards}) div {max(n, 1)} as int)"))
    first = f"((cast(shard as bigint) * {n} + {shards - 1}) div {shards})"
    placed = placed.withColumn("slot", F.expr(f"_place - {first}")).drop("_place")
    schema = placed.schema
    placed.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    if not n:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: the method scatters single records uniformly, so counts are what it keeps even."""
    placed = shuffle_to_shards(table(spark, sf_dir, "documents"), shared_dir(spark))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return placed.select("doc_id", (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
