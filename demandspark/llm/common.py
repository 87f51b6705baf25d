"""What the corpus operators share: tables, written intermediates, task plumbing."""

from __future__ import annotations

import pickle
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share.

    ``spark.checkpoint.dir`` names it. Only a local session, whose executors are
    the driver, may do without.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = tempfile.mkdtemp(prefix="demandspark-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder and go on from the files.

    This cuts the lineage, so a lost executor costs its running tasks only, and
    column pruning works on what follows.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Lets a query's shuffle files go when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_tidily(df: DataFrame) -> DataFrame:
    """:func:`stage` that leaves no shuffle files behind, for operators that shuffle whole texts several times."""
    spark = df.sparkSession
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        return stage(df)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def by_value(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast a value of bounded size with the code of its class; what is returned gives it inside a task.

    A plain broadcast names the class only, which tasks could not import.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def map_rows(df: DataFrame, columns: Sequence[str], schema: str,
             rows: Callable[[Iterator[tuple]], Iterator[tuple]], batch: int = 4096) -> DataFrame:
    """Apply a Python generator to the rows of each partition, moved in Arrow batches.

    ``rows`` gets an iterator over tuples of ``columns`` and yields tuples for ``schema``.
    """
    empty = df.sparkSession.createDataFrame([], schema)
    arrow = _arrow_schema(empty)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tuples():
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    yield from zip(*[c.to_pylist() for c in part.columns])

        kept, size = [], 0
        for row in rows(tuples()):
            kept.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(kept) >= batch or size >= 1 << 24:
                yield _to_batch(kept, arrow)
                kept, size = [], 0
        if kept:
            yield _to_batch(kept, arrow)

    return df.select(*columns).mapInArrow(run, schema)


def _to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def utf8(text: str | None) -> bytes:
    """Bytes of a text; null is empty and lone surrogates become question marks."""
    return b"" if text is None else text.encode("utf-8", "replace")


# What a row is known by where ids may repeat or be null.
ROW = ["doc", "has", "mark"]
ROW_TYPES = "doc bigint, has boolean, mark bigint"


def identified(docs: DataFrame, doc_id: str, text: str, carried: Column | None = None) -> DataFrame:
    """``ROW`` and text, or what is carried in its place.

    ``ROW`` is the id as a whole number (0 if null), whether there is one, and the xxhash64
    of the text (null is empty).
    """
    own, value = F.col(f"`{doc_id}`").cast("bigint"), F.col(f"`{text}`")
    return docs.select(F.coalesce(own, F.lit(0)).alias("doc"), own.isNotNull().alias("has"),
                       F.xxhash64(F.coalesce(value, F.lit(""))).alias("mark"),
                       value.alias("text") if carried is None else carried)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text, modulo ``parts``, is ``part``; false for a null id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % parts == part, F.lit(False))


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
