"""Exact deduplication by distributed radix partitioning, most significant bytes first.

A round splits every group of texts that are still alike by their next run of
bytes: rows of one group with the same run form a group of the next round. Groups
of one row leave, and so do groups whose texts end inside the run, as these are
equal. Runs get wider by a fixed factor, so the number of rounds is logarithmic in
the longest text that repeats, and only rows that still have a partner carry text
on. Bytes themselves are compared throughout; no digest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import stage_tidily as stage
from demandspark.llm.common import ROW, identified, table

FIRST_RUN = 256
WIDEN = 16
SPACES = " \t\n\x0b\x0c\r"


def without_space(text: Column) -> Column:
    """Text without ASCII white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _split(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """One round: group by the next ``width`` bytes, then say for each row what became of it.

    Groups are counted with partial sums per task. The join that brings the count
    back has one row per group on one side; as a merge join, adaptive execution can
    split a group however large.
    """
    run = F.substring(F.col("_rest"), 1, width)
    rows = rows.withColumn("_run", run)
    groups = rows.groupBy(*keys, "_run").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    groups = stage(groups.withColumn("_next", F.monotonically_increasing_id()))
    out = rows.join(groups.hint("merge"), [*keys, "_run"], "left").drop(*keys)
    alive = F.col("_n").isNotNull()
    ended = F.length("_run") < width
    return stage(out.select(
        "_doc", "_sha", "_chars", "_id", "_row", F.coalesce("_n", F.lit(1)).alias("_n"), F.col("_next").alias("_group"),
        (alive & ended).alias("_ended"),
        F.when(alive & ~ended, F.expr(f"substring(_rest, {width + 1})")).alias("_rest")))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", first_run: int = FIRST_RUN,
                widen: int = WIDEN, keep: list[str] | None = None) -> DataFrame:
    """Every row with its group of texts that are equal but for white space.

    Returns the struct ``_doc`` of the columns ``keep`` (default: all), and
    keep_id, group_size, kept, text_sha256. Of a group the row with the most code
    points in its text stays, then the smallest doc_id (null last), then any one of
    rows alike in both. A null text is empty, and empty texts are equal. Ids may be of any
    type that has an order.
    """
    id_, value = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    norm = without_space(value)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("_doc"), F.sha2(norm.cast("binary"), 256).alias("_sha"),
        F.coalesce(F.length(value), F.lit(0)).alias("_chars"), id_.alias("_id"),
        F.monotonically_increasing_id().alias("_row"), norm.cast("binary").alias("_rest"))
    levels, keys, width = [], [], first_run
    while True:
        out = _split(rows, keys, width)
        levels.append(out.withColumn("_level", F.lit(len(levels))))
        rows = out.where("_n > 1 and not _ended").drop("_n", "_ended")
        if rows.isEmpty():
            break
        keys, width = ["_group"], width * widen
    done = None
    for out in levels:
        part = out.where("_n = 1 or _ended").drop("_rest")
        done = part if done is None else done.unionByName(part)
    alone = done.where("_n = 1").select("_doc", F.col("_id").alias("keep_id"), F.col("_n").alias("group_size"),
                                        F.lit(True).alias("kept"), F.col("_sha").alias("text_sha256"))
    many = done.where("_n > 1")
    best = many.groupBy("_level", "_group").agg(
        F.min(F.struct((-F.col("_chars")).alias("chars"), F.col("_id").isNull().alias("none"), F.col("_id").alias("id"),
                       F.col("_row").alias("row"))).alias("_best"))
    many = many.join(best.hint("merge"), ["_level", "_group"]).select(
        "_doc", F.col("_best.id").alias("keep_id"), F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_best.row")).alias("kept"), F.col("_sha").alias("text_sha256"))
    return alone.unionByName(many)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps.

    Texts are compared without the rows they belong to, which are moved only once, at the
    end. Ids are whole numbers. Of rows alike in id and text one stays.
    """
    rows = identified(docs, doc_id, text)
    own = F.when(F.col("has"), F.col("doc")).alias("own")
    found = exact_dedup(rows.select(*ROW, own, "text"), "own", "text", keep=ROW)
    facts = stage(found.groupBy(*[F.col(f"_doc.{c}").alias(c) for c in ROW]).agg(
        F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_alike")))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    kept = identified(docs, doc_id, text, whole).join(facts.where("_kept").hint("merge"), ROW)
    single = kept.where("_alike = 1").select("_row.*")
    return single.unionByName(kept.where("_alike > 1").dropDuplicates(ROW).select("_row.*"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("_doc.doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""
