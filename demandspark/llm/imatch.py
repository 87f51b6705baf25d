"""I-Match fingerprints over randomised lexicon subsets, with DataFrame functions only.

A term belongs to the lexicon if the share of texts that have it lies in a band,
which is a band of inverse document frequencies. Each randomised subset of the
lexicon gives one part of a text's fingerprint: the hash of the text's sorted
distinct terms in it. The subsets cover the lexicon: a term is in one that is its own
and in each of the others by chance. A text with no term of the lexicon is hashed
over all its terms instead.

The lexicon is kept in the plan as a set: with D distinct terms in a mean text, at
most D / ``low`` terms reach the share ``low``, however many texts there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.common import table

LOW, HIGH = 0.01, 0.25
SUBSETS = 32
# One in so many terms of the lexicon is in a given subset besides those whose own it is.
ONE_IN = 64


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH) -> list[str]:
    """Terms whose document frequency, over all rows, is between ``low`` and ``high`` of their number."""
    n = docs.count()
    words = docs.select(F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("t"))
    found = words.groupBy("t").agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(low * n, high * n))
    return sorted(r["t"] for r in found.select("t").collect())


def with_fingerprint(df: DataFrame, text: str, out: str, words: list[str], subsets: int = SUBSETS,
                     one_in: int = ONE_IN) -> DataFrame:
    """Add ``out``: an array of ``subsets`` hashes, null where the text has no term of a subset.

    Each term has a subset of its own, so a text with a term of the lexicon has a part,
    and texts that differ in one term differ in a part.
    """
    listed = ", ".join(f"'{w}'" for w in words) or "''"  # terms hold letters and digits only
    df = df.withColumn("_terms", F.sort_array(terms(F.col(text))))
    df = df.withColumn("_band", F.expr(f"transform(filter(_terms, t -> t IN ({listed})), t -> xxhash64(t))"))

    def part(k: int) -> Column:
        chosen = F.filter("_band", lambda h: (F.pmod(h, F.lit(subsets)) == k) | (
            F.pmod(F.xxhash64(F.lit(k), h), F.lit(one_in)) == 0))
        return F.when(F.size(chosen) > 0, F.xxhash64(chosen))

    whole = F.array(F.xxhash64(F.concat_ws(" ", "_terms")), *[F.lit(None).cast("bigint")] * (subsets - 1))
    parts = F.array(*[part(k) for k in range(subsets)])
    return df.withColumn(out, F.when(F.size("_band") > 0, parts).otherwise(whole)).drop("_terms", "_band")


def likeness(a: str, b: str) -> Column:
    """Share of equal parts among those that either fingerprint has; 1 if both have none."""
    both = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None)).otherwise(
        F.when(x.eqNullSafe(y), F.lit(1)).otherwise(F.lit(0))))
    known = F.filter(both, lambda x: x.isNotNull())
    hits = F.size(F.filter(known, lambda x: x == 1))
    return F.when(F.size(known) == 0, F.lit(1.0)).otherwise(hits.cast("double") / F.size(known))


def as_text(parts: str) -> Column:
    return F.array_join(F.transform(parts, lambda x: F.coalesce(F.lower(F.hex(x)), F.lit("0"))), "-")


def with_next(df: DataFrame, doc_id: str, text: str, more: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add ``next_<column>``: values of the row that follows in descending doc_id, the first after the last.

    The columns are ``text`` and those that ``more`` adds to a table with it.

    Rows are dealt into ranges of doc_id cut at quantiles, so that no window holds
    more than a range; the first row of the next range is joined in for the last of
    each. A null doc_id comes last. Rows that repeat a doc_id follow each other in
    descending order of their texts.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.select(F.percentile_approx(doc_id, [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    id_ = F.col(doc_id)
    listed = F.array(*[F.lit(c) for c in sorted(set(cuts), reverse=True)]) if cuts else F.array().cast("array<bigint>")
    part = F.coalesce(F.size(F.filter(listed, lambda c: c > id_)), F.lit(n)).cast("int")
    part = F.when(id_.isNull(), F.lit(n + 1)).otherwise(part)
    df = df.withColumn("_part", part)
    order = [id_.desc_nulls_last(), F.col(text).desc_nulls_last()]
    # At most one row per range: which id each range starts with.
    tops = sorted((r["_part"], r["top"]) for r in df.groupBy("_part").agg(F.max(doc_id).alias("top")).collect())
    follow = {p: tops[(i + 1) % len(tops)] for i, (p, _) in enumerate(tops)}
    kind = df.schema[doc_id].dataType.simpleString()
    links = spark.createDataFrame([(p, q, top) for p, (q, top) in follow.items()], f"_part int, _at int, _top {kind}")
    firsts = df.join(F.broadcast(links.select(F.col("_at").alias("_part"), F.col("_top"), F.col("_part").alias("_to"))), "_part")
    firsts = firsts.where(id_.eqNullSafe(F.col("_top")))
    firsts = firsts.groupBy("_to").agg(F.max(text).alias(text))
    known = set(df.columns)
    df, firsts = more(df), more(firsts)
    carried = [text, *[c for c in df.columns if c not in known]]
    firsts = firsts.select(F.col("_to").alias("_part"), F.struct(*[F.col(c) for c in carried]).alias("_first"))
    w = Window.partitionBy("_part").orderBy(*order)
    df = df.withColumn("_lead", F.lead(F.struct(*[F.col(c) for c in carried])).over(w)).join(firsts, "_part", "left")
    df = df.withColumn("_lead", F.coalesce("_lead", "_first"))
    return df.select(*[c for c in df.columns if not c.startswith("_")],
                     *[F.col(f"_lead.{c}").alias(f"next_{c}") for c in carried])


def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = lexicon(docs)
    rows = with_next(docs, "doc_id", "text", lambda df: with_fingerprint(df, "text", "parts", words))
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    rows = rows.select("doc_id", "n_chars", "edited", "parts", "next_parts")
    rows = with_fingerprint(rows, "edited", "edited_parts", words)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("parts").alias("fingerprint"), as_text("edited_parts").alias("edited_fingerprint"),
        likeness("parts", "edited_parts").alias("near_edited"), likeness("parts", "next_parts").alias("near_next"))
