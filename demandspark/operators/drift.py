"""Distribution drift of an analysis part against a reference part, by chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.keys import SeriesKeys, epoch_seconds
from demandspark.operators.chunks import row_position, salted_join, series_join, stage, with_chunk
from demandspark.operators.quantiles import cumulative_counts

CHUNK_ROWS = 96


def number_chunks(df: DataFrame, keys: SeriesKeys, rows: int = CHUNK_ROWS, slots: bool = False) -> DataFrame:
    """``(ids, part, value)``: consecutive pieces of ``rows`` rows from each series' start.

    With ``slots`` a piece is that many grid slots instead, whether or not they have rows.
    """
    if not slots:
        numbered = row_position(with_chunk(df.select(*keys.key, keys.target), keys), keys)
        return numbered.select(*keys.ids, F.floor(F.col("row_no") / rows).cast("bigint").alias("part"), keys.target)
    start = df.groupBy(*keys.ids).agg(F.min(keys.time).alias("_start"))
    joined = series_join(df.select(*keys.key, keys.target), start, keys.ids)
    offset = (epoch_seconds(F.col(keys.time)) - epoch_seconds(F.col("_start"))) / F.lit(rows * keys.step)
    return joined.select(*keys.ids, F.floor(offset).cast("bigint").alias("part"), keys.target)


def ks_by_chunk(reference: DataFrame, chunks: DataFrame, keys: SeriesKeys) -> DataFrame:
    """Kolmogorov-Smirnov distance of each chunk from the whole reference.

    The largest gap lies at a value of the chunk, so the reference distribution
    is needed only there, just at and just below it. Those counts are computed
    once for all chunks. Values are counted per chunk first: a join key holds at
    most one row per chunk, and is salted by chunk.
    """
    ids, y = list(keys.ids), keys.target
    ref = cumulative_counts(reference, chunks, ids, y)
    own = chunks.filter(F.col(y).isNotNull()).groupBy(*ids, "part", y).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*ids, "part").orderBy(y)
    whole = Window.partitionBy(*ids, "part")
    own = own.select(
        *ids, "part", y, "_c",
        F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum("_c").over(whole).alias("_size"),
    )
    both = salted_join(own, ref, [*ids, y], spread=[*ids, "part"])
    at = F.abs(F.col("at_or_below") / F.col("n_reference") - F.col("_upto") / F.col("_size"))
    below = F.abs(F.col("below") / F.col("n_reference") - (F.col("_upto") - F.col("_c")) / F.col("_size"))
    return both.groupBy(*ids, "part").agg(F.max(F.greatest(at, below)).alias("statistic"))


def js_by_chunk(reference: DataFrame, chunks: DataFrame, keys: SeriesKeys, bins: int = 20) -> DataFrame:
    """Jensen-Shannon distance (base 2) of each chunk from the whole reference.

    Histogram of ``bins`` equal bins over the reference range; what lies outside
    it falls into one more bin, which is empty in the reference. A bin with no
    chunk rows adds half its reference share, so only occupied bins are joined.
    """
    ids, y = list(keys.ids), keys.target
    edges = reference.groupBy(*ids).agg(F.min(y).alias("_lo"), F.max(y).alias("_hi"), F.count(y).alias("_nref"))

    def histogram(df: DataFrame, by: list[str]) -> DataFrame:
        rows = series_join(df.filter(F.col(y).isNotNull()), edges, ids)
        v, lo, hi = F.col(y), F.col("_lo"), F.col("_hi")
        place = F.least(F.floor((v - lo) / (hi - lo) * F.lit(bins)) + 1, F.lit(bins))
        bin_no = F.when((v < lo) | (v > hi), 0).when(hi == lo, 1).otherwise(place).cast("int")
        return rows.groupBy(*by, bin_no.alias("_bin")).agg(
            F.count(F.lit(1)).alias("_c"), F.first("_nref").alias("_nref"))

    ref = histogram(reference.select(*ids, y), ids).select(*ids, "_bin", (F.col("_c") / F.col("_nref")).alias("_p"))
    own = histogram(chunks.select(*ids, "part", y), [*ids, "part"])
    size = Window.partitionBy(*ids, "part")
    own = own.select(*ids, "part", "_bin", (F.col("_c") / F.sum("_c").over(size)).alias("_q"))
    both = series_join(own, ref, [*ids, "_bin"], "left")
    p, q = F.coalesce(F.col("_p"), F.lit(0.0)), F.col("_q")
    m = (p + q) / 2
    term = F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0)) + q * F.log2(q / m)
    divergence = (F.sum(term) + (1 - F.sum(p))) / 2
    return both.groupBy(*ids, "part").agg(F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("statistic"))


def alert_limits(reference_statistics: DataFrame, keys: SeriesKeys, sigmas: float = 3.0) -> DataFrame:
    """Mean plus and minus ``sigmas`` population deviations over the reference chunks."""
    s = F.col("statistic")
    spread = F.lit(sigmas) * F.stddev_pop(s)
    return reference_statistics.groupBy(*keys.ids).agg(
        F.greatest(F.avg(s) - spread, F.lit(0.0)).alias("lower_limit"),
        (F.avg(s) + spread).alias("upper_limit"),
    )


def drift_report(reference: DataFrame, analysis: DataFrame, keys: SeriesKeys,
                 rows: int = CHUNK_ROWS, bins: int = 20) -> DataFrame:
    """Both statistics per analysis chunk with limits from the reference chunks.

    Each statistic is computed once, over the chunks of both parts: those of the
    reference are numbered below zero and give the limits.
    """
    reference, analysis = stage(reference), stage(analysis)
    before = number_chunks(reference, keys, rows).withColumn("part", -1 - F.col("part"))
    chunks = stage(before.unionByName(number_chunks(analysis, keys, rows)))
    reports = []
    for method, measure in (("kolmogorov_smirnov", ks_by_chunk),
                            ("jensen_shannon", lambda r, c, k: js_by_chunk(r, c, k, bins))):
        found = stage(measure(reference, chunks, keys))
        limits = alert_limits(found.where("part < 0"), keys)
        s = F.col("statistic")
        reports.append(series_join(found.where("part >= 0"), limits, keys.ids).select(
            *keys.ids, F.lit(method).alias("method"), "part", "statistic", "lower_limit", "upper_limit",
            ((s > F.col("upper_limit")) | (s < F.col("lower_limit"))).alias("alert")))
    return reports[0].unionByName(reports[1])
