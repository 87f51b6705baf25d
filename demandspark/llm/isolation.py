"""Quality rules: plain limits first, then isolation forests on the rules' statistics.

A tree of a forest splits a small sample of documents at random features and values.
Documents that differ from the rest are alone after few splits, so a short mean path
marks an anomaly. One forest looks at the form of words, one at repetition, as honest
texts differ much in the latter; all labelled rows say for each from which score on a
document is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.common import stage, table

LEAST_WORDS = 20
REPEAT_WIDTH = 8
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Labelled rows that the driver holds as a whole; of more, only those that a tree draws are fetched.
POOL_ROWS = 8192
TREES = 100
SAMPLE = 64
# Share of the labelled good rows that one forest may reject at most.
MOST_LOST = 0.0025
SEED = 12
# A rate of few words is drawn towards that of so many usual ones.
USUAL_WORDS, USUAL_LENGTH = 30, 5
# The features of each forest.
FORESTS = {"form": (0, 1), "repeats": (2, 3)}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[str], width: int = REPEAT_WIDTH) -> int:
    """Words that lie in a window of ``width`` words which is found twice or more.

    Windows are named by doubling: equal names of two halves make equal windows.
    """
    n = len(words)
    if n <= width:
        return 0
    numbers: dict[str, int] = {}
    name = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    span = 1
    while span < width:
        step = min(span, width - span)
        pairs = name[:len(name) - step] * (int(name.max()) + 1) + name[step:]
        kinds, name = np.unique(pairs, return_inverse=True)
        if len(kinds) == len(name):
            return 0
        span += step
    often = np.flatnonzero(np.bincount(name)[name] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, often, 1)
    np.add.at(edges, often + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def rule_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text; null has none."""
    if not text:
        return 0, 0, 0, 0, 0
    words = WORD.findall(text)
    repeated, seen = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), repeated, repeated_words(words)


def fails_base(stats: np.ndarray) -> np.ndarray:
    """Too few words, or too many of them in repeated windows."""
    return (stats[:, 0] < LEAST_WORDS) | (100 * stats[:, 4] > REPEAT_PERCENT * stats[:, 0])


def features(stats: np.ndarray) -> np.ndarray:
    """Rates that do not grow with the length of a text: letters to a word, symbols to a letter,
    repeated lines and words to a word."""
    words, chars = stats[:, 0].astype(float), stats[:, 1].astype(float)
    more = words + USUAL_WORDS
    return np.column_stack([(chars + USUAL_LENGTH * USUAL_WORDS) / more, stats[:, 2] / (chars + 1),
                            stats[:, 3] / more, stats[:, 4] / more])


def mean_path(rows: np.ndarray | float) -> np.ndarray:
    """Mean path length of a search that fails in a random binary tree of so many rows."""
    m = np.maximum(2.0, np.asarray(rows, float))
    full = 2.0 * (np.log(m - 1) + np.euler_gamma) - 2.0 * (m - 1) / m
    return np.where(np.asarray(rows) > 2, full, np.where(np.asarray(rows) == 2, 1.0, 0.0))


@dataclass(frozen=True)
class IsolationForest:
    """Trees in heap order: the children of node i are 2i+1 and 2i+2; feature -1 is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    length: np.ndarray
    depth: int
    usual: float

    @staticmethod
    def fit(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED,
            draws: list[np.ndarray] | None = None) -> "IsolationForest":
        """Trees on ``sample`` random rows each; ``draws`` names the rows of each tree if they were drawn before."""
        rng = np.random.default_rng(seed)
        size = min(sample, len(x))
        depth = max(1, int(np.ceil(np.log2(max(2, size)))))
        nodes = 2 ** (depth + 1) - 1
        feature, cut, length = np.full((trees, nodes), -1, np.int16), np.zeros((trees, nodes)), np.zeros((trees, nodes))
        for t in range(trees):
            open_ = [(0, 0, x[rng.choice(len(x), size, replace=False) if draws is None else draws[t]])]
            while open_:
                at, level, rows = open_.pop()
                low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(x.shape[1]),) * 2
                spread = np.flatnonzero(high > low)
                if level == depth or not len(spread):
                    length[t, at] = level + float(mean_path(len(rows)))
                    continue
                f = int(rng.choice(spread))
                value = rng.uniform(low[f], high[f])
                value = value if value > low[f] else high[f]
                feature[t, at], cut[t, at] = f, value
                right = rows[:, f] >= value
                open_ += [(2 * at + 1, level + 1, rows[~right]), (2 * at + 2, level + 1, rows[right])]
        return IsolationForest(feature, cut, length, depth, max(float(mean_path(size)), 1e-9))

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path length over the usual one: near 1 is an anomaly."""
        tree = np.arange(len(self.feature))[None, :]
        row = np.arange(len(x))[:, None]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            f = self.feature[tree, at]
            right = x[row, np.maximum(f, 0)] >= self.cut[tree, at]
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        return 2.0 ** (-self.length[tree, at].mean(axis=1) / self.usual)


def calibrate(scores: np.ndarray, good: np.ndarray, most_lost: float = MOST_LOST) -> float:
    """The score beyond which a document is left out.

    Of the thresholds that lose at most ``most_lost`` of the good rows, the one with the
    greatest difference between the shares of bad and good rows beyond it; without bad
    rows the least of these thresholds, without good rows none (infinity).
    """
    fine, poor = np.sort(scores[good]), np.sort(scores[~good])
    if not len(fine):
        return float("inf")
    least = fine[len(fine) - 1 - int(most_lost * len(fine))]
    if not len(poor):
        return float(least)
    tried = np.unique(np.concatenate([[least], scores[scores >= least]]))
    caught = 1 - np.searchsorted(poor, tried, "right") / len(poor)
    lost = 1 - np.searchsorted(fine, tried, "right") / len(fine)
    return float(tried[np.argmax(caught - lost)])


@dataclass(frozen=True)
class QualityModel:
    """Forests by name (none: every document passes) and the score beyond which each rejects a document."""

    forests: dict[str, IsolationForest]
    thresholds: dict[str, float]

    def verdict(self, stats: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """base_failed, the score of each forest and kept, for rows of :data:`STATS`."""
        x, failed = features(stats), fails_base(stats)
        kept, scores = ~failed, []
        for name, columns in FORESTS.items():
            score = self.forests[name].score(x[:, columns]) if name in self.forests else np.zeros(len(stats))
            kept = kept & (score <= self.thresholds.get(name, float("inf")))
            scores.append(score)
        return failed, scores, kept


def stats_column(docs: DataFrame, text: str = "text", batch: int = 512) -> DataFrame:
    """All columns but the text, and the rule statistics of the whole text."""
    others = [c for c in docs.columns if c != text and c not in STATS]
    plain = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").alias("_text"))
    out = plain.drop("_text")
    for c in STATS:
        out = out.withColumn(c, F.lit(0).cast("bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                found = [rule_stats(t.as_py()) for t in part.column("_text")]
                columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                yield pa.record_batch([*part.columns[:-1], *columns], names=[*others, *STATS])

    return plain.mapInArrow(run, out.schema)


def _ranged(df: DataFrame, order: list[Column]) -> tuple[DataFrame, Column]:
    """A written copy cut by ranges of ``order``, numbered by ``_part``, and its window of one part."""
    cut = stage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    return cut, Window.partitionBy("_part").orderBy(*order)


def thresholds(scored: DataFrame, names: list[str], most_lost: float = MOST_LOST) -> dict[str, float]:
    """:func:`calibrate` for the scores in the columns ``names``, over a table of any size with the boolean ``good``.

    Equal scores are counted as one row; the counts run along ranges of the scores, whose
    totals, one row each, are all that a range needs to know of those before it.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("score")) for n in names])).alias("_s")
    counts = scored.select("good", pairs).groupBy("_s.name", "_s.score").agg(
        F.count_if("good").alias("fine"), F.count_if(~F.col("good")).alias("poor"))
    counts, within = _ranged(counts, [F.col("name"), F.col("score")])
    each = counts.groupBy("name", "_part").agg(F.sum("fine").alias("fine"), F.sum("poor").alias("poor")).orderBy("name", "_part").collect()
    out, before, total = {}, [], {}
    for r in each:
        fine, poor = total.get(r["name"], (0, 0))
        before.append((r["name"], r["_part"], fine, poor))
        total[r["name"]] = fine + r["fine"], poor + r["poor"]
    for n in names:
        fine, poor = total.get(n, (0, 0))
        out[n] = float("inf")
        if not fine:
            continue
        start = scored.sparkSession.createDataFrame([r[1:] for r in before if r[0] == n], "_part int, _fine bigint, _poor bigint")
        upto = within.rowsBetween(Window.unboundedPreceding, 0)
        rows = counts.where(F.col("name") == n).join(F.broadcast(start), "_part").select(
            "score", (F.sum("fine").over(upto) + F.col("_fine")).alias("fine"), (F.sum("poor").over(upto) + F.col("_poor")).alias("poor"))
        caught = 1 - F.col("poor") / poor if poor else F.lit(0.0)
        lost = 1 - F.col("fine") / fine if poor else F.lit(0.0)
        best = rows.where(F.col("fine") >= fine - int(most_lost * fine)).agg(
            F.max(F.struct((caught - lost).alias("gain"), (-F.col("score")).alias("least")))["least"].alias("least"))
        out[n] = -best.first()["least"]
    return out


def _tree_rows(usual: DataFrame, n: int, pool_rows: int, trees: int, sample: int,
               seed: int) -> tuple[np.ndarray, list[np.ndarray] | None]:
    """Features of the rows that trees are made of, and each tree's own among them (None: they draw from all)."""
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality"), *[F.col(c) for c in STATS]]
    if n <= pool_rows:
        rows, draws = usual.orderBy(*order).collect(), None
    else:
        rng = np.random.default_rng([seed, n])
        ranks = [rng.choice(n, sample, replace=False) for _ in range(trees)]
        wanted = np.unique(np.concatenate(ranks))
        cut, within = _ranged(usual, order)
        sizes = {r["_part"]: r["count"] for r in cut.groupBy("_part").count().collect()}
        parts = sorted(sizes)
        first = dict(zip(parts, np.cumsum([0, *[sizes[p] for p in parts]]).tolist()))
        edges = [first[p] for p in parts[1:]]
        asked = [(parts[k], r - first[parts[k]] + 1, r) for r, k in zip(wanted.tolist(), np.searchsorted(edges, wanted, "right").tolist())]
        asked = usual.sparkSession.createDataFrame(asked, "_part int, _place int, _rank bigint")
        numbered = cut.withColumn("_place", F.row_number().over(within))
        rows = numbered.join(F.broadcast(asked), ["_part", "_place"]).orderBy("_rank").collect()
        draws = [np.searchsorted(wanted, r) for r in ranks]
    return features(np.array([[r[c] for c in STATS] for r in rows], np.int64)), draws


def learn(stats: DataFrame, labels: DataFrame, pool_rows: int = POOL_ROWS, trees: int = TREES, sample: int = SAMPLE,
          seed: int = SEED) -> QualityModel:
    """Learn from the labelled rows of ``stats`` (doc_id and :data:`STATS`) that pass the plain limits.

    ``labels`` has doc_id and quality (0 or 1; rows with a null are skipped). Each tree is
    made of ``sample`` random rows out of all of them, and all are scored for the thresholds.
    Without labelled documents all pass.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", "quality").distinct()
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    usual = stage(stats.select("doc_id", *STATS).join(known, "doc_id").where(~failed))
    n = usual.count()
    if not n:
        return QualityModel({}, {})
    x, draws = _tree_rows(usual, n, pool_rows, trees, sample, seed)
    forests = {name: IsolationForest.fit(x[:, c], trees, sample, seed, draws) for name, c in FORESTS.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                own = features(np.column_stack([part.column(c).to_numpy() for c in STATS]))
                scores = [pa.array(f.score(own[:, FORESTS[name]])) for name, f in forests.items()]
                yield pa.record_batch([part.column("good"), *scores], names=["good", *forests])

    kinds = ", ".join(f"{name} double" for name in forests)
    scored = usual.select((F.col("quality") == 1).alias("good"), *STATS).mapInArrow(run, f"good boolean, {kinds}")
    return QualityModel(forests, thresholds(scored, list(forests)))


def fit(docs: DataFrame, labels: DataFrame, pool_rows: int = POOL_ROWS, trees: int = TREES, sample: int = SAMPLE,
        seed: int = SEED) -> QualityModel:
    """:func:`learn` from the texts of ``docs`` (doc_id and text)."""
    return learn(stage(stats_column(docs.select("doc_id", "text"))), labels, pool_rows, trees, sample, seed)


MADE = ("base_failed", *[f"anomaly_{n}" for n in FORESTS], "kept")


def judged(stats: DataFrame, model: QualityModel, batch: int = 512) -> DataFrame:
    """All columns of ``stats`` with base_failed, the score of each forest and kept."""
    others = [c for c in stats.columns if c not in MADE]
    plain = stats.select(*[F.col(f"`{c}`") for c in others])
    out = plain.select("*", F.lit(True).alias(MADE[0]), *[F.lit(0.0).alias(c) for c in MADE[1:-1]], F.lit(True).alias(MADE[-1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                failed, scores, kept = model.verdict(np.column_stack([part.column(c).to_numpy() for c in STATS]))
                yield pa.record_batch([*part.columns, *[pa.array(c) for c in (failed, *scores, kept)]], names=[*others, *MADE])

    return plain.mapInArrow(run, out.schema)


def quality_verdicts(docs: DataFrame, model: QualityModel, text: str = "text", batch: int = 512) -> DataFrame:
    """All columns but the text, the rule statistics, base_failed, the score of each forest
    (``anomaly_<name>``) and kept.

    Null and empty texts have no words and fail the plain limits. Columns of these names
    are replaced; repeated rows get equal results.
    """
    return judged(stats_column(docs.drop(*[c for c in MADE if c != text]), text, batch), model, batch)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stage(stats_column(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return judged(stats, learn(stats, table(spark, sf_dir, "labels")))
