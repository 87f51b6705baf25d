"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import by_value, held_out, map_rows, table

# Most labelled rows of each class that a fit uses, taken in order of a hash of their id.
FIT_ROWS = 1500
BITS = 18
ORDERS = (3, 4, 5)
SMOOTHING = 1.0
LEAST_TEXTS = 3
PENALTY = 1e-2
STEPS = 60
# The rarer class weighs as if it were at least this share of the rows.
LEAST_SHARE = 0.3


class Grams:
    """Which hashed character n-grams a text has."""

    def __init__(self, bits: int = BITS, orders: tuple[int, ...] = ORDERS) -> None:
        self.bits, self.orders = bits, orders
        self.seen = np.zeros(1 << bits, bool)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted indices; letters are lower-cased and a blank is put at both ends."""
        codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), np.uint32)
        self.seen[:] = False
        shift = np.uint32(32 - self.bits)
        state = codes * np.uint32(0x9E3779B1)
        for n in range(2, max(self.orders) + 1):
            if len(codes) < n:
                break
            state = (state[:-1] ^ (state[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + codes[n - 1:] * np.uint32(0xC2B2AE3D)
            if n in self.orders:
                self.seen[((state ^ (state >> np.uint32(13))) * np.uint32(0x27D4EB2F)) >> shift] = True
        return np.flatnonzero(self.seen).astype(np.int32)


@dataclass(frozen=True)
class NaiveBayesLinear:
    """Weights of the n-grams (ratio and linear weight multiplied out) and the intercept."""

    weights: np.ndarray
    intercept: float
    bits: int = BITS
    orders: tuple[int, ...] = ORDERS

    def score(self, grams: np.ndarray) -> float:
        z = float(self.weights[grams].sum()) / np.sqrt(max(1, len(grams))) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def train(grams: list[np.ndarray], labels: np.ndarray, prior: float, bits: int = BITS,
          orders: tuple[int, ...] = ORDERS) -> NaiveBayesLinear:
    """Fit logistic regression on the scaled n-grams of labelled texts.

    The log-count ratio of an n-gram compares the shares of both classes' texts
    that have it. A text's features are the ratios of its n-grams over the square
    root of their number; n-grams of fewer than ``LEAST_TEXTS`` texts are left out.
    ``prior`` is the share of label 1 among all labelled rows. Without both classes
    the score is the prior.
    """
    size, labels, texts = 1 << bits, np.asarray(labels, np.float64), len(grams)
    if not labels.any() or labels.all():
        prior = min(max(prior, 1e-6), 1 - 1e-6)
        return NaiveBayesLinear(np.zeros(size, np.float32), float(np.log(prior / (1 - prior))), bits, orders)
    prior = min(max(prior, LEAST_SHARE), 1 - LEAST_SHARE)
    lengths = np.array([len(g) for g in grams])
    having, toxic = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for own, mark in zip(grams, labels):
        having[own] += 1  # a text has an n-gram once
        toxic[own] += int(mark)
    ratio = (np.log((toxic + SMOOTHING) / (labels.sum() + 2 * SMOOTHING))
             - np.log((having - toxic + SMOOTHING) / ((1 - labels).sum() + 2 * SMOOTHING)))
    used = having >= LEAST_TEXTS
    n, share = int(used.sum()), labels.mean()
    place, scale = (np.cumsum(used) - 1).astype(np.int32), ratio[used]
    columns = [place[g[used[g]]] for g in grams]
    root = np.sqrt(np.maximum(1, lengths))
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share)) / texts
    w, b, m, v = np.zeros(n), float(np.log(prior / (1 - prior))), np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, STEPS + 1):  # Adam on the whole sample, text by text
        grad, scaled = np.zeros(n + 1), w * scale
        for column, norm, mark, each in zip(columns, root, labels, weight):
            z = scaled[column].sum() / norm + b
            error = each * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - mark)
            grad[column] += error / norm
            grad[n] += error
        grad[:n] = grad[:n] * scale + PENALTY / texts * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-10)
        w, b = w - step[:-1], b - step[-1]
    weights = np.zeros(size, np.float32)
    weights[used] = w * ratio[used]
    return NaiveBayesLinear(weights, float(b), bits, orders)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> NaiveBayesLinear:
    """Learn from up to ``fit_rows`` labelled documents of each class for which ``learn`` holds.

    ``labels`` has doc_id and toxic (rows with a null are skipped). The chosen ids,
    of bounded number, are broadcast; n-grams are found in tasks. One task learns from
    them, so that only the weights reach the driver.
    """
    known = labels.where(learn).where("doc_id is not null and toxic in (0, 1)").select("doc_id", "toxic").distinct()
    found = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for c in (0, 1):
        part = known.where(f"toxic = {c}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        grams = Grams()
        for doc, text, toxic in rows:
            yield doc, toxic, grams(text).tobytes()

    prior = found.get(1, 0) / max(1, sum(found.values()))

    def learn_all(rows: Iterator[tuple]) -> Iterator[tuple]:
        rows = sorted(rows)
        model = train([np.frombuffer(g, np.int32) for _, _, g in rows], np.array([t for _, t, _ in rows]), prior)
        yield model.weights.tobytes(), model.intercept

    rows = map_rows(texts, ["doc_id", "text", "toxic"], "doc_id bigint, toxic int, grams binary", run, 64)
    got = map_rows(rows.repartition(1), ["doc_id", "toxic", "grams"], "weights binary, intercept double", learn_all).first()
    if got is None:
        return train([], np.zeros(0, int), prior)
    return NaiveBayesLinear(np.frombuffer(bytes(got["weights"]), np.float32), got["intercept"])


def score_column(docs: DataFrame, model: NaiveBayesLinear, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out`` (0 to 1) of every whole text; null and empty texts get that of no n-gram but the blanks."""
    docs = docs.drop(out)
    names = docs.columns
    at = names.index(text)
    sent = by_value(docs.sparkSession, model)  # of fixed size
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        found, grams = sent(), Grams()
        for row in rows:
            yield (*row, found.score(grams(row[at])))

    return map_rows(docs, [F.col(f"`{c}`") for c in names], f"{kinds}, `{out}` double", run, 512)


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """All columns of ``docs`` with ``score``; learns from the labelled rows that ``learn`` admits."""
    return score_column(docs, fit(docs, labels, learn))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    outside = held_out(F.col("doc_id"), 5, 0)
    model = fit(docs, table(spark, sf_dir, "labels"), ~outside)
    sent = by_value(spark, model)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        found, grams = sent(), Grams()
        for doc, out, text in rows:
            score = found.score(grams(text))
            yield doc, out, score, int(score >= 0.5)

    return map_rows(docs.select("doc_id", outside.alias("held_out"), "text"), ["doc_id", "held_out", "text"],
                    "doc_id bigint, held_out boolean, score double, predicted int", run)
