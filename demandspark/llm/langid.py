"""Language identification by a byte convolutional network written and trained in numpy.

A text is read as windows of fixed length. A window's bytes are embedded, filters
of several widths slide over them, each keeps its greatest response, and a softmax
over these gives log probabilities. A text's are the means over its windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import by_value, held_out, map_rows, table, utf8

# Most documents of each language that a fit uses, in order of a hash of their id, and windows of each.
FIT_ROWS = 300
FIT_WINDOWS = 6
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
EPOCHS = 12
BATCH = 64
UNKNOWN = "und"
HAS_LETTER = re.compile(r"[^\W\d_]").search


def windows(data: bytes) -> np.ndarray:
    """All bytes as rows of ``WINDOW``; the last is filled up with zeros. No bytes, no rows."""
    n = -(-len(data) // WINDOW)
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


@dataclass
class ByteCnn:
    """Embedding, one filter bank (narrow filters are zero past their width), output layer, names."""

    names: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def start(names: list[str], rng: np.random.Generator) -> ByteCnn:
        wide, count = max(WIDTHS), FILTERS * len(WIDTHS)
        filters = rng.normal(0, 1, (wide * EMBEDDING, count)) * ByteCnn.mask() / np.sqrt(EMBEDDING * 3)
        return ByteCnn(names, rng.normal(0, 1, (256, EMBEDDING)).astype(np.float32), filters.astype(np.float32),
                       np.zeros(count, np.float32), rng.normal(0, 0.2, (count, len(names))).astype(np.float32),
                       np.zeros(len(names), np.float32))

    @staticmethod
    def mask() -> np.ndarray:
        rows = np.arange(max(WIDTHS) * EMBEDDING)[:, None] // EMBEDDING
        return (rows < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)

    def columns(self, batch: np.ndarray) -> np.ndarray:
        """Embedded stretches of the widest filter: (windows, places, width * embedding)."""
        wide = max(WIDTHS)
        flat = self.embed[batch].reshape(len(batch), WINDOW * EMBEDDING)
        view = np.lib.stride_tricks.sliding_window_view(flat, wide * EMBEDDING, axis=1)[:, ::EMBEDDING]
        return np.ascontiguousarray(view)

    def pooled(self, batch: np.ndarray) -> np.ndarray:
        cols = self.columns(batch)
        peak = (cols.reshape(-1, cols.shape[2]) @ self.filters).reshape(*cols.shape[:2], -1).max(axis=1)
        return np.maximum(peak + self.bias, 0)

    def log_probs(self, batch: np.ndarray) -> np.ndarray:
        z = self.pooled(batch) @ self.out + self.out_bias
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def text(self, data: bytes, at_once: int = 256) -> np.ndarray:
        """Probabilities for a whole text, from the mean of its windows' log probabilities."""
        rows = windows(data)
        total = sum(self.log_probs(rows[i:i + at_once]).sum(axis=0) for i in range(0, len(rows), at_once))
        z = total / max(1, len(rows))
        p = np.exp(z - np.max(z))
        return p / p.sum()


def train(batch: np.ndarray, labels: np.ndarray, names: list[str], seed: int = 7) -> ByteCnn:
    """Adam on the cross entropy of single windows."""
    rng = np.random.default_rng(seed)
    net = ByteCnn.start(names, rng)
    params = ["embed", "filters", "bias", "out", "out_bias"]
    m = {p: np.zeros_like(getattr(net, p)) for p in params}
    v = {p: np.zeros_like(getattr(net, p)) for p in params}
    mask, wide, t = ByteCnn.mask(), max(WIDTHS), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(batch))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            x, y, n = batch[pick], labels[pick], len(pick)
            cols = net.columns(x)
            response = (cols.reshape(-1, cols.shape[2]) @ net.filters).reshape(*cols.shape[:2], -1)
            place = response.argmax(axis=1)
            peak = np.take_along_axis(response, place[:, None, :], axis=1)[:, 0] + net.bias
            hidden = np.maximum(peak, 0)
            z = hidden @ net.out + net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            back = (p @ net.out.T) * (peak > 0)
            chosen = cols[np.arange(n)[:, None], place]  # windows, filters, width * embedding
            grads = {"out": hidden.T @ p, "out_bias": p.sum(axis=0), "bias": back.sum(axis=0),
                     "filters": np.einsum("nf,nfd->df", back, chosen) * mask, "embed": np.zeros_like(net.embed)}
            to_cols = (back[:, :, None] * net.filters.T[None]).reshape(n, -1, wide, EMBEDDING)
            places = place[:, :, None] + np.arange(wide)
            np.add.at(grads["embed"], x[np.arange(n)[:, None, None], places], to_cols)
            t += 1
            for name in params:
                g = grads[name]
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                step = 3e-3 * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.999**t)) + 1e-8)
                setattr(net, name, (getattr(net, name) - step).astype(np.float32))
    return net


def fit(docs: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> ByteCnn | None:
    """Learn from text and lang of up to ``fit_rows`` documents of each language; none known gives no network.

    Each document gives ``FIT_WINDOWS`` windows spread evenly over its text, cut out
    in tasks, so what reaches the driver is bounded.
    """
    rows = docs.where(learn).where("lang is not null and text is not null").select("doc_id", "lang", "text")
    found = sorted(r["lang"] for r in rows.select("lang").distinct().collect())  # as many as languages
    chosen = None
    for name in found:
        ids = rows.where(F.col("lang") == name).select("doc_id", "lang").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        chosen = ids if chosen is None else chosen.unionByName(ids)
    if chosen is None:
        return None

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, lang, text in rows:
            all_windows = windows(utf8(text))
            for i in sorted({len(all_windows) * k // FIT_WINDOWS for k in range(FIT_WINDOWS)} if len(all_windows) else ()):
                yield doc, lang, all_windows[i].tobytes()

    some = map_rows(rows.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"]), ["doc_id", "lang", "text"],
                    "doc_id bigint, lang string, bytes binary", cut, 512).collect()
    some = sorted((r["doc_id"], r["lang"], bytes(r["bytes"])) for r in some)
    if not some:
        return None
    batch = np.frombuffer(b"".join(r[2] for r in some), np.uint8).reshape(len(some), WINDOW)
    return train(batch, np.array([found.index(r[1]) for r in some]), found)


def identify(docs: DataFrame, net: ByteCnn | None, text: str = "text") -> DataFrame:
    """Add lang_pred and score to every row.

    A null text or one without a letter, and any text without a network, is ``und``
    with score 1.0 and 0.0 respectively.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    at = names.index(text)
    sent = by_value(docs.sparkSession, net)  # of fixed size
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        found = sent()
        for row in rows:
            value = row[at]
            if value is None or not HAS_LETTER(value):
                yield (*row, UNKNOWN, 1.0)
            elif found is None:
                yield (*row, UNKNOWN, 0.0)
            else:
                p = found.text(utf8(value))
                yield (*row, found.names[int(p.argmax())], float(p.max()))

    return map_rows(docs, [F.col(f"`{c}`") for c in names], f"{kinds}, lang_pred string, score double", run, 512)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    outside = held_out(F.col("doc_id"), 4, 2)
    found = identify(docs.select("doc_id", outside.alias("held_out"), "text"), fit(docs, ~outside))
    return found.select("doc_id", "held_out", "lang_pred", "score")
