"""Best-fit decreasing packing of tokenized documents into sequences.

Sizes are whole numbers up to the capacity, so the work is planned on the count
of pieces per size, a table no longer than the capacity: the segment tree over
remaining capacities finds the tightest open bin for a piece in logarithmic time,
and bins that look alike move through it together. The plan says which ranks of
a size go to which bins and places; pieces find theirs by their rank.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.common import crc, map_rows, stage, table
from demandspark.llm.pieces import Remembered, Splitter, kept

CAPACITY = 1024
END_ID = 2


class OpenBins:
    """Segment tree over remaining capacities: groups of alike bins and the tightest that fits."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.some = [0] * (2 * self.size)
        self.groups: list[list[list[int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        i = room + self.size
        self.some[i] = 1 if self.groups[room] else 0
        while i > 1:
            i >>= 1
            self.some[i] = self.some[2 * i] | self.some[2 * i + 1]

    def put(self, room: int, first: int, count: int) -> None:
        """``count`` bins from number ``first`` on have ``room`` left."""
        if count and room:
            groups = self.groups[room]
            if groups and groups[-1][0] + groups[-1][1] == first:
                groups[-1][1] += count
            else:
                groups.append([first, count])
            self._mark(room)

    def take(self, room: int) -> list[int]:
        group = self.groups[room].pop()
        self._mark(room)
        return group

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` that an open bin has."""
        i = need + self.size
        if self.some[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.some[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``counts[size]`` pieces of each size.

    Rows (size, first_rank, n, per_bin, first_bin, place): the pieces of that size
    ranked first_rank .. first_rank+n-1 go, per_bin at a time, to the bins from
    first_bin on, the first of each bin at ``place``. A bin that takes one piece of
    a size stays the tightest for the next as long as another fits, so filling it
    up first is what best fit does.
    """
    bins, rows, made = OpenBins(capacity), [], 0
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            room = bins.tightest(size)
            if room is None:
                room, first, count = capacity, made, -(-left // (capacity // size))
                made += count
            else:
                first, count = bins.take(room)
            per_bin = room // size
            full = min(count, left // per_bin)
            if full:
                rows.append((size, rank, full * per_bin, per_bin, first, capacity - room))
                bins.put(room - per_bin * size, first, full)
                rank, left = rank + full * per_bin, left - full * per_bin
            if left and full < count:  # the last pieces do not fill a bin of this kind
                rows.append((size, rank, left, left, first + full, capacity - room))
                bins.put(room - left * size, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            bins.put(room, first + full, count - full)
    return rows


class WordIds:
    """Ids of a text by a tokenizer file, each piece of the pattern encoded once and remembered.

    A text that holds one of the file's added tokens is encoded as a whole, as such a token
    goes before the pattern.
    """

    def __init__(self, path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split, self.ids = Splitter(pattern), Remembered(self._encode)

    def _encode(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        text = text or ""
        if any(t in text for t in self.added):
            return self._encode(text)
        return b"".join(map(self.ids.__getitem__, self.split(text)))


def cut(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of a document of ``n`` ids; only the first may be shorter than the capacity."""
    return list(range(0, n, capacity)) if n % capacity == 0 else [0, *range(n % capacity, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int, end_id: int, doc_id: str = "doc_id",
                 text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and its rank inside its task and size.

    Every document ends in ``end_id``, so a null or empty text is one id long.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (f"`{doc_id}` {kind}, piece int, start bigint, length int, ids_crc32 bigint, _task int, _rank bigint"
              + ", ids binary" * with_ids)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = kept(("words", tokenizer_path, pattern), lambda: WordIds(tokenizer_path, pattern))
        tail, task = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for doc, value in rows:
            ids = coder(value) + tail
            starts = cut(len(ids) // 4, capacity)
            for k, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids) // 4])):
                own, n = ids[4 * start:4 * stop], stop - start
                seen[n] = seen.get(n, 0) + 1
                yield (doc, k, start, n, crc(own), task, seen[n] - 1, *[own] * with_ids)

    return map_rows(docs, [doc_id, text], schema, run)


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces with ``length``, ``_task`` and ``_rank``.

    ``pieces`` must be a written table, as its numbers per task are used twice. Only
    counts leave it: per task and size for the ranks, per size for the plan, whose
    rows are fewer than pairs of sizes. Extra columns stay; an empty table gives none.
    """
    spark = pieces.sparkSession
    per_task = pieces.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_task")
    per_task = per_task.withColumn("_before", F.sum("_n").over(before) - F.col("_n"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan(counts, capacity)
    steps: dict[int, list[tuple]] = {}
    for size, *rest in rows:
        steps.setdefault(size, []).append(tuple(rest))
    planned = spark.createDataFrame(
        [(size, s) for size, s in steps.items()],
        "length int, _steps array<struct<first:bigint,n:bigint,per:bigint,bin:bigint,place:bigint>>")
    ranked = (pieces.join(per_task.drop("_n"), ["length", "_task"])
              .withColumn("_rank", F.col("_rank") + F.col("_before"))
              .join(F.broadcast(planned), "length"))  # at most ``capacity`` rows
    # The step of a rank is the last that starts at or before it.
    step = F.expr("element_at(_steps, size(filter(_steps, s -> s.first <= _rank)))")
    inside = F.col("_rank") - F.col("_s.first")
    return (ranked.withColumn("_s", step)
            .withColumn("sequence_id", (F.col("_s.bin") + F.floor(inside / F.col("_s.per"))).cast("bigint"))
            .withColumn("offset", (F.col("_s.place") + F.pmod(inside, F.col("_s.per")) * F.col("length")).cast("bigint"))
            .drop("_s", "_steps", "_rank", "_task", "_before"))


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
         doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Rows that repeat are packed as often as they come; a null doc_id is kept.
    """
    pieces = stage(token_pieces(docs, tokenizer_path, pattern, capacity, end_id, doc_id, text, with_ids))
    packed = best_fit(pieces, capacity)
    last = ["ids"] if with_ids else []
    return packed.select(doc_id, "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32",
                         "sequence_id", "offset", *last)


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
