"""Byte-level BPE encoding and decoding with a segment tree over byte positions."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import map_rows, table, utf8
from demandspark.llm.pieces import Remembered, Splitter, kept

NONE = 1 << 62
PLACE = 32


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from base64 lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: a whole token if it is one, else merges in order of rank.

    Leaf i of the tree holds rank and place of the pair that starts at byte i, as
    long as a live part starts there; an inner node holds the smaller of its
    children, so the root names the leftmost pair of least rank. A merge changes
    the pair of its part and that of the part to the left and empties one leaf:
    three point updates of logarithmic cost.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, rank = len(piece), ranks.get
    tree = [NONE] * (2 * n)
    for i in range(n - 1):
        r = rank(piece[i:i + 2])
        if r is not None:
            tree[n + i] = r << PLACE | i
    for i in range(n - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))
    while (top := tree[1]) != NONE:
        at = top & ((1 << PLACE) - 1)
        gone = end[at]
        stop = end[at] = end[gone]
        before = left[at]
        changed = [(gone, NONE), (at, NONE)]
        if stop < n:
            left[stop] = at
            r = rank(piece[at:end[stop]])
            if r is not None:
                changed[1] = (at, r << PLACE | at)
        if before >= 0:
            r = rank(piece[before:stop])
            changed.append((before, NONE if r is None else r << PLACE | before))
        for i, value in changed:
            i += n
            tree[i] = value
            while i > 1:
                i >>= 1
                a, b = tree[2 * i], tree[2 * i + 1]
                if b < a:
                    a = b
                if tree[i] == a:
                    break
                tree[i] = a
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder for one vocabulary; keeps the ids of short pieces seen before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.split = ranks, Splitter(pattern)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.ids = Remembered(lambda piece: np.array(encode_piece(utf8(piece), ranks), "<u4").tobytes())

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids.__getitem__, self.split(text or ""))), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def codec(ranks_path: str, pattern: str) -> Codec:
    return kept(("codec", ranks_path, pattern), lambda: Codec(load_ranks(ranks_path), pattern))


def encode_table(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (binary) to every row.

    Null text encodes as empty: no ids. Every match of ``pattern`` is encoded on
    its own; texts are never cut. All other columns stay.
    """
    df = df.drop("ids", "decoded")
    names = df.columns
    at = names.index(text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = codec(ranks_path, pattern)
        for row in rows:
            ids = coder.encode(row[at])
            yield (*row, ids.astype("<i4"), coder.decode(ids))

    return map_rows(df, [F.col(f"`{c}`") for c in names], f"{kinds}, ids array<int>, decoded binary", run, 256)


def codec_digests(df: DataFrame, ranks_path: str, pattern: str, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` with n_tokens, ids_sha256 and decoded_sha256 of every row's text.

    The ids and the decoded bytes are digested where they are made, so that they
    are not moved. Null text counts as empty.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = codec(ranks_path, pattern)
        for *key, value in rows:
            ids = coder.encode(value)
            yield (*key, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                   hashlib.sha256(coder.decode(ids)).hexdigest())

    return map_rows(df, [*keys, text], f"{kinds}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", run)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return codec_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN, ["doc_id"])
