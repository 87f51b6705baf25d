"""Repeated passages by suffix arrays.

A byte of a text is removed if a string of ``WINDOW`` bytes that covers it also
starts in a text with a smaller id. Strings that agree in ``WINDOW`` bytes have the
same minimizer (least hash of a short stretch inside), so suffixes are dealt by it:

1. Every text's minimizers; those found in one text only cannot repeat and go.
2. Stretches of text around the others are dealt by minimizer, equal ones once.
3. In each share the suffixes are sorted by the difference-cover algorithm: sampled
   triples are sorted and named, the names sorted in the same way, and the other
   suffixes merged in. Adjacent suffixes are then compared in their first ``WINDOW``
   bytes, and runs of equal ones get the smallest id among them.
4. Covered bytes are merged per text and cut out.

Recursion ends once names stand for more than ``WINDOW`` bytes, as order beyond that
does not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.bytesets import Powers, mix, prefix_hash
from demandspark.llm.common import map_rows, table, utf8
from demandspark.llm.common import stage_tidily as stage

WINDOW = 50
STRETCH = 24
DEPTH = 4  # names of this level stand for 3 ** 4 bytes, more than WINDOW
# Bytes of text per share and per group of texts whose spans one task puts together, entries kept before a task hands them on, bytes sorted at once, references looked up at once.
SHARE_BYTES = 4 << 20
PART_BYTES = 256 << 20
SLAB = 1 << 20
SORTED_BYTES = 1 << 18
REFERENCES = 1 << 15
LAST_ID = (1 << 63) - 1
KEY_BITS = 48


# --- suffix array ---------------------------------------------------------------------------------------------------

def _names(*symbols: np.ndarray) -> np.ndarray:
    """Dense names from 1 of tuples of symbols, in their order."""
    key = symbols[0]
    for more in symbols[1:]:
        width = int(more.max(initial=0)) + 1
        if (int(key.max(initial=0)) + 1) * width >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
        key = key * width + more
    return np.unique(key, return_inverse=True)[1].astype(np.int64) + 1


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes of positive symbols, exact in their first 3 ** depth symbols.

    Suffixes alike in these keep together, in any order; sorting the merge keys and
    making places ascend concerns only them.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    p = np.concatenate([s, np.zeros(3, s.dtype)]).astype(np.int64)
    sampled = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    names = _names(p[sampled], p[sampled + 1], p[sampled + 2])
    if depth == 1 or names.max() == len(names):
        order = np.argsort(names, kind="stable")
    else:
        order = suffix_array(names, depth - 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sampled[order]] = np.arange(1, len(order) + 1)
    sampled = sampled[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    wide = len(order) + 2
    key = p[rest] * wide + rank[rest + 1]
    by_key = np.argsort(key, kind="stable")
    rest, key = rest[by_key], key[by_key]
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(np.sort(p[one] * wide + rank[one + 1]), key)
    both = np.concatenate([two, rest])
    pair = _names(p[both], p[both + 1]) * wide + rank[both + 2]
    before += np.searchsorted(np.sort(pair[:len(two)]), pair[len(two):])
    out = np.empty(n, np.int64)
    place = np.maximum.accumulate(before) + np.arange(len(rest))
    others = np.ones(n, bool)
    others[place] = False
    out[place], out[others] = rest, sampled
    return out


def least_owner(strings: list[bytes], owners: np.ndarray) -> list[np.ndarray]:
    """For each string and each window in it, the smallest owner of a string that has that window."""
    lengths = np.array([len(x) for x in strings])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    data = np.frombuffer(b"\0".join(strings) + b"\0" * 8, np.uint8)
    symbols = data[:int(starts[-1] + lengths[-1])].astype(np.int64) + 2
    symbols[(starts[1:] - 1)] = 1
    order = suffix_array(symbols, DEPTH)
    counts = lengths - WINDOW + 1
    owner = np.full(len(symbols), -1, np.int64)
    place = np.concatenate([[0], np.cumsum(counts)[:-1]])
    at = np.arange(counts.sum()) + np.repeat(starts - place, counts)
    owner[at] = np.repeat(np.arange(len(strings)), counts)
    order = order[owner[order] >= 0]
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    a, b = order[:-1], order[1:]
    alike = np.ones(len(a), bool)
    for k in [*range(0, WINDOW - 7, 8), WINDOW - 8]:
        alike &= words[a + k] == words[b + k]
    first = np.flatnonzero(np.concatenate([[True], ~alike]))
    least = np.minimum.reduceat(owners[owner[order]], first)
    found = np.empty(len(symbols), np.int64)
    found[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    return [found[s:s + c] for s, c in zip(starts.tolist(), counts.tolist())]


# --- minimizers -----------------------------------------------------------------------------------------------------

def _spread(least: np.ndarray) -> np.ndarray:
    """Keys of least hashes, one to one. The least of many hashes is mostly small; keys are spread evenly."""
    low, half = np.uint64((1 << KEY_BITS) - 1), np.uint64(KEY_BITS // 2)
    for odd in (0x9E3779B97F4B, 0xC2B2AE3D27D5):
        least = (least ^ (least >> half)) * np.uint64(odd) & low
    return least ^ (least >> half)


def minimizers(data: bytes, tables: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimizer: its key, the first window, one past the last."""
    b = np.frombuffer(data, np.uint8)
    if len(b) < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    prefix = prefix_hash(b, tables)
    n = len(b) - STRETCH + 1
    least = mix((prefix[STRETCH:] - prefix[:-STRETCH]) * tables.get(n)[1][:n]) >> np.uint64(64 - KEY_BITS)
    wide, span = WINDOW - STRETCH + 1, 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[:span - wide], least[wide - span:])
    turns = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], turns])
    return _spread(least[first]), first, np.concatenate([turns, [len(least)]])


def share_of(key: np.ndarray, shares: int) -> np.ndarray:
    """Share of each key, not descending with the keys. Their top 32 bits decide, so the product fits for any number of shares below 2 ** 32."""
    return ((key >> np.uint64(KEY_BITS - 32)) * np.uint64(shares) >> np.uint64(32)).astype(np.int64)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of whole numbers, first all lowest ones and so on; sorted values then compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def _ids(ids: list[tuple[int, int]]) -> bytes:
    return np.array(ids, "<i8").tobytes()


def _part_of(doc: np.ndarray, mark: np.ndarray, parts: int) -> np.ndarray:
    """Group of a text, by hash."""
    mixed = doc.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ mark.astype(np.int64).view(np.uint64)
    return ((mixed >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)


def _send_keys(rows: DataFrame, shares: int) -> DataFrame:
    """Keys of each slab of texts, dealt by key: share, keys, which text has each, the texts' ids.

    A key that several texts of the slab have is known to repeat. It is sent once,
    without a text; the rows of ``share`` -1 hand it to its texts.
    """
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        tables, ids, keys, texts, held = Powers(), [], [], [], 0

        def flush() -> Iterator[tuple]:
            key, text = np.concatenate(keys), np.repeat(np.arange(len(keys), dtype=np.uint32), [len(k) for k in keys])
            order = np.argsort(key, kind="stable")
            key, text = key[order], text[order]
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            many = np.repeat(np.diff(np.append(np.flatnonzero(fresh), len(key))) > 1, np.diff(np.append(np.flatnonzero(fresh), len(key))))
            again, owner = key[many], text[many]
            for t in np.unique(owner):
                yield -1, again[owner == t].astype("<u8").tobytes(), None, _ids([ids[t]])
            key, text = key[fresh], np.where(many, np.uint32(0xFFFFFFFF), text)[fresh]
            share, first = np.unique(share_of(key, shares), return_index=True)
            for s, a, b in zip(share.tolist(), first.tolist(), np.append(first[1:], len(key)).tolist()):
                used, local = np.unique(text[a:b], return_inverse=True)
                yield s, _planes(key[a:b]), _planes(local.astype("<u4")), _ids(
                    [ids[t] if t != 0xFFFFFFFF else (0, 0) for t in used.tolist()]) + bytes([int(used[-1] == 0xFFFFFFFF)])

        for doc, mark, text in rows:
            found = np.unique(minimizers(utf8(text), tables)[0])
            if len(found):
                ids.append((doc, mark))
                keys.append(found)
                held += len(found)
            if held >= SLAB:
                yield from flush()
                ids, keys, held = [], [], 0
        if keys:
            yield from flush()

    return map_rows(rows, ["doc", "mark", "text"], "share int, keys binary, texts binary, ids binary", run, 64)


def _repeated_keys(sent: DataFrame, shares: int, parts: int) -> DataFrame:
    """doc, mark, keys: the keys of each text that other texts have too.

    A share hands on one row for each of ``parts`` groups of texts, as in :func:`_covered`.
    """
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, text, ids, n = [], [], [], 0
        sure, whose = [], []
        for share, keys, texts, who in rows:
            if share < 0:
                sure.append(np.frombuffer(keys, "<u8"))
                whose.append(np.frombuffer(who, "<i8").reshape(-1, 2))
                continue
            own = np.frombuffer(who[:-1], "<i8").reshape(-1, 2)
            local = _unplanes(texts, "<u4").astype(np.int64)
            known = local == len(own) - 1 if who[-1] else np.zeros(len(local), bool)
            key.append(_unplanes(keys, "<u8"))
            text.append(np.where(known, -1, local + n))
            ids.append(own)
            n += len(own)
        if key:
            key, text = np.concatenate(key), np.concatenate(text)
            order = np.argsort(key, kind="stable")
            key, text = key[order], text[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(first, len(key)))
            many = np.repeat((size > 1) | (np.minimum.reduceat(text, first) < 0), size) & (text >= 0)
            sure.append(key[many])
            whose.append(np.zeros((0, 2), np.int64))
            text = [text[many]]
        else:
            text = []
        text = [np.full(len(k), n + i, np.int64) for i, k in enumerate(sure[:len(sure) - len(text)])] + text
        if not sum(map(len, sure)):
            return
        key, text, ids = np.concatenate(sure), np.concatenate(text), np.concatenate([*ids, *whose])
        part = _part_of(ids[:, 0], ids[:, 1], parts)
        order = np.lexsort((text, part[text]))
        key, text = key[order], text[order]
        turns = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        owner, size = text[turns], np.diff(np.append(turns, len(text)))
        used, first = np.unique(part[owner], return_index=True)
        for p, a, b in zip(used.tolist(), first.tolist(), np.append(first[1:], len(owner)).tolist()):
            low, high = int(turns[a]), int(turns[a] + size[a:b].sum())
            yield (p, _planes(ids[owner[a:b], 0].astype("<i8")), _planes(ids[owner[a:b], 1].astype("<i8")),
                   _planes(size[a:b].astype("<u4")), key[low:high].astype("<u8").tobytes())

    def by_text(rows: Iterator[tuple]) -> Iterator[tuple]:
        found: dict[tuple[int, int], list[bytes]] = {}
        for _, doc, mark, sizes, keys in rows:
            ends = np.cumsum(_unplanes(sizes, "<u4"), dtype=np.int64).tolist()
            for d, m, a, b in zip(_unplanes(doc, "<i8").tolist(), _unplanes(mark, "<i8").tolist(), [0, *ends], ends):
                found.setdefault((d, m), []).append(keys[8 * a:8 * b])
        for (d, m), own in found.items():
            yield d, m, b"".join(own)

    # Rows that need no share of their own are dealt by text.
    dealt = F.when(F.col("share") >= 0, F.col("share")).otherwise(F.pmod(F.xxhash64("ids"), F.lit(shares)).cast("int"))
    packed = map_rows(sent.repartition(shares, dealt), ["share", "keys", "texts", "ids"],
                      "part bigint, docs binary, marks binary, sizes binary, keys binary", run)
    return map_rows(packed.repartition(parts, "part"), ["part", "docs", "marks", "sizes", "keys"],
                    "doc bigint, mark bigint, keys binary", by_text)


# --- repeated stretches ---------------------------------------------------------------------------------------------

def _send_stretches(texts: DataFrame, shares: int) -> DataFrame:
    """Stretches around repeated keys, dealt by key; equal ones of a slab once."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        tables = Powers()
        slabs: dict[int, tuple[dict, list]] = {}
        held = 0

        def flush() -> Iterator[tuple]:
            for share, (strings, refs) in slabs.items():
                keys = np.array([k for k, _ in strings], "<u8")
                lengths = np.array([len(x) for _, x in strings], "<u4")
                doc, mark, start, which = (np.array(c, "<i8") for c in zip(*refs))
                yield (share, keys.tobytes(), lengths.tobytes(), b"".join(x for _, x in strings), _planes(doc), _planes(mark),
                       _planes(start.astype("<u4")), _planes(which.astype("<u4")))

        for doc, mark, text, keys in rows:
            data, known = utf8(text), np.unique(np.frombuffer(keys, "<u8"))
            key, first, stop = minimizers(data, tables)
            place = np.minimum(np.searchsorted(known, key), len(known) - 1)
            kept = np.flatnonzero(known[place] == key)
            share = share_of(key[kept], shares)
            for s, k, a, b in zip(share.tolist(), key[kept].tolist(), first[kept].tolist(), stop[kept].tolist()):
                strings, refs = slabs.setdefault(s, ({}, []))
                refs.append((doc, mark, a, strings.setdefault((k, data[a:b + WINDOW - 1]), len(strings))))
            held += len(kept)
            if held >= SLAB // 8:
                yield from flush()
                slabs, held = {}, 0
        yield from flush()

    return map_rows(texts, ["doc", "mark", "text", "keys"], "share int, keys binary, lengths binary, strings binary, "
                    "doc binary, mark binary, start binary, which binary", run, 64)


def _spans(least: np.ndarray, counts: np.ndarray, doc: np.ndarray, start: np.ndarray, which: np.ndarray,
           place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of each reference whose least owner is smaller than its text: reference, first byte, end."""
    n = counts[which]
    ref = np.repeat(np.arange(len(which)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    hit = least[place[which][ref] + inside] < doc[ref]
    ref, inside = ref[hit], inside[hit]
    if not len(ref):
        return ref, ref, ref
    new = np.concatenate([[True], (ref[1:] != ref[:-1]) | (inside[1:] != inside[:-1] + 1)])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ref) - 1]])
    first = np.flatnonzero(new)
    return ref[first], start[ref[first]] + inside[first], start[ref[first]] + inside[last] + WINDOW


def _covered(sent: DataFrame, shares: int, parts: int) -> DataFrame:
    """doc, mark, spans: bytes of each text that repeat, as pairs of first byte and end.

    A share hands on one row for each of ``parts`` groups of texts, whose spans are then
    put together per text.
    """
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        strings: dict[tuple[int, bytes], int] = {}
        docs, marks, starts, which = [], [], [], []
        for _, keys, lengths, blob, doc, mark, start, ref in rows:
            ends = np.cumsum(np.frombuffer(lengths, "<u4"), dtype=np.int64)
            own = np.array([strings.setdefault((k, blob[e - n:e]), len(strings)) for k, n, e in zip(
                np.frombuffer(keys, "<u8").tolist(), np.frombuffer(lengths, "<u4").tolist(), ends.tolist())], np.int64)
            docs.append(_unplanes(doc, "<i8"))
            marks.append(_unplanes(mark, "<i8"))
            starts.append(_unplanes(start, "<u4").astype(np.int64))
            which.append(own[_unplanes(ref, "<u4")])
        if not strings:
            return
        doc, mark, start, which = (np.concatenate(x) for x in (docs, marks, starts, which))
        texts = list(strings)
        owner = np.full(len(texts), LAST_ID, np.int64)
        np.minimum.at(owner, which, doc)
        counts = np.array([len(x) - WINDOW + 1 for _, x in texts])
        place = np.concatenate([[0], np.cumsum(counts)[:-1]])
        least = np.repeat(owner, counts)
        batch, size, group = [], 0, 0
        by_key = sorted(range(len(texts)), key=lambda i: texts[i][0])
        for at, i in enumerate(by_key):
            batch.append(i)
            size += len(texts[i][1])
            ends = at + 1 == len(by_key) or texts[by_key[at + 1]][0] != texts[i][0]
            if ends and len(batch) - group == 1:  # the only string of its key has no other to be compared with
                batch.pop()
                size -= len(texts[i][1])
            if ends:
                group = len(batch)
            if batch and ends and (size >= SORTED_BYTES or at + 1 == len(by_key)):
                for k, found in zip(batch, least_owner([texts[k][1] for k in batch], owner[batch])):
                    least[place[k]:place[k] + counts[k]] = found
                batch, size, group = [], 0, 0
        found = [_spans(least, counts, doc[r:r + REFERENCES], start[r:r + REFERENCES], which[r:r + REFERENCES], place)
                 for r in range(0, len(doc), REFERENCES)]
        ref = np.concatenate([r * REFERENCES + x[0] for r, x in enumerate(found)])
        first, stop = (np.concatenate([x[k] for x in found]) for k in (1, 2))
        if not len(ref):
            return
        order = np.lexsort((first, mark[ref], doc[ref]))
        d, m, pairs = doc[ref][order], mark[ref][order], np.stack([first, stop], 1)[order].astype("<u4")
        part = _part_of(d, m, parts)
        order = np.argsort(part, kind="stable")
        d, m, pairs, part = d[order], m[order], pairs[order], part[order]
        used, turns = np.unique(part, return_index=True)
        for p, a, b in zip(used.tolist(), turns.tolist(), np.append(turns[1:], len(d)).tolist()):
            yield p, _planes(d[a:b].astype("<i8")), _planes(m[a:b].astype("<i8")), pairs[a:b].tobytes()

    def by_text(rows: Iterator[tuple]) -> Iterator[tuple]:
        found: dict[tuple[int, int], list[bytes]] = {}
        for _, doc, mark, pairs in rows:
            d, m = _unplanes(doc, "<i8"), _unplanes(mark, "<i8")
            turns = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (m[1:] != m[:-1])]))
            for a, b in zip(turns.tolist(), np.append(turns[1:], len(d)).tolist()):
                found.setdefault((int(d[a]), int(m[a])), []).append(pairs[8 * a:8 * b])
        for (d, m), spans in found.items():
            yield d, m, merged(spans).astype("<u4").tobytes()

    dealt = sent.repartition(shares, "share")
    found = map_rows(dealt, ["share", "keys", "lengths", "strings", "doc", "mark", "start", "which"],
                     "part bigint, docs binary, marks binary, pairs binary", run)
    return map_rows(found.repartition(parts, "part"), ["part", "docs", "marks", "pairs"], "doc bigint, mark bigint, spans binary", by_text)


def merged(spans: list[bytes]) -> np.ndarray:
    """Disjoint spans (first byte, end) with the same bytes, in order; touching ones become one."""
    pairs = np.frombuffer(b"".join(spans), "<u4").reshape(-1, 2).astype(np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(pairs) - 1]])
    return np.stack([pairs[new, 0], reach[last]], 1)


def pairs_of(spans: bytes) -> np.ndarray:
    return np.frombuffer(spans, "<u4").reshape(-1, 2).astype(np.int64)


def without(data: bytes, spans: np.ndarray) -> bytes:
    """What is left of the bytes."""
    ends = [0, *spans[:, 1].tolist()]
    return b"".join(data[a:b] for a, b in zip(ends, [*spans[:, 0].tolist(), len(data)]))


def inside_characters(data: bytes, spans: np.ndarray) -> np.ndarray:
    """Spans without the characters that they cover in part."""
    out = []
    for a, b in spans.tolist():
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


# --- operator -------------------------------------------------------------------------------------------------------

def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two written tables: all texts in short, and those with something to remove.

    The first has doc (the id; null counts as larger than any other), mark (hash of
    the text), n_bytes, sha (hex digest of the text) and copy: whether a smaller id
    has the same text. The second has doc, mark, text and spans of the others that
    share bytes with a smaller id. Rows that repeat an id are not smaller than each
    other; rows alike in id and text appear once in the second table.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    doc = F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(LAST_ID)).alias("doc")
    mark = F.xxhash64(body).alias("mark")
    short = docs.select(doc, mark, F.octet_length(body).cast("bigint").alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("sha"))
    short = stage(short)
    firsts = short.groupBy("sha", "n_bytes").agg(F.min("doc").alias("least"))
    short = short.join(firsts.hint("merge"), ["sha", "n_bytes"]).withColumn("copy", F.col("doc") > F.col("least")).drop("least")
    short = stage(short)
    total = short.agg(F.sum("n_bytes")).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares, parts = max(1, -(-total // SHARE_BYTES), least), max(1, -(-total // PART_BYTES), least)
    rows = docs.select(doc, mark, body.alias("text"))
    keys = _repeated_keys(_send_keys(rows, shares), shares, parts)
    asked = keys.join(short.where("not copy").select("doc", "mark").distinct(), ["doc", "mark"], "left_semi")
    asked = stage(asked)
    texts = rows.join(asked.hint("merge"), ["doc", "mark"])
    texts = stage(texts)
    spans = stage(_covered(_send_stretches(texts, shares), shares, parts))
    return short, texts.select("doc", "mark", "text").join(spans.hint("merge"), ["doc", "mark"])


def _outcome(short: DataFrame, cut: DataFrame) -> DataFrame:
    """doc, mark, n_bytes, copy, sha, and of texts that lose bytes n_removed, n_spans, kept_sha256."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, mark, text, spans in rows:
            data, found = utf8(text), pairs_of(spans)
            yield doc, mark, int((found[:, 1] - found[:, 0]).sum()), len(found), hashlib.sha256(without(data, found)).hexdigest()

    lost = map_rows(cut, ["doc", "mark", "text", "spans"],
                    "doc bigint, mark bigint, n_removed bigint, n_spans bigint, kept_sha256 string", run)
    return short.join(lost.dropDuplicates(["doc", "mark"]).hint("merge"), ["doc", "mark"], "left")


def whole(copy: Column, n_bytes: Column) -> Column:
    """Whether a text goes whole: it repeats a smaller id's and has a window."""
    return copy & (n_bytes >= WINDOW)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row. Null text is empty and loses nothing."""
    out = _outcome(*repeated_spans(docs, doc_id, text))
    gone, none = whole(F.col("copy"), F.col("n_bytes")), F.lit(0).cast("bigint")
    return out.select(
        F.when(F.col("doc") != LAST_ID, F.col("doc")).alias("doc_id"), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("bigint")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def cut_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with their texts cut; rows that lose all of their text go.

    A character that is covered in part stays. ``n_chars``, if there is such a
    column, counts the code points left of texts that were cut; all else is kept, and
    so are rows whose text was empty or null before.
    """
    short, cut = repeated_spans(docs, doc_id, text)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, mark, value, spans in rows:
            data = utf8(value)
            left = without(data, inside_characters(data, pairs_of(spans))).decode()
            yield doc, mark, left

    lost = map_rows(cut, ["doc", "mark", "text", "spans"], "_doc bigint, _mark bigint, _left string", run, 256)
    gone = short.where(whole(F.col("copy"), F.col("n_bytes"))).select(
        F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), F.lit("").alias("_left"))
    # Written by itself, so that the texts' shuffle is gone before whole rows move.
    changed = stage(lost.unionByName(gone).dropDuplicates(["_doc", "_mark"]))
    value = F.col(f"`{text}`")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(LAST_ID)).alias("_doc"),
                        F.xxhash64(F.coalesce(value, F.lit(""))).alias("_mark"))
    rows = keyed.join(changed.hint("merge"), ["_doc", "_mark"], "left").where("_left is null or _left <> ''")
    new = {text: F.coalesce("_left", F.col(f"_row.`{text}`"))}
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        new[n_chars] = F.when(F.col("_left").isNull(), F.col(f"_row.`{n_chars}`")).otherwise(F.length("_left")).cast(kind)
    return rows.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
