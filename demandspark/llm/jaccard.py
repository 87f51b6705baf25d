"""Self-join of texts on the Jaccard similarity of their word n-grams.

Texts with the same set of n-grams form a class, of which one stands for all.
Between classes:

* *Candidates.* In one order of all n-grams, rare ones first, two sets alike
  enough share an n-gram of their prefixes. Classes that share one form a bucket;
  buckets with the same classes are one. A parity bitmap of each set bounds the
  size of a pair's symmetric difference from below and leaves the pairs that may be
  linked; of these, a bucket hands on a spanning forest only. Bitmaps folded to a few
  bytes go first, so that only classes with a possible partner bring whole ones.
* *Vertical partitioning.* The n-gram order (hashes) is cut into fragments. The
  overlap of a pair is counted in each fragment by itself and summed per pair.
* A bucket whose forest holds a pair that is not linked is looked at again without
  that pair, until its forest consists of links only. Components of the links of
  all buckets are thus those of all links, though never all pairs are made.

The order comes from a sketch of n-gram counts over all texts. It decides how large
buckets are, never what the result is.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.bytesets import Powers, set_digest, shingles
from demandspark.llm.common import ROW, ROW_TYPES, identified, map_rows, table, utf8
from demandspark.llm.common import stage_tidily as stage
from demandspark.llm.components import connected

WIDTH = 4
PERCENT = 85
FRAGMENTS = 4
# Bits of the count sketch, parts it travels in, and partial sketches added by one task.
SKETCH_BITS = 18
SKETCH_PARTS = 16
SKETCH_FAN_IN = 256
# Bitmap bits for each n-gram, and classes and n-grams of a block when a bucket is compared in blocks. A bitmap
# has at most a byte for each n-gram, so the n-grams bound the bytes of the bitmaps that a row holds.
BITS_EACH = 4
BLOCK = 1024
BLOCK_GRAMS = 1 << 24
# Least bytes of a folded bitmap, and parts that a larger one is folded from. A bit for every one or two n-grams is
# enough for two unlike sets to differ in more bits than links allow.
FOLDED = 32
FOLDS = 8


def prefix_length(n: int, percent: int) -> int:
    """N-grams of a set of ``n`` of which a partner must have one."""
    return n + (-percent * n // 100) + 1


def linked(size_sum, difference, percent: int):
    """Whether sets whose sizes add up to ``size_sum`` and that differ in so many members are alike enough."""
    return (100 - percent) * size_sum >= (100 + percent) * difference


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _first() -> Column:
    """First row of a group: the smallest id (null last), then the smallest hash."""
    return F.min(F.struct((~F.col("has")).alias("none"), "doc", "mark"))


def digest_sets(rows: DataFrame, width: int) -> DataFrame:
    """``ROW``, n and digest of every row's set; each task adds one row with its count sketch."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        tables, counts = Powers(), np.zeros(1 << SKETCH_BITS, np.uint32)
        for doc, has, mark, value in rows:
            found = shingles(utf8(value), width, tables)
            np.add.at(counts, _cells(found), 1)
            yield doc, has, mark, len(found), set_digest(found), None, None, None
        task = TaskContext.get().partitionId()
        for k, part in enumerate(np.split(counts, SKETCH_PARTS)):
            yield None, None, None, None, None, k, task, part.tobytes()

    return map_rows(rows, [*ROW, "text"],
                    f"{ROW_TYPES}, n int, digest binary, part int, task int, counts binary", run)


def add_sketches(partial: DataFrame) -> np.ndarray:
    """Sum of the tasks' sketches, a limited number at a time; only the sum reaches the driver."""
    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(c, "<u8" if len(c) == (8 << SKETCH_BITS) // SKETCH_PARTS else "<u4").astype(np.uint64)
                        for c in group["counts"].to_pylist()], axis=0, dtype=np.uint64)
        return pa.table({"part": [group["part"][0].as_py()], "task": [group["task"][0].as_py() // SKETCH_FAN_IN],
                         "counts": [total.tobytes()]}, schema=pa.schema([("part", pa.int32()), ("task", pa.int32()), ("counts", pa.binary())]))

    tasks = partial.agg(F.max("task")).first()[0]
    rows, left = partial, 1 if tasks is None else tasks + 1
    while left:
        rows = rows.groupBy("part", F.expr(f"task div {SKETCH_FAN_IN}").alias("_to")).applyInArrow(add, "part int, task int, counts binary")
        left = 0 if left <= SKETCH_FAN_IN else -(-left // SKETCH_FAN_IN)
    parts = {r["part"]: np.frombuffer(bytes(r["counts"]), np.uint64) for r in rows.collect()}
    empty = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.uint64)
    return np.concatenate([parts.get(k, empty) for k in range(SKETCH_PARTS)])


def _bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the set's members over a power of two of bits; half of it is the xor of its halves."""
    bits = max(64, 1 << (BITS_EACH * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(bitmap: bytes) -> bytes:
    """Xor of the parts of a bitmap: the parity over fewer bits, in which two sets differ no more."""
    size = max(min(FOLDED, len(bitmap)), len(bitmap) // FOLDS)
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, np.uint8).reshape(-1, size)).tobytes()


def prefixes(rows: DataFrame, width: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """``ROW``, n, digest, prefix n-grams (rare first), bitmap and folded bitmap of every row with a set."""
    rank = np.argsort(np.argsort(sketch, kind="stable"), kind="stable").astype(np.int32)
    sent = rows.sparkSession.sparkContext.broadcast(rank)  # of fixed size

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        tables, ranks = Powers(), sent.value
        for doc, has, mark, value in rows:
            found = shingles(utf8(value), width, tables)
            if len(found):
                take = prefix_length(len(found), percent)
                order = np.lexsort((found, ranks[_cells(found)]))[:take]
                bitmap = _bitmap(found)
                yield doc, has, mark, len(found), set_digest(found), found[order].view(np.int64), bitmap, _folded(bitmap)

    return map_rows(rows, [*ROW, "text"],
                    f"{ROW_TYPES}, n int, digest binary, prefix array<bigint>, bitmap binary, folded binary", run, 256)


class Sets:
    """Union-find over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _halved(m: np.ndarray) -> np.ndarray:
    return m[:, :m.shape[1] // 2] ^ m[:, m.shape[1] // 2:]


def possible_pairs(sizes: np.ndarray, bitmaps: list[bytes], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (i, j, bound on their difference) that the bitmaps do not rule out, row by row of equal bitmap sizes."""
    lengths = np.array([len(b) for b in bitmaps])
    for size in np.unique(lengths):
        own = np.flatnonzero(lengths == size)
        wider = np.flatnonzero(lengths == 2 * size)
        rows = np.frombuffer(b"".join(bitmaps[i] for i in own), "<u8").reshape(len(own), -1)
        if len(wider):
            more = np.frombuffer(b"".join(bitmaps[i] for i in wider), "<u8").reshape(len(wider), -1)
            rows = np.concatenate([rows, _halved(more)])
        who = np.concatenate([own, wider])
        for k in range(len(own)):
            bound = np.bitwise_count(rows[k + 1:] ^ rows[k]).sum(axis=1, dtype=np.int64)
            bound = np.maximum(bound, np.abs(sizes[who[k + 1:]] - sizes[own[k]]))
            ok = np.flatnonzero(linked(sizes[who[k + 1:]] + sizes[own[k]], bound, percent))
            if len(ok):
                yield np.full(len(ok), own[k]), who[k + 1 + ok], bound[ok]


def forests(ids: list[int], sizes: np.ndarray, bitmaps: list[bytes], links: list[tuple[int, int]],
            refuted: list[tuple[int, int]], many: int, percent: int) -> list[tuple[int, int]]:
    """Edges of up to ``many`` edge-disjoint spanning forests of the possible pairs between known components.

    ``links`` are known links and ``refuted`` pairs known not to be links. Likelier
    pairs come first. An empty answer means that the components of the known links are final.
    """
    found = list(possible_pairs(sizes, bitmaps, percent))
    if not found:
        return []
    i, j, bound = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(bound / (sizes[i] + sizes[j]), kind="stable")
    place = {d: k for k, d in enumerate(ids)}
    base = Sets(len(ids))
    for a, b in links:
        base.join(place[a], place[b])
    no = {(place[a], place[b]) for a, b in refuted} | {(place[b], place[a]) for a, b in refuted}
    layers, out = [], []
    for a, b in zip(i[order].tolist(), j[order].tolist()):
        a0, b0 = base.find(a), base.find(b)
        if a0 == b0 or (a, b) in no:
            continue
        for layer in layers:
            if layer.join(a0, b0):
                break
        else:
            if len(layers) >= many:
                continue
            layers.append(Sets(len(ids)))
            layers[-1].join(a0, b0)
        out.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
    return out


def _blocks(reps: DataFrame, percent: int) -> DataFrame:
    """Buckets cut into blocks of bounded size: bucket, i, j, nodes, same.

    A bucket holds the classes that share a prefix n-gram and are close enough in
    size: two sets that may be linked are in the same band of sizes or in adjacent
    ones, so each goes to its own band and the next. Buckets with the same classes
    are kept once, blocks that come down to the same classes too. Every pair that may be
    linked is together in a row.
    """
    rows = reps.select("node", "n", F.explode("prefix").alias("gram"))
    shared = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("gram")
    members = stage(rows.join(shared.hint("merge"), "gram"))
    # Bands a little wider than the ratio of sizes, so that rounding of logarithms never parts a pair.
    band = F.floor(F.log("n") / float(-np.log(percent / 100 - 1e-6))).cast("int")
    members = members.select("node", "n", "gram", F.explode(F.array(band, band + 1)).alias("band"))
    buckets = members.groupBy("gram", "band").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams"), F.bit_xor(F.xxhash64("node")).alias("s"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("t")).where("m > 1")
    buckets = buckets.groupBy("m", "grams", "s", "t").agg(F.min(F.struct("gram", "band")).alias("one"))
    cuts = F.greatest(F.ceil(F.col("m") / BLOCK), F.least("m", F.ceil(F.col("grams") / BLOCK_GRAMS))).cast("int").alias("nb")
    buckets = stage(buckets.select("one.gram", "one.band", cuts, F.monotonically_increasing_id().alias("bucket")))
    members = members.drop("n").join(buckets.hint("merge"), ["gram", "band"]).select("node", "bucket", "nb")
    members = members.join(reps.select("node", "n", "folded").hint("merge"), "node")
    own = F.pmod(F.xxhash64("node", F.lit(2)), F.col("nb")).cast("int")
    members = members.withColumn("b", own).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    thin = members.groupBy("bucket", F.least("b", "c").alias("i"), F.greatest("b", "c").alias("j")).agg(
        F.collect_list(F.struct("node", "n", "folded")).alias("members")).where(F.size("members") > 1)
    return stage(_partnered(thin, percent).dropDuplicates(["same"]))


def _partnered(blocks: DataFrame, percent: int) -> DataFrame:
    """bucket, i, j, nodes, same: members of each block that may be linked to another one, and their digest."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for bucket, i, j, members in rows:
            members = list({m["node"]: m for m in members}.values())
            some = np.zeros(len(members), bool)
            for a, b, _ in possible_pairs(np.array([m["n"] for m in members], np.int64), [m["folded"] for m in members], percent):
                some[a] = some[b] = True
            if some.any():
                nodes = np.sort(np.array([m["node"] for m in members], "<i8")[some])
                yield bucket, i, j, nodes, hashlib.sha256(nodes.tobytes()).digest()

    return map_rows(blocks, ["bucket", "i", "j", "members"],
                    "bucket bigint, i int, j int, nodes array<bigint>, same binary", run, 256)


def _candidates(blocks: DataFrame, reps: DataFrame, many: int, percent: int, known: DataFrame | None = None) -> DataFrame:
    """bucket, i, j, a, b: forest pairs of each block, given what is known of its earlier pairs.

    Only the classes of the blocks looked at bring their bitmaps.
    """
    if known is not None:
        blocks = blocks.join(known.hint("merge").select("bucket", "i", "j"), ["bucket", "i", "j"], "left_semi")
    blocks = blocks.select("bucket", "i", "j", F.explode("nodes").alias("node")).join(
        reps.select("node", "n", "bitmap").hint("merge"), "node").groupBy("bucket", "i", "j").agg(
        F.collect_list(F.struct("node", "n", "bitmap")).alias("members"))
    if known is not None:
        blocks = blocks.join(known.hint("merge"), ["bucket", "i", "j"])
    else:
        kind = "cast(array() as array<struct<a:bigint,b:bigint>>)"
        blocks = blocks.withColumn("yes", F.expr(kind)).withColumn("no", F.expr(kind))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for bucket, i, j, members, yes, no in rows:
            members = list({m["node"]: m for m in members}.values())
            for a, b in forests([m["node"] for m in members], np.array([m["n"] for m in members], np.int64),
                                [m["bitmap"] for m in members], [(p["a"], p["b"]) for p in yes],
                                [(p["a"], p["b"]) for p in no], many, percent):
                yield bucket, i, j, a, b

    return map_rows(blocks, ["bucket", "i", "j", "members", "yes", "no"],
                    "bucket bigint, i int, j int, a bigint, b bigint", run)


def fragments(rows: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """node, n, fragment, hashes of the sets of ``reps`` (node, ``ROW``, digest, n), cut by hash range.

    Texts travel to their classes compressed one by one, in two thirds of the space.
    """
    def pack(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, has, mark, value in rows:
            yield doc, has, mark, zlib.compress(utf8(value), 1)

    texts = map_rows(rows, [*ROW, "text"], f"{ROW_TYPES}, packed binary", pack, 256).join(reps.hint("merge"), ROW)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        tables = Powers()
        edges = np.array([(k << 64) // FRAGMENTS for k in range(1, FRAGMENTS)], np.uint64)
        for node, packed, digest, n in rows:
            found = shingles(zlib.decompress(packed), width, tables)
            if set_digest(found) == digest:
                for k, part in enumerate(np.split(found, np.searchsorted(found, edges))):
                    yield node, n, k, part.view(np.int64)

    found = map_rows(texts, ["node", "packed", "digest", "n"], "node bigint, n int, fragment int, hashes array<bigint>", run, 256)
    return stage(found.dropDuplicates(["node", "fragment"]))


def overlaps(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """a, b, ok: partial overlaps per fragment, summed per pair, and whether the pair is linked."""
    one = parts.select(F.col("node").alias("a"), F.col("n").alias("na"), "fragment", F.col("hashes").alias("ha"))
    two = parts.select(F.col("node").alias("b"), F.col("n").alias("nb"), "fragment", F.col("hashes").alias("hb"))
    partial = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), ["b", "fragment"]).select(
        "a", "b", (F.col("na") + F.col("nb")).alias("both"), F.size(F.array_intersect("ha", "hb")).cast("bigint").alias("c"))
    total = partial.groupBy("a", "b").agg(F.max("both").alias("both"), F.sum("c").alias("c"))
    return total.select("a", "b", linked(F.col("both"), F.col("both") - 2 * F.col("c"), percent).alias("ok"))


def links(rows: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b: links between classes that have the components of all links.

    Joins of what grows with the corpus are merge joins at every size.
    """
    blocks = _blocks(reps, percent)
    asked = stage(_candidates(blocks, reps, 1, percent))
    nodes = asked.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    parts = fragments(rows, reps.select("node", *ROW, "digest", "n").join(nodes.hint("merge"), "node", "left_semi"), width)
    known = stage(overlaps(asked.select("a", "b").distinct(), parts, percent))
    told, many = stage(asked.join(known.hint("merge"), ["a", "b"])), 1
    history = [told]
    while not (wrong := history[-1].where("not ok").select("bucket", "i", "j").distinct()).isEmpty():
        many = min(8 * many, 4096)
        sofar = history[0]
        for h in history[1:]:
            sofar = sofar.unionByName(h)
        pair = F.struct("a", "b")
        sofar = sofar.join(wrong.hint("merge"), ["bucket", "i", "j"], "left_semi").groupBy("bucket", "i", "j").agg(
            F.collect_list(F.when(F.col("ok"), pair)).alias("yes"), F.collect_list(F.when(~F.col("ok"), pair)).alias("no"))
        asked = stage(_candidates(blocks, reps, many, percent, stage(sofar)))
        fresh = asked.select("a", "b").distinct().join(known.hint("merge"), ["a", "b"], "left_anti")
        known = stage(known.unionByName(overlaps(fresh, parts, percent)))
        history.append(stage(asked.join(known.hint("merge"), ["a", "b"])))
    return known.where("ok").select("a", "b")


def similar_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                 percent: int = PERCENT) -> DataFrame:
    """doc_id, ``ROW``, n_shingles, node and component_id of every row.

    Rows with equal sets are a
    class, whatever their ids; node numbers the component of a row's class (null without
    words), and component_id is the smallest doc_id in it (null if all are).
    """
    rows = identified(docs, doc_id, text)
    sets = stage(digest_sets(rows, width))
    sketch = add_sketches(sets.where("part is not null").select("part", "task", "counts"))
    short = sets.where("part is null").select(*ROW, "n", "digest")
    classes = stage(short.where("n > 0").groupBy("digest").agg(_first().alias("first")).select(
        F.monotonically_increasing_id().alias("node"), "digest", "first.doc", (~F.col("first.none")).alias("has"), "first.mark"))
    chosen = prefixes(rows, width, percent, sketch).join(classes.hint("merge"), [*ROW, "digest"])
    # Rows alike in id and text are in one partition of the join already.
    reps = stage(chosen.dropDuplicates([*ROW, "digest"]))
    roots = connected(links(rows, reps, width, percent))
    named = classes.join(roots.hint("merge").withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "digest", F.coalesce("root", "node").alias("node"), F.when(F.col("has"), F.col("doc")).alias("least"))
    least = named.groupBy("node").agg(F.min("least").alias("component_id"))
    named = stage(named.drop("least").join(least.hint("merge"), "node"))
    own = F.when(F.col("has"), F.col("doc"))
    return short.join(named.hint("merge"), "digest", "left").select(
        own.alias("doc_id"), *ROW, F.col("n").cast("bigint").alias("n_shingles"), "node",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(own).alias("component_id"))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                       percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two texts are linked when 100 * |intersection| >= ``percent`` * |union| of their
    sets of distinct ``width``-word shingles. component_id is the smallest doc_id
    reachable. A text without words (or null) has no shingle and no link, and its own
    doc_id. Rows that repeat a doc_id are rows of their own; those with a null doc_id
    are linked like others, and component_id is null if all ids of a component are.
    """
    return similar_rows(docs, doc_id, text, width, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those similar to an earlier one: of each component its first stays.

    The first has the smallest doc_id (null last), then the smallest hash of its text; rows
    alike in both stay together. Texts without words stay.
    """
    found = stage(similar_rows(docs, doc_id, text, width, percent).where("node is not null").select(*ROW, "node"))
    first = found.groupBy("node").agg(_first().alias("first"))
    gone = found.join(first.hint("merge"), "node").where(
        "doc <> first.doc or has = first.none or mark <> first.mark").select(*ROW).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return identified(docs, doc_id, text, whole).join(gone.hint("merge"), ROW, "left_anti").select("_row.*")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
