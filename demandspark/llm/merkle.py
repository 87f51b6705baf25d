"""Merkle manifest of a table: a digest tree per group, and one over the groups' roots.

The place of a leaf in its group is its rank among the group's ids. No row is sorted for
it: the ids of a group form a bitmap of 64-bit words, kept only where a bit is set, 64
words to a chunk with a summary word and a directory of counts before each word. A rank
is the count before the chunk, the directory's entry and the bits below in one word.

Places key the slots of arrays: 729 consecutive leaves are one array, which a task reduces
by six levels; the results are the slots of the next arrays. On the way back an array gets
the siblings above it and hands its leaves theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.common import map_rows, stage, table

ARITY = 3
LEVELS = 6  # reduced inside one array
BLOCK = ARITY**LEVELS
WORD_BITS, CHUNK_BITS = 6, 12  # 64 ids to a word, 64 words to a chunk
DIRECTORY_BITS = 12  # chunks to one entry of the directory above, and so on upwards
TIE_DIGITS = 4
RUN = 1024
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- digests ---

def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]).cast("binary"), 256)


def reduce_runs(nodes: list[str], levels: int | None) -> tuple[str, list[list[list[str]]]]:
    """The node that remains, and for each level the runs it was made of.

    ``levels`` says how many levels there are (also a lone node goes up); None stops at one node.
    """
    made = []
    while len(nodes) > 1 if levels is None else len(made) < levels:
        runs = [nodes[i:i + ARITY] for i in range(0, len(nodes), ARITY)]
        made.append(runs)
        nodes = [digest(r) for r in runs]
    return nodes[0], made


def steps_above(made: list[list[list[str]]], slot: int) -> str:
    """Siblings of a node level by level: per level the place in the run, the number of siblings, and these."""
    out = []
    for runs in made:
        run, at = runs[slot // ARITY], slot % ARITY
        out.append(f"{at}{len(run) - 1}" + "".join(run[:at] + run[at + 1:]))
        slot //= ARITY
    return "".join(out)


def fold(node: str, steps: str) -> str:
    """The root that a node and the siblings above it give."""
    i = 0
    while i < len(steps):
        at, n = int(steps[i]), int(steps[i + 1])
        others = [steps[i + 2 + 64 * j:i + 66 + 64 * j] for j in range(n)]
        node = digest([*others[:at], node, *others[at:]])
        i += 2 + 64 * n
    return node


def proof(steps: str) -> str:
    """The digest of all siblings in order."""
    parts, i = [], 0
    while i < len(steps):
        n = int(steps[i + 1])
        parts.append(steps[i + 2:i + 2 + 64 * n])
        i += 2 + 64 * n
    return digest(parts)


# --- ranks ---

def _same(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Merge join where null equals null; the columns ``on`` are those of ``a``."""
    right = b.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in b.columns]).hint("merge")
    same = None
    for c in on:
        equal = a[c].eqNullSafe(right[f"_r_{c}"])
        same = equal if same is None else same & equal
    return a.join(right, same, how).drop(*[f"_r_{c}" for c in on])


def id_chunks(ids: DataFrame) -> DataFrame:
    """Chunks of the bitmap of each group: ``summary`` (which words there are), ``words`` and ``before``.

    ``ids`` has _group, _id and _n (rows of that id). ``words`` holds in order of place the
    mask of a word and, for ids of several rows, how many more they have than one;
    ``before`` the rows in front of each word. A chunk of null ids has no words.
    """
    bit = F.expr(f"cast(_id & {(1 << WORD_BITS) - 1} as int)")
    more = F.when(F.col("_n") > 1, F.struct(bit.alias("bit"), (F.col("_n") - 1).alias("more")))
    words = ids.groupBy("_group", F.expr(f"shiftright(_id, {WORD_BITS})").alias("_word")).agg(
        F.bit_or(_one_bit(bit)).alias("mask"), F.sum("_n").alias("rows"), F.collect_list(more).alias("extra"))
    words = words.withColumn("_chunk", F.expr(f"shiftright(_word, {CHUNK_BITS - WORD_BITS})"))
    word_at = F.expr(f"cast(_word & {(1 << (CHUNK_BITS - WORD_BITS)) - 1} as int)")
    packed = words.groupBy("_group", "_chunk").agg(
        F.bit_or(_one_bit(word_at)).alias("summary"), F.sum("rows").alias("_rows"),
        F.array_sort(F.collect_list(F.struct(word_at.alias("at"), "mask", "rows", "extra"))).alias("words"))  # 64 at most
    # rows in front of each word, and after the last
    running = F.expr("aggregate(words, array(0L), (acc, w) -> array_append(acc, element_at(acc, -1) + w.rows))")
    return packed.withColumn("before", running)


def _one_bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n)


def _lower_bits(n: Column) -> Column:
    """The ``n`` lowest bits set (n up to 63)."""
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), n))


def rank_in_chunk(id_: Column) -> Column:
    """Rows of smaller ids in the chunk whose ``summary``, ``words`` and ``before`` stand beside ``id_``."""
    word = F.shiftright(id_, WORD_BITS).bitwiseAND(F.lit((1 << (CHUNK_BITS - WORD_BITS)) - 1).cast("bigint")).cast("int")
    place = F.bit_count(F.col("summary").bitwiseAND(_lower_bits(word)))
    bit = id_.bitwiseAND(F.lit((1 << WORD_BITS) - 1).cast("bigint")).cast("int")
    entry = F.get(F.col("words"), place)
    below = F.bit_count(entry["mask"].bitwiseAND(_lower_bits(bit)))
    more = F.aggregate(F.filter(entry["extra"], lambda e: e["bit"] < bit), F.lit(0).cast("bigint"), lambda acc, e: acc + e["more"])
    return F.get(F.col("before"), place) + below + more


def chunk_bases(chunks: DataFrame) -> DataFrame:
    """Rows of the group in front of each chunk (_group, _chunk, _base), null ids first.

    Counts climb a directory of ``2**DIRECTORY_BITS`` children to a parent, and the rows in front of a
    parent come down again, so that no group of a window has more rows than that.
    """
    level = chunks.select("_group", F.col("_chunk").alias("_k0"), F.col("_rows").alias("_n"))
    low, high = level.agg(F.min("_k0"), F.max("_k0")).first()
    tall = 0
    while low is not None and (high >> (DIRECTORY_BITS * tall)) - (low >> (DIRECTORY_BITS * tall)) >= 1 << DIRECTORY_BITS:
        tall += 1
    levels = [level]
    for i in range(tall):
        parent = F.expr(f"shiftright(_k{i}, {DIRECTORY_BITS})").alias(f"_k{i + 1}")
        levels.append(levels[-1].groupBy("_group", parent).agg(F.sum("_n").alias("_n")))
    base = None
    for i in range(tall, -1, -1):
        here, over = levels[i], Window.partitionBy("_group").orderBy(F.col(f"_k{i}").asc_nulls_first())
        if i < tall:
            here = here.withColumn("_up", F.expr(f"shiftright(_k{i}, {DIRECTORY_BITS})"))
            over = Window.partitionBy("_group", "_up").orderBy(F.col(f"_k{i}").asc_nulls_first())
        here = here.withColumn("_base", F.sum("_n").over(over.rowsBetween(Window.unboundedPreceding, -1)))
        here = here.withColumn("_base", F.coalesce("_base", F.lit(0).cast("bigint")))
        if base is not None:
            above = base.select("_group", F.col(f"_k{i + 1}").alias("_up"), F.col("_base").alias("_above"))
            here = _same(here, above, ["_group", "_up"]).withColumn("_base", F.col("_base") + F.col("_above"))
        base = here.select("_group", f"_k{i}", "_base")
    return base.withColumnRenamed("_k0", "_chunk")


def tie_offsets(leaves: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows in front of a leaf among the rows of its id: (_group, _id, leaf, _tie) for ids of several leaves.

    Leaves of one id are in order of their digest. Counts by the digest's first digits come first, so
    that an id of very many rows is dealt over many windows.
    """
    head = F.substring("leaf", 1, TIE_DIGITS).alias("_head")
    rows = _same(leaves, ids.where("_leaves > 1").select("_group", "_id"), ["_group", "_id"])
    rows = rows.select("_group", "_id", "leaf", "_m", head)
    heads = rows.groupBy("_group", "_id", "_head").agg(F.sum("_m").alias("_n"))
    before = Window.unboundedPreceding, -1
    by_head = Window.partitionBy("_group", "_id").orderBy("_head").rowsBetween(*before)
    inside = Window.partitionBy("_group", "_id", "_head").orderBy("leaf").rowsBetween(*before)
    heads = heads.select("_group", "_id", "_head", F.coalesce(F.sum("_n").over(by_head), F.lit(0)).alias("_front"))
    rows = rows.withColumn("_in", F.coalesce(F.sum("_m").over(inside), F.lit(0)))
    return _same(rows, heads, ["_group", "_id", "_head"]).select("_group", "_id", "leaf", (F.col("_front") + F.col("_in")).alias("_tie"))


def place_leaves(leaves: DataFrame) -> DataFrame:
    """One row per leaf with its slot: (_group, _slot, _id, leaf, altered).

    ``leaves`` has _group, _id, leaf, altered. Nulls among the ids come first, rows of one id are in
    order of their leaf, and rows of equal leaves take consecutive slots in any order.
    """
    chunk = F.expr(f"shiftright(_id, {CHUNK_BITS})").alias("_chunk")
    leaves = stage(leaves.groupBy("_group", "_id", "leaf", "altered").agg(F.count(F.lit(1)).alias("_m")))
    ids = stage(leaves.groupBy("_group", "_id").agg(F.sum("_m").alias("_n"), F.count(F.lit(1)).alias("_leaves")))
    chunks = stage(id_chunks(ids))
    chunks = _same(chunks, chunk_bases(chunks), ["_group", "_chunk"])
    placed = _same(leaves.select("*", chunk), chunks.select("_group", "_chunk", "summary", "words", "before", "_base"), ["_group", "_chunk"])
    inside = F.when(F.col("_id").isNull(), F.lit(0)).otherwise(rank_in_chunk(F.col("_id")))
    placed = placed.select("_group", "_id", "leaf", "altered", "_m", (F.col("_base") + inside).cast("bigint").alias("_slot"))
    if not ids.where("_leaves > 1").isEmpty():
        placed = _same(placed, tie_offsets(leaves, ids), ["_group", "_id", "leaf"], "left")
        placed = placed.withColumn("_slot", F.col("_slot") + F.coalesce("_tie", F.lit(0))).drop("_tie")
    single = placed.where("_m = 1").drop("_m")
    many = placed.where("_m > 1")
    if not ids.where("_n > _leaves").isEmpty():  # rows alike in all fields, run by run
        many = many.withColumn("_run", F.explode(F.expr(f"sequence(0L, (_m - 1) div {RUN})")))
        many = many.repartition("_group", "_id", "leaf", "_run")
        many = many.withColumn("_at", F.explode(F.expr(f"sequence(_run * {RUN}, least((_run + 1) * {RUN}, _m) - 1)")))
        single = single.unionByName(many.select("_group", "_id", "leaf", "altered", (F.col("_slot") + F.col("_at")).alias("_slot")))
    return single.select("_group", "_slot", "_id", "leaf", "altered")


def place_groups(groups: DataFrame) -> DataFrame:
    """Adds ``_slot``, the place of each group in the order of its name, null first."""
    ordered = stage(groups.orderBy(F.col("_group").asc_nulls_first()).withColumn("_mark", F.monotonically_increasing_id()))
    part = F.shiftright("_mark", 33).alias("_part")
    parts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    over = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task that wrote
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_front"))
    slot = (F.col("_front") + F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1).cast("bigint"))).cast("bigint").alias("_slot")
    return ordered.select("*", part).join(F.broadcast(parts), "_part").select(*groups.columns, slot)


# --- the tree ---

def slot_arrays(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """Nodes of a group as arrays of up to ``BLOCK`` slots: (_group, _block, slots)."""
    slot = F.expr(f"cast(_slot % {BLOCK} as int)").alias("_at")
    return nodes.groupBy("_group", F.expr(f"_slot div {BLOCK}").alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct(slot, *columns))).alias("slots"))


def _tops(rows: Iterator[tuple]) -> Iterator[tuple]:
    for group, block, nodes, alone in rows:
        if alone is not None and block == 0 and len(nodes) == 1:  # the group ended below
            yield group, block, nodes[0], alone[0]
        else:
            yield group, block, reduce_runs(nodes, LEVELS)[0], reduce_runs(nodes, None)[0]


def reduce_groups(nodes: DataFrame, columns: list[str], kind: str) -> tuple[DataFrame, list[DataFrame]]:
    """The root of each group (_group, root), and the slot arrays of every level, lowest first.

    A node that goes up has two digests: ``full``, reduced by all levels of its array, and
    ``alone``, reduced until one node is left, which counts if the group has no other array.
    """
    schema = f"_group {kind}, _slot bigint, full string, alone string"
    arrays, alone = slot_arrays(nodes, columns), F.lit(None).cast("array<string>")
    digest_ = "leaf" if "leaf" in columns else "full"
    levels = []
    while True:
        arrays = stage(arrays)
        levels.append(arrays)
        tops = map_rows(arrays.select("_group", "_block", F.col("slots")[digest_].alias("nodes"), alone.alias("alone")),
                        ["_group", "_block", "nodes", "alone"], schema, _tops, 512)
        if arrays.where("_block > 0").isEmpty():
            return tops.select("_group", F.col("alone").alias("root")), levels
        arrays, digest_, alone = slot_arrays(tops, ["full", "alone"]), "full", F.col("slots")["alone"]


def siblings_below(levels: list[DataFrame], paths: DataFrame, kind: str, extra: str) -> DataFrame:
    """The lowest arrays with what is above each: (_group, _block, slots, ``extra`` columns, steps, single).

    ``paths`` has for each group the steps above its root. ``single`` says that the array is all of its group.
    """
    names = [c.split()[0] for c in extra.split(", ")]
    schema = f"_group {kind}, _block bigint, {extra}, steps string, single boolean"

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for group, block, nodes, single, steps, *more in rows:
            if single and len(nodes) == 1:
                yield group, 0, *more, steps, True
                continue
            made = reduce_runs(nodes, None if single else LEVELS)[1]
            for slot in range(len(nodes)):
                yield group, block * BLOCK + slot, *more, steps_above(made, slot) + steps, False

    paths = paths.select("_group", F.lit(0).cast("bigint").alias("_block"), *names, "steps", F.lit(True).alias("single"))
    for arrays in reversed(levels[1:]):
        rows = _same(arrays.select("_group", "_block", F.col("slots")["full"].alias("nodes")), paths, ["_group", "_block"])
        paths = map_rows(rows, ["_group", "_block", "nodes", "single", "steps", *names], schema, run, 2048)
    return _same(levels[0], paths, ["_group", "_block"])


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_: str = "doc_id", group: str = "source",
             text: str = "text") -> DataFrame:
    """Leaf, roots, proof and a check against tampering for each row.

    Returns (id, group, leaf, subroot, root, proof_sha256, folded_root, verified). Ids are
    whole numbers. In a group null ids come first and rows of one id are in order of their
    leaf; a null group is one of its own, the first. Where the crc32 of the id in decimal is
    even, the folded leaf is that of the text without line feeds; a null id or text is never
    altered. Rows alike in all fields are leaves of their own. No rows give no rows.
    """
    values = [F.col(f"`{c}`") for c in fields]
    body, id_col = F.col(f"`{text}`"), F.col(f"`{id_}`")
    changed = [F.replace(body, F.lit("\n"), F.lit("")) if c == text else v for c, v in zip(fields, values)]
    even = F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 2 == 0, F.lit(False)) & F.coalesce(F.contains(body, F.lit("\n")), F.lit(False))
    leaf = leaf_digest(values)
    kind, id_kind = docs.schema[group].dataType.simpleString(), docs.schema[id_].dataType.simpleString()
    leaves = docs.select(F.col(f"`{group}`").alias("_group"), id_col.cast("bigint").alias("_id"), leaf.alias("leaf"),
                         F.when(even, leaf_digest(changed)).alias("altered"))
    placed = place_leaves(leaves)
    subroots, levels = reduce_groups(placed, ["_id", "leaf", "altered"], kind)
    subroots = stage(subroots)
    ranked = place_groups(subroots)
    nodes = ranked.select(F.lit(0).alias("_group"), "_slot", F.col("_group").alias("name"), F.col("root").alias("leaf"))
    root, above = reduce_groups(nodes, ["leaf", "name"], "int")
    root = root.select("_group", F.col("root").alias("top"), F.lit("").alias("steps"))
    tree = siblings_below(above, root, "int", "top string")

    def to_groups(rows: Iterator[tuple]) -> Iterator[tuple]:
        for names, nodes, single, steps, top in rows:
            made = reduce_runs(nodes, None if single else LEVELS)[1]
            for slot, (name, node) in enumerate(zip(names, nodes)):
                yield name, node, top, steps_above(made, slot) + steps

    paths = map_rows(tree.select(F.col("slots")["name"].alias("names"), F.col("slots")["leaf"].alias("nodes"), "single", "steps", "top"),
                     ["names", "nodes", "single", "steps", "top"], f"_group {kind}, subroot string, top string, steps string", to_groups)
    rows = siblings_below(levels, stage(paths), kind, "subroot string, top string")

    def to_leaves(rows: Iterator[tuple]) -> Iterator[tuple]:
        for group, slots, single, steps, subroot, top in rows:
            made = reduce_runs([s["leaf"] for s in slots], None if single else LEVELS)[1]
            for slot, s in enumerate(slots):
                path = steps_above(made, slot) + steps
                folded = fold(s["altered"] or s["leaf"], path)
                yield s["_id"], group, s["leaf"], subroot, top, proof(path), folded, folded == top

    found = map_rows(rows.select("_group", "slots", "single", "steps", "subroot", "top"),
                     ["_group", "slots", "single", "steps", "subroot", "top"],
                     f"_id bigint, _group {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                     "folded_root string, verified boolean", to_leaves, 2048)
    return found.select(F.col("_id").cast(id_kind).alias(id_), F.col("_group").alias(group), "leaf", "subroot", "root",
                        "proof_sha256", "folded_root", "verified")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(table(spark, sf_dir, "documents").select(*FIELDS))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _op13_sql() -> str:
    def size_and_value(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(size_and_value(text if c == "text" else c) for c in FIELDS) + ")"

    def steps(first: str, nodes: str, key: str, same: str) -> str:
        """One row per level above a node: the digests before and after its own in its run."""
        own = f"l.{key} // CAST(3 ** k.level AS BIGINT)"
        return f"""
  SELECT l.rid, {first} + k.level AS step, coalesce(string_agg(k.h, '' ORDER BY k.pos) FILTER (k.pos < {own}), '') AS before,
         coalesce(string_agg(k.h, '' ORDER BY k.pos) FILTER (k.pos > {own}), '') AS behind
  FROM leaves l JOIN {nodes} k ON {same} k.n > 1 AND k.pos // 3 = l.{key} // CAST(3 ** (k.level + 1) AS BIGINT)
  GROUP BY l.rid, k.level"""

    up = "level + 1, pos // 3 AS pos, (n + 2) // 3 AS n, sha256(string_agg(h, '' ORDER BY pos)) AS h"
    crc = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
    return f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT doc_id, source, {leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS altered
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS group_pos
  FROM hashed),
nodes AS (
  SELECT group_pos, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT group_pos, {up} FROM nodes WHERE n > 1 GROUP BY group_pos, level, pos // 3, n),
subroots AS MATERIALIZED (SELECT group_pos, h FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, group_pos AS pos, (SELECT count(*) FROM subroots) AS n, h FROM subroots
  UNION ALL
  SELECT {up} FROM tops WHERE n > 1 GROUP BY level, pos // 3, n),
leaves AS MATERIALIZED (SELECT * FROM placed),
steps AS MATERIALIZED ({steps("0", "nodes", "pos", "k.group_pos = l.group_pos AND")}
  UNION ALL {steps("1000", "tops", "group_pos", "")}),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY step) AS rung FROM steps),
proofs AS (SELECT rid, sha256(string_agg(before || behind, '' ORDER BY rung)) AS proof_sha256 FROM numbered GROUP BY rid),
folds AS (
  SELECT rid, 0 AS rung, coalesce(altered, leaf) AS h FROM leaves
  UNION ALL
  SELECT f.rid, s.rung, sha256(s.before || f.h || s.behind) FROM folds f JOIN numbered s ON s.rid = f.rid AND s.rung = f.rung + 1),
folded AS (SELECT rid, max_by(h, rung) AS folded_root FROM folds GROUP BY rid)
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root.h AS verified
FROM leaves JOIN subroots USING (group_pos) JOIN folded USING (rid) LEFT JOIN proofs USING (rid), (SELECT h FROM tops WHERE n = 1) root"""


OP13_SQL = _op13_sql()
