"""The corpus operators against brute force on small tables with awkward rows."""

import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from demandspark.llm import bpe, components, exact, imatch, jaccard, langid, packing, sharding, suffixes, toxicity, warc
from demandspark.llm.common import shared_dir
from demandspark.llm.pieces import Splitter
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
RANKS = P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, shard int, `_group` string"
WORDS = "der die une and of the ñu été 42 x".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n))


def awkward(seed=1):
    """Rows with null and empty texts, white space, repeats, near copies, shared passages, a long text, a null id."""
    rng = random.Random(seed)
    base, passage = prose(rng, 80), prose(rng, 30)
    texts = [None, "", " \t\n", "a", "A  a", base, base, base.replace(" ", "\n", 3), base + " tail", base + " end of it",
             "é" * 40, passage, prose(rng, 20) + " " + passage, passage + " " + prose(rng, 5) + " " + passage,
             "ab" * 200, "ab" * 90, "日本語 " * 30, "x" * 49, "x" * 50, "x" * 51, prose(rng, 3000), None]
    texts += [prose(rng, rng.randint(1, 60)) for _ in range(12)]
    rows = [(i, t, "en", "s", None if t is None else len(t), 0.5, 3, "g") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def with_repeats(spark):
    rows = awkward()
    return spark.createDataFrame(rows + rows[:4] + [(None, rows[0][1], *rows[0][2:]), (None, None, *rows[0][2:])], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


# --- exact dedup ---

def squeezed(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("first_run,widen", [(1, 2), (256, 16)])
def test_exact_groups(docs, first_run, widen):
    want = {}
    for i, t in texts(docs).items():
        want.setdefault(squeezed(t), []).append((-len(t), i))
    got = exact.exact_dedup(docs, first_run=first_run, widen=widen).collect()
    assert len(got) == docs.count()
    for r in got:
        group = want[squeezed(r["_doc"]["text"])]
        assert (r["keep_id"], r["group_size"]) == (min(group)[1], len(group))
        assert r["kept"] == (r["_doc"]["doc_id"] == r["keep_id"])
        assert r["text_sha256"] == hashlib.sha256(squeezed(r["_doc"]["text"]).encode()).hexdigest()


def test_exact_repeated_rows_keep_one(with_repeats, nothing):
    kept = exact.exact_dedup(with_repeats).where("kept").select("_doc.text").collect()
    found = [squeezed(r["text"]) for r in kept]
    assert sorted(found) == sorted(set(squeezed(r["text"]) for r in with_repeats.collect()))
    assert exact.exact_dedup(nothing).count() == 0


def test_one_row_of_equal_texts(docs, with_repeats, nothing):
    """Whole rows, with columns that clash with names used inside; rows alike in id and text leave one."""
    for df in (docs, with_repeats):
        own = df.withColumn("mark", F.lit("m")).withColumn("has", F.lit(5))
        got = exact.one_of_each(own)
        assert got.columns == own.columns
        groups = {}
        for r in own.collect():
            groups.setdefault(squeezed(r["text"]), []).append(r)
        rows = got.collect()
        assert len(rows) == len(groups)
        for r in rows:
            assert r in groups[squeezed(r["text"])]
            best = min(groups[squeezed(r["text"])], key=lambda x: (-len(x["text"] or ""), x["doc_id"] is None, x["doc_id"] or 0))
            assert (r["doc_id"], len(r["text"] or "")) == (best["doc_id"], len(best["text"] or ""))
    assert exact.one_of_each(nothing).count() == 0


@pytest.mark.parametrize("kind,ids", [("bigint", [-(1 << 63), 5, (1 << 63) - 1, None]), ("string", ["a", "b", "c", None])])
def test_exact_ids_of_any_kind(spark, kind, ids):
    rows = [(i, t) for i in ids for t in ("one text", "a b")] + [(ids[1], "onetext ")]
    found = exact.exact_dedup(spark.createDataFrame(rows, f"doc_id {kind}, text string")).collect()
    assert {(r["_doc"]["doc_id"], r["_doc"]["text"]) for r in found if r["kept"]} == {(ids[0], "one text"), (ids[0], "a b")}
    assert {r["keep_id"] for r in found} == {ids[0]} and {r["group_size"] for r in found} == {4, 5}


# --- near copies ---

def shingle_sets(rows, width):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for i, t in rows.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower))
        out[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    return out


def components_of(sets, percent):
    root = {i: i for i in sets}
    for _ in sets:
        for a, x in sets.items():
            for b, y in sets.items():
                if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (1, 50)])
def test_jaccard_components(docs, width, percent):
    sets = shingle_sets(texts(docs), width)
    want = components_of(sets, percent)
    for r in jaccard.jaccard_components(docs, width=width, percent=percent).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])


@pytest.mark.parametrize("bound, most", [("BLOCK", 4), ("BLOCK_GRAMS", 64)])
def test_jaccard_chains_and_blocks(spark, monkeypatch, bound, most):
    """Sliding sets form one chain; small blocks compare a bucket in pieces."""
    monkeypatch.setattr(jaccard, bound, most)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    rows = {i: " ".join(words[2 * i:2 * i + 40]) for i in range(40)}
    for i in range(40, 70):  # variants at the border of the threshold
        w = rows[0].split()
        for k in rng.sample(range(40), rng.randint(1, 3)):
            w[k] = f"z{rng.randint(0, 9)}"
        rows[i] = " ".join(w)
    want = components_of(shingle_sets(rows, 2), 80)
    df = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(df, width=2, percent=80).collect()}
    assert got == want


def rows_of_components(rows, width, percent):
    """Rows (doc_id, text) by place: size of the set, place of the component's root."""
    sets = shingle_sets({k: t or "" for k, (_, t) in enumerate(rows)}, width)
    return sets, components_of(sets, percent)


def test_jaccard_awkward(with_repeats, nothing):
    rows = [(r["doc_id"], r["text"]) for r in with_repeats.collect()]
    sets, root = rows_of_components(rows, 4, 85)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root[k]] = min((x for x in (least.get(root[k]), i) if x is not None), default=None)
    want = [(i, len(sets[k]), least[root[k]] if sets[k] else i) for k, (i, _) in enumerate(rows)]
    got = [tuple(r) for r in jaccard.jaccard_components(with_repeats).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert jaccard.jaccard_components(nothing).count() == 0


def test_links_hold_for_repeated_and_null_ids(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"{k}{rng.randint(0, 999)}" for _ in range(60)) for k in "abcd")
    rows = [(1, a), (1, b), (2, a + " q"), (3, b + " q"), (4, c), (None, c + " q"), (None, d), (None, d + " q"), (5, "lone text of its own"),
            (2, d + "".join(f" z{k}" for k in range(30)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["mark"]): r["component_id"] for r in jaccard.similar_rows(df).collect()}
    marks = {r["text"]: r["mark"] for r in df.select("text", F.xxhash64("text").alias("mark")).collect()}
    want = [1, 1, 1, 1, 4, 4, None, None, 5, 2]
    assert [got[i, marks[t]] for i, t in rows] == want


def test_one_of_each(spark, with_repeats, nothing):
    """Of each component one row stays, also when ids repeat or are null; columns and clashing names stay."""
    rng = random.Random(9)
    a, b = (" ".join(f"{k}{rng.randint(0, 999)}" for _ in range(60)) for k in "ab")
    rows = [(1, a), (None, a + " q"), (2, b), (2, a + " z"), (3, None), (4, ""), (None, b + " q"), (None, "quite another text")]
    df = spark.createDataFrame([(*r, 7, "m") for r in rows], "doc_id bigint, text string, node int, mark string")
    out = jaccard.one_of_each(df, width=5, percent=80)
    assert out.columns == df.columns
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == {(1, a), (2, b), (3, None), (4, ""), (None, "quite another text")}
    assert jaccard.one_of_each(nothing).count() == 0
    every = [(r["doc_id"], r["text"]) for r in with_repeats.collect()]
    sets, root = rows_of_components(every, 5, 80)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each(with_repeats, width=5, percent=80).collect()]
    groups = {}
    for k, row in enumerate(every):
        if sets[k]:
            groups.setdefault(root[k], []).append(row)
    for members in groups.values():
        ids = [i for i, _ in members if i is not None]
        left = {row for row in kept if row in members}
        assert len(left) == 1 and next(iter(left))[0] == (min(ids) if ids else None)
    assert sum(not shingle_sets({0: t or ""}, 5)[0] for _, t in kept) == sum(not x for x in sets.values())


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 63, n // 12 + 1).astype(np.uint64)]))
        differ = len(np.setxor1d(a, b))
        pairs = list(jaccard.possible_pairs(np.array([len(a), len(b)]), [jaccard._bitmap(a), jaccard._bitmap(b)], 80))
        if 20 * (len(a) + len(b)) >= 180 * differ:
            assert pairs and pairs[0][2][0] <= differ


def test_folded_bitmaps_never_rule_out_what_whole_ones_leave():
    rng = np.random.default_rng(1)
    for n in (1, 9, 40, 300, 3000, 20000):
        for _ in range(10):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.05], rng.integers(0, 1 << 63, n // 10 + 1).astype(np.uint64)]))
            whole, sizes = [jaccard._bitmap(a), jaccard._bitmap(b)], np.array([len(a), len(b)])
            if list(jaccard.possible_pairs(sizes, whole, 80)):
                assert list(jaccard.possible_pairs(sizes, [jaccard._folded(x) for x in whole], 80))


def test_unlike_texts_of_one_bucket_bring_no_bitmaps(spark):
    """Of texts that share a rare passage only those with a possible partner are left in a block, once."""
    rng = random.Random(6)
    rows = [(i, "one two three four " + " ".join(f"{i}x{rng.randint(0, 10 ** 6)}" for _ in range(200 if i < 9 else 900))) for i in range(12)]
    rows += [(20, rows[2][1] + " q"), (21, rows[10][1] + " q")]
    docs = jaccard.identified(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text")
    reps = jaccard.prefixes(docs, 4, 85, np.zeros(1 << jaccard.SKETCH_BITS, np.uint64)).withColumn("node", F.col("doc"))
    shared = jaccard.shingles(b"one two three four", 4, jaccard.Powers()).view(np.int64).tolist()
    reps = reps.withColumn("prefix", F.concat("prefix", F.array(*[F.lit(x) for x in shared])))
    blocks = [r["nodes"] for r in jaccard._blocks(reps, 85).collect()]
    assert sorted(blocks) == [[2, 20], [10, 21]]


def test_connected(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == {n: r for n, r in root.items() if n != r}


# --- repeated passages ---

def removed(rows):
    seen, out = set(), {}
    for i in sorted(rows):
        b = rows[i].encode()
        own = [b[k:k + 50] for k in range(len(b) - 49)]
        mask = bytearray(len(b))
        for k, w in enumerate(own):
            if w in seen:
                mask[k:k + 50] = b"\1" * 50
        seen.update(own)
        out[i] = bytes(mask)
    return out


def test_repeats(docs, nothing):
    rows = texts(docs)
    want = removed(rows)
    for r in suffixes.remove_repeats(docs).collect():
        data, mask = rows[r["doc_id"]].encode(), want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"]) == (len(data), sum(mask))
        assert r["n_spans"] == len(re.findall(b"\1+", mask))
        assert r["kept_sha256"] == hashlib.sha256(bytes(x for x, m in zip(data, mask) if not m)).hexdigest()
    assert suffixes.remove_repeats(nothing).count() == 0


def test_repeats_in_small_slabs(docs, monkeypatch):
    """Many slabs, shares and sorts give what one does."""
    one = sorted(map(tuple, suffixes.remove_repeats(docs).collect()))
    for name, value in (("SLAB", 64), ("SHARE_BYTES", 500), ("SORTED_BYTES", 200), ("REFERENCES", 7)):
        monkeypatch.setattr(suffixes, name, value)
    assert sorted(map(tuple, suffixes.remove_repeats(docs).collect())) == one


def test_repeats_awkward(with_repeats):
    got = suffixes.remove_repeats(with_repeats).collect()
    assert len(got) == with_repeats.count()
    cut = suffixes.cut_texts(with_repeats)
    assert cut.columns == with_repeats.columns and cut.where("text is null").count() == with_repeats.where("text is null").count()


def test_suffix_array():
    rng = np.random.default_rng(2)
    for t in range(150):
        s = rng.integers(1, 2 + t % 4, rng.integers(0, 120))
        s = np.concatenate([s, s[: len(s) // 2], s])
        depth = int(rng.integers(1, 5))
        order = suffixes.suffix_array(s, depth).tolist()
        heads = [s[i:i + 3**depth].tolist() for i in order]
        assert sorted(order) == list(range(len(s))) and heads == sorted(heads)


def test_shares_ascend_with_keys_at_any_number():
    """At many shares too, each is a range of the sorted keys, and all are used about evenly."""
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << suffixes.KEY_BITS, 200_000, np.uint64))
    for shares in (1, 60_000, 65_537, 131_072, 1 << 24):
        share = suffixes.share_of(keys, shares)
        assert (np.diff(share) >= 0).all() and 0 <= share[0] and share[-1] < shares
        assert share[-1] > 0.999 * shares - 1
    last = np.array([(1 << suffixes.KEY_BITS) - 1], np.uint64)
    assert suffixes.share_of(last, 131_072)[0] == 131_071


def test_minimizers_fill_all_shares_alike():
    """Minimizers are the least of many hashes; no share gets more of them than the others for that."""
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(60_000)).encode()
    keys = suffixes.minimizers(text, suffixes.Powers())[0]
    counts = np.bincount(suffixes.share_of(keys, 100), minlength=100)
    assert counts.max() < 1.5 * counts.mean() and counts.min() > 0.5 * counts.mean()
    assert (keys >> np.uint64(suffixes.KEY_BITS)).max() == 0
    some = np.unique(np.random.default_rng(1).integers(0, 1 << suffixes.KEY_BITS, 100_000, np.uint64))
    assert len(np.unique(suffixes._spread(some))) == len(some)


# --- packing and byte-pair encoding ---

def test_plan_is_best_fit_decreasing():
    import bisect

    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice([10, 64, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
        rooms, bins = [], 0
        for z in sorted(sizes, reverse=True):
            k = bisect.bisect_left(rooms, z)
            room = rooms.pop(k) if k < len(rooms) else capacity
            bins += room == capacity
            if room > z:
                bisect.insort(rooms, room - z)
        used = {}
        for size, _, n, per, first, place in packing.plan({z: sizes.count(z) for z in set(sizes)}, capacity):
            for k in range(n):
                used.setdefault(first + k // per, []).append((place + k % per * size, size))
        assert sum(len(x) for x in used.values()) == len(sizes) and len(used) == bins
        for items in used.values():
            items.sort()
            assert [a for a, _ in items] == [sum(z for _, z in items[:k]) for k in range(len(items))]
            assert sum(z for _, z in items) <= capacity


def test_pack(docs, nothing):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, P.PATTERN, with_ids=True).collect()
    for doc, text in texts(docs).items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        own = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["piece"])
        assert [i for r in own for i in np.frombuffer(bytes(r["ids"]), "<u4").tolist()] == ids
        assert all(r["length"] == 1024 for r in own[1:])
        assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in own)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        items.sort()
        assert [a for a, _ in items] == [sum(n for _, n in items[:k]) for k in range(len(items))]
    assert packing.pack(nothing, path, P.PATTERN).count() == 0


def test_added_tokens_follow_the_file():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tokenizer, own = Tokenizer.from_file(path), packing.WordIds(path, P.PATTERN)
    for text in ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b", "<|endoftext|", "plain words"]:
        assert np.frombuffer(own(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_bpe_equals_tiktoken(docs, nothing):
    import tiktoken

    ranks = bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.encode_table(docs, RANKS, P.PATTERN)
    assert set(docs.columns) < set(found.columns)
    for r in found.collect():
        assert list(r["ids"]) == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.codec_digests(nothing, RANKS, P.PATTERN, ["doc_id"]).count() == 0
    rng = random.Random(2)
    codec = bpe.Codec(ranks, P.PATTERN)
    letters = "a b'st\n\t\x1c\x85\xa0š42²ªé日 "
    for _ in range(300):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert codec.encode(s).tolist() == library.encode_ordinary(s)
        assert Splitter(P.PATTERN)(s) == codec.split.wide(s)


# --- archives and shards ---

def pages_of(spark):
    rows = [(i, f"http://a/{i} b", h) for i, h in enumerate(["<p>x</p>", None, "", "<p>x</p>", "é" * 70_000, "<p>x</p>", "\r\n\r\n", "y" * 300_000])]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.mark.parametrize("archive_bytes", [1, 1 << 20])
def test_warc_round_trip(spark, archive_bytes):
    pages = pages_of(spark)
    path = shared_dir(spark)
    archives = warc.write_archives(pages, path, archive_bytes)
    found = {r["page_id"]: r for r in warc.resolve(warc.read_archives(archives, path)).collect()}
    first = {}
    for r in sorted(pages.collect(), key=lambda r: r["page_id"]):
        body = (r["html"] or "").encode()
        keep = first.setdefault(body, r["page_id"])
        got = found[r["page_id"]]
        assert (got["payload_bytes"], got["payload_digest"]) == (len(body), warc.sha1_base32(body))
        assert (got["record_type"], got["refers_to"]) == (("response", None) if keep == r["page_id"] else ("revisit", keep))
        assert got["payload"] is None if got["refers_to"] is not None else bytes(got["payload"]) == body


def test_warc_empty_and_broken(spark):
    path = shared_dir(spark)
    none = warc.write_archives(pages_of(spark).limit(0), path)
    assert warc.read_archives(none, path).count() == 0
    good = warc.page_record(1, "u", b"abc", 1) + warc.page_record(2, "u", b"abc", 1)
    assert [h["warc-type"] for h, _ in warc.read_records(io.BytesIO(good))] == ["response", "revisit"]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(good[:-20])))
    spoiled = warc.member({"WARC-Type": "response", "WARC-Block-Digest": "sha1:AAAA"}, b"x")
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(spoiled)))


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 25])
def test_shards(with_repeats, bucket_bytes):
    out = sharding.shuffle_to_shards(with_repeats, shared_dir(with_repeats.sparkSession), bucket_bytes=bucket_bytes)
    rows = out.collect()
    assert sorted(repr((r["doc_id"], r["text"])) for r in rows) == sorted(repr((r["doc_id"], r["text"])) for r in with_repeats.collect())
    slots = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)]
    assert all(s == list(range(len(s))) for s in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1


def test_shards_of_nothing(nothing):
    assert sharding.shuffle_to_shards(nothing, shared_dir(nothing.sparkSession)).count() == 0


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(0)
    seen = {}
    for _ in range(6000):
        k = tuple(sharding.fisher_yates(3, rng))
        seen[k] = seen.get(k, 0) + 1
    assert len(seen) == 6 and min(seen.values()) > 850


# --- fingerprints ---

def test_fingerprints_follow_the_method(docs):
    rows = texts(docs)
    words = imatch.lexicon(docs.na.fill("", ["text"]), "text", 0.1, 0.5)
    terms = {i: set(re.findall(r"[^\W_]+", t.lower())) for i, t in rows.items()}
    n = len(rows)
    counts = {}
    for t in terms.values():
        for w in t:
            counts[w] = counts.get(w, 0) + 1
    assert words == sorted(w for w, c in counts.items() if 0.1 * n <= c <= 0.5 * n)
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = {r["doc_id"]: tuple(r["p"]) for r in imatch.with_fingerprint(plain, "text", "p", words).collect()}
    for a in rows:
        for b in rows:
            if terms[a] & set(words) == terms[b] & set(words) and terms[a] & set(words):
                assert parts[a] == parts[b]


def test_short_texts_keep_their_identity(spark):
    """Texts of one or two lexicon terms, or of none, have a part, and different ones differ."""
    words = [f"w{i}" for i in range(200)]
    rows = [w for w in words] + [f"{a} {b}" for a, b in zip(words, words[1:])] + [f"other{i}" for i in range(50)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    parts = [tuple(r["p"]) for r in imatch.with_fingerprint(df, "text", "p", words).collect()]
    assert all(any(x is not None for x in p) for p in parts)
    assert len(set(parts)) == len(rows)


def test_next_row_wraps(docs, with_repeats, nothing):
    rows = texts(docs)
    ids = sorted(rows, reverse=True)
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for r in imatch.with_next(plain, "doc_id", "text").collect():
        assert r["next_text"] == rows[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
    repeated = with_repeats.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert imatch.with_next(repeated, "doc_id", "text").count() == with_repeats.count()
    assert imatch.with_next(nothing.select("doc_id", "text"), "doc_id", "text").count() == 0


# --- classifiers ---

def test_toxicity_learns(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        bad = i % 3 == 0
        rows.append((i, prose(rng, 30) + (" vile grub" if bad else "") + " " + prose(rng, 30)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows + [(1000, None), (1001, "")], "doc_id bigint, text string").withColumn("score", F.lit("own"))
    marks = spark.createDataFrame(labels + [(None, 1), (5000, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks, F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_column(docs, model).collect()}
    test = [i for i in range(400) if i % 5 == 0]
    assert sum((got[i] >= 0.5) == (i % 3 == 0) for i in test) >= 0.95 * len(test)
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 402
    flat = toxicity.fit(docs, marks.limit(0), F.lit(True))
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_column(docs, flat).collect())


def test_toxicity_learns_in_a_task(spark, monkeypatch):
    """The labelled texts' n-grams do not reach the driver."""
    import os

    docs = spark.createDataFrame([(i, f"text {i} " * 9, i % 2) for i in range(20)], "doc_id bigint, text string, toxic int")
    monkeypatch.setattr(toxicity, "train", lambda grams, *more: toxicity.NaiveBayesLinear(
        np.full(1 << toxicity.BITS, len(grams), np.float32), float(os.getpid())))
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"), F.lit(True))
    assert model.intercept != os.getpid() and set(model.weights.tolist()) == {20.0}


def test_cut_texts_are_written_before_whole_rows_move(with_repeats):
    """What is returned joins rows to written texts and cuts nothing itself, so the cut's shuffles are gone."""
    plan = suffixes.cut_texts(with_repeats)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan


def test_toxicity_training_equals_dense_steps():
    """Ratios, features and Adam steps against plain dense matrices."""
    rng = np.random.default_rng(3)
    bits, texts = 6, 30
    grams = [np.flatnonzero(rng.random(1 << bits) < 0.2).astype(np.int32) for _ in range(texts)]
    grams[4] = np.zeros(0, np.int32)
    labels = (rng.random(texts) < 0.4).astype(int)
    model = toxicity.train(grams, labels, 0.4, bits)
    has = np.zeros((texts, 1 << bits))
    for k, g in enumerate(grams):
        has[k, g] = 1
    bad, good = has[labels == 1], has[labels == 0]
    ratio = np.log((bad.sum(0) + 1) / (len(bad) + 2)) - np.log((good.sum(0) + 1) / (len(good) + 2))
    x = has * ratio * (has.sum(0) >= toxicity.LEAST_TEXTS) / np.sqrt(np.maximum(1, has.sum(1)))[:, None]
    weight = np.where(labels == 1, 0.4 / labels.mean(), 0.6 / (1 - labels.mean())) / texts
    w, b, m, v = np.zeros(1 << bits), np.log(0.4 / 0.6), np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    for t in range(1, toxicity.STEPS + 1):
        error = weight * (1 / (1 + np.exp(-(x @ w + b))) - labels)
        grad = np.append(x.T @ error + toxicity.PENALTY / texts * w, error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-10)
        w, b = w - step[:-1], b - step[-1]
    assert np.allclose(model.weights, w * ratio, atol=1e-5) and np.isclose(model.intercept, b)


def test_models_reach_tasks_without_the_package(tmp_path):
    """The package is importable on the driver only; scores must come all the same."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from demandspark.llm import langid, toxicity
rows = [(i, ("vile grub " if i % 2 else "good bread ") * 9, "ab"[i % 2], i % 2) for i in range(40)]
docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int")
model = toxicity.fit(docs, docs.select("doc_id", "toxic"), F.lit(True))
assert toxicity.score_column(docs, model).where("(score >= 0.5) = (toxic = 1)").count() == 40
assert langid.identify(docs, langid.fit(docs, F.lit(True))).where("lang_pred = lang").count() == 40
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]


def test_language_id_learns(spark):
    rng = random.Random(6)
    stems = {"aa": "zon rik bel tam".split(), "bb": "qua xir vey hup".split()}
    rows = [(i, lang, " ".join(rng.choice(stems[lang]) + rng.choice(stems[lang]) for _ in range(rng.randint(5, 90))))
            for i, lang in enumerate(["aa", "bb"] * 60)]
    rows += [(500, None, "zonzon"), (501, "aa", None), (502, "bb", " 12 ! "), (503, "aa", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    net = langid.fit(docs, F.col("doc_id") % 4 != 2)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, net).collect()}
    assert sum(got[i] == lang for i, lang, _ in rows[:120]) >= 114
    assert got[501] == got[502] == got[503] == "und"
    assert langid.fit(docs.limit(0), F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}


# --- pipeline ---

def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        path = shared_dir(spark)
        out.write.parquet(path)
        before, after = texts(docs), out
        docs = spark.read.parquet(path)
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == set(before)
            break
        assert docs.columns == columns
        after = texts(docs)
        if name == "toxicity":
            gone = set(before) - set(after)
            assert all(labels.get(i, 1) == 1 for i in gone)
        elif name == "exact_dedup":
            assert sorted(map(squeezed, after.values())) == sorted(set(map(squeezed, before.values())))
        elif name == "ngram_jaccard_join":
            assert set(after) == set(components_of_fast(shingle_sets(before, 5), 80).values())
        else:
            masks = removed(before)
            for i, t in before.items():
                ends = np.cumsum([0, *[len(c.encode()) for c in t]])
                kept = "".join(c for c, x, y in zip(t, ends, ends[1:]) if not all(masks[i][x:y]))
                assert after.get(i) == (kept if kept or not t else None)


def components_of_fast(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in sets}
