"""Centroid clusters, quality rules and Merkle manifests against brute force, with awkward rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from demandspark.llm import isolation, merkle, orchard
from demandspark.llm.common import table

SF = "/root/testdata/sf0.001"


# --- centroid clusters ---

def lloyd(rows, k=8, rounds=10, scale=1024):
    """(id, vector) pairs to {id: (cluster, distance)} in plain Python numbers."""
    kept = [(i, [math.floor(scale * x) if abs(x) < 2**52 else int(x) * scale for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            centroids[j] = [sum(c) // len(g) for c in zip(*g)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 f"vec_id bigint, embedding array<{kind}>, cluster int, distance string")


@pytest.mark.parametrize("width,k,spread", [(3, 8, 1.0), (5, 20, 0.01), (2, 3, 1e30), (64, 8, 1.0)])
def test_clusters_equal_plain_rounds(spark, width, k, spread):
    rng = random.Random(width)
    rows = [(i, [rng.gauss(0, spread) for _ in range(width)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)] + [(7, rows[3][1]), (None, rows[4][1])]
    want, centers = lloyd(rows, k, 4)
    got, centroids = orchard.centroid_clusters(vectors(spark, rows), width, k, 4)
    assert centroids == centers
    fits = [(i, c, d if d < 2**63 else None) for i, c, d in want]
    assert sorted((tuple(r)[:3] for r in got.collect()), key=repr) == sorted(fits, key=repr)
    inertia = {}
    for _, c, d in want:
        inertia[c] = inertia.get(c, 0) + d
    for r in got.collect():
        assert r["cluster_inertia"] == (inertia[r["cluster"]] if inertia[r["cluster"]] < 2**63 else None)
        assert r["inertia"] == (sum(inertia.values()) if sum(inertia.values()) < 2**63 else None)


def test_search_finds_the_nearest_with_ties():
    rng = np.random.default_rng(1)
    for k in (1, 2, 7, 60):
        centroids = rng.integers(-4, 5, (k, 3))
        x = rng.integers(-6, 7, (300, 3))
        far = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        best, near = orchard.orchard_search(x, centroids, *orchard.neighbour_lists(centroids), start=k - 1)
        assert (near == far.min(axis=1)).all() and (best == far.argmin(axis=1)).all()


def test_search_stops_early():
    """Far clusters are not measured: each vector meets few of the centroids."""
    centroids = np.arange(50)[:, None] * 1000
    order, gaps = orchard.neighbour_lists(centroids)
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype == np.int64:
                seen.append(len(key))
            return np.asarray(self)[key]

    orchard.orchard_search(np.array([[1]] * 10), centroids.view(Counted), order, gaps)
    assert sum(seen) <= 20


def test_vectors_that_do_not_count(spark):
    good = [(i, [float(i), 0.5]) for i in range(4)]
    bad = [(10, None), (11, [1.0]), (12, [1.0, None]), (13, [1.0, float("nan")]), (14, [float("inf"), 1.0]), (15, [])]
    rows, centroids = orchard.centroid_clusters(vectors(spark, good + bad), 2, 8, 3)
    assert len(centroids) == 4 and {r["vec_id"] for r in rows.collect()} == {0, 1, 2, 3}
    rows, centroids = orchard.centroid_clusters(vectors(spark, bad), 2)
    assert centroids == [] and rows.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"] and rows.isEmpty()


def test_parts_of_numbers():
    for n in (0, 1, -1, 2**32, -(2**90) + 12345, 2**63):
        assert sum(p << (32 * at) for at, p in orchard.limbs(n)) == n


# --- quality rules ---

def plain_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, dup = [], 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def some_texts():
    rng = random.Random(5)
    out = [None, "", " \t\n", "a", "a " * 8, "a " * 9, "a b " * 30, "x\n\nx\n x\nx", "é|é #", "a b c\x0bd", "\r\n".join("pq"), "w\n" * 30]
    for _ in range(60):
        out.append(" ".join(rng.choice("abcde") + rng.choice(["", "\n", "#"]) for _ in range(rng.randint(1, 120))))
    line = " ".join(f"w{i}" for i in range(20))
    out += [line, line + "\n" + line, line + " x " + line, " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(20000)) + " " + line * 3]
    return out


def test_statistics_equal_plain_ones():
    for t in some_texts()[:-1]:
        assert isolation.rule_stats(t) == plain_stats(t), t
    n = isolation.rule_stats(some_texts()[-1])
    assert n[0] == 20000 + 58 and n[4] == 56


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 13])
def test_repeats_at_any_width(width):
    rng = random.Random(width)
    for _ in range(40):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 60))]
        windows = [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]
        covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + width)}
        assert isolation.repeated_words(words, width) == len(covered)


def test_forest_paths_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    x[:5] += 30
    forest = isolation.IsolationForest.fit(x, trees=20, sample=64)
    score = forest.score(x)
    for i in (0, 1, 50, 399):
        lengths = []
        for t in range(20):
            at = 0
            while forest.feature[t, at] >= 0:
                at = 2 * at + (2 if x[i, forest.feature[t, at]] >= forest.cut[t, at] else 1)
            lengths.append(forest.length[t, at])
        assert score[i] == pytest.approx(2 ** (-np.mean(lengths) / float(isolation.mean_path(64))))
    assert score[:5].min() > score[5:].max()
    again = isolation.IsolationForest.fit(x, trees=20, sample=64)
    assert (again.score(x) == score).all()


def test_constant_rows_and_single_rows_make_a_forest():
    for x in (np.ones((50, 2)), np.ones((1, 2))):
        assert np.isfinite(isolation.IsolationForest.fit(x, trees=3).score(x)).all()


def test_threshold_loses_few_good_rows():
    rng = np.random.default_rng(4)
    scores = np.concatenate([rng.uniform(0.3, 0.6, 1000), rng.uniform(0.55, 0.9, 100)])
    good = np.arange(1100) < 1000
    t = isolation.calibrate(scores, good, 0.01)
    assert (scores[good] > t).mean() <= 0.01 and (scores[~good] > t).mean() > 0.8
    assert isolation.calibrate(scores[good], good[good], 0.01) == np.sort(scores[good])[989]
    assert isolation.calibrate(scores[~good], good[~good]) == float("inf")


def test_verdicts_on_awkward_rows(spark):
    rows = [(i, t, "en", 0.5, True) for i, t in enumerate(some_texts())] + [(None, "a", "en", 0.5, True), (3, "a", "en", 0.5, True)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, score double, kept boolean").repartition(3)
    out = isolation.quality_verdicts(docs, isolation.QualityModel({}, {}))
    assert out.columns == ["doc_id", "score", *isolation.STATS, "base_failed", "anomaly_form", "anomaly_repeats", "kept"]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in isolation.STATS], r["base_failed"], r["kept"]) for r in out.collect())
    want = []
    for i, t, *_ in rows:
        s = plain_stats(t) if len(t or "") < 50000 else isolation.rule_stats(t)
        failed = s[0] < 20 or 100 * s[4] > 30 * s[0]
        want.append((i is None, i or 0, *s, failed, not failed))
    assert got == sorted(want)
    assert isolation.quality_verdicts(docs.limit(0), isolation.QualityModel({}, {})).collect() == []


def test_fit_on_odd_labels(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(30 + i))) for i in range(30)] + [(None, "a"), (5, "b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert isolation.fit(docs, none) == isolation.QualityModel({}, {})
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7), (4, 1), (4, 1), (5, 1)], "doc_id bigint, quality int")
    model = isolation.fit(docs, odd)
    assert set(model.forests) == set(isolation.FORESTS)


def test_quality_learns_from_all_labelled_rows(spark, monkeypatch):
    """Thresholds as those of all labelled rows together, and trees drawn from all of them, however few the driver holds."""
    rng = random.Random(8)
    rows = [(i, " ".join("x" * rng.randint(1, 9 + i % 7) for _ in range(rng.randint(20, 90))), int(rng.random() < 0.8)) for i in range(600)]
    rows += [(700 + i, " ".join("y" * 40 for _ in range(30)) + f" #{i}#", 0) for i in range(9)]
    docs = spark.createDataFrame(rows + rows[:50], "doc_id bigint, text string, quality int")
    labels = docs.select("doc_id", "quality")
    stats, good = np.array([isolation.rule_stats(r[1]) for r in rows + rows[:50]]), np.array([r[2] == 1 for r in rows + rows[:50]])
    usual = ~isolation.fails_base(stats)
    for pool in (64, 10_000):
        drawn, plain = [], isolation.IsolationForest.fit
        monkeypatch.setattr(isolation.IsolationForest, "fit", staticmethod(lambda x, *more: drawn.append(x) or plain(x, *more)))
        model = isolation.fit(docs, labels, pool, 20, 32)
        monkeypatch.setattr(isolation.IsolationForest, "fit", staticmethod(plain))
        assert all(len(x) > 200 for x in drawn) and len(drawn) == 2
        x = isolation.features(stats[usual])
        for name, forest in model.forests.items():
            score = forest.score(x[:, isolation.FORESTS[name]])
            assert model.thresholds[name] == isolation.calibrate(score, good[usual])


def test_thresholds_equal_those_of_one_array(spark):
    rng = np.random.default_rng(6)
    scores = np.round(rng.random(3000), 3)
    good = rng.random(3000) > scores ** 3
    rows = spark.createDataFrame([(bool(g), float(s), float(1 - s)) for g, s in zip(good, scores)], "good boolean, a double, b double")
    for lost in (0.0, 0.01, 0.3):
        got = isolation.thresholds(rows, ["a", "b"], lost)
        assert got == {"a": isolation.calibrate(scores, good, lost), "b": isolation.calibrate(np.array([1 - s for s in scores]), good, lost)}
    assert isolation.thresholds(rows.where("good"), ["a"]) == {"a": isolation.calibrate(scores[good], good[good])}
    assert isolation.thresholds(rows.where("not good"), ["a"]) == {"a": float("inf")}


def test_quality_query_against_its_labels(spark):
    """The whole query: statistics of all texts by brute force, and what the labels say of its verdicts."""
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in isolation.op12_quality_rules(spark, sf).collect()}
    for r in table(spark, sf, "documents").collect():
        if len(r["text"] or "") < 3000:
            s, g = plain_stats(r["text"]), got[r["doc_id"]]
            assert tuple(g[c] for c in isolation.STATS) == s
            assert g["base_failed"] == (s[0] < 20 or 100 * s[4] > 30 * s[0]) and not (g["kept"] and g["base_failed"])
    quality = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    passed = [(quality[i], r["kept"]) for i, r in got.items() if quality.get(i) is not None and not r["base_failed"]]
    good, poor = [k for q, k in passed if q == 1], [k for q, k in passed if q == 0]
    assert sum(good) / len(good) > 0.97 and sum(poor) / len(poor) < 0.3


# --- Merkle manifest ---

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(field(r["doc_id"]), field(r["source"]), field(r["lang"]), field(r["n_chars"]), field(text))


def plain_tree(nodes):
    at, above = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for j, i in enumerate(at):
            above[j].append((runs[i // 3][:i % 3], runs[i // 3][i % 3 + 1:]))
            at[j] = i // 3
        nodes = [h(*r) for r in runs]
    return nodes[0], above


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        members = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = members, *plain_tree([leaf(r, r["text"]) for r in members])
    root, tops = plain_tree([trees[s][1] for s in names]) if names else (None, [])
    out = []
    for s, top in zip(names, tops):
        members, subroot, above = trees[s]
        for r, path in zip(members, above):
            node = first = leaf(r, r["text"])
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                node = leaf(r, r["text"].replace("\n", ""))
            for before, after in path + top:
                node = h(*before, node, *after)
            siblings = [x for before, after in path + top for x in before + after]
            out.append((r["doc_id"], s, first, subroot, root, h(*siblings), node, node == root))
    return sorted(out, key=repr)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, `_group` int, root string"


def rows_of(kind):
    rng = random.Random(2)
    if kind == "one row":
        return [(3, "a\nb", "en", "s", 3)]
    if kind == "lone groups":
        return [(i, f"t\n{i}", None, f"s{i}" if i else None, i) for i in range(40)]
    if kind == "one large group":
        return [(i * 3, f"t\n{i}", "en", "s", 1) for i in range(2300)] + [(1, "ü\n", "de", None, None)]
    if kind == "wide ids":
        return [(rng.randint(-2**63, 2**63 - 1), f"x{i}\n", "en", rng.choice(["a", "b", "ä"]), i) for i in range(900)] + [
            (-2**63, "\n", "en", "a", 0), (2**63 - 1, "\n", "en", "a", 0), (0, "\n", "en", "a", 0), (63, None, "en", "a", 0), (64, "", "en", "a", 0)]
    return [(i % 5 if i % 3 else None, None if i % 7 == 0 else f"t\n{i % 6}", "en", None if i % 2 else "s", i % 2) for i in range(1600)] + [
        (9, "same", "en", "s", 4)] * 1200


@pytest.mark.parametrize("kind", ["one row", "lone groups", "one large group", "wide ids", "repeats and nulls"])
def test_manifest_equals_brute_force(spark, kind):
    docs = spark.createDataFrame([(*r, "clash", 7, "clash") for r in rows_of(kind)], DOCS).repartition(5)
    got = merkle.manifest(docs)
    assert got.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(docs.collect())


def test_manifest_of_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_tall_directory(spark, monkeypatch):
    """Ranks stay right when counts climb several levels."""
    monkeypatch.setattr(merkle, "DIRECTORY_BITS", 2)
    docs = spark.createDataFrame([(*r, "", 0, "") for r in rows_of("one large group") + rows_of("wide ids")], DOCS)
    assert sorted(map(tuple, merkle.manifest(docs).collect()), key=repr) == plain_manifest(docs.collect())


def test_slots_are_ranks(spark):
    rows = [("g", (i * 37) % 5000, f"{i:064d}", None) for i in range(3000)] + [(None, None, f"{i}", None) for i in range(50)]
    leaves = spark.createDataFrame(rows, "_group string, _id bigint, leaf string, altered string")
    got = merkle.place_leaves(leaves).collect()
    for group in ("g", None):
        mine = sorted((r for r in got if r["_group"] == group), key=lambda r: r["_slot"])
        assert [r["_slot"] for r in mine] == list(range(len(mine)))
        keys = [(r["_id"] is not None, r["_id"] or 0, r["leaf"]) for r in mine]
        assert keys == sorted(keys)


def test_alterations_are_found(spark):
    """The query: exactly the rows whose text changes fail, all others verify."""
    got = {r["doc_id"]: r for r in merkle.op13_merkle_manifest(spark, SF).collect()}
    rows = table(spark, SF, "documents").collect()
    assert len(got) == len(rows)
    for r in rows:
        changed = r["text"] is not None and "\n" in r["text"] and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        assert got[r["doc_id"]]["verified"] == (not changed)
    assert len({r["root"] for r in got.values()}) == 1
    n = table(spark, SF, "documents").select("source").distinct().count()
    assert len({r["subroot"] for r in got.values()}) == n
