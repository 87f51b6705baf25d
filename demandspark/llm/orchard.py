"""Centroid clustering of integer vectors, the nearest centroid found by Orchard search.

Every centroid has a list of the others, nearest first. The search for a vector walks
the list of its best centroid so far: whatever it meets is marked as visited and
measured once, a closer one is jumped to at once and its own list is walked from the
start. It ends where the list goes strictly beyond twice the distance to the best, as
by the triangle inequality nothing further on can be as close.

Rows stay where they are: a round sends the centroids (whose number is a parameter) to
the tasks and gets exact partial sums back, a few numbers per cluster and component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.llm.common import stage, table

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
BLOCK = 2048
LONG = 2**63 - 1
LIMB = 32


def safe_size(width: int) -> int:
    """Components below this in size keep four times any squared distance within 62 bits."""
    return int(math.isqrt((1 << 60) // max(1, width)) // 2)


def quantise(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles: 64-bit whole numbers, or Python's where those are too narrow."""
    limit = safe_size(values.shape[1])
    if not values.size or np.abs(values).max() < limit / scale:
        return np.floor(values * float(scale)).astype(np.int64)
    whole = [int(v) * scale if abs(v) >= 2.0**52 else math.floor(v * scale) for v in values.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(values.shape)


def as_array(centroids: list[list[int]], width: int) -> np.ndarray:
    """Centroids as 64-bit numbers where these do, else as Python's."""
    small = all(abs(c) < safe_size(width) for row in centroids for c in row)
    return np.array(centroids, dtype=np.int64 if small else object).reshape(len(centroids), width)


def squared(differences: np.ndarray) -> np.ndarray:
    return (differences * differences).sum(axis=1)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid the others by (squared distance, number), and those distances."""
    k = len(centroids)
    order, gaps = np.zeros((k, max(0, k - 1)), np.int64), np.zeros((k, max(0, k - 1)), centroids.dtype)
    for c in range(k):
        far = squared(centroids - centroids[c])
        others = [j for j in sorted(range(k), key=lambda j: (far[j], j)) if j != c]
        order[c], gaps[c] = others, far[others]
    return order, gaps


def orchard_search(x: np.ndarray, centroids: np.ndarray, order: np.ndarray, gaps: np.ndarray,
                   start: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row; ties go to the smaller number.

    All rows of the block take their next step together.
    """
    n, k = len(x), len(centroids)
    best = np.full(n, start, np.int64)
    near = squared(x - centroids[start])
    visited = np.zeros((n, k), bool)
    visited[:, start] = True
    place = np.zeros(n, np.int64)
    walking = np.arange(n)
    while True:
        walking = walking[place[walking] < k - 1]
        walking = walking[(gaps[best[walking], place[walking]] <= 4 * near[walking]).astype(bool)]
        if not len(walking):
            return best, near
        met = order[best[walking], place[walking]]
        place[walking] += 1
        new = ~visited[walking, met]
        rows, met = walking[new], met[new]
        visited[rows, met] = True
        far = squared(x[rows] - centroids[met])
        closer = ((far < near[rows]) | ((far == near[rows]) & (met < best[rows]))).astype(bool)
        rows = rows[closer]
        best[rows], near[rows], place[rows] = met[closer], far[closer], 0


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """A whole number as parts of 32 bits that carry its sign, so that Spark can add any number of them."""
    sign, rest, at = (-1 if total < 0 else 1), abs(total), 0
    while rest:
        yield at, sign * (rest & ((1 << LIMB) - 1))
        rest, at = rest >> LIMB, at + 1


def _blocks(batches: Iterator[pa.RecordBatch], width: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            values = part.column("_v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)
            yield part.column("_id"), quantise(values, scale)


def kept_vectors(vectors: DataFrame, width: int, id_: str, vector: str) -> DataFrame:
    """``_id`` and ``_v`` (doubles) of vectors of ``width`` components, none null, NaN or infinite."""
    fits = F.expr(f"size(`{vector}`) = {width} AND forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) "
                  "AND abs(x) < double('Infinity'))")
    return vectors.where(F.coalesce(fits, F.lit(False))).select(
        F.col(f"`{id_}`").alias("_id"), F.col(f"`{vector}`").cast("array<double>").alias("_v"))


def first_centroids(kept: DataFrame, k: int, seed: int, scale: int) -> list[list[int]]:
    """The k vectors of the smallest sha256 of ``seed:id``; null ids last, repeated ids by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(digest.asc_nulls_last(), "_v").limit(k).select("_v").collect()
    return [[int(c) for c in quantise(np.array([r["_v"]], np.float64), scale)[0]] for r in rows]


def moved(kept: DataFrame, centroids: list[list[int]], width: int, scale: int) -> list[list[int]]:
    """Each centroid replaced by floor(sum / count) of the vectors nearest to it; empty ones stay."""
    points = as_array(centroids, width)
    order, gaps = neighbour_lists(points)
    schema = "cluster int, dim int, limb int, part bigint"
    arrow = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("limb", pa.int32()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(points), width + 1), object)  # the last column counts
        for _, x in _blocks(batches, width, scale):
            best, _ = orchard_search(x, points, order, gaps)
            for c in np.unique(best):
                mine = x[best == c]
                sums[c, :width] += mine.sum(axis=0).astype(object)
                sums[c, width] += len(mine)
        rows = [(c, d, at, part) for c in range(len(points)) for d in range(width + 1) for at, part in limbs(int(sums[c, d]))]
        if rows:
            yield pa.record_batch([pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)

    parts = kept.select("_id", "_v").mapInArrow(run, schema).groupBy("cluster", "dim", "limb").agg(F.sum("part").alias("part"))
    totals = [[0] * (width + 1) for _ in centroids]
    for r in parts.collect():  # clusters x components x parts of a number
        totals[r["cluster"]][r["dim"]] += r["part"] << (LIMB * r["limb"])
    return [[s // t[-1] for s in t[:-1]] if t[-1] else old for t, old in zip(totals, centroids)]


def assigned(kept: DataFrame, centroids: list[list[int]], width: int, scale: int) -> DataFrame:
    """``_id``, its cluster, and the squared distance (null beyond 63 bits) of every vector."""
    points = as_array(centroids, width)
    order, gaps = neighbour_lists(points)
    id_type = kept.schema["_id"].dataType
    schema = T.StructType([T.StructField("_id", id_type), T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, width, scale):
            best, near = orchard_search(x, points, order, gaps)
            far = pa.array([int(d) if d <= LONG else None for d in near.tolist()], pa.int64())
            yield pa.record_batch([ids, pa.array(best, pa.int32()), far], names=["_id", "cluster", "distance"])

    return kept.select("_id", "_v").mapInArrow(run, schema)


def centroid_clusters(vectors: DataFrame, width: int, k: int = CLUSTERS, rounds: int = ROUNDS, id_: str = "vec_id",
                      vector: str = "embedding", seed: int = SEED, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """Lloyd rounds in whole numbers: (id, cluster, distance, cluster_inertia, inertia), and the final centroids.

    Vectors that have not ``width`` components, or have one that is null, NaN or infinite,
    are left out; the others become floor(scale * x). Fewer vectors than ``k`` give as
    many centroids; none give no rows. Rows of one id are single vectors. Distances and
    sums are exact; those beyond 63 bits are null.
    """
    spark = vectors.sparkSession
    kept = stage(kept_vectors(vectors, width, id_, vector))
    centroids = first_centroids(kept, k, seed, scale)
    if not centroids:
        empty = kept.select(F.col("_id").alias(id_), F.lit(0).alias("cluster"))
        for c in ("distance", "cluster_inertia", "inertia"):
            empty = empty.withColumn(c, F.lit(None).cast("bigint"))
        return empty, []
    for _ in range(rounds):
        centroids = moved(kept, centroids, width, scale)
    rows = stage(assigned(kept, centroids, width, scale))
    found = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                        F.count_if(F.col("distance").isNull()).alias("beyond")).collect()
    sums = {r["cluster"]: None if r["beyond"] else int(r["s"]) for r in found}  # one row per cluster
    fitting = {c: s if s is not None and s <= LONG else None for c, s in sums.items()}
    total = sum(sums.values()) if None not in sums.values() else None
    total = total if total is not None and total <= LONG else None
    each = spark.createDataFrame([(c, s, total) for c, s in fitting.items()], "cluster int, cluster_inertia bigint, inertia bigint")
    return rows.join(F.broadcast(each), "cluster").select(
        F.col("_id").alias(id_), "cluster", "distance", "cluster_inertia", "inertia"), centroids


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = centroid_clusters(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 64)
    digests = spark.createDataFrame([(c, centroid_digest(v)) for c, v in enumerate(centroids)], "cluster int, centroid_sha256 string")
    return rows.join(F.broadcast(digests), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op11_sql() -> str:
    """The rounds one after the other; a vector is one row per component."""
    def nearest(i: int) -> str:
        return f"""
d{i} AS MATERIALIZED (
  SELECT v.vec_id, c.cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
  FROM v JOIN c{i} c USING (dim) GROUP BY v.vec_id, c.cluster),
a{i} AS MATERIALIZED (
  SELECT vec_id, cluster, distance FROM d{i}
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""

    parts = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT vec_id, dim, CAST(floor({SCALE} * CAST(embedding[dim] AS DOUBLE)) AS BIGINT) AS x
  FROM kept CROSS JOIN (SELECT unnest(range(1, 65)) AS dim)),
first AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster FROM kept
  QUALIFY cluster < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT cluster, dim, x FROM first JOIN v USING (vec_id))"""]
    for i in range(ROUNDS):
        parts.append(nearest(i))
        parts.append(f"""
s{i} AS MATERIALIZED (
  SELECT a.cluster, v.dim, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n FROM a{i} a JOIN v USING (vec_id) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, c.dim, coalesce((s.s - ((s.s % s.n) + s.n) % s.n) // s.n, c.x) AS x
  FROM c{i} c LEFT JOIN s{i} s ON s.cluster = c.cluster AND s.dim = c.dim)""")
    parts.append(nearest(ROUNDS))
    parts.append(f"""
h AS MATERIALIZED (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256
  FROM c{ROUNDS} GROUP BY cluster)""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN h USING (cluster)"""


OP11_SQL = _op11_sql()
