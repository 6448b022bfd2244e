"""K-means over integer vectors in Spark's own expressions: literal centroids, exact distances, column sums.

A round is one scan of the written integer vectors. zip_with and aggregate give the squared distance to each literal
centroid, array_min of (distance, number) picks the nearest, and one sum a component with partial aggregation gives the new
centroids, so that a task sends a row a cluster, however large a cluster is. Only clusters x components numbers reach the
driver. All arithmetic is exact: repeated runs, and runs over other partitions, give the same clusters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharrow.llm.scratch import materialise

#: Components beyond this size are refused, as squared distances of wide vectors would leave 64 bits.
LARGEST = 1 << 26


@dataclass
class Clustering:
    """assigned: id, cluster, distance (squared). centroids and inertia go by number."""

    assigned: DataFrame
    centroids: list[list[int]]
    inertia: list[int]


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, components: int, scale: int) -> DataFrame:
    """vec_id and x, floor(scale * component); vectors of another length, or with a null or non-finite component, are left out."""
    vector = F.col(vector_col).cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    kept = df.select(F.col(id_col).alias("vec_id"), vector.alias("v")).where((F.size("v") == components) & ~F.exists("v", bad))
    return kept.select("vec_id", F.transform("v", lambda v: F.floor(F.lit(float(scale)) * v)).alias("x"))


def nearest(x: Column, centroids: list[list[int]]) -> Column:
    """Struct of distance and cluster of the nearest centroid; of equal distances the smaller number's."""
    far = []
    for k, centroid in enumerate(centroids):
        squares = F.zip_with(x, F.lit(centroid).cast("array<bigint>"), lambda a, b: (a - b) * (a - b))
        far.append(F.struct(F.aggregate(squares, F.lit(0).cast("bigint"), lambda s, d: s + d).alias("distance"), F.lit(k).alias("cluster")))
    return F.array_min(F.array(*far))


def kmeans(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = 8, rounds: int = 10, seed: int = 3, components: int = 64, scale: int = 1024) -> Clustering:
    """Cluster all vectors of `components` finite numbers.

    Centroids start as the vectors whose ids, as "seed:id", have the least SHA-256 hashes; ids that repeat are ordered by
    their vectors, and null ids come last. Each round gives every vector to its nearest centroid and moves each non-empty
    centroid to floor(sum / count), empty ones stay; then vectors are assigned once more. With fewer vectors than clusters
    there are as many clusters as vectors; without any, the result is empty. Equal rows each keep a row. Further columns are
    ignored, whatever their names. A component over LARGEST after scaling is an error.
    """
    vectors = materialise(integer_vectors(df, id_col, vector_col, components, scale), "integer-vectors")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("x", F.abs))).alias("top")).first()
    n, top = size["n"], size["top"] or 0
    if top > LARGEST:
        raise ValueError(f"a scaled component has the size {top}; over {LARGEST}, distances don't fit in 64 bits")
    order = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256).asc_nulls_last(), F.col("x")]
    centroids = [r["x"] for r in vectors.orderBy(*order).limit(clusters).collect()]
    if not centroids:
        return Clustering(vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), [], [])
    # sums of all rows fit in 64 bits, or are taken as decimals
    total = lambda c, largest: F.sum(c if n * largest < 1 << 63 else c.cast("decimal(20,0)"))
    for _ in range(rounds):
        near = vectors.select("x", nearest(F.col("x"), centroids)["cluster"].alias("cluster"))
        sums = near.groupBy("cluster").agg(F.count("*").alias("n"), *[total(F.col("x")[i], top).alias(f"s{i}") for i in range(components)])
        for r in sums.collect():  # a row a cluster
            centroids[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(components)]
    near = vectors.select("vec_id", nearest(F.col("x"), centroids).alias("near"))
    assigned = near.select("vec_id", "near.cluster", "near.distance")
    inertia = [0] * len(centroids)
    for r in assigned.groupBy("cluster").agg(total(F.col("distance"), 4 * components * top * top).alias("inertia")).collect():
        inertia[r["cluster"]] = int(r["inertia"])
    return Clustering(assigned, centroids, inertia)
