"""Centroid clustering in whole numbers, by SQL expressions alone.

A vector is kept if it has the asked number of components, all of them finite numbers, and each component
becomes the integer ``floor(scale * x)``. Distances, sums and means are integers from then on, so the
result depends neither on the order of rows nor on how they lie on the cluster.

The centroids are a literal array of arrays in the plan, ``clusters * dimensions`` numbers: a row finds its
cluster without a join. A round sums the components of each cluster in one aggregation, whose partial
results are ``clusters`` rows for each task, and the driver reads ``clusters`` rows.

Null vectors, other lengths, and vectors with a null or non-finite component are left out. Repeated rows are
vectors of their own, and so are rows that share an id. Null ids come last among the possible first
centroids; equal ids are ordered by their integers. Ties of distance go to the smaller cluster number. With
fewer kept vectors than clusters every vector is a first centroid; an empty table gives no rows. An empty
cluster keeps its centroid. A component of ``2 ** 27`` or more after scaling raises an error, since squared
distances would no longer fit in a long. Columns besides ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitmetrics.sources.workspace import stage

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
#: Written before a vector's id when first centroids are drawn.
SALT = "1"
#: Integers stay below this, so that 64 squared differences fit in a long.
LARGEST = 1 << 27


def integer_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and ``vector``, the integers of every kept row."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    too_large = F.raise_error(F.lit(f"a component is {LARGEST} or more after scaling")).cast("int")
    whole = F.transform(
        x, lambda v: F.when(F.abs(v) < LARGEST / scale, F.floor(v * scale).cast("int")).otherwise(too_large)
    )
    kept = embeddings.where(F.coalesce((F.size(x) == dimensions) & finite, F.lit(False)))
    return kept.select("vec_id", whole.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, salt: str = SALT) -> list[list[int]]:
    """The vectors whose ``salt:vec_id`` has the smallest SHA-256 digests, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.select("vector", digest.alias("digest"))
    return [r["vector"] for r in chosen.orderBy(F.asc_nulls_last("digest"), "vector").limit(clusters).collect()]


def _literal(centroids: list[list[int]]) -> str:
    return "array(" + ", ".join("array(" + ", ".join(f"{c}L" for c in row) + ")" for row in centroids) + ")"


def nearest(centroids: list[list[int]]) -> Column:
    """The struct (distance, cluster) of the centroid nearest to ``vector``."""
    return F.expr(
        f"array_min(transform({_literal(centroids)}, (c, k) -> struct("
        "aggregate(zip_with(vector, c, (x, y) -> (x - y) * (x - y)), 0L, (s, d) -> s + d) as distance,"
        " k as cluster)))"
    )


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: the floor of each mean, and empty clusters as they were."""
    columns = [F.sum(F.col("vector")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    assigned = vectors.select("vector", nearest(centroids)["cluster"].alias("cluster"))
    after = list(centroids)
    for row in assigned.groupBy("cluster").agg(F.count("*").alias("n"), *columns).collect():
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(len(columns))]
    return after


@dataclass(frozen=True)
class Clustering:
    """``vectors`` has vec_id, cluster and distance; ``inertia`` the summed distance of each cluster."""

    vectors: DataFrame
    centroids: list[list[int]]
    inertia: list[int]


def cluster_vectors(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    salt: str = SALT,
) -> Clustering:
    """Lloyd's rounds over all kept vectors; the integers are written once and read in every round."""
    vectors = stage(integer_vectors(embeddings, dimensions, scale), "integer_vectors")
    centroids = first_centroids(vectors, clusters, salt)
    if not centroids:
        return Clustering(vectors.selectExpr("vec_id", "0 as cluster", "0L as distance"), [], [])
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    found = vectors.select("vec_id", nearest(centroids).alias("found"))
    found = stage(found.select("vec_id", "found.cluster", "found.distance"), "clusters")
    inertia = [0] * len(centroids)
    for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect():
        inertia[row["cluster"]] = row["inertia"]
    return Clustering(found, centroids, inertia)


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_table(found: Clustering) -> DataFrame:
    """Every kept vector with the figures of its cluster; these are ``clusters`` literals in the plan."""
    listed = ", ".join(f"{n}L" for n in found.inertia)
    digests = ", ".join(f"'{centroid_digest(c)}'" for c in found.centroids)
    return found.vectors.selectExpr(
        "vec_id",
        "cluster",
        "distance",
        f"get(cast(array({listed}) as array<bigint>), cluster) as cluster_inertia",
        f"{sum(found.inertia)}L as inertia",
        f"get(cast(array({digests}) as array<string>), cluster) as centroid_sha256",
    )
