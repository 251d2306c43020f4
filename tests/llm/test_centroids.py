import hashlib
import math
import random

import numpy as np
import pytest

from splitmetrics.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, vector string, found string, digest string"


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, *"abcd") for i, v in rows], SCHEMA).repartition(partitions)


def brute(rows, clusters, rounds, dimensions):
    kept = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    drawn = sorted(kept, key=lambda r: ("g" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in drawn[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        middle = [
            [sum(column) // len(groups[k]) for column in zip(*groups[k], strict=True)] if k in groups else c
            for k, c in enumerate(middle)
        ]
    found = [(i, *near(v)) for i, v in kept]
    inertia = [sum(d for _, d, k in found if k == j) for j in range(len(middle))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, k, d, inertia[k], sum(inertia), shas[k]) for i, d, k in found), key=repr)


def result(spark, rows, **options):
    found = centroids.cluster_table(centroids.cluster_vectors(table(spark, rows), **options))
    assert found.dtypes == [
        ("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"),
        ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"),
    ]
    return sorted(map(tuple, found.collect()), key=repr)


def vectors(seed, count, dimensions):
    draw = random.Random(seed)
    spots = [[draw.gauss(0, 1) for _ in range(dimensions)] for _ in range(5)]
    return [[s + draw.gauss(0, 0.3) for s in draw.choice(spots)] for _ in range(count)]


@pytest.mark.parametrize("clusters, rounds", [(16, 3), (3, 1), (1, 2)])
def test_equals_direct_computation(spark, clusters, rounds):
    nan, inf = float("nan"), float("inf")
    rows = [(7 * k + 1, v) for k, v in enumerate(vectors(1, 150, 6))]
    rows += rows[:20] + [(None, rows[3][1]), (5, rows[4][1]), (5, rows[9][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 5), (903, [nan] * 6), (904, [inf] + [0.0] * 5), (905, [None] * 6)]
    single = [(i, None if v is None else [None if x is None else np.float32(x).item() for x in v]) for i, v in rows]
    assert result(spark, rows, clusters=clusters, rounds=rounds, dimensions=6) == brute(single, clusters, rounds, 6)


def test_ties_and_few_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.5, 0.0]), (3, [0.25, 0.0])] + [(4, [0.25, 0.0])] * 3
    assert result(spark, rows, dimensions=2) == brute(rows, 16, 3, 2)
    same = [(k, [0.5, -0.5]) for k in range(40)]
    found = result(spark, same, dimensions=2)
    assert found == brute(same, 16, 3, 2)
    assert {r[1] for r in found} == {0}


def test_empty_and_out_of_range(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None), (2, [1.0])]) == []
    with pytest.raises(Exception, match="after scaling"):
        result(spark, [(1, [1e30, 0.0])], dimensions=2)


def test_plan_has_no_python_and_no_join(spark):
    found = centroids.cluster_table(centroids.cluster_vectors(table(spark, [(1, [0.1] * 64), (2, [0.2] * 64)])))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan
