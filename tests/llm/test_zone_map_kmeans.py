import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm.zone_map_kmeans import candidates, hilbert_keys, zone_map_kmeans

SCHEMA = "vec_id long, embedding array<float>, id int, cluster string, x string"


def brute(rows, clusters, rounds, dimensions, scale=1024, seed=3):
    kept = [(i, v) for i, v, *_ in rows if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, np.floor(np.array(v, np.float32).astype(float) * scale).astype(np.int64)) for i, v in kept]
    name = lambda e: (e[0] is None, hashlib.sha256(f"{seed}:{e[0]}".encode()).hexdigest() if e[0] is not None else "", list(e[1]))
    centroids = [v for _, v in sorted(whole, key=name)[:clusters]]

    def assign():
        return [min((int(((v - c) ** 2).sum()), k) for k, c in enumerate(centroids)) for _, v in whole]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(whole, found, strict=True) if c == k]
            if own:
                centroids[k] = np.array([sum(int(v[i]) for v in own) // len(own) for i in range(dimensions)])
    found = assign()
    per = {k: sum(d for d, c in found if c == k) for k in range(len(centroids))}
    total = sum(d for d, _ in found)
    shas = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, per[k], total, shas[k]) for (i, _), (d, k) in zip(whole, found, strict=True)), key=str)


def made(seed, count, dimensions):
    draw = random.Random(seed)
    centres = [[draw.uniform(-1, 1) for _ in range(dimensions)] for _ in range(4)]
    rows = []
    for i in range(count):
        centre = draw.choice(centres)
        rows.append((i, [x + draw.gauss(0, 0.2) for x in centre]))
    rows += [(count + i, rows[3][1]) for i in range(40)]  # many equal vectors
    rows += [(3, rows[3][1]), (None, rows[5][1]), (900, None), (901, []), (902, [1.0]), (903, [float("nan")] * dimensions)]
    rows += [(904, [None] * dimensions), (905, [float("inf")] + [0.0] * (dimensions - 1))]
    return [(*r, 1, "c", "y") for r in rows]


def answers(found):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[c] for c in names) for r in found.collect()), key=str)


@pytest.mark.parametrize(("dimensions", "block_rows"), [(6, 16), (64, 256)])
def test_equals_brute_force(spark, dimensions, block_rows):
    rows = made(dimensions, 300, dimensions)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = zone_map_kmeans(vectors, clusters=5, rounds=6, dimensions=dimensions, block_rows=block_rows)
    assert answers(found) == brute(rows, 5, 6, dimensions)


def test_few_and_no_vectors(spark):
    rows = made(2, 10, 4)[:2]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert answers(zone_map_kmeans(vectors, dimensions=4)) == brute(rows, 8, 10, 4)
    assert zone_map_kmeans(vectors.limit(0), dimensions=4).count() == 0
    assert zone_map_kmeans(vectors, dimensions=5).count() == 0
    with pytest.raises(ValueError):
        zone_map_kmeans(vectors.withColumn("embedding", F.array(*[F.lit(1e9).cast("float")] * 4)), dimensions=4)


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for dimensions, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
        keys = hilbert_keys(grid, bits)
        assert len(set(keys)) == len(grid)
        path = grid[sorted(range(len(grid)), key=keys.__getitem__)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_candidates_hold_the_nearest():
    draw = np.random.default_rng(4)
    for _ in range(200):
        rows, centroids = draw.integers(-50, 50, (7, 3)) + draw.integers(-200, 200, 3), draw.integers(-250, 250, (9, 3))
        close = candidates(rows.min(axis=0), rows.max(axis=0), centroids)
        distances = ((rows[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        for row in distances:
            assert set(np.flatnonzero(row == row.min())) <= set(close)
