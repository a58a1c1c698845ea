import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm.cross_polytope import (
    LEAST_RECALL,
    TABLES,
    directions,
    hadamard,
    nearest_neighbours,
    own_bucket,
    probed_cells,
    probes_needed,
    rotate,
)


def brute(vectors, query, k=20):
    scores = {i: float(np.dot(vectors[query], v)) for i, v in vectors.items() if i != query}
    return sorted(scores, key=lambda i: (-scores[i], i))[:k]


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(spark, path):
    rows = spark.read.parquet(path)
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in rows.collect()}
    got = found(nearest_neighbours(rows, F.col("vec_id") % 20 == 0))
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for query, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - np.dot(vectors[query], vectors[i])) < 1e-12 for i, s in near)
        hits += len(set(brute(vectors, query)) & {i for i, _ in near})
    return hits / (20 * len(got))


def test_recall(spark):
    assert recall(spark, "/root/testdata/sf0.1/embeddings.parquet") >= 0.9


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(rotate(x, 3), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


def test_copies_ties_and_unusable_vectors(spark):
    draw = np.random.default_rng(2)
    vectors = {i: [float(v) for v in draw.normal(size=8)] for i in range(100)}
    for i in range(100, 200):
        vectors[i] = vectors[40]  # one vector held by half of the rows
    rows = [(i, v, "x") for i, v in vectors.items()]
    rows += [(200, None, "x"), (220, [0.0] * 8, "x"), (240, [float("nan")] * 8, "x"), (260, [1.0, None] * 4, "x")]
    rows += [(280, [], "x"), (300, [1.0, 2.0], "x"), (301, [2.0, 2.0], "x"), (None, vectors[1], "x"), rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, bucket string").withColumn("class", F.lit(1))
    got = found(nearest_neighbours(df, F.col("vec_id") % 20 == 0, probe_share=1.0))
    for query in range(0, 200, 20):
        assert [i for i, _ in got[query]] == brute({i: np.array(v) for i, v in vectors.items()}, query)
    assert [i for i, _ in got[300]] == [301]
    assert set(got) == {*range(0, 200, 20), 300}


def test_inner_products_of_unequal_lengths(spark):
    draw = np.random.default_rng(3)
    vectors = {i: draw.normal(size=32) * (1 + i % 7) for i in range(600)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    vectors = {i: v.astype("f4").astype("f8") for i, v in vectors.items()}
    got = found(nearest_neighbours(df, F.col("vec_id") % 20 == 0))
    hits = [len(set(brute(vectors, q)) & {i for i, _ in near}) for q, near in got.items()]
    assert sum(hits) / (20 * len(hits)) >= 0.9


def share_found(spark, vectors):
    """Recall by the default parameters, each query against the 20 best or all other rows."""
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = found(nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0))
    shares = []
    for query in range(0, len(vectors), 20):
        scores = vectors @ vectors[query]
        scores[query] = -np.inf
        best = set(np.argsort(-scores, kind="stable")[: min(20, len(vectors) - 1)].tolist())
        shares.append(len(best & {i for i, _ in got.get(query, [])}) / len(best))
    return float(np.mean(shares))


@pytest.mark.parametrize("width, norms", [(64, "one long"), (64, "lognormal"), (768, "unit")])
def test_recall_does_not_hang_on_norms_and_components(spark, width, norms):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(4600, width))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if norms == "one long":
        vectors[7] *= 10
    elif norms == "lognormal":
        vectors *= draw.lognormal(size=(len(vectors), 1))
    assert share_found(spark, vectors) >= 0.9


@pytest.mark.parametrize("count", [10, 15, 21])
def test_few_vectors_are_all_candidates(spark, count):
    assert share_found(spark, np.random.default_rng(count).normal(size=(count, 64))) == 1.0


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 2.0])]])
def test_no_candidates(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert nearest_neighbours(df, F.col("vec_id") % 20 == 0).count() == 0


def work(vectors):
    """Recall, and pairs compared as a share of all, by the number of buckets that the neighbours ask for."""
    x, asked = directions(vectors), np.arange(0, len(vectors), 20)
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :20]
    needed = probes_needed(np.repeat(x[asked], 20, axis=0), x[best.reshape(-1)], TABLES)
    probes = int(np.ceil(np.quantile(needed, LEAST_RECALL)))
    own = [own_bucket(x, table) for table in range(TABLES)]
    met, pairs = np.zeros((len(asked), len(x)), bool), 0
    for rows, tables, cells, places in probed_cells(x[asked], TABLES, probes):
        for row, table, cell, place in zip(rows, tables, cells, places, strict=True):
            hit = (own[table][0] == cell) & ((place >> own[table][1]) & 1 == 1)
            met[row] |= hit
            pairs += int(hit.sum())
    return np.take_along_axis(met, best, axis=1).mean(), pairs / met.size


def test_hashing_compares_fewer_pairs_the_more_rows(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    vectors = np.array([r["embedding"] for r in rows], float)
    shares = []
    for count in (500, 2000):
        found, share = work(vectors[:count])
        assert found >= 0.93
        shares.append(share)
    assert shares[1] < shares[0] and shares[1] <= 0.6
