import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexspark.llm import jaccard_join
from lexspark.llm import shingles as shingles_module
from lexspark.llm.common import arrow_batches
from lexspark.llm.components import connected_components
from lexspark.llm.jaccard_join import group_runs, jaccard_components, keep_one_of_each
from lexspark.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(FOLD))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.fixture(scope="module")
def near_copies():
    """Groups of near copies around the threshold, equal texts in other letters, and a passage that many share."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(draw.choices(words, k=30))
    rows = []
    for _ in range(12):
        base = draw.choices(words, k=draw.randrange(5, 160))
        for _ in range(draw.randrange(1, 14)):
            copy = list(base)
            for _ in range(draw.randrange(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(" ".join(copy) + (" " + passage if draw.random() < 0.3 else ""))
    rows += [rows[0].upper(), rows[3] + "\t\n", "a b c", "A B  c", "a b", passage, passage]
    draw.shuffle(rows)
    return list(enumerate(rows))


def test_components_equal_brute_force(spark, near_copies):
    docs = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert found == brute(near_copies)


def test_documents_of_the_smallest_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert found == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_one_of_each_component_stays(spark, near_copies):
    docs = spark.createDataFrame([(i, t, "x") for i, t in near_copies], "doc_id long, text string, key string")
    kept = keep_one_of_each(docs.union(docs.limit(3)))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in brute(near_copies).values()})


def test_rows_with_one_id_stay_if_their_texts_differ(spark, near_copies):
    rows = [(1, "a b c"), (1, "a b c"), (1, "x y z"), (2, "a b c"), (3, "x y z w"), (None, "a b c"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_hash", F.lit(1))
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    want = [(1, "a b c"), (1, "x y z"), (3, "x y z w"), (None, "a b c"), (None, None)]
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=str) == sorted(want, key=str)


def template_rows():
    """Texts from one template that share most shingles without linking, with near copies of some."""
    draw = random.Random(8)
    frame = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(300):
        text = [*frame, *[f"v{i}x{j}" for j in range(draw.randrange(8, 14))]]
        rows.append(" ".join(text))
        if i % 20 == 0:
            rows.append(" ".join([*text, "more"]))
    return list(enumerate(rows))


def test_large_groups_of_texts_that_do_not_link(spark, monkeypatch):
    """Blocks of a few rows, and more pairs of one class than meet one copy of its set."""
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 16)
    monkeypatch.setattr(jaccard_join, "FAN_OUT", 5)
    rows = template_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert found == brute(rows)


def test_odd_and_no_documents(odd_docs, no_docs):
    rows = jaccard_components(odd_docs).collect()
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == odd_docs.count()
    assert by_id[1][1] == 0 and by_id[2] == (0, 2) and by_id[3] == (0, 3) and by_id[4] == (0, 4) and by_id[5] == (1, 5)
    assert jaccard_components(no_docs).count() == 0


def test_sets_are_those_of_the_words():
    texts = ["a b c d e f", "A B C D E F", "x", "", None, "é b  c\x0bd e", "a b c d", "ab c d e f"]
    found = list(shingle_sets(texts))
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    assert list(found[0]) == list(found[1]) and set(found[0]).isdisjoint(found[7])


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    draw = random.Random(4)
    texts = ["", " ".join("w" * draw.randrange(1, 40) + str(draw.randrange(50)) for _ in range(300)), "x" * 500, None]
    texts += [" \t".join(["ab", "C" * 300, "d\x0be", "f", "g"]) + " " * 200, "a b c", "y" * 64, " " * 300, "z" * 63]
    want = [s.tolist() for s in shingle_sets(texts)]
    for size in (16, 64, 101, 256):
        monkeypatch.setattr(shingles_module, "BLOCK_BYTES", size)
        assert [s.tolist() for s in shingle_sets(texts)] == want


def test_rows_of_a_cut_group_keep_partners_before_the_cut():
    sizes = [10, 20, 40, 80, 99, 100]  # 100 has its only partner, 99, in the part before
    columns = [pa.array([7] * 6), pa.array(sizes, pa.int32()), pa.array(range(6), pa.int64()), pa.array([0] * 6, pa.int32())]
    rows = pa.RecordBatch.from_arrays(columns, names=["token", "n", "key", "pos"])
    other = pa.RecordBatch.from_arrays([pa.array([8, 8]), *[c.slice(0, 2) for c in columns[1:]]], names=rows.schema.names)
    found = pa.Table.from_batches(group_runs(iter([rows.slice(0, 5), rows.slice(5), other]), run_rows=5)).to_pydict()
    assert set(zip(found["token"], found["n"], strict=True)) == {(7, n) for n in sizes}
    whole = pa.Table.from_batches(group_runs(iter([rows, other]), run_rows=50)).to_pydict()
    assert set(zip(whole["token"], whole["n"], strict=True)) == {(7, n) for n in sizes[3:]}


def test_long_chains_become_one_component(spark):
    edges = spark.range(1, 60).selectExpr("id AS a", "id - 1 AS b").union(spark.range(1).selectExpr("100L", "99L"))
    found = {r["node"]: r["component"] for r in connected_components(edges.toDF("a", "b")).collect()}
    assert found == {**dict.fromkeys(range(60), 0), 99: 99, 100: 99}


def test_arrow_limits_hold_inside_only(spark):
    def batch_rows():
        sizes = spark.range(0, 5000, 1, 1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint"
        )
        return [row["n"] for row in sizes.collect()]

    before = batch_rows()
    with pytest.raises(ValueError), arrow_batches(spark, 2000, "8m"):
        assert batch_rows() == [2000, 2000, 1000]
        raise ValueError
    assert batch_rows() == before


def test_histograms_never_rule_out_a_link():
    draw = np.random.default_rng(5)
    ruled_out = 0
    for size in (1, 2, 5, 31, 32, 33, 700, 5000, 200_000):
        for share in (0.0, 0.3, 0.6, 0.75, 0.8, 0.85, 0.9, 1.0):
            both = round(size * share)
            own = draw.integers(0, 1 << 63, 2 * (size - both), "u8") * np.uint64(2) + np.uint64(1)
            common = draw.integers(0, 1 << 63, both, "u8") * np.uint64(2)
            x, y = (np.unique(np.concatenate([common, part])) for part in (own[: size - both], own[size - both :][: (size - both) // 2]))
            if not len(y):
                continue
            assert jaccard_join.least_difference(*map(jaccard_join.histogram, (x, y))) <= len(np.setxor1d(x, y))
            linked = jaccard_join._overlap(len(x), len(y), x, y)
            assert linked == (100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y)))
            may = jaccard_join._may_overlap(len(x), len(y), *map(jaccard_join.histogram, (x, y)))
            assert may or not linked
            ruled_out += not may
    assert ruled_out > 10
    same = np.full(600, 1 << 60, "u8") + np.arange(600, dtype="u8")  # more than 255 in one range
    assert jaccard_join.least_difference(jaccard_join.histogram(same), jaccard_join.histogram(same[:500])) <= 100
