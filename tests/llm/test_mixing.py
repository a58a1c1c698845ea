from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexspark.llm.mixing import mix_documents, mixing_order, schedule


def brute(blocks, weights):
    """Earliest deadline first, slot by slot, from the given weights."""
    done, slots, slot = dict.fromkeys(blocks, 0), {}, 0
    name = lambda s: (s is None, str(s))
    for group in ({s for s in blocks if weights.get(s)}, {s for s in blocks if not weights.get(s)}):
        while active := sorted((s for s in group if done[s] < blocks[s]), key=name):
            share = {s: Fraction(weights.get(s) or 1) for s in active}
            total, base, count = sum(share.values()), slot, dict.fromkeys(active, 0)
            while all(done[s] < blocks[s] for s in active):
                ready = [s for s in active if count[s] * total // share[s] <= slot - base]
                due = {s: -(-(count[s] + 1) * total // share[s]) for s in ready}
                source = min(ready, key=lambda s: (due[s], active.index(s)))
                slots[source, done[source]] = slot
                count[source] += 1
                done[source] += 1
                slot += 1
    return slots


def worst_deviation(rows, weights):
    """The largest distance of a source from its share of the given weights, at every prefix of a phase.

    A source is furthest ahead right after and furthest behind right before one of its own blocks.
    """
    worst, by_phase = 0.0, defaultdict(list)
    for source, _, _, phase in rows:
        by_phase[phase].append(source)
    for sources in by_phase.values():
        total, count = sum(weights[s] for s in set(sources)), Counter()
        for place, source in enumerate(sources):
            share = weights[source] / total
            worst = max(worst, abs(place * share - count[source]))
            count[source] += 1
            worst = max(worst, abs((place + 1) * share - count[source]))
        for source in set(sources):
            worst = max(worst, abs(len(sources) * weights[source] / total - count[source]))
    return worst


@settings(max_examples=40, deadline=None)
@given(
    st.dictionaries(
        st.sampled_from(["a", "b", "c", "d", None]), st.tuples(st.integers(1, 60), st.floats(0, 25)), min_size=1
    )
)
def test_schedule_is_that_of_earliest_deadlines(sources):
    blocks, weights = {s: n for s, (n, _) in sources.items()}, {s: w for s, (_, w) in sources.items()}
    assert {(s, b): slot for s, b, slot, _ in schedule(blocks, weights)} == brute(blocks, weights)


def test_less_than_a_block_from_the_given_weights_with_many_sources():
    weights = {f"s{i}": 1 for i in range(3000)} | {"large": 3000}
    rows = list(schedule({s: 50_000 if s == "large" else 17 for s in weights}, weights))
    assert len(rows) == 50_000 + 3000 * 17
    first = [r for r in rows if r[3] == 0]
    assert len(first) > 90_000 and worst_deviation(first, weights) < 1


def test_less_than_a_block_from_uneven_weights():
    weights = {"a": 0.1, "b": 1e-4, "c": 2**0.5, "d": 3.3}
    rows = list(schedule({"a": 9000, "b": 40, "c": 90_000, "d": 200_000}, weights))
    phase = {s for s, _, _, p in rows if p == 0}
    assert phase == set(weights) - ({"b"} - phase) and worst_deviation([r for r in rows if r[3] == 0], weights) < 1


def test_every_document_gets_its_slot(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    weights = {f"src{i}": i * 0.7 for i in range(40)}
    rows = mixing_order(docs, weights=weights, block_bytes=5000).collect()
    texts = {r["doc_id"]: r for r in docs.collect()}
    assert Counter(r["doc_id"] for r in rows) == Counter(texts.keys())
    streams = defaultdict(list)
    for r in rows:
        assert r["source"] == texts[r["doc_id"]]["source"]
        assert r["size"] == max(1, len(texts[r["doc_id"]]["text"].encode()))
        streams[r["source"]].append((r["start"], r["size"], r["block"], r["slot"]))
    sizes = {}
    for source, stream in streams.items():
        place = 0
        for start, size, block, _ in sorted(stream):
            assert start == place and block == start // 5000
            place += size
        sizes[source] = place
    slots = brute({s: -(-n // 5000) for s, n in sizes.items()}, weights)
    assert all(slot == slots[s, block] for s, stream in streams.items() for _, _, block, slot in stream)


def test_blocks_grow_with_the_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing_order(docs, block_bytes=1, max_slots=50).collect()
    assert len(rows) == docs.count()
    total = sum(r["size"] for r in rows)
    assert all(r["block"] == r["start"] // -(-total // 50) for r in rows)
    assert max(r["slot"] for r in rows) < 50 + len({r["source"] for r in rows})


def test_weights_of_nothing_and_wrong_weights(odd_docs):
    for weights in ({}, {"s0": 0.0, "s1": 0.0}):
        assert mixing_order(odd_docs, weights=weights).count() == odd_docs.count()
    later = mixing_order(odd_docs, weights={"s0": 1.0}, block_bytes=10).collect()
    assert max(r["slot"] for r in later if r["source"] == "s0") < min(r["slot"] for r in later if r["source"] != "s0")
    for wrong in (-1.0, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mixing_order(odd_docs, weights={"s0": wrong})


def test_mixed_documents_keep_rows_and_columns(odd_docs, no_docs):
    mixed = mix_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(mixed.collect(), key=key) == sorted(odd_docs.collect(), key=key)
    assert mix_documents(no_docs).count() == 0 and mixing_order(no_docs).count() == 0
    assert {r["source"] for r in mixing_order(odd_docs).collect()} == {None, "s0", "s1"}
