import hashlib
import random
import re

import pytest

from lexspark.llm import decontamination
from lexspark.llm.decontamination import contamination, filter_bits, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items):
    """Per row of ``docs`` the counts, from every window at every place."""
    windows = {}
    for item, text in items:
        ws = words(text)
        for i in range(len(ws) - min(len(ws), 10) + 1 if ws and item is not None else 0):
            windows.setdefault(tuple(ws[i : i + 10]), set()).add(str(item))
    out = []
    for doc, text in docs:
        ws, hit, named = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(ws) - size + 1):
                found = windows.get(tuple(ws[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    named |= found
        out.append((doc, len(ws), len(hit), tuple(sorted(named))))
    return sorted(out, key=str)


def answers(found):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect()), key=str)


def made_rows(seed):
    """Texts of few words, so that parts of windows recur, with items of all lengths planted in some."""
    draw = random.Random(seed)
    vocabulary = ["alpha", "beta", "GAMMA", "d1", "é", "ok", "Zeta"]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 4, 5, 6, 9, 10, 11, 25])))) for i in range(2, 12)]
    items += [(12, None), (13, " -- "), (None, items[3][1] + " more"), (3, "another text of item three"), (14, items[4][1])]
    docs = []
    for i in range(60):
        parts = [" ".join(draw.choices(vocabulary, k=draw.randrange(0, 14)))]
        if draw.random() < 0.6:
            planted = draw.choice(items)[1] or ""
            parts.append(planted[: draw.choice([len(planted), len(planted) // 2])])
        parts.append("x" * draw.randrange(0, 3) + "\t!? " + " ".join(draw.choices(vocabulary, k=draw.randrange(0, 9))))
        docs.append((i % 50, ", ".join(parts)))
    return docs, items


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_LIMIT_BYTES, 0])
def test_equals_brute_force(spark, monkeypatch, limit):
    """With prefixes that are broadcast, and with those that are too large for it."""
    monkeypatch.setattr(decontamination, "BROADCAST_LIMIT_BYTES", limit)
    docs, items = made_rows(7)
    found = contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert answers(found) == brute(docs, items)


def test_a_filter_that_lets_all_pass_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MIN_FILTER_BITS", 64)
    monkeypatch.setattr(decontamination, "MAX_FILTER_BITS", 64)
    docs, items = made_rows(8)
    found = contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert filter_bits(10**6) == 64 and answers(found) == brute(docs, items)


def test_odd_and_no_tables(spark, odd_docs, no_docs):
    rows = [(5, "very long text " * 40, "x"), (6, None, "x"), (7, "", "x"), (8, "one", "x"), (8, "one", "x")]
    items = spark.createDataFrame(rows, "item_id long, text string, hash string")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert answers(contamination(odd_docs, items)) == brute(docs, [(r[0], r[1]) for r in rows])
    assert contamination(no_docs, items).count() == 0
    assert contamination(odd_docs, items.limit(0)).filter("n_hit = 0 AND n_items = 0").count() == odd_docs.count()
    kept = without_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1


def test_spans_hold_what_was_hit(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"zero {item} twelve and {item[:46]}")], "doc_id long, text string")
    row = contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert [tuple(s) for s in row["spans"]] == [(1, 11), (2, 12)] and row["n_hit"] == 11
    assert hashlib.sha256(",".join(row["items"]).encode()).hexdigest() == hashlib.sha256(b"1").hexdigest()
