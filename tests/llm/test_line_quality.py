import re
from collections import Counter

from lexspark.llm.line_quality import NAVIGATION, SUSPECT, clean_documents, line_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_figures_equal_brute_force(spark, sf_dir, odd_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(
        odd_docs.select("doc_id", "text")
    )
    texts = {}
    for row in docs.collect():
        texts.setdefault(row["doc_id"], set()).add(brute(row["text"]))
    rows = line_quality(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got in texts[r["doc_id"]]
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_labels_of_quality_are_followed(spark, sf_dir):
    found = line_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("NOT base_failed").collect()
    assert all(r["kept"] == bool(r["quality"]) for r in rows)


def test_lines_are_judged_one_by_one(spark):
    good = "This is a line of prose with enough words in it, and it ends as it should."
    bad = ["home | news | sport | more", "All rights reserved.", "no end of a sentence here", "BUY!! NOW!! HERE!! OK."]
    other = "A second one follows here: other words altogether, yet no less a sentence than that."
    text = "\n".join([good, *bad, other])
    docs = spark.createDataFrame([(1, text, 3, "x")], "doc_id long, text string, n_chars int, extra string")
    row = clean_documents(docs).first()
    assert row["text"].split("\n") == [good, other]
    assert row["n_chars"] == len(row["text"]) and row["extra"] == "x"
    mostly_bad = spark.createDataFrame([(1, "\n".join([*bad * 5, good]), 0)], "doc_id long, text string, n_chars int")
    assert not line_quality(mostly_bad).first()["kept"]


def test_odd_and_no_documents(odd_docs, no_docs):
    rows = line_quality(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["base_failed"] for r in rows if r["doc_id"] in (2, 3, 4, 5))
    assert clean_documents(odd_docs).columns == odd_docs.columns
    assert line_quality(no_docs).count() == 0


def test_every_navigation_mark_is_suspect():
    pattern, edges = re.compile(NAVIGATION.replace("\\z", "\\Z")), ["", *" \t\n\x0b\f\r"]
    texts = [f"{a}{mark}{b}" for mark in "|»›·•>/" for a in edges for b in edges]
    assert all(pattern.search(t) for t in texts)
    assert [t for t in texts if not any(part in t for part in SUSPECT)] == []


def test_sentences_of_other_scripts_are_prose(spark):
    ends = ["यह एक साधारण वाक्य है।", "هل هذه جملة بسيطة؟", "یہ ایک سادہ جملہ ہے۔", "这是 一个 简单的 句子。", "Սա պարզ նախադասություն է։"]
    lines = [f"{' '.join(f'{end[:-1]}{i}' for i in range(6))}{end[-1]}" for end in ends]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r["doc_id"]: (r["base_failed"], r["kept"], r["kept_chars"] == r["word_chars"]) for r in line_quality(docs).collect()}
    assert found == {i: (False, True, True) for i in range(len(lines))}
