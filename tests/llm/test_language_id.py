import random
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from lexspark.llm import tokenising
from lexspark.llm.language_id import UNKNOWN, LanguageModel, Sizes, fit_languages, keep_identified, predict_language


@pytest.fixture(scope="module")
def model(spark):
    return fit_languages(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_accuracy_on_the_fold_that_was_held_out(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    hits = found.filter("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert hits.first()[0] >= 0.98


def brute(text, dictionaries):
    """Sizes by a fresh compressor per chunk."""
    data = b"\n" + text.lower().encode() + b"\n"
    data = data * max(1, -(-64 // len(data))) if len(data) < 64 else data
    sizes = {}
    for lang, content in dictionaries.items():
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        sizes[lang] = 0
        for start in range(0, len(data), 64):
            options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            sizes[lang] += len(zstandard.ZstdCompressor(level=5, dict_data=held, **options).compress(data[start : start + 64]))
    best = min(sizes, key=lambda lang: (sizes[lang], lang))
    second = min(n for lang, n in sizes.items() if lang != best)
    return best, 1 - sizes[best] / second


def test_answers_are_those_of_separate_compressors(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["text"] and len(r["text"]) < 3000}
    found = {r["doc_id"]: r for r in predict_language(docs, model).collect()}
    compared = 0
    for i, text in texts.items():
        if found[i]["lang_pred"] != UNKNOWN:
            lang, margin = brute(text, model.dictionaries)
            assert (found[i]["lang_pred"], found[i]["score"]) == (lang, pytest.approx(margin))
            compared += 1
    assert compared > 50


def test_clean_documents_stay(spark, model):
    for name, fitted in (("sf0.001", None), ("sf0.01", model)):
        docs = spark.read.parquet(f"/root/testdata/{name}/documents.parquet")
        clean = spark.read.parquet(f"/root/testdata/{name}/labels.parquet").filter("quality = 1")
        kept = keep_identified(docs.join(clean.select("doc_id"), "doc_id", "left_semi"), fitted or fit_languages(docs))
        assert kept.count() >= 0.98 * docs.join(clean, "doc_id", "left_semi").count()


def test_unlearned_languages_and_noise_are_rejected(model):
    draw = random.Random(3)
    letters = "bcdfghjklmnpqrstvwxz"
    words = lambda marks, n: " ".join("".join(draw.choices(marks, k=7)) for _ in range(n))
    texts = [
        "il governo italiano ha approvato ieri sera la nuova legge sulle pensioni che entrerà in vigore il prossimo anno",
        "rząd polski przyjął wczoraj wieczorem nową ustawę o emeryturach która wejdzie w życie w przyszłym roku",
        "".join(draw.choices("0123456789abcdef", k=300)),
        words(letters, 40),
        words(letters + "aeiouy0123456789", 40),
    ]
    assert [Sizes(model).classify(t)[2] for t in texts] == [False] * len(texts)


def test_limits_depend_on_length_and_ties_are_rejected(model):
    assert [start for start, _, _ in model.limits] == [0, 32, 64, 128, 256]
    assert all(margin > 0 and ratio < float("inf") for _, margin, ratio in model.limits)
    equal = LanguageModel({"a": b"the same text", "b": b"the same text"}, model.limits)
    assert Sizes(equal).classify("the same text again, and again") == ("a", 0.0, False)


def test_fit_does_not_see_what_is_held_out(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.when(F.crc32(F.col("id").cast("string")) % 5 == 0, "secret").otherwise("open").alias("text"),
        F.lit("en").alias("lang"),
    )
    assert b"secret" not in fit_languages(docs).dictionaries["en"]


def test_odd_and_no_documents(odd_docs, no_docs):
    fitted = fit_languages(odd_docs)
    rows = {r["doc_id"]: r for r in predict_language(odd_docs, fitted).collect()}
    assert set(fitted.dictionaries) == {"en"}
    assert [rows[i]["lang_pred"] for i in (2, 3, 4, 6)] == [UNKNOWN] * 4
    assert rows[0]["lang_pred"] == "en" and 0 <= rows[0]["score"] <= 1
    kept = keep_identified(odd_docs, fitted)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 4
    assert fit_languages(no_docs).dictionaries == {}
    assert predict_language(odd_docs, LanguageModel({}, [])).filter("accepted").count() == 0
    assert predict_language(no_docs, fitted).count() == 0


def test_a_worker_forgets_the_words_of_the_packing(monkeypatch):
    monkeypatch.setattr(tokenising, "_loaded", {})
    tokenising.word_tokenizer(public_tokenizers.path("word_bpe_49k.json")).encode(["a b c"])
    docs = SimpleNamespace(columns=["text"], schema=None, mapInArrow=lambda clear, schema: clear)
    clear = keep_identified(docs, LanguageModel({}, []))
    kept = list(clear(iter([pa.RecordBatch.from_pydict({"text": ["a b c"]})])))
    assert [b.num_rows for b in kept] == [0] and not tokenising._loaded
