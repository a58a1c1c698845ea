import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lexspark.llm import tokenising
from lexspark.llm.packing import TIERS, Packer, pack_documents, step_groups
from lexspark.llm.tokenising import WordTokenizer, word_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_words_give_the_ids_of_whole_texts(spark, sf_dir, whole):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += [
        "It's don't I'll. 12.5, a.b, x., É., ”. \x1c\x85\xa0　z <|endoftext|> A<|ENDOFTEXT|> é. ́a",
        "İ. ,, ., .,a. b,c", "", None, "\n", " . ,", "a.́ b", "''s 've.", "ﬁ. Å, ｱ.",
    ]
    words = WordTokenizer(PATH)
    for _ in range(2):  # the second time from memory
        assert words.encode(texts) == [whole(t).tobytes() for t in texts]


def test_forgetting_words_changes_nothing(monkeypatch, whole):
    monkeypatch.setattr("lexspark.llm.tokenising.MEMO_WORDS", 3)
    texts = ["a b c d e", "e d c b a", "a b c d e f g"]
    assert WordTokenizer(PATH).encode(texts) == [whole(t).tobytes() for t in texts]


def test_packing_bounds_what_it_remembers(monkeypatch, whole):
    monkeypatch.setattr(tokenising, "_loaded", {})
    texts = [f"a{i} b{i} c" for i in range(50)]
    assert word_tokenizer(PATH, 3).encode(texts) == [whole(t).tobytes() for t in texts]
    assert len(word_tokenizer(PATH, 3).young) <= 3 and len(word_tokenizer(PATH, 3).old) <= 3 + 3
    assert word_tokenizer(PATH).memo_words == tokenising.MEMO_WORDS > corpus_pipeline.MEMO_WORDS


def test_the_pipeline_packs_small_batches(spark, odd_docs, monkeypatch):
    seen, keep = [], corpus_pipeline.materialise
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(
        corpus_pipeline, "materialise", lambda df, to: (seen.append(spark.conf.get(name)), keep(df, to))[1]
    )
    pieces = corpus_pipeline.packing(spark, odd_docs, "")
    assert seen == [str(corpus_pipeline.BATCH_ROWS)] and spark.conf.get(name) == before
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(pieces.collect(), key=key) == sorted(pack_documents(odd_docs, PATH).collect(), key=key)


def check(pieces, texts, whole):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = whole(texts[p["doc_id"]])
        part = ids[p["start"] : p["start"] + p["length"]]
        assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(part.tobytes())
        by_doc[p["doc_id"]].append((p["start"], p["length"]))
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    padded = 0
    for doc, found in by_doc.items():
        place = 0
        for start, length in sorted(found):
            assert start == place
            place += length
        assert place == len(whole(texts[doc]))
    for found in by_sequence.values():
        place = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == place
            place += p["length"]
        assert place <= found[0]["tier"] <= 2048
        padded += place not in TIERS
    return padded


def test_every_token_lies_in_one_piece(spark, sf_dir, whole):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    pieces = pack_documents(docs, PATH).collect()
    padded = check(pieces, {r["doc_id"]: r["text"] for r in docs.collect()}, whole)
    assert padded <= 3  # one sequence of a task may need padding


def test_odd_and_no_documents(odd_docs, no_docs, whole):
    distinct = odd_docs.dropDuplicates(["doc_id"])
    check(pack_documents(distinct, PATH).collect(), {r["doc_id"]: r["text"] for r in distinct.collect()}, whole)
    rows = pack_documents(odd_docs, PATH).filter("doc_id = 1 AND start = 0").count()
    assert rows == 2  # a repeated row is packed twice
    assert pack_documents(no_docs, PATH).count() == 0


def test_what_does_not_fill_a_window_waits():
    packer = Packer((4, 8))
    assert packer.add(0, 19) == [[(8, 0, 0)], [(8, 0, 8)]]
    assert list(packer.windows()) == [] and packer.pool == [(3, 0, 16)]
    packer.add(1, 5)
    assert list(packer.windows()) == [[(5, 1, 0), (3, 0, 16)]] and not packer.pool
    packer.add(2, 7)
    assert [sum(x for x, _, _ in w) for w in packer.rest()] == [4, 3]


def test_step_groups_are_balanced():
    lengths = [2048] * 40 + [1024] * 30 + [512] * 20
    totals = defaultdict(int)
    for length, group in zip(lengths, step_groups(lengths, 16_384), strict=True):
        totals[group] += length
    assert max(totals.values()) - min(totals.values()) <= 2048
