import glob

import models
import pytest

from lexspark.plans import catalog
from lexspark.session import SORT_SPLIT_BYTES, scratch_path, small_splits
from lexspark.sources.store import DocumentStore


@pytest.fixture
def store(spark):
    return DocumentStore(spark, scratch_path(spark, "store"), id_type="bigint")


@pytest.fixture
def text_store(spark):
    return DocumentStore(spark, scratch_path(spark, "store"))


def docs(spark, *rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "doc_id bigint")


def texts_of(store):
    return {r.doc_id: r.text for r in store.documents().collect()}


def postings_of(store):
    return {(r.doc_id, r.word): r.word_frequency for r in store.postings().collect()}


def test_an_empty_store_answers(store):
    assert texts_of(store) == {} and postings_of(store) == {}
    assert store.idf().count() == 0
    assert store.search("apple").count() == 0


def test_insert_gives_new_ids_and_keeps_copies(spark, text_store):
    batch = spark.createDataFrame([("apple pear",), ("apple pear",), ("the of",), (None,)], "text string")
    commit = text_store.insert(batch)
    keys = [r.doc_id for r in text_store.inserted(commit).collect()]
    assert len(set(keys)) == 2 and all(len(k) == 36 for k in keys)
    assert {k for k, _ in postings_of(text_store)} == set(keys)
    assert sorted(r.text for r in text_store.rejected().collect()) == ["", "the of"]
    first = keys[0]
    assert [r.text for r in text_store.get(first).collect()] == ["apple pear"]
    assert text_store.get("no-such-id").count() == 0


def test_upsert_replaces_whole_documents(spark, store):
    store.upsert(docs(spark, (1, "apple pear"), (2, "plum")))
    store.upsert(docs(spark, (1, "cherry"), (3, "melon")))
    assert texts_of(store) == {1: "cherry", 2: "plum", 3: "melon"}
    assert postings_of(store) == models.index(texts_of(store).items())


def test_upsert_without_tokens_has_no_effect(spark, store):
    store.upsert(docs(spark, (1, "apple pear")))
    store.upsert(docs(spark, (1, "the -- a"), (2, None)))
    assert texts_of(store) == {1: "apple pear"}
    assert sorted((r.doc_id, r.text, r.reason) for r in store.rejected().collect()) == [
        (1, "the -- a", "no_tokens"), (2, "", "no_tokens"),
    ]


def test_one_row_per_id_counts(spark, store):
    turns = spark.createDataFrame([(1, "apple one", 1), (1, "apple two", 2), (2, "pear", 1)], "doc_id bigint, text string, turn int")
    store.upsert(turns, order_col="turn")
    assert texts_of(store) == {1: "apple two", 2: "pear"}
    assert postings_of(store) == models.index(texts_of(store).items())
    with pytest.raises(Exception, match="no order"):
        store.upsert(turns.select("doc_id", "text"))
    assert texts_of(store) == {1: "apple two", 2: "pear"}


def test_writers_at_the_same_time_keep_both(spark, store, monkeypatch):
    store.append(docs(spark, (1, "apple")))
    monkeypatch.setattr(store, "_next", lambda: 2)  # both saw the same last number
    store.append(docs(spark, (10, "pear")))
    store.append(docs(spark, (20, "plum")))
    monkeypatch.undo()
    assert set(texts_of(store)) == {1, 10, 20} and [c["number"] for c in store.commits()] == [1, 2, 2]


def test_rejected_bodies_are_kept(spark, text_store):
    bodies = ['{"text":"apple"}', '{"text":5}', "bad", '{"text":"the"}', "{}"]
    text_store.insert_json(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert sorted((r.reason, r.text) for r in text_store.rejected().collect()) == [
        ("malformed", "bad"), ("no_tokens", ""), ("no_tokens", "the"), ("not_a_string", '{"text":5}'),
    ]
    text_store.compact()
    assert text_store.rejected().count() == 4 and text_store.documents().count() == 1


def test_delete_cascades_and_reports(spark, store):
    before = docs(spark, (1, "apple pear"), (2, "plum"))
    store.upsert(before)
    kept = postings_of(store)
    store.upsert(docs(spark, (9, "apple")))
    assert store.delete(ids(spark, 9, 9, 77)) == 1
    assert store.delete(ids(spark, 9)) == 0
    assert postings_of(store) == kept
    assert store.search("apple").count() == 0 or [r.doc_id for r in store.search("apple").collect()] == [1]
    assert store.get(9).count() == 0
    store.upsert(docs(spark, (9, "back")))
    assert texts_of(store)[9] == "back"


def test_a_key_counts_once(spark, store):
    assert store.upsert(docs(spark, (1, "apple")), key="batch-0") is not None
    assert store.upsert(docs(spark, (1, "pear")), key="batch-0") is None
    assert texts_of(store) == {1: "apple"}


def test_unlisted_changes_stay_invisible(spark, store):
    store.upsert(docs(spark, (1, "apple")))
    store._fill("left-behind", store._judged(docs(spark, (5, "ghost"))), False)
    assert set(texts_of(store)) == {1}
    store.upsert(docs(spark, (2, "pear")))
    assert set(texts_of(store)) == {1, 2}


def test_changes_apply_in_order(spark, store):
    store.upsert(docs(spark, (1, "apple"), (2, "plum")))
    changes = spark.createDataFrame(
        [(1, "first", "upsert", 1), (1, "second", "upsert", 2), (2, None, "delete", 3), (3, "x", "upsert", 4), (3, None, "delete", 5)],
        "doc_id bigint, text string, op string, seq int",
    )
    store.apply_changes(changes)
    assert texts_of(store) == {1: "second"}


def test_compaction_changes_nothing_visible(spark, store):
    store.upsert(docs(spark, (1, "apple pear"), (2, "plum"), (3, "melon")))
    store.upsert(docs(spark, (2, "cherry")))
    store.delete(ids(spark, 3))
    store.refresh_idf()
    state = texts_of(store), postings_of(store), store.search("cherry apple").collect()
    store.compact()
    assert (texts_of(store), postings_of(store), store.search("cherry apple").collect()) == state
    assert len(store.commits()) == 1  # earlier changes are not read again
    store.delete(ids(spark, 1))
    assert set(texts_of(store)) == {2}
    store.refresh_idf()
    assert {r.word: r.idf for r in store.idf().collect()} == pytest.approx(models.idf(postings_of(store)))


def test_idf_snapshots(spark, store):
    store.upsert(docs(spark, (1, "apple"), (2, "pear"), (3, "apple plum")))
    store.refresh_idf()
    first = {r.word: r.idf for r in store.idf().collect()}
    assert first == pytest.approx(models.idf(postings_of(store)))
    store.delete(ids(spark, 2))
    assert {r.word for r in store.idf().collect()} == {"apple", "pear", "plum"}
    store.refresh_idf(retain_missing=True)
    kept = {r.word: r.idf for r in store.idf().collect()}
    assert kept["pear"] == first["pear"] and kept["apple"] != first["apple"]
    store.refresh_idf()
    assert {r.word for r in store.idf().collect()} == {"apple", "plum"}


def test_search_uses_the_last_snapshot(spark, store):
    store.upsert(docs(spark, (1, "apple"), (2, "pear")))
    store.refresh_idf()
    store.upsert(docs(spark, (3, "melon")))
    assert [(r.doc_id, r.score, r.text) for r in store.search("melon").collect()] == [(3, 0.0, "melon")]


def test_batch_search_over_a_store(spark, store):
    store.upsert(docs(spark, (1, "apple pear"), (2, "pear plum"), (3, "plum")))
    store.refresh_idf()
    queries = spark.createDataFrame([(1, "plum"), (2, "apple pear")], "query_id int, text string")
    rows = sorted(store.batch_search(queries).collect(), key=lambda r: (r.query_id, r["rank"]))
    for query_id, text in [(1, "plum"), (2, "apple pear")]:
        alone = [tuple(r) for r in store.search(text).collect()]
        assert [(r.doc_id, r.score, r.text) for r in rows if r.query_id == query_id] == alone


def test_stored_precision(spark):
    store = DocumentStore(spark, scratch_path(spark, "store"), id_type="bigint", stored_precision=True)
    store.upsert(docs(spark, (1, "a1 b1 c1")))
    assert dict(store.postings().dtypes)["word_frequency"] == "float"
    assert {round(r.word_frequency, 6) for r in store.postings().collect()} == {0.333333}


def test_a_change_that_is_published_during_a_compaction_stays(spark, store, monkeypatch):
    store.append(docs(spark, (1, "apple pear"), (2, "plum"), (3, "melon")))
    store.delete(ids(spark, 3))
    compacted = store._compacted

    def interrupted(seen, change):
        store.upsert(docs(spark, (4, "cherry"), (1, "fig")))
        store.delete(ids(spark, 2))
        return compacted(seen, change)

    monkeypatch.setattr(store, "_compacted", interrupted)
    store.compact()
    assert texts_of(store) == {1: "fig", 4: "cherry"}
    monkeypatch.setattr(store, "_compacted", compacted)
    store.append(docs(spark, (5, "lime")))
    store.compact()
    assert texts_of(store) == {1: "fig", 4: "cherry", 5: "lime"}
    assert len(store.commits()) == 1 and store.snapshot().total_documents() == 3
    store.refresh_idf()
    assert {r.word: r.document_count for r in store.idf().collect()} == {"fig": 1, "cherry": 1, "lime": 1}


def test_unknown_operations_are_errors(spark, store):
    schema = "doc_id bigint, text string, op string, seq int"
    for op in ("UPSERT", "merge", None):
        rows = [(1, "apple", "upsert", 1), (2, "pear", op, 2)]
        with pytest.raises(Exception, match="unknown operation"):
            store.apply_changes(spark.createDataFrame(rows, schema))
    assert texts_of(store) == {} and store.commits() == []


def test_rows_without_an_id_are_rejected(spark, store):
    store.upsert(docs(spark, (None, "apple"), (None, "pear"), (1, "plum")))
    store.append(docs(spark, (None, "fig"), (2, "lime")))
    rows = [(None, "kiwi", "upsert", 1), (None, None, "delete", 2), (3, "date", "upsert", 3)]
    store.apply_changes(spark.createDataFrame(rows, "doc_id bigint, text string, op string, seq int"))
    assert texts_of(store) == {1: "plum", 2: "lime", 3: "date"}
    lost = sorted((r.text, r.reason) for r in store.rejected().collect())
    assert lost == [(t, "no_id") for t in ("apple", "fig", "kiwi", "pear")]


def test_idf_snapshots_by_id_and_time(spark, store):
    store.append(docs(spark, (1, "apple pear"), (2, "plum")))
    first = store.refresh_idf()
    store.append(docs(spark, (3, "apple plum"), (4, "lime")))
    second = store.refresh_idf()
    store.compact()
    made = {r.snapshot_id: r.computed_at for r in store.idf_snapshots().collect()}
    assert set(made) == {first, second}
    old = {r.word: r.document_count for r in store.idf(first).collect()}
    assert old == {"apple": 1, "pear": 1, "plum": 1}
    assert {r.word for r in store.idf(made[first]).collect()} == set(old)
    assert {r.word for r in store.idf(made[second]).collect()} == {"apple", "pear", "plum", "lime"} == {r.word for r in store.idf().collect()}
    assert store.idf("none").count() == 0
    scores = {r.doc_id: r.score for r in store.search("lime apple", as_of=first).collect()}
    assert scores[4] == 0 and set(scores) == {1, 3, 4}


def test_documents_have_bloom_filters_on_their_ids(spark, store):
    store.append(docs(spark, *[(i, f"word{i}") for i in range(50)]))
    change = store.commits()[0]["id"]
    pattern = f"{store.path}/changes/{change}/documents/*.parquet"
    jvm, conf, files = spark._jvm, spark._jsc.hadoopConfiguration(), glob.glob(pattern)
    assert files
    for file in files:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        for block in reader.getFooter().getBlocks():
            assert block.getColumns()[0].getBloomFilterOffset() > 0
        reader.close()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deletions_that_hide_nothing_are_not_joined(spark, store):
    store.upsert(docs(spark, (1, "apple pear"), (2, "plum"), (3, "melon")))
    assert "Join" not in plan_of(store.postings())  # its ids replace nothing
    store.upsert(docs(spark, (1, "cherry"), (4, "quince plum")))
    store.delete(ids(spark, 2, 9))
    assert {r.doc_id for r in store.snapshot().deletions.collect()} == {1, 2, 4}
    want = {1: "cherry", 3: "melon", 4: "quince plum"}
    assert texts_of(store) == want
    store.compact()
    assert texts_of(store) == want and "Join" not in plan_of(store.postings())
    counts = {r.word: r.document_count for r in store.snapshot().word_counts().collect()}
    assert counts == {"cherry": 1, "melon": 1, "quince": 1, "plum": 1}
    store.upsert(docs(spark, (3, "fig")))
    assert texts_of(store) == want | {3: "fig"}


def test_upsert_moves_no_texts(spark, store, monkeypatch):
    plans = {}
    write = DocumentStore._write

    def watched(self, df, table, change):
        plans[table] = plan_of(df)
        return write(self, df, table, change)

    monkeypatch.setattr(DocumentStore, "_write", watched)
    store.upsert(docs(spark, (1, "apple pear"), (None, "plum")))
    assert "Exchange" not in plans["documents"]
    with pytest.raises(Exception, match="several rows and no order for id 7"):
        store.upsert(docs(spark, (7, "fig"), (8, "fig"), (7, "the of")))
    assert texts_of(store) == {1: "apple pear"}


def test_tasks_that_sort_postings_read_small_splits(spark, store, monkeypatch):
    limit, seen = (lambda: spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()), {}
    before = limit()
    write = DocumentStore._write

    def watched(self, df, table, change):
        seen[table] = limit()
        return write(self, df, table, change)

    monkeypatch.setattr(DocumentStore, "_write", watched)
    store.append(docs(spark, (1, "apple pear")))
    assert before > SORT_SPLIT_BYTES and seen["postings"] == SORT_SPLIT_BYTES
    with pytest.raises(ValueError), small_splits(spark):
        raise ValueError
    assert limit() == before == seen["documents"]


def test_inserted_texts_move_once(spark):
    folder = scratch_path(spark, "tables")
    rows = [("apple pear",), ("apple pear",), ("the of",), (None,), ("",), ("plum plum fig",)]
    spark.createDataFrame(rows, "text string").write.parquet(f"{folder}/documents.parquet")
    made = catalog.insert_generated(spark, folder)
    assert made.columns == ["text", "n_documents", "n_postings"]
    assert sorted(map(tuple, made.collect())) == [("", 2, 0), ("apple pear", 2, 4), ("plum plum fig", 1, 2), ("the of", 1, 0)]
    final = plan_of(made).split("== Initial Plan ==")[0]
    assert "hashpartitioning(text" not in final
