import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer
from tokenizers.models import WordLevel

from lexspark.llm import token_files
from lexspark.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_round_trip_gives_all_ids_in_order(spark, sf_dir, ids_of):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    found = {r["doc_id"]: r for r in token_files.round_trip(docs, PATH).collect()}
    start = 0
    for row in docs.orderBy("doc_id").collect():
        ids, got = ids_of(row["text"]), found.pop(row["doc_id"])
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found


def test_rows_are_views_of_the_file(spark, sf_dir, ids_of):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write_token_files(docs, PATH, folder, row_tokens=64).orderBy("part").collect()
    assert sum(m["n_docs"] for m in manifest) == docs.count()
    ordered = np.concatenate([ids_of(r["text"]) for r in docs.orderBy("doc_id").collect()])
    start = 0
    for m in manifest:
        part, start = ordered[start : start + m["n_tokens"]], start + m["n_tokens"]
        tokens = token_files.TokenFile(folder, m["ids_file"], m["docs_file"])
        for number in {0, len(part) // 64 // 2, (len(part) - 1) // 64}:
            ids, mask = tokens.row(number)
            used = part[64 * number : 64 * number + 64]
            assert not ids.flags.owndata and ids.dtype == np.uint16 and len(ids) == len(mask) == 64
            assert mask.true_count == len(used) and list(ids[: len(used)]) == list(used)


def test_odd_and_no_documents(odd_docs, no_docs):
    rows = token_files.round_trip(odd_docs, PATH).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in odd_docs.collect())
    assert [b["start"] - a["start"] for a, b in zip(rows, rows[1:], strict=False)] == [r["n_tokens"] for r in rows[:-1]]
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[2] == 1
    assert token_files.round_trip(no_docs, PATH).count() == 0


def test_every_row_is_reached_by_its_number():
    """Also when documents end inside and beyond batches."""
    sink = pa.BufferOutputStream()
    writer = token_files.RowWriter(sink, "uint32", 4)
    draw, all_ids = np.random.default_rng(1), []
    step = token_files.BATCH_ROWS * 4
    for size in (3, step + 6, 1, 2 * step, step - 5, 7):
        all_ids.append(draw.integers(0, 1 << 20, size, "u4"))
        writer.add(all_ids[-1])
    writer.close()
    ids = np.concatenate(all_ids)
    tokens = token_files.TokenFile.__new__(token_files.TokenFile)
    tokens.ids = pa.ipc.open_file(sink.getvalue())
    count = -(-len(ids) // 4)
    for number in (0, 1, *(n * token_files.BATCH_ROWS + d for n in (1, 2, 3) for d in (-1, 0, 1)), count - 1):
        row, mask = tokens.row(number)
        used = ids[4 * number : 4 * number + 4]
        assert list(row[: len(used)]) == list(used) and mask.true_count == len(used)
    for number in (-1, count, count + step):
        with pytest.raises(IndexError):
            tokens.row(number)


def test_ids_are_as_wide_as_the_vocabulary_needs(tmp_path):
    assert token_files.id_width(PATH) == "uint16"
    assert token_files.id_width(PATH, end_id=1 << 16) == "uint32"
    words = {f"w{i}": i for i in range(70_000)}
    Tokenizer(WordLevel(words, unk_token="w0")).save(str(tmp_path / "wide.json"))
    assert token_files.id_width(str(tmp_path / "wide.json")) == "uint32"
