"""Token ids as Arrow files of fixed-size lists, written and read by Spark tasks.

Documents are range-partitioned and sorted by id. Every task writes its ids, end to end, into rows of
``ROW_TOKENS`` ids: an Arrow IPC file with the columns ``ids`` (fixed-size list of unsigned integers, 16 bits
wide where the vocabulary allows it) and ``mask`` (fixed-size list of booleans, false where the last row is
padded). Rows have equal lengths and the file has a footer, so a reader maps it and reaches row ``r``
without decoding or copying. A second small Arrow file per task lists its documents: id, first token,
number of tokens. Both lie in a folder that all executors share.

A task writes under a name of its own and reports it; only reported files belong to the data set, so a
task that was lost or ran twice leaves nothing behind that readers see.

Defined results: null and empty texts are one token (the end id); repeated ids keep all their rows,
ordered by a hash of their texts; an empty table gives a data set without rows; long texts run through
many rows. Other columns are not looked at.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator
from contextlib import closing

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexspark.llm.tokenising import END_ID, word_tokenizer
from lexspark.session import materialise, partitions_for, scratch_path

ROW_TOKENS = 2048
#: Rows per record batch: what a task holds before it writes.
BATCH_ROWS = 256
PAD_ID = 0
MANIFEST = "part int, ids_file string, docs_file string, n_docs bigint, n_tokens bigint"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; any file system that Arrow can open by its URI."""
    return fs.FileSystem.from_uri(path)


class RowWriter:
    """Cuts a run of ids into rows and writes them batch by batch."""

    def __init__(self, sink, width: str, row_tokens: int) -> None:
        self.row_tokens, self.dtype = row_tokens, np.dtype(width)
        value = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema(
            [("ids", pa.list_(value, row_tokens)), ("mask", pa.list_(pa.bool_(), row_tokens))]
        )
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.count = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.dtype))
        self.count += len(ids)
        if self.count >= BATCH_ROWS * self.row_tokens:
            self._write(last=False)

    def _write(self, last: bool) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.empty(0, self.dtype)
        step = BATCH_ROWS * self.row_tokens
        used = len(flat) if last else len(flat) - len(flat) % step
        rows = -(-used // self.row_tokens)
        for start in range(0, rows * self.row_tokens, step):
            ids = flat[start : min(start + step, used)]
            size = -(-len(ids) // self.row_tokens) * self.row_tokens
            padded = np.full(size, PAD_ID, self.dtype)
            padded[: len(ids)] = ids
            columns = [padded, np.arange(size) < len(ids)]
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(c), self.row_tokens) for c in columns]
            self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.waiting = [flat[used:]]
        self.count = len(flat) - used

    def close(self) -> None:
        self._write(last=True)
        self.writer.close()


def id_width(tokenizer_path: str, end_id: int = END_ID) -> str:
    greatest = max([end_id, PAD_ID, *Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values()])
    return "uint16" if greatest < 1 << 16 else "uint32"


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_tokens: int = ROW_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """Writes the data set; returns its manifest, one row per file pair, in the order of the ids.

    Ids have 16 bits if the tokenizer has none that needs more, else 32.
    """
    spark = docs.sparkSession
    width = id_width(tokenizer_path, end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        part = TaskContext.get().partitionId()
        disk, root = open_folder(folder)
        disk.create_dir(root, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        ids_file, docs_file = f"{name}.ids.arrow", f"{name}.docs.arrow"
        n_docs = n_tokens = 0
        writers: list = []
        try:
            for batch in batches:
                if not writers:  # nothing is written for a partition without rows
                    sinks = [disk.open_output_stream(posixpath.join(root, f)) for f in (ids_file, docs_file)]
                    rows = RowWriter(sinks[0], width, row_tokens)
                    places = pa.schema(
                        [("id", batch.schema.field(0).type), ("start", pa.int64()), ("n_tokens", pa.int64())]
                    )
                    writers = [rows, pa.ipc.new_file(sinks[1], places), *sinks]
                starts, lengths = [], []
                for text in batch.column(1):
                    ids = np.frombuffer(tokenizer.encode([text.as_py()], end_id)[0], "<u4")
                    writers[0].add(ids)
                    starts.append(n_tokens)
                    lengths.append(len(ids))
                    n_tokens += len(ids)
                n_docs += batch.num_rows
                columns = [batch.column(0), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())]
                writers[1].write_batch(pa.RecordBatch.from_arrays(columns, schema=places))
        finally:
            for writer in writers:
                writer.close()
        if n_docs:
            values = [[part], [ids_file], [docs_file], [n_docs], [n_tokens]]
            types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            names = ["part", "ids_file", "docs_file", "n_docs", "n_tokens"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names
            )

    ordered = (
        docs.select(id_col, text_col)
        .repartitionByRange(partitions_for(spark), id_col)
        .sortWithinPartitions(F.col(id_col), F.xxhash64(text_col))
    )
    return materialise(ordered.mapInArrow(write, MANIFEST), "token-manifest")


class TokenFile:
    """One file pair. Rows are reached by number; ids and masks are views of the mapped file."""

    def __init__(self, folder: str, ids_file: str, docs_file: str) -> None:
        disk, root = open_folder(folder)
        self.ids = pa.ipc.open_file(self._open(disk, posixpath.join(root, ids_file)))
        self.docs = pa.ipc.open_file(self._open(disk, posixpath.join(root, docs_file)))
        self.row_tokens = self.ids.schema.field("ids").type.list_size

    @staticmethod
    def _open(disk: fs.FileSystem, path: str):
        return pa.memory_map(path) if isinstance(disk, fs.LocalFileSystem) else disk.open_input_file(path)

    def close(self) -> None:
        """Views of the file stay valid as long as they are referenced."""
        self.ids = self.docs = None

    def row(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """The ids and the mask of one row. All batches but the last have ``BATCH_ROWS`` rows."""
        at, place = divmod(number, BATCH_ROWS)
        if number < 0 or at >= self.ids.num_record_batches:
            raise IndexError(number)
        batch = self.ids.get_batch(at)
        if place >= batch.num_rows:
            raise IndexError(number)
        return batch.column(0).slice(place, 1).flatten().to_numpy(), batch.column(1).slice(place, 1).flatten()

    def blocks(self) -> Iterator[np.ndarray]:
        """The ids of the file, batch by batch, without the padding."""
        for i in range(self.ids.num_record_batches):
            batch = self.ids.get_batch(i)
            used = batch.column(1).flatten().true_count
            yield batch.column(0).flatten().to_numpy()[:used]

    def documents(self) -> Iterator[tuple[object, int, int]]:
        for i in range(self.docs.num_record_batches):
            batch = self.docs.get_batch(i)
            yield from zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)

    def checksums(self) -> Iterator[tuple[object, int, int, int]]:
        """(id, first token, tokens, crc32 of the ids as 32-bit integers) in the order of the file."""
        blocks, block, used = self.blocks(), np.empty(0, "u4"), 0
        for key, start, length in self.documents():
            crc, left = 0, length
            while left:
                if used == len(block):
                    block, used = next(blocks), 0
                    continue
                piece = block[used : used + left]
                crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                used, left = used + len(piece), left - len(piece)
            yield key, start, length, crc


def read_token_files(spark: SparkSession, manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, ids_file, docs_file in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                with closing(TokenFile(folder, ids_file, docs_file)) as tokens:
                    rows: list[tuple] = []
                    id_arrow = tokens.docs.schema.field("id").type
                    for key, start, length, crc in tokens.checksums():
                        rows.append((key, base + start, length, crc))
                        if len(rows) == 10_000:
                            yield block(rows, id_arrow)
                            rows = []
                    if rows:
                        yield block(rows, id_arrow)

    def block(rows: list[tuple], id_arrow: pa.DataType) -> pa.RecordBatch:
        types = [id_arrow, pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # One task, as the manifest has one row per task of the writing job.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint").alias("base"), "ids_file", "docs_file"
    ).repartition(partitions_for(spark))
    return files.mapInArrow(read, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents to the shared folder and read them back from their files."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    manifest = write_token_files(docs, tokenizer_path, folder, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    return read_token_files(spark, manifest, folder, id_type).withColumnRenamed("doc_id", id_col)
