"""Hierarchical packing of documents into sequences of several lengths.

Lengths form tiers (powers of two up to the longest). Whole windows of the longest tier are cut from long
documents first. What is left of each document is routed to the shortest tier that holds it; windows
are opened from the longest tier down, and the gap of a window is filled from shorter tiers: with the
largest remainder that fits, and at last with a cut that fits exactly. So every window is full but the
last of a task, whose tokens are split over shorter tiers; fewer tokens than the shortest tier are all
that may need padding. Finished sequences are dealt to step groups of nearly equal token counts.

Each task packs the documents of its own partition, in rounds of ``ROUND_TOKENS`` tokens with what is open
carried on, so nothing is shuffled, memory is bounded, and a lost task is packed again the same way.

Defined results: null and empty texts are one token (the end id); repeated rows are packed once each;
documents of any length are cut; an empty table gives no pieces. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lexspark.llm.tokenising import END_ID, word_tokenizer

TIERS = (128, 256, 512, 1024, 2048)
ROUND_TOKENS = 1_000_000
STEP_TOKENS = 32 * 2048
#: Sequence and step numbers start at the task's number times this.
NUMBERS_PER_TASK = 1 << 40

SCHEMA = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_group bigint"
)


class Packer:
    """Packs (document, tokens) runs; ``Piece`` is (length, number, start) within a document."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = sorted(tiers)
        self.longest = self.tiers[-1]
        self.pool: list[tuple[int, int, int]] = []  # (length, document, start), sorted

    def tier_of(self, length: int) -> int:
        return self.tiers[bisect_right(self.tiers, length - 1)]

    def add(self, document: int, tokens: int) -> list[list[tuple[int, int, int]]]:
        """Takes a document; returns its whole windows of the longest tier."""
        whole = tokens // self.longest
        windows = [[(self.longest, document, i * self.longest)] for i in range(whole)]
        if tokens > whole * self.longest:
            insort(self.pool, (tokens - whole * self.longest, document, whole * self.longest))
        return windows

    def _take(self, gap: int) -> tuple[int, int, int] | None:
        """The largest remainder up to ``gap``, else ``gap`` tokens of the next larger one."""
        if not self.pool:
            return None
        place = bisect_right(self.pool, (gap, 1 << 62, 0))
        if place:
            return self.pool.pop(place - 1)
        length, document, start = self.pool.pop(0)
        insort(self.pool, (length - gap, document, start + gap))
        return gap, document, start

    def windows(self) -> Iterator[list[tuple[int, int, int]]]:
        """Full windows, longest tier first. What does not fill a window goes back to the pool."""
        while self.pool:
            first = self.pool.pop()
            window, gap = [first], self.tier_of(first[0]) - first[0]
            while gap:
                piece = self._take(gap)
                if piece is None:
                    break
                window.append(piece)
                gap -= piece[0]
            if gap:
                for piece in window:
                    insort(self.pool, piece)
                return
            yield window

    def rest(self) -> Iterator[list[tuple[int, int, int]]]:
        """Windows of shorter tiers from what is left at the end; only the last may not be full."""
        while self.pool:
            left = sum(length for length, _, _ in self.pool)
            gap = next((t for t in reversed(self.tiers) if t <= left), left)
            window = []
            while gap:
                piece = self._take(gap)
                window.append(piece)
                gap -= piece[0]
            yield window


def step_groups(lengths: list[int], step_tokens: int) -> list[int]:
    """A group number per sequence: longest first, each to the group with the fewest tokens."""
    count = max(1, round(sum(lengths) / step_tokens))
    heap = [(0, group) for group in range(count)]
    groups = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        tokens, group = heapq.heappop(heap)
        groups[i] = group
        heapq.heappush(heap, (tokens + lengths[i], group))
    return groups


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    end_id: int = END_ID,
    memo_words: int | None = None,
) -> DataFrame:
    """One row per piece of a document: where it lies in its document and in its sequence.

    ``memo_words`` bounds what a worker remembers: fewer words take less memory and more time.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path, memo_words)
        packer = Packer(tiers)
        base = TaskContext.get().partitionId() * NUMBERS_PER_TASK
        held: dict[int, tuple[object, bytes]] = {}  # documents with tokens that are not packed yet
        closed: list[list[tuple[int, int, int]]] = []
        numbers = {"document": 0, "sequence": base, "group": base}
        waiting = 0

        def rows() -> pa.RecordBatch:
            lengths = [sum(length for length, _, _ in window) for window in closed]
            groups = step_groups(lengths, step_tokens)
            columns: list[list] = [[] for _ in range(9)]
            for window, used, group in zip(closed, lengths, groups, strict=True):
                offset = 0
                for length, document, start in window:
                    key, ids = held[document]
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    row = (key, start, length, crc, len(ids) // 4, numbers["sequence"], offset)
                    for column, value in zip(
                        columns, (*row, packer.tier_of(used), numbers["group"] + group), strict=True
                    ):
                        column.append(value)
                    offset += length
                numbers["sequence"] += 1
            numbers["group"] += max(groups, default=-1) + 1
            closed.clear()
            still = {document for _, document, _ in packer.pool}
            for document in [d for d in held if d not in still]:
                del held[document]
            types = [id_type, *[pa.int64()] * 6, pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

        id_type, names = pa.int64(), [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = tokenizer.encode([text.as_py()], end_id)[0]
                document = numbers["document"]
                numbers["document"] += 1
                held[document] = (key.as_py(), ids)
                closed.extend(packer.add(document, len(ids) // 4))
                waiting += len(ids) // 4
                if waiting >= ROUND_TOKENS:
                    closed.extend(packer.windows())
                    yield rows()
                    waiting = 0
        closed.extend(packer.windows())
        closed.extend(packer.rest())
        if closed:
            yield rows()

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(pack, SCHEMA.format(id=id_type)).withColumnRenamed("doc_id", id_col)
