"""Language identification by compression.

Every language gets a raw-content dictionary of text in that language. A text is compressed with each of
them, in independent chunks of ``CHUNK_BYTES`` so that the dictionary counts through the whole text, and the
language with the smallest sum of sizes wins. Chunks are so short that a match in the dictionary is all that
saves bytes; a text shorter than that is repeated to fill one.

A text is rejected when its two best languages lie too close together, or when even the best dictionary saves
too little (a language that was not learned, or noise). Both limits depend on the length of the text and come
from the sample itself: half of it is judged by dictionaries of the other half.

Fitting reads a bounded sample: ``SAMPLE_ROWS`` labelled rows per language, of which at most
``PIECES_PER_ROW`` pieces of ``PIECE_CHARS`` characters go into a dictionary of ``DICTIONARY_BYTES``, and
``JUDGED_PIECES`` per language into the limits. Prediction reads every text in full and needs no shuffle.

Defined results: null texts, and texts without a letter, are ``und`` with score 0 and are rejected; equal
sizes go to the language that sorts first and are rejected; a table without labelled rows makes every text
``und``; with one language the score is 1; repeated rows get equal answers. Columns other than the named
ones pass through ``keep_identified`` as they are and are dropped by ``predict_language``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.tokenising import forget_words

UNKNOWN = "und"
FOLDS = 5
SAMPLE_ROWS = 256
PIECES_PER_ROW = 2
PIECE_CHARS = 256
DICTIONARY_BYTES = 64 * 1024
LEVEL = 5
CHUNK_BYTES = 64
#: Pieces per language that are judged by the dictionaries of the other half, and how many a limit needs at least.
JUDGED_PIECES = 128
LEAST_JUDGED = 50
#: Lengths in characters from which a limit of its own counts.
LENGTHS = (0, 32, 64, 128, 256)
#: A limit leaves this share of the judged pieces out, and some room beyond it.
LEFT_OUT = 0.01
MARGIN_ROOM, RATIO_ROOM = 0.5, 1.05
#: Margins below this are ties.
TIE = 1e-9
LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    """True for the fold that is kept out of the fitting."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass
class LanguageModel:
    """``dictionaries`` by language, and ``limits`` as (characters, least margin, greatest ratio)."""

    dictionaries: dict[str, bytes]
    limits: list[tuple[int, float, float]]


def fit_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> LanguageModel:
    """A dictionary per language and the limits, from the rows that are not held out.

    The sample is drawn by a hash of the id, so it does not depend on the order of rows. Ranking moves
    ids only; the texts of the chosen rows are fetched by a join with at most ``sample_rows`` ids per
    language.
    """
    labelled = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    labelled = labelled.filter("_lang IS NOT NULL AND _text IS NOT NULL AND _id IS NOT NULL").filter(
        ~held_out(F.col("_id"))
    )
    by_hash = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    chosen = (
        labelled.select("_id", "_lang")
        .withColumn("_rank", F.row_number().over(by_hash))
        .filter(F.col("_rank") <= sample_rows)
        .select("_id", "_lang")
        .distinct()
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ids, cuts = [], [], []
            for lang, key, text in zip(*(batch.column(c).to_pylist() for c in ("_lang", "_id", "_text")), strict=True):
                step = max(PIECE_CHARS, len(text) // PIECES_PER_ROW)
                for start in range(0, min(len(text), step * PIECES_PER_ROW), step):
                    langs.append(lang)
                    ids.append(str(key))
                    cuts.append(text[start : start + PIECE_CHARS].lower())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(ids, pa.string()), pa.array(cuts, pa.string())],
                names=["lang", "id", "piece"],
            )

    texts = labelled.join(F.broadcast(chosen), ["_id", "_lang"]).mapInArrow(
        pieces, "lang string, id string, piece string"
    )
    parts: dict[str, list[tuple[int, str]]] = {}
    for row in texts.collect():  # bounded by languages * sample_rows * PIECES_PER_ROW * PIECE_CHARS
        parts.setdefault(row["lang"], []).append((zlib.crc32(row["id"].encode()), row["piece"]))
    for found in parts.values():
        found.sort()  # by hash, so that what the dictionary has no room for is left out evenly
    return LanguageModel(_dictionaries(parts, dictionary_bytes), _limits(parts, dictionary_bytes))


def _dictionaries(parts: dict[str, list[tuple[int, str]]], dictionary_bytes: int) -> dict[str, bytes]:
    return {
        lang: "\n".join(piece for _, piece in found).encode("utf-8", "replace")[:dictionary_bytes]
        for lang, found in sorted(parts.items())
    }


def _limits(parts: dict[str, list[tuple[int, str]]], dictionary_bytes: int) -> list[tuple[int, float, float]]:
    """Limits from the pieces with an odd hash, judged by dictionaries of the others."""
    half = {lang: [x for x in found if x[0] % 2 == 0] for lang, found in parts.items()}
    sizes = Sizes(LanguageModel(_dictionaries({k: v for k, v in half.items() if v}, dictionary_bytes), []))
    limits = []
    for start, end in zip(LENGTHS, [*LENGTHS[1:], PIECE_CHARS], strict=True):
        cut = end if start == LENGTHS[-1] else (start + end) // 2
        margins, ratios = [], []
        for lang, found in parts.items():
            for _, piece in [x for x in found if x[0] % 2 and len(x[1]) >= cut][:JUDGED_PIECES]:
                if LETTER.search(piece[:cut]):
                    best, margin, ratio = sizes.measure(piece[:cut])
                    margins += [margin] if best == lang else []
                    ratios.append(ratio)
        if len(margins) < LEAST_JUDGED:
            limits.append((start, TIE, float("inf")))
            continue
        margin = max(TIE, MARGIN_ROOM * float(np.quantile(margins, LEFT_OUT)))
        limits.append((start, margin, RATIO_ROOM * float(np.quantile(ratios, 1 - LEFT_OUT))))
    return limits


class Sizes:
    """Compressed sizes of texts with each dictionary of a model."""

    def __init__(self, model: LanguageModel, level: int = LEVEL) -> None:
        self.limits = model.limits
        self.compressors = []
        for lang, content in sorted(model.dictionaries.items()):
            prepared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            prepared.precompute_compress(level=level)
            compressor = zstandard.ZstdCompressor(
                level=level,
                dict_data=prepared,
                write_checksum=False,
                write_content_size=False,
                write_dict_id=False,
            )
            self.compressors.append((lang, compressor))

    def measure(self, text: str) -> tuple[str, float, float]:
        """The language, the share by which its size is below the next one, and its size per byte of text."""
        data = f"\n{text.lower()}\n".encode("utf-8", "replace")  # framed, as the pieces of the dictionaries are
        if len(data) < CHUNK_BYTES:
            data *= -(-CHUNK_BYTES // len(data))
        chunks = [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
        sizes = sorted((sum(len(c.compress(x)) for x in chunks), lang) for lang, c in self.compressors)
        margin = 1.0 if len(sizes) == 1 else 1.0 - sizes[0][0] / sizes[1][0]
        return sizes[0][1], margin, sizes[0][0] / len(data)

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """The language, the margin, and whether both limits for the text's length are kept."""
        if not text or not self.compressors or not LETTER.search(text):
            return UNKNOWN, 0.0, False
        lang, margin, ratio = self.measure(text)
        least, most = next(((m, r) for start, m, r in reversed(self.limits) if len(text) >= start), (TIE, float("inf")))
        return lang, margin, margin >= least and ratio <= most


def predict_language(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, held_out, lang_pred, score, accepted)`` for every row; the score is the margin."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model)
        for batch in batches:
            found = [sizes.classify(x.as_py()) for x in batch.column(1)]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "lang_pred", "score", "accepted"])

    found = docs.select(id_col, text_col).mapInArrow(
        classify, f"id {id_type}, lang_pred string, score double, accepted boolean"
    )
    return found.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "accepted"
    )


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows whose language is clear, with all their columns; texts stay in their partitions."""
    place = docs.columns.index(text_col)

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        sizes = Sizes(model)
        for batch in batches:
            yield batch.filter(pa.array([sizes.classify(x.as_py())[2] for x in batch.column(place)], pa.bool_()))

    return docs.mapInArrow(clear, docs.schema)
