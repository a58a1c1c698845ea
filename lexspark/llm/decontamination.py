"""Benchmark decontamination by a prefix-filtered set join.

The sets are windows of ``WINDOW_WORDS`` consecutive words of a benchmark item (an item of fewer words is one
window), seen as their shingles of ``SHINGLE_WORDS`` words. A document contains a window only if it holds
every one of its shingles, so the prefix a window has to be joined by is one shingle: its rarest.

* Rarity is the number of times a shingle occurs in all documents. A window with a shingle that occurs
  nowhere is not joined at all.
* Documents are read once. A Bloom filter of the benchmark's shingles, of a size fixed by ``filter_bits``,
  picks the positions that count and the few documents whose words are kept. Beyond ``MAX_FILTER_BITS`` it
  lets more through, which costs time and changes no result.
* A prefix shingle found at a place gives the start of the window; the positional bound (the window does
  not start before the text) and the length bound (it does not end behind it) leave the candidates.
* A candidate counts when the words of the document at that place are those of the window, one by one.

Everything is DataFrame expressions. Only the prefixes are broadcast, below a checked size; beyond it the
documents' side of the join is salted, so that a passage in a third of all documents is no hot key.

Defined results: null and empty texts have no words and no hits, and as items no windows; items without an id
take no part; several items with one id are one item; repeated rows get their own, equal results; very long
texts are read in full; empty tables give zero hits or an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, estimated_bytes, materialise

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: ASCII characters that are no part of a word, once A-Z are folded.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_SHINGLE = 32
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 12, 1 << 24
PROBES = 3
#: Parts a hot key of the documents' side is dealt to when the other side is too large to broadcast.
SALTS = 32


def item_words(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, SEPARATORS), lambda w: w != "")


def _with_hashes(df: DataFrame, longest: int) -> DataFrame:
    """``df`` with ``_h1`` to ``_h<longest>``: a hash of that many words from each word on.

    Where fewer words are left, the value means nothing; readers stop at ``_n - length``.
    """

    def paired(first: str, second: str, step: int) -> Column:
        ahead = F.slice(F.col(second), step + 1, F.greatest(F.col("_n"), F.lit(1)))
        return F.zip_with(F.col(first), ahead, lambda a, b: F.xxhash64(a, b))

    df = df.select("*", F.transform("_words", lambda w: F.xxhash64(w)).alias("_h1"))
    for length in range(2, longest + 1):
        half = length // 2 if length % 2 == 0 else length - 1
        df = df.select("*", paired(f"_h{half}", f"_h{length - half}", half).alias(f"_h{length}"))
    return df


def _places(last: Column) -> Column:
    """0 to ``last``, or nothing when it is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item, text, w, length, offset, hash)``: every window of every item with each of its shingles."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), item_words(F.col(text_col)).alias("_words"))
    items = items.filter("item IS NOT NULL").select("*", F.size("_words").alias("_n")).filter("_n > 0")
    items = items.select("*", F.least("_n", F.lit(WINDOW_WORDS)).alias("w"))
    items = items.select("*", F.least("w", F.lit(SHINGLE_WORDS)).alias("length"))
    hashed = _with_hashes(items, SHINGLE_WORDS)
    own = F.lit(None).cast("array<bigint>")
    for length in range(1, SHINGLE_WORDS + 1):
        own = F.when(F.col("length") == length, F.col(f"_h{length}")).otherwise(own)
    starts = hashed.select("item", "_words", "w", "length", own.alias("_h"), F.explode(_places(F.col("_n") - F.col("w"))).alias("s"))
    shingles = F.transform(
        _places(F.col("w") - F.col("length")),
        lambda o: F.struct(o.alias("offset"), F.get(F.col("_h"), F.col("s") + o).alias("hash")),
    )
    return starts.select(
        "item", "w", "length", F.array_join(F.slice("_words", F.col("s") + 1, F.col("w")), " ").alias("text"),
        F.explode(shingles).alias("x"),
    ).select("item", "text", "w", "length", "x.offset", "x.hash")


def filter_bits(shingles: int) -> int:
    """A power of two near ``BITS_PER_SHINGLE`` bits each, within the two bounds."""
    return min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << (BITS_PER_SHINGLE * max(shingles, 1) - 1).bit_length()))


def _slots(value: Column, bits: int) -> list[Column]:
    return [F.shiftright(value, 20 * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


def _bloom(hashes: DataFrame) -> tuple[Column, int]:
    """A constant array of 64-bit words with the filter's bits, and how many bits there are."""
    bits = filter_bits(hashes.count())
    slots = hashes.select(F.explode(F.array(*_slots(F.col("hash"), bits))).alias("slot"))
    words = (
        slots.groupBy(F.shiftright("slot", 6).alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("word"))
        .collect()
    )  # bits / 64 rows at most
    dense = [0] * (bits // 64)
    for row in words:
        dense[row["at"]] = row["word"]
    return F.from_json(F.lit("[" + ",".join(map(str, dense)) + "]"), "array<bigint>"), bits


def _passes(value: Column, bloom: Column, bits: int) -> Column:
    found = F.lit(True)
    for slot in _slots(value, bits):
        word = F.get(bloom, F.shiftright(slot, 6).cast("int"))
        shifted = F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit(63)).cast("int"))
        found = found & (shifted.bitwiseAND(F.lit(1)) == 1)
    return found


def _spread_join(rows: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of many ``rows`` with a ``side`` of the benchmark's size, without hot keys."""
    if estimated_bytes(side) <= BROADCAST_LIMIT_BYTES:
        return rows.join(F.broadcast(side), keys)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_row", *keys), F.lit(SALTS)).cast("int"))
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def _marked_documents(docs: DataFrame, hashes: DataFrame, lengths: list[int]) -> DataFrame:
    """``(_row, id, n, words, hits)``: each document with the places of benchmark shingles.

    ``words`` is null where there is no such place.
    """
    bloom, bits = _bloom(hashes)
    marked = docs.select("id", item_words(F.col("text")).alias("_words")).select("*", F.size("_words").alias("_n"))
    marked = _with_hashes(marked, max(lengths, default=1))

    def places(length: int) -> Column:
        own = F.col(f"_h{length}")
        hit = F.filter(_places(F.col("_n") - length), lambda i: _passes(F.get(own, i), bloom, bits))
        return F.transform(
            hit, lambda i: F.struct(i.alias("pos"), F.lit(length).alias("length"), F.get(own, i).alias("hash"))
        )

    none = F.array().cast("array<struct<pos:int,length:int,hash:bigint>>")
    marked = marked.select("id", "_n", "_words", F.concat(none, *[places(n) for n in lengths]).alias("hits"))
    return marked.select(
        F.monotonically_increasing_id().alias("_row"), "id", F.col("_n").alias("n"),
        F.when(F.size("hits") > 0, F.col("_words")).alias("words"), "hits",
    )


def _covered(spans: Column) -> Column:
    """How many words lie in one or more of the ``spans`` (start, end), which come sorted."""
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("reach"))
    return F.aggregate(
        spans,
        zero,
        lambda at, s: F.struct(
            (at["total"] + F.greatest(s["end"] - F.greatest(s["start"], at["reach"]), F.lit(0))).alias("total"),
            F.greatest(at["reach"], s["end"]).alias("reach"),
        ),
        lambda at: at["total"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document ``(id, n_words, n_hit, n_items, items, spans)``.

    ``items`` are the ids of the items with a window in the document, as sorted strings; ``spans`` the
    windows' places, as (start, end) in words.
    """
    windows = materialise(benchmark_windows(benchmark, item_id_col, item_text_col), "benchmark-windows")
    hashes = windows.select("hash", "length").distinct()
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # SHINGLE_WORDS at most
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = materialise(_marked_documents(texts, hashes, lengths), "marked-documents")

    hits = marked.filter(F.size("hits") > 0).select("_row", "n", F.explode("hits").alias("h"))
    hits = hits.select("_row", "n", "h.pos", "h.length", "h.hash")
    counts = hits.groupBy("hash", "length").count()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "hash", "offset")).alias("x")
    prefixes = materialise(
        windows.select("text", "w", "length", "offset", "hash").distinct()
        .join(counts, ["hash", "length"], "left").groupBy("text", "w", "length").agg(rarest)
        .filter("x.count > 0").select("x.hash", "length", "x.offset", "text", "w"),
        "window-prefixes",
    )
    placed = _spread_join(hits, prefixes, ["hash", "length"]).select(
        "_row", "n", (F.col("pos") - F.col("offset")).alias("start"), "w", "text"
    )
    bounded = placed.filter("start >= 0 AND start + w <= n")
    candidates = bounded.groupBy("_row").agg(F.collect_set(F.struct("start", "w", "text")).alias("found"))
    same = lambda c: F.array_join(F.slice(F.col("words"), c["start"] + 1, c["w"]), " ") == c["text"]
    held = marked.filter("words IS NOT NULL").select("_row", "words").join(candidates, "_row")
    verified = held.select("_row", F.filter("found", same).alias("found")).filter(F.size("found") > 0)
    span = lambda c: F.struct(c["start"].alias("start"), (c["start"] + c["w"]).alias("end"))
    verified = materialise(
        verified.select(
            "_row",
            F.array_sort(F.array_distinct(F.transform("found", span))).alias("spans"),
            F.array_distinct(F.transform("found", lambda c: c["text"])).alias("texts"),
        ),
        "verified-windows",
    )
    named = _spread_join(
        verified.select("_row", F.explode("texts").alias("text")), windows.select("text", "item").distinct(), ["text"]
    )
    items = named.groupBy("_row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    per_row = verified.select("_row", "spans", _covered(F.col("spans")).alias("n_hit")).join(items, "_row")
    return marked.select("_row", "id", "n").join(per_row, "_row", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that hold no window of the benchmark, with all columns; an id goes as a whole."""
    hit = contamination(docs, benchmark, id_col, **options).filter("n_hit > 0").select(F.col(id_col).alias("_hit")).distinct()
    return docs.join(broadcast_if_small(hit), docs[id_col].eqNullSafe(F.col("_hit")), "left_anti")
