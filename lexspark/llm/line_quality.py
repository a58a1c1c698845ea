"""Line-first quality rules: clean the lines, then judge the document by what is left.

Each line with a word is tested by five rules: it must hold the end of a sentence, must not be
navigation (separators between words), must not be boilerplate (licence, copyright and cookie
phrases), must not be noise (symbols or doubled exclamation marks on its words), and must not repeat its
words. Lines that fail are removed. A document is rejected when its base figures fail or when it loses
more than ``max_lost_pct`` of the characters of its words.

Everything is a row-wise expression: no shuffle, no Python on the executors, and a document is judged
from itself alone. Defined results: null and empty texts, and texts without words, have zero counts and
are rejected (``base_failed``); repeated rows get equal verdicts, row by row; very long texts cost time
in proportion to ``n log n`` of their words. Other columns of the input are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import WHITE_SPACE, let, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: A document may lose this share of the characters of its words to the line rules.
MAX_LOST_PCT = 50

# The phrases of boilerplate lines, as lower-case text.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under",
    "privacy policy",
    "terms of service",
    "accept cookies",
    "use of cookies",
    "enable javascript",
    "powered by",
)

SPACE = "[\\x20\\x09-\\x0D]"
# The marks that end a sentence, in Latin, Chinese, Indic, Arabic, Armenian, Ethiopic, Burmese and Khmer texts.
SENTENCE_END = f"[.!?…。！？।॥؟۔։።၊။។][\"'”’»)\\]]*(?:{SPACE}|\\z)"
SYMBOLS = "[#*$%&|<>]"
NAVIGATION = f"(?:^|{SPACE})[|»›·•>/](?:{SPACE}|\\z)"
SHOUTS = "[!?]{2,}"
# Texts without any of these cannot break the rules on symbols, shouting and navigation.
SUSPECT = ("#", "*", "$", "%", "&", "|", "<", ">", "»", "›", "·", "•", "!!", "!?", "?!", "??", "/")


def contains_any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def repeated_positions(windows: Column) -> Column:
    """How many words lie in windows that occur twice or more; ``windows`` holds a hash per start.

    Equal hashes become neighbours by sorting (hash, start); the starts of such windows, sorted, cover
    ``WINDOW`` words each, less what the next start covers.
    """

    def covered(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))),
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def twins(ordered: Column) -> Column:
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        marked = F.transform(
            ordered,
            lambda e, i: F.when(
                ((i > 0) & same(F.get(ordered, i - 1), e)) | same(F.get(ordered, i + 1), e), e["i"]
            ),
        )
        return let(F.sort_array(F.filter(marked, lambda p: p.isNotNull())), covered)

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        let(F.array_sort(pairs), twins)
    )


def line_fails(line: Column, suspect: Column, echoes: Column, boilerplate: Column) -> Column:
    """True for a line that is not prose. ``line`` must hold a word.

    The other three say whether the document can break a rule at all; they spare its lines the work.
    """

    def noisy(count: Column) -> Column:
        return (
            (F.regexp_count(line, F.lit(SYMBOLS)) * 2 > count)
            | (F.regexp_count(line, F.lit(SHOUTS)) * 3 > count)
            | (F.regexp_count(line, F.lit(NAVIGATION)) * 4 > count)
        )

    def echoing(words: Column) -> Column:
        return F.size(F.filter(follows_itself(words), lambda same: same)) * 10 > F.size(words) * 3

    return (
        ~line.rlike(SENTENCE_END)
        | (suspect & let(F.size(words_of(line)), noisy))
        | (echoes & let(words_of(line), echoing))
        | (boilerplate & contains_any(F.lower(line), BOILERPLATE))
    )


def follows_itself(words: Column) -> Column:
    """For each word whether it is the one before it; null after the last."""
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: a == b)


def window_hashes(words: Column, n: Column) -> Column:
    """A 64-bit hash of the ``WINDOW`` (eight) words from each word on, by doubling."""

    def doubled(step: int):
        def pairs(hashes: Column) -> Column:
            ahead = F.slice(hashes, step + 1, F.greatest(n, F.lit(1)))
            return F.zip_with(hashes, ahead, lambda a, b: F.xxhash64(a, b))

        return pairs

    single = F.transform(words, lambda w: F.xxhash64(w))
    return F.slice(let(let(let(single, doubled(1)), doubled(2)), doubled(4)), 1, n - (WINDOW - 1))


def figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the figures in a struct ``_quality``, ``_base_failed``, and the lines with their flags."""
    words = words_of(F.coalesce(F.col(text_col), F.lit("")))
    lines = F.filter(
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    with_words = docs.select("*", words.alias("_words"), lines.alias("_lines"))
    n = F.size("_words")
    windows = F.when(n >= WINDOW, window_hashes(F.col("_words"), n)).otherwise(F.array().cast("array<bigint>"))
    with_windows = with_words.select(
        "*",
        windows.alias("_windows"),
        contains_any(text, SUSPECT).alias("_suspect"),
        F.exists(follows_itself(F.col("_words")), lambda x: F.coalesce(x, F.lit(False))).alias("_echoes"),
        contains_any(F.lower(text), BOILERPLATE).alias("_boilerplate"),
    )
    flags = [F.col(c) for c in ("_suspect", "_echoes", "_boilerplate")]
    with_failed = with_windows.select(
        "*",
        F.filter("_lines", lambda line: line_fails(line, *flags)).alias("_failed_lines"),
        word_chars(F.col("_words")).alias("_word_chars"),
    )
    symbols = F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    lost = F.char_length(F.regexp_replace(F.array_join("_failed_lines", " "), WHITE_SPACE, ""))
    verdict = F.struct(
        n.cast("long").alias("n_words"),
        F.col("_word_chars").alias("word_chars"),
        F.when(F.col("_suspect"), symbols).otherwise(F.lit(0)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_positions(F.col("_windows")).alias("n_repeat_words"),
        (F.col("_word_chars") - lost).alias("left"),
    )
    # No filter is pushed below an explode, so a filter on the verdict does not compute all of it again.
    counted = with_failed.select(*docs.columns, "_lines", *flags, F.explode_outer(F.array(verdict)).alias("_quality"))
    words_found, repeats = F.col("_quality.n_words"), F.col("_quality.n_repeat_words")
    failed = (words_found < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PCT * words_found)
    return counted.withColumn("_base_failed", failed)


def keeps(max_lost_pct: int) -> Column:
    return 100 * F.col("_quality.left") >= (100 - max_lost_pct) * F.col("_quality.word_chars")


def line_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost_pct: int = MAX_LOST_PCT
) -> DataFrame:
    """Per document: the base figures, ``kept_chars`` after line cleaning, and the verdict."""
    judged = figures(docs.select(id_col, text_col), text_col)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        id_col,
        *[F.col(f"_quality.{c}").alias(c) for c in names],
        F.col("_base_failed").alias("base_failed"),
        (~F.col("_base_failed") & keeps(max_lost_pct)).alias("kept"),
        F.col("_quality.left").alias("kept_chars"),
    )


def clean_documents(docs: DataFrame, text_col: str = "text", max_lost_pct: int = MAX_LOST_PCT) -> DataFrame:
    """The documents that pass, with the failed lines taken out of their texts; all columns stay."""
    judged = figures(docs, text_col)
    flags = [F.col(c) for c in ("_suspect", "_echoes", "_boilerplate")]
    cleaned = F.array_join(F.filter("_lines", lambda line: ~line_fails(line, *flags)), "\n")
    columns = [cleaned.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    passed = judged.filter(~F.col("_base_failed") & keeps(max_lost_pct)).select(*columns)
    if "n_chars" in docs.columns:
        passed = passed.withColumn("n_chars", F.char_length(text_col).cast(docs.schema["n_chars"].dataType))
    return passed
