"""Reproducible synthetic corpora and query workloads, one row per given id.

All choices come from integer arithmetic on (id, position, seed), so a row is the same on every run
and in every partitioning, and a lost task is repeated exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Vocabulary and shape of the generated texts.
POPULAR_WORDS = (
    "apple", "amazon", "google", "microsoft", "tcs", "reliance", "iitb", "facebook", "meta", "tesla",
    "nvidia", "intel", "oracle", "ibm", "flipkart", "uber", "airbnb", "zoom", "slack", "spotify",
    "twitter", "linkedin", "microsoftteams", "github", "docker", "kubernetes", "tensorflow", "pytorch",
    "scikit-learn", "opencv", "nlp", "reinforcement", "deepdream", "chatgpt", "stable-diffusion",
    "midjourney", "gpt4", "transformer", "attention", "backpropagation", "gradientdescent",
    "overfitting", "regularization", "dropout", "epoch", "batchnorm", "funnycat", "robotunicorn",
    "quantumbanana", "datawizard", "blah", "decs", "load", "testing",
)
RANDOM_WORDS = 10_000
FILLER_WORDS = 5_000
WORDS_PER_DOCUMENT = 35
LEADING_WORDS = 2
POPULAR_SHARE = 10
ALPHABET = "abcdefghijklmnopqrstuvwxyz "
CHARACTERS_PER_DOCUMENT = 1_000

#: Modulus of the mixing steps; products of two residues fit into 64 bits.
PRIME = 2_147_483_647
#: Ids are split into low and high bits here.
HALF_BITS = 30
HALF = 1 << HALF_BITS

#: Letters drawn at a time: 27 ** 6 is below the modulus.
LETTERS_PER_DRAW = 6
DIGITS_27 = "0123456789ABCDEFGHIJKLMNOPQ"


def _step(value: Column) -> Column:
    """The fifth power plus seven modulo ``PRIME``: one to one, as 5 has no factor in common with ``PRIME - 1``."""
    square = (value * value) % PRIME
    return ((square * square) % PRIME * value + 7) % PRIME


def _mix(value: Column) -> Column:
    """``_step`` of a value that is computed once: a lambda variable is, a nested expression is repeated."""
    return F.element_at(F.transform(F.array(value), _step), 1)


def _states(row_id: Column, seed: int) -> tuple[Column, Column]:
    """Two numbers below ``PRIME`` from the low and the high bits of an id, so all of it counts."""
    low = (row_id.cast("bigint").bitwiseAND(F.lit(HALF - 1)) * 48271 + (seed % PRIME) * 16807 + 1) % PRIME
    high = (F.shiftright(row_id.cast("bigint"), HALF_BITS) * 40692 + 5) % PRIME
    return _mix(_mix(low)), _mix(_mix(high))


def draw(row_id: Column, position: Column, seed: int) -> Column:
    """A number below ``PRIME`` that depends on all arguments; ``row_id`` is a non-negative integer
    below 2**60. Ids are mixed before positions are added, so no text is a shifted copy of another."""
    low, high = _states(row_id, seed)
    one, two = ((s + position * f) % PRIME for s, f in ((low, 69621), (high, 39373)))
    return (_mix(_mix(one)) + _mix(two)) % PRIME


def draws(row_id: Column, count: int, seed: int) -> Column:
    """The draws of positions 0 to ``count - 1`` as an array."""
    positions = F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))

    def from_states(states: Column) -> Column:
        one = F.transform(F.transform(positions, lambda p: (states["low"] + p * 69621) % PRIME), _step)
        two = F.transform(positions, lambda p: (states["high"] + p * 39373) % PRIME)
        return F.zip_with(F.transform(one, _step), F.transform(two, _step), lambda a, b: (a + b) % PRIME)

    low, high = _states(row_id, seed)
    return F.element_at(F.transform(F.array(F.struct(low.alias("low"), high.alias("high"))), from_states), 1)


def _popular(number: Column) -> Column:
    words = F.array(*[F.lit(w) for w in POPULAR_WORDS])
    return F.get(words, (number % len(POPULAR_WORDS)).cast("int"))


def _random(number: Column) -> Column:
    return F.concat(F.lit("word_"), (number % RANDOM_WORDS).cast("string"))


def _filler(number: Column) -> Column:
    return F.concat(F.lit("gibberish_"), (number % FILLER_WORDS).cast("string"))


def generate_word_documents(ids: DataFrame, id_col: str = "doc_id", seed: int = 0) -> DataFrame:
    """``(id, text)``: two leading words, popular in about one document of ten, then filler."""
    row = F.col(id_col)
    popular = draw(row, F.lit(WORDS_PER_DOCUMENT), seed) % POPULAR_SHARE < 1
    numbered = ids.select(id_col).select(
        id_col, popular.alias("_popular"), draws(row, WORDS_PER_DOCUMENT, seed).alias("_draws")
    )
    leading = F.when(F.col("_popular"), F.transform(F.slice("_draws", 1, LEADING_WORDS), _popular)).otherwise(
        F.transform(F.slice("_draws", 1, LEADING_WORDS), _random)
    )
    filler = F.transform(F.slice("_draws", LEADING_WORDS + 1, WORDS_PER_DOCUMENT), _filler)
    return numbered.select(
        id_col, F.concat(F.array_join(F.concat(leading, filler), " "), F.lit(" ")).alias("text")
    )


def generate_character_documents(
    ids: DataFrame, id_col: str = "doc_id", length: int = CHARACTERS_PER_DOCUMENT, seed: int = 0
) -> DataFrame:
    """``(id, text)``: uniform letters and spaces, drawn as base-27 digits."""
    count = -(-length // LETTERS_PER_DRAW)
    base = len(ALPHABET)

    def digits(number: Column) -> Column:
        shown = F.conv((number % base**LETTERS_PER_DRAW).cast("string"), 10, base)
        return F.lpad(shown, LETTERS_PER_DRAW, "0")

    text = F.array_join(F.transform(draws(F.col(id_col), count, seed), digits), "")
    cut = F.substring(text, 1, length)
    return ids.select(id_col).select(id_col, F.translate(cut, DIGITS_27, ALPHABET).alias("text"))


def generate_queries(ids: DataFrame, workload: str, id_col: str = "query_id", seed: int = 0) -> DataFrame:
    """``(id, text)``: one-word queries, ``long_tail`` over the random words or ``short_tail`` over the
    popular ones."""
    words = {"long_tail": _random, "short_tail": _popular}
    if workload not in words:
        raise ValueError(f"unknown workload {workload!r}")
    return ids.select(id_col, words[workload](draw(F.col(id_col), F.lit(0), seed)).alias("text"))
