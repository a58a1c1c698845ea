"""Tokeniser and query-text expressions, built from native column functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stopwords, punctuation marks, letters and separators that define a token.
STOPWORDS = (
    "a", "an", "the", "and", "or", "but", "if", "while", "with", "to", "of", "for", "in", "on",
    "at", "by", "from", "as", "is", "are", "was", "were", "be", "been", "being", "it", "this",
    "that", "these", "those", "i", "you", "he", "she", "they", "we", "me", "him", "her", "them",
    "my", "your", "his", "their", "our", "so", "because", "what", "which", "who", "whom",
)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = "\t\n\x0b\f\r"


def clean_text(text: Column) -> Column:
    """Fold ASCII case, turn every separator into a space and delete ASCII punctuation.

    One ``translate`` does all three: characters without a counterpart are deleted. ``lower()``
    would also fold non-ASCII letters, which tokens keep as written.
    """
    return F.translate(
        F.coalesce(text, F.lit("")),
        UPPER + SEPARATORS + PUNCTUATION,
        LOWER + " " * len(SEPARATORS),
    )


def is_token(word: Column) -> Column:
    return (word != "") & ~word.isin(*STOPWORDS)


def tokens(text: Column) -> Column:
    """The ordered token list of a text, duplicates kept."""
    return F.filter(F.split(clean_text(text), " "), is_token)


def decode_query(raw: Column) -> Column:
    """Undo URL encoding of a logged query; an encoded plus separates words like a plain one.

    A percent sign without two hex digits stands for itself.
    """
    escaped = F.regexp_replace(raw, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.replace(F.url_decode(escaped), F.lit("+"), F.lit(" "))


def is_valid_query(query: Column, max_bytes: int | None = None) -> Column:
    """Not missing, not empty and, with ``max_bytes``, not longer than that."""
    size = F.octet_length(query)
    valid = (size >= 1) if max_bytes is None else size.between(1, max_bytes)
    return F.coalesce(valid, F.lit(False))
