"""Column formulas of the ranking model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals kept in a score. Ranking uses the rounded value, so the order does not depend on
#: the order in which partial sums arrive.
SCORE_DECIMALS = 8


def term_frequency(count: Column, total: Column, stored_precision: bool = False) -> Column:
    """Share of a word among the tokens of its document.

    ``stored_precision`` gives the 32-bit value rounded half-even to six decimals that a
    single-precision store would hold; the default is the exact double.
    """
    ratio = count.cast("double") / total.cast("double")
    if stored_precision:
        return F.bround(ratio.cast("float"), 6).cast("float")
    return ratio


def inverse_document_frequency(n_documents: Column, document_count: Column) -> Column:
    """``ln(N / (df + 1))``: 0 when all documents but one have the word, negative when all have."""
    return F.log(n_documents.cast("double") / (document_count + 1).cast("double"))


def mean_score(total: Column, n_tokens: Column) -> Column:
    return F.round(total / n_tokens.cast("double"), SCORE_DECIMALS)
