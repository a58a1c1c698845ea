"""Exact quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one aggregation buffer. Here equal values are
counted first; the counts, sorted by group and value, are dealt out in ranges, and running totals along
them give every value its ranks. A group with many values spans many ranges, so no task and no window
holds more than one range, however the values are distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.operators.ordered import running_totals


def exact_quantiles(df: DataFrame, keys: list[str], value_col: str, probabilities: dict[str, float]) -> DataFrame:
    """``(*keys, <name>...)`` with linear interpolation between neighbours; NULLs are ignored.

    ``probabilities`` maps an output name to a share between 0 and 1. ``keys`` must not be NULL.
    """
    counts = (
        df.filter(F.col(value_col).isNotNull())
        .groupBy(F.struct(*keys).alias("_key"), F.col(value_col).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = running_totals(counts, "_key", ["_v"], {"_start": F.col("_n")}, "value-counts")
    totals = placed.groupBy("_key").agg(F.max(F.col("_start") + F.col("_n")).alias("_total"))
    ranked = placed.join(totals, "_key")

    def at(rank: Column) -> Column:
        inside = (rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_n"))
        return F.max(F.when(inside, F.col("_v")))

    sides = []
    for name, p in probabilities.items():
        position = p * (F.col("_total") - 1)
        sides += [
            at(F.floor(position)).alias(f"_{name}_lo"),
            at(F.ceil(position)).alias(f"_{name}_hi"),
            F.max(position - F.floor(position)).alias(f"_{name}_part"),
        ]
    result = ranked.groupBy("_key").agg(*sides)
    return result.select(
        *[F.col(f"_key.{k}").alias(k) for k in keys],
        *[
            (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_part")).alias(n)
            for n in probabilities
        ],
    )
