"""Running totals and last values along a sorted table of any size.

The rows are range-partitioned by group and order, so a large group spans many partitions. Totals run
within a partition; what lies before a partition of a group comes from one row per partition and
group. No window ever holds more than a partition's rows of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.session import materialise, partitions_for


def ranged(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` written in ranges of (group, order), with the number of its range as ``_range``.

    Writing fixes the ranges: they come from a sample, and every later step has to see the same ones.
    """
    dealt = df.repartitionByRange(partitions_for(df.sparkSession), group, *order)
    return materialise(dealt.withColumn("_range", F.spark_partition_id()), name)


def _within(group: str, order: list[str]):
    return Window.partitionBy("_range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _earlier_ranges(group: str):
    return Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)


def running_totals(df: DataFrame, group: str, order: list[str], amounts: dict[str, Column], name: str) -> DataFrame:
    """``df`` with, per amount, a column of its sum over the earlier rows of the group.

    ``order`` should be unique within a group; ties keep all rows, in some order of their own.
    """
    rows = ranged(df.select("*", *[v.cast("bigint").alias(f"_{k}") for k, v in amounts.items()]), group, order, name)
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    order = [*order, "_row"]
    sums = rows.groupBy(group, "_range").agg(*[F.sum(f"_{k}").alias(f"_{k}") for k in amounts])
    before = sums.select(
        F.col(group).alias("_group"),
        F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(f"_{k}").over(_earlier_ranges(group)), F.lit(0)).alias(f"_base_{k}") for k in amounts],
    )
    inside = rows.select(
        "*", *[F.coalesce(F.sum(f"_{k}").over(_within(group, order)), F.lit(0)).alias(f"_in_{k}") for k in amounts]
    )
    joined = inside.join(before, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return joined.select(*df.columns, *[(F.col(f"_base_{k}") + F.col(f"_in_{k}")).alias(k) for k in amounts])


def last_before(df: DataFrame, group: str, order: list[str], value: Column, alias: str, name: str) -> DataFrame:
    """``df`` with the last non-null ``value`` among the earlier rows of the group."""
    rows = ranged(df.withColumn("_value", value), group, order, name)
    lasts = rows.groupBy(group, "_range").agg(
        F.max(F.when(F.col("_value").isNotNull(), F.struct(*order, "_value"))).alias("_last")
    )
    carried = lasts.select(
        F.col(group).alias("_group"),
        F.col("_range").alias("_of"),
        F.last("_last._value", ignorenulls=True).over(_earlier_ranges(group)).alias("_carried"),
    )
    inside = rows.withColumn("_near", F.last("_value", ignorenulls=True).over(_within(group, order)))
    joined = inside.join(carried, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return joined.select(*df.columns, F.coalesce("_near", "_carried").alias(alias))
