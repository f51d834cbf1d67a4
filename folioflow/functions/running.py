"""Running sums over ordered rows of which one key may hold most."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged


def _running(rows: DataFrame, keys: list[str], order: list[str], values: list[str], merge, start) -> DataFrame:
    """Adds before_<value>: what `merge` makes of a key's earlier rows; `start` without any, or null."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(rows.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    own = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*keys, "_range").agg(*[merge(v).alias(v) for v in values])
    bases = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"), *[merge(v).over(earlier).alias(f"_base_{v}") for v in values])
    inside = dealt.select("*", *[merge(v).over(own).alias(f"_own_{v}") for v in values])
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    both = lambda v: merge_two(F.col(f"_base_{v}"), F.col(f"_own_{v}"))
    merge_two = (lambda a, b: F.coalesce(a, F.lit(start)) + F.coalesce(b, F.lit(start))) if merge is F.sum else F.greatest
    return inside.join(bases, same).select(*rows.columns, *[both(v).cast("long").alias(f"before_{v}") for v in values])


def running_sums(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Adds before_<value>: the sum of a key's rows that come earlier, 0 without any. Keys and order together have to be unique.

    Rows are dealt by ranges of (keys, order), so a key with most of the rows is spread over many ranges. Each
    range sums up its own rows; the ranges' totals, a row per key and range, give what lies before each range.
    """
    return _running(rows, keys, order, values, F.sum, 0)


def running_max(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds before_<value>: the largest value of a key's earlier rows, null without any; dealt like running_sums."""
    return _running(rows, keys, order, [value], F.max, None)
