"""The first rows that fit a budget together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def within_budget(rows: DataFrame, order: str, size: str, budget: int, ranges: int = 200) -> DataFrame:
    """(order, size, running) of the rows, by `order`, whose running sum is within the
    budget. Sizes are summed per range of `order` first, so the running sum is taken
    only over the ranges that begin before the budget ends."""
    own = rows.select(order, size)
    ends = own.agg(F.min(order).alias("lo"), F.max(order).alias("hi"))
    bucket = F.floor((F.col(order) - F.col("lo")) * ranges / (F.col("hi") - F.col("lo") + 1))
    placed = own.crossJoin(F.broadcast(ends)).withColumn("bucket", bucket)
    sums = placed.groupBy("bucket").agg(F.sum(size).alias("s"))  # at most `ranges` rows
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("bucket", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base")).where(F.col("base") <= budget)
    within = Window.partitionBy("bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(F.broadcast(starts), "bucket").withColumn("running", F.col("base") + F.sum(size).over(within))
    return out.where(F.col("running") <= budget).select(order, size, "running")
