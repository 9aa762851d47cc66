"""A stream of spans as windowed service edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_edges(spans: DataFrame, late: str = "10 minutes", apart: str = "5 minutes", window: str = "1 minute") -> DataFrame:
    """(window, src, dst, n) from a stream (or table) of spans (trace_id, span_id, parent_id,
    service, ts): repeats within the watermark go, a child meets its parent within `apart`,
    and pairs are counted in tumbling windows of the child's time. State is bounded by
    the watermark; spans later than it are dropped."""
    s = spans.withWatermark("ts", late)
    if spans.isStreaming:
        s = s.dropDuplicatesWithinWatermark(["trace_id", "span_id"])
    p = s.select(F.col("trace_id").alias("p_trace"), F.col("span_id").alias("p_id"), F.col("service").alias("src"), F.col("ts").alias("p_ts"))
    c = s.where("parent_id is not null").select("trace_id", "parent_id", F.col("service").alias("dst"), "ts")
    near = F.expr(f"ts between p_ts - interval {apart} and p_ts + interval {apart}")
    pairs = c.join(p, (F.col("trace_id") == F.col("p_trace")) & (F.col("parent_id") == F.col("p_id")) & near).where("src <> dst")
    return pairs.groupBy(F.window("ts", window), "src", "dst").agg(F.count("*").alias("n"))
