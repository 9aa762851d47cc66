"""Spans to service edges: the parent join and its scopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import zero_id


def service_calls(spans: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """(src, dst, n) per pair of services: n spans of dst have a parent in src. Spans with
    no parent, a zero one or one of the same service make no edge. scope: columns
    within which ids are unique (a trace or a file), besides the id itself.

    One equi-join; the pair counts combine before their shuffle."""
    child = spans.where(F.col("parent_id").isNotNull() & ~zero_id(F.col("parent_id").cast("string"))).select(*scope, F.col("parent_id").cast("string").alias("id"), F.col("service").alias("dst"))
    parent = spans.where("span_id is not null").select(*scope, F.col("span_id").cast("string").alias("id"), F.col("service").alias("src"))
    pairs = child.join(parent, [*scope, "id"]).where("src <> dst")
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("n"))


def service_edges(spans: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    return service_calls(spans, scope).select("src", "dst")
