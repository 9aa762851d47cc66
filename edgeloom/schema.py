"""Record shapes and enums."""

from __future__ import annotations

from pyspark.sql import types as T

EDGES = T.StructType([
    T.StructField("graph_id", T.StringType()), T.StructField("src", T.StringType()), T.StructField("dst", T.StringType()),
    T.StructField("weight", T.DoubleType()), T.StructField("source", T.StringType()), T.StructField("ord", T.LongType()),
])
SPANS = "trace_id string, span_id string, parent_id string, service string, ts timestamp"
RISKS = "graph_id string, node string, category string, severity string, description string, value double"
DIMENSIONS = ("depth", "independence", "hierarchy", "throughput", "criticality", "fanout")
VECTORS = "graph_id string, node string, " + ", ".join(f"{d} double" for d in DIMENSIONS)
SEVERITIES = ("critical", "warning", "info")
#: Risk categories.
CATEGORIES = ("SINGLE_POINT_OF_FAILURE", "AMPLIFICATION_RISK", "CONVERGENCE_SINK", "DEEP_BOTTLENECK", "MONITORING_GAP_CANDIDATE")


class EdgeError(ValueError):
    """An edge list that can't be used: too few edges, blank ends or a shape that isn't known."""


class NodeLimitError(EdgeError):
    """A graph with more nodes than the caller allows."""
