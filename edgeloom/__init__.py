"""edgeloom: structural analysis of directed graphs on Spark DataFrames.

Names are imported when they are first asked for, so that Python workers, which import
this package for the functions that they run, load nothing else."""

from importlib import import_module

__version__ = "0.2.0"

#: What the package gives, by module.
_EXPORTS = {
    "functions.text": ("canonical", "edge_set_key"),
    "operators.drift": ("drift", "risk_changes", "top_changes"),
    "operators.edges": ("alias", "dedupe", "normalize", "validate", "what_if"),
    "operators.graph": ("RoundsError", "break_cycles", "depth", "fanout", "layers", "path_share", "prune", "reach", "throughput", "weak_components"),
    "operators.measures": ("MEASURES", "Compared", "Measured", "Rule", "apply_rules", "compare", "mean_reach", "measures", "simulate"),
    "operators.risks": ("by_category", "by_severity", "cards", "has_critical", "headline", "markdown", "ranked", "report"),
    "operators.spans": ("service_edges",),
    "schema": ("EdgeError", "NodeLimitError"),
    "sources": ("from_directory", "graph_documents", "text_edges"),
    "tools": ("TOOLS", "pasted"),
}
_HOME = {name: module for module, names in _EXPORTS.items() for name in names}
__all__ = sorted(_HOME)


def __getattr__(name: str):
    if name not in _HOME:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f"{__name__}.{_HOME[name]}"), name)


def __dir__() -> list[str]:
    return sorted([*globals(), *_HOME])
