"""Column functions."""

from .text import bar, canonical, category_label, dotted_rollup, edge_set_key, kebab, module_name, short, snake, zero_id

__all__ = ["bar", "canonical", "category_label", "dotted_rollup", "edge_set_key", "kebab", "module_name", "short", "snake", "zero_id"]
