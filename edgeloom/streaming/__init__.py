"""Streaming edges."""

from .spans import windowed_edges

__all__ = ["windowed_edges"]
