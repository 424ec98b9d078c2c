"""Queries over the given tables; importing this registers all of them."""

from . import layout_queries, note_queries, queries

__all__ = ["layout_queries", "note_queries", "queries"]
