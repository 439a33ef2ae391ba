"""Reusable DataFrame operators: joins, top-1 per key, trees, attribute pivots."""
