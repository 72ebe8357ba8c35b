"""Text forms of the evidence maps, needed only where rows leave as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def map_text(entries: Column) -> Column:
    """JSON text of a list of (position, value) pairs, by position."""
    return F.to_json(F.map_from_entries(F.array_sort(entries)))


def quoted_values(text: Column) -> Column:
    """Every quoted value that follows a colon in a printed map."""
    return F.regexp_extract_all(text, F.lit(':"([^"]*)"'), 1)


def bare_values(text: Column) -> Column:
    """Every unquoted value in a printed map, the last one included."""
    return F.regexp_extract_all(text, F.lit(r":([^,}\"]+)[,}]"), 1)
