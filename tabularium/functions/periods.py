"""Half-open periods as two columns; a NULL bound is unbounded, a NULL period means unknown and matches everything."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains(start: Column, end: Column, at: Column) -> Column:
    """Whether [start, end) holds ``at``; NULL if ``at`` is NULL."""
    return (start.isNull() | (start <= at)) & (end.isNull() | (at < end))


def overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Whether two periods share a moment; empty periods share none."""
    filled = lambda s, e: s.isNull() | e.isNull() | (s < e)
    return (start_a.isNull() | end_b.isNull() | (start_a < end_b)) & (start_b.isNull() | end_a.isNull() | (start_b < end_a)) & filled(start_a, end_a) & filled(start_b, end_b)


def within(start: Column, end: Column, outer_start: Column, outer_end: Column) -> Column:
    """Whether a period lies inside another."""
    return (outer_start.isNull() | (start.isNotNull() & (start >= outer_start))) & (outer_end.isNull() | (end.isNotNull() & (end <= outer_end)))


def is_open(end: Column) -> Column:
    """Whether a period has no end."""
    return end.isNull()


def is_empty(start: Column, end: Column) -> Column:
    """Whether a period holds no moment."""
    return F.coalesce(start >= end, F.lit(False))


def closed_at(end: Column, at: Column) -> Column:
    """The end of an open period closed at ``at``; a closed one keeps its end."""
    return F.coalesce(end, at)
