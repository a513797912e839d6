"""Predicates of searches: periods, scopes, full text, file names, quality flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_period(date: Column, start: str | None, end: str | None) -> Column:
    """Whether a date lies from ``start`` to ``end``; without bounds everything does, with a bound nothing undated."""
    out = F.lit(True)
    if start:
        out = out & F.coalesce(date >= F.lit(start), F.lit(False))
    if end:
        out = out & F.coalesce(date <= F.lit(end), F.lit(False))
    return out


def in_scope(wanted: Mapping[str, str | None]) -> Column:
    """Whether columns have the wanted values; ``all`` and None are any."""
    out = F.lit(True)
    for column, value in wanted.items():
        if value not in (None, "all"):
            out = out & F.coalesce(F.col(column) == F.lit(value), F.lit(False))
    return out


def mentions(text: str, columns: Sequence[Column]) -> Column:
    """Whether any column contains a text, whatever the case; dates also as day/month/year. An empty text is in everything."""
    hay = F.lower(F.concat_ws(" ", *[c.cast("string") for c in columns]))
    shown = F.regexp_replace(hay, r"\b(\d{4})-(\d{2})-(\d{2})\b", "$1-$2-$3 $3/$2/$1")
    return F.contains(shown, F.lower(F.lit(text.strip())))


def file_name(url: Column) -> Column:
    """The decoded name of the file an address ends in; NULL for malformed escapes."""
    return F.try_url_decode(F.regexp_extract(url, r"([^/?#]+)(?:[?#].*)?$", 1))


def names_document(url: Column, include: str, exclude: str) -> Column:
    """Whether an address's file name fits one pattern and not another, whatever the case."""
    name = F.lower(F.coalesce(file_name(url), url))
    return name.rlike(include) & ~name.rlike(exclude)


def flags(rules: Mapping[str, Column]) -> Column:
    """The names of the rules that hold, in their order; a rule that gives NULL does not."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
