"""Entries of source lists with what is known of them: names, identifiers, addresses, series."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.distances import within

_MASK = re.compile(r"x{2,}|[*#]+")
_NUMBER = re.compile(r"\d{9,13}\Z")
_PERSON = re.compile(r"[a-z]{5,7}[a-z0-9]{8,11}\Z")
_PERSON_EXACT = re.compile(r"[a-z]{6}\d\d[a-z]\d\d[a-z]\d{3}[a-z]\Z")


def entry_names(observations: DataFrame, editions: DataFrame) -> DataFrame:
    """Distinct spellings per entry: ``entry``, ``series``, ``name``. Rows without entry, name or known edition are left out."""
    spelt = observations.filter("entry_id is not null and source_name_normalised is not null").groupBy(F.col("entry_id").alias("entry"), F.col("source_name_normalised").alias("name")).agg(F.min("edition_id").alias("edition_id"))
    return spelt.join(editions.select("edition_id", F.col("source_series_key").alias("series")), "edition_id").filter("series is not null").select("entry", "series", "name").distinct()


def by_first_row(table: DataFrame, observations: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of a table that names an entry by one of its rows, with ``entry``."""
    rows = observations.filter("entry_id is not null").select("entity_observation_id", F.col("entry_id").alias("entry"))
    return table.select("entity_observation_id", *columns).join(rows, "entity_observation_id").select("entry", *columns)


def identifier_kind(value: str) -> str:
    """``number`` for a tax number, ``person`` for a personal code, ``masked`` if part is hidden, else empty."""
    if _MASK.search(value) and not _PERSON_EXACT.match(value):
        return "masked"
    if _NUMBER.match(value):
        return "number"
    return "person" if 13 <= len(value) <= 18 and _PERSON.match(value) else ""


def identifier_text(value: str | None) -> str:
    """An identifier in lower case without spaces and punctuation."""
    return re.sub(r"[^a-z0-9*#]", "", (value or "").lower())


def mask_shape(masked: str) -> str:
    """Which places of a masked identifier are visible: ``1`` for a visible one, ``0`` for a hidden one."""
    return re.sub("[^0]", "1", _MASK.sub(lambda m: "0" * len(m[0]), masked.replace("0", "1")))


def visible(value: str, shape: str) -> str:
    """The characters of a value at the visible places of a mask of its length."""
    return "".join(c for c, s in zip(value, shape, strict=True) if s == "1")


def mask_misfits(masked: str, full: str) -> int | None:
    """How many visible characters of a masked identifier differ from a full one; None if the lengths differ or under four are visible."""
    if len(masked) != len(full):
        return None
    shown = [i for i, s in enumerate(mask_shape(masked)) if s == "1"]
    return sum(masked[i] != full[i] for i in shown) if len(shown) > 3 else None


def identifier_relation(a: list[str], b: list[str]) -> int:
    """4 equal, 3 one or two typos apart, 2 one fits the visible part of the other, 1 not comparable, 0 contradicting."""
    best, against = 1, False
    for x in a:
        for y in b:
            kx, ky = identifier_kind(x), identifier_kind(y)
            if not kx or not ky:
                continue
            if "masked" in (kx, ky):
                masked, full = (x, y) if kx == "masked" else (y, x)
                misfits = mask_misfits(masked, full) if kx != ky else None
                if misfits == 0 or (kx == ky and masked == full):
                    best = max(best, 2)
                elif misfits is not None and misfits > 2:
                    against = True
            elif x == y:
                best = 4
            elif kx == ky:
                if within(x, y, 2):
                    best = max(best, 3)
                else:
                    against = True
    return 0 if best == 1 and against else best
