"""Folding of texts to letters and digits: no case, no accents, one Unicode form.

``folded`` keeps nearly all rows inside whole-stage code: ASCII texts need a
lower-casing and one replacement, precomposed Latin letters a ``translate`` whose
table is derived from the Unicode database, and only what is left (ligatures,
combining marks, other scripts) is handed to an Arrow-batched function; for all
other rows that function is given NULL.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def fold_text(text: str | None) -> str | None:
    """Letters and digits of ``text``, case-folded, without accents; NULL stays NULL."""
    if text is None:
        return None
    flat = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text).casefold())
    return "".join(c for c in flat if c.isalnum())


def strip_accents(text: str) -> str:
    """``text`` in lower case without accents; punctuation and spacing stay."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


@lru_cache(maxsize=1)
def latin_table() -> tuple[str, str]:
    """Precomposed Latin letters and the single ASCII letter or digit each folds to."""
    pairs = [(chr(c), f) for c in range(0x80, 0x250) if len(f := fold_text(chr(c)) or "") == 1 and f.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@lru_cache(maxsize=1)
def accent_map() -> dict[int, str]:
    """A ``str.translate`` table to lower case without accents, for all letters of the basic plane."""
    table = {}
    for c in range(0x80, min(sys.maxunicode, 0x10000)):
        if 0xD800 <= c < 0xE000:
            continue
        flat = strip_accents(chr(c))
        if flat != chr(c):
            table[c] = flat
    return table


def unaccented(text: Column) -> Column:
    """``strip_accents`` of a column; only texts with letters that no table folds leave the JVM."""
    strip = F.pandas_udf(lambda texts: texts.map(lambda t: None if t is None else strip_accents(t)), StringType())
    source, target = latin_table()
    plain = F.lower(F.translate(text, source, target))
    known = ~plain.rlike(r"[\p{L}\p{M}&&[^\x00-\x7F]]")
    return F.when(known, plain).otherwise(strip(F.when(~known, text)))


def _fold_series(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else fold_text(t))


def folded(text: Column) -> Column:
    """``fold_text`` of a column."""
    fold_udf = F.pandas_udf(_fold_series, StringType())
    source, target = latin_table()
    ascii_only = text.rlike(r"\A[\x00-\x7F]*\z")
    latin = F.when(ascii_only, text).otherwise(F.regexp_replace(F.translate(text, source, target), "[  -⁯]", ""))
    simple = latin.rlike(r"\A[\x00-\x7F]*\z")
    return F.when(simple, F.regexp_replace(F.lower(latin), "[^a-z0-9]", "")).otherwise(fold_udf(F.when(~simple, text)))
