"""Address records of one location, however written.

Method: addresses are taken apart, equal parts are merged to one class, classes are compared in
multi-pass sorted neighbourhoods whose keys order the components differently, kind of street and
civic number must agree strictly, street and municipality by transposition-tolerant edit
distance, and accepted pairs are joined to locations by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.address_parts import UNTYPED, parse_address, parse_review
from tabularium.llm.distances import within
from tabularium.llm.neighbourhood import codes, neighbour_pairs
from tabularium.operators.components import components
from tabularium.session import written

WINDOW = 16
PART_COLUMNS = ("municipality", "kind", "street", "civic", "postcode", "province")
PASSES = ("by_municipality", "by_word", "by_root", "by_end")
#: Kinds of roads that are known by their number.
EXACT_KINDS = ("sp", "ss", "sr")
_PARTS_DDL = ", ".join(f"{c} string" for c in PART_COLUMNS)


def _tolerance(text: str) -> int:
    return 0 if len(text) < 5 else 1 if len(text) < 11 else 2


@lru_cache(maxsize=200_000)
def same_street(a: str, b: str) -> bool:
    """Whether two street names agree: words in any order, typos, initials for given names, a missing given name."""
    if a == b:
        return True
    x, y = a.split(), b.split()
    if {w for w in x if w.isdigit()} != {w for w in y if w.isdigit()}:
        return False
    if len(x) > len(y):
        x, y = y, x
    if not x or len(y) - len(x) > 1 or (len(y) > len(x) and len(x) > 1):
        joined_a, joined_b = a.replace(" ", ""), b.replace(" ", "")
        return bool(x) and len(joined_a) > 7 and within(joined_a, joined_b, 1)
    left, whole = list(y), 0
    for word in sorted(x, key=len, reverse=True):
        hit = next((w for w in left if w == word), None) or next((w for w in left if len(word) > 3 and len(w) > 3 and not word.isdigit() and within(word, w, _tolerance(min(word, w, key=len)))), None)
        if hit:
            whole += len(word) > 3 or word.isdigit()
        else:
            hit = next((w for w in left if min(len(w), len(word)) == 1 and w[0] == word[0] and not (w + word).isdigit()), None)
        if not hit:
            return len(x) == len(y) and len(a) > 7 and within(a.replace(" ", ""), b.replace(" ", ""), 1)
        left.remove(hit)
    return whole > 0


@lru_cache(maxsize=200_000)
def municipality_likeness(a: str, b: str) -> int:
    """2: equal names; 1: a typo or a shortened first part; 0: different names."""
    if a == b:
        return 2
    x, y = a.replace(" ", ""), b.replace(" ", "")
    if x == y:
        return 2
    for p, q in ((a, b), (b, a)):
        head, _, tail = p.partition(" ")
        tail = tail.replace(" ", "")
        full = q.replace(" ", "")
        if len(head) == 1 and len(tail) > 4 and full[0] == head and len(full) > len(tail) + 1:
            rest = full[-len(tail) :]
            if rest == tail or within(rest, tail, 1) or within(full[-len(tail) - 1 :], tail, 1) or within(full[-len(tail) + 1 :], tail, 1):
                return 1
    return int(x[:1] == y[:1] and len(x) > 5 and within(x, y, _tolerance(min(x, y, key=len)))) or (-1 if len(x) > 5 and within(x, y, 1) else 0)


def _same_place(likeness: int, a: tuple, b: tuple) -> bool:
    """Whether municipalities of a likeness are one, given the postcodes and provinces of the addresses."""
    if likeness in (0, 2):
        return likeness == 2
    agree = any(x and x == y for x, y in zip(a, b, strict=True))
    conflict = any(x and y and x != y for x, y in zip(a, b, strict=True))
    return agree if likeness < 0 else agree or not conflict


def same_location(a: tuple, b: tuple) -> bool:
    """Whether two addresses denote one location; tuples of the parts in the order of ``PART_COLUMNS``."""
    if a[3] != b[3] or a[1] != b[1] or not a[0] or not b[0]:
        return False
    if a[1] in EXACT_KINDS and a[2] != b[2]:
        return False
    if a[1] == UNTYPED:
        return a[0] == b[0]
    return _same_place(municipality_likeness(a[0], b[0]), a[4:6], b[4:6]) and same_street(a[2], b[2])


def _judged(column: pa.ChunkedArray, i: np.ndarray, j: np.ndarray, judge) -> np.ndarray:
    """``judge`` of the values of rows i and j, asked once for each pair of different values."""
    code = codes(column).astype(np.int64)
    low, high = np.minimum(code[i], code[j]), np.maximum(code[i], code[j])
    pairs, back = np.unique(low << 32 | high, return_inverse=True)
    values = column.combine_chunks().dictionary_encode("encode").dictionary.to_pylist()
    return np.array([judge(values[p >> 32], values[p & 0xFFFFFFFF]) for p in pairs.tolist()], np.int8)[back]


def same_locations(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``same_location`` of the rows numbered i and j, whose civic numbers and kinds are equal: municipalities first, then streets of what is left."""
    kinds = np.array(rows.column("kind").to_pylist(), object)
    exact, untyped, street = np.isin(kinds, EXACT_KINDS), kinds == UNTYPED, codes(rows.column("street"))
    likeness = _judged(rows.column("municipality"), i, j, municipality_likeness)
    likeness[untyped[i] & (codes(rows.column("municipality"))[i] != codes(rows.column("municipality"))[j])] = 0
    likeness[exact[i] & (street[i] != street[j])] = 0
    keep = np.flatnonzero(likeness)
    keep = keep[_judged(rows.column("street"), i[keep], j[keep], lambda a, b: a == b or same_street(a, b)) > 0]
    details = list(zip(*(rows.column(c).to_pylist() for c in PART_COLUMNS[4:]), strict=True))
    out = np.zeros(len(i), bool)
    out[[n for n in keep.tolist() if _same_place(int(likeness[n]), details[i[n]], details[j[n]])]] = True
    return out


def _parsed(batches: Iterator[pa.RecordBatch], parse) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, *texts = batch.columns
        parts = [parse(*row) for row in zip(*(t.to_pylist() for t in texts), strict=True)]
        yield pa.RecordBatch.from_arrays([ids, *(pa.array([p[i] for p in parts], pa.string()) for i in range(len(PART_COLUMNS)))], ["record", *PART_COLUMNS])


def address_parts(records: DataFrame, record: str, *columns: str) -> DataFrame:
    """``record`` (as ``record``) with the parts of its address: one column of free text, or municipality, street and civic. Rows without ``record`` are left out."""
    parse = parse_address if len(columns) == 1 else parse_review
    return records.filter(F.col(record).isNotNull()).select(F.col(record).cast("bigint").alias("record"), *columns).mapInArrow(lambda b: _parsed(b, parse), f"record bigint, {_PARTS_DDL}")


def address_classes(parts: DataFrame) -> DataFrame:
    """Distinct addresses: ``cls``, the least record of it, the parts, and the least postcode and province met."""
    known = parts.filter("municipality <> '' and kind <> ''")
    return known.groupBy(*PART_COLUMNS[:4]).agg(F.min("record").alias("cls"), *[F.coalesce(F.min(F.when(F.col(c) != "", F.col(c))), F.lit("")).alias(c) for c in PART_COLUMNS[4:]])


def sort_keys(classes: DataFrame) -> DataFrame:
    """Classes with ``strict`` (civic number and kind) and the keys of the four passes, each with the components in another order."""
    words = F.array_distinct(F.split("street", " "))
    long_words = F.filter(words, lambda w: (F.length(w) > 1) | (F.size(words) == 1))
    root = F.reverse(F.regexp_replace("municipality", " ", ""))
    return classes.withColumns(
        {
            "strict": F.concat_ws("|", "civic", "kind"),
            "by_municipality": F.array(F.concat_ws("|", "municipality", F.array_join(F.array_sort(long_words), " "))),
            "by_word": F.transform(long_words, lambda w: F.concat_ws("|", w, root)),
            "by_root": F.transform(long_words, lambda w: F.concat_ws("|", root, F.reverse(w))),
            "by_end": F.transform(long_words, lambda w: F.concat_ws("|", F.reverse(w), "municipality")),
        }
    )


def locations(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each record with its location: columns ``record``, ``location`` (the least record of it).

    Records whose address is NULL, blank or without municipality have no location and are left out. An address without a known street
    type is one location only with addresses of the same words and number. No number and an explicit absence of one are the same.
    Repeated rows of a record count once.
    """
    parts = written(parts, "address-parts")
    classes = written(address_classes(parts), "address-classes")
    pairs = neighbour_pairs(sort_keys(classes), id_="cls", strict="strict", keys=PASSES, payload=PART_COLUMNS, window=window, alike=same_locations)
    roots = components(pairs, "a", "b").withColumnRenamed("node", "cls")
    placed = classes.join(roots, "cls", "left").select(*PART_COLUMNS[:4], F.coalesce("root", "cls").alias("location"))
    members = parts.select("record", *PART_COLUMNS[:4]).distinct()
    return members.join(placed, list(PART_COLUMNS[:4])).select("record", "location").distinct()


def pairs_of(members: DataFrame, member: str, group: str, first: str, second: str) -> DataFrame:
    """All pairs of members of one group, the smaller first."""
    left, right = (members.select(F.col(group).alias("_g"), F.col(member).alias(n)) for n in (first, second))
    return left.join(right, "_g").filter(F.col(first) < F.col(second)).select(first, second)
