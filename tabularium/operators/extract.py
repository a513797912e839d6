"""From positioned words and table rows to records: lines, bands, segments, carried headers, stitched continuations, collapsed groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LINE_TOLERANCE = 4.0


def clustered_lines(words: DataFrame, document: str = "doc", page: str = "page", tolerance: float = LINE_TOLERANCE) -> DataFrame:
    """Words with the line they stand on: a word joins a line if its centre is within ``tolerance`` of the running mean of the line's centres.

    words: document, page, x0, y0, x1, y1, text. Adds ``line`` (from 0 down the page) and ``yc``. The mean moves with every word, so the lines of
    a page are found in order; a page is one group, which its paper bounds.
    """
    schema = words.withColumns({"yc": F.lit(0.0), "line": F.lit(0)}).schema

    def assign(group: pd.DataFrame) -> pd.DataFrame:
        g = group.assign(yc=(group.y0 + group.y1) / 2).sort_values(["yc", "x0"], kind="stable")
        lines, mean, count, number = [], 0.0, 0, -1
        for yc in g.yc:
            if count and abs(yc - mean) <= tolerance:
                mean, count = (mean * count + yc) / (count + 1), count + 1
            else:
                mean, count, number = yc, 1, number + 1
            lines.append(number)
        return g.assign(line=pd.array(lines, dtype="int32"))[schema.names]

    return words.groupBy(document, page).applyInPandas(assign, schema)


def banded(words: DataFrame, bands: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Words with the band [low, high) that holds their centre; NULL outside all."""
    centre = (F.col("x0") + F.col("x1")) / 2
    return words.withColumn("band", F.coalesce(*[F.when((centre >= lo) & (centre < hi), F.lit(n)) for n, lo, hi in bands], F.lit(None).cast("string")))


def band_texts(words: DataFrame, line: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """One row per line with the text of each band, its words from left to right."""
    text = lambda b: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("band") == b, F.struct("x0", "text")))), lambda w: w["text"]), " ")
    return words.groupBy(*line).agg(*[text(b).alias(b) for b in bands])


def segments(rows: DataFrame, document: Sequence[str], order: Sequence[str], starts: Column, name: str = "segment") -> DataFrame:
    """Rows with the number of the segment they belong to: a new one begins where ``starts`` holds; rows before the first have 0."""
    w = Window.partitionBy(*document).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.when(F.coalesce(starts, F.lit(False)), 1).otherwise(0)).over(w))


def stitched(rows: DataFrame, document: Sequence[str], order: Sequence[str], anchor: Column, texts: Sequence[str]) -> DataFrame:
    """One row per anchor row with the texts of its continuation rows added in order; rows before the first anchor are left out."""
    marked = segments(rows, document, order, anchor)
    joined = [F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.coalesce(t, F.lit("")).alias("t")))), lambda x: F.trim(x["t"])), lambda x: x != ""), " ").alias(t) for t in texts]
    return marked.filter("segment > 0").groupBy(*document, "segment").agg(*joined, F.count("*").alias("rows"))


def carried(rows: DataFrame, document: Sequence[str], order: Sequence[str], header: Column, name: str) -> DataFrame:
    """Rows with the last header at or above them in their document."""
    w = Window.partitionBy(*document).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(header, ignorenulls=True).over(w))


def collapsed(rows: DataFrame, identity: Sequence[str], order: str, item: str, variants: Sequence[str] = ()) -> DataFrame:
    """One row per identity with its items in order of appearance, once each, and all distinct values of other columns with a flag where they differ.

    Repetitions are merged before anything is gathered, so a list holds no more than the distinct items of its identity. NULL items are none.
    """
    once = rows.groupBy(*identity, item).agg(F.min(order).alias("_first"), F.count("*").alias("_rows"), *[F.collect_set(v).alias(f"_{v}") for v in variants])
    ordered = F.transform(F.array_sort(F.collect_list(F.when(F.col(item).isNotNull(), F.struct("_first", F.col(item).alias("_item"))))), lambda x: x["_item"])
    kept = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"_{v}")))).alias(f"{v}_variants") for v in variants]
    out = once.groupBy(*identity).agg(ordered.alias("items"), F.sum("_rows").alias("rows"), *kept)
    conflict = F.lit(False)
    for v in variants:
        conflict = conflict | (F.size(f"{v}_variants") > 1)
    return out.withColumn("conflict", conflict)


def reconstructed(rows: DataFrame, identity: Sequence[str], date: Column, raw: Column, order: str, sector: str) -> DataFrame:
    """One row per identity and date with its sectors in order: of a bundle of one list per sector. A date that cannot be read is told apart by its text."""
    return collapsed(rows.withColumn("date_key", date_or_raw(date, raw)), [*identity, "date_key"], order, sector)


def date_or_raw(date: Column, raw: Column) -> Column:
    """A key for grouping by a date that may be unreadable: the date, else its text marked as raw."""
    return F.coalesce(date.cast("string"), F.concat(F.lit("RAW:"), F.coalesce(raw, F.lit(""))))


def within_cells(points: DataFrame, rectangles: DataFrame, page: Sequence[str]) -> DataFrame:
    """Points (x, y) with the text of the largest rectangle of their page that covers them; NULL if none does."""
    boxes = rectangles.select(*page, "left", "top", "right", "bottom", F.col("text").alias("_text"))
    keyed = points.withColumn("_p", F.xxhash64(*points.columns))
    area = (F.col("right") - F.col("left")) * (F.col("bottom") - F.col("top"))
    hits = keyed.join(boxes, list(page)).filter("x >= left and x <= right and y >= top and y <= bottom").groupBy("_p").agg(F.max(F.struct(area.alias("a"), "_text"))["_text"].alias("cell"))
    return keyed.join(hits, "_p", "left").drop("_p")


def stamped(rows: DataFrame, column: str, value: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a blank ``column`` filled, and the rows where it holds something else."""
    text = F.trim(F.coalesce(column, F.lit("")))
    return rows.withColumn(column, F.when(text == "", F.lit(value)).otherwise(F.col(column))), rows.filter((text != "") & (text != value))


def pages_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words of ``-bbox-layout`` XHTML (columns doc, content) with page and box, for ``mapInPandas``."""
    import re

    word = re.compile(r'<word xMin="([\d.]+)" yMin="([\d.]+)" xMax="([\d.]+)" yMax="([\d.]+)">(.*?)</word>', re.S)
    from html import unescape

    for batch in batches:
        rows = [(d, n, *map(float, m.groups()[:4]), unescape(m[5])) for d, content in zip(batch.doc, batch.content, strict=True) for n, page in enumerate(re.split(r"<page\b", (bytes(content).decode("utf-8", "replace") if not isinstance(content, str) else content))[1:], 1) for m in word.finditer(page)]
        yield pd.DataFrame(rows, columns=["doc", "page", "x0", "y0", "x1", "y1", "text"])


WORDS_DDL = "doc string, page int, x0 double, y0 double, x1 double, y1 double, text string"
