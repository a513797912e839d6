"""Multi-pass sorted neighbourhoods: rows are sorted by several keys and compared within a window.

Spark's range partitioning sorts the rows of all passes at once; each partition is streamed once and compared as
it comes, with the last rows of a batch carried into the next. Pairs across the ends of partitions are found
from the few rows that stand within a window of an end, by their position in the whole order, so every window is
whole wherever the partitions are cut. Ties in a key are cut by the id, so a key that a third of all rows share is spread
like any other.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import written

#: Rows of one partition of the sorted order, and partitions whose ends are compared by one task.
STRETCH_ROWS, ENDS_PARTITIONS = 50_000, 64

#: Decides for the rows numbered ``i`` and ``j`` of a table of payload columns which of these pairs are alike.
Alike = Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray]


def _neighbours(n: int, window: int, first: int, strict: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers ``i < j`` under ``n`` less than ``window`` apart, ``j`` at least ``first``, with equal strict codes."""
    left, right = [], []
    for d in range(1, min(window, n)):
        j = np.arange(max(first, d), n)
        j = j[strict[j] == strict[j - d]]
        left.append(j - d)
        right.append(j)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def codes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equal numbers for equal values; NULL is a value of its own."""
    whole = pa.chunked_array([column]) if isinstance(column, pa.Array) else column
    return whole.combine_chunks().dictionary_encode("encode").indices.to_numpy()


def _alike_pairs(rows: pa.Table, window: int, first: int, alike: Alike) -> tuple[np.ndarray, np.ndarray]:
    strict = codes(rows.column("pass_")).astype(np.int64) << 32 | codes(rows.column("strict_"))
    i, j = _neighbours(rows.num_rows, window, first, strict)
    keep = alike(rows, i, j)
    return i[keep], j[keep]


def neighbour_pairs(rows: DataFrame, *, id_: str, strict: str, keys: Sequence[str], payload: Sequence[str], window: int, alike: Alike, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Pairs ``a < b`` of ids that stand within ``window`` places of each other by one of the keys, have equal ``strict`` and are alike.

    rows: one row per id, read several times, so best a written table. strict: a column of texts that sorts before every key. keys: columns of
    arrays of texts; a row stands in a pass once for each. No rows or one row give no pairs; NULL keys stand in no pass, and rows
    without id are left out.
    What reaches the driver is one count per partition.
    """
    kind = rows.schema[id_].dataType.simpleString()
    passes = F.concat(*[F.coalesce(_numbered(k, number), F.array().cast("array<struct<pass_:int,key_:string>>")) for number, k in enumerate(keys)])
    rows = rows.filter(F.col(id_).isNotNull())
    laid = rows.select(F.col(id_).alias("id_"), F.col(strict).alias("strict_"), *payload, F.explode(passes).alias("p")).select("id_", "strict_", *payload, "p.pass_", "p.key_")
    total = rows.agg(F.sum(sum((F.greatest(F.size(k), F.lit(0)) for k in keys), F.lit(0)))).first()[0] or 0
    order = ("pass_", "strict_", "key_", "id_")
    ranged = laid.repartitionByRange(max(1, -(-total // stretch_rows)), *order).sortWithinPartitions(*order).drop("key_")
    held = ["id_", "strict_", "pass_", *payload]
    types = {f.name: f.dataType.simpleString() for f in ranged.schema.fields}
    ddl = ", ".join([f"a {kind}, b {kind}, part_ int, at_ bigint", *(f"{c} {types[c]}" for c in held)])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, carried, schema = TaskContext.get().partitionId(), 0, None, None
        wide = lambda a, b, at, ends: pa.RecordBatch.from_arrays([a, b, pa.array([part] * len(a), pa.int32()), at, *ends.columns], ["a", "b", "part_", "at_", *held])

        def ends(table: pa.Table, at: np.ndarray) -> pa.RecordBatch:
            nothing = pa.nulls(len(at), schema.field("id_").type)
            return wide(nothing, nothing, pa.array(at, pa.int64()), table.select(held).combine_chunks().to_batches()[0])

        for batch in batches:
            if not batch.num_rows:
                continue
            schema, fresh = batch.schema, pa.Table.from_batches([batch])
            table = fresh if carried is None else pa.concat_tables([carried, fresh])
            old = table.num_rows - fresh.num_rows
            i, j = _alike_pairs(table, window, old, alike)
            ids = table.column("id_").combine_chunks()
            a, b = ids.take(pa.array(i)), ids.take(pa.array(j))
            if len(a):
                none = pa.nulls(len(a), pa.int64())
                yield wide(a, b, none, pa.Table.from_arrays([pa.nulls(len(a), schema.field(c).type) for c in held], names=held).to_batches()[0])
            if seen < window - 1:
                head = fresh.slice(0, window - 1 - seen)
                yield ends(head, np.arange(seen, seen + head.num_rows))
            seen += fresh.num_rows
            carried = table.slice(max(0, table.num_rows - window + 1))
        if seen:
            at = np.arange(seen - carried.num_rows, seen)
            tail = carried.filter(pa.array(at >= window - 1))
            if tail.num_rows:
                yield ends(tail, at[at >= window - 1])
            nothing = pa.nulls(1, schema.field("id_").type)
            yield wide(nothing, nothing, pa.array([seen], pa.int64()), pa.Table.from_arrays([pa.nulls(1, schema.field(c).type) for c in held], names=held).to_batches()[0])

    found = written(ranged.mapInArrow(stream, ddl), "neighbours")
    inner = found.filter("a is not null").select("a", "b")
    counts = [(r["part_"], r["at_"]) for r in found.filter("a is null and id_ is null").select("part_", "at_").orderBy("part_").collect()]
    starts = [0, *accumulate(n for _, n in counts)]
    block_ends = [starts[min(k + ENDS_PARTITIONS, len(counts))] for k in range(0, len(counts), ENDS_PARTITIONS)]
    placed = [(part, starts[k], sorted({*range(bisect_right(block_ends, starts[k] - window + 1), k // ENDS_PARTITIONS), k // ENDS_PARTITIONS})) for k, (part, _) in enumerate(counts)]
    places = rows.sparkSession.createDataFrame(placed, "part_ int, start_ bigint, blocks_ array<int>")
    edges = found.filter("id_ is not null").drop("a", "b").join(places, "part_").select(*held, "part_", (F.col("start_") + F.col("at_")).alias("at_"), F.array_max("blocks_").alias("own_"), F.explode("blocks_").alias("block_"))

    def across(block: pa.Table) -> pa.Table:
        block = block.sort_by("at_")
        at, part = (block.column(c).to_numpy() for c in ("at_", "part_"))
        own = block.column("own_").to_numpy() == block.column("block_").to_numpy()
        strict_codes = codes(block.column("pass_")).astype(np.int64) << 32 | codes(block.column("strict_"))
        i, j = _neighbours(block.num_rows, window, 1, strict_codes)
        keep = (at[j] - at[i] < window) & (part[i] != part[j]) & own[i]
        i, j = i[keep], j[keep]
        keep = alike(block, i, j)
        ids = block.column("id_").combine_chunks()
        return pa.table({"a": ids.take(pa.array(i[keep])), "b": ids.take(pa.array(j[keep]))})

    outer = edges.groupBy("block_").applyInArrow(across, f"a {kind}, b {kind}")
    return inner.unionByName(outer).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _numbered(keys: str, number: int):
    """The texts of an array column, each with the number of its pass."""
    return F.transform(keys, lambda key: F.struct(F.lit(number).alias("pass_"), key.alias("key_")))
