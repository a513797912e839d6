"""Differences between consecutive full snapshots.

Every row is reduced to a few numbers: its snapshot's position in its group, a
key, a version and a hash of the compared values. These are spread over buckets
by a hash of the key, so that a group holding a third of all rows is spread as
evenly as any other, and each bucket is compared by sorted arrays and
``searchsorted``. Full values are fetched only for keys that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.session import shipped

KINDS = ("added", "removed", "changed")
BUCKET_ROWS = 100_000
_OUT = "_group bigint, _at int, _key bigint, _kind int"


def snapshot_positions(snapshots: DataFrame, *, snapshot: str, group: str, order: Sequence[Column]) -> DataFrame:
    """Each snapshot with its group's number, its position and the snapshots around it.

    Snapshots without an id or a group are left out; equal order values fall back on the id; a repeated snapshot counts once.
    """
    w = Window.partitionBy("_group").orderBy(*order, F.col(snapshot))
    return (
        snapshots.filter(F.col(snapshot).isNotNull() & F.col(group).isNotNull())
        .dropDuplicates([snapshot])
        .withColumn("_group", F.xxhash64(group))
        .select(
            F.col(snapshot).alias("_snapshot"),
            "_group",
            (F.row_number().over(w) - 1).alias("_at"),
            F.lag(snapshot).over(w).alias("_before"),
            F.lead(snapshot).over(w).isNull().alias("_last"),
        )
    )


def diff_sorted(group: np.ndarray, at: np.ndarray, last: np.ndarray, key: np.ndarray, version: np.ndarray, tie: np.ndarray, digest: np.ndarray):
    """(group, position, key, kind) of every difference among the rows of one bucket.

    Of rows with equal group, position and key the one of the latest version (then the largest tie) counts.
    """
    order = np.lexsort((tie, version, at, key, group))
    group, at, last, key, digest = group[order], at[order], last[order], key[order], digest[order]
    same_key = (group[1:] == group[:-1]) & (key[1:] == key[:-1])
    final = np.append(~(same_key & (at[1:] == at[:-1])), True)
    number = np.concatenate(([0], np.cumsum(~same_key)))[final]
    group, at, last, key, digest = group[final], at[final].astype(np.int64), last[final], key[final], digest[final]
    code = number * (at.max() + 3) + at + 1
    earlier, later = np.searchsorted(code, code - 1), np.searchsorted(code, code + 1)
    in_earlier = code[earlier] == code - 1
    in_later = (later < len(code)) & (code[np.minimum(later, len(code) - 1)] == code + 1)
    added = np.flatnonzero(~in_earlier & (at > 0))
    removed = np.flatnonzero(~in_later & ~last)
    changed = np.flatnonzero(in_earlier & (digest[earlier] != digest))
    rows = np.concatenate((added, removed, changed))
    kind = np.repeat(np.arange(3, dtype=np.int32), (len(added), len(removed), len(changed)))
    return group[rows], (at[rows] + (kind == 1)).astype(np.int32), key[rows], kind


def _diff_bucket(rows: pa.Table) -> pa.Table:
    a = {n: rows.column(n).to_numpy() for n in rows.column_names if n != "_bucket"}
    found = diff_sorted(a["_group"], a["_at"], a["_last"], a["_key"], a["_version"], a["_tie"], a["_digest"])
    return pa.table(dict(zip(("_group", "_at", "_key", "_kind"), map(pa.array, found), strict=True)))


def snapshot_changes(
    rows: DataFrame,
    positions: DataFrame,
    *,
    snapshot: str,
    key: str,
    digest: Column,
    version: Column,
    tie: Column,
    values: Sequence[str] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """What was added, removed or changed from each snapshot to the next of its group.

    Result: ``snapshot``, ``key``, ``change_kind``, and for each of ``values`` its former and present
    value (``old_*``, ``new_*``). A removal is dated by the snapshot where the key is absent. The first
    snapshot of a group has no changes. Rows without key or of an unknown snapshot are left out; of
    rows with equal snapshot and key the one of the greatest ``version`` counts, then of the greatest
    ``tie``; a NULL version counts as the least. Empty input gives no rows. Other columns of ``rows`` are ignored.

    rows: any number of snapshots. positions: see ``snapshot_positions``. key: a bigint column. digest: a bigint hash of what is compared.
    """
    shipped(rows.sparkSession)
    compact = rows.filter(F.col(key).isNotNull()).select(
        F.col(snapshot).alias("_snapshot"),
        F.col(key).cast("bigint").alias("_key"),
        F.coalesce(version, F.lit(-(2**62))).cast("bigint").alias("_version"),
        F.coalesce(tie, F.lit(-(2**62))).cast("bigint").alias("_tie"),
        digest.alias("_digest"),
    )
    buckets = max(1, -(-rows.count() // bucket_rows))
    placed = compact.join(positions.select("_snapshot", "_group", "_at", "_last"), "_snapshot").drop("_snapshot")
    found = (
        placed.withColumn("_bucket", F.pmod(F.xxhash64("_group", "_key"), F.lit(buckets)))
        .groupBy("_bucket")
        .applyInArrow(_diff_bucket, _OUT)
        .join(positions.select("_group", "_at", "_snapshot", "_before"), ["_group", "_at"])
    )
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("_kind") + 1).alias("change_kind")
    found = found.select("_snapshot", "_before", "_key", kind)
    if values:
        full = rows.filter(F.col(key).isNotNull()).select(
            F.col(snapshot).alias("_s"), F.col(key).cast("bigint").alias("_k"), F.struct(version.alias("v"), tie.alias("t"), F.struct(*values).alias("x")).alias("_row")
        )
        sides = found.select("_snapshot", "_before", "_key", "change_kind", F.explode(F.array(F.col("_snapshot"), F.col("_before"))).alias("_s")).withColumnRenamed("_key", "_k")
        met = sides.join(full, ["_s", "_k"]).groupBy("_snapshot", "_k", "change_kind")
        newest = met.agg(F.max(F.when(F.col("_s") == F.col("_snapshot"), F.col("_row"))).alias("_new"), F.max(F.when(F.col("_s") == F.col("_before"), F.col("_row"))).alias("_old"))
        return newest.select(
            F.col("_snapshot").alias(snapshot), F.col("_k").alias(key), "change_kind", *[F.col(f"_old.x.{v}").alias(f"old_{v}") for v in values], *[F.col(f"_new.x.{v}").alias(f"new_{v}") for v in values]
        )
    return found.select(F.col("_snapshot").alias(snapshot), F.col("_key").alias(key), "change_kind")
