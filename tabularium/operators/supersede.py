"""Tables that only grow: superseded versions, idempotent appends, folds over dated checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def superseded(current: DataFrame, desired: DataFrame, key: Sequence[str], values: Sequence[str], now: Column, remove_missing: bool = True) -> DataFrame:
    """The table after a run at ``now``: open versions that differ from the desired row are closed and followed by a new one; equal ones stay as they are.

    current: key, values, ``valid_from``, ``valid_to`` (NULL while open). Keys without a desired row are closed, or kept if not ``remove_missing``. Running twice with the same desired rows changes nothing.
    """
    closed, opened = current.filter("valid_to is not null"), current.filter("valid_to is null")
    a = opened.select(*key, F.struct(*values).alias("_was"), F.col("valid_from").alias("_from"))
    b = desired.select(*key, F.struct(*values).alias("_new"))
    both = a.join(b, list(key), "full_outer")
    same = F.col("_was").eqNullSafe(F.col("_new"))
    keep = F.col("_was").isNotNull() & (same | (F.lit(not remove_missing) & F.col("_new").isNull()))
    end = F.when(keep, F.lit(None)).otherwise(now)
    old = F.when(F.col("_was").isNotNull(), F.struct(F.col("_was").alias("v"), F.col("_from").alias("f"), end.cast(current.schema["valid_to"].dataType).alias("t")))
    new = F.when(F.col("_new").isNotNull() & ~(F.col("_was").isNotNull() & same), F.struct(F.col("_new").alias("v"), now.cast(current.schema["valid_from"].dataType).alias("f"), F.lit(None).cast(current.schema["valid_to"].dataType).alias("t")))
    rows = both.select(*key, F.explode(F.array_compact(F.array(old, new))).alias("r")).select(*key, *[F.col(f"r.v.{c}").alias(c) for c in values], F.col("r.f").alias("valid_from"), F.col("r.t").alias("valid_to"))
    return closed.select(*rows.columns).unionByName(rows)


def expired(current: DataFrame, eligible: DataFrame, key: Sequence[str], now: Column, scope: Column | None = None) -> DataFrame:
    """The table with open versions closed at ``now`` whose key is no longer eligible; ``scope`` says which open rows are judged at all.

    eligible: the keys that may stay open, made by semi- and anti-joins (see ``unserved``); a NULL key is never eligible.
    """
    judged = F.col("valid_to").isNull() & (F.lit(True) if scope is None else F.coalesce(scope, F.lit(False)))
    closing = current.filter(judged).join(eligible.select(*key).distinct(), list(key), "left_anti").withColumn("valid_to", now.cast(current.schema["valid_to"].dataType)).select(*current.columns)
    staying = current.filter(judged).join(eligible.select(*key).distinct(), list(key), "left_semi").select(*current.columns)
    return current.filter(~judged).unionByName(staying).unionByName(closing)


def unserved(routes: DataFrame, always: Column, after_failure: Column, results: DataFrame, key: Sequence[str], failed: Column, good: Column) -> DataFrame:
    """Keys whose route always asks for a second provider, or does so after the first one failed and gave nothing good."""
    second = routes.filter(after_failure).join(results.filter(failed).select(*key), list(key), "left_semi").join(results.filter(good).select(*key), list(key), "left_anti")
    return routes.filter(always).select(*key).unionByName(second.select(*key)).distinct()


def to_append(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the table lacks, one per key."""
    return incoming.dropDuplicates(list(key)).join(existing.select(*key), list(key), "left_anti")


def append_conflicts(existing: DataFrame, incoming: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys under which an incoming row differs from the table or from another incoming row: an append may go on only without any."""
    both = existing.select(*key, *values).unionByName(incoming.select(*key, *values))
    return both.groupBy(*key).agg(F.count_distinct(F.xxhash64(*values)).alias("_n")).filter("_n > 1").select(*key)


def folded_checks(checks: DataFrame, key: str, at: str, digest: str, error: str) -> DataFrame:
    """The state of each resource after all its checks: last attempt, last success, last change (a success whose content differs from the success before it), failures since the last success."""
    w = Window.partitionBy(key).orderBy(at)
    good = checks.filter(F.col(error).isNull()).withColumn("_was", F.lag(digest).over(w))
    changes = good.groupBy(key).agg(F.max(at).alias("last_success"), F.max(F.when(~F.col("_was").eqNullSafe(F.col(digest)), F.col(at))).alias("last_change"), F.max_by(digest, at).alias(digest))
    tries = checks.groupBy(key).agg(F.max(at).alias("last_attempt"), F.count("*").alias("attempts"))
    bad = checks.filter(F.col(error).isNotNull()).select(key, at)
    since = bad.join(changes.select(key, "last_success"), key, "left").filter(F.col("last_success").isNull() | (F.col(at) > F.col("last_success"))).groupBy(key).agg(F.count("*").alias("failures_since"))
    return tries.join(changes, key, "left").join(since, key, "left").withColumn("failures_since", F.coalesce("failures_since", F.lit(0)))


def first_observed(rows: DataFrame, key: Sequence[str], at: str, now: Column) -> DataFrame:
    """When each key was first seen and its age in days."""
    return rows.groupBy(*key).agg(F.min(at).alias("first_observed")).withColumn("age_days", F.datediff(now, F.col("first_observed")))


def edge_transitions(rows: DataFrame, key: str, at: str, mode: str) -> DataFrame:
    """Rows where the mode of a key differs from its mode before: key, at, from_mode (NULL at first), to_mode."""
    w = Window.partitionBy(key).orderBy(at)
    return rows.withColumn("_was", F.lag(mode).over(w)).filter(~F.col("_was").eqNullSafe(F.col(mode))).select(key, at, F.col("_was").alias("from_mode"), F.col(mode).alias("to_mode"))
