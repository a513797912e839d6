"""Rules that a table has to obey, as queries for the rows that break them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType
from pyspark.sql.window import Window

from tabularium.functions.periods import within
from tabularium.functions.scalars import canonical_digest


def unknown_fields(schema: DataType, allowed: DataType, path: str = "") -> list[str]:
    """Paths of a schema that a closed contract does not have, at any depth."""
    if isinstance(schema, StructType):
        known = {f.name: f.dataType for f in allowed} if isinstance(allowed, StructType) else {}
        out = []
        for f in schema:
            here = f"{path}.{f.name}".lstrip(".")
            out += unknown_fields(f.dataType, known[f.name], here) if f.name in known else [here]
        return out
    if isinstance(schema, ArrayType) and isinstance(allowed, ArrayType):
        return unknown_fields(schema.elementType, allowed.elementType, path + "[]")
    if isinstance(schema, MapType) and isinstance(allowed, MapType):
        return unknown_fields(schema.valueType, allowed.valueType, path + "{}")
    return [] if schema.simpleString() == allowed.simpleString() else [path]


def closed(rows: DataFrame, contract: StructType) -> DataFrame:
    """``rows`` in the contract's columns; an error names fields that it does not have, missing ones are NULL."""
    if extra := unknown_fields(rows.schema, contract):
        raise ValueError(f"fields outside the contract: {', '.join(extra)}")
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in contract])


def broken_rules(rows: DataFrame, id_: str, rules: Mapping[str, Column]) -> DataFrame:
    """Rows with the rules they break: ``id_``, ``rule``. A rule that gives NULL is not broken."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(~c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return rows.select(id_, F.explode(broken).alias("rule"))


def repeated_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with more than one row and their number."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(rows: DataFrame, parents: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose reference is set but names no parent."""
    known = parents.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    return rows.dropna(subset=list(on)).join(known, list(on), "left_anti").select(*rows.columns)


def unknown_codes(rows: DataFrame, column: str, codes: Sequence[str]) -> DataFrame:
    """Values of a column outside a vocabulary, with their counts."""
    return rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(*codes)).groupBy(column).agg(F.count("*").alias("n"))


def outside_parent(rows: DataFrame, parents: DataFrame, on: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows whose period is not inside their parent's."""
    outer = parents.select(*on, F.col(start).alias("_from"), F.col(end).alias("_to"))
    return rows.join(outer, list(on)).filter(~within(F.col(start), F.col(end), F.col("_from"), F.col("_to"))).select(*rows.columns)


def mismatched(rows: DataFrame, parents: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """Rows whose column differs from their parent's, NULLs compared as values."""
    outer = parents.select(*on, F.col(column).alias("_parent"))
    return rows.join(outer, list(on)).filter(~F.col(column).eqNullSafe(F.col("_parent"))).select(*rows.columns)


def mutated(before: DataFrame, after: DataFrame, key: Sequence[str], fixed: Sequence[str]) -> DataFrame:
    """Keys of a table that may only grow which were removed or whose fixed columns changed: key, ``fault``."""
    new = after.select(*key, F.struct(*fixed).alias("_new"))
    joined = before.select(*key, F.struct(*fixed).alias("_old")).join(new, list(key), "left")
    fault = F.when(F.col("_new").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return joined.select(*key, fault.alias("fault")).filter("fault is not null")


def downgraded(before: DataFrame, after: DataFrame, key: Sequence[str], level: str, order: Sequence[str]) -> DataFrame:
    """Keys whose level fell in a given order of levels."""
    rank = lambda c: F.array_position(F.array(*map(F.lit, order)), c)
    joined = before.select(*key, F.col(level).alias("_old")).join(after.select(*key, F.col(level).alias("_new")), list(key))
    return joined.filter(rank(F.col("_new")) < rank(F.col("_old"))).select(*key)


def denominators(rows: DataFrame, by: Sequence[str], expected: DataFrame, column: str) -> DataFrame:
    """Groups whose number of rows is not the expected one: group, expected, found (0 if absent, expected NULL if not foreseen)."""
    found = rows.groupBy(*by).agg(F.count("*").alias("found"))
    joined = expected.select(*by, F.col(column).cast("bigint").alias("expected")).join(found, list(by), "full_outer")
    return joined.withColumn("found", F.coalesce("found", F.lit(0))).filter(~F.col("expected").eqNullSafe(F.col("found")))


def require_none(problems: DataFrame, message: str) -> None:
    """An error with a few of the rows if there are any."""
    if few := problems.take(5):
        raise ValueError(f"{message}: {[r.asDict() for r in few]}")


def score_mismatches(rows: DataFrame, by: Sequence[str], key: str, value: str, score: str, tolerance: float = 1e-9) -> DataFrame:
    """Rows whose stored score is not the one computed from the counts of smaller and equal values."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_equal"))
    w = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = counts.withColumn("_below", F.coalesce(F.sum("_equal").over(w), F.lit(0)))
    totals = counts.groupBy(*by).agg(F.sum("_equal").alias("_n"))
    expected = F.try_divide(100.0 * (F.col("_below") + (F.col("_equal") - 1) / 2), F.nullif(F.col("_n") - 1, F.lit(0)))
    joined = rows.join(below, [*by, value], "left").join(totals, list(by), "left") if by else rows.join(below, value, "left").crossJoin(F.broadcast(totals))
    return joined.filter(F.coalesce(F.abs(expected - F.col(score)) > tolerance, ~expected.eqNullSafe(F.col(score)))).select(*by, key, F.col(score).alias("stored"), expected.alias("expected"))


def unreconciled(rows: DataFrame, by: Sequence[str], category: str, stored: DataFrame, total: str) -> DataFrame:
    """Groups whose stored counts by category, or their total, are not those of the rows: stored has ``by``, one column per category, and ``total``."""
    kinds = [c for c in stored.columns if c not in (*by, total)]
    found = rows.groupBy(*by).agg(*[F.count_if(F.col(category) == k).alias(f"_{k}") for k in kinds], F.count("*").alias("_total"))
    joined = stored.join(found, list(by), "left") if by else stored.crossJoin(F.broadcast(found))
    wrong = ~F.coalesce(F.col("_total"), F.lit(0)).eqNullSafe(F.col(total))
    for k in kinds:
        wrong = wrong | ~F.coalesce(F.col(f"_{k}"), F.lit(0)).eqNullSafe(F.col(k))
    return joined.filter(wrong).select(*stored.columns)


def disagreeing_shards(parts: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys that several shards report with different values."""
    return parts.groupBy(*key).agg(F.count_distinct(F.struct(*values)).alias("versions")).filter("versions > 1")


def composed(preserved: DataFrame, fresh: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The union of two tables and the keys that both have, which have to be none."""
    return preserved.unionByName(fresh), preserved.select(*key).distinct().join(fresh.select(*key).distinct(), list(key))


def unmatched(expected: DataFrame, found: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys that only one side has or whose values differ: key and ``fault`` (missing, unexpected, different)."""
    a, b = (x.select(*key, F.struct(*values).alias(n)) for x, n in ((expected, "_e"), (found, "_f")))
    fault = F.when(F.col("_f").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(~F.col("_e").eqNullSafe(F.col("_f")), "different")
    return a.join(b, list(key), "full_outer").select(*key, fault.alias("fault")).filter("fault is not null")


def damaged_documents(rows: DataFrame, key: str, text: str, digest: str) -> DataFrame:
    """JSON texts whose canonical digest is not the stored one."""
    return rows.filter(~canonical_digest(F.col(text)).eqNullSafe(F.col(digest))).select(key)


def shape_profile(rows: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """How often each shape of a text occurs (letters as A, digits as 9, runs shortened), so that a structure is seen and no value."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(column), r"\p{L}+", "A"), r"\p{N}+", "9"), r"\s+", " ")
    return rows.groupBy(*by, shape.alias("shape")).agg(F.count("*").alias("n"))
