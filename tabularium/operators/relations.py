"""Relational building blocks: one row per key, period joins, prefix joins, complete combinations, validations of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.functions.periods import contains, overlap


def top_one(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``. Rows with a NULL key form a group of their own; ties need a last column that breaks them."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key, by an aggregate that combines before the shuffle."""
    rest = [c for c in rows.columns if c not in {*keys, *order}]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in (*order, *rest)]).select(*rows.columns)


#: Periods of one key that meet everything of the key, and parts at most that the time of a key with more is cut into.
PART_ROWS, TIME_PARTS = 64, 256


def _seconds(at: Column) -> Column:
    return at.cast("timestamp").cast("double")


def _cut(periods: DataFrame, on: Sequence[str], start: str, end: str) -> DataFrame:
    """The keys with more than ``PART_ROWS`` periods, with the first moment of their bounds and the width and number of the parts up to the last one."""
    ends = [_seconds(F.col(c)) for c in (start, end)]
    parts = F.least(F.lit(TIME_PARTS), F.ceil(F.count("*") / PART_ROWS)).cast("int")
    cut = periods.groupBy(*on).agg(F.min(F.least(*ends)).alias("_low"), F.max(F.greatest(*ends)).alias("_high"), parts.alias("_parts"))
    return cut.filter("_parts > 1 and _low is not null").select(*on, "_low", F.greatest(F.lit(1.0), (F.col("_high") - F.col("_low")) / F.col("_parts")).alias("_width"), "_parts")


def _part(at: Column, unknown: Column) -> Column:
    """The part of its key's time that a moment stands in; all of a key whose time is not cut stands in part 0."""
    part = F.floor((_seconds(at) - F.col("_low")) / F.col("_width"))
    return F.when(F.col("_parts").isNull(), 0).when(at.isNull(), unknown).otherwise(F.greatest(F.lit(0), F.least(F.col("_parts") - 1, part))).cast("int")


def _begun(start: Column) -> Column:
    return _part(start, F.lit(0))


def _covered(start: Column, end: Column) -> Column:
    first, last = _begun(start), _part(end, F.col("_parts") - 1)
    return F.when(first <= last, F.sequence(first, last))


def join_in_period(facts: DataFrame, periods: DataFrame, on: Sequence[str], at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Facts with the rows of ``periods`` that have equal keys and hold the moment ``at`` in [start, end).

    The time of a key with very many periods is cut into parts; a period of it stands once for each part it touches and meets only the
    facts of that part. The periods of any other key stand once, so their number hardly grows. As Spark takes the spread rows for no more
    than the periods themselves, they are never broadcast. A fact without moment holds in no period.
    """
    cut = _cut(periods, on, start, end)
    spread = periods.join(cut, list(on), "left").select(*periods.columns, F.explode(_covered(F.col(start), F.col(end))).alias("_p_part"))
    renamed = spread.withColumnsRenamed({c: f"_p_{c}" for c in on}).hint("merge")
    placed = facts.join(cut, list(on), "left").select(*facts.columns, F.when(F.col(at).isNotNull(), _begun(F.col(at))).alias("_f_part"))
    condition = contains(F.col(start), F.col(end), F.col(at)) & (F.col("_f_part") == F.col("_p_part"))
    for c in on:
        condition = (F.col(c) == F.col(f"_p_{c}")) & condition
    return placed.join(renamed, condition, how).drop("_f_part", "_p_part", *[f"_p_{c}" for c in on])


def period_conflicts(rows: DataFrame, key: Sequence[str], id_: str, periods: Sequence[tuple[str, str]]) -> DataFrame:
    """Pairs of ids of one key whose periods overlap in every one of ``periods``.

    Of two whose first periods overlap one holds the moment when the other begins. So a row stands once for each part of its key's time (``join_in_period``)
    that its first period touches, and meets there the rows that begin in that part, at its own beginning or later. The spread rows are never broadcast.
    """
    names = [c for p in periods for c in p]
    start, end = periods[0]
    timed = rows.join(_cut(rows, key, start, end), list(key), "left")
    a = timed.select(*key, F.col(id_).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in names], F.explode(_covered(F.col(start), F.col(end))).alias("_part"))
    b = timed.select(*key, F.col(id_).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in names], _begun(F.col(start)).alias("_part"))
    from_a, from_b = F.col(f"_a_{start}"), F.col(f"_b_{start}")
    ordered = F.when(from_a.eqNullSafe(from_b), F.col("_a") < F.col("_b")).otherwise((F.col("_a") != F.col("_b")) & (from_a.isNull() | F.coalesce(from_a < from_b, F.lit(False))))
    joined = a.hint("merge").join(b, [*key, "_part"]).filter(ordered)
    for start, end in periods:
        joined = joined.filter(overlap(F.col(f"_a_{start}"), F.col(f"_a_{end}"), F.col(f"_b_{start}"), F.col(f"_b_{end}")))
    return joined.select(*key, F.least("_a", "_b").alias(f"{id_}_1"), F.greatest("_a", "_b").alias(f"{id_}_2"))


def longest_prefix(rows: DataFrame, text: str, aliases: DataFrame, alias: str, code: str) -> DataFrame:
    """``rows`` with the code of the longest alias whose words begin the text: adds ``code``, ``prefix_status`` (unique, ambiguous, none) and ``rest``.

    Words are runs of letters and digits in lower case. The text's first words, up to as many as the longest alias has, are joined to the aliases
    by equality, so neither side is compared with all of the other.
    """
    spelt = lambda c: F.array_join(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), " ")
    known = aliases.select(spelt(F.col(alias)).alias("_prefix"), F.col(code).alias("_code")).filter("_prefix <> ''").groupBy("_prefix").agg(F.min("_code").alias("_code"), F.count_distinct("_code").alias("_codes"))
    most = known.agg(F.max(F.size(F.split("_prefix", " "))).alias("_most"))
    tagged = rows.withColumn("_words", F.split(spelt(F.col(text)), " ")).withColumn("_row", F.xxhash64(*rows.columns))
    probes = tagged.crossJoin(F.broadcast(most)).select("_row", F.explode(F.transform(F.sequence(F.lit(1), F.least("_most", F.size("_words"))), lambda n: F.struct(n.alias("n"), F.array_join(F.slice("_words", F.lit(1), n), " ").alias("_prefix")))).alias("p"))
    hits = probes.select("_row", "p.n", "p._prefix").distinct().join(known, "_prefix").groupBy("_row").agg(F.max(F.struct("n", "_code", "_codes")).alias("_hit"))
    joined = tagged.join(hits, "_row", "left")
    status = F.when(F.col("_hit").isNull(), "none").when(F.col("_hit._codes") > 1, "ambiguous").otherwise("unique")
    rest = F.when(F.col("_hit").isNotNull(), F.array_join(F.slice("_words", F.col("_hit.n") + 1, F.greatest(F.lit(0), F.size("_words") - F.col("_hit.n"))), " "))
    return joined.select(*rows.columns, F.when(status == "unique", F.col("_hit._code")).alias(code), status.alias("prefix_status"), rest.alias("rest"))


def complete_only(parts: Sequence[DataFrame], key: str, total: str, value: str) -> DataFrame:
    """Keys that stand in every part with one and the same total: ``key``, ``total``, the sum of ``value`` and whether all values are known."""
    rows = parts[0].select(key, total, value, F.lit(0).alias("_part"))
    for n, part in enumerate(parts[1:], 1):
        rows = rows.unionByName(part.select(key, total, value, F.lit(n).alias("_part")))
    combined = rows.groupBy(key).agg(F.count_distinct("_part").alias("_parts"), F.count_distinct(total).alias("_totals"), F.max(total).alias(total), F.sum(value).alias(value), F.every(F.col(value).isNotNull()).alias("complete"))
    return combined.filter((F.col("_parts") == len(parts)) & (F.col("_totals") == 1)).select(key, total, value, "complete")


def pairwise_overlap(rows: DataFrame, scope: Sequence[str], source: str, key: str) -> DataFrame:
    """For each pair of sources of a scope that share keys, how many they share.

    Keys that stand in the same sources are counted together first, so only distinct sets of sources are spelt out in pairs.
    """
    sets = rows.filter(F.col(key).isNotNull() & F.col(source).isNotNull()).groupBy(*scope, key).agg(F.array_sort(F.collect_set(source)).alias("_set")).filter(F.size("_set") > 1)
    counted = sets.groupBy(*scope, "_set").agg(F.count("*").alias("_n")).select(*scope, "_set", "_n", F.posexplode("_set").alias("_i", f"{source}_1"))
    pairs = counted.select(*scope, f"{source}_1", "_n", F.explode(F.slice("_set", F.col("_i") + 2, F.size("_set"))).alias(f"{source}_2"))
    return pairs.groupBy(*scope, f"{source}_1", f"{source}_2").agg(F.sum("_n").alias("shared"))


def routed(rows: DataFrame, rules: DataFrame, on: Sequence[str], priority: str, target: str) -> DataFrame:
    """Each row's target by its binding of the highest priority; NULL without a binding; a tie between targets is an error value in ``route_status``."""
    best = rules.groupBy(*on).agg(F.max(priority).alias("_p"))
    tied = rules.join(best, list(on)).filter(F.col(priority) == F.col("_p")).groupBy(*on).agg(F.count_distinct(target).alias("_targets"), F.min(target).alias("_target"))
    joined = rows.join(tied, list(on), "left")
    status = F.when(F.col("_targets").isNull(), "unbound").when(F.col("_targets") > 1, "ambiguous").otherwise("bound")
    return joined.select(*rows.columns, F.when(status == "bound", F.col("_target")).alias(target), status.alias("route_status"))


def aliased(rows: DataFrame, column: str, aliases: DataFrame, alias: str, key: str) -> DataFrame:
    """``rows`` with ``column`` replaced where it stands among the aliases."""
    table = aliases.select(F.col(alias).alias("_alias"), F.col(key).alias("_key")).dropDuplicates(["_alias"])
    return rows.join(table, F.col(column) == F.col("_alias"), "left").withColumn(column, F.coalesce("_key", column)).select(*rows.columns)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of a multiset that the other lacks, with the side: the two cover each other exactly if it is empty."""
    common = left.columns
    return left.exceptAll(right.select(*common)).withColumn("side", F.lit("left")).unionByName(right.select(*common).exceptAll(left).withColumn("side", F.lit("right")))


def beyond_baseline(documents: DataFrame, baselines: DataFrame, scope: Sequence[str], date: str, digest: str) -> DataFrame:
    """Documents of a scope later than its newest baseline and not among the baselines by content; scopes without a baseline give all their documents."""
    cutoff = baselines.groupBy(*scope).agg(F.max(date).alias("_cutoff"))
    newer = documents.join(cutoff, list(scope), "left").filter(F.col("_cutoff").isNull() | (F.col(date) > F.col("_cutoff"))).drop("_cutoff")
    return newer.join(baselines.select(digest).distinct(), digest, "left_anti").select(*documents.columns)


def witnessed_bundles(members: DataFrame, bundle: Sequence[str], label: str, needed: Sequence[str]) -> DataFrame:
    """Bundles whose members of all needed labels were seen together: never combined from members of different ones."""
    seen = members.filter(F.col(label).isin(*needed)).groupBy(*bundle).agg(F.count_distinct(label).alias("_n"))
    return members.join(seen.filter(F.col("_n") == len(set(needed))).select(*bundle), list(bundle), "left_semi")
