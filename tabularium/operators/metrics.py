"""Aggregates of registers: exact quantiles, ranks, cohorts, lags, weighted figures, calendars, coverage.

Unknown stays NULL: a figure that needs values that are missing is NULL and never 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.operators.ordering import running_total


def quantile_summary(rows: DataFrame, by: Sequence[str], value: Column, thresholds: Sequence[float] = ()) -> DataFrame:
    """n, p25, median, p75 and p90 by linear interpolation with two decimals, and the counts above thresholds; no values give n = 0 and NULLs."""
    points = F.percentile(value, F.array(*map(F.lit, (0.25, 0.5, 0.75, 0.9))))
    over = [F.count_if(value > t).alias(f"over_{t:g}".replace(".", "_")) for t in thresholds]
    out = rows.groupBy(*by).agg(F.count(value).alias("n"), points.alias("_q"), *over)
    return out.select(*by, "n", *[F.round(F.element_at("_q", i), 2).alias(n) for i, n in enumerate(("p25", "median", "p75", "p90"), 1)], *[o for o in out.columns if o.startswith("over_")])


def histogram(rows: DataFrame, by: Sequence[str], value: Column, edges: Sequence[float]) -> DataFrame:
    """Counts of values below, between and from the edges on (half-open), and of missing values, in columns that add up to n."""
    bounds = [None, *edges, None]
    cells = [F.count_if((F.lit(True) if lo is None else value >= lo) & (F.lit(True) if hi is None else value < hi) & value.isNotNull()).alias(f"bin_{i}") for i, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False))]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *cells, F.count_if(value.isNull()).alias("missing"))


def share_bounds(rows: DataFrame, by: Sequence[str], condition: Column) -> DataFrame:
    """Least and greatest possible share of rows with a condition that is unknown (NULL) for some."""
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(condition).alias("met"), F.count_if(condition.isNull()).alias("unknown"))
    return out.withColumns({"lower": F.round(F.try_divide("met", "n"), 6), "upper": F.round(F.try_divide(F.col("met") + F.col("unknown"), "n"), 6)})


def competition_rank(rows: DataFrame, by: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """1, 1, 3 ranks from the greatest value down; missing values have no rank. Over all rows (no ``by``) distinct values are counted and totalled by ranges, not in one task."""
    if by:
        w = Window.partitionBy(*by, F.col(value).isNull()).orderBy(F.col(value).desc())
        return rows.withColumn(name, F.when(F.col(value).isNotNull(), F.rank().over(w)))
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    above = running_total(counts, [F.col("_value").desc()], F.col("_n"), "_above")
    return rows.join(above, F.col(value) == F.col("_value"), "left").withColumn(name, F.col("_above") + 1).select(*rows.columns, name)


def midrank_score(rows: DataFrame, by: Sequence[str], value: str, name: str = "score") -> DataFrame:
    """0 to 100 by the mean position among ties; NULL for missing values and where fewer than two are known. Over all rows (no ``by``) as ``competition_rank``."""
    known = F.col(value).isNotNull()
    score = lambda below, ties, n: F.when(known, F.try_divide(100.0 * (below + (ties - 1) / 2), F.nullif(n - 1, F.lit(0))))
    if by:
        w = Window.partitionBy(*by, F.col(value).isNull())
        ties = F.count("*").over(Window.partitionBy(*by, F.col(value).isNull(), value))
        return rows.withColumn(name, score(F.rank().over(w.orderBy(value)) - 1, ties, F.count("*").over(w)))
    counts = rows.filter(known).groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_ties"))
    below = running_total(counts, ["_value"], F.col("_ties"), "_below")
    total = rows.agg(F.count(value).alias("_known"))
    joined = rows.join(below, F.col(value) == F.col("_value"), "left").crossJoin(F.broadcast(total))
    return joined.withColumn(name, score(F.col("_below"), F.col("_ties"), F.col("_known"))).select(*rows.columns, name)


def mean_of_complete(scores: DataFrame, key: str, event: str, score: str) -> DataFrame:
    """The mean score of keys that have one in every event, and their rank."""
    events = scores.agg(F.count_distinct(event).alias("_events"))
    means = scores.filter(F.col(score).isNotNull()).groupBy(key).agg(F.count_distinct(event).alias("_n"), F.avg(score).alias("mean_score"))
    complete = means.crossJoin(F.broadcast(events)).filter("_n = _events").select(key, "mean_score")
    return competition_rank(complete, [], "mean_score")


def weighted_times(rows: DataFrame, by: Sequence[str], hours: str, weight: str, share: float = 0.9) -> DataFrame:
    """Weighted mean, first time at which ``share`` of the weight is reached, and last time; all NULL if a time of the group is missing."""
    per_time = rows.groupBy(*by, hours).agg(F.sum(weight).alias("_w"))
    w = Window.partitionBy(*by).orderBy(F.col(hours).asc_nulls_last())
    run = per_time.withColumns({"_run": F.sum("_w").over(w), "_all": F.sum("_w").over(Window.partitionBy(*by)), "_miss": F.max(F.col(hours).isNull()).over(Window.partitionBy(*by))})
    whole = ~F.col("_miss")
    return run.groupBy(*by).agg(
        F.sum("_w").alias("weight"),
        F.round(F.try_divide(F.sum(F.when(whole, F.col(hours) * F.col("_w"))), F.sum(F.when(whole, F.col("_w")))), 6).alias("weighted_mean"),
        F.min(F.when(whole & (F.col("_run") >= share * F.col("_all")), F.col(hours))).alias("share_reached"),
        F.max(F.when(whole, F.col(hours))).alias("last"),
    )


def rolled_up(rows: DataFrame, by: Sequence[str], value: str, at: str) -> DataFrame:
    """Sum of values, the latest time only if every row has one, and whether all rows are valid."""
    out = rows.groupBy(*by).agg(F.sum(value).alias(value), F.count("*").alias("_n"), F.count(at).alias("_known"), F.max(at).alias("_last"), F.every(F.col(value).isNotNull() & F.col(at).isNotNull()).alias("valid"))
    return out.select(*by, value, F.when(F.col("_n") == F.col("_known"), F.col("_last")).alias(at), "valid")


def facet_totals(rows: DataFrame, facets: Sequence[str]) -> DataFrame:
    """Counts by each facet alone in one pass: facet, value, n."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value")) for f in facets])).alias("p")
    return rows.select(pairs).groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))


def shares(rows: DataFrame, by: Sequence[str], category: str) -> DataFrame:
    """Counts of each category and its percentage of the group."""
    counted = rows.groupBy(*by, category).agg(F.count("*").alias("n"))
    return counted.withColumn("percent", F.bround(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*by)), 2))


def calendar_bins(rows: DataFrame, date: str, unit: str, start: str, end: str) -> DataFrame:
    """Counts for every month or year from ``start`` to ``end``, zeros included: bin, n."""
    step = {"month": "interval 1 month", "year": "interval 1 year"}[unit]
    spark = rows.sparkSession
    bins = spark.range(1).select(F.explode(F.expr(f"sequence(date'{start}', date'{end}', {step})")).alias("bin"))
    counts = rows.filter(F.col(date).isNotNull()).groupBy(F.trunc(date, unit).alias("bin")).agg(F.count("*").alias("n"))
    return bins.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def first_seen_cohorts(rows: DataFrame, key: str, edition: str, state: str, entering: str, leaving: str) -> DataFrame:
    """Cohorts of keys by the edition where they first had the state ``entering``, split by their state in the last edition.

    Result: cohort, n, still_entering, left (state ``leaving``), other, not_observed, ever_left (had ``leaving`` after their first). Keys never entering are left out.
    """
    last = rows.agg(F.max(edition).alias("_last"))
    first = rows.groupBy(key).agg(F.min(F.when(F.col(state) == entering, F.col(edition))).alias("cohort"), F.max(F.when(F.col(state) == leaving, F.col(edition))).alias("_leaving"), F.max_by(state, edition).alias("_state"), F.max(edition).alias("_seen"))
    joined = first.filter("cohort is not null").crossJoin(F.broadcast(last))
    final = F.when(F.col("_seen") < F.col("_last"), "not_observed").when(F.col("_state") == entering, "still_entering").when(F.col("_state") == leaving, "left").otherwise("other")
    return joined.withColumn("_final", final).groupBy("cohort").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("_final") == c).alias(c) for c in ("still_entering", "left", "other", "not_observed")], F.count_if(F.coalesce(F.col("_leaving") > F.col("cohort"), F.lit(False))).alias("ever_left")
    )


def linked_lags(rows: DataFrame, key: str, at: str, state: str, entering: str, leaving: str, blocking: Sequence[str] = ()) -> DataFrame:
    """Per key the days between the last ``entering`` observation before the first ``leaving`` one, or the first reason why there is none."""
    firsts = rows.groupBy(key).agg(F.min(F.when(F.col(state) == leaving, F.col(at))).alias("first_leaving"), F.max(F.when(F.col(state) == entering, F.col(at))).alias("_any"))
    joined = rows.join(firsts.filter("first_leaving is not null and _any is not null"), key)
    early = F.col(at) < F.col("first_leaving")
    out = joined.groupBy(key, "first_leaving").agg(
        F.max(F.when((F.col(state) == entering) & early, F.col(at))).alias("last_entering"),
        F.coalesce(F.max(F.when(early | (F.col(at) == F.col("first_leaving")), F.col(state).isin(*blocking) if blocking else F.lit(False))), F.lit(False)).alias("_blocked"),
    )
    reason = F.when(F.col("last_entering").isNull(), "no_earlier_entering").when(F.col("_blocked"), "blocked_before_leaving")
    return out.select(key, reason.alias("excluded"), F.when(reason.isNull(), F.datediff("first_leaving", "last_entering")).alias("lag_days"))


def weighted_review(rows: DataFrame, stratum: str, verdict: str, weight: str, correct: Sequence[str], wrong: Sequence[str]) -> DataFrame:
    """Precision of each stratum and over all, weighted by the population each reviewed row stands for; undecided verdicts are left out of it."""
    yes, no = F.col(verdict).isin(*correct), F.col(verdict).isin(*wrong)
    figures = lambda g: g.agg(
        F.count("*").alias("n"), F.count_if(yes).alias("correct"), F.count_if(yes | no).alias("decided"), F.round(F.try_divide(F.sum(F.when(yes, F.col(weight))), F.sum(F.when(yes | no, F.col(weight)))), 6).alias("precision")
    )
    return figures(rows.groupBy(stratum)).unionByName(figures(rows.groupBy(F.lit("(all)").alias(stratum))))


def coverage_matrix(rows: DataFrame, targets: DataFrame, kinds: Sequence[str], kind: str, both: str) -> DataFrame:
    """Whether each target has a row of each kind; a row of kind ``both`` serves every kind. Targets without rows appear as uncovered."""
    on = targets.columns
    flags = rows.groupBy(*on).agg(*[F.max(F.col(kind).isin(k, both)).alias(f"has_{k}") for k in kinds])
    joined = targets.distinct().join(flags, on, "left")
    return joined.select(*on, *[F.coalesce(f"has_{k}", F.lit(False)).alias(f"has_{k}") for k in kinds])


def pivoted(rows: DataFrame, key: Sequence[str], name: str, value: str, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Long rows to one row per key: each wanted column is the greatest value among its names."""
    return rows.groupBy(*key).agg(*[F.max(F.when(F.col(name).isin(*names), F.col(value))).alias(column) for column, names in wanted.items()])


def unpivoted(rows: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key and field: ``field``, ``raw_value`` as text and ``parsed_value`` as JSON; NULL fields stay as rows."""
    cells = F.array(*[F.struct(F.lit(v).alias("field"), F.col(v).cast("string").alias("raw_value"), F.to_json(F.struct(F.col(v).alias("value")), {"ignoreNullFields": "false"}).alias("parsed_value")) for v in values])
    return rows.select(*key, F.explode(cells).alias("c")).select(*key, "c.*")


def content_fingerprint(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row count and a hash of the multiset of rows of each group, whatever their order: sums and exclusive-ors combine before the shuffle."""
    h = F.xxhash64(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.bit_xor(h).alias("hash_xor"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"))


def archive_summary(rows: DataFrame, distinct: Sequence[str], date: str) -> DataFrame:
    """One row: rows, distinct values of some columns, first and last date, and the last date only if no date is missing."""
    return rows.agg(F.count("*").alias("n"), *[F.count_distinct(c).alias(f"n_{c}") for c in distinct], F.min(date).alias("first"), F.max(date).alias("last"), F.when(F.count(date) == F.count("*"), F.max(date)).alias("last_if_complete"))
