"""Editions of a publication: logical editions, events in time, as-of state, and differences that stay honest about identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.operators.ordering import numbered


def edition_aggregates(rows: DataFrame, edition: str, status: str, content: Sequence[str]) -> DataFrame:
    """Per edition the rows, counts by status as a map, and a fingerprint of the content whatever the order of rows."""
    by_status = rows.groupBy(edition, status).agg(F.count("*").alias("_n"), F.bit_xor(F.xxhash64(*content)).alias("_x"), F.sum(F.xxhash64(*content).cast("decimal(38,0)")).alias("_s"))
    out = by_status.groupBy(edition).agg(F.sum("_n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(status, F.lit("")), "_n")))).alias("status_counts"), F.bit_xor("_x").alias("_x"), F.sum("_s").alias("_s"))
    return out.select(edition, "total", "status_counts", F.sha2(F.concat_ws("|", "_x", "_s", "total"), 256).alias("fingerprint"))


def logical_editions(editions: DataFrame, scope: str, date: str, fingerprint: str, document: str, parser: str, id_: str, checked: str) -> DataFrame:
    """Editions of equal scope, date and content as one: its representative's id, the number of documents and versions, the latest check.

    Without a fingerprint only the same document read by the same parser is the same content.
    """
    same = F.when(F.col(fingerprint).isNotNull(), F.concat(F.lit("data|"), fingerprint)).otherwise(F.concat_ws("|", F.lit("document"), document, parser))
    newest_first = F.struct(F.coalesce(-F.unix_micros(F.col(checked).cast("timestamp")), F.lit(2**62)).alias("c"), F.col(id_).alias("i"))
    grouped = editions.withColumn("_content", same).groupBy(scope, date, "_content")
    out = grouped.agg(F.max(F.col(checked)).alias("latest_check"), F.count("*").alias("versions"), F.count_distinct(document).alias("documents"), F.min(newest_first)["i"].alias(id_))
    return out.select(scope, date, id_, "versions", "documents", "latest_check")


def edition_events(editions: DataFrame, scope: str, date: str, id_: str, document: str, parser: str, fingerprint: str, total: str) -> DataFrame:
    """The event each edition is: undated, unordered (several versions of one date), baseline, same_document, parser_revision, file_only, data_changed or document_changed.

    An edition is compared with the one before it in its scope only if neither date is shared; after a shared date a new baseline begins.
    """
    per_date = Window.partitionBy(scope, date)
    w = Window.partitionBy(scope).orderBy(F.col(date).asc_nulls_first(), id_)
    dated = editions.withColumn("_alone", (F.count("*").over(per_date) == 1) & F.col(date).isNotNull())
    before = {c: F.when(F.lag("_alone").over(w) & F.col("_alone"), F.lag(c).over(w)) for c in (id_, document, parser, fingerprint, total, date)}
    joined = dated.withColumns({f"_was_{c}": v for c, v in before.items()})
    was = lambda c: F.col(f"_was_{c}")
    event = (
        F.when(F.col(date).isNull(), "undated")
        .when(~F.col("_alone"), "unordered")
        .when(was(id_).isNull(), "baseline")
        .when(was(document).eqNullSafe(F.col(document)) & was(parser).eqNullSafe(F.col(parser)), "same_document")
        .when(~was(parser).eqNullSafe(F.col(parser)), "parser_revision")
        .when(was(fingerprint).isNotNull() & F.col(fingerprint).isNotNull(), F.when(was(fingerprint) == F.col(fingerprint), "file_only").otherwise("data_changed"))
        .otherwise("document_changed")
    )
    return joined.select(scope, date, id_, was(id_).alias(f"before_{id_}"), event.alias("event"), F.datediff(F.col(date), was(date)).alias("gap_days"), (F.col(total) - was(total)).alias("delta"))


def as_of(editions: DataFrame, scope: str, date: str, id_: str, cutoff: Column) -> DataFrame:
    """For each scope the edition in force: ``state`` is selected (with its id), ambiguous (several of the latest date) or missing."""
    eligible = F.when(F.col(date) <= cutoff, F.col(date))
    dated = editions.withColumn("_d", eligible).groupBy(scope, "_d").agg(F.count("*").alias("_n"), F.min(id_).alias(id_))
    out = dated.groupBy(scope).agg(F.max(F.when(F.col("_d").isNotNull(), F.struct("_d", "_n", id_))).alias("_best"))
    state = F.when(F.col("_best").isNull(), "missing").when(F.col("_best._n") > 1, "ambiguous").otherwise("selected")
    return out.select(scope, state.alias("state"), F.when(state == "selected", F.col(f"_best.{id_}")).alias(id_), F.col("_best._d").alias("as_of"))


def unique_dated(editions: DataFrame, scope: str, date: str) -> DataFrame:
    """Editions whose date no other of the scope has."""
    w = Window.partitionBy(scope, date)
    return editions.filter(F.col(date).isNotNull()).withColumn("_n", F.count("*").over(w)).filter("_n = 1").drop("_n")


def latest_comparable(editions: DataFrame, scope: str, date: str, id_: str, document: str, parser: str) -> DataFrame:
    """Per scope the newest edition and the newest older one of the same parser and another document: ``after``, ``before`` (NULL if none)."""
    alone = unique_dated(editions, scope, date).select(scope, date, id_, document, parser)
    newest = alone.groupBy(scope).agg(F.max(F.struct(date, id_, document, parser)).alias("_a"))
    older = alone.join(newest, scope).filter((F.col(date) < F.col(f"_a.{date}")) & (F.col(parser) == F.col(f"_a.{parser}")) & (F.col(document) != F.col(f"_a.{document}")))
    best = older.groupBy(scope).agg(F.max(F.struct(date, id_)).alias("_b"))
    return newest.join(best, scope, "left").select(scope, F.col(f"_a.{id_}").alias("after"), F.col(f"_b.{id_}").alias("before"))


def latest_per_series(rows: DataFrame, series: Sequence[str], date: str, digest: str) -> DataFrame:
    """Per series the latest date, its digest, and whether the date has more than one."""
    dated = rows.filter(F.col(date).isNotNull()).groupBy(*series, date).agg(F.count_distinct(digest).alias("_n"), F.min(digest).alias(digest))
    return dated.groupBy(*series).agg(F.max(F.struct(date, "_n", digest)).alias("_m")).select(*series, F.col(f"_m.{date}").alias(date), F.when(F.col("_m._n") == 1, F.col(f"_m.{digest}")).alias(digest), (F.col("_m._n") > 1).alias("conflict"))


def update_frequency(editions: DataFrame, scope: str, date: str, document: str) -> DataFrame:
    """Per scope the changes of document between single-dated editions, the median gap in days if there are two or more, and the first and last date."""
    w = Window.partitionBy(scope).orderBy(date)
    alone = unique_dated(editions, scope, date)
    changed = alone.withColumn("_was", F.lag(document).over(w)).filter("_was is null or _was <> " + document)
    gaps = changed.withColumn("_gap", F.datediff(F.col(date), F.lag(date).over(w))).filter("_gap > 0")
    figures = gaps.groupBy(scope).agg(F.count("*").alias("changes"), F.when(F.count("*") >= 2, F.percentile("_gap", F.lit(0.5))).alias("median_gap"))
    seen = editions.groupBy(scope).agg(F.count("*").alias("editions"), F.min(date).alias("first"), F.max(date).alias("last"))
    return seen.join(figures, scope, "left").select(scope, "editions", F.coalesce("changes", F.lit(0)).alias("changes"), "median_gap", "first", "last")


def _one_per_key(rows: DataFrame, key: Sequence[str], ordinal: str, keep: Sequence[str]) -> DataFrame:
    last = rows.groupBy(*key).agg(F.max(F.struct(F.col(ordinal), *keep)).alias("_r"))
    return last.select(*key, *[F.col(f"_r.{c}").alias(c) for c in keep])


def edition_diff(before: DataFrame, after: DataFrame, key: Sequence[str], ordinal: str, status: str, content: Sequence[str]) -> DataFrame:
    """Each key of either edition as added, disappeared, status_changed, content_changed or unchanged, with the transition of status.

    Of rows with one key the one with the greatest ``ordinal`` counts. Keys join null-safe.
    """
    keep = list(dict.fromkeys((status, *content)))
    old, new = (_one_per_key(x, key, ordinal, keep).select(*[F.col(k).alias(f"_{s}_{k}") for k in key], F.struct(*keep).alias(s)) for x, s in ((before, "old"), (after, "new")))
    condition = F.lit(True)
    for k in key:
        condition = condition & F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}"))
    joined = old.join(new, condition, "full_outer")
    differs = lambda cols: ~F.struct(*[F.col(f"old.{c}") for c in cols]).eqNullSafe(F.struct(*[F.col(f"new.{c}") for c in cols]))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "disappeared").when(differs([status]), "status_changed").when(differs(list(content)), "content_changed").otherwise("unchanged")
    return joined.select(
        *[F.coalesce(f"_old_{k}", f"_new_{k}").alias(k) for k in key], change.alias("change"), F.when(change == "status_changed", F.concat_ws("->", F.coalesce(F.col(f"old.{status}"), F.lit("")), F.coalesce(F.col(f"new.{status}"), F.lit("")))).alias("transition")
    )


def guarded_diff(before: DataFrame, after: DataFrame, bundle: str, name: str, status: str) -> DataFrame:
    """Counts of a comparison that links rows only by unambiguous identifier bundles (texts joined by ``|``): one row.

    A bundle on several rows, none at all, one that shares an identifier with a changed bundle of the other side, or one whose name
    changed is unresolved; while any row is, ``added`` and ``disappeared`` are NULL.
    """

    def unique(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy(bundle).agg(F.count("*").alias("_n"), F.min(name).alias("_name"), F.min(status).alias("_status"))
        return counted.withColumn("_ok", F.col(bundle).isNotNull() & (F.col("_n") == 1))

    old, new = unique(before), unique(after)
    left, right = (x.filter("_ok").select(F.col(bundle), F.struct("_name", "_status").alias(s)) for x, s in ((old, "_x"), (new, "_y")))
    both = left.join(right, bundle, "full_outer")
    parts = both.filter("_x is null or _y is null").select(bundle, F.col("_x").isNotNull().alias("_old"), F.explode(F.split(bundle, r"\|")).alias("_part"))
    shared = parts.groupBy("_part").agg(F.max("_old").alias("_o"), F.min("_old").alias("_n")).filter("_o and not _n").select("_part")
    overlapping = parts.join(shared, "_part", "left_semi").select(bundle).distinct().withColumn("_changed", F.lit(True))
    marked = both.join(overlapping, bundle, "left").withColumn("_changed", F.coalesce("_changed", F.lit(False)))
    renamed = F.coalesce(F.col("_x._name") != F.col("_y._name"), F.lit(False))
    common = F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~renamed
    figures = marked.agg(
        F.count_if(F.col("_x").isNull() & ~F.col("_changed")).alias("_added"),
        F.count_if(F.col("_y").isNull() & ~F.col("_changed")).alias("_gone"),
        F.count_if(common).alias("common"),
        F.count_if(common & ~F.col("_x._status").eqNullSafe(F.col("_y._status"))).alias("status_changed"),
        F.count_if((F.col("_changed") & F.col("_x").isNotNull()) | renamed).alias("_ua"),
        F.count_if((F.col("_changed") & F.col("_y").isNotNull()) | renamed).alias("_ub"),
    )
    loose = lambda x, n: x.filter("not _ok").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(n))
    one = figures.crossJoin(F.broadcast(loose(old, "_la"))).crossJoin(F.broadcast(loose(new, "_lb")))
    left_out, right_out = F.col("_ua") + F.col("_la"), F.col("_ub") + F.col("_lb")
    whole = (left_out == 0) & (right_out == 0)
    return one.select(F.when(whole, F.col("_added")).alias("added"), F.when(whole, F.col("_gone")).alias("disappeared"), "common", "status_changed", left_out.alias("unresolved_before"), right_out.alias("unresolved_after"))


def comparison_pairs(editions: DataFrame, scope: str, date: str, id_: str, parser: str, checked: str) -> DataFrame:
    """The edition each one is to be compared with: the only one of the greatest earlier date of its scope and parser, else, for equal or unknown dates, the only one checked last before it."""
    w = Window.partitionBy(scope, parser)
    per_date = editions.groupBy(scope, parser, date).agg(F.count("*").alias("_n"), F.min(id_).alias("_id")).filter(F.col(date).isNotNull())
    by_date = per_date.withColumns({"_prev": F.lag(F.struct("_id", "_n")).over(w.orderBy(date))}).select(scope, parser, date, "_prev")
    dated = editions.join(by_date, [scope, parser, date], "left")
    seen = editions.groupBy(scope, parser, checked).agg(F.count("*").alias("_cn"), F.min(id_).alias("_cid"), F.min(date).alias("_cd")).filter(F.col(checked).isNotNull())
    by_check = seen.withColumn("_cprev", F.lag(F.struct("_cid", "_cn", "_cd")).over(w.orderBy(checked))).select(scope, parser, checked, "_cprev")
    joined = dated.join(by_check, [scope, parser, checked], "left")
    compatible = F.col("_cprev._cd").isNull() | F.col(date).isNull() | (F.col("_cprev._cd") == F.col(date))
    before = F.when(F.col("_prev").isNotNull(), F.when(F.col("_prev._n") == 1, F.col("_prev._id"))).when((F.col("_cprev._cn") == 1) & compatible, F.col("_cprev._cid"))
    basis = F.when(F.col("_prev").isNotNull(), "reference_date").otherwise("check_time")
    return joined.select(scope, F.col(id_).alias("after"), before.alias("before"), basis.alias("basis")).filter("before is not null")


def consecutive_transitions(rows: DataFrame, edition: str, key: str, state: str) -> DataFrame:
    """Counts of key states from each edition to the next over all keys: edition_no, from_state, to_state, n; an absent key has the state ``(absent)``.

    Each key's row is set beside the editions around it, so nothing is joined with itself.
    """
    order = numbered(rows.select(edition).filter(F.col(edition).isNotNull()).distinct(), [edition], "_no").withColumn("_no", F.col("_no") + 1)
    last = order.agg(F.max("_no").alias("_last"))
    placed = rows.join(order, edition).crossJoin(F.broadcast(last))
    w = Window.partitionBy(key).orderBy("_no")
    around = placed.withColumns({"_before": F.when(F.lag("_no").over(w) == F.col("_no") - 1, F.lag(state).over(w)), "_follows": F.coalesce(F.lead("_no").over(w) == F.col("_no") + 1, F.lit(False))})
    absent = F.lit("(absent)")
    arrive = F.when(F.col("_no") > 1, F.struct(F.col("_no").alias("edition_no"), F.coalesce("_before", absent).alias("from_state"), F.col(state).alias("to_state")))
    leave = F.when(~F.col("_follows") & (F.col("_no") < F.col("_last")), F.struct((F.col("_no") + 1).alias("edition_no"), F.col(state).alias("from_state"), absent.alias("to_state")))
    moves = around.select(F.explode(F.array_compact(F.array(arrive, leave))).alias("m")).select("m.*")
    return moves.groupBy("edition_no", "from_state", "to_state").agg(F.count("*").alias("n"))


def merged_ledgers(ledgers: DataFrame, id_: str, fixed: Sequence[str], evidence: str, fill: str) -> DataFrame:
    """The union of ledgers: one row per id with the evidence lists merged and ``fill`` set once known; ``conflict`` if a fixed field differs."""
    differs = [F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\x00"))) > 1 for c in fixed]
    conflict = differs[0]
    for d in differs[1:]:
        conflict = conflict | d
    out = ledgers.groupBy(id_).agg(*[F.min(c).alias(c) for c in fixed], F.array_sort(F.array_distinct(F.flatten(F.collect_set(evidence)))).alias(evidence), F.max(fill).alias(fill), (conflict | (F.count_distinct(fill) > 1)).alias("conflict"))
    return out


def multiset_diff(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with how many times each side has them where the two differ: ``n_before``, ``n_after``."""
    sided = before.select(*columns, F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(after.select(*columns, F.lit(0).alias("_b"), F.lit(1).alias("_a")))
    return sided.groupBy(*columns).agg(F.sum("_b").alias("n_before"), F.sum("_a").alias("n_after")).filter("n_before <> n_after")
