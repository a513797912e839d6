"""From parsed records to typed observations: records with defaults, moved fields, one row per identifier, office and activity."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.scalars import clean, first_nonblank, identifiers, items, stable_key
from tabularium.operators.ordering import numbered
from tabularium.session import written

#: Projectors by the name of a profile: (records) to tables of observations by name.
PROJECTORS: dict[str, Callable[[DataFrame], dict[str, DataFrame]]] = {}


def projector(name: str) -> Callable:
    """Registers a projector under the name of its profile; a second one of the same name is an error."""

    def register(function: Callable[[DataFrame], dict[str, DataFrame]]) -> Callable:
        if PROJECTORS.setdefault(name, function) is not function:
            raise ValueError(f"projector {name} is registered twice")
        return function

    return register


def built(rows: DataFrame, texts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Records with text columns that are never NULL: each the first that is not blank of its candidates, cleaned; missing candidates are passed over."""
    have = lambda names: [F.col(n) for n in names if n in rows.columns]
    return rows.select(*[clean(first_nonblank(*c) if (c := have(names)) else F.lit(None)).alias(name) for name, names in texts.items()])


def moved(rows: DataFrame, rename: Mapping[str, str], aside: Sequence[str], into: str = "source_fields") -> DataFrame:
    """Rows with columns renamed and others moved into one struct."""
    kept = [F.col(c).alias(rename.get(c, c)) for c in rows.columns if c not in aside]
    return rows.select(*kept, F.struct(*[F.col(c) for c in aside if c in rows.columns]).alias(into))


def projected(records: DataFrame, run: str, position: str, name: str, identifier: str, office: str, activity: str) -> dict[str, DataFrame]:
    """The observations of records as tables with keys that are the same in every run: entities, identifiers, offices, activities and issues (records without a name)."""
    keyed = records.withColumn("entity_key", stable_key(F.col(run), F.col(position)))
    named = clean(F.col(name))
    one = lambda values, column: keyed.select("entity_key", F.posexplode(values).alias("ordinal", column))
    return {
        "entities": keyed.filter(named != "").select("entity_key", run, position, named.alias("name")),
        "identifiers": one(identifiers(F.col(identifier)), "identifier"),
        "offices": keyed.select("entity_key", clean(F.col(office)).alias("office")).filter("office <> ''"),
        "activities": one(items(F.col(activity)), "activity"),
        "issues": keyed.filter(named == "").select("entity_key", F.lit("no_name").alias("issue")),
    }


def selected_jobs(candidates: DataFrame, resource: Sequence[str], captured: str, digest: str, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Of each resource the newest candidate that meets all rules, and the candidates left out with the first rule they fail (or ``superseded``)."""
    reason = F.coalesce(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()], F.lit(None).cast("string"))
    judged = candidates.withColumn("reason", reason)
    newest = judged.filter("reason is null").groupBy(*resource).agg(F.max(F.struct(captured, digest)).alias("_m"))
    joined = judged.join(newest, list(resource), "left")
    chosen = F.col("reason").isNull() & (F.struct(captured, digest) == F.col("_m"))
    jobs = joined.filter(chosen).drop("reason", "_m").dropDuplicates([*resource])
    left = joined.filter(~F.coalesce(chosen, F.lit(False))).withColumn("reason", F.coalesce("reason", F.lit("superseded"))).drop("_m")
    return jobs, left


def newest_frozen(candidates: DataFrame, resource: Sequence[str], captured: str, content: Sequence[str], id_: str) -> DataFrame:
    """Of each resource the newest capture: resource, ``id_``, ``state``. Equal content at the newest time gives the least id; different content is ``ambiguous`` and has none."""
    newest = candidates.groupBy(*resource).agg(F.max(captured).alias("_newest"))
    latest = candidates.join(newest, list(resource)).filter(F.col(captured) == F.col("_newest"))
    out = latest.groupBy(*resource).agg(F.min(id_).alias("_id"), F.count_distinct(F.struct(*content)).alias("_contents"))
    return out.select(*resource, F.when(F.col("_contents") == 1, F.col("_id")).alias(id_), F.when(F.col("_contents") == 1, "selected").otherwise("ambiguous").alias("state"))


def synchronised(state: DataFrame, sources: DataFrame, key: Sequence[str], date: str, amount: str, latest: str) -> DataFrame:
    """The monitoring state of all keys with what is published of each: ``sources_selected``, ``amount_selected`` and ``latest`` moved forward, never back.

    Keys without a published source have 0 and keep their date; sources of keys outside the state are no concern of it (see ``validate.orphans``).
    """
    published = sources.groupBy(*key).agg(F.count("*").alias("sources_selected"), F.sum(amount).alias("amount_selected"), F.max(date).alias("_latest"))
    joined = state.join(published, list(key), "left")
    kept = [F.greatest(latest, "_latest").alias(c) if c == latest else F.col(c) for c in state.columns]
    return joined.select(*kept, F.coalesce("sources_selected", F.lit(0)).alias("sources_selected"), F.coalesce("amount_selected", F.lit(0)).alias("amount_selected"))


def reconciled(state: DataFrame, report: DataFrame, key: Sequence[str], complete: str, issues: str, settled: str) -> DataFrame:
    """The monitoring state with ``complete`` as all parts of the report say, and the issue ``settled`` taken from the list ``issues`` where they are complete. Keys the report lacks stay as they are."""
    parts = report.groupBy(*key).agg(F.every(F.coalesce(complete, F.lit(False))).alias("_complete"))
    joined = state.join(parts, list(key), "left")
    made = {complete: F.coalesce("_complete", complete), issues: F.when(F.col("_complete"), F.array_remove(issues, settled)).otherwise(F.col(issues))}
    return joined.select(*[made.get(c, F.col(c)).alias(c) for c in state.columns])


def receipt(rows: DataFrame, open_fields: Sequence[str], facts: Mapping[str, Column]) -> DataFrame:
    """What may be shown of private records: the named fields, NULL where a record lacks them, and facts told as booleans; nothing else, whatever columns are added later."""
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in open_fields], *[F.coalesce(f, F.lit(False)).alias(n) for n, f in facts.items()])


def state_history(revisions: DataFrame, order: str, state: str, items: str, key: str) -> DataFrame:
    """What retained revisions of a JSON state say of each item of its list ``items``, wherever it differs from the revision before: order, key, item (JSON), ``change`` (added, changed, removed).

    A revision that cannot be read has no items of its own and is passed over.
    """
    listed = F.from_json(F.get_json_object(state, f"$.{items}"), "array<string>")
    read = revisions.withColumn("_items", listed).filter(F.col("_items").isNotNull())
    at = written(numbered(read.select(order).distinct(), [order], "_n"), "revisions")
    chain = at.join(at.select(F.col(order).alias("_next"), (F.col("_n") - 1).alias("_n")), "_n").select(order, "_next")
    told = read.select(order, F.explode("_items").alias("item")).withColumn(key, F.get_json_object("item", f"$.{key}")).filter(F.col(key).isNotNull())
    was = told.join(chain, order).select(F.col("_next").alias(order), key, F.col("item").alias("_was"))
    first = read.agg(F.min(order).alias("_first"))
    both = told.join(was, [order, key], "full_outer").crossJoin(F.broadcast(first))
    change = F.when(F.col("_was").isNull(), "added").when(F.col("item").isNull(), "removed").when(F.col("item") != F.col("_was"), "changed")
    return both.select(order, key, F.coalesce("item", "_was").alias("item"), change.alias("change")).filter("change is not null")
