"""Queries on editions: history of entries, drift of file schemas, differences between snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.fold import folded
from tabularium.operators.drift import appearing_alternatives, field_changes
from tabularium.operators.history import OPEN_END, key_history, snapshot_tree
from tabularium.operators.snapshots import snapshot_changes, snapshot_positions
from tabularium.sources.tables import table


def _state():
    return F.xxhash64(folded(F.col("source_name_normalised")), F.col("source_status_code"))


def _version():
    return {"version": F.unix_micros("projected_at"), "tie": F.col("entity_observation_id")}


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions of every entry's folded name and status, dated by the editions of its series."""
    rows = table(spark, sf_dir, "entity_observation")
    stats = rows.groupBy("edition_id").agg(F.min("observation_date").alias("_first"), F.count("*").alias("_n"))
    editions = table(spark, sf_dir, "source_edition").select("edition_id", "source_series_key", "reference_from", "publication_date", "created_at").join(stats, "edition_id", "left")
    published = F.struct(F.coalesce("publication_date", F.lit("0001-01-01").cast("date")), "created_at", "edition_id")
    last = editions.filter("reference_from is not null").groupBy("source_series_key", "reference_from").agg(F.max(published)["edition_id"].alias("edition_id")).select("edition_id")
    counted = editions.join(last, "edition_id", "left_semi").unionByName(editions.filter("reference_from is null"))
    tree = snapshot_tree(
        counted, snapshot="edition_id", group="source_series_key", date=F.coalesce("reference_from", "_first"), order=[F.col("publication_date").asc_nulls_first(), F.col("created_at")], rows=F.col("_n")
    )
    versions = key_history(rows, tree, snapshot="edition_id", key="entry_id", digest=_state(), **_version())
    return versions.select("entry_id", F.col("valid_from").cast("string").alias("valid_from"), F.coalesce(F.col("valid_to").cast("string"), F.lit(OPEN_END)).alias("valid_to"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field added, removed, renamed or retyped between consecutive files of a series."""
    return field_changes(table(spark, sf_dir, "parse_snapshot")).select("parse_run_id", "json_column", "change_kind", "field_name")


def p3_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alternative types of every field of a series."""
    return appearing_alternatives(table(spark, sf_dir, "parse_snapshot"))


def _changes(spark: SparkSession, sf_dir: str, values: tuple[str, ...] = ()) -> DataFrame:
    date = F.coalesce("publication_date", "reference_from")
    positions = snapshot_positions(table(spark, sf_dir, "source_edition"), snapshot="edition_id", group="source_series_key", order=[date.asc_nulls_first(), F.col("created_at")])
    return snapshot_changes(table(spark, sf_dir, "entity_observation"), positions, snapshot="edition_id", key="entry_id", digest=_state(), values=values, **_version())


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries added, removed or changed from each edition to the next of its series."""
    return _changes(spark, sf_dir)


def p6_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with former and present name and status."""
    return _changes(spark, sf_dir, ("source_name_normalised", "source_status_code"))


_FOLD = "regexp_replace(lower(strip_accents(nfc_normalize(source_name_normalised))), '[^a-z0-9]', '', 'g')"
_ROWS = f"""rows_ AS (
  SELECT * FROM (
    SELECT edition_id, entry_id, observation_date, {_FOLD} AS n, source_status_code AS s, source_name_normalised, source_status_code,
           row_number() OVER (PARTITION BY edition_id, entry_id ORDER BY projected_at DESC, entity_observation_id DESC) AS k
    FROM entity_observation) WHERE k = 1)"""

_P2 = f"""
WITH {_ROWS},
first_ AS (SELECT edition_id, min(observation_date) AS d FROM entity_observation GROUP BY 1),
dated AS (
  SELECT e.edition_id, e.source_series_key, coalesce(e.reference_from, f.d) AS d, e.publication_date, e.created_at, e.reference_from,
         row_number() OVER (PARTITION BY e.source_series_key, e.reference_from ORDER BY e.publication_date DESC NULLS LAST, e.created_at DESC, e.edition_id DESC) AS k
  FROM source_edition e LEFT JOIN first_ f USING (edition_id)),
ed AS (
  SELECT edition_id, source_series_key, d,
         row_number() OVER (PARTITION BY source_series_key ORDER BY d, publication_date ASC NULLS FIRST, created_at, edition_id) AS i,
         lead(d) OVER (PARTITION BY source_series_key ORDER BY d, publication_date ASC NULLS FIRST, created_at, edition_id) AS nd
  FROM dated WHERE d IS NOT NULL AND (reference_from IS NULL OR k = 1)),
x AS (SELECT r.entry_id, e.i, e.d, e.nd, r.n, r.s FROM rows_ r JOIN ed e USING (edition_id)),
y AS (SELECT *, CASE WHEN lag(i) OVER w = i - 1 AND lag(n) OVER w = n AND lag(s) OVER w = s THEN 0 ELSE 1 END AS b FROM x WINDOW w AS (PARTITION BY entry_id ORDER BY i)),
z AS (SELECT *, sum(b) OVER (PARTITION BY entry_id ORDER BY i) AS run FROM y)
SELECT entry_id, CAST(min(d) AS VARCHAR) AS valid_from, coalesce(CAST(arg_max(coalesce(nd, DATE '9999-12-31'), i) AS VARCHAR), '9999-12-31') AS valid_to
FROM z GROUP BY entry_id, run"""

_P6 = f"""
WITH {_ROWS},
ed AS (
  SELECT edition_id, row_number() OVER w AS i, lead(edition_id) OVER w AS next_id, lag(edition_id) OVER w AS prev_id FROM source_edition
  WINDOW w AS (PARTITION BY source_series_key ORDER BY coalesce(publication_date, reference_from), created_at, edition_id)),
x AS (SELECT r.*, e.next_id, e.prev_id FROM rows_ r JOIN ed e USING (edition_id)),
ch AS (
  SELECT a.edition_id, a.entry_id, CASE WHEN b.entry_id IS NULL THEN 'added' ELSE 'changed' END AS change_kind,
         b.source_name_normalised AS old_source_name_normalised, b.source_status_code AS old_source_status_code, a.source_name_normalised AS new_source_name_normalised, a.source_status_code AS new_source_status_code
  FROM x a LEFT JOIN x b ON b.edition_id = a.prev_id AND b.entry_id = a.entry_id
  WHERE a.prev_id IS NOT NULL AND (b.entry_id IS NULL OR a.n <> b.n OR a.s <> b.s)
  UNION ALL
  SELECT a.next_id, a.entry_id, 'removed', a.source_name_normalised, a.source_status_code, NULL, NULL
  FROM x a LEFT JOIN x b ON b.edition_id = a.next_id AND b.entry_id = a.entry_id WHERE a.next_id IS NOT NULL AND b.entry_id IS NULL)"""

QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_alternatives": p3_alternatives, "p6_found": p6_found, "p6_changes": p6_changes}
SQL = {"p2_found": _P2, "p6_found": _P6 + "\nSELECT edition_id, entry_id, change_kind FROM ch", "p6_changes": _P6 + "\nSELECT * FROM ch"}
