"""Queries of the register operators on the tables of lists, editions, observations and files, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions import filters
from tabularium.functions.fold import folded
from tabularium.functions.scalars import bundle_key, ladder, mask_ids, normalised_name, percent, shard_digit, street_and_civic
from tabularium.operators import editions as E
from tabularium.operators import metrics as M
from tabularium.operators import relations as R
from tabularium.operators import geo, project, resolve, sampling, supersede, validate
from tabularium.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its name, with its SQL if there is one."""

    def register(function: Callable) -> Callable:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def _editions(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "source_edition")


def _observed(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "entity_observation")


def _files(s: SparkSession, d: str) -> DataFrame:
    """Editions with the file they were first read from: scope, date, id, document, parser, total."""
    first = R.latest(table(s, d, "parse_snapshot").filter("edition_id is not null").withColumn("_o", -F.unix_micros("created_at")), ["edition_id"], ["_o", "parse_run_id"])
    files = first.select("edition_id", F.col("snapshot_sha256").alias("document"), F.get_json_object("diagnostics_json", "$.parser").alias("parser"), F.col("record_count").cast("bigint").alias("total"))
    return _editions(s, d).select("edition_id", "source_series_key", "reference_from").join(files, "edition_id")


_FILES = """f AS (
  SELECT * FROM (SELECT edition_id, snapshot_sha256 AS document, json_extract_string(diagnostics_json, '$.parser') AS parser, CAST(record_count AS BIGINT) AS total,
                        row_number() OVER (PARTITION BY edition_id ORDER BY created_at, parse_run_id DESC) AS k FROM parse_snapshot WHERE edition_id IS NOT NULL) WHERE k = 1),
e AS (SELECT s.edition_id, s.source_series_key, s.reference_from, f.document, f.parser, f.total FROM source_edition s JOIN f USING (edition_id)),
a AS (SELECT *, count(*) OVER (PARTITION BY source_series_key, reference_from) AS same FROM e)"""


@query("""SELECT edition_id, CAST(sum(n) AS BIGINT) AS total, string_agg(s || '=' || n, ',' ORDER BY s) AS statuses
FROM (SELECT edition_id, source_status_code AS s, count(*) AS n FROM entity_observation GROUP BY 1, 2) GROUP BY 1""")
def edition_totals(s: SparkSession, d: str) -> DataFrame:
    """Rows and counts by status of every edition."""
    out = E.edition_aggregates(_observed(s, d), "edition_id", "source_status_code", ["entry_id", "source_name_normalised", "source_status_code"])
    text = F.array_join(F.transform(F.array_sort(F.map_entries("status_counts")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return out.select("edition_id", "total", text.alias("statuses"))


_CONTENT = "c AS (SELECT edition_id, concat_ws('|', count(*), CAST(sum(entry_id) AS BIGINT), min(source_name_normalised), max(source_status_code)) AS fp FROM entity_observation GROUP BY 1)"


def _contents(s: SparkSession, d: str) -> DataFrame:
    """What an edition's rows amount to, in a text that both engines make alike."""
    fingerprint = F.concat_ws("|", F.count("*"), F.sum("entry_id"), F.min("source_name_normalised"), F.max("source_status_code"))
    return _observed(s, d).groupBy("edition_id").agg(fingerprint.alias("fingerprint"))


@query(f"""WITH {_FILES}, {_CONTENT}, b AS (SELECT a.*, c.fp FROM a LEFT JOIN c USING (edition_id)),
w AS (SELECT *, lag(CASE WHEN same = 1 AND reference_from IS NOT NULL THEN 1 ELSE 0 END) OVER o AS pa, lag(edition_id) OVER o AS pi, lag(document) OVER o AS pd, lag(parser) OVER o AS pp, lag(total) OVER o AS pt, lag(reference_from) OVER o AS pr, lag(fp) OVER o AS pf
      FROM b WINDOW o AS (PARTITION BY source_series_key ORDER BY reference_from ASC NULLS FIRST, edition_id)),
x AS (SELECT *, CASE WHEN pa = 1 AND same = 1 AND reference_from IS NOT NULL THEN 1 ELSE 0 END AS v FROM w)
SELECT source_series_key, edition_id, CASE WHEN v = 1 THEN pi END AS before_edition_id,
  CASE WHEN reference_from IS NULL THEN 'undated' WHEN same > 1 THEN 'unordered' WHEN v = 0 THEN 'baseline'
       WHEN document IS NOT DISTINCT FROM pd AND parser IS NOT DISTINCT FROM pp THEN 'same_document' WHEN parser IS DISTINCT FROM pp THEN 'parser_revision'
       WHEN pf IS NOT NULL AND fp IS NOT NULL THEN CASE WHEN pf = fp THEN 'file_only' ELSE 'data_changed' END ELSE 'document_changed' END AS event,
  CASE WHEN v = 1 THEN date_diff('day', pr, reference_from) END AS gap_days, CASE WHEN v = 1 THEN total - pt END AS delta FROM x""")
def edition_events(s: SparkSession, d: str) -> DataFrame:
    """The event each edition is in its series."""
    out = E.edition_events(_files(s, d).join(_contents(s, d), "edition_id", "left"), "source_series_key", "reference_from", "edition_id", "document", "parser", "fingerprint", "total")
    return out.select("source_series_key", "edition_id", "before_edition_id", "event", F.col("gap_days").cast("bigint").alias("gap_days"), "delta")

@query("""WITH c AS (SELECT source_series_key, reference_from, count(*) AS n, min(edition_id) AS i FROM source_edition WHERE reference_from <= DATE '2024-01-01' GROUP BY 1, 2),
b AS (SELECT source_series_key, max(reference_from) AS m FROM c GROUP BY 1)
SELECT s.source_series_key, CASE WHEN b.m IS NULL THEN 'missing' WHEN c.n > 1 THEN 'ambiguous' ELSE 'selected' END AS state, CASE WHEN c.n = 1 THEN c.i END AS edition_id, CAST(b.m AS VARCHAR) AS as_of
FROM (SELECT DISTINCT source_series_key FROM source_edition) s LEFT JOIN b USING (source_series_key) LEFT JOIN c ON c.source_series_key = s.source_series_key AND c.reference_from = b.m""")
def editions_as_of(s: SparkSession, d: str) -> DataFrame:
    """The edition of each series in force on a day."""
    return E.as_of(_editions(s, d), "source_series_key", "reference_from", "edition_id", F.lit("2024-01-01").cast("date")).withColumn("as_of", F.col("as_of").cast("string"))


@query("""SELECT source_series_key, edition_id FROM (SELECT *, count(*) OVER (PARTITION BY source_series_key, reference_from) AS n FROM source_edition WHERE reference_from IS NOT NULL) WHERE n = 1""")
def editions_alone_on_their_date(s: SparkSession, d: str) -> DataFrame:
    """Editions whose date no other of the series has."""
    return E.unique_dated(_editions(s, d), "source_series_key", "reference_from").select("source_series_key", "edition_id")


@query(f"""WITH {_FILES}, u AS (SELECT * FROM a WHERE same = 1 AND reference_from IS NOT NULL),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_series_key ORDER BY reference_from DESC) AS k FROM u) WHERE k = 1),
b AS (SELECT u.source_series_key, arg_max(u.edition_id, u.reference_from) AS i FROM u JOIN n ON n.source_series_key = u.source_series_key AND u.reference_from < n.reference_from AND u.parser = n.parser AND u.document <> n.document GROUP BY 1)
SELECT n.source_series_key, n.edition_id AS after, b.i AS before FROM n LEFT JOIN b USING (source_series_key)""")
def latest_comparable_editions(s: SparkSession, d: str) -> DataFrame:
    """The newest edition of each series and the newest comparable one before it."""
    return E.latest_comparable(_files(s, d), "source_series_key", "reference_from", "edition_id", "document", "parser")


@query(f"""WITH {_FILES}, u AS (SELECT *, lag(document) OVER (PARTITION BY source_series_key ORDER BY reference_from) AS pd FROM a WHERE same = 1 AND reference_from IS NOT NULL),
c AS (SELECT *, date_diff('day', lag(reference_from) OVER (PARTITION BY source_series_key ORDER BY reference_from), reference_from) AS gap FROM u WHERE pd IS NULL OR pd <> document),
g AS (SELECT source_series_key, count(*) AS changes, CASE WHEN count(*) >= 2 THEN quantile_cont(gap, 0.5) END AS median_gap FROM c WHERE gap > 0 GROUP BY 1)
SELECT e2.source_series_key, e2.editions, coalesce(g.changes, 0) AS changes, g.median_gap, e2.first, e2.last
FROM (SELECT source_series_key, count(*) AS editions, CAST(min(reference_from) AS VARCHAR) AS first, CAST(max(reference_from) AS VARCHAR) AS last FROM e GROUP BY 1) e2 LEFT JOIN g USING (source_series_key)""")
def update_frequencies(s: SparkSession, d: str) -> DataFrame:
    """How often the document of each series changes."""
    out = E.update_frequency(_files(s, d), "source_series_key", "reference_from", "document")
    return out.withColumns({"first": F.col("first").cast("string"), "last": F.col("last").cast("string")})


@query("""WITH g AS (SELECT source_series_key, edition_id, snapshot_sha256, count(*) AS versions, count(DISTINCT parse_run_id) AS runs, max(created_at) AS c FROM parse_snapshot GROUP BY 1, 2, 3)
SELECT g.source_series_key, g.edition_id, min(p.parse_run_id) AS parse_run_id, any_value(g.versions) AS versions, any_value(g.runs) AS documents
FROM g JOIN parse_snapshot p ON p.source_series_key = g.source_series_key AND p.edition_id = g.edition_id AND p.snapshot_sha256 = g.snapshot_sha256 AND p.created_at = g.c GROUP BY g.source_series_key, g.edition_id, g.snapshot_sha256""")
def logical_file_editions(s: SparkSession, d: str) -> DataFrame:
    """Files of equal content of an edition as one."""
    files = table(s, d, "parse_snapshot").select("source_series_key", "edition_id", "snapshot_sha256", "parse_run_id", F.get_json_object("diagnostics_json", "$.parser").alias("parser"), "created_at")
    out = E.logical_editions(files.withColumn("document", F.col("parse_run_id")), "source_series_key", "edition_id", "snapshot_sha256", "document", "parser", "parse_run_id", "created_at")
    return out.select("source_series_key", "edition_id", "parse_run_id", "versions", "documents")


@query(f"""WITH {_FILES}, x AS (SELECT source_series_key, reference_from, count(DISTINCT document) AS n, min(document) AS document FROM e WHERE reference_from IS NOT NULL GROUP BY 1, 2)
SELECT source_series_key, CAST(reference_from AS VARCHAR) AS reference_from, CASE WHEN n = 1 THEN document END AS document, n > 1 AS conflict FROM (SELECT *, row_number() OVER (PARTITION BY source_series_key ORDER BY reference_from DESC) AS k FROM x) WHERE k = 1""")
def latest_documents(s: SparkSession, d: str) -> DataFrame:
    """The latest document of each series and whether its date has several."""
    return E.latest_per_series(_files(s, d), ["source_series_key"], "reference_from", "document").withColumn("reference_from", F.col("reference_from").cast("string"))


def _ends(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    published = F.struct(F.coalesce("publication_date", "reference_from"), "created_at", "edition_id")
    ends = _editions(s, d).groupBy("source_series_key").agg(F.min(published)["edition_id"].alias("_first"), F.max(published)["edition_id"].alias("_last"))
    observed = _observed(s, d).select("edition_id", "entry_id", "source_status_code", "source_name_normalised", "projected_at")
    rows = observed.join(_editions(s, d).select("edition_id", "source_series_key"), "edition_id").join(ends, "source_series_key")
    rows = rows.withColumn("at", F.unix_micros("projected_at"))
    return rows.filter("edition_id = _first"), rows.filter("edition_id = _last")


@query("""WITH e AS (SELECT *, row_number() OVER (PARTITION BY source_series_key ORDER BY coalesce(publication_date, reference_from), created_at, edition_id) AS i,
                  row_number() OVER (PARTITION BY source_series_key ORDER BY coalesce(publication_date, reference_from) DESC, created_at DESC, edition_id DESC) AS j FROM source_edition),
r AS (SELECT e.source_series_key, o.entry_id, o.source_status_code AS st, o.source_name_normalised AS nm, e.i, e.j, row_number() OVER (PARTITION BY o.edition_id, o.entry_id ORDER BY o.projected_at DESC) AS k FROM entity_observation o JOIN e USING (edition_id)),
b AS (SELECT * FROM r WHERE i = 1 AND k = 1), a AS (SELECT * FROM r WHERE j = 1 AND k = 1)
SELECT coalesce(a.source_series_key, b.source_series_key) AS source_series_key, coalesce(a.entry_id, b.entry_id) AS entry_id,
  CASE WHEN b.entry_id IS NULL THEN 'added' WHEN a.entry_id IS NULL THEN 'disappeared' WHEN a.st <> b.st THEN 'status_changed' WHEN a.nm <> b.nm THEN 'content_changed' ELSE 'unchanged' END AS change,
  CASE WHEN a.st <> b.st THEN b.st || '->' || a.st END AS transition
FROM a FULL OUTER JOIN b ON a.source_series_key = b.source_series_key AND a.entry_id = b.entry_id""")
def first_to_last_edition(s: SparkSession, d: str) -> DataFrame:
    """What became of the entries of each series from its first edition to its last."""
    before, after = _ends(s, d)
    return E.edition_diff(before, after, ["source_series_key", "entry_id"], "at", "source_status_code", ["source_name_normalised"])


_BUNDLES = """b AS (SELECT o.entry_id, o.observation_date < DATE '2024-01-01' AS early, o.source_status_code AS st, o.source_name_normalised AS nm,
       CASE WHEN bool_and(regexp_full_match(upper(regexp_replace(i.normalised_value, '\\s+', '', 'g')), '[0-9]{11}|[A-Z0-9]{16}')) THEN string_agg(DISTINCT upper(regexp_replace(i.normalised_value, '\\s+', '', 'g')), '|' ORDER BY upper(regexp_replace(i.normalised_value, '\\s+', '', 'g'))) END AS bundle
  FROM identifier_observation i JOIN entity_observation o USING (entity_observation_id) GROUP BY o.entity_observation_id, 1, 2, 3, 4)"""


def _bundles(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "identifier_observation").groupBy("entity_observation_id").agg(bundle_key(F.collect_list("normalised_value")).alias("bundle"))
    return ids.join(_observed(s, d), "entity_observation_id").select("bundle", "observation_date", F.col("source_name_normalised").alias("name"), F.col("source_status_code").alias("status"), "entry_id")


@query(f"""WITH {_BUNDLES},
u AS (SELECT bundle, early, count(*) AS n, min(nm) AS nm, min(st) AS st FROM b GROUP BY 1, 2),
l AS (SELECT * FROM u WHERE early AND n = 1 AND bundle IS NOT NULL), r AS (SELECT * FROM u WHERE NOT early AND n = 1 AND bundle IS NOT NULL),
j AS (SELECT coalesce(l.bundle, r.bundle) AS bundle, l.bundle IS NOT NULL AS a, r.bundle IS NOT NULL AS z, l.nm AS an, r.nm AS zn, l.st AS ast, r.st AS zst FROM l FULL OUTER JOIN r ON l.bundle = r.bundle),
p AS (SELECT bundle, a, unnest(string_split(bundle, '|')) AS part FROM j WHERE NOT (a AND z)),
sh AS (SELECT part FROM p GROUP BY 1 HAVING bool_or(a) AND NOT bool_and(a)),
c AS (SELECT DISTINCT bundle FROM p WHERE part IN (SELECT part FROM sh)),
m AS (SELECT j.*, c.bundle IS NOT NULL AS ch, coalesce(an <> zn, false) AS rn FROM j LEFT JOIN c USING (bundle)),
t AS (SELECT count(*) FILTER (NOT a AND NOT ch) AS added, count(*) FILTER (NOT z AND NOT ch) AS gone, count(*) FILTER (a AND z AND NOT rn) AS common, count(*) FILTER (a AND z AND NOT rn AND ast IS DISTINCT FROM zst) AS sc,
             count(*) FILTER ((ch AND a) OR rn) AS ua, count(*) FILTER ((ch AND z) OR rn) AS ub FROM m),
x AS (SELECT CAST(coalesce(sum(n) FILTER (early), 0) AS BIGINT) AS la, CAST(coalesce(sum(n) FILTER (NOT early), 0) AS BIGINT) AS lb FROM u WHERE n > 1 OR bundle IS NULL)
SELECT CASE WHEN ua + la + ub + lb = 0 THEN added END AS added, CASE WHEN ua + la + ub + lb = 0 THEN gone END AS disappeared, common, sc AS status_changed, ua + la AS unresolved_before, ub + lb AS unresolved_after FROM t, x""")
def guarded_comparison(s: SparkSession, d: str) -> DataFrame:
    """A comparison of early and late first sightings that counts entries and exits only while nothing is ambiguous."""
    b = _bundles(s, d)
    early = F.col("observation_date") < F.lit("2024-01-01").cast("date")
    return E.guarded_diff(b.filter(early), b.filter(~early), "bundle", "name", "status")


@query(f"""WITH {_FILES}, k AS (SELECT e.*, s.created_at AS checked FROM e JOIN source_edition s USING (edition_id)),
h AS (SELECT source_series_key, parser, reference_from, count(*) AS n, min(edition_id) AS i FROM k GROUP BY 1, 2, 3),
g AS (SELECT *, lag(i) OVER w AS pi, lag(n) OVER w AS pn FROM h WHERE reference_from IS NOT NULL WINDOW w AS (PARTITION BY source_series_key, parser ORDER BY reference_from)),
c AS (SELECT source_series_key, parser, checked, count(*) AS n, min(edition_id) AS i, min(reference_from) AS r FROM k WHERE checked IS NOT NULL GROUP BY 1, 2, 3),
l AS (SELECT *, lag(i) OVER w AS ci, lag(n) OVER w AS cn, lag(r) OVER w AS cr FROM c WINDOW w AS (PARTITION BY source_series_key, parser ORDER BY checked)),
z AS (SELECT k.source_series_key, k.edition_id AS after, CASE WHEN g.pi IS NOT NULL THEN CASE WHEN g.pn = 1 THEN g.pi END WHEN l.cn = 1 AND (l.cr IS NULL OR k.reference_from IS NULL OR l.cr = k.reference_from) THEN l.ci END AS before,
        CASE WHEN g.pi IS NOT NULL THEN 'reference_date' ELSE 'check_time' END AS basis
      FROM k LEFT JOIN g ON g.source_series_key = k.source_series_key AND g.parser = k.parser AND g.reference_from = k.reference_from LEFT JOIN l ON l.source_series_key = k.source_series_key AND l.parser = k.parser AND l.checked = k.checked)
SELECT * FROM z WHERE before IS NOT NULL""")
def editions_to_compare(s: SparkSession, d: str) -> DataFrame:
    """The edition each one is compared with by reference date, or by the time it was recorded."""
    files = _files(s, d).join(_editions(s, d).select("edition_id", F.col("created_at").alias("checked")), "edition_id")
    return E.comparison_pairs(files, "source_series_key", "reference_from", "edition_id", "parser", "checked")

@query("""WITH m AS (SELECT strftime(observation_date, '%Y-%m') AS mo, entry_id, arg_max(source_status_code, (projected_at, entity_observation_id)) AS st FROM entity_observation GROUP BY 1, 2),
n AS (SELECT mo, row_number() OVER (ORDER BY mo) AS no FROM (SELECT DISTINCT mo FROM m)),
p AS (SELECT n.no, m.entry_id, m.st FROM m JOIN n USING (mo)), x AS (SELECT max(no) AS l FROM n),
j AS (SELECT coalesce(b.no, a.no + 1) AS edition_no, coalesce(a.st, '(absent)') AS from_state, coalesce(b.st, '(absent)') AS to_state FROM p a FULL OUTER JOIN p b ON a.entry_id = b.entry_id AND b.no = a.no + 1)
SELECT edition_no, from_state, to_state, count(*) AS n FROM j, x WHERE edition_no > 1 AND edition_no <= l GROUP BY 1, 2, 3""")
def monthly_status_transitions(s: SparkSession, d: str) -> DataFrame:
    """Moves between statuses from each month to the next, with arrivals and departures."""
    newest = F.struct("projected_at", "entity_observation_id")
    monthly = _observed(s, d).groupBy(F.date_format("observation_date", "yyyy-MM").alias("month"), "entry_id").agg(F.max_by("source_status_code", newest).alias("state"))
    return E.consecutive_transitions(monthly, "month", "entry_id", "state").withColumn("edition_no", F.col("edition_no").cast("bigint"))


@query("""WITH a AS (SELECT authority_key, source_status_code, count(*) FILTER (observation_date < DATE '2024-01-01') AS n_before, count(*) FILTER (observation_date >= DATE '2024-01-01') AS n_after FROM entity_observation GROUP BY 1, 2)
SELECT * FROM a WHERE n_before <> n_after""")
def status_multiset_change(s: SparkSession, d: str) -> DataFrame:
    """How often each authority and status stands in the early and in the late rows."""
    rows = _observed(s, d)
    early = F.col("observation_date") < F.lit("2024-01-01").cast("date")
    return E.multiset_diff(rows.filter(early), rows.filter(~early), ["authority_key", "source_status_code"])


@query("""SELECT parse_run_id, min(edition_id) AS edition_id, min(source_series_key) AS source_series_key, count(DISTINCT snapshot_sha256) AS n_evidence, max(record_count) AS record_count,
  count(DISTINCT edition_id) > 1 OR count(DISTINCT source_series_key) > 1 OR count(DISTINCT record_count) > 1 AS conflict FROM parse_snapshot GROUP BY 1""")
def merged_file_ledger(s: SparkSession, d: str) -> DataFrame:
    """The files' ledger with repeated rows merged."""
    ledger = table(s, d, "parse_snapshot").select("parse_run_id", "edition_id", "source_series_key", F.array("snapshot_sha256").alias("evidence"), "record_count")
    out = E.merged_ledgers(ledger, "parse_run_id", ["edition_id", "source_series_key"], "evidence", "record_count")
    return out.select("parse_run_id", "edition_id", "source_series_key", F.size("evidence").cast("bigint").alias("n_evidence"), "record_count", "conflict")


@query("""WITH r AS (SELECT DISTINCT source_family, publication_model, CASE WHEN publication_model IN ('web_application', 'sector_files') THEN 2 ELSE 1 END AS p, source_family || ':' || publication_model AS t FROM source_series)
SELECT s.source_series_key, r.t AS target, 'bound' AS route_status FROM source_series s JOIN r USING (source_family, publication_model)""")
def parser_routes(s: SparkSession, d: str) -> DataFrame:
    """The parser route of each series by the binding of highest priority."""
    series = table(s, d, "source_series")
    rules = series.select("source_family", "publication_model", F.when(F.col("publication_model").isin("web_application", "sector_files"), 2).otherwise(1).alias("priority"), F.concat_ws(":", "source_family", "publication_model").alias("target")).distinct()
    return R.routed(series.select("source_series_key", "source_family", "publication_model"), rules, ["source_family", "publication_model"], "priority", "target").select("source_series_key", "target", "route_status")


@query("""SELECT s.source_series_key, coalesce(t.jurisdiction_name, s.authority_key) AS authority_key FROM source_series s LEFT JOIN territorial_authority t USING (authority_key)""")
def authority_names(s: SparkSession, d: str) -> DataFrame:
    """Series with the authority's key replaced by its name."""
    return R.aliased(table(s, d, "source_series").select("source_series_key", "authority_key"), "authority_key", table(s, d, "territorial_authority"), "authority_key", "jurisdiction_name")


@query("""SELECT e.edition_id AS period_edition, count(*) AS n FROM entity_observation o JOIN source_edition own ON own.edition_id = o.edition_id
JOIN source_edition e ON e.source_series_key = own.source_series_key AND (e.reference_from IS NULL OR e.reference_from <= o.observation_date) AND (e.reference_to IS NULL OR o.observation_date < e.reference_to) GROUP BY 1""")
def rows_in_reference_periods(s: SparkSession, d: str) -> DataFrame:
    """Rows whose observation date falls into each edition's reference period."""
    facts = _observed(s, d).join(_editions(s, d).select("edition_id", "source_series_key"), "edition_id").select("source_series_key", "observation_date")
    periods = _editions(s, d).select("source_series_key", F.col("edition_id").alias("period_edition"), "reference_from", "reference_to")
    return R.join_in_period(facts, periods, ["source_series_key"], "observation_date", "reference_from", "reference_to").groupBy("period_edition").agg(F.count("*").alias("n"))


@query("""SELECT a.source_series_key, a.edition_id AS edition_id_1, b.edition_id AS edition_id_2 FROM source_edition a JOIN source_edition b ON a.source_series_key = b.source_series_key AND a.edition_id < b.edition_id
WHERE (a.reference_from IS NULL OR b.reference_to IS NULL OR a.reference_from < b.reference_to) AND (b.reference_from IS NULL OR a.reference_to IS NULL OR b.reference_from < a.reference_to)
AND coalesce(a.reference_from < a.reference_to, true) AND coalesce(b.reference_from < b.reference_to, true)""")
def overlapping_reference_periods(s: SparkSession, d: str) -> DataFrame:
    """Editions of one series whose reference periods overlap."""
    return R.period_conflicts(_editions(s, d), ["source_series_key"], "edition_id", [("reference_from", "reference_to")])


@query("""WITH w AS (SELECT establishment_observation_id, regexp_extract_all(lower(full_address_raw), '[\\p{L}\\p{N}]+') AS ws FROM establishment_observation),
k AS (SELECT array_to_string(regexp_extract_all(lower(jurisdiction_name), '[\\p{L}\\p{N}]+'), ' ') AS p, min(authority_key) AS code, count(DISTINCT authority_key) AS n FROM territorial_authority GROUP BY 1),
n AS (SELECT DISTINCT len(string_split(p, ' ')) AS i FROM k),
h AS (SELECT w.establishment_observation_id, n.i, k.code, k.n FROM w, n, k WHERE n.i <= len(w.ws) AND array_to_string(w.ws[1:n.i], ' ') = k.p),
b AS (SELECT establishment_observation_id, arg_max(code, i) AS code, arg_max(n, i) AS n FROM h GROUP BY 1)
SELECT w.establishment_observation_id, CASE WHEN b.n = 1 THEN b.code END AS authority_key, CASE WHEN b.n IS NULL THEN 'none' WHEN b.n > 1 THEN 'ambiguous' ELSE 'unique' END AS prefix_status FROM w LEFT JOIN b USING (establishment_observation_id)""")
def address_place_prefixes(s: SparkSession, d: str) -> DataFrame:
    """The authority whose name begins each address, by the longest prefix."""
    out = R.longest_prefix(table(s, d, "establishment_observation").select("establishment_observation_id", "full_address_raw"), "full_address_raw", table(s, d, "territorial_authority"), "jurisdiction_name", "authority_key")
    return out.select("establishment_observation_id", "authority_key", "prefix_status")


@query("""WITH a AS (SELECT edition_id, count(DISTINCT entry_id) AS n FROM entity_observation GROUP BY 1), b AS (SELECT edition_id, max(record_count) AS n FROM parse_snapshot GROUP BY 1)
SELECT edition_id, a.n AS total, CAST(a.n + b.n AS BIGINT) AS value, true AS complete FROM a JOIN b USING (edition_id) WHERE a.n = b.n""")
def editions_with_equal_counts(s: SparkSession, d: str) -> DataFrame:
    """Editions whose observations and files agree on the number of entries."""
    a = _observed(s, d).groupBy("edition_id").agg(F.count_distinct("entry_id").alias("total")).withColumn("value", F.col("total"))
    b = table(s, d, "parse_snapshot").groupBy("edition_id").agg(F.max("record_count").cast("bigint").alias("total")).withColumn("value", F.col("total"))
    return R.complete_only([a, b], "edition_id", "total", "value")


@query("""WITH k AS (SELECT DISTINCT source_status_code AS a, authority_key AS s, observation_date AS v FROM entity_observation WHERE authority_key IS NOT NULL)
SELECT x.a AS source_status_code, x.s AS authority_key_1, y.s AS authority_key_2, count(*) AS shared FROM k x JOIN k y ON x.a = y.a AND x.v = y.v AND x.s < y.s GROUP BY 1, 2, 3""")
def authorities_seen_together(s: SparkSession, d: str) -> DataFrame:
    """Authorities with rows of one status on the same days, and on how many."""
    return R.pairwise_overlap(_observed(s, d), ["source_status_code"], "authority_key", "observation_date")

@query("""(SELECT edition_id, 'left' AS side FROM source_edition WHERE publication_date IS NOT NULL EXCEPT ALL SELECT edition_id, 'left' FROM parse_snapshot) UNION ALL (SELECT edition_id, 'right' FROM parse_snapshot EXCEPT ALL SELECT edition_id, 'right' FROM source_edition WHERE publication_date IS NOT NULL)""")
def edition_cover(s: SparkSession, d: str) -> DataFrame:
    """Published editions without a file, and files beyond one for each published edition."""
    return R.set_difference(_editions(s, d).filter("publication_date is not null").select("edition_id"), table(s, d, "parse_snapshot").select("edition_id"))

@query("""WITH b AS (SELECT p.source_series_key, p.created_at, p.snapshot_sha256 FROM parse_snapshot p JOIN source_edition e USING (edition_id) WHERE e.edition_identity_status_code = 'explicit'),
c AS (SELECT source_series_key, max(created_at) AS m FROM b GROUP BY 1)
SELECT p.parse_run_id, p.source_series_key FROM parse_snapshot p LEFT JOIN c USING (source_series_key) WHERE (c.m IS NULL OR p.created_at > c.m) AND p.snapshot_sha256 NOT IN (SELECT snapshot_sha256 FROM b)""")
def files_beyond_baseline(s: SparkSession, d: str) -> DataFrame:
    """Files later than the newest file of an explicitly identified edition of their series."""
    files = table(s, d, "parse_snapshot").select("parse_run_id", "source_series_key", "edition_id", "created_at", "snapshot_sha256")
    base = files.join(_editions(s, d).filter("edition_identity_status_code = 'explicit'").select("edition_id"), "edition_id", "left_semi")
    return R.beyond_baseline(files, base, ["source_series_key"], "created_at", "snapshot_sha256").select("parse_run_id", "source_series_key")


@query("""SELECT edition_id, count(*) AS n FROM entity_observation WHERE edition_id IN (SELECT edition_id FROM entity_observation WHERE source_status_code IN ('listed', 'pending') GROUP BY 1 HAVING count(DISTINCT source_status_code) = 2) GROUP BY 1""")
def editions_with_both_statuses(s: SparkSession, d: str) -> DataFrame:
    """Editions in which listed and pending rows stand together, with their rows."""
    return R.witnessed_bundles(_observed(s, d), ["edition_id"], "source_status_code", ["listed", "pending"]).groupBy("edition_id").agg(F.count("*").alias("n"))


@query("""WITH n AS (SELECT f.source_family, o.edition_id, count(*) AS c FROM entity_observation o JOIN source_edition e USING (edition_id) JOIN source_series f USING (source_series_key) GROUP BY 1, 2)
SELECT source_family, count(*) AS n, round(quantile_cont(c, 0.25), 2) AS p25, round(quantile_cont(c, 0.5), 2) AS median, round(quantile_cont(c, 0.75), 2) AS p75, round(quantile_cont(c, 0.9), 2) AS p90, count(*) FILTER (c > 20) AS over_20 FROM n GROUP BY 1""")
def edition_size_quantiles(s: SparkSession, d: str) -> DataFrame:
    """Exact quantiles of the sizes of editions."""
    sizes = _observed(s, d).groupBy("edition_id").agg(F.count("*").alias("c")).join(_editions(s, d).select("edition_id", "source_series_key"), "edition_id").join(table(s, d, "source_series").select("source_series_key", "source_family"), "source_series_key")
    return M.quantile_summary(sizes, ["source_family"], F.col("c"), [20])


@query("""SELECT source_status_code, count(*) AS n, count(*) FILTER (x < 1) AS bin_0, count(*) FILTER (x >= 1 AND x < 7) AS bin_1, count(*) FILTER (x >= 7 AND x < 30) AS bin_2, count(*) FILTER (x >= 30) AS bin_3, count(*) FILTER (x IS NULL) AS missing
FROM (SELECT o.source_status_code, date_diff('day', e.reference_from, o.observation_date) AS x FROM entity_observation o JOIN source_edition e USING (edition_id)) GROUP BY 1""")
def delay_histogram(s: SparkSession, d: str) -> DataFrame:
    """Days from the reference date to the observation, in bins."""
    rows = _observed(s, d).join(_editions(s, d).select("edition_id", "reference_from"), "edition_id").withColumn("x", F.datediff("observation_date", "reference_from"))
    return M.histogram(rows, ["source_status_code"], F.col("x"), [1, 7, 30])


@query("""SELECT review_stratum, n, met, unknown, round(met / n, 6) AS lower, round((met + unknown) / n, 6) AS upper FROM (SELECT review_stratum, count(*) AS n, count(*) FILTER (review_precision = 'civic') AS met, count(*) FILTER (review_precision IS NULL) AS unknown FROM address_review GROUP BY 1)""")
def civic_precision_bounds(s: SparkSession, d: str) -> DataFrame:
    """Least and greatest possible share of reviewed addresses located to the civic number."""
    return M.share_bounds(table(s, d, "address_review"), ["review_stratum"], F.col("review_precision") == "civic")


def _per_authority(s: SparkSession, d: str) -> DataFrame:
    rows = _observed(s, d).join(_editions(s, d).select("edition_id", "source_series_key"), "edition_id").join(table(s, d, "source_series").select("source_series_key", "source_family"), "source_series_key")
    return rows.groupBy("source_family", "authority_key").agg(F.count_distinct("entry_id").alias("entries"))


_PER = "p AS (SELECT f.source_family, o.authority_key, count(DISTINCT o.entry_id) AS entries FROM entity_observation o JOIN source_edition e USING (edition_id) JOIN source_series f USING (source_series_key) GROUP BY 1, 2)"


@query(f"WITH {_PER} SELECT *, rank() OVER (PARTITION BY source_family ORDER BY entries DESC) AS rank FROM p")
def authority_rank(s: SparkSession, d: str) -> DataFrame:
    """Authorities by their number of entries; ties share a rank."""
    return M.competition_rank(_per_authority(s, d), ["source_family"], "entries").withColumn("rank", F.col("rank").cast("bigint"))


_MID = f"{_PER}, m AS (SELECT *, 100.0 * (rank() OVER (PARTITION BY source_family ORDER BY entries) - 1 + (count(*) OVER (PARTITION BY source_family, entries) - 1) / 2) / nullif(count(*) OVER (PARTITION BY source_family) - 1, 0) AS sc FROM p)"


@query(f"WITH {_MID} SELECT source_family, authority_key, entries, round(sc, 6) AS score FROM m")
def authority_midrank(s: SparkSession, d: str) -> DataFrame:
    """The same as a score from 0 to 100 by the mean position among ties."""
    return M.midrank_score(_per_authority(s, d), ["source_family"], "entries").withColumn("score", F.round("score", 6))


@query(f"""WITH {_MID}, c AS (SELECT authority_key, avg(sc) AS a FROM m WHERE sc IS NOT NULL GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT source_family) FROM m))
SELECT authority_key, round(a, 6) AS mean_score, rank() OVER (ORDER BY round(a, 6) DESC) AS rank FROM c""")
def authority_overall(s: SparkSession, d: str) -> DataFrame:
    """Authorities with a score in every family, by its mean."""
    scores = M.midrank_score(_per_authority(s, d), ["source_family"], "entries")
    means = M.mean_of_complete(scores, "authority_key", "source_family", "score").withColumn("mean_score", F.round("mean_score", 6)).drop("rank")
    return M.competition_rank(means, [], "mean_score").withColumn("rank", F.col("rank").cast("bigint"))


@query("""WITH n AS (SELECT edition_id, count(*) AS c FROM entity_observation GROUP BY 1)
SELECT e.source_series_key, CAST(sum(n.c) AS BIGINT) AS rows_, CASE WHEN count(*) = count(e.publication_date) THEN CAST(max(e.publication_date) AS VARCHAR) END AS publication_date, bool_and(n.c IS NOT NULL AND e.publication_date IS NOT NULL) AS valid FROM source_edition e LEFT JOIN n USING (edition_id) GROUP BY 1""")
def series_roll_up(s: SparkSession, d: str) -> DataFrame:
    """Rows of each series and its last publication, only if every edition has one."""
    n = _observed(s, d).groupBy("edition_id").agg(F.count("*").alias("rows_"))
    out = M.rolled_up(_editions(s, d).join(n, "edition_id", "left"), ["source_series_key"], "rows_", "publication_date")
    return out.withColumn("publication_date", F.col("publication_date").cast("string"))


@query("""SELECT 'authority_key' AS facet, authority_key AS value, count(*) AS n FROM entity_observation GROUP BY 2 UNION ALL SELECT 'source_status_code', source_status_code, count(*) FROM entity_observation GROUP BY 2 UNION ALL SELECT 'resolution_readiness_code', resolution_readiness_code, count(*) FROM entity_observation GROUP BY 2""")
def observation_facets(s: SparkSession, d: str) -> DataFrame:
    """Rows by authority, by status and by readiness in one pass."""
    return M.facet_totals(_observed(s, d), ["authority_key", "source_status_code", "resolution_readiness_code"])


@query("""SELECT *, round_even(100.0 * n / sum(n) OVER (PARTITION BY authority_key), 2) AS percent FROM (SELECT authority_key, source_status_code, count(*) AS n FROM entity_observation GROUP BY 1, 2)""")
def status_counts(s: SparkSession, d: str) -> DataFrame:
    """Statuses of each authority with their percentage."""
    return M.shares(_observed(s, d), ["authority_key"], "source_status_code")

@query("""SELECT CAST(b.m AS VARCHAR) AS bin, coalesce(c.n, 0) AS n FROM (SELECT CAST(unnest(generate_series(DATE '2019-01-01', DATE '2027-12-01', INTERVAL 1 MONTH)) AS DATE) AS m) b LEFT JOIN (SELECT CAST(date_trunc('month', publication_date) AS DATE) AS m, count(*) AS n FROM source_edition GROUP BY 1) c ON c.m = b.m""")
def publications_by_month(s: SparkSession, d: str) -> DataFrame:
    """Editions published in every month, zeros included."""
    return M.calendar_bins(_editions(s, d), "publication_date", "month", "2019-01-01", "2027-12-01").withColumn("bin", F.col("bin").cast("string"))


_MONTHS = "m AS (SELECT strftime(observation_date, '%Y-%m') AS mo, entry_id, arg_max(source_status_code, (projected_at, entity_observation_id)) AS st FROM entity_observation GROUP BY 1, 2)"


def _monthly(s: SparkSession, d: str) -> DataFrame:
    return _observed(s, d).groupBy(F.date_format("observation_date", "yyyy-MM").alias("month"), "entry_id").agg(F.max_by("source_status_code", F.struct("projected_at", "entity_observation_id")).alias("state"))


@query(f"""WITH {_MONTHS}, l AS (SELECT max(mo) AS last FROM m),
f AS (SELECT entry_id, min(mo) FILTER (st = 'pending') AS cohort, max(mo) FILTER (st = 'listed') AS lv, arg_max(st, mo) AS fs, max(mo) AS seen FROM m GROUP BY 1)
SELECT cohort, count(*) AS n, count(*) FILTER (seen = last AND fs = 'pending') AS still_entering, count(*) FILTER (seen = last AND fs = 'listed') AS left_, count(*) FILTER (seen = last AND fs NOT IN ('pending', 'listed')) AS other,
  count(*) FILTER (seen < last) AS not_observed, count(*) FILTER (lv > cohort) AS ever_left FROM f, l WHERE cohort IS NOT NULL GROUP BY 1""")
def first_pending_cohorts(s: SparkSession, d: str) -> DataFrame:
    """Cohorts of entries by the month they were first seen pending."""
    return M.first_seen_cohorts(_monthly(s, d), "entry_id", "month", "state", "pending", "listed").withColumnRenamed("left", "left_")


@query("""WITH r AS (SELECT entry_id, observation_date AS ts, source_status_code AS st FROM entity_observation),
f AS (SELECT entry_id, min(ts) FILTER (st = 'listed') AS fl, max(ts) FILTER (st = 'pending') AS ap FROM r GROUP BY 1),
j AS (SELECT r.entry_id, f.fl, max(r.ts) FILTER (r.st = 'pending' AND r.ts < f.fl) AS le, coalesce(bool_or(r.st = 'renewal_requested') FILTER (r.ts <= f.fl), false) AS b FROM r JOIN f USING (entry_id) WHERE f.fl IS NOT NULL AND f.ap IS NOT NULL GROUP BY 1, 2)
SELECT entry_id, CASE WHEN le IS NULL THEN 'no_earlier_entering' WHEN b THEN 'blocked_before_leaving' END AS excluded, CASE WHEN le IS NOT NULL AND NOT b THEN date_diff('day', le, fl) END AS lag_days FROM j""")
def pending_to_listed_lags(s: SparkSession, d: str) -> DataFrame:
    """Days from the last pending sighting to the first listed one, or why there are none."""
    return M.linked_lags(_observed(s, d), "entry_id", "observation_date", "source_status_code", "pending", "listed", ["renewal_requested"]).withColumn("lag_days", F.col("lag_days").cast("bigint"))


@query("""WITH r AS (SELECT *, review_verdict = 'correct' AS y, review_verdict IN ('wrong_municipality', 'wrong_civic', 'wrong_street') AS n FROM address_review)
SELECT review_stratum, count(*) AS n, count(*) FILTER (y) AS correct, count(*) FILTER (y OR n) AS decided, round(sum(sampling_weight) FILTER (y) / sum(sampling_weight) FILTER (y OR n), 6) AS precision FROM r GROUP BY 1
UNION ALL SELECT '(all)', count(*), count(*) FILTER (y), count(*) FILTER (y OR n), round(sum(sampling_weight) FILTER (y) / sum(sampling_weight) FILTER (y OR n), 6) FROM r""")
def review_precision(s: SparkSession, d: str) -> DataFrame:
    """Precision of the reviewed addresses, weighted by what each stands for."""
    return M.weighted_review(table(s, d, "address_review"), "review_stratum", "review_verdict", "sampling_weight", ["correct"], ["wrong_municipality", "wrong_civic", "wrong_street"])


@query("""WITH t AS (SELECT a.authority_key, r.regime_code FROM territorial_authority a, (SELECT DISTINCT regime_code FROM source_series) r)
SELECT t.authority_key, t.regime_code, coalesce(bool_or(population_scope IN ('listed', 'listed;applicant')), false) AS has_listed, coalesce(bool_or(population_scope IN ('applicant', 'listed;applicant')), false) AS has_applicant
FROM t LEFT JOIN source_series s USING (authority_key, regime_code) GROUP BY 1, 2""")
def population_coverage(s: SparkSession, d: str) -> DataFrame:
    """Which authorities publish listed and applicant populations of each regime; all authorities appear."""
    series = table(s, d, "source_series")
    targets = table(s, d, "territorial_authority").select("authority_key").crossJoin(F.broadcast(series.select("regime_code").distinct()))
    return M.coverage_matrix(series, targets, ["listed", "applicant"], "population_scope", "listed;applicant")


@query("""SELECT review_batch, max(CASE WHEN review_stratum LIKE 'matched%' THEN stratum_population END) AS matched, max(CASE WHEN review_stratum LIKE 'not_found%' THEN stratum_population END) AS not_found FROM address_review GROUP BY 1""")
def review_wide(s: SparkSession, d: str) -> DataFrame:
    """Long review figures as one row per batch."""
    rows = table(s, d, "address_review").withColumn("kind", ladder([(F.col("review_stratum").startswith("matched"), "matched"), (F.col("review_stratum").startswith("not_found"), "not_found")], "other"))
    return M.pivoted(rows, ["review_batch"], "kind", "stratum_population", {"matched": ["matched"], "not_found": ["not_found"]})


@query("""SELECT edition_id, 'edition_identity_status_code' AS field, edition_identity_status_code AS raw_value, '{"value":' || coalesce('"' || edition_identity_status_code || '"', 'null') || '}' AS parsed_value FROM source_edition
UNION ALL SELECT edition_id, 'publication_date', CAST(publication_date AS VARCHAR), '{"value":' || coalesce('"' || CAST(publication_date AS VARCHAR) || '"', 'null') || '}' FROM source_edition
UNION ALL SELECT edition_id, 'reference_from', CAST(reference_from AS VARCHAR), '{"value":' || coalesce('"' || CAST(reference_from AS VARCHAR) || '"', 'null') || '}' FROM source_edition""")
def edition_fields_long(s: SparkSession, d: str) -> DataFrame:
    """Fields of editions as one row each, as text and as JSON."""
    return M.unpivoted(_editions(s, d), ["edition_id"], ["edition_identity_status_code", "publication_date", "reference_from"])

@query("""SELECT count(*) AS n, count(DISTINCT source_series_key) AS n_source_series_key, count(DISTINCT edition_id) AS n_edition_id, CAST(min(publication_date) AS VARCHAR) AS first, CAST(max(publication_date) AS VARCHAR) AS last, CASE WHEN count(publication_date) = count(*) THEN CAST(max(publication_date) AS VARCHAR) END AS last_if_complete FROM source_edition""")
def archive_figures(s: SparkSession, d: str) -> DataFrame:
    """Totals of the archive of editions."""
    out = M.archive_summary(_editions(s, d), ["source_series_key", "edition_id"], "publication_date")
    return out.withColumns({c: F.col(c).cast("string") for c in ("first", "last", "last_if_complete")})


@query()
def table_fingerprints(s: SparkSession, d: str) -> DataFrame:
    """Count and content hash of the observations of each authority, whatever the order of rows."""
    return M.content_fingerprint(_observed(s, d), ["authority_key"])


@query()
def review_sample(s: SparkSession, d: str) -> DataFrame:
    """A repeatable stratified sample of reviewed addresses with weights."""
    rows = table(s, d, "address_review").select("address_id", "review_stratum", "review_municipality", "review_street")
    return sampling.stratified_sample(rows, "review_stratum", ["address_id", "review_street"], 150)


@query("""SELECT entry_id, names FROM (SELECT entry_id, count(DISTINCT source_name_normalised) AS names FROM entity_observation GROUP BY 1) ORDER BY names DESC, entry_id LIMIT 25 OFFSET 25""")
def second_page_of_renamed(s: SparkSession, d: str) -> DataFrame:
    """The second page of entries by the number of their spellings."""
    names = _observed(s, d).groupBy("entry_id").agg(F.count_distinct("source_name_normalised").alias("names"))
    return sampling.page(names, [F.desc("names"), F.asc("entry_id")], 2, 25)


@query("""SELECT parse_run_id, strpos('0123456789abcdef', right(sha256(parse_run_id), 1)) - 1 AS shard FROM parse_snapshot""")
def file_shards(s: SparkSession, d: str) -> DataFrame:
    """The shard of sixteen that each file belongs to."""
    return table(s, d, "parse_snapshot").select("parse_run_id", shard_digit(F.col("parse_run_id"), 16).cast("bigint").alias("shard"))


_NAMED = "n AS (SELECT i.identifier_observation_id AS id, o.source_name_normalised AS nm, i.normalised_value AS v FROM identifier_observation i JOIN entity_observation o USING (entity_observation_id))"


def _named(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "identifier_observation").join(_observed(s, d).select("entity_observation_id", "source_name_normalised"), "entity_observation_id").select(F.col("identifier_observation_id").alias("id"), F.col("source_name_normalised").alias("name"), F.col("normalised_value").alias("value"))


@query(f"WITH {_NAMED} SELECT v AS value FROM n GROUP BY 1 HAVING count(DISTINCT nm) > 1")
def ambiguous_identifiers(s: SparkSession, d: str) -> DataFrame:
    """Identifiers seen under several names."""
    return resolve.ambiguous_values(_named(s, d), "name", "value")


@query("""WITH RECURSIVE n AS (SELECT i.entity_observation_id AS id, o.source_name_normalised AS nm, i.normalised_value AS v, i.shape_code IN ('11_digit_numeric', '16_char_alphanumeric') AS strong FROM identifier_observation i JOIN entity_observation o USING (entity_observation_id)),
am AS (SELECT v FROM n WHERE strong GROUP BY 1 HAVING count(DISTINCT nm) > 1), k AS (SELECT DISTINCT id, nm || chr(31) || v AS e FROM n WHERE strong AND v NOT IN (SELECT v FROM am)),
r AS (SELECT id, id AS m FROM k UNION SELECT b.id, r.m FROM r JOIN k a ON a.id = r.id JOIN k b ON a.e = b.e), g AS (SELECT id, min(m) AS subject FROM r GROUP BY 1)
SELECT DISTINCT n.id, g.subject FROM n LEFT JOIN g USING (id)""")
def resolved_subjects(s: SparkSession, d: str) -> DataFrame:
    """The subject of each observation with identifiers: observations of one name that share well-formed, unambiguous identifiers, also over several steps."""
    ids = table(s, d, "identifier_observation").join(_observed(s, d).select("entity_observation_id", "source_name_normalised"), "entity_observation_id")
    rows = ids.select(F.col("entity_observation_id").alias("id"), F.col("source_name_normalised").alias("name"), F.col("normalised_value").alias("value"), "shape_code")
    return resolve.resolved(rows, "id", "name", "value", F.col("shape_code").isin("11_digit_numeric", "16_char_alphanumeric"))

_LAST = "SELECT entry_id, arg_min(source_status_code, (observation_date, projected_at, entity_observation_id)) AS fs, arg_max(source_status_code, (observation_date, projected_at, entity_observation_id)) AS ls FROM entity_observation GROUP BY 1"


@query(f"""WITH x AS ({_LAST})
SELECT entry_id, fs AS source_status_code, '2020-01-01' AS valid_from, CASE WHEN fs <> ls THEN '2026-01-01' END AS valid_to FROM x UNION ALL SELECT entry_id, ls, '2026-01-01', NULL FROM x WHERE fs <> ls""")
def superseded_statuses(s: SparkSession, d: str) -> DataFrame:
    """Versions of status after a run that closes what changed and opens what is new."""
    when = F.struct("observation_date", "projected_at", "entity_observation_id")
    ends = _observed(s, d).groupBy("entry_id").agg(F.min_by("source_status_code", when).alias("fs"), F.max_by("source_status_code", when).alias("ls"))
    current = ends.select("entry_id", F.col("fs").alias("source_status_code"), F.lit("2020-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    out = supersede.superseded(current, ends.select("entry_id", F.col("ls").alias("source_status_code")), ["entry_id"], ["source_status_code"], F.lit("2026-01-01").cast("date"))
    return out.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@query("""WITH c AS (SELECT source_series_key AS k, created_at AS ts, CASE WHEN record_count < 5 THEN NULL ELSE snapshot_sha256 END AS dg, record_count < 5 AS bad, parse_run_id FROM (SELECT DISTINCT source_series_key, created_at, snapshot_sha256, record_count, parse_run_id FROM parse_snapshot)),
g AS (SELECT *, lag(dg) OVER (PARTITION BY k ORDER BY ts) AS was FROM c WHERE NOT bad),
s AS (SELECT k, max(ts) AS ls, max(ts) FILTER (was IS DISTINCT FROM dg) AS lc, arg_max(dg, ts) AS dg FROM g GROUP BY 1)
SELECT c.k AS source_series_key, max(c.ts) AS last_attempt, count(*) AS attempts, any_value(s.ls) AS last_success, any_value(s.lc) AS last_change, any_value(s.dg) AS digest, count(*) FILTER (c.bad AND (s.ls IS NULL OR c.ts > s.ls)) AS failures_since FROM c LEFT JOIN s USING (k) GROUP BY 1""")
def series_check_states(s: SparkSession, d: str) -> DataFrame:
    """The state of each series after all reads of its files; a file of under five records counts as failed."""
    files = table(s, d, "parse_snapshot").select("source_series_key", "created_at", "snapshot_sha256", "record_count", "parse_run_id").distinct()
    failed = F.col("record_count") < 5
    checks = files.select("source_series_key", F.col("created_at").alias("at"), F.when(~failed, F.col("snapshot_sha256")).alias("digest"), F.when(failed, F.lit("short")).alias("error"))
    return supersede.folded_checks(checks, "source_series_key", "at", "digest", "error").select("source_series_key", "last_attempt", "attempts", "last_success", "last_change", "digest", "failures_since")


@query("""SELECT authority_key, source_status_code, CAST(min(observation_date) AS VARCHAR) AS first_observed, date_diff('day', min(observation_date), DATE '2026-01-01') AS age_days FROM entity_observation GROUP BY 1, 2""")
def status_first_observed(s: SparkSession, d: str) -> DataFrame:
    """When each status was first seen at each authority, and how long ago."""
    out = supersede.first_observed(_observed(s, d), ["authority_key", "source_status_code"], "observation_date", F.lit("2026-01-01").cast("date"))
    return out.withColumns({"first_observed": F.col("first_observed").cast("string"), "age_days": F.col("age_days").cast("bigint")})


@query(f"""WITH {_MONTHS}, l AS (SELECT *, lag(st) OVER (PARTITION BY entry_id ORDER BY mo) AS was FROM m) SELECT entry_id, mo AS month, was AS from_mode, st AS to_mode FROM l WHERE was IS DISTINCT FROM st""")
def status_edges(s: SparkSession, d: str) -> DataFrame:
    """Months in which an entry's status is another than before."""
    return supersede.edge_transitions(_monthly(s, d), "entry_id", "month", "state")


@query("""SELECT edition_id FROM parse_snapshot WHERE edition_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT snapshot_sha256 || record_count) > 1""")
def file_append_conflicts(s: SparkSession, d: str) -> DataFrame:
    """Editions whose files of one time can't be added to those of another, as the content differs."""
    files = table(s, d, "parse_snapshot").filter("edition_id is not null")
    early = F.col("created_at") < F.lit("2024-01-01").cast("timestamp")
    return supersede.append_conflicts(files.filter(early), files.filter(~early), ["edition_id"], ["snapshot_sha256", "record_count"])

@query("""SELECT edition_id, 'reference_period_holds_a_day' AS rule FROM source_edition WHERE reference_from >= reference_to UNION ALL SELECT edition_id, 'published_after_reference' FROM source_edition WHERE publication_date < reference_from UNION ALL SELECT edition_id, 'identity_is_explicit' FROM source_edition WHERE edition_identity_status_code <> 'explicit'""")
def broken_edition_rules(s: SparkSession, d: str) -> DataFrame:
    """Editions that break rules on their dates and identity."""
    rules = {"reference_period_holds_a_day": F.col("reference_from") < F.col("reference_to"), "published_after_reference": F.col("publication_date") >= F.col("reference_from"), "identity_is_explicit": F.col("edition_identity_status_code") == "explicit"}
    return validate.broken_rules(_editions(s, d), "edition_id", rules)


@query("SELECT edition_id, entry_id, count(*) AS n FROM entity_observation GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_entries(s: SparkSession, d: str) -> DataFrame:
    """Entries with several rows in one edition."""
    return validate.repeated_keys(_observed(s, d), ["edition_id", "entry_id"])


@query("SELECT entity_observation_id, parse_run_id FROM entity_observation WHERE parse_run_id IS NOT NULL AND parse_run_id NOT IN (SELECT parse_run_id FROM parse_snapshot WHERE record_count >= 5)")
def rows_without_usable_file(s: SparkSession, d: str) -> DataFrame:
    """Rows that name a file that is not among those with five records or more."""
    return validate.orphans(_observed(s, d), table(s, d, "parse_snapshot").filter("record_count >= 5"), {"parse_run_id": "parse_run_id"}).select("entity_observation_id", "parse_run_id")

@query("SELECT source_status_code, count(*) AS n FROM entity_observation WHERE source_status_code NOT IN ('listed', 'pending', 'renewal_requested', 'renewal_update_in_progress', 'rejected_or_denied') GROUP BY 1")
def unlisted_status_codes(s: SparkSession, d: str) -> DataFrame:
    """Status codes outside a vocabulary."""
    return validate.unknown_codes(_observed(s, d), "source_status_code", ["listed", "pending", "renewal_requested", "renewal_update_in_progress", "rejected_or_denied"])


@query("SELECT p.parse_run_id FROM parse_snapshot p JOIN (SELECT edition_id, CAST(max(publication_date) AS VARCHAR) AS day FROM source_edition GROUP BY 1) e USING (edition_id) WHERE CAST(CAST(p.created_at AS DATE) AS VARCHAR) IS DISTINCT FROM e.day")
def files_not_made_when_published(s: SparkSession, d: str) -> DataFrame:
    """Files not made on the day their edition was published; an edition without a day differs from any."""
    parents = _editions(s, d).groupBy("edition_id").agg(F.max("publication_date").cast("string").alias("day"))
    files = table(s, d, "parse_snapshot").select("parse_run_id", "edition_id", F.to_date("created_at").cast("string").alias("day"))
    return validate.mismatched(files, parents, ["edition_id"], "day").select("parse_run_id")

@query("""WITH f AS (SELECT edition_id, max(record_count) AS x FROM parse_snapshot GROUP BY 1), o AS (SELECT edition_id, count(*) AS n FROM entity_observation GROUP BY 1)
SELECT edition_id, CAST(f.x AS BIGINT) AS expected, coalesce(o.n, 0) AS found FROM f FULL OUTER JOIN o USING (edition_id) WHERE f.x IS DISTINCT FROM coalesce(o.n, 0)""")
def edition_denominators(s: SparkSession, d: str) -> DataFrame:
    """Editions whose rows are not as many as their file has records."""
    expected = table(s, d, "parse_snapshot").groupBy("edition_id").agg(F.max("record_count").alias("x"))
    return validate.denominators(_observed(s, d), ["edition_id"], expected, "x")


@query("""WITH a AS (SELECT entry_id, min(authority_key) AS k, max(authority_key) AS m FROM entity_observation WHERE observation_date < DATE '2024-01-01' GROUP BY 1), b AS (SELECT entry_id, min(authority_key) AS k FROM entity_observation WHERE observation_date >= DATE '2024-01-01' GROUP BY 1)
SELECT a.entry_id, CASE WHEN b.entry_id IS NULL THEN 'removed' ELSE 'changed' END AS fault FROM a LEFT JOIN b USING (entry_id) WHERE b.entry_id IS NULL OR a.k IS DISTINCT FROM b.k""")
def mutated_entries(s: SparkSession, d: str) -> DataFrame:
    """Entries that vanished from the later rows or changed what is fixed."""
    rows = _observed(s, d)
    early = F.col("observation_date") < F.lit("2024-01-01").cast("date")
    one = lambda x: x.groupBy("entry_id").agg(F.min("authority_key").alias("k"))
    return validate.mutated(one(rows.filter(early)), one(rows.filter(~early)), ["entry_id"], ["k"])


@query("""SELECT identifier_observation_id, CASE WHEN length(normalised_value) < 6 THEN repeat('•', length(normalised_value)) ELSE substr(normalised_value, 1, 3) || repeat('•', length(normalised_value) - 5) || right(normalised_value, 2) END AS masked FROM identifier_observation""")
def masked_identifiers(s: SparkSession, d: str) -> DataFrame:
    """Identifiers with only their ends shown."""
    return table(s, d, "identifier_observation").select("identifier_observation_id", mask_ids(F.col("normalised_value")).alias("masked"))


@query("""SELECT entity_observation_id, trim(upper(translate(trim(regexp_replace(source_name_raw, '[\\s\\x{00A0}]+', ' ', 'g')), '’‘`´', '''''''''')), ' .') AS name, regexp_replace(lower(strip_accents(nfc_normalize(source_name_raw))), '[^a-z0-9]', '', 'g') AS folded FROM entity_observation""")
def normalised_names(s: SparkSession, d: str) -> DataFrame:
    """Names in their normal and folded forms."""
    return _observed(s, d).select("entity_observation_id", normalised_name(F.col("source_name_raw")).alias("name"), folded(F.col("source_name_raw")).alias("folded"))


_CIVIC = r"""t AS (SELECT address_id, trim(concat_ws(', ', review_street, review_civic)) AS t FROM address_review WHERE review_street IS NOT NULL),
p AS (SELECT *, regexp_matches(t, '(?i)(\bs\s*\.?\s*n\s*\.?\s*c\s*\.?|\bs\s*\.?\s*n\s*\.?)\s*$') AS none, regexp_extract(t, '^(.*?)(?:,\s*|\s+)(\d{1,5})(?:\s*[/-]\s*([A-Za-z]))?\s*$', 1) AS st,
        regexp_extract(t, '^(.*?)(?:,\s*|\s+)(\d{1,5})(?:\s*[/-]\s*([A-Za-z]))?\s*$', 2) AS no, regexp_extract(t, '^(.*?)(?:,\s*|\s+)(\d{1,5})(?:\s*[/-]\s*([A-Za-z]))?\s*$', 3) AS sx FROM t),
q AS (SELECT *, CASE WHEN t = '' THEN 'blank' WHEN none THEN 'explicit_no_civic' WHEN no = '' THEN 'no_confident_terminal_civic'
        WHEN regexp_matches(regexp_replace(regexp_replace(lower(st), '[^\p{L}\p{N}]+', ' ', 'g'), ' $', ''), '(^| )(ss|sp|s s|s p|strada statale|strada provinciale|km)$') THEN 'terminal_number_is_route_number' ELSE 'civic' END AS status FROM p)"""


@query(f"""WITH {_CIVIC} SELECT address_id, regexp_replace(CASE WHEN status = 'explicit_no_civic' THEN regexp_replace(t, '(?i)(\\bs\\s*\\.?\\s*n\\s*\\.?\\s*c\\s*\\.?|\\bs\\s*\\.?\\s*n\\s*\\.?)\\s*$', '') WHEN status = 'civic' THEN st ELSE t || chr(31) END, '[ ,;-]+$|' || chr(31), '') AS street, status,
  CASE WHEN status = 'civic' THEN CAST(CAST(no AS INT) AS VARCHAR) END AS number, CASE WHEN status = 'civic' THEN nullif(upper(sx), '') END AS suffix FROM q""")
def street_civics(s: SparkSession, d: str) -> DataFrame:
    """Reviewed streets with their number taken apart."""
    rows = table(s, d, "address_review").filter("review_street is not null")
    return rows.select("address_id", street_and_civic(F.concat_ws(", ", "review_street", "review_civic")).alias("p")).select("address_id", "p.*")

@query("""SELECT authority_key, listed, n, round_even(100.0 * listed / n, 2) AS percent FROM (SELECT authority_key, count(*) FILTER (source_status_code = 'listed') AS listed, count(*) AS n FROM entity_observation GROUP BY 1)""")
def listed_per_authority(s: SparkSession, d: str) -> DataFrame:
    """Listed rows of each authority and their percentage."""
    out = _observed(s, d).groupBy("authority_key").agg(F.count_if(F.col("source_status_code") == "listed").alias("listed"), F.count("*").alias("n"))
    return out.withColumn("percent", percent(F.col("listed"), F.col("n")))

@query("""SELECT coalesce(a.entry_id, b.entry_id) AS entry_id, coalesce(a.n, 0) AS n_identifiers, coalesce(b.n, 0) AS n_offices FROM (SELECT o.entry_id, count(*) AS n FROM identifier_observation i JOIN entity_observation o USING (entity_observation_id) GROUP BY 1) a
FULL OUTER JOIN (SELECT o.entry_id, count(*) AS n FROM establishment_observation e JOIN entity_observation o USING (entity_observation_id) GROUP BY 1) b ON a.entry_id = b.entry_id""")
def entry_lineage(s: SparkSession, d: str) -> DataFrame:
    """Identifiers and offices of entries, led back over the rows that name them; an entry with only one of them is there too."""
    rows = _observed(s, d).select("entity_observation_id", "entry_id")
    ids = table(s, d, "identifier_observation").join(rows, "entity_observation_id").groupBy("entry_id").agg(F.count("*").alias("n_identifiers"))
    offices = table(s, d, "establishment_observation").join(rows, "entity_observation_id").groupBy("entry_id").agg(F.count("*").alias("n_offices"))
    return ids.join(offices, "entry_id", "full_outer").select("entry_id", F.coalesce("n_identifiers", F.lit(0)).alias("n_identifiers"), F.coalesce("n_offices", F.lit(0)).alias("n_offices"))

@query("""SELECT parse_run_id FROM (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY created_at DESC, snapshot_sha256 DESC) AS k FROM parse_snapshot WHERE record_count >= 5 AND edition_id IS NOT NULL) WHERE k = 1""")
def newest_usable_files(s: SparkSession, d: str) -> DataFrame:
    """The newest file of each edition with five records or more."""
    files = table(s, d, "parse_snapshot").filter("edition_id is not null").select("parse_run_id", "edition_id", "created_at", "snapshot_sha256", "record_count")
    jobs, _ = project.selected_jobs(files, ["edition_id"], "created_at", "snapshot_sha256", {"enough_records": F.col("record_count") >= 5})
    return jobs.select("parse_run_id")


@query("""SELECT coalesce(m.edition_id, o.edition_id) AS edition_id, CASE WHEN o.edition_id IS NULL THEN 'missing' WHEN m.edition_id IS NULL THEN 'unexpected' ELSE 'different' END AS fault
FROM (SELECT edition_id, CAST(max(record_count) AS BIGINT) AS n FROM parse_snapshot WHERE record_count >= 5 GROUP BY 1) m FULL OUTER JOIN (SELECT edition_id, count(*) AS n FROM entity_observation GROUP BY 1) o USING (edition_id) WHERE m.n IS DISTINCT FROM o.n""")
def unmatched_editions(s: SparkSession, d: str) -> DataFrame:
    """Editions whose usable files and observations don't have as many rows."""
    files = table(s, d, "parse_snapshot").filter("record_count >= 5").groupBy("edition_id").agg(F.max("record_count").cast("bigint").alias("n"))
    return validate.unmatched(files, _observed(s, d).groupBy("edition_id").agg(F.count("*").alias("n")), ["edition_id"], ["n"])

@query("""SELECT source_hint, regexp_replace(regexp_replace(regexp_replace(raw_value, '\\p{L}+', 'A', 'g'), '\\p{N}+', '9', 'g'), '\\s+', ' ', 'g') AS shape, count(*) AS n FROM identifier_observation GROUP BY 1, 2""")
def identifier_shape_profile(s: SparkSession, d: str) -> DataFrame:
    """The shapes of identifiers as printed, without any value."""
    return validate.shape_profile(table(s, d, "identifier_observation"), ["source_hint"], "raw_value")


@query("""SELECT entity_observation_id FROM entity_observation WHERE observation_date BETWEEN DATE '2023-06-01' AND DATE '2023-12-31' AND source_status_code = 'listed' AND contains(lower(source_name_normalised), 'fratelli')""")
def listed_brothers(s: SparkSession, d: str) -> DataFrame:
    """Listed rows of a period whose name contains a text; all of it reaches the scan or stays in generated code."""
    wanted = filters.in_period(F.col("observation_date"), "2023-06-01", "2023-12-31") & filters.in_scope({"source_status_code": "listed", "authority_key": "all"}) & filters.mentions("Fratelli", [F.col("source_name_normalised")])
    return _observed(s, d).filter(wanted).select("entity_observation_id")


_TYPES = "|".join(p for p, _ in geo.ROAD_TYPES)
_KINDS = "CASE k " + " ".join(f"WHEN '{p}' THEN '{t}'" for p, t in geo.ROAD_TYPES) + " ELSE 'unspecified' END"


def _keyed(source: str) -> str:
    """SQL of rows with the key ``key`` of their street ``street``; other columns stay."""
    spelt = "array_to_string(regexp_extract_all(lower(strip_accents(street)), '[\\p{L}\\p{N}]+'), ' ')"
    pattern = f"'^(?:({_TYPES})(?: |$))?(.*)$'"
    parts = f"SELECT *, regexp_extract({spelt}, {pattern}, 1) AS k, regexp_extract({spelt}, {pattern}, 2) AS w FROM {source}"
    return f"SELECT * EXCLUDE (k, w), CASE WHEN w = '' THEN '' ELSE {_KINDS} || '|' || w END AS key FROM ({parts})"


@query(f"SELECT address_id, key AS street_key FROM ({_keyed('(SELECT address_id, review_street AS street FROM address_review WHERE review_street IS NOT NULL)')})")
def reviewed_street_keys(s: SparkSession, d: str) -> DataFrame:
    """Reviewed streets with their key for exact linkage."""
    return table(s, d, "address_review").filter("review_street is not null").select("address_id", geo.street_key(F.col("review_street")).alias("street_key"))


@query(f"""WITH {_CIVIC}, c AS (SELECT q.address_id, r.review_municipality AS municipality_code, regexp_replace(CASE WHEN status = 'explicit_no_civic' THEN regexp_replace(t, '(?i)(\\bs\\s*\\.?\\s*n\\s*\\.?\\s*c\\s*\\.?|\\bs\\s*\\.?\\s*n\\s*\\.?)\\s*$', '') WHEN status = 'civic' THEN st ELSE t || chr(31) END, '[ ,;-]+$|' || chr(31), '') AS street,
    CASE WHEN status = 'civic' THEN CAST(CAST(no AS INT) AS VARCHAR) || coalesce('/' || nullif(upper(sx), ''), '') END AS civic FROM q JOIN address_review r USING (address_id)),
a AS ({_keyed('c')}),
f AS ({_keyed("(SELECT review_municipality AS municipality_code, review_street AS street, review_batch AS street_id, upper(regexp_replace(trim(review_civic), '^0+(\\d)', '\\1')) AS civic, CAST(address_id % 90 AS DOUBLE) AS lat, CAST(address_id % 180 AS DOUBLE) AS lon FROM address_review WHERE review_street IS NOT NULL)")}),
s AS (SELECT municipality_code, key, count(DISTINCT street_id) AS n, median(lat) AS lat, median(lon) AS lon FROM f WHERE key <> '' GROUP BY 1, 2),
x AS (SELECT municipality_code, key, civic, count(DISTINCT (lat, lon)) AS n, min(lat) AS lat, min(lon) AS lon FROM f WHERE key <> '' AND civic IS NOT NULL GROUP BY 1, 2, 3),
z AS (SELECT a.address_id, CASE WHEN s.n IS NULL THEN 'no_street' WHEN s.n > 1 THEN 'ambiguous_street' WHEN x.n = 1 THEN 'civic' WHEN x.n > 1 THEN 'ambiguous_civic' ELSE 'street_only' END AS status, s.lat AS slat, s.lon AS slon, x.lat AS clat, x.lon AS clon
      FROM a LEFT JOIN s ON s.municipality_code = a.municipality_code AND s.key = a.key LEFT JOIN x ON x.municipality_code = a.municipality_code AND x.key = a.key AND x.civic = a.civic)
SELECT address_id, status, CASE status WHEN 'civic' THEN clat WHEN 'street_only' THEN slat END AS latitude, CASE status WHEN 'civic' THEN clon WHEN 'street_only' THEN slon END AS longitude FROM z""")
def linked_reviews(s: SparkSession, d: str) -> DataFrame:
    """Reviewed addresses linked exactly to the streets and numbers of all reviews, each batch taken as a street of its own, at made-up places."""
    rows = table(s, d, "address_review").filter("review_street is not null")
    asked = rows.select("address_id", F.col("review_municipality").alias("municipality_code"), F.concat_ws(", ", "review_street", "review_civic").alias("street"))
    reference = rows.select(F.col("review_municipality").alias("municipality_code"), F.col("review_street").alias("street"), F.col("review_batch").alias("street_id"), F.col("review_civic").alias("civic"), (F.col("address_id") % 90).cast("double").alias("latitude"), (F.col("address_id") % 180).cast("double").alias("longitude"))
    return geo.linked_to_reference(asked, reference)


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY source_series_key ORDER BY created_at DESC) AS k, max(created_at) OVER (PARTITION BY source_series_key) AS newest FROM parse_snapshot)
SELECT source_series_key, CASE WHEN count(DISTINCT (snapshot_sha256, record_count)) = 1 THEN min(parse_run_id) END AS parse_run_id, CASE WHEN count(DISTINCT (snapshot_sha256, record_count)) = 1 THEN 'selected' ELSE 'ambiguous' END AS state FROM r WHERE created_at = newest GROUP BY 1""")
def newest_files(s: SparkSession, d: str) -> DataFrame:
    """The newest file of each series, if its content is certain."""
    return project.newest_frozen(table(s, d, "parse_snapshot"), ["source_series_key"], "created_at", ["snapshot_sha256", "record_count"], "parse_run_id")


@query("""WITH x AS (SELECT source_series_key AS k, count(*) AS n, sum(record_count) AS m, CAST(max(created_at) AS DATE) AS l FROM parse_snapshot GROUP BY 1), s AS (SELECT source_series_key AS k, CAST(created_at AS DATE) AS l FROM source_series)
SELECT s.k AS source_series_key, CAST(CASE WHEN x.l > s.l THEN x.l ELSE s.l END AS VARCHAR) AS latest, coalesce(x.n, 0) AS sources_selected, CAST(coalesce(x.m, 0) AS BIGINT) AS amount_selected FROM s LEFT JOIN x USING (k)""")
def monitored_series(s: SparkSession, d: str) -> DataFrame:
    """The monitoring state of every series brought up to its files."""
    state = table(s, d, "source_series").select("source_series_key", F.to_date("created_at").alias("latest"))
    files = table(s, d, "parse_snapshot").select("source_series_key", F.to_date("created_at").alias("day"), "record_count")
    return project.synchronised(state, files, ["source_series_key"], "day", "record_count", "latest").withColumn("latest", F.col("latest").cast("string"))


@query("""WITH r AS (SELECT source_series_key AS k, bool_and(coalesce(publication_date IS NOT NULL, false)) AS c FROM source_edition GROUP BY 1)
SELECT s.source_series_key, coalesce(r.c, false) AS complete, CASE WHEN r.c THEN 'scope' ELSE 'population,scope' END AS issues FROM source_series s LEFT JOIN r ON r.k = s.source_series_key""")
def reconciled_series(s: SparkSession, d: str) -> DataFrame:
    """The open issues of every series after a report on its editions."""
    state = table(s, d, "source_series").select("source_series_key", F.lit(False).alias("complete"), F.array(F.lit("population"), F.lit("scope")).alias("issues"))
    report = _editions(s, d).select("source_series_key", F.col("publication_date").isNotNull().alias("complete"))
    return project.reconciled(state, report, ["source_series_key"], "complete", "issues", "population").withColumn("issues", F.array_join("issues", ","))


@query("""WITH l AS (SELECT entry_id, arg_max(source_status_code, (observation_date, projected_at, entity_observation_id)) AS st, bool_or(source_status_code = 'rejected_or_denied') AS bad, bool_or(source_status_code = 'listed') AS good FROM entity_observation GROUP BY 1)
SELECT entry_id, CASE WHEN st = 'pending' OR (st = 'renewal_requested' AND bad AND NOT good) THEN NULL ELSE '2026-01-01' END AS valid_to FROM l""")
def expired_requests(s: SparkSession, d: str) -> DataFrame:
    """One open request per entry, closed unless its newest status asks for one always, or after a refusal without any listing."""
    rows = _observed(s, d)
    newest = rows.groupBy("entry_id").agg(F.max_by("source_status_code", F.struct("observation_date", "projected_at", "entity_observation_id")).alias("st"))
    wanted = supersede.unserved(newest, F.col("st") == "pending", F.col("st") == "renewal_requested", rows, ["entry_id"], F.col("source_status_code") == "rejected_or_denied", F.col("source_status_code") == "listed")
    open_ = newest.select("entry_id", F.lit(None).cast("date").alias("valid_to"))
    return supersede.expired(open_, wanted, ["entry_id"], F.lit("2026-01-01").cast("date")).withColumn("valid_to", F.col("valid_to").cast("string"))

@query()
def projected_identifiers(s: SparkSession, d: str) -> DataFrame:
    """Identifier observations projected from observed rows with keys that are the same in every run."""
    rows = _observed(s, d).join(table(s, d, "identifier_observation").select("entity_observation_id", "raw_value"), "entity_observation_id", "left").select("edition_id", "entity_observation_id", "source_name_raw", "raw_value", F.lit(None).cast("string").alias("office"), F.lit(None).cast("string").alias("activity"))
    return project.projected(rows, "edition_id", "entity_observation_id", "source_name_raw", "raw_value", "office", "activity")["identifiers"]
