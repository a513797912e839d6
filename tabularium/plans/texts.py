"""Queries that take texts apart: identifiers, dates, lines, headers and continuation rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.scalars import any_date, capital_key, date_list, identifiers, iso_text, items, shaped_identifiers, single_date, source_date, stable_key, word_spans
from tabularium.operators import drift, extract
from tabularium.operators.validate import broken_rules
from tabularium.sinks.tables import for_csv
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


def _lines(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))


_LINES = "l AS (SELECT doc_id, unnest(generate_series(0, len(x) - 1)) AS line, unnest(x) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))"


@query("""WITH p AS (SELECT identifier_observation_id, regexp_extract_all(upper(regexp_replace(raw_value, '[^A-Za-z0-9\\s·;,]', '', 'g')), '[A-Z0-9]+') AS w FROM identifier_observation),
g AS (SELECT identifier_observation_id, list_filter(w, lambda x: regexp_full_match(x, '[0-9]{11}|[A-Z0-9]{16}')) AS i FROM p)
SELECT identifier_observation_id, array_to_string(list_filter(i, lambda x, n: list_position(i, x) = n), ' ') AS found FROM g""")
def whole_identifiers(s: SparkSession, d: str) -> DataFrame:
    """The well-formed identifiers of each field in order, once each."""
    return table(s, d, "identifier_observation").select("identifier_observation_id", F.array_join(identifiers(F.col("raw_value")), " ").alias("found"))

@query("""SELECT doc_id, array_to_string(regexp_extract_all(text, '\\b[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\\b'), ' ') AS dates, len(regexp_extract_all(text, '\\([0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\\)')) AS parenthesised FROM documents""")
def document_dates(s: SparkSession, d: str) -> DataFrame:
    """The day/month/year dates each document names as written, and how many stand in parentheses."""
    found = date_list(F.col("text"))
    return table(s, d, "documents").select("doc_id", F.array_join(F.transform(found, lambda x: x["raw"]), " ").alias("dates"), F.size(F.filter(found, lambda x: x["parenthesised"])).cast("bigint").alias("parenthesised"))

@query("""SELECT doc_id, CASE WHEN len(x) = 1 THEN CAST(x[1] AS VARCHAR) END AS day FROM (SELECT doc_id, list_distinct([CAST(try_strptime(y, '%d/%m/%Y') AS DATE) FOR y IN regexp_extract_all(text, '\\b[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\\b')]) AS x FROM documents)""")
def single_slash_dates(s: SparkSession, d: str) -> DataFrame:
    """The only slash date of each document, NULL if there are several."""
    found = F.array_distinct(F.array_compact(F.transform(date_list(F.col("text")), lambda x: source_date(x["raw"]))))
    return table(s, d, "documents").select("doc_id", F.when(F.size(found) == 1, F.element_at(found, 1)).cast("string").alias("day"))


@query()
def single_document_dates(s: SparkSession, d: str) -> DataFrame:
    """The only date of each document in any writing."""
    return table(s, d, "documents").select("doc_id", single_date(F.col("text")).cast("string").alias("day"))


@query("""SELECT edition_id, strftime(publication_date, '%d/%m/%Y') AS shown, strftime(publication_date, '%Y-%m-%d') AS iso, CAST(publication_date AS VARCHAR) AS day FROM source_edition WHERE publication_date IS NOT NULL""")
def date_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Publication dates written and read again."""
    shown = F.date_format("publication_date", "dd/MM/yyyy")
    return table(s, d, "source_edition").filter("publication_date is not null").select("edition_id", shown.alias("shown"), iso_text(shown).alias("iso"), any_date(shown).cast("string").alias("day"))


@query(f"""WITH {_LINES}, h AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[.;:]') AND length(text) BETWEEN 3 AND 60 THEN text END AS head FROM l)
SELECT doc_id, line, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM h""")
def carried_headers(s: SparkSession, d: str) -> DataFrame:
    """Each line of a document with the header above it."""
    header = F.when(~F.col("text").rlike("[.;:]") & F.length("text").between(3, 60), F.col("text"))
    return extract.carried(_lines(s, d), ["doc_id"], ["line"], header, "header").select("doc_id", F.col("line").cast("bigint").alias("line"), "header")


@query(f"""WITH {_LINES}, g AS (SELECT *, sum(CASE WHEN regexp_matches(text, '^[0-9]+\\) ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS segment FROM l)
SELECT doc_id, CAST(segment AS BIGINT) AS segment, string_agg(text, ' ' ORDER BY line) FILTER (trim(text) <> '') AS text, count(*) AS n FROM g WHERE segment > 0 GROUP BY 1, 2""")
def stitched_items(s: SparkSession, d: str) -> DataFrame:
    """Numbered items of documents with their continuation lines."""
    out = extract.stitched(_lines(s, d), ["doc_id"], ["line"], F.col("text").rlike(r"^[0-9]+\) "), ["text"])
    return out.select("doc_id", "segment", "text", F.col("rows").alias("n"))


@query("""SELECT source, list_aggregate(list_sort(list(DISTINCT doc_type)), 'string_agg', ',') AS doc_types, count(*) AS n, count(DISTINCT lang) > 1 AS conflict FROM documents GROUP BY 1""")
def collapsed_sources(s: SparkSession, d: str) -> DataFrame:
    """Documents of each source as one row with its kinds of document."""
    once = table(s, d, "documents").groupBy("source", "doc_type", "lang").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("c"))
    out = extract.collapsed(once, ["source"], "doc_id", "doc_type", ["lang"]).select("source", F.array_join(F.array_sort("items"), ",").alias("doc_types"), "conflict")
    return out.join(once.groupBy("source").agg(F.sum("c").alias("n")), "source")


@query("""SELECT doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS n_words FROM documents""")
def document_words(s: SparkSession, d: str) -> DataFrame:
    """Words of each document."""
    return table(s, d, "documents").select("doc_id", F.size(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).cast("bigint").alias("n_words"))


@query("""SELECT authority_key, regexp_replace(upper(strip_accents(jurisdiction_name)), '[^A-Z]', '', 'g') AS key FROM territorial_authority""")
def authority_letters(s: SparkSession, d: str) -> DataFrame:
    """Authorities' names as capital letters only."""
    return table(s, d, "territorial_authority").select("authority_key", capital_key(F.col("jurisdiction_name")).alias("key"))


@query("""SELECT source_series_key, sha256(concat_ws(chr(31), '=' || source_series_key, coalesce('=' || population_scope, '-'), '=' || regime_code)) AS key FROM source_series""")
def series_keys(s: SparkSession, d: str) -> DataFrame:
    """Stable keys of series in which NULL and empty differ."""
    return table(s, d, "source_series").select("source_series_key", stable_key(F.col("source_series_key"), F.col("population_scope"), F.col("regime_code")).alias("key"))


@query("""SELECT entity_observation_id, CASE WHEN regexp_matches(source_name_raw, '^[=+@\\-\\t\\r]') THEN '''' || source_name_raw ELSE source_name_raw END AS source_name_raw FROM entity_observation""")
def names_for_csv(s: SparkSession, d: str) -> DataFrame:
    """Names as they go into CSV."""
    return for_csv(table(s, d, "entity_observation").select("entity_observation_id", "source_name_raw"))


@query("""SELECT doc_id, 'length_is_right' AS rule FROM documents WHERE n_chars <> length(text) UNION ALL SELECT doc_id, 'language_is_known' FROM documents WHERE lang NOT IN ('it', 'de', 'fr') UNION ALL SELECT doc_id, 'text_is_short' FROM documents WHERE n_chars > 5000""")
def broken_document_rules(s: SparkSession, d: str) -> DataFrame:
    """Documents that break rules on length and language."""
    rules = {"length_is_right": F.col("n_chars") == F.length("text"), "language_is_known": F.col("lang").isin("it", "de", "fr"), "text_is_short": F.col("n_chars") <= 5000}
    return broken_rules(table(s, d, "documents"), "doc_id", rules)


@query()
def file_records(s: SparkSession, d: str) -> DataFrame:
    """All records of all files in one table, whatever their fields: one row per record and field."""
    records = drift.unified_records(table(s, d, "parse_snapshot"))
    return records.select("parse_run_id", "position", "entry_id", F.explode("fields").alias("label", "cell")).select("parse_run_id", "position", "entry_id", "label", "cell.*")


@query("""WITH o AS (SELECT * FROM (SELECT parse_run_id, records_json AS j, row_number() OVER (PARTITION BY parse_run_id ORDER BY created_at) AS k FROM parse_snapshot WHERE parse_run_id IS NOT NULL) WHERE k = 1),
r AS (SELECT parse_run_id, unnest(generate_series(0, CAST(json_array_length(j) AS INT) - 1)) AS position, j FROM o),
c AS (SELECT parse_run_id, position, json_extract(j, '$[' || position || ']') AS rec FROM r),
l AS (SELECT *, unnest(json_keys(rec)) AS label FROM c), v AS (SELECT *, json_extract(rec, '$."' || label || '"') AS x FROM l WHERE label <> 'entry_id'),
t AS (SELECT *, CASE json_type(x) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'number' END AS type FROM v)
SELECT parse_run_id, CAST(position AS BIGINT) AS position, CAST(json_extract(rec, '$.entry_id') AS BIGINT) AS entry_id, label, type, CASE type WHEN 'string' THEN x ->> '$' END AS as_string, CASE type WHEN 'number' THEN CAST(x AS DOUBLE) END AS as_number, CASE type WHEN 'boolean' THEN x ->> '$' END AS as_boolean FROM t""")
def file_values(s: SparkSession, d: str) -> DataFrame:
    """The values of all records of all files, each in the branch of its type."""
    records = drift.unified_records(table(s, d, "parse_snapshot"))
    cells = records.select("parse_run_id", F.col("position").cast("bigint").alias("position"), "entry_id", F.explode("fields").alias("label", "cell"))
    return cells.select("parse_run_id", "position", "entry_id", "label", *[F.col(f"cell.{c}").alias(c) for c in ("type", "as_string", "as_number")], F.col("cell.as_boolean").cast("string").alias("as_boolean"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
i AS (SELECT doc_id, line, unnest(regexp_split_to_array(trim(regexp_replace(t, '[\\s\\x{00A0}]+', ' ', 'g')), '\\s*•\\s*|\\s+-\\s+')) AS item FROM l)
SELECT * FROM i WHERE item <> ''""")
def list_items(s: SparkSession, d: str) -> DataFrame:
    """Items of lines that list several with dashes."""
    return _lines(s, d).select("doc_id", "line", F.explode(items(F.col("text"))).alias("item"))


@query("""WITH t AS (SELECT identifier_observation_id, upper(regexp_replace(raw_value, '\\s', '', 'g')) AS v FROM identifier_observation)
SELECT identifier_observation_id, v AS raw_value, CASE WHEN regexp_full_match(v, '[0-9]{11}') THEN '11_digit_numeric' WHEN regexp_full_match(v, '[0-9]+') THEN 'numeric_' || length(v) || '_digits' WHEN regexp_full_match(v, '[A-Z0-9]{16}') THEN '16_char_alphanumeric' WHEN regexp_full_match(v, '[A-Z0-9]+') THEN 'unparsed_alphanumeric' ELSE 'unparsed' END AS shape,
  CASE WHEN regexp_full_match(v, '[0-9]{11}') THEN 'UNRESOLVED_CF_OR_VAT' WHEN regexp_full_match(v, '[A-Z0-9]{16}') AND NOT regexp_full_match(v, '[0-9]+') THEN 'IT_CF_CANDIDATE' ELSE 'UNKNOWN' END AS scheme_assertion FROM t WHERE v NOT IN ('', 'CF', 'C.F', 'C.F.')""")
def identifier_shapes(s: SparkSession, d: str) -> DataFrame:
    """Identifiers of fields with their shape and what scheme they may be of."""
    rows = table(s, d, "identifier_observation").select("identifier_observation_id", F.explode(shaped_identifiers(F.col("raw_value"))).alias("i"))
    return rows.select("identifier_observation_id", "i.raw_value", "i.shape", "i.scheme_assertion")

@query()
def address_word_spans(s: SparkSession, d: str) -> DataFrame:
    """Words of addresses with their offsets."""
    return table(s, d, "establishment_observation").select("establishment_observation_id", F.explode(word_spans(F.col("full_address_raw"))).alias("w")).select("establishment_observation_id", "w.*")
