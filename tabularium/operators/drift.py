"""Schemas that drift between the JSON files of a series.

Each file's objects are reduced to their fields with the main type of each. Files are
chained in order of time by a few columns only, these are compared, and only for
files where one field vanished while another appeared are values read again, to tell
a renaming from a removal and an addition. The alternatives of a field are a tagged
union: per path the types met in any value, each with its count.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.functions.canonical import canonical, type_tag
from tabularium.session import shipped, written

RECORDS, DIAGNOSTICS = "records_json", "diagnostics_json"
#: Two fields carry the same information if this share of the entries that have both agree.
AGREEMENT = 0.5
#: A pair of labels is known to name one field once so many files show it by their values.
KNOWN_FILES = 2

_FIELDS = pa.list_(pa.struct([("f", pa.string()), ("t", pa.string())]))
_INVENTORY = pa.schema([("run", pa.string()), ("series", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("rec", _FIELDS), ("dia", _FIELDS), ("values", pa.string())])
_INVENTORY_DDL = "run string, series string, at bigint, n bigint, rec array<struct<f:string,t:string>>, dia array<struct<f:string,t:string>>, values string"
_TAGS = {str: "string", bool: "boolean", int: "number", float: "number", list: "array", dict: "object", type(None): None}


def decoded(text: str | None, kind: type) -> list | dict:
    """``text`` decoded; an empty container if it is NULL, malformed or of another kind."""
    try:
        value = json.loads(text) if text is not None else kind()
    except json.JSONDecodeError:
        return kind()
    except ValueError:  # a whole number with more digits than Python converts
        value = json.loads(text, parse_int=lambda digits: int(digits) if len(digits) < 4000 else float(digits))
    return value if isinstance(value, kind) else kind()


def field_types(records: list) -> dict[str, Counter]:
    """Per top-level field of the records the number of values of each type tag (None for null)."""
    met: Counter = Counter()
    for record in records:
        if record.__class__ is dict:
            met.update([(k, v.__class__) for k, v in record.items()])
    fields: dict[str, Counter] = defaultdict(Counter)
    for (name, kind), n in met.items():
        fields[name][_TAGS[kind]] += n
    return fields


def main_type(types: Counter) -> str | None:
    """The tag of most non-null values; of equal counts the first by name; None if all are null."""
    return min(((-n, t) for t, n in types.items() if t), default=(0, None))[1]


def _inventory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _INVENTORY.names}
        for run, series, at, records, diagnostics in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows, facts = decoded(records, list), decoded(diagnostics, dict)
            fields = field_types(rows)
            fields.pop("entry_id", None)
            out["run"].append(run)
            out["series"].append(series)
            out["at"].append(at)
            out["n"].append(len(rows))
            out["rec"].append([{"f": f, "t": main_type(fields[f])} for f in sorted(fields)])
            out["dia"].append([{"f": f, "t": type_tag(facts[f])} for f in sorted(facts)])
            out["values"].append(json.dumps(facts, ensure_ascii=False))
        yield pa.RecordBatch.from_pydict(out, schema=_INVENTORY)


def inventory(snapshots: DataFrame) -> DataFrame:
    """One row per distinct file of each series with the fields of its two JSON columns and the main type of each."""
    shipped(snapshots.sparkSession)
    source = snapshots.filter("parse_run_id is not null and source_series_key is not null").select("parse_run_id", "source_series_key", F.unix_micros("created_at"), RECORDS, DIAGNOSTICS)
    return source.mapInArrow(_inventory, _INVENTORY_DDL).dropDuplicates(["series", "run"])


_VALUES = pa.schema([("series", pa.string()), ("target", pa.string()), ("side", pa.string()), ("field", pa.string()), ("entries", pa.list_(pa.string())), ("hashes", pa.list_(pa.string()))])
_VALUES_DDL = "series string, target string, side string, field string, entries array<string>, hashes array<string>"


def _entry(record: object) -> str | None:
    """The entry that a record is of, alike for 5, 5.0 and "5"; None if that is unknown."""
    entry = record.get("entry_id") if isinstance(record, dict) else None
    if isinstance(entry, float) and entry.is_integer():
        entry = int(entry)
    return str(entry) if isinstance(entry, (int, float, str)) else None


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each wanted (file of a series, side, fields): the hash of each entry's canonical value."""
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _VALUES.names}
        for series, records, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = [(e, r) for r in decoded(records, list) if (e := _entry(r)) is not None]
            for want in wanted:
                for field in want["fields"]:
                    values = {e: c for e, r in rows if (c := canonical(r.get(field)))}
                    for name, value in zip(out, (series, want["target"], want["side"], field, list(values), list(values.values())), strict=True):
                        out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=_VALUES)


def _label_words(label: str) -> set[str]:
    return {w.lower() for w in re.findall(r"[A-Z]?[a-zà-ù]+|[A-Z]+|\d+", label)}


def _greedy(scores: list[tuple[float, str, str]]) -> list[tuple[str, str]]:
    """One-to-one pairs by falling score; equal scores by name."""
    pairs, used = [], set()
    for _, old, new in sorted(scores, key=lambda s: (-s[0], s[1], s[2])):
        if (0, old) not in used and (1, new) not in used:
            used |= {(0, old), (1, new)}
            pairs.append((old, new))
    return pairs


def same_records_field(old: dict[str, str], new: dict[str, str]) -> float:
    """Share of the entries with a value on both sides whose canonical values agree; 0 below ``AGREEMENT``."""
    both = old.keys() & new.keys()
    agree = sum(old[e] == new[e] for e in both)
    share = agree / len(both) if both else 0.0
    return share + agree * 1e-6 if agree and share >= AGREEMENT else 0.0


def same_fact(old: object, new: object, old_label: str, new_label: str, old_rows: int, new_rows: int) -> float:
    """How surely two diagnostics state the same: by label, by value, by being the same figure of their files."""
    labels_a, labels_b = _label_words(old_label), _label_words(new_label)
    alike = len(labels_a & labels_b) / max(1, min(len(labels_a), len(labels_b)))
    kinds = type_tag(old), type_tag(new)
    equal = (a := canonical(old)) is not None and a == canonical(new)
    if isinstance(old, dict) and isinstance(new, dict):
        equal = equal or bool(old.keys() & new.keys()) and len(old.keys() & new.keys()) * 2 >= min(len(old), len(new))
    counts = old == old_rows and new == new_rows and "number" in kinds
    score = 1.0 * equal + 0.9 * counts + 1.5 * alike
    return score if equal or counts or (alike >= 1 and kinds[0] == kinds[1]) or labels_a == labels_b else 0.0


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"source_series_key": [], "parse_run_id": [], "json_column": [], "change_kind": [], "field_name": [], "former_name": [], "type": []}
        for row in batch.to_pylist():
            sides: dict[str, dict[str, dict[str, str]]] = {"gone": {}, "new": {}}
            for v in row["found"] or ():
                sides[v["side"]][v["field"]] = dict(zip(v["entries"], v["hashes"], strict=True))
            for column, key in ((RECORDS, "rec"), (DIAGNOSTICS, "dia")):
                now, was = ({x["f"]: x["t"] for x in row[k]} for k in (key, f"was_{key}"))
                gone, new = was.keys() - now.keys(), now.keys() - was.keys()
                if key == "rec":
                    scores = [(s, a, b) for a in gone for b in new if (s := same_records_field(sides["gone"].get(a, {}), sides["new"].get(b, {})))]
                elif gone and new:
                    facts, former = decoded(row["values"], dict), decoded(row["was_values"], dict)
                    scores = [(s, a, b) for a in gone for b in new if (s := same_fact(former.get(a), facts.get(b), a, b, row["was_n"], row["n"]))]
                else:
                    scores = []
                renamed = {b: a for a, b in _greedy(scores)}
                events = [("renamed", b, a) for b, a in renamed.items()]
                events += [("added", b, None) for b in new - renamed.keys()] + [("removed", a, None) for a in gone - set(renamed.values())]
                events += [("retyped", b, renamed.get(b)) for b in now if (a := renamed.get(b, b)) in was and now[b] and was[a] and now[b] != was[a]]
                for kind, name, former_name in events:
                    for c, v in zip(out, (row["series"], row["run"], column, kind, name, former_name, was.get(name) if kind == "removed" else now.get(name)), strict=True):
                        out[c].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.string()) for c in out]))


def field_changes(snapshots: DataFrame) -> DataFrame:
    """Every change of fields or types of a file against the file before it in its series.

    Result: parse_run_id, json_column, change_kind (added, removed, renamed, retyped), field_name, former_name.
    Files are the distinct non-NULL parse_run_id of a non-NULL series in order of created_at, then id; one that stands
    in several series is a file of each. NULL or malformed JSON counts as no records; a field with only nulls is there but has no type, so it is never
    retyped. Repeated rows of a file count once. Empty input gives no rows; other columns are ignored.
    """
    file = ["series", "run"]
    files = written(inventory(snapshots), "inventory")
    w = Window.partitionBy("series").orderBy("at", "run")
    chain = files.select("series", "at", "run").withColumn("next", F.lead("run").over(w)).filter(F.col("next").isNotNull()).select("series", "run", "next")
    was = files.join(chain, file).select("series", F.col("next").alias("run"), *[F.col(c).alias(f"was_{c}") for c in ("n", "rec", "dia", "values")], F.col("run").alias("was_run"))
    changed = written(files.join(was, file).filter("rec <> was_rec or dia <> was_dia").drop("at"), "changed")

    gone = F.array_except("was_rec.f", "rec.f")
    new = F.array_except("rec.f", "was_rec.f")
    sides = F.array(
        F.struct("series", F.col("run").alias("of"), F.col("run").alias("target"), F.lit("new").alias("side"), new.alias("fields")),
        F.struct("series", F.col("was_run").alias("of"), F.col("run").alias("target"), F.lit("gone").alias("side"), gone.alias("fields")),
    )
    wanted = changed.filter((F.size(gone) > 0) & (F.size(new) > 0)).select(F.explode(sides).alias("s")).groupBy(F.col("s.series").alias("source_series_key"), F.col("s.of").alias("parse_run_id")).agg(F.collect_list(F.struct("s.target", "s.side", "s.fields")).alias("wanted"))
    wanted = written(wanted, "wanted")
    # a written table has a known size, so it is broadcast only if that is under the session's own bound
    read = snapshots.select("source_series_key", "parse_run_id", RECORDS).join(wanted, ["source_series_key", "parse_run_id"]).select("source_series_key", RECORDS, "wanted")
    found = read.mapInArrow(_values, _VALUES_DDL)
    found = found.groupBy("series", F.col("target").alias("run")).agg(F.collect_set(F.struct("side", "field", "entries", "hashes")).alias("found"))
    ddl = "source_series_key string, parse_run_id string, json_column string, change_kind string, field_name string, former_name string, type string"
    return _with_known_names(written(changed.join(found, file, "left").mapInArrow(_report, ddl), "changes")).drop("source_series_key", "type")


def _with_known_names(report: DataFrame) -> DataFrame:
    """The report with a removal and an addition in one file made a renaming where other files show, by their values, that the two labels name one field.

    Of several such pairs those count that are each other's most frequent; equal counts by name.
    """
    file = ["source_series_key", "parse_run_id", "json_column"]
    renamed = report.filter("change_kind = 'renamed'")
    known = renamed.groupBy("json_column", F.least("former_name", "field_name").alias("_a"), F.greatest("former_name", "field_name").alias("_b")).agg(F.count_distinct("parse_run_id").alias("_n")).filter(F.col("_n") >= KNOWN_FILES)
    gone, new = (report.filter(F.col("change_kind") == k).select(*file, F.col("field_name").alias(n), F.col("type").alias(f"{n}_type")) for k, n in (("removed", "former"), ("added", "name")))
    pairs = gone.join(new, file).withColumns({"_a": F.least("former", "name"), "_b": F.greatest("former", "name")}).join(known, ["json_column", "_a", "_b"])
    best = lambda side, other: F.row_number().over(Window.partitionBy(*file, side).orderBy(F.desc("_n"), other))
    chosen = pairs.withColumns({"_x": best("former", "name"), "_y": best("name", "former")}).filter("_x = 1 and _y = 1")
    kinds = F.array_compact(F.array(F.lit("renamed"), F.when(F.col("former_type") != F.col("name_type"), F.lit("retyped"))))
    made = chosen.select(*file, F.explode(kinds).alias("change_kind"), F.col("name").alias("field_name"), F.col("former").alias("former_name"), F.col("name_type").alias("type"))
    undone = chosen.select(*file, F.explode(F.array(F.struct(F.lit("removed").alias("change_kind"), F.col("former").alias("field_name")), F.struct(F.lit("added").alias("change_kind"), F.col("name").alias("field_name")))).alias("u")).select(*file, "u.*")
    return report.join(undone, [*file, "change_kind", "field_name"], "left_anti").select(*report.columns).unionByName(made)


_CELL = pa.struct([("type", pa.string()), ("as_string", pa.string()), ("as_number", pa.float64()), ("as_boolean", pa.bool_()), ("as_json", pa.string()), ("canonical", pa.string())])
_CELL_DDL = "struct<type:string,as_string:string,as_number:double,as_boolean:boolean,as_json:string,canonical:string>"


def _cell(value: object) -> dict:
    tag = type_tag(value)
    return {
        "type": tag,
        "as_string": value if tag == "string" else None,
        "as_number": float(value) if tag == "number" else None,
        "as_boolean": value if tag == "boolean" else None,
        "as_json": json.dumps(value, ensure_ascii=False, sort_keys=True) if tag in ("array", "object") else None,
        "canonical": canonical(value),
    }


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("parse_run_id", pa.string()), ("source_series_key", pa.string()), ("position", pa.int32()), ("entry_id", pa.int64()), ("fields", pa.map_(pa.string(), _CELL))])
    for batch in batches:
        for run, series, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = [r for r in decoded(records, list) if isinstance(r, dict)]
            if rows:
                yield pa.RecordBatch.from_pydict(
                    {
                        "parse_run_id": [run] * len(rows),
                        "source_series_key": [series] * len(rows),
                        "position": list(range(len(rows))),
                        "entry_id": [e if isinstance(e := r.get("entry_id"), int) and not isinstance(e, bool) else None for r in rows],
                        "fields": [[(k, _cell(v)) for k, v in r.items() if k != "entry_id"] for r in rows],
                    },
                    schema=schema,
                )


def unified_records(snapshots: DataFrame) -> DataFrame:
    """All records of all files in one table, whatever their fields.

    Result: parse_run_id, source_series_key, position, entry_id and ``fields``, a map from label to a tagged union:
    the type met, the value in the branch of that type, and its canonical form. A file delivered
    repeatedly counts once. NULL or malformed JSON gives no records; an entry_id that is no whole number is NULL.
    """
    shipped(snapshots.sparkSession)
    ids = snapshots.filter(F.col("parse_run_id").isNotNull())
    w = Window.partitionBy("parse_run_id").orderBy("created_at")
    once = ids.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("parse_run_id", "source_series_key", RECORDS)
    return once.mapInArrow(_records, f"parse_run_id string, source_series_key string, position int, entry_id bigint, fields map<string,{_CELL_DDL}>")


_PATHS = pa.list_(pa.struct([("c", pa.string()), ("p", pa.list_(pa.string())), ("t", pa.string()), ("n", pa.int64())]))
_PATHS_DDL = "run string, series string, at bigint, met array<struct<c:string,p:array<string>,t:string,n:bigint>>"


def path_types(objects: list, skipped: frozenset[str] = frozenset()) -> Counter:
    """The number of non-null values of each (path, type tag) in the objects, whatever their nesting.

    A path is the labels from the top; the elements of an array are one further step ``[]``. ``skipped`` are top-level fields left out.
    """
    met: Counter = Counter()
    waiting = [((k,), v) for o in objects if o.__class__ is dict for k, v in o.items() if k not in skipped]
    while waiting:
        path, value = waiting.pop()
        kind = value.__class__
        if value is not None:
            met[path, _TAGS[kind]] += 1
        if kind is dict:
            waiting.extend(((*path, k), v) for k, v in value.items())
        elif kind is list:
            waiting.extend(((*path, "[]"), v) for v in value)
    return met


def _alternatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        met = []
        for records, diagnostics in zip(*(batch.column(c).to_pylist() for c in (RECORDS, DIAGNOSTICS)), strict=True):
            counts = ((RECORDS, path_types(decoded(records, list), frozenset(("entry_id",)))), (DIAGNOSTICS, path_types([decoded(diagnostics, dict)])))
            met.append([{"c": c, "p": list(p), "t": t, "n": n} for c, types in counts for (p, t), n in types.items()])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(met, _PATHS)], ["run", "series", "at", "met"])


def appearing_alternatives(snapshots: DataFrame) -> DataFrame:
    """For each series, column and field, also within objects and arrays, every type any of its values ever had, with the first and last file and the numbers of files and values.

    Result: source_series_key, json_column, field_name, type, first_seen, last_seen, n_files, n_values. A nested field's name is its path with dots;
    the elements of an array are the step ``[]``. Paths are told apart by their steps, so a label that holds a dot is never merged with a nested
    field. Nulls have no type and add nothing.
    """
    shipped(snapshots.sparkSession)
    source = snapshots.filter("parse_run_id is not null and source_series_key is not null").select("parse_run_id", "source_series_key", F.unix_micros("created_at"), RECORDS, DIAGNOSTICS)
    files = source.mapInArrow(_alternatives, _PATHS_DDL).dropDuplicates(["series", "run"])
    cells = files.select("series", "at", F.explode("met").alias("x"))
    return (
        cells.groupBy(F.col("series").alias("source_series_key"), F.col("x.c").alias("json_column"), F.col("x.p").alias("_path"), F.col("x.t").alias("type"))
        .agg(F.timestamp_micros(F.min("at")).alias("first_seen"), F.timestamp_micros(F.max("at")).alias("last_seen"), F.count("*").alias("n_files"), F.sum("x.n").alias("n_values"))
        .select("source_series_key", "json_column", F.array_join("_path", ".").alias("field_name"), "type", "first_seen", "last_seen", "n_files", "n_values")
    )
