"""Snapshot differences, history and drift against plain Python on small tables with all sorts of gaps."""

import datetime as dt
import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tabularium.operators import history
from tabularium.operators.drift import appearing_alternatives, field_changes, unified_records
from tabularium.operators.history import key_history, snapshot_tree
from tabularium.operators.snapshots import snapshot_changes, snapshot_positions
from tabularium.session import written

DAY = dt.date(2020, 1, 1)


def lists(seed, hot):
    """Random snapshots (id, group, date) and rows (snapshot, key, value, version) with repeated rows, and one group with a large share."""
    r = random.Random(seed)
    snaps, rows = [], []
    for g in range(5):
        n_keys = 400 if hot and g == 0 else 12
        state = {}
        for s in range(6):
            sid = f"s{g}-{s}"
            snaps.append((sid, f"g{g}", DAY + dt.timedelta(days=10 * s)))
            for k in range(n_keys):
                key = g * 1000 + k
                if r.random() < 0.15:
                    state[key] = r.choice([None, "A", "B", "C"])
                if state.get(key):
                    rows.append((sid, key, state[key], 1, "x"))
                    if r.random() < 0.1:
                        rows.append((sid, key, "OLD", 0, "x"))
    return snaps, rows


def frames(spark, seed=1, hot=False):
    snaps, rows = lists(seed, hot)
    s = spark.createDataFrame([*snaps, (None, "g0", DAY), ("lost", None, DAY)], "snap string, series string, day date")
    o = spark.createDataFrame([*rows, (None, 1, "A", 1, "x"), ("s0-0", None, "A", 1, "x"), ("nowhere", 5, "A", 1, "x")], "snap string, k bigint, value string, version bigint, _group string")
    return snaps, rows, s, o


def final(rows):
    best = {}
    for sid, key, value, version, _ in rows:
        if (sid, key) not in best or version > best[sid, key][0]:
            best[sid, key] = (version, value)
    per = defaultdict(dict)
    for (sid, key), (_, value) in best.items():
        per[sid][key] = value
    return per


def args():
    return dict(snapshot="snap", key="k", digest=F.xxhash64("value"), version=F.col("version"), tie=F.col("version"))


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True)])
def test_changes_equal_plain_comparison(spark, seed, hot):
    snaps, rows, s, o = frames(spark, seed, hot)
    per, expected = final(rows), set()
    for g in {x[1] for x in snaps}:
        ids = [x[0] for x in sorted(snaps, key=lambda x: x[2]) if x[1] == g]
        for a, b in zip(ids, ids[1:]):
            for key in per[a].keys() | per[b].keys():
                x, y = per[a].get(key), per[b].get(key)
                if x != y:
                    expected.add((b, key, "added" if x is None else "removed" if y is None else "changed", x, y))
    positions = snapshot_positions(s, snapshot="snap", group="series", order=[F.col("day")])
    plain = snapshot_changes(o, positions, **args(), bucket_rows=50).collect()
    assert {tuple(r) for r in plain} == {e[:3] for e in expected} and len(plain) == len(expected)
    full = snapshot_changes(o, positions, **args(), values=["value"]).select("snap", "k", "change_kind", "old_value", "new_value").collect()
    assert {tuple(r) for r in full} == expected and len(full) == len(expected)


@pytest.mark.parametrize("seed, hot, leaf_rows", [(3, False, 32), (4, True, 8), (5, False, 1)])
def test_history_equals_plain_runs(spark, seed, hot, leaf_rows):
    snaps, rows, s, o = frames(spark, seed, hot)
    per, expected = final(rows), []
    for g in {x[1] for x in snaps}:
        ids = sorted((x for x in snaps if x[1] == g), key=lambda x: x[2])
        for key in {k for x in ids for k in per[x[0]]}:
            run = None
            for sid, _, day in ids:
                value = per[sid].get(key)
                if run and run[1] != value:
                    expected.append((key, run[0], day))
                    run = None
                if value and not run:
                    run = (day, value)
            if run:
                expected.append((key, run[0], None))
    counts = o.groupBy("snap").agg(F.count("*").alias("n"))
    tree = snapshot_tree(s.join(counts, "snap", "left"), snapshot="snap", group="series", date=F.col("day"), order=[], rows=F.col("n"), leaf_rows=leaf_rows)
    got = key_history(o, tree, **args()).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_empty_tables(spark):
    _, _, s, o = frames(spark)
    positions = snapshot_positions(s, snapshot="snap", group="series", order=[F.col("day")])
    assert snapshot_changes(o.limit(0), positions, **args()).count() == 0
    assert snapshot_changes(o, positions.limit(0), **args(), values=["value"]).count() == 0
    tree = snapshot_tree(s.limit(0), snapshot="snap", group="series", date=F.col("day"), order=[], rows=F.lit(1))
    assert key_history(o, tree, **args()).count() == 0


def files(spark, *contents, series="s"):
    rows = [(f"r{n}", series, json.dumps(records) if not isinstance(records, str) and records is not None else records, json.dumps(facts), dt.datetime(2020, 1, 1 + n), "clash") for n, (records, facts) in enumerate(contents)]
    rows += [rows[0]] if rows else []
    return spark.createDataFrame([*rows, (None, series, "[]", "{}", dt.datetime(2019, 1, 1), ""), ("r-x", None, "[]", "{}", dt.datetime(2019, 1, 1), "")], "parse_run_id string, source_series_key string, records_json string, diagnostics_json string, created_at timestamp, run string")


def drift(spark, *contents):
    return {tuple(r)[:4] for r in field_changes(files(spark, *contents)).collect()}


def people(label="name", extra=None, **more):
    return [{"entry_id": i, label: f"Person {i}", **({extra: i} if extra else {}), **{k: v(i) for k, v in more.items()}} for i in range(8)]


def test_renamed_retyped_added_removed(spark):
    got = drift(
        spark,
        (people(seat=lambda i: f"Via {i}"), {"rows": 8, "cols": 5}),
        (people("denomination", seat=lambda i: {"address": f"Via {i}", "p": "XX"}), {"rowsTotal": 8, "columns": 5}),
        (people("denomination", "n", seat=lambda i: {"address": f"Via {i}", "p": "XX"}), {"rowsTotal": "8", "columns": 5}),
        (people("denomination", "n", place=lambda i: f"Via {i}"), {"rowsTotal": "8", "columns": 5}),
    )
    assert got == {
        ("r1", "records_json", "renamed", "denomination"), ("r1", "records_json", "retyped", "seat"), ("r1", "diagnostics_json", "renamed", "rowsTotal"), ("r1", "diagnostics_json", "renamed", "columns"),
        ("r2", "records_json", "added", "n"), ("r2", "diagnostics_json", "retyped", "rowsTotal"),
        ("r3", "records_json", "renamed", "place"), ("r3", "records_json", "retyped", "place"),
    }


def test_unrelated_fields_are_removed_and_added(spark):
    got = drift(spark, (people(phone=lambda i: f"000-{i}"), {}), (people(note=lambda i: f"foglio {i}"), {}))
    assert got == {("r1", "records_json", "removed", "phone"), ("r1", "records_json", "added", "note")}


def test_drift_of_nulls_odd_values_and_broken_files(spark):
    odd = people(v=lambda i: "x" if i else 5)
    got = drift(spark, (people(v=lambda i: "x"), {}), (odd, {}), (people(v=lambda i: None), {}), (None, {}), ("{broken", {}), ([], {}), ([None, 5, {"entry_id": 1, "v": "x" * 100_000}], {}))
    assert got == {("r3", "records_json", "removed", "v"), ("r3", "records_json", "removed", "name"), ("r6", "records_json", "added", "v")}
    assert field_changes(files(spark).limit(0)).count() == 0


def test_a_file_in_two_series_is_compared_in_both(spark):
    one, other = files(spark, (people(), {}), (people("denomination"), {}), series="s"), files(spark, (people(), {}), (people(v=lambda i: i), {"n": 8}), series="t")
    found = field_changes(one.unionByName(other)).drop("former_name").collect()
    assert sorted(map(tuple, found)) == [("r1", "diagnostics_json", "added", "n"), ("r1", "records_json", "added", "v"), ("r1", "records_json", "renamed", "denomination")]
    kinds = [(r["source_series_key"], r["field_name"]) for r in appearing_alternatives(one.unionByName(other)).collect()]
    assert sorted(kinds) == [("s", "denomination"), ("s", "name"), ("t", "n"), ("t", "name"), ("t", "v")]


def test_entries_are_the_same_however_their_number_is_typed(spark):
    typed = lambda label, kind: [{**r, "entry_id": kind(r["entry_id"])} for r in people(label)]
    assert drift(spark, (typed("name", int), {}), (typed("denomination", float), {}), (typed("title", str), {})) == {("r1", "records_json", "renamed", "denomination"), ("r2", "records_json", "renamed", "title")}


def test_numbers_of_any_length(spark):
    got = drift(spark, (people(v=lambda i: 10**400), {"n": 10**400}), (people(w=lambda i: 10**400), {"m": 10**400}), (f'[{{"entry_id": 1, "name": "Person 1", "w": 1{"0" * 5000}}}]', {}))
    assert got == {("r1", "records_json", "renamed", "w"), ("r1", "diagnostics_json", "renamed", "m"), ("r2", "diagnostics_json", "removed", "m")}


def test_unified_records_keep_every_typing(spark):
    table = files(spark, (people(v=lambda i: i), {}), (people(v=lambda i: [str(i)]), {}), ("[1", {}))
    rows = unified_records(table).collect()
    assert len(rows) == 16 and {r["fields"]["v"]["type"] for r in rows} == {"number", "array"}
    by_entry = defaultdict(set)
    for r in rows:
        by_entry[r["entry_id"]].add(r["fields"]["v"]["canonical"])
    assert all(len(v) == 1 for v in by_entry.values())
    kinds = {(r["field_name"], r["type"]) for r in appearing_alternatives(table).collect()}
    assert {("v", "number"), ("v", "array"), ("name", "string")} <= kinds


def test_known_labels_rename_without_equal_values(spark):
    pair = lambda label, shift: people(label, seat=lambda i: f"Via {i + shift}")
    got = drift(spark, (pair("name", 0), {}), (pair("nome", 0), {}), (pair("name", 0), {}), ([{**r, "nome": f"other {r['entry_id']}"} | {} for r in [{k: v for k, v in x.items() if k != "name"} for x in pair("name", 0)]], {}))
    assert got == {("r1", "records_json", "renamed", "nome"), ("r2", "records_json", "renamed", "name"), ("r3", "records_json", "renamed", "nome")}


def test_repeated_snapshots_count_once(spark):
    _, _, s, o = frames(spark)
    once, twice = (snapshot_positions(x, snapshot="snap", group="series", order=[F.col("day")]) for x in (s, s.unionByName(s)))
    assert snapshot_changes(o, once, **args()).exceptAll(snapshot_changes(o, twice, **args())).count() == 0
    trees = [snapshot_tree(x, snapshot="snap", group="series", date=F.col("day"), order=[], rows=F.lit(12)) for x in (s, s.unionByName(s))]
    a, b = ({tuple(r) for r in key_history(o, t, **args()).collect()} for t in trees)
    assert a == b


def test_alternatives_keep_odd_values_and_nested_fields(spark):
    odd = people(v=lambda i: "x" if i else 5, seat=lambda i: {"street": f"Via {i}" if i else None, "lots": [1, "2", {"a.b": True}] if i == 3 else []})
    table = files(spark, (odd, {"counts": {"listed": 8}}), (people(v=lambda i: None, **{"seat.street": lambda i: i}), None), ("[1", {}))
    got = {(r["json_column"], r["field_name"], r["type"]): (r["n_files"], r["n_values"]) for r in appearing_alternatives(table.unionByName(table)).collect()}
    assert got == {
        ("records_json", "name", "string"): (2, 16), ("records_json", "v", "string"): (1, 7), ("records_json", "v", "number"): (1, 1),
        ("records_json", "seat", "object"): (1, 8), ("records_json", "seat.street", "string"): (1, 7), ("records_json", "seat.street", "number"): (1, 8),
        ("records_json", "seat.lots", "array"): (1, 8), ("records_json", "seat.lots.[]", "number"): (1, 1), ("records_json", "seat.lots.[]", "string"): (1, 1),
        ("records_json", "seat.lots.[]", "object"): (1, 1), ("records_json", "seat.lots.[].a.b", "boolean"): (1, 1),
        ("diagnostics_json", "counts", "object"): (1, 1), ("diagnostics_json", "counts.listed", "number"): (1, 1),
    }


def test_history_by_appending_equals_history_of_all(spark):
    r = random.Random(8)
    groups = {g: {k + 10_000 * n: r.randrange(3) for k in range(size)} for n, (g, size) in enumerate((("big", 700), ("small", 5), ("gone", 3)))}
    snapshots, rows_, versions, stored = [], [], spark.createDataFrame([], "k bigint, valid_from date, valid_to date"), spark.createDataFrame([], history.LEAVES_DDL)
    options = {"key": "k", "digest": F.xxhash64("v"), "version": F.col("at"), "tie": F.col("at")}
    for n in range(4):
        when, new = dt.date(2020, 1, 1 + n), []
        for g, state in groups.items():
            if n == 2 and g == "small":
                continue
            for k in r.sample(sorted(state), len(state) // 20 + 1) if n else ():
                state[k] = r.randrange(3)
            if n:
                state.pop(min(state))
                state[max(state) + 1] = 1
            sid = f"{g}{n}"
            snapshots.append((sid, g, when, len(state)))
            new += [(sid, g, k, v, 2) for k, v in state.items()] + [(sid, g, k, v + 7, 1) for k, v in list(state.items())[:2]] + [(sid, g, None, 1, 1)]
        rows_ += new
        frame = spark.createDataFrame(new, "sid string, g string, k bigint, v int, at int")
        dates = frame.select(F.xxhash64("g").alias("_group")).distinct().withColumn("_date", F.lit(when))
        fresh = written(history.newest_leaves(frame, group="g", stored=stored, **options), "fresh")
        versions = written(history.appended_versions(versions, stored, fresh, dates, "k"), "versions")
        stored = written(stored.join(dates, "_group", "left_anti").unionByName(fresh), "stored")
    tree = history.snapshot_tree(spark.createDataFrame(snapshots, "sid string, g string, d date, n int"), snapshot="sid", group="g", date=F.col("d"), order=[], rows=F.col("n"))
    everything = history.key_history(spark.createDataFrame(rows_, "sid string, g string, k bigint, v int, at int"), tree, snapshot="sid", **options)
    assert sorted(map(str, versions.collect())) == sorted(map(str, everything.select("k", "valid_from", "valid_to").collect()))
    assert stored.filter("_depth > 0").count() > 0
