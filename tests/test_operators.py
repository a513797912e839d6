import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabularium.operators import editions as E
from tabularium.operators import extract, ordering, resolve, sampling, supersede, validate
from tabularium.operators import metrics as M
from tabularium.operators import relations as R
from tabularium.operators.components import components


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 80)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    expected = {(x, find(x)) for x in root}
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").select("node", "root").collect()
    assert {tuple(g) for g in got} == expected and len(got) == len(expected)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_prefix_join_takes_the_longest_and_reports_ambiguity(spark):
    texts = spark.createDataFrame([(1, "Monte San Pietro, via x"), (2, "Monte 3"), (3, "Ro ma"), (4, None), (5, "Ada")], "id int, text string")
    places = spark.createDataFrame([("Monte", "M"), ("Monte San Pietro", "P"), ("Ada", "1"), ("Ada", "2"), ("", "e")], "name string, code string")
    got = {r["id"]: (r["code"], r["prefix_status"], r["rest"]) for r in R.longest_prefix(texts, "text", places, "name", "code").collect()}
    assert got == {1: ("P", "unique", "via x"), 2: ("M", "unique", "3"), 3: (None, "none", None), 4: (None, "none", None), 5: (None, "ambiguous", "")}


def test_routes_aliases_and_bundles(spark):
    rules = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 1, "z")], "k string, p int, target string")
    got = {r["k"]: (r["target"], r["route_status"]) for r in R.routed(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), rules, ["k"], "p", "target").collect()}
    assert got == {"a": ("y", "bound"), "b": (None, "ambiguous"), "c": (None, "unbound")}
    assert rows(R.aliased(spark.createDataFrame([("a",), (None,)], "k string"), "k", spark.createDataFrame([("a", "A")], "f string, t string"), "f", "t")) == {("A",), (None,)}
    members = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "y"), (3, "y")], "b int, label string")
    assert rows(R.witnessed_bundles(members, ["b"], "label", ["x", "y"]).select("b")) == {(1,)}


def test_period_join_conflicts_and_complete_combination(spark):
    periods = spark.createDataFrame([("a", day(0), day(5), "p"), ("a", day(5), None, "q"), ("b", None, None, "r")], "k string, f date, t date, name string")
    facts = spark.createDataFrame([("a", day(4)), ("a", day(5)), ("b", day(1)), ("c", day(1)), ("a", None)], "k string, at date")
    assert rows(R.join_in_period(facts, periods, ["k"], "at", "f", "t").select("at", "name")) == {(day(4), "p"), (day(5), "q"), (day(1), "r")}
    versions = spark.createDataFrame([("a", 1, day(0), day(5)), ("a", 2, day(4), None), ("a", 3, day(9), day(9)), ("b", 4, None, None)], "k string, id int, f date, t date")
    assert rows(R.period_conflicts(versions, ["k"], "id", [("f", "t")])) == {("a", 1, 2)}
    parts = [spark.createDataFrame(x, "k string, n int, v int") for x in ([("a", 3, 1), ("b", 2, 1), ("c", 1, None)], [("a", 3, 2), ("b", 9, 1), ("c", 1, 4)])]
    assert rows(R.complete_only(parts, "k", "n", "v")) == {("a", 3, 3, True), ("c", 1, 4, False)}
    with_dup = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert rows(R.set_difference(with_dup, spark.createDataFrame([(1,), (3,)], "x int"))) == {(1, "left"), (2, "left"), (3, "right")}


def test_latest_and_top_one_with_ties_and_nulls(spark):
    t = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 2, 0), (None, 1, 5)], "k string, at int, id int")
    assert rows(R.latest(t, ["k"], ["at", "id"])) == rows(R.top_one(t, ["k"], [F.desc("at"), F.desc("id")])) == {("a", 2, 1), (None, 1, 5)}


def test_quantiles_histogram_bounds_ranks(spark):
    t = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)] + [("b", None)], "g string, v double")
    assert rows(M.quantile_summary(t, ["g"], F.col("v"), [2])) == {("a", 4, 1.75, 2.5, 3.25, 3.7, 2), ("b", 0, None, None, None, None, 0)}
    assert rows(M.histogram(t, ["g"], F.col("v"), [2, 4])) == {("a", 4, 1, 2, 1, 0), ("b", 1, 0, 0, 0, 1)}
    assert rows(M.share_bounds(t, ["g"], F.col("v") > 3)) == {("a", 4, 1, 0, 0.25, 0.25), ("b", 1, 0, 1, 0.0, 1.0)}
    ties = spark.createDataFrame([("x", 5), ("y", 5), ("z", 1), ("n", None)], "k string, v int")
    assert rows(M.competition_rank(ties, [], "v").select("k", "rank")) == {("x", 1), ("y", 1), ("z", 3), ("n", None)}
    assert rows(M.midrank_score(ties, [], "v").select("k", "score")) == {("x", 75.0), ("y", 75.0), ("z", 0.0), ("n", None)}
    one = spark.createDataFrame([("x", 5)], "k string, v int")
    assert rows(M.midrank_score(one, [], "v").select("score")) == {(None,)}


def test_weighted_times_roll_up_and_review(spark):
    t = spark.createDataFrame([("a", 8, 1), ("a", 10, 9), ("b", None, 1), ("b", 3, 1)], "g string, h int, w int")
    assert rows(M.weighted_times(t, ["g"], "h", "w")) == {("a", 10, 9.8, 10, 10), ("b", 2, None, None, None)}
    assert rows(M.rolled_up(t.withColumnRenamed("h", "at"), ["g"], "w", "at")) == {("a", 10, 10, True), ("b", 2, None, False)}
    review = spark.createDataFrame([("s", "ok", 2.0), ("s", "bad", 1.0), ("s", "?", 9.0)], "st string, v string, w double")
    assert rows(M.weighted_review(review, "st", "v", "w", ["ok"], ["bad"])) == {("s", 3, 1, 2, 0.666667), ("(all)", 3, 1, 2, 0.666667)}
    assert M.content_fingerprint(t, []).first() == M.content_fingerprint(t.orderBy(F.desc("w")), []).first()


def test_bins_cohorts_lags_and_coverage(spark):
    t = spark.createDataFrame([(1, 1, "pending"), (1, 2, "listed"), (2, 1, "pending"), (3, 2, "pending"), (4, 2, "listed")], "k int, e int, s string")
    assert rows(M.first_seen_cohorts(t, "k", "e", "s", "pending", "listed")) == {(1, 2, 0, 1, 0, 1, 1), (2, 1, 1, 0, 0, 0, 0)}
    dated = t.withColumn("at", F.date_add(F.lit(day(0)), F.col("e") * 10))
    assert rows(M.linked_lags(dated, "k", "at", "s", "pending", "listed")) == {(1, None, 10)}
    bins = M.calendar_bins(dated, "at", "month", "2019-12-01", "2020-02-01").collect()
    assert [r["n"] for r in sorted(bins)] == [0, 5, 0]
    series = spark.createDataFrame([("a", "listed"), ("b", "both")], "auth string, kind string")
    targets = spark.createDataFrame([("a",), ("b",), ("c",)], "auth string")
    assert rows(M.coverage_matrix(series, targets, ["listed", "applicant"], "kind", "both")) == {("a", True, False), ("b", True, True), ("c", False, False)}


def test_edition_diff_counts_last_of_duplicates(spark):
    ddl = "k string, o int, st string, c string"
    before = spark.createDataFrame([("a", 1, "p", "x"), ("a", 2, "l", "x"), ("b", 3, "l", "x"), (None, 4, "l", "x")], ddl)
    after = spark.createDataFrame([("a", 1, "l", "y"), ("c", 2, "p", "x"), (None, 3, "p", "x")], ddl)
    assert rows(E.edition_diff(before, after, ["k"], "o", "st", ["c"])) == {("a", "content_changed", None), ("b", "disappeared", None), ("c", "added", None), (None, "status_changed", "l->p")}


def test_guarded_diff_counts_only_what_is_certain(spark):
    ddl = "b string, n string, s string"
    clean = E.guarded_diff(spark.createDataFrame([("1", "A", "p"), ("2", "B", "p")], ddl), spark.createDataFrame([("1", "A", "l"), ("3", "C", "p")], ddl), "b", "n", "s").first()
    assert tuple(clean) == (1, 1, 1, 1, 0, 0)
    loose = E.guarded_diff(spark.createDataFrame([("1|2", "A", "p"), ("5", "B", "p"), ("6", "X", "p")], ddl), spark.createDataFrame([("1", "A", "l"), ("5", "Z", "p"), (None, "Q", "p"), ("6", "X", "p")], ddl), "b", "n", "s").first()
    assert tuple(loose) == (None, None, 1, 0, 2, 3)


def test_events_as_of_and_comparable(spark):
    ddl = "scope string, day date, id string, doc string, parser string, fp string, total int, checked timestamp"
    t = spark.createDataFrame(
        [("s", day(0), "1", "d1", "p", "f1", 5, None), ("s", day(1), "2", "d2", "p", "f1", 5, None), ("s", day(2), "3", "d2", "q", "f1", 6, None), ("s", day(3), "4", "d3", "q", "f2", 6, None), ("s", day(4), "5", "d4", "q", None, 6, None), ("s", day(4), "6", "d5", "q", None, 6, None), ("s", day(5), "7", "d6", "q", None, 7, None), ("s", None, "8", "d7", "q", None, 7, None)], ddl
    )
    events = {r["id"]: r["event"] for r in E.edition_events(t, "scope", "day", "id", "doc", "parser", "fp", "total").collect()}
    assert events == {"1": "baseline", "2": "file_only", "3": "parser_revision", "4": "data_changed", "5": "unordered", "6": "unordered", "7": "baseline", "8": "undated"}
    state = lambda n: tuple(E.as_of(t, "scope", "day", "id", F.lit(day(n))).first())[1:3]
    assert (state(2), state(4), state(-1)) == (("selected", "3"), ("ambiguous", None), ("missing", None))
    assert tuple(E.latest_comparable(t, "scope", "day", "id", "doc", "parser").first()) == ("s", "7", "4")


def test_transitions_between_consecutive_editions(spark):
    t = spark.createDataFrame([(1, "a", "p"), (1, "b", "p"), (2, "a", "l"), (3, "b", "p")], "e int, k string, s string")
    assert rows(E.consecutive_transitions(t, "e", "k", "s")) == {(2, "p", "l", 1), (2, "p", "(absent)", 1), (3, "l", "(absent)", 1), (3, "(absent)", "p", 1)}


def test_allocation_and_sample(spark):
    def plan(sizes, target, **options):
        strata = spark.createDataFrame(list(sizes.items()), "s string, n bigint")
        return {r["s"]: r["stratum_sample"] for r in sampling.allocated(strata, "s", "n", target, **options).collect()}

    assert plan({"a": 100, "b": 10, "c": 1}, 21) == {"a": 14, "b": 6, "c": 1}
    assert plan({"a": 9, "b": 8, "z": 0}, 1) == {"a": 0, "b": 1, "z": 0}
    assert plan({"a": 9, "b": 8}, 1, largest_first=True) == {"a": 1, "b": 0}
    assert plan({"a": 2}, 50) == {"a": 2}
    assert plan({"a": 1000, "b": 6, "c": 6, "d": 6}, 300) == {"a": 282, "b": 6, "c": 6, "d": 6}
    assert sum(plan({k: 7 + ord(k) for k in "abcdefgh"}, 101).values()) == 101 and plan({}, 5) == {}
    t = spark.createDataFrame([("a" if i % 3 else "b", i) for i in range(90)] + [(None, 99)], "s string, id int")
    first, second = (rows(sampling.stratified_sample(x, "s", ["id"], 20)) for x in (t, t.repartition(7)))
    assert first == second and len(first) == 20
    assert abs(sum({(r[0], r[2]): r[2] for r in first}.values()) - 90) == 0
    assert [r["id"] for r in sampling.page(t.filter("s = 'a'"), [F.asc("id")], 2, 3).collect()] == [5, 7, 8]
    assert [(r["id"], r["denominator"]) for r in sampling.batch(t, ["id"], 3, 2).collect()] == [(3, 91), (4, 91)]


def test_resolution_links_only_unambiguous_identifiers(spark):
    t = spark.createDataFrame([(1, "A", "x"), (2, "A", "x"), (3, "B", "y"), (4, "C", "y"), (5, "A", "z"), (2, "A", "z"), (6, "A", None), (7, None, "q")], "id bigint, name string, ident string")
    assert rows(resolve.resolved(t, "id", "name", "ident")) == {(1, 1), (2, 1), (5, 1), (3, None), (4, None), (6, None), (7, None)}
    chain = spark.createDataFrame([(n, "A", f"v{v}") for n in range(1, 30) for v in (n, n + 1)] + [(90, "A", "w")], "id bigint, name string, ident string")
    assert rows(resolve.resolved(chain, "id", "name", "ident", F.col("ident") != "w")) == {(n, 1) for n in range(1, 30)} | {(90, None)}
    assert rows(resolve.ambiguous_values(t, "name", "ident")) == {("y",)}


def test_supersession_is_idempotent(spark):
    now, later = (F.lit(day(n)) for n in (1, 2))
    current = spark.createDataFrame([("a", 1, day(0), None), ("b", 1, day(0), None), ("c", 1, day(0), None), ("d", 1, day(-9), day(-1))], "k string, v int, valid_from date, valid_to date")
    desired = spark.createDataFrame([("a", 1), ("b", 2), ("e", None)], "k string, v int")
    once = supersede.superseded(current, desired, ["k"], ["v"], now)
    assert rows(once) == {("a", 1, day(0), None), ("b", 1, day(0), day(1)), ("b", 2, day(1), None), ("c", 1, day(0), day(1)), ("d", 1, day(-9), day(-1)), ("e", None, day(1), None)}
    assert rows(supersede.superseded(once, desired, ["k"], ["v"], later)) == rows(once)


def test_expiry_keeps_what_is_still_asked_for(spark):
    routes = spark.createDataFrame([("a", "always"), ("b", "second"), ("c", "second"), ("d", "none"), ("e", "second")], "k string, route string")
    results = spark.createDataFrame([("b", "failed"), ("c", "failed"), ("c", "good")], "k string, status string")
    wanted = supersede.unserved(routes, F.col("route") == "always", F.col("route") == "second", results, ["k"], F.col("status") == "failed", F.col("status") == "good")
    assert rows(wanted) == {("a",), ("b",)}
    current = spark.createDataFrame([(k, stage, None) for k in "abcde" for stage in ("second",)] + [("d", "first", None), ("e", "second", day(0)), (None, "second", None)], "k string, stage string, valid_to date")
    got = rows(supersede.expired(current, wanted, ["k"], F.lit(day(5)), F.col("stage") == "second"))
    assert got == {("a", "second", None), ("b", "second", None), ("c", "second", day(5)), ("d", "second", day(5)), ("e", "second", day(5)), ("d", "first", None), ("e", "second", day(0)), (None, "second", day(5))}


def test_range_joins_equal_brute_force(spark):
    r = random.Random(2)
    when = lambda: None if r.random() < 0.15 else day(r.randrange(400))
    periods = [(n, r.choice("aab"), when(), when(), when(), when()) for n in range(120)]
    facts = [(n, r.choice("abc"), when()) for n in range(150)]
    p = spark.createDataFrame(periods, "id int, k string, f date, t date, g date, u date")
    inside = lambda a, f, t: a is not None and (f is None or f <= a) and (t is None or a < t)
    got = R.join_in_period(spark.createDataFrame(facts, "n int, k string, at date"), p, ["k"], "at", "f", "t").select("n", "id").collect()
    assert sorted(map(tuple, got)) == sorted((n, q[0]) for n, k, a in facts for q in periods if q[1] == k and inside(a, q[2], q[3]))
    full = lambda s, e: s is None or e is None or s < e
    over = lambda a, b, c, d: (a is None or d is None or a < d) and (c is None or b is None or c < b) and full(a, b) and full(c, d)
    for spans in ([("f", "t")], [("f", "t"), ("g", "u")]):
        expected = {(x[1], x[0], y[0]) for x in periods for y in periods if x[1] == y[1] and x[0] < y[0] and all(over(*x[2 + 2 * i : 4 + 2 * i], *y[2 + 2 * i : 4 + 2 * i]) for i in range(len(spans)))}
        found = R.period_conflicts(p, ["k"], "id", spans).collect()
        assert sorted(map(tuple, found)) == sorted(expected)
    assert R.period_conflicts(p.limit(0), ["k"], "id", [("f", "t")]).count() == 0


def test_numbers_and_totals_over_ranges(spark):
    t = spark.range(0, 1000, 1, 7).select("id", F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id") % 5).alias("v"))
    assert sorted((r["id"], r["n"]) for r in ordering.numbered(t, [F.desc("id")], "n").collect()) == [(i, 999 - i) for i in range(1000)]
    total, expected = 0, {}
    for i in range(1000):
        expected[i] = total
        total += 0 if i % 9 == 0 else i % 5
    assert {r["id"]: r["s"] for r in ordering.running_total(t, ["id"], F.col("v"), "s").collect()} == expected
    assert ordering.numbered(t.limit(0), ["id"], "n").count() == 0
    assert rows(R.pairwise_overlap(spark.createDataFrame([("s", "a", 1), ("s", "b", 1), ("s", "c", 1), ("s", "a", 2), ("s", "b", 2), ("s", "b", 2), ("s", None, 2), (None, "x", 1), (None, "y", 1)], "scope string, src string, k int"), ["scope"], "src", "k")) == {("s", "a", "b", 2), ("s", "a", "c", 1), ("s", "b", "c", 1), (None, "x", "y", 1)}


def test_checks_fold_and_edges(spark):
    t = spark.createDataFrame([("u", 1, "h", None), ("u", 2, None, "e"), ("u", 3, "h", None), ("u", 4, "g", None), ("u", 5, None, "e"), ("w", 1, None, "e")], "k string, at int, d string, err string")
    got = {r["k"]: (r["last_attempt"], r["attempts"], r["last_success"], r["last_change"], r["d"], r["failures_since"]) for r in supersede.folded_checks(t, "k", "at", "d", "err").collect()}
    assert got == {"u": (5, 5, 4, 4, "g", 1), "w": (1, 1, None, None, None, 1)}
    assert rows(supersede.edge_transitions(t.filter("err is null"), "k", "at", "d")) == {("u", 1, None, "h"), ("u", 4, "h", "g")}


def test_validation(spark):
    contract = StructType.fromDDL("a int, s struct<x:string>, l array<struct<y:int>>")
    good = spark.createDataFrame([(1, ("q",))], "a int, s struct<x:string>")
    assert validate.closed(good, contract).first()["l"] is None
    with pytest.raises(ValueError, match="s.z"):
        validate.closed(spark.createDataFrame([(1, ("q", 2))], "a int, s struct<x:string,z:int>"), contract)
    t = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    assert rows(validate.broken_rules(t, "id", {"positive": F.col("v") > 0, "small": F.col("v") < 5})) == {(3, "positive"), (1, "small")}
    assert rows(validate.orphans(t, spark.createDataFrame([(5,)], "p int"), {"v": "p"})) == {(3, -1)}
    assert rows(validate.mutated(t, spark.createDataFrame([(1, 6), (2, None)], "id int, v int"), ["id"], ["v"])) == {(1, "changed"), (3, "removed")}
    states = [spark.createDataFrame([(1, s)], "id int, level string") for s in ("durable", "local")]
    assert validate.downgraded(*states, ["id"], "level", ["local", "durable"]).count() == 1
    expected = spark.createDataFrame([(1, 1), (9, 2)], "id int, n int")
    assert rows(validate.denominators(t, ["id"], expected, "n")) == {(2, None, 1), (3, None, 1), (9, 2, 0)}
    with pytest.raises(ValueError):
        validate.require_none(t, "rows")


def test_lines_bands_and_segments(spark):
    words = spark.createDataFrame([("d", 1, 10.0, 100.0, 20.0, 104.0, "B"), ("d", 1, 0.0, 101.0, 5.0, 105.0, "A"), ("d", 1, 60.0, 103.0, 70.0, 107.0, "C"), ("d", 1, 0.0, 120.0, 5.0, 124.0, "D")], extract.WORDS_DDL)
    lines = extract.clustered_lines(words)
    assert {r["text"]: r["line"] for r in lines.collect()} == {"A": 0, "B": 0, "C": 0, "D": 1}
    texts = extract.band_texts(extract.banded(lines, [("left", 0, 30), ("right", 30, 100)]), ["doc", "page", "line"], ["left", "right"])
    assert rows(texts) == {("d", 1, 0, "A B", "C"), ("d", 1, 1, "D", "")}
    t = spark.createDataFrame([("d", 0, "head"), ("d", 1, "1) x"), ("d", 2, "more"), ("d", 3, None), ("d", 4, "2) y")], "doc string, n int, text string")
    stitched = extract.stitched(t, ["doc"], ["n"], F.col("text").rlike(r"^\d\)"), ["text"])
    assert rows(stitched) == {("d", 1, "1) x more", 3), ("d", 2, "2) y", 1)}
    collapsed = extract.collapsed(spark.createDataFrame([("a", 2, "y", "p"), ("a", 1, "x", "p"), ("a", 3, "y", "q")], "k string, n int, item string, st string"), ["k"], "n", "item", ["st"])
    assert [tuple(r) for r in collapsed.collect()] == [("a", ["x", "y"], 3, ["p", "q"], True)]
    cells = spark.createDataFrame([(1, 0.0, 0.0, 9.0, 9.0, "big"), (1, 0.0, 0.0, 2.0, 2.0, "small")], "page int, left double, top double, right double, bottom double, text string")
    points = spark.createDataFrame([(1, 1.0, 1.0), (1, 50.0, 1.0)], "page int, x double, y double")
    assert rows(extract.within_cells(points, cells, ["page"])) == {(1, 1.0, 1.0, "big"), (1, 50.0, 1.0, None)}
    filled, wrong = extract.stamped(spark.createDataFrame([(" ",), ("p",), ("q",)], "parser string"), "parser", "p")
    assert rows(filled) == {("p",), ("q",)} and rows(wrong) == {("q",)}


def test_longest_prefix_of_many_words(spark):
    words = "san giovanni di sopra al monte del lago vecchio"
    aliases = spark.createDataFrame([("San Giovanni", "A"), (words, "B"), (None, "C")], "alias string, code string")
    rows = spark.createDataFrame([(1, f"{words.upper()}, via Roma 5"), (2, "San Giovanni di sopra, via Roma 5"), (3, "Via Roma"), (4, None)], "id int, text string")
    got = {r["id"]: (r["code"], r["prefix_status"], r["rest"]) for r in R.longest_prefix(rows, "text", aliases, "alias", "code").collect()}
    assert got == {1: ("B", "unique", "via roma 5"), 2: ("A", "unique", "di sopra via roma 5"), 3: (None, "none", None), 4: (None, "none", None)}
    assert {r["prefix_status"] for r in R.longest_prefix(rows, "text", aliases.limit(0), "alias", "code").collect()} == {"none"}


def _spread_over_time(n: int) -> list[tuple]:
    """Short series with open periods, and one series of many periods, some open."""
    few = [(i, f"s{i % (n // 5)}", day(i % 300), None) for i in range(n)]
    return few + [(n + i, "hot", None if i % 50 == 0 else day(3 * i), None if i % 40 == 0 else day(3 * i + 7)) for i in range(n)]


def test_periods_of_short_series_are_not_multiplied(spark):
    facts = spark.createDataFrame([(i, k, day(i)) for i in range(900) for k in ("hot", f"s{i % 9}")], "n int, k string, at date")
    periods = spark.createDataFrame(_spread_over_time(300), "id int, k string, f date, t date")
    joined = R.join_in_period(facts, periods, ["k"], "at", "f", "t")
    assert joined.count() == facts.join(periods, "k").filter("(f is null or f <= at) and (t is null or at < t)").count() > 0
    spread = periods.join(R._cut(periods, ["k"], "f", "t"), "k", "left").select("k", F.explode(R._covered(F.col("f"), F.col("t"))))
    assert spread.filter("k <> 'hot'").count() == 300 and spread.filter("k = 'hot'").count() < 300 * 3
    assert "SortMergeJoin" in _joined_by(joined, "_p_part") and "Broadcast" not in _joined_by(joined, "_p_part")


def test_conflicts_of_long_and_short_series(spark):
    full = lambda s, e: s is None or e is None or s < e
    over = lambda x, y: (x[2] is None or y[3] is None or x[2] < y[3]) and (y[2] is None or x[3] is None or y[2] < x[3]) and full(*x[2:]) and full(*y[2:])
    periods = _spread_over_time(250) + [(7, "hot", day(30), day(40)), (7, "hot", day(30), day(60)), (999, "hot", None, None), (998, "hot", day(9), day(9)), (None, "hot", None, None)]
    found = R.period_conflicts(spark.createDataFrame(periods, "id int, k string, f date, t date"), ["k"], "id", [("f", "t")])
    named = [x for x in periods if x[0] is not None]
    assert sorted(map(tuple, found.collect())) == sorted((x[1], x[0], y[0]) for x in named for y in named if x[1] == y[1] and x[0] < y[0] and over(x, y))
    assert "SortMergeJoin" in _joined_by(found, "_part") and "Broadcast" not in _joined_by(found, "_part")


def _joined_by(frame, column: str) -> str:
    """The operators of the plan that is first made that join by a column."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return "\n".join(x for x in plan.splitlines() if "Join" in x and column in x)
