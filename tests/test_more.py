import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tabularium.functions import filters
from tabularium.functions.scalars import canonical_bytes
from tabularium.operators import extract, geo, project, validate
from tabularium.sinks import tables as sink
from tabularium.sources import fetch


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_fetch_states(spark):
    def transport(address, etag, modified):
        name = address.rsplit("/", 1)[1]
        if name == "same":
            return fetch.Answer(304)
        if name == "busy":
            return fetch.Answer(503)
        if name == "broken":
            raise ConnectionError("reset")
        return fetch.Answer(404) if name == "gone" else fetch.Answer(200, b"x" * (50 if name == "large" else 3), "e2", "m2")

    given = spark.createDataFrame([(f"https://h.example/{n}", "e", None) for n in ("same", "busy", "broken", "gone", "large", "new")] + [("http://h.example/new", None, None), ("https://z.example/new", None, None), (None, None, None)], "address string, etag string, modified string")
    got = {r["address"]: (r["state"], r["attempts"]) for r in fetch.fetched(given, transport, frozenset({"h.example"}), attempts=2, most=10, seconds=0).collect()}
    at = lambda n: got[f"https://h.example/{n}"]
    assert [at(n) for n in ("same", "busy", "broken", "gone", "large", "new")] == [("unchanged", 1), ("failed", 2), ("failed", 2), ("failed", 1), ("too_large", 1), ("new", 1)]
    assert got["http://h.example/new"][0] == got["https://z.example/new"][0] == got[None][0] == "refused"


def test_pages_end_and_stored_answers(spark):
    pages = {1: [1, 2], 2: [2, 3], 3: [3]}
    read = lambda n: spark.createDataFrame([(x,) for x in pages[n]], "k int") if n in pages else None
    assert rows(fetch.paged(spark, read, ["k"], 9)) == {(1,), (2,), (3,)}
    assert rows(fetch.paged(spark, read, ["k"], 1)) == {(1,), (2,)} and fetch.paged(spark, lambda n: None, ["k"], 3) is None
    table = spark.createDataFrame([("a", "p")], "key string, payload string")
    assert rows(fetch.answers_from(table, spark.createDataFrame([("a",), ("b",)], "q string"), "q")) == {("a", "p", "answered"), ("b", None, "unanswered")}


def test_filters(spark):
    t = spark.createDataFrame([("Roma", dt.date(2020, 1, 2), "https://x.example/a/Elenco%20iscritti.pdf?v=1"), ("Ostia", None, "https://x.example/modulo%ZZ.pdf")], "name string, day date, url string")
    count = lambda c: t.filter(c).count()
    assert (count(filters.in_period(F.col("day"), None, None)), count(filters.in_period(F.col("day"), "2020-01-02", None)), count(filters.in_period(F.col("day"), None, "2020-01-01"))) == (2, 1, 0)
    assert (count(filters.in_scope({"name": "all"})), count(filters.in_scope({"name": "Roma", "url": None}))) == (2, 1)
    assert [count(filters.mentions(q, [F.col("name"), F.col("day")])) for q in ("ROM", "02/01/2020", "zzz", "")] == [1, 1, 0, 2]
    assert [r[0] for r in t.select(filters.file_name(F.col("url"))).collect()] == ["Elenco iscritti.pdf", None]
    assert [r[0] for r in t.select(filters.names_document(F.col("url"), "elenco|iscritti", "modulo")).collect()] == [True, False]
    assert t.select(filters.flags({"late": F.col("day") > F.lit("2020-01-01"), "r": F.col("name") == "Roma"})).first()[0] == ["late", "r"]


def test_reference_linkage(spark):
    ref = [("M", "VIA ROMA", 1, "1", 45.0, 9.0), ("M", "VIA ROMA", 1, "3", 45.2, 9.2), ("M", "VIA ROMA", 1, "003", 45.2, 9.2), ("M", "Viale Po", 2, "1", 1.0, 1.0), ("M", "VIALE PÓ", 3, "1", 2.0, 2.0), ("M", "CORSO RE", 4, "7/B", 5.0, 5.0), ("M", "CORSO RE", 4, "8", 6.0, 6.0), ("M", "CORSO RE", 4, "8", 7.0, 7.0)]
    reference = spark.createDataFrame(ref, "municipality_code string, street string, street_id int, civic string, latitude double, longitude double")
    addresses = spark.createDataFrame([(1, "M", "Via Roma, 03"), (2, "M", "Via Roma snc"), (3, "M", "viale po 1"), (4, "M", "Via Ignota 1"), (5, "N", "Via Roma 1"), (6, "M", "Corso Ré 7/b"), (7, "M", "Corso Re 8"), (8, "M", None)], "address_id int, municipality_code string, street string")
    got = {r["address_id"]: (r["status"], r["latitude"]) for r in geo.linked_to_reference(addresses, reference).collect()}
    assert got == {1: ("civic", 45.2), 2: ("street_only", 45.2), 3: ("ambiguous_street", None), 4: ("no_street", None), 5: ("no_street", None), 6: ("civic", 5.0), 7: ("ambiguous_civic", None), 8: ("no_street", None)}


def test_best_results_and_country(spark):
    t = spark.createDataFrame([("a", "candidate", "p", 1, 1), ("a", "accepted", "q", 0, 2), ("a", "accepted", "p", 0, 3), ("a", "accepted", "p", 5, 4), ("b", "error", None, None, 5)], "address string, status string, provider string, at int, id int")
    assert rows(geo.best_results(t, "address", {"status": ["accepted", "candidate"], "provider": ["p", "q"]}, "at", "id").select("address", "id")) == {("a", 4), ("b", 5)}
    c = spark.createDataFrame([(" fr ", "unique", None), (None, "unique", "DE"), ("", "none", "DE"), (None, None, None)], "e string, p string, m string")
    assert [r[0] for r in c.select(geo.country(F.col("e"), F.col("p"), F.col("m"))).collect()] == ["FR", "IT", "DE", None]


def test_projection(spark):
    records = spark.createDataFrame([("r", 0, " Rossi  srl", "01234567890 / ABCDEF12G34H567I", "Via Roma", "Scavi • Noli"), ("r", 1, None, None, None, None)], "run string, n int, name string, ids string, seat string, act string")
    out = project.projected(records, "run", "n", "name", "ids", "seat", "act")
    assert {k: v.count() for k, v in out.items()} == {"entities": 1, "identifiers": 2, "offices": 1, "activities": 2, "issues": 1}
    again = project.projected(records.repartition(3), "run", "n", "name", "ids", "seat", "act")
    assert rows(out["identifiers"]) == rows(again["identifiers"])
    assert rows(project.built(records, {"name": ["missing", "name"], "extra": ["none"]})) == {("Rossi srl", ""), ("", "")}
    moved = project.moved(records, {"name": "label"}, ["act", "absent"])
    assert moved.columns == ["run", "n", "label", "ids", "seat", "source_fields"] and moved.first()["source_fields"]["act"] == "Scavi • Noli"
    project.projector("p")(project.projected)
    with pytest.raises(ValueError):
        project.projector("p")(lambda r: {})
    jobs = spark.createDataFrame([("u", 1, "a" * 4), ("u", 2, "b" * 4), ("u", 3, "zz"), ("w", 1, None)], "url string, at int, h string")
    chosen, left = project.selected_jobs(jobs, ["url"], "at", "h", {"hash_shape": F.col("h").rlike("^[a-f]{4}$")})
    assert rows(chosen) == {("u", 2, "bbbb")}
    assert rows(left.select("url", "at", "reason")) == {("u", 1, "superseded"), ("u", 3, "hash_shape"), ("w", 1, "hash_shape")}


def test_more_validation(spark):
    t = spark.createDataFrame([("x", 5, 75.0), ("y", 5, 75.0), ("z", 1, 1.0), ("n", None, None)], "k string, v int, s double")
    assert rows(validate.score_mismatches(t, [], "k", "v", "s").select("k")) == {("z",)}
    stored = spark.createDataFrame([("a", 1, 1, 2), ("b", 0, 0, 1)], "g string, ok int, bad int, total int")
    found = spark.createDataFrame([("a", "ok"), ("a", "bad")], "g string, c string")
    assert rows(validate.unreconciled(found, ["g"], "c", stored, "total")) == {("b", 0, 0, 1)}
    parts = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b")], "k int, v string")
    assert rows(validate.disagreeing_shards(parts, ["k"], ["v"])) == {(2, 2)}
    union, both = validate.composed(parts, spark.createDataFrame([(2, "z"), (3, "z")], "k int, v string"), ["k"])
    assert union.count() == 6 and rows(both) == {(2,)}
    one, two = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (2, "b"), (3, None)], [(1, "a"), (2, "c"), (4, "d")]))
    assert rows(validate.unmatched(one, two, ["k"], ["v"])) == {(2, "different"), (3, "missing"), (4, "unexpected")}
    digest = hashlib.sha256(canonical_bytes({"a": 1, "b": 2})).hexdigest()
    docs = spark.createDataFrame([(1, '{"b":2, "a":1}', digest), (2, '{"a":2}', digest), (3, "{", digest)], "k int, t string, d string")
    assert rows(validate.damaged_documents(docs, "k", "t", "d")) == {(2,), (3,)}
    assert rows(validate.shape_profile(docs, [], "t").filter("n > 1")) == set()


def test_street_keys(spark):
    keys = {"Via Roma": "via|roma", "Piazza Roma": "piazza|roma", "C/da Padula": "contrada|padula", "S.S. 18": "ss|18", "MÜLLERSTRASSE": "unspecified|mullerstrasse", "Frazione São": "frazione|sao", "strada statale 1": "ss|1", "Strada Alta": "strada|alta", "Via": "", "V. Roma": "unspecified|v roma", "ул. Мира": "unspecified|ул мира", "Straße": "unspecified|strasse"}
    got = spark.createDataFrame([(k,) for k in (*keys, None, " ")], "s string").select("s", geo.street_key(F.col("s")).alias("k")).collect()
    assert {r["s"]: r["k"] for r in got} == {**keys, None: "", " ": ""}


def test_monitoring_and_receipts(spark):
    state = spark.createDataFrame([("a", "2020-05-01", False, ["x", "y"]), ("b", None, True, ["x"]), ("c", "2020-01-01", False, None)], "k string, latest string, complete boolean, issues array<string>")
    sources = spark.createDataFrame([("a", "2020-04-01", 3), ("a", None, 4), ("b", "2020-02-02", 1), ("z", "2021-01-01", 9)], "k string, day string, n int")
    assert {tuple(r)[:2] + tuple(r)[4:] for r in project.synchronised(state, sources, ["k"], "day", "n", "latest").collect()} == {("a", "2020-05-01", 2, 7), ("b", "2020-02-02", 1, 1), ("c", "2020-01-01", 0, 0)}
    report = spark.createDataFrame([("a", True), ("a", True), ("b", None)], "k string, complete boolean")
    got = {r["k"]: (r["complete"], r["issues"]) for r in project.reconciled(state, report, ["k"], "complete", "issues", "x").collect()}
    assert got == {"a": (True, ["y"]), "b": (False, ["x"]), "c": (False, None)}
    shown = project.receipt(state.withColumn("secret", F.lit("s")), ["k", "absent"], {"done": F.col("complete"), "stored": F.col("latest") > "2020-04"})
    assert shown.columns == ["k", "absent", "done", "stored"] and rows(shown) == {("a", None, False, True), ("b", None, True, False), ("c", None, False, False)}
    captures = spark.createDataFrame([("a", 1, "d", "q1"), ("a", 2, "e", "q3"), ("a", 2, "e", "q2"), ("b", 1, "d", "q"), ("b", 1, "f", "r")], "k string, at int, digest string, id string")
    assert rows(project.newest_frozen(captures, ["k"], "at", ["digest"], "id")) == {("a", "q2", "selected"), ("b", None, "ambiguous")}
    revisions = spark.createDataFrame([(1, '{"rows":[{"k":"a","v":1},{"k":"b","v":1}]}'), (2, "{"), (3, '{"rows":[{"k":"a","v":2},{"k":"c"}]}')], "n int, state string")
    assert {(r["n"], r["k"], r["change"]) for r in project.state_history(revisions, "n", "state", "rows", "k").collect()} == {(1, "a", "added"), (1, "b", "added"), (3, "a", "changed"), (3, "b", "removed"), (3, "c", "added")}


def test_objects_and_bundles(spark, tmp_path):
    files = spark.createDataFrame([(bytearray(b"one"),), (bytearray(b"two"),), (bytearray(b"one"),), (None,)], "content binary")
    store = str(tmp_path / "store")
    assert [r["created"] for r in sink.archived_objects(files, store).collect()] == [True, True]
    again = sink.archived_objects(files.union(spark.createDataFrame([(bytearray(b"three"),)], "content binary")), store).collect()
    assert sorted((r["byte_size"], r["created"], r["verified"]) for r in again) == [(3, False, True), (3, False, True), (5, True, True)]
    assert spark.read.parquet(store).count() == 3
    bundle = str(tmp_path / "bundle")
    table = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert sink.exported_bundle({"t": table, "empty": table.limit(0)}, bundle).count() == 2
    back = sink.restored_bundle(spark, bundle)
    assert rows(back["t"]) == {(1, "x"), (2, None)} and back["empty"].count() == 0
    table.limit(1).write.mode("overwrite").parquet(f"{bundle}/t")
    with pytest.raises(ValueError, match="t is not"):
        sink.restored_bundle(spark, bundle)


def test_sectors_of_one_list(spark):
    t = spark.createDataFrame([("a", "1/1/2020", 1, "s1"), ("a", "01/01/2020", 2, "s2"), ("a", "soon", 3, "s3"), ("a", None, 4, "s1")], "k string, raw string, n int, sector string")
    got = extract.reconstructed(t, ["k"], F.try_to_date("raw", "d/M/yyyy"), F.col("raw"), "n", "sector").collect()
    assert {(r["date_key"], tuple(r["items"])) for r in got} == {("2020-01-01", ("s1", "s2")), ("RAW:soon", ("s3",)), ("RAW:", ("s1",))}
