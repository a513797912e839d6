import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.llm.address_parts import parse_address, parse_review
from tabularium.llm.addresses import address_parts, locations, pairs_of, same_location
from tabularium.llm.neighbourhood import neighbour_pairs

SAME = [
    ("Via Teresa Braltido, nr. 1/B pal. C/8 Torredorsale (ZM)", "VIA BRALTIDO TERESA 1 B – 99085 TORREDORSALE, ZM"),
    ("99118 MONTECALVESA - XF, V. T. Braltido N.1-b", "Montecalvesa: Via Braltido 1b"),
    ("Via XXI Novembre, 4 – Ripasorbina Superiore", "RIPASORBINA SUPERIORE, VIA VENTUNO NOVEMBRE N° 4"),
    ("S.P. 135 km 10,000 in Fontegrifana", "FONTEGRIFANA - QE, Strada Provinciale N. 135 KM 10.0"),
    ("LOCALITA' Colle Subola, snc – Acqualumbra", "Acqualumbra, Loc.tà Colle Subola s.n."),
    ("c/o Studio Contabile - Via Anna Stalero 3 scala A int. 9 Castelgrifana al Colle", "C.grifana al Colle, V. A. Stalero, 3 piano 4"),
    ("presso capannone 3, VLE MICHELE DOSCELLA, CIV. 27 IN BORGOPERLONA, WS", "B.go perlona - Viale Michele Doscella 27"),
    ("Via Piano Vorbara 7, Vallecalvesa in Piano", "vallecalvesa in piano, via piano vobrara n. 7"),
]
OTHER = [
    ("Via Roma 1, Montecalvesa", "Via Roma 1b, Montecalvesa"), ("Via Roma 1, Montecalvesa", "Via Roma 2, Montecalvesa"), ("Via Roma 1, Montecalvesa", "Piazza Roma 1, Montecalvesa"),
    ("Via Roma 1, Fontescagna (QE)", "Via Roma 1, Montescagna (ZZ)"), ("Via Anna Stalero 1, Montecalvesa", "Via Teresa Stalero 1, Montecalvesa"), ("Via Roma, Montecalvesa", "Via Roma 1, Montecalvesa"),
    ("S.P. 1 km 10,000 Montecalvesa", "S.P. 2 km 10,000 Montecalvesa"), ("Via 5 Agosto 1, Montecalvesa", "Via 6 Agosto 1, Montecalvesa"), ("Via Roma 1, Montecalvesa Marina", "Via Roma 1, Montecalvesa Vecchia"),
]


@pytest.mark.parametrize("a, b", SAME)
def test_one_location(a, b):
    assert same_location(parse_address(a), parse_address(b)), (parse_address(a), parse_address(b))


@pytest.mark.parametrize("a, b", OTHER)
def test_different_locations(a, b):
    assert not same_location(parse_address(a), parse_address(b)), (parse_address(a), parse_address(b))


def test_odd_addresses():
    for text in (None, "", " ", ",", "Via", "12", "x" * 100_000, "Via " * 5_000, "(((", "km", "Via 12 12 12"):
        assert all(isinstance(p, str) for p in parse_address(text))
    assert parse_review("Torredorsale", "Via T. Braltido", "1/B")[:4] == parse_address("Via T. Braltido 1 b, Torredorsale")[:4]
    assert parse_review(None, None, "1").kind == ""


def brute_windows(rows, n_keys, window):
    """Pairs by every pass on its own: rows are (id, strict, [keys of each pass], value)."""
    found = set()
    for number in range(n_keys):
        order = sorted((strict, key, id_, value) for id_, strict, keys, value in rows for key in keys[number] or ())
        found |= {(min(a[2], b[2]), max(a[2], b[2])) for n, a in enumerate(order) for b in order[n + 1 : n + window] if a[0] == b[0] and a[3] == b[3] and a[2] != b[2]}
    return found


@pytest.mark.parametrize("stretch, block", [(7, 2), (7, 64), (40, 3), (10_000, 64)])
@pytest.mark.parametrize("n_keys", [1, 4])
def test_windows_are_whole_wherever_partitions_are_cut(spark, monkeypatch, stretch, block, n_keys):
    monkeypatch.setattr("tabularium.llm.neighbourhood.ENDS_PARTITIONS", block)
    r = random.Random(n_keys)
    word = lambda: r.choice(["hot", "hot", f"k{r.randrange(60)}"])
    rows = [(i, r.choice("ab"), [[word() for _ in range(r.randrange(1, 7))] if r.random() > 0.05 else None for _ in range(n_keys)], r.randrange(4)) for i in range(300)]
    names = [f"key{n}" for n in range(n_keys)]
    df = spark.createDataFrame([(i, s, *k, v) for i, s, k, v in rows], "id bigint, strict string, " + "".join(f"{n} array<string>, " for n in names) + "v int")
    alike = lambda table, i, j: np.equal(table.column("v").to_numpy()[i], table.column("v").to_numpy()[j])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    got = neighbour_pairs(df, id_="id", strict="strict", keys=names, payload=["v"], window=5, alike=alike, stretch_rows=stretch).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((g["a"], g["b"]) for g in got) == sorted(brute_windows(rows, n_keys, 5))
    assert neighbour_pairs(df.limit(0), id_="id", strict="strict", keys=names, payload=["v"], window=5, alike=alike).count() == 0


def test_passes_find_what_all_pairs_find(spark):
    r = random.Random(3)
    towns, streets = ["Torredorsale", "Montecalvesa", "Fontegrifana", "Borgoperlona"], ["Teresa Braltido", "Michele Doscella", "Anna Stalero Maria Grazia Lunga", "XXI Novembre"]
    parts = {parse_address(f"{r.choice(['Via', 'V.le'])} {typed(r.choice(streets), r)} {r.randrange(1, 4)}, {typed(r.choice(towns), r)}") for _ in range(400)}
    rows = [(n, *p) for n, p in enumerate(sorted(parts))]
    df = spark.createDataFrame(rows, "record bigint, municipality string, kind string, street string, civic string, postcode string, province string")
    found = {tuple(p) for p in pairs_of(locations(df), "record", "location", "a", "b").collect()}
    accepted = {(a[0], b[0]) for n, a in enumerate(rows) for b in rows[n + 1 :] if same_location(a[1:], b[1:])}
    assert len(accepted & found) >= 0.97 * len(accepted) > 100


def typed(text, r):
    """``text`` with words turned around or two letters swapped now and then."""
    words = text.split()
    if r.random() < 0.3:
        words = words[::-1]
    if r.random() < 0.3:
        at = r.randrange(1, len(words[0]) - 2) if len(words[0]) > 4 else 0
        words[0] = words[0][:at] + words[0][at + 1] + words[0][at] + words[0][at + 2 :] if at else words[0]
    return " ".join(words)


def test_addresses_without_a_known_street_type(spark):
    texts = ["Torredorsale, Galleria dei Fiori 7", "GALLERIA DEI FIORI, 7 - TORREDORSALE", "Torredorsale, Galleria dei Fiori 8", "Torredorsale, Galleria dei Fiorai 7"]
    found = locations(address_parts(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"), "id", "text"))
    assert [tuple(p) for p in pairs_of(found, "record", "location", "a", "b").collect()] == [(0, 1)]


def test_locations_of_records(spark):
    texts = [t for pair in SAME for t in pair] + [None, "", "Via Roma 1, Altrove", "Via Roma 1, Altrove"]
    df = spark.createDataFrame([(n, t, "clash") for n, t in enumerate(texts)] + [(0, texts[0], "clash")], "id bigint, text string, record string")
    found = locations(address_parts(df, "id", "text"))
    pairs = {tuple(p) for p in pairs_of(found, "record", "location", "a", "b").collect()}
    assert pairs == {(2 * n, 2 * n + 1) for n in range(len(SAME))} | {(len(texts) - 2, len(texts) - 1)}
    assert locations(address_parts(df.limit(0), "id", "text")).count() == 0
    assert found.select("record").distinct().count() == len(texts) - 2


def test_a_third_of_all_records_in_one_place(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, F.lit("Via Roma 1, Montecalvesa")).otherwise(F.concat(F.lit("Via Roma "), (F.col("id") % 400 + 2).cast("string"), F.lit(", Montecalvesa"))).alias("text"))
    found = locations(address_parts(df, "id", "text"))
    assert found.groupBy("location").count().agg(F.max("count")).first()[0] == 300
