import pytest

from tabularium.llm.entries import identifier_relation, mask_shape
from tabularium.llm.linkage import estimate, linked_records, mask_keys, name_level, pattern_of
from tabularium.llm.name_parts import parse_name, phonetic, same_name
from tabularium.llm.names import name_variants

COMMON = frozenset({"ecologia", "bonifiche", "autotrasporti", "costruzioni", "generali", "fratelli", "consorzio", "servizi", "ambientali"})
SAME = [
    ("ECOLOGIA CONCETTA GLUBSCISCO S.R.L.", "ECOLOGIA C. GLUBSCISCO SOC. A R.L."), ("BONIFICHE CATERINA REVIMA S.R.L.S.", "BONIFICHE RINA REVIAM S.R.L. SEMPLIFICATA"), ("STERANTE ROBERTO", "STERANTE, ROBERTO"),
    ("FRATELLI NINDARZO COSTRUZIONI GENERALI S.N.C.", "F.LLI NINDARZO COSTRUZIONI GEN.LI S.N.C."), ("DITTA BRADLULLI BARTOLOMEO", "BRALDULLI BARTOLOMEO"), ("DELFNENNI - CONSORZIO RECUPERI", "C.ZIO RECUPERI DELFNENNI"),
    ("TORREANA SERVIZI AMB.LI SRLS", "TORREANA SERVIZI AMBIENTALI S.R.L.S."), ("POLMQUANAASFALTI S R L", "POLMQUANA ASFALTI S.R.L."), ("AUTOTRASPORTI SCINDANA ANDREA", "SCINDANA, ANDRREA"), ("VORONDA G.", "VORONDA GAETANO"),
]
OTHER = [("ECOLOGIA GLUBSCISCO", "ECOLOGIA BRENZVIDO"), ("ROSSI ANNA", "ROSSI TERESA"), ("TEVLOCCA COSTRUZIONI S.R.L.", "TEVLOCCA COSTRUZIONI GENERALI S.R.L."), ("VERDI G.", "VERDI TERESA"), ("ECOLOGIA S.R.L.", "ECOLOGIA S.P.A. BONIFICHE")]


@pytest.mark.parametrize("a, b", SAME)
def test_variants(a, b):
    assert same_name(parse_name(a), parse_name(b), COMMON) > 0, (parse_name(a), parse_name(b))


@pytest.mark.parametrize("a, b", OTHER)
def test_different_names(a, b):
    assert same_name(parse_name(a), parse_name(b), COMMON) == 0, (parse_name(a), parse_name(b))


def test_odd_names():
    for text in ("", " ", "...", "S.R.L.", "x" * 20_000, "A B " * 3_000, "1234", "Ñ"):
        assert isinstance(parse_name(text).words, tuple)
    assert phonetic("") == "" and phonetic("ccc") == phonetic("k")


def test_variants_within_a_series_only(spark):
    rows = [(2 * n + i, "s", t) for n, p in enumerate(SAME) for i, t in enumerate(p)] + [(100 + 2 * n + i, "s", t) for n, p in enumerate(OTHER) for i, t in enumerate(p)]
    rows += [(500, "other", SAME[0][0]), (501, "other", "STERANTE ROBERTO"), (0, "s", SAME[0][0])]
    names = spark.createDataFrame(rows, "entry bigint, series string, name string")
    none = spark.createDataFrame([], "entry bigint, ids array<string>")
    got = {tuple(r) for r in name_variants(names, none).collect()}
    assert {(2 * n, 2 * n + 1) for n in range(len(SAME))} - got <= {(16, 17)}
    assert not any(a >= 500 or b >= 500 for a, b in got)
    veto = spark.createDataFrame([(4, ["01234567890"]), (5, ["98765432109"])], "entry bigint, ids array<string>")
    assert (4, 5) in got and (4, 5) not in {tuple(r) for r in name_variants(names, veto).collect()}
    assert name_variants(names.limit(0), none).count() == 0


@pytest.mark.parametrize(
    "a, b, level",
    [(["12345678901"], ["12345678901"], 4), (["12345678901"], ["12345678910"], 3), (["***45678***"], ["12345678901"], 2), (["99945678***"], ["12345678901"], 0), (["12345678901"], ["98765432109"], 0), ([], ["12345678901"], 1), (["rea123"], ["12345678901"], 1), (["12345678901"], ["rssmra80a01h501u"], 1), (["rssmra80a01h501u", "1"], ["rssmra80a01h501u"], 4)],
)
def test_identifier_levels(a, b, level):
    assert identifier_relation(a, b) == level == identifier_relation(b, a)


def test_estimation_separates_matches():
    address, identifier, both = range(3)
    counts = {(4, 3, 4, both): 300, (3, 2, 4, both): 100, (4, 1, 4, address): 480, (1, 1, 0, address): 4000, (1, 0, 0, address): 3000, (4, 0, 0, address): 60, (0, 0, 4, address): 20, (0, 1, 4, address): 50, (0, 1, 2, address): 100, (0, 0, 2, address): 300, (1, 2, 0, identifier): 70, (3, 3, 2, identifier): 20, (0, 2, 4, both): 5}
    posterior = estimate({pattern_of(*k): n for k, n in counts.items()})
    accepted = {k for k in counts if posterior[pattern_of(*k)] >= 0.5}
    assert accepted == {(4, 3, 4, both), (3, 2, 4, both), (4, 1, 4, address), (3, 3, 2, identifier), (0, 2, 4, both)}
    assert posterior[pattern_of(4, 3, 4, both)] > 0.99 and posterior[pattern_of(1, 0, 0, address)] < 0.01 and estimate({}) == {}
    few = estimate({pattern_of(*k): n // 50 + (k[0] == 4 and k[2] == 0) * 900 for k, n in counts.items()})
    assert few[pattern_of(4, 0, 0, address)] != posterior[pattern_of(4, 0, 0, address)]


@pytest.mark.parametrize(
    "a, b, level",
    [("rossi mario", "mario rossi", 4), ("querocca asfalti", "querocca inerti", 0), ("sarstrante luigi", "sarstrannte umberto", 0), ("brenzvido", "tarsugo", 1), ("carpenteria metallica tommaso brindido", "carpenteraimetal tommaso brindido", 3), ("ponteggib devimma", "ponteggi bartolomeo devima", 3), ("spurghil. grurmgrassi", "spurghi lorenzo grurmgrassi", 3)],
)
def test_name_levels(a, b, level):
    assert name_level([a], [b], COMMON) == level == name_level([b], [a], COMMON)


def test_forms_written_together_with_names():
    for text, words in (("TUMBEOS.R.L. - ESTRAZIONE CAVE", ("tumbeo", "estrazione", "cave")), ("SEPSTNETTIS R L - ASFALTI", ("sepstnetti", "asfalti")), ("LARSPRALDISRL", ("larspraldi",)), ("IMPIANTIF.LLI GALDTOCCA", ("impianti", "fratelli", "galdtocca")), ("C.ZIOIMPIANTI GESTTRULLI", ("consorzio", "impianti", "gesttrulli")), ("NUOVA DITTA SENZALDI", ("senzaldi",))):
        assert parse_name(text).words == words


def test_equal_profiles_are_compared_once(spark, monkeypatch):
    rows = [(n, "x", ["ecologia glubscisco"], ["12345678901"], ["Via Roma 1, Montecalvesa"]) for n in range(60)] + [(100 + n, "y", ["glubscisco ecologia"], ["12345678901"], ["Via Roma 1, Montecalvesa"]) for n in range(60)]
    profiles = spark.createDataFrame(rows, "entry bigint, side string, names array<string>, ids array<string>, addresses array<string>")
    seen = {}
    monkeypatch.setattr("tabularium.llm.linkage.estimate", lambda counts: seen.update(counts) or dict.fromkeys(counts, 1.0))
    assert linked_records(profiles, ("x", "y"), COMMON).count() == 3600 and list(seen.values()) == [3600]


def test_linkage_across_sides(spark):
    people = ["GLUBSCISCO", "BRENZVIDO", "TARSUGO", "POLMQUANNA", "SCINDANA", "REVIMA", "MEVERO", "ZERBETTI"]
    rows = []
    for n, p in enumerate(people):
        number = f"{10000000000 + n * 1234567891}"
        rows.append((n, "x", [f"ecologia {p.lower()}"], [number], [f"Via {p.title()} {n + 1}, Montecalvesa"]))
        rows.append((100 + n, "y", [f"{p.lower()} ecologia"], [number] if n % 2 else None, [f"MONTECALVESA, VIA {p} N. {n + 1}"]))
    rows += [(200, "y", ["ecologia glubscisco"], ["98989898989"], ["Via Altra 7, Lontano"]), (201, "y", None, None, None), (202, "x", ["ecologia"], [""], [""])]
    profiles = spark.createDataFrame(rows, "entry bigint, side string, names array<string>, ids array<string>, addresses array<string>")
    got = linked_records(profiles, ("x", "y"), COMMON).collect()
    assert {(r["a"], r["b"]) for r in got} == {(n, 100 + n) for n in range(len(people))}
    assert all(0.5 <= r["confidence"] <= 1 for r in got)
    assert linked_records(profiles.limit(0), ("x", "y"), COMMON).count() == 0


def test_masked_identifier_alone_brings_a_pair_together(spark):
    profiles = spark.createDataFrame(
        [
            (1, "x", ["mario scevzarzo"], ["scvlssxxxxxxxxxx"], ["Via Roma 5, 99066 T.nidora"]), (2, "y", ["mario scevzarzo"], ["scvlss95p02x092g"], ["Largo Verdi 7, 99066 Torrenidora"]),
            (3, "x", ["derero noli"], ["19487257479"], ["Largo Bevvana 69, Fontegrifana"]), (4, "y", ["noli derro"], ["19##72574##"], ["Corso Glubqietti 29, Fontegrifana"]),
            (5, "y", ["noli derro"], ["18##72574##"], ["Corso Glubqietti 30, Fontegrifana"]), (6, "x", ["lenni nulli"], ["***55555***"], None), (7, "y", ["nulli lenni"], ["xxx55555xxx"], None),
            (8, "x", ["ranzi"], ["*******"], None), (9, "y", None, None, None),
        ],
        "entry bigint, side string, names array<string>, ids array<string>, addresses array<string>",
    )
    known = [r.asDict() for r in profiles.collect()]
    shapes = sorted({mask_shape(v) for r in known for v in r["ids"] or () if "*" in v or "#" in v or "xx" in v})
    keys = {r["entry"]: mask_keys(r["ids"] or (), r["side"], "y" if r["side"] == "x" else "x", shapes) for r in known}
    met = {(a, b) for a in keys for b in keys if a < b and keys[a] & keys[b] and known[a - 1]["side"] != known[b - 1]["side"]}
    assert met == {(1, 2), (3, 4), (6, 7)}
    got = {(r["a"], r["b"]) for r in linked_records(profiles, ("x", "y"), COMMON, 0.0).collect()}
    assert {(1, 2), (3, 4)} <= got
