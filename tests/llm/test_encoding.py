import re

import pytest

from tabularium.llm.encoding import SUSPECT, garbled_texts, repair

ITALIAN = "La società non è più iscritta: l’attività dell’elenco «già cessata» – € 5 (§ 3) perché così può. N° 5, 1ª categoria, 20 °C, ± 5 %."
GERMAN = "Das Verzeichnis enthält die gültige Erklärung für die Prüfung gemäß Maß; ausschließlich geänderte Tätigkeit."
FRENCH = "La société à responsabilité limitée complète déjà le siège transféré où qu’il soit, reçue dès l’année."
CLEAN = [
    ITALIAN, GERMAN, FRENCH, "Åre, São Ângelo and Ñuble are place names – kept.", "the supplier CONSTRUÇÕES SÃO Costruzioni S.p.A.", "À L’ÂGE DE 18 ANS", "Café “Roma” – naïve €5", "SOCIETÀ COOPERATIVA È GIÀ", "gelten 65 m² und 20 °C",
    "", " ", "plain ascii", "Città di Forlì, lì 3/3/2020", "¿Qué?", "Größe ÜBER ALLES", "x" * 100_000, "à " * 20_000,
]
WRONG = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "cp850"), ("utf-8", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("cp1252", "cp1250")]


def garble(text, real, wrong):
    out = []
    for b in text.encode(real):
        try:
            out.append(bytes([b]).decode(wrong))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_stay(text):
    assert repair(text) == (text, 0, False)


@pytest.mark.parametrize("real, wrong", WRONG)
@pytest.mark.parametrize("text", [ITALIAN, GERMAN, FRENCH])
def test_round_trips(text, real, wrong):
    bad = garble(text, real, wrong)
    if bad == text:
        return
    restored, layers, lost = repair(bad)
    assert layers >= 1 and re.search(SUSPECT, bad)
    same = sum(a == b for a, b in zip(restored, text, strict=False)) if len(restored) == len(text) else 0
    assert same >= len(text) - 3, restored


OTHERS = {
    "czech": ("Příliš žluťoučký kůň úpěl ďábelské ódy. Žluťoučký kůň", "cp1250"), "polish": ("Zażółć gęślą jaźń. Łódź, świętość źdźbła", "cp1250"), "russian": ("Привет мир, я и ты в доме с котом", "cp1251"),
    "greek": ("Καλημέρα κόσμε, η ζωή", "cp1253"), "hungarian": ("Árvíztűrő tükörfúrógép", ""), "croatian": ("Ćevapčići i đak šalju žito", ""), "romanian": ("Și țara are mâine sfârșit ăsta", ""), "turkish": ("Şişli’de ağır iş günü çok zor", ""),
    "spanish": ("El niño comió piñón, así será más fácil según él", ""), "norwegian": ("Det er nødvendig å gå på skolen i Ålesund, æres", ""), "japanese": ("日本語のテキスト", ""), "short": ("Žluťoučký kůň", "cp1250"), "mixed": ("La società Żółć è già iscritta", ""),
}


@pytest.mark.parametrize("name", OTHERS)
def test_other_languages_stay_and_come_back(name):
    text, narrow = OTHERS[name]
    assert repair(text) == (text, 0, False)
    for wrong in ("cp1252", "latin-1", "cp437", "mac_roman"):
        assert repair(garble(text, "utf-8", wrong))[0] == text, wrong
    if narrow:
        assert repair(garble(text, narrow, "cp1252"))[0] == text


def test_nested_partial_and_lost():
    twice = garble(garble(ITALIAN, "utf-8", "cp1252"), "utf-8", "cp1252")
    assert repair(twice)[:2] == (ITALIAN, 2)
    part = FRENCH + "\n" + garble(ITALIAN, "utf-8", "cp1252") + "\n" + GERMAN
    assert repair(part)[:2] == ("\n".join((FRENCH, ITALIAN, GERMAN)), 1)
    assert repair("la societÃ  Rossi")[0] == "la società Rossi"
    lost = ITALIAN.encode("cp1252").decode("utf-8", "replace")
    assert repair(lost)[2] and repair(None) == (None, 0, False)


def test_table(spark):
    rows = [(1, ITALIAN, 0), (2, garble(ITALIAN, "utf-8", "cp1252"), 0), (3, None, 0), (4, "", 0), (5, "�", 0), (2, garble(ITALIAN, "utf-8", "cp1252"), 0), (6, garble(GERMAN, "utf-8", "latin-1") * 500, 0)]
    got = garbled_texts(spark.createDataFrame(rows, "doc_id bigint, text string, layers int")).collect()
    assert sorted((r["doc_id"], r["layers"], r["lost"]) for r in got) == [(2, 1, False), (2, 1, False), (5, 0, True), (6, 1, False)]
    assert {r["restored"] for r in got if r["doc_id"] == 2} == {ITALIAN}
    assert garbled_texts(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


#: Garbled passages whose every sign is usual elsewhere.
PLAIN_SIGNS = [
    ("RORBMOCCA â€“ Pietratufara", "RORBMOCCA – Pietratufara"), ("allegato (Â§ 70).", "allegato (§ 70)."), ("PRILSIDO ÔÇô Roccanidora", "PRILSIDO – Roccanidora"),
    ("un capitale di Ç 705.108,00 nel comune", "un capitale di € 705.108,00 nel comune"), ("a 20 Â°C", "a 20 °C"), ("gli Â«elenchi", "gli «elenchi"),
]


def test_signs_that_are_usual_elsewhere(spark):
    rows = [(k, bad) for k, (bad, _) in enumerate(PLAIN_SIGNS)]
    got = garbled_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["restored"] for r in got} == {k: good for k, (_, good) in enumerate(PLAIN_SIGNS)}


def test_what_repair_changes_is_looked_at():
    signs = "àèéìòùâêîôûäöüßçëïñœÀÈÉÌÒÙÄÖÜÇ’‘“”„–—«»€°§²³ªº±…•·½"
    for real, wrong in WRONG:
        for sign in signs:
            for pattern in ("uno {} due", "uno ({} 7)", "7 {}C", "caff{}", "perch{} no", "l{}elenco"):
                try:
                    bad = garble(pattern.format(sign), real, wrong)
                except UnicodeEncodeError:
                    continue
                _, layers, lost = repair(bad)
                assert not (layers or lost) or re.search(SUSPECT, bad), bad


@pytest.mark.parametrize("text, good", [("CAVE GORULLI û Montemelusa", "CAVE GORULLI – Montemelusa"), ("list û page 77", "list – page 77"), ("die Umlaute ä, ö, ü", None), ("il tasto «û»", None), ("è lì o là, ò ì ù", None)])
def test_lone_letters(text, good):
    assert repair(text) == ((good, 1, False) if good else (text, 0, False))
