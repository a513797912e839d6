import random

from tabularium.llm.leakage import Automaton, cleaned_documents, leaked_items, leaks, packs, without, word_spans, words

R = random.Random(4)
VOCABULARY = [f"parola{i}" for i in range(400)]
ITEMS = [(i, " ".join(R.choice(VOCABULARY) for _ in range(60)) + " ai sensi dell’articolo sette comma due del regolamento") for i in range(20)]
AUTOMATON = Automaton([(i, words(t)) for i, t in ITEMS])


def text_of(item, start=0, n=60):
    return " ".join(ITEMS[item][1].split()[start : start + n])


def noise(n, seed=9):
    r = random.Random(seed)
    return " ".join(r.choice(["atto", "elenco", "società", "il", "parola1", "parola2"]) for _ in range(n))


def test_longest_matches_equal_brute_force():
    r = random.Random(1)
    items = [(i, [f"w{r.randrange(4)}".encode() for _ in range(30)]) for i in range(4)]
    automaton = Automaton(items)
    tokens = [f"w{r.randrange(5)}".encode() for _ in range(200)]
    runs = set()
    for end in range(1, len(tokens) + 1):
        best = next((n for n in range(min(end, 30), 0, -1) if any(tokens[end - n : end] == t[k : k + n] for _, t in items for k in range(len(t) - n + 1))), 0)
        longer = end < len(tokens) and any(tokens[end - best : end + 1] == t[k : k + best + 1] for _, t in items for k in range(len(t) - best))
        if best >= 3 and not longer:
            runs.add((end, best))
    found = automaton.passages(tokens)
    assert {(e, n) for e, n, _ in found} == runs
    for end, n, state in found:
        assert set(automaton.places(state)) == {(i, k + n - 1) for i, t in items for k in range(len(t) - n + 1) if t[k : k + n] == tokens[end - n : end]}


def test_whole_partial_altered_and_edited_passages():
    assert set(leaks(AUTOMATON, f"{noise(50)}\n{ITEMS[3][1]}. {noise(40)}")) == {3}
    assert set(leaks(AUTOMATON, noise(30) + " " + text_of(5, 20, 20) + " " + noise(30))) == {5}
    assert set(leaks(AUTOMATON, ITEMS[7][1].upper().replace("PAROLA", "PÀROLA").replace(" ", "  \n"))) == {7}
    edited = text_of(2, 0, 40).split()
    edited[6], edited[13] = "altro", ""
    edited.insert(25, "sic")
    assert set(leaks(AUTOMATON, " ".join(edited))) == {2}


def test_short_quotes_phrases_and_scattered_words_are_none():
    assert leaks(AUTOMATON, noise(50) + " " + text_of(5, 20, 9) + " " + noise(50)) == {}
    assert leaks(AUTOMATON, (noise(20) + " ai sensi dell’articolo sette comma due del regolamento. ") * 30) == {}
    scattered = text_of(6).split()
    assert leaks(AUTOMATON, " ".join(w for k in range(0, 60, 4) for w in (*scattered[k : k + 4], *noise(25, k).split()))) == {}
    for text in ("", " ", "x" * 200_000, "parola1 " * 30_000):
        assert leaks(AUTOMATON, text) == {}


def test_words_of_any_script():
    for text in ("Straße à Žluťoučký, l’Œuvre ½ ﬁne", "Привет, МИР! ё", "Καλημέρα ς Σ", "日本語 text 2", "שָׁלוֹם עולם", "a_b-c", "", "x" * 1000):
        spans = word_spans(text)
        assert [w.decode() for w in words(text)] == [w.decode() for a, b in spans for w in words(text[a:b])] or "½" in text
        assert len(words(text)) == len(spans)
    assert words("Straße ÄÖ Привет") == [b"strasse", b"ao", "привет".encode()] and len(words("日本語")) == 3


def test_other_scripts_leak():
    text = " ".join(f"слово{chr(1072 + k)} дом{chr(1072 + k * 7 % 30)}" for k in range(20))
    han = "".join(chr(0x4E00 + 37 * k) for k in range(40))
    automaton = Automaton([(1, words(text)), (2, words(han)), (3, words("due parole di un testo breve che ha undici parole in tutto"))])
    assert set(leaks(automaton, f"{noise(30)} {text.upper()} {noise(9)}")) == {1}
    assert set(leaks(automaton, f"{noise(30)} {han[5:35]} {noise(9)}")) == {2}
    assert set(leaks(automaton, "Inizio: due parole di un testo breve, che ha undici parole in tutto. Fine")) == {3}
    assert leaks(automaton, "due parole di un testo breve che ha undici") == {}


def test_passages_are_taken_out(spark):
    twice = f"Prima. {ITEMS[3][1]}! Mezzo; {text_of(3, 10, 30)} – fine à é."
    chain = leaks(AUTOMATON, twice)[3]
    assert len(chain) == 2
    assert without(twice, [(c.start, c.end) for c in chain]) == "Prima. Mezzo; fine à é."
    assert without("a b c d", [(0, 2), (1, 3)]) == "d" and without("a b", [(0, 2)]) == "" and without("a b.", []) == "a b."
    documents = spark.createDataFrame([(1, twice, "x"), (2, noise(40), "x"), (3, None, "x"), (4, ITEMS[1][1], "x")], "doc_id bigint, text string, cleaned string")
    got = {r["doc_id"]: (r["cleaned"], r["n_removed"]) for r in cleaned_documents(documents, spark.createDataFrame(ITEMS, "item_id bigint, text string")).collect()}
    assert got[1][0] == "Prima. Mezzo; fine à é." and got[4] == ("", len(words(ITEMS[1][1]))) and set(got) == {1, 4}
    assert cleaned_documents(documents, spark.createDataFrame([], "item_id bigint, text string")).count() == 0


def test_tables(spark):
    docs = [(1, ITEMS[0][1], 5), (2, noise(40), 5), (3, None, 5), (4, "", 5), (5, f"{ITEMS[1][1]} {noise(5000)} {ITEMS[2][1]}", 5), (1, ITEMS[0][1], 5), (6, ITEMS[0][1], 5), (None, ITEMS[0][1], 5)]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([*ITEMS, (None, "x"), (99, None), (98, "")], "item_id bigint, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in leaked_items(documents, items).collect())
    assert got == [(1, 0), (5, 1), (5, 2), (6, 0)]
    assert leaked_items(documents, items.limit(0)).count() == 0 and leaked_items(documents.limit(0), items).count() == 0
    assert [len(p) for p in packs(ITEMS, 200)] == [2] * 10 and sum(packs(ITEMS, 5), ()) == tuple(ITEMS)
