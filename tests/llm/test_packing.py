import random
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabularium.llm.packing import VOCABULARY, TokenCounter, packed, packed_kinds, packing_patterns, places, token_counts

HAVE = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 300), max_size=12), st.integers(40, 60))
def test_patterns_hold_every_item_once_and_fit(histogram, capacity):
    patterns = packing_patterns(histogram, capacity)
    held = Counter()
    for pattern, packs in patterns:
        assert packs > 0 and 0 < sum(pattern) <= capacity
        for length in pattern:
            held[length] += packs
    assert held == Counter(histogram)
    for length, rows in places(patterns).items():
        seen = sorted((r[0], r[0]) for r in rows)
        assert seen[0][0] == 0 and histogram[length] > rows[-1][0]


def test_little_room_is_left():
    r = random.Random(1)
    histogram = Counter(min(512, max(1, int(r.lognormvariate(5, 0.8)))) for _ in range(20_000))
    patterns = packing_patterns(histogram, 512)
    total, packs = sum(k * n for k, n in histogram.items()), sum(n for _, n in patterns)
    assert total / (packs * 512) > 0.99 and len(patterns) < 4 * 512


def check(rows, sizes, capacity):
    by, spans = {}, {}
    for r in rows:
        if r["container_id"] is not None:
            by.setdefault(r["container_id"], []).append((r["place"], r["n_tokens"]))
        spans.setdefault(r["doc_id"], []).append((r["first_token"], r["n_tokens"], r["container_id"]))
    for parts in by.values():
        at = 0
        for place, n in sorted(parts):
            assert place == at
            at += n
        assert at <= capacity
    assert sorted(by) == list(range(len(by)))
    for doc, n in sizes.items():
        parts, at = sorted(spans[doc], key=lambda p: p[:2]), 0
        assert len(parts) == max(1, -(-n // capacity))
        for first, size, _ in parts:
            assert first == at
            at += size
        assert at == n


def test_every_document_has_its_place(spark):
    r = random.Random(2)
    sizes = {i: r.choice([0, 5, 5, 5, 17, 50, 51, 120]) if i % 3 else 7 for i in range(1, 700)}
    df = spark.createDataFrame(list(sizes.items()), "doc_id bigint, n_tokens bigint")
    check(packed(df, 50).collect(), sizes, 50)
    assert packed(df.limit(0), 50).count() == 0
    with pytest.raises(ValueError):
        packed(df, 0)


@HAVE
def test_counts_equal_encoding():
    counter = TokenCounter(VOCABULARY)
    for text in ["", "a", "a b", "a  b", " a", "a ", "a\nb c", "a\n b", "l’altro — x 12 3'll", "à è ì", "x" * 5000, "tab\tb c", "a\n\n\nb", "日本 語", "a  b", "\n a"]:
        assert counter(text) == len(counter._encode(text)), text
    assert counter(None) == 0


@HAVE
def test_kinds(spark):
    docs = spark.createDataFrame([(1, "uno due tre", "x"), (2, None, "x"), (3, "", "x"), (4, "parola " * 3000, "x")], "doc_id bigint, text string, n_tokens string")
    kinds = spark.createDataFrame([("short", 64), ("none", 0), ("null", None)], "container_kind string, capacity_tokens int")
    rows = packed_kinds(docs, kinds).collect()
    sizes = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs).collect()}
    assert {r["container_kind"] for r in rows} == {"short"} and sizes[2] == sizes[3] == 0
    check(rows, sizes, 64)
