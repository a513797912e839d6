import pytest
from hypothesis import given
from hypothesis import strategies as st

from tabularium.llm.distances import distance, jaro_winkler, within

WORD = st.text(alphabet="abc", max_size=7)


def plain(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i and j and x == b[j - 1] and a[i - 1] == y:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@given(WORD, WORD)
def test_distance_and_bound(a, b):
    assert distance(a, b) == plain(a, b)
    for most in range(4):
        assert within(a, b, most) == (plain(a, b) <= most)


@given(WORD, WORD)
def test_jaro_winkler_is_symmetric_and_bounded(a, b):
    assert 0 <= jaro_winkler(a, b) <= 1
    assert jaro_winkler(a, b) == pytest.approx(jaro_winkler(b, a))


def test_known_jaro_winkler_values():
    assert jaro_winkler("MARTHA", "MARHTA") == pytest.approx(0.9611, abs=1e-4)
    assert jaro_winkler("DWAYNE", "DUANE") == pytest.approx(0.84, abs=1e-4)
    assert jaro_winkler("", "a") == 0 and jaro_winkler("", "") == 1
