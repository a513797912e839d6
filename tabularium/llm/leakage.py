"""Passages of evaluation items inside the documents of a corpus.

A generalised suffix automaton of the normalised items' words is built once per worker. The words of
each document are streamed through it, so at every word the longest passage of any item that
ends there is known. Maximal passages are chained per item where only a few words lie between
them in both texts; a chain that exceeds the limits of length and coverage is a leak, and its span is taken out of the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import shipped

#: Shortest passage that counts, in words, and most words that may lie between two passages of a chain in either text.
MIN_RUN, MAX_GAP = 3, 7
#: Words of an item that a chain must cover to be a leak: quotations under 10 words are none, passages of 20 words with single words changed are, and
#: this is the middle between them. Of a shorter item the given share is enough, if it is no mere quotation.
MIN_COVER, QUOTATION, SHORT_SHARE = 14, 10, 0.9
#: Of the stretch between a chain's ends, the share of words that must be covered.
MIN_DENSITY = 0.55
#: Words of items in one automaton; more items are streamed against several automata in turn.
PACK_WORDS = 400_000
#: Packs whose automata a worker holds at once; more packs take another scan of the documents.
SCAN_PACKS = 4

_MARKS = re.compile("[̀-ͯ]+")
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_OTHER_LETTER = re.compile(r"(?![\x00-\x7f])[^\W_]")
#: A sign of a script that is written without spaces is a word of its own.
_UNSPACED = "\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}]+")


def _folded(text: str) -> str:
    return unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text).casefold())


def words(text: str) -> list[bytes]:
    """Words of a text: runs of letters and digits of any script, without case, accents and Unicode forms."""
    if not text.isascii():
        text = _MARKS.sub("", _folded(text))
        if _OTHER_LETTER.search(text):
            return [w.encode() for w in _WORD.findall("".join(c for c in text if not unicodedata.category(c).startswith("M")))]
    return text.encode("ascii", "replace").translate(_PLAIN).split()


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where each of the words of a text begins and ends in it; for texts that hold a passage, as every character is looked at."""
    flat, origin = [], []
    for at, c in enumerate(text):
        for part in c if c.isascii() else _folded(c):
            if part.isascii() or not unicodedata.category(part).startswith("M"):
                flat.append(part)
                origin.append(at)
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in _WORD.finditer("".join(flat))]


class Automaton:
    """Suffix automaton of several word sequences, with the places where each state's passages end."""

    def __init__(self, items: list[tuple[int, list[bytes]]]) -> None:
        self.next: list[dict[bytes | int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int] | None] = [None]
        last = 0
        for number, (item, tokens) in enumerate(items):
            for at, token in enumerate([*tokens, -1 - number]):
                state = len(self.next)
                self.next.append({})
                self.length.append(self.length[last] + 1)
                self.link.append(0)
                ends.append((item, at) if at < len(tokens) else None)
                p = last
                while p >= 0 and token not in self.next[p]:
                    self.next[p][token] = state
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][token]
                    if self.length[q] == self.length[p] + 1:
                        self.link[state] = q
                    else:
                        copy = len(self.next)
                        self.next.append(dict(self.next[q]))
                        self.length.append(self.length[p] + 1)
                        self.link.append(self.link[q])
                        ends.append(None)
                        while p >= 0 and self.next[p].get(token) == q:
                            self.next[p][token] = copy
                            p = self.link[p]
                        self.link[q] = self.link[state] = copy
                last = state
        children: dict[int, list[int]] = defaultdict(list)
        for s in range(1, len(self.link)):
            children[self.link[s]].append(s)
        self._children, self._ends = children, ends
        self.needed = {item: min(MIN_COVER, max(QUOTATION, ceil(SHORT_SHARE * len(tokens)))) for item, tokens in items}
        self.least = min(self.needed.values(), default=MIN_COVER)
        self._places: dict[int, list[tuple[int, int]]] = {}

    def places(self, state: int) -> list[tuple[int, int]]:
        """(item, position of the last word) of every place where the passages of a state stand."""
        if state not in self._places:
            found, stack = [], [state]
            while stack:
                s = stack.pop()
                if self._ends[s]:
                    found.append(self._ends[s])
                stack.extend(self._children.get(s, ()))
            self._places[state] = found
        return self._places[state]

    def passages(self, tokens: list[bytes], least: int = MIN_RUN) -> list[tuple[int, int, int]]:
        """(end, length, state) of every maximal passage of at least ``least`` words; ``end`` is exclusive."""
        follow, link, length = self.next, self.link, self.length
        out, state, run = [], 0, 0
        first = follow[0]
        for at, token in enumerate(tokens):
            to = follow[state].get(token)
            if to is None:
                if run >= least:
                    out.append((at, run, state))
                while to is None and state:
                    state = link[state]
                    to = follow[state].get(token)
                run = length[state]
                if to is None:
                    run = 0
                    to = first.get(token)
                    if to is None:
                        state = 0
                        continue
            state = to
            run += 1
        if run >= least:
            out.append((len(tokens), run, state))
        return out


class Chain(NamedTuple):
    """Words covered, and the span of words from ``start`` to ``end`` (exclusive) in the document."""

    covered: int
    start: int
    end: int


def chains(runs: list[tuple[int, int, int]], least: int) -> list[Chain]:
    """Disjoint chains of (end in the document, end in the item, length), in order in both with small gaps, that cover at least ``least`` words; those that cover most first."""
    out: list[Chain] = []
    while top := _best_chain(runs, least):
        out.append(top)
        runs = [r for r in runs if r[0] <= top.start or r[0] - r[2] >= top.end]
    return out


def _best_chain(runs: list[tuple[int, int, int]], least: int) -> Chain | None:
    runs = sorted(runs)
    longest = max((n for _, _, n in runs), default=0)
    best: list[tuple[int, int, int]] = []
    top: Chain | None = None
    for j, (d, i, n) in enumerate(runs):
        mine = (n, d - n, i - n)
        for k in range(j - 1, -1, -1):
            dk, ik, _ = runs[k]
            if d - dk > longest + MAX_GAP:
                break
            if d - n - dk <= MAX_GAP and dk < d and ik < i and i - n - ik <= MAX_GAP:
                got = best[k][0] + min(n, d - dk, i - ik)
                if got > mine[0]:
                    mine = (got, best[k][1], best[k][2])
        best.append(mine)
        if mine[0] >= max(least, top.covered + 1 if top else 0) and mine[0] >= MIN_DENSITY * max(d - mine[1], i - mine[2]):
            top = Chain(mine[0], mine[1], d)
    return top


def leaks(automaton: Automaton, text: str) -> dict[int, list[Chain]]:
    """Items of which ``text`` holds a passage, with its chains."""
    found = automaton.passages(words(text))
    if sum(n for _, n, _ in found) < automaton.least:
        return {}
    by_item: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for end, n, state in found:
        for item, at in automaton.places(state):
            by_item[item].append((end, at + 1, n))
    return {item: c for item, runs in by_item.items() if sum(n for _, _, n in runs) >= automaton.needed[item] and (c := chains(runs, automaton.needed[item]))}


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without spans of its words, which may overlap; what stood between two of its words goes with the first."""
    places = word_spans(text)
    out, at = [], 0
    for start, end in sorted(spans):
        begin, stop = places[start][0], places[end][0] if end < len(places) else len(text)
        if stop > at:
            out.append(text[at : max(at, begin)])
            at = stop
    return "".join([*out, text[at:]])


@lru_cache(maxsize=SCAN_PACKS)
def _automaton(pack: tuple[tuple[int, str], ...]) -> Automaton:
    return Automaton([(item, words(text)) for item, text in pack])


_SPANS = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32())]))
_LEAKS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int64()), ("spans", _SPANS)])
_LEAKS_DDL = "doc_id bigint, item_id bigint, n_words bigint, spans array<struct<first_word:int,end_word:int>>"
_CLEANED = pa.schema([("doc_id", pa.int64()), ("cleaned", pa.string()), ("n_removed", pa.int64())])


def _found(text: str, automata: list[Automaton]) -> dict[int, list[Chain]]:
    return {item: c for automaton in automata for item, c in leaks(automaton, text).items()}


def _stream(batches: Iterator[pa.RecordBatch], group: list[tuple[tuple[int, str], ...]]) -> Iterator[pa.RecordBatch]:
    automata = [_automaton(pack) for pack in group]
    for batch in batches:
        rows = [(d, i, c[0].covered, [{"first_word": x.start, "end_word": x.end} for x in c]) for d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for i, c in _found(t, automata).items()]
        yield pa.RecordBatch.from_pydict(dict(zip(_LEAKS.names, zip(*rows, strict=True) if rows else ((),) * 4, strict=True)), schema=_LEAKS)


def _strip(batches: Iterator[pa.RecordBatch], groups: list[list[tuple[tuple[int, str], ...]]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = (c.to_pylist() for c in batch.columns)
        spans: list[list[tuple[int, int]]] = [[] for _ in ids]
        for group in groups:
            automata = [_automaton(pack) for pack in group]
            for at, text in enumerate(texts):
                spans[at] += [(c.start, c.end) for found in _found(text, automata).values() for c in found]
        rows = [(d, without(t, s), len({w for a, b in s for w in range(a, b)})) for d, t, s in zip(ids, texts, spans, strict=True) if s]
        yield pa.RecordBatch.from_pydict(dict(zip(_CLEANED.names, zip(*rows, strict=True) if rows else ((),) * 3, strict=True)), schema=_CLEANED)


def packs(items: list[tuple[int, str]], most: int = PACK_WORDS) -> list[tuple[tuple[int, str], ...]]:
    """Items in groups of at most ``most`` words, a longer item alone."""
    out: list[list[tuple[int, str]]] = []
    size = most + 1
    for item in sorted(items):
        n = len(words(item[1]))
        if size + n > most:
            out.append([])
            size = 0
        out[-1].append(item)
        size += n
    return [tuple(p) for p in out]


def _groups(items: DataFrame) -> list[list[tuple[tuple[int, str], ...]]]:
    known = [(r["item_id"], r["text"]) for r in items.filter("item_id is not null and text is not null").select("item_id", "text").distinct().toLocalIterator()]
    made = packs(known)
    return [made[k : k + SCAN_PACKS] for k in range(0, len(made), SCAN_PACKS)]


def _texts(documents: DataFrame) -> DataFrame:
    shipped(documents.sparkSession)
    return documents.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_words`` (most words of the item covered by one passage) and ``spans`` (words of the document) for every document with a passage of an item.

    documents: ``doc_id``, ``text``. items: ``item_id``, ``text``, held-out material that is small beside the corpus; it is
    gathered in packs of bounded size, and the documents are scanned once for every ``SCAN_PACKS`` packs. NULL texts and ids are left out; items
    or documents without words match nothing; a repeated document row is reported once. Texts are read whole, whatever their length and script.
    """
    texts = _texts(documents)
    found = [texts.mapInArrow(lambda b, g=group: _stream(b, g), _LEAKS_DDL) for group in _groups(items)] or [documents.sparkSession.createDataFrame([], _LEAKS_DDL)]
    best = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.max(F.struct("n_words", "spans")).alias("_best"))
    return best.select("doc_id", "item_id", "_best.n_words", "_best.spans")


def cleaned_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents with passages of items, without these: ``doc_id``, ``cleaned`` text and ``n_removed``, the words taken out.

    Other documents stay as they are and are not in the result. See ``leaked_items``; a repeated row is given as often as it stands, as its texts can differ.
    """
    groups = _groups(items)
    return _texts(documents).mapInArrow(lambda b: _strip(b, groups), "doc_id bigint, cleaned string, n_removed bigint")
