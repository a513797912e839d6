"""Probabilistic linkage of the records of two sources that share no key.

Candidates come from several blocking passes; each pair is compared on name, identifier and
address, giving a small pattern of agreement levels; expectation-maximisation over the counts of
the patterns estimates how often each level occurs among matches and among non-matches; the
posterior probability of a match is the confidence of a pair and alone decides.

Pairs that only an identifier brought together always agree on it, match or not, and likewise with addresses. So
a pattern holds the route by which its pairs were found, and the levels of identifier and address are estimated for each route.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.address_parts import parse_address
from tabularium.llm.addresses import municipality_likeness, same_location, same_street
from tabularium.llm.entries import identifier_kind, identifier_relation, identifier_text, mask_shape, visible
from tabularium.llm.name_parts import _NICK, NICKNAMES, code_keys, compared, phonetic, unjoined
from tabularium.session import written

#: Levels of the fields name, identifier and address, and routes (address, identifier, both); patterns are their product.
LEVELS, ROUTES = (5, 5, 5), 3
#: Least posterior probability of a reported match.
CONFIDENCE = 0.5
#: Starting values of the match and non-match probabilities by level, and of the share of matches by route.
START_M = ((0.002, 0.01, 0.05, 0.3, 0.638), (0.01, 0.49, 0.2, 0.2, 0.1), (0.05, 0.05, 0.1, 0.1, 0.7))
START_U = ((0.35, 0.45, 0.1, 0.05, 0.05), (0.6, 0.38, 0.01, 0.005, 0.005), (0.5, 0.1, 0.3, 0.05, 0.05))
START_SHARE = (0.1, 0.1, 0.9)
#: Most matches found by address alone whose names differ in words on both sides. Relatives and sister firms share a word of the name and the address, which the fields'
#: independence cannot tell from matches, so estimation is kept from taking them for one.
MOST_OPPOSED = 0.001

_PROFILE = "entry bigint, side string, names array<string>, ids array<string>, addresses array<string>"
_KINDS = "kind bigint, n bigint, side string, names array<string>, ids array<string>, addresses array<string>, keys array<string>, shapes array<string>"


def _telling(core: str, common: frozenset[str]) -> list[str]:
    words = core.split(" ")
    return [w for w in words if w not in common and w not in NICKNAMES and w not in _NICK and len(w.strip(".")) > 2] or words


def blocking_keys(names: Sequence[str], ids: Sequence[str], addresses: Sequence[Sequence[str]], common: frozenset[str]) -> set[str]:
    """The blocks of an entry: sound of a telling word with the civic number, with the municipality, and with either end of an identifier."""
    keys = set()
    for core in names:
        for word in _telling(core, common):
            sound = phonetic(word)
            for municipality, kind, _, civic, *_ in addresses:
                if kind:
                    keys |= {f"c|{code}|{kind}|{civic}|{municipality[-3:] if not civic else ''}" for code in code_keys(word)}
                if municipality:
                    keys.add(f"m|{sound}|{phonetic(municipality)}")
            for value in ids:
                if identifier_kind(value) in ("number", "person"):
                    keys |= {f"i|{sound[:3]}|{value[:4]}", f"j|{sound[:3]}|{value[-4:]}"}
    return keys


def mask_keys(ids: Sequence[str], side: str, other: str, shapes: Sequence[str]) -> set[str]:
    """The blocks of an entry by the visible part of masked identifiers, whatever its name and address.

    A full identifier stands in the blocks of all ``shapes`` of its length, under its side, where only masked ones of the other side meet it; equal masked ones meet as well.
    """
    keys = set()
    for value in ids:
        kind = identifier_kind(value)
        if kind == "masked":
            shape = mask_shape(value)
            keys |= {f"v|{by}|{shape}|{visible(value, shape)}" for by in (other, "") if shape.count("1") > 3}
        elif kind:
            keys |= {f"v|{side}|{shape}|{visible(value, shape)}" for shape in shapes if len(shape) == len(value) and shape.count("1") > 3}
    return keys


def _mask_blocks(batches: Iterator[pa.RecordBatch], sides: tuple[str, str], shapes: Sequence[str]) -> Iterator[pa.RecordBatch]:
    other = dict(zip(sides, reversed(sides), strict=True))
    for batch in batches:
        keys = [sorted(mask_keys(ids, side, other[side], shapes)) for side, ids in zip(*(batch.column(c).to_pylist() for c in ("side", "ids")), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("entry"), batch.column("side"), pa.array(keys, pa.list_(pa.string()))], ["entry", "side", "keys"])


def _profiles(batches: Iterator[pa.RecordBatch], common: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, ids, addresses = [], [], []
        for spelt, values, written_as in zip(*(batch.column(c).to_pylist() for c in ("names", "ids", "addresses")), strict=True):
            cores = sorted({unjoined(n, common) for n in spelt or () if n and n.strip()})
            plain = sorted({t for v in values or () if (t := identifier_text(v))})
            places = sorted({tuple(parse_address(a)) for a in written_as or ()})
            names.append(cores)
            ids.append(plain)
            addresses.append(["|".join(p) for p in places])
        arrays = [pa.array(x, pa.list_(pa.string())) for x in (names, ids, addresses)]
        yield pa.RecordBatch.from_arrays([batch.column("entry"), batch.column("side"), *arrays], ["entry", "side", "names", "ids", "addresses"])


def _keyed(batches: Iterator[pa.RecordBatch], common: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, shapes = [], []
        for cores, plain, places in zip(*(batch.column(c).to_pylist() for c in ("names", "ids", "addresses")), strict=True):
            keys.append(sorted(blocking_keys(cores, plain, [p.split("|") for p in places], common)))
            shapes.append(sorted({mask_shape(v) for v in plain if identifier_kind(v) == "masked"}))
        arrays = [pa.array(x, pa.list_(pa.string())) for x in (keys, shapes)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, "keys", "shapes"])


def name_level(a: Sequence[str], b: Sequence[str], common: frozenset[str]) -> int:
    """4 the same words, 3 all words agree, 2 one name has more than the other, 1 names without a common word, 0 names that share a word and differ in others on both sides."""
    best, opposed = 1, False
    for x in a:
        for y in b:
            p, q = x.split(" "), y.split(" ")
            if sorted(p) == sorted(q):
                return 4
            s, differ = compared(tuple(p), tuple(q), common)
            if s > 0:
                best = max(best, 3 if s >= 0.75 else 2)
            opposed = opposed or differ
    return 0 if best == 1 and opposed else best


def address_level(a: Sequence[Sequence[str]], b: Sequence[Sequence[str]]) -> int:
    """4 one location, 3 one street, 2 one municipality, 1 unknown, 0 different municipalities."""
    best, known = 0, False
    for x in a:
        for y in b:
            if not x[0] or not y[0]:
                continue
            known = True
            if same_location(x, y):
                return 4
            if municipality_likeness(x[0], y[0]) > 0:
                best = max(best, 3 if x[1] == y[1] and same_street(x[2], y[2]) else 2)
    return best if known else 1


def pattern_of(name: int, identifier: int, address: int, route: int) -> int:
    """The number of a pattern."""
    return ((name * LEVELS[1] + identifier) * LEVELS[2] + address) * ROUTES + route


def _patterns(batches: Iterator[pa.RecordBatch], common: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        sides = [[batch.column(f"{c}_{s}").to_pylist() for c in ("names", "ids", "addresses")] for s in ("a", "b")]
        for na, ia, aa, nb, ib, ab, route in zip(*sides[0], *sides[1], batch.column("routes").to_pylist(), strict=True):
            n, i, p = name_level(na, nb, common), identifier_relation(ia, ib), address_level([x.split("|") for x in aa], [x.split("|") for x in ab])
            out.append(pattern_of(n, i, p, route - 1))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("n"), pa.array(out, pa.int32())], ["a", "b", "n", "pattern"])


def estimate(counts: dict[int, int], rounds: int = 200) -> dict[int, float]:
    """The posterior probability of a match for each pattern, by expectation-maximisation over the patterns' counts.

    Given match or non-match and the route, fields are taken as independent; the levels of names are the same on every route but for
    ``MOST_OPPOSED``. The starting values, which alone say which levels speak for a match, count as one observation of each table in every round, so no probability becomes zero. No patterns
    give no posteriors.
    """
    if not counts:
        return {}
    patterns = np.array(sorted(counts))
    weight = np.array([counts[p] for p in patterns], float)
    route, rest = patterns % ROUTES, patterns // ROUTES
    name, identifier, address = rest // (LEVELS[1] * LEVELS[2]), rest // LEVELS[2] % LEVELS[1], rest % LEVELS[2]
    cells = (route * LEVELS[0] + name, route * LEVELS[1] + identifier, route * LEVELS[2] + address)
    start = [[np.tile(np.array(t), (ROUTES, 1)) for t in tables] for tables in (START_M, START_U)]
    m, u = ([t.copy() for t in tables] for tables in start)
    share = np.array(START_SHARE)

    def posterior() -> np.ndarray:
        like_m, like_u = (np.prod([t.ravel()[c] for t, c in zip(tables, cells, strict=True)], axis=0) for tables in (m, u))
        return share[route] * like_m / (share[route] * like_m + (1 - share[route]) * like_u)

    for _ in range(rounds):
        match = posterior()
        for tables, first, w in ((m, start[0], match * weight), (u, start[1], (1 - match) * weight)):
            for f, cell in enumerate(cells):
                got = np.bincount(cell, w, first[f].size).reshape(first[f].shape)
                got = first[f] + (got if f else got.sum(axis=0))
                tables[f] = got / got.sum(axis=1, keepdims=True)
        if m[0][0, 0] > MOST_OPPOSED:
            m[0][0, 1:] *= (1 - MOST_OPPOSED) / m[0][0, 1:].sum()
            m[0][0, 0] = MOST_OPPOSED
        share = (np.bincount(route, match * weight, ROUTES) + np.array(START_SHARE)) / (np.bincount(route, weight, ROUTES) + 1)
    return dict(zip(patterns.tolist(), posterior().tolist(), strict=True))


def linked_records(profiles: DataFrame, sides: tuple[str, str], common: frozenset[str], confidence: float = CONFIDENCE) -> DataFrame:
    """Pairs of an entry of one side and an entry of the other that are one subject: ``a``, ``b``, ``pattern``, ``confidence``.

    profiles: ``entry``, ``side``, ``names`` (core words as ``parsed_names`` gives them), ``ids``, ``addresses`` (arrays of texts, NULL for none), one row per entry.
    Missing values count as unknown, never as agreement. Entries with the same names, identifiers and addresses are compared once. Empty input gives no rows.
    """
    known = written(profiles.filter(F.col("side").isin(*sides)).mapInArrow(lambda b: _profiles(b, common), _PROFILE), "profiles")
    alike = ("side", "names", "ids", "addresses")
    distinct = known.groupBy(*alike).agg(F.min("entry").alias("kind"), F.count("*").alias("n")).select("kind", "n", *alike)
    kinds = written(distinct.mapInArrow(lambda b: _keyed(b, common), _KINDS), "kinds")
    shapes = sorted(r["shape"] for r in kinds.select(F.explode("shapes").alias("shape")).distinct().collect())
    masks = kinds.filter(F.size("ids") > 0).select(F.col("kind").alias("entry"), "side", "ids").mapInArrow(lambda b: _mask_blocks(b, sides, shapes), "entry bigint, side string, keys array<string>")
    blocks = kinds.select(F.col("kind").alias("entry"), "side", "keys").unionByName(masks).select("entry", "side", F.explode("keys").alias("key"))
    by_address = F.substring("key", 1, 1).isin("c", "m")
    blocks = blocks.select("entry", "side", F.xxhash64("key").alias("key"), F.when(by_address, 1).otherwise(2).alias("route"))
    left, right = (blocks.filter(F.col("side") == s).select("key", "route", F.col("entry").alias(n)) for s, n in zip(sides, ("a", "b"), strict=True))
    candidates = left.join(right, ["key", "route"]).groupBy("a", "b").agg(F.bit_or("route").alias("routes"))
    for n in ("a", "b"):
        candidates = candidates.join(kinds.select(F.col("kind").alias(n), F.col("n").alias(f"n_{n}"), *[F.col(c).alias(f"{c}_{n}") for c in alike[1:]]), n)
    compared = written(candidates.withColumn("n", F.col("n_a") * F.col("n_b")).mapInArrow(lambda b: _patterns(b, common), "a bigint, b bigint, n bigint, pattern int"), "patterns")
    counts = {r["pattern"]: r["n"] for r in compared.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}
    matches = [(p, float(c)) for p, c in estimate(counts).items() if c >= confidence]
    table = profiles.sparkSession.createDataFrame(matches, "pattern int, confidence double")
    members = known.join(kinds.select(*alike, "kind"), list(alike)).select("entry", "kind")
    links = compared.join(F.broadcast(table), "pattern")
    for n in ("a", "b"):
        links = links.withColumnRenamed(n, "kind").join(members.withColumnRenamed("entry", n), "kind").drop("kind")
    return links.select("a", "b", "pattern", "confidence")
