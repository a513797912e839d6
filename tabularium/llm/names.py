"""Variant spellings of one subject's name within a series.

Method: blocks by phonetic codes of the telling words of a name, comparison of words by
Jaro–Winkler with nicknames, initials and short forms, and connected components over accepted
pairs. Identifiers may veto a pair but never make one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.entries import identifier_relation, identifier_text
from tabularium.llm.name_parts import _NICK, NICKNAMES, Name, code_keys, parse_name, phonetic, same_name, unjoined
from tabularium.operators.components import components
from tabularium.session import discarded, written

#: A word that at least this share of all entries have is a line of business or the like and tells no subject. At most 1 / share times the words of a name can be.
COMMON_SHARE = 0.003


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [parse_name(n) for n in batch.column("name").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("entry"), batch.column("series"), batch.column("name"), pa.array([" ".join(n.words) for n in names], pa.string()), pa.array([n.form for n in names], pa.string())], ["entry", "series", "name", "core", "form"]
        )


def parsed_names(names: DataFrame) -> DataFrame:
    """``entry``, ``series``, ``name`` with the name's core words and legal form."""
    return names.select("entry", "series", "name").mapInArrow(_parsed, f"entry {names.schema['entry'].dataType.simpleString()}, series string, name string, core string, form string")


def common_words(parsed: DataFrame, share: float = COMMON_SHARE) -> frozenset[str]:
    """Words that at least ``share`` of all entries have, given names excepted."""
    words = parsed.select("entry", F.explode(F.split("core", " ")).alias("w")).distinct().groupBy("w").count()
    total = parsed.select("entry").distinct().count()
    return frozenset({r["w"] for r in words.filter(F.col("count") >= share * total).select("w").collect()} - NICKNAMES.keys())


def block_keys(core: str, common: frozenset[str]) -> list[str]:
    """The blocks of a name: codes of each telling word, each with the first letter of each other word."""
    words = core.split(" ")
    telling = [w for w in words if w not in common and w not in NICKNAMES and w not in _NICK and len(w.strip(".")) > 2] or words
    keys = set()
    for word in telling:
        rest = [w for w in words if w is not word]
        initials = {n[0] for w in rest for n in (w, *_NICK.get(w, ()))} or {""}
        keys |= {f"{code}|{i}" for code in code_keys(word) for i in initials}
    if len(words) == 2:
        keys |= {f"{code}|" for code in (*code_keys("".join(words)), *code_keys("".join(words[::-1])))}
    if len(words) == 1 and len(words[0]) > 9:
        keys.add(f"{phonetic(words[0])}|")
    return sorted(keys)


def _blocks(batches: Iterator[pa.RecordBatch], common: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cores = [unjoined(c, common) for c in batch.column("core").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("series"), pa.array(cores, pa.string()), batch.column("node"), pa.array([block_keys(c, common) for c in cores], pa.list_(pa.string()))], ["series", "core", "node", "keys"])


def _alike(batches: Iterator[pa.RecordBatch], common: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [same_name(Name(tuple(a.split(" ")), "", False), Name(tuple(b.split(" ")), "", False), common) for a, b in zip(batch.column("core_a").to_pylist(), batch.column("core_b").to_pylist(), strict=True)]
        out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.float64())], ["a", "b", "likeness"])
        yield out.filter(pa.array([k > 0 for k in keep]))


def _kept(batches: Iterator[pa.RecordBatch], spelt: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names if n not in ("a", "b")}
        keep = [identifier_relation(x, y) > 0 for x, y in zip(columns["ids_a"], columns["ids_b"], strict=True)]
        if spelt:
            keep = [k and x != y for k, x, y in zip(keep, columns["spelt_a"], columns["spelt_b"], strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def unopposed(pairs: DataFrame, spelt: bool = False) -> DataFrame:
    """The pairs ``a``, ``b`` whose identifiers ``ids_a`` and ``ids_b`` don't contradict each other; with ``spelt`` only those with different ``spelt_a`` and ``spelt_b``."""
    kind = pairs.schema["a"].dataType.simpleString()
    columns = ["a", "b", "ids_a", "ids_b", *(("spelt_a", "spelt_b") if spelt else ())]
    return pairs.select(*columns).mapInArrow(lambda b: _kept(b, spelt), f"a {kind}, b {kind}")


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [sorted({t for v in x or () if (t := identifier_text(v))}) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("entry"), pa.array(ids, pa.list_(pa.string()))], ["entry", "ids"])


def class_links(accepted: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` between classes of entries that tie all of a name, and of two accepted names, whose identifiers don't contradict each other.

    accepted: ``a``, ``b``, nodes of alike names. classes: ``cls``, ``node``, ``ids``. A class without identifiers contradicts none, so where a name has one the others are tied to it
    alone: as many edges as classes, however many there are. Otherwise classes are compared in pairs.
    """
    hubs = classes.groupBy("node").agg(F.min(F.when(F.size("ids") == 0, F.col("cls"))).alias("hub"))
    side = lambda n: classes.select(F.col("node").alias(f"node_{n}"), F.col("cls").alias(n), F.col("ids").alias(f"ids_{n}"))
    alike = accepted.select(F.col("a").alias("node_a"), F.col("b").alias("node_b"))
    alike = alike.unionByName(hubs.filter("hub is null").select(F.col("node").alias("node_a"), F.col("node").alias("node_b")))
    for n in ("a", "b"):
        alike = alike.join(hubs.withColumnsRenamed({"node": f"node_{n}", "hub": f"hub_{n}"}), f"node_{n}")
    tied = alike.filter("hub_a is not null or hub_b is not null").select(F.coalesce("hub_a", "hub_b").alias("a"), F.when(F.col("hub_a").isNotNull(), F.col("node_b")).otherwise(F.col("node_a")).alias("node"))
    tied = tied.unionByName(hubs.filter("hub is not null").select(F.col("hub").alias("a"), "node")).join(classes.select("node", F.col("cls").alias("b")), "node").select("a", "b")
    compared = alike.filter("hub_a is null and hub_b is null").select("node_a", "node_b").join(side("a"), "node_a").join(side("b"), "node_b").filter("node_a <> node_b or a < b")
    return tied.unionByName(unopposed(compared)).filter("a <> b")


def name_variants(names: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of entries of one series that are one subject under different spellings.

    names: ``entry``, ``series``, ``name``, one row per spelling, none NULL. identifiers: ``entry``, ``ids`` (array of texts).
    Entries with exactly the same spellings are no pair. Repeated rows count once; empty input gives no rows. Entries of one name and the same
    identifiers are one class until the end; only the result is spelt out in pairs of entries.
    """
    parsed = written(parsed_names(names.distinct()), "names")
    common = common_words(parsed)
    nodes = parsed.select("series", "core").distinct().withColumn("node", F.xxhash64("series", "core"))
    blocks = nodes.mapInArrow(lambda b: _blocks(b, common), "series string, core string, node bigint, keys array<string>").select("node", "core", F.explode(F.transform("keys", lambda k: F.xxhash64("series", k))).alias("key"))
    blocks = written(blocks, "name-blocks")
    left, right = (blocks.select("key", F.col("node").alias(n), F.col("core").alias(f"core_{n}")) for n in ("a", "b"))
    candidates = left.join(right, "key").filter("a < b").drop("key").dropDuplicates(["a", "b"])
    accepted = written(candidates.select("a", "b", "core_a", "core_b").mapInArrow(lambda b: _alike(b, common), "a bigint, b bigint, likeness double"), "alike-names")
    kind = parsed.schema["entry"].dataType.simpleString()
    known = identifiers.select("entry", "ids").mapInArrow(_plain, f"entry {kind}, ids array<string>")
    spelt = parsed.groupBy("entry").agg(F.collect_set(F.xxhash64("series", "core")).alias("nodes"), F.array_sort(F.collect_set(F.xxhash64("name"))).alias("spelt"))
    entries = written(spelt.join(known, "entry", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>"))), "name-entries")
    members = entries.select("entry", "ids", F.explode("nodes").alias("node"))
    classes = written(members.groupBy("node", "ids").agg(F.min("entry").alias("cls")), "name-classes")
    several = entries.filter(F.size("nodes") > 1).select("entry", "ids", F.explode("nodes").alias("node")).join(classes, ["node", "ids"]).select(F.col("entry").alias("a"), F.col("cls").alias("b"))
    groups = components(class_links(accepted, classes).unionByName(several), "a", "b").withColumnRenamed("node", "cls")
    for finished in (blocks, accepted):
        discarded(finished)
    placed = members.join(classes, ["node", "ids"]).join(groups, "cls", "left").groupBy("entry").agg(F.min(F.coalesce("root", "cls")).alias("root"))
    placed = written(entries.drop("nodes").join(placed, "entry"), "name-groups")
    left, right = (placed.select("root", F.col("entry").alias(n), F.col("ids").alias(f"ids_{n}"), F.col("spelt").alias(f"spelt_{n}")) for n in ("a", "b"))
    return unopposed(left.join(right, "root").filter("a < b"), spelt=True)
