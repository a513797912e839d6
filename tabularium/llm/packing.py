"""Filling containers of fixed capacity with documents, none split unless it exceeds the capacity.

Shortest-pack-first over the histogram of lengths: lengths are placed from the longest down, each
into the emptiest packs that can hold it, as counts of packing patterns and not of documents; the
finished patterns are joined back to the documents by their rank within their length.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.session import shipped, written

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the word pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 500_000
RANK_BUCKETS = 64


class _Counts(dict):
    """Tokens of ``" " + word`` by word, counted when first asked for."""

    def __init__(self, encode) -> None:
        super().__init__()
        self._encode = encode

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self._encode(" " + word))
        return n


class TokenCounter:
    """Counts the tokens of texts by a byte-level BPE vocabulary.

    A space before a visible character always begins a new word of the pattern, so a text with single spaces is the sum of
    its space-separated pieces, and each piece is encoded once. Other texts are encoded whole.
    """

    def __init__(self, vocabulary: str) -> None:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(vocabulary).read_bytes().splitlines() if line)}
        self._encode = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._counts = _Counts(self._encode)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = text.split(" ")
        if "" in pieces or any(p[0].isspace() for p in pieces):
            return len(self._encode(text))
        if len(self._counts) > CACHED_WORDS:
            self._counts.clear()
        return len(self._encode(pieces[0])) + sum(map(self._counts.__getitem__, pieces[1:]))


@lru_cache(maxsize=2)
def _counter(vocabulary: str) -> TokenCounter:
    return TokenCounter(vocabulary)


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and ``n_tokens``, the tokens of the whole text; a NULL or empty text has none."""
    shipped(documents.sparkSession)
    documents.sparkSession.sparkContext.addFile(vocabulary)
    name = Path(vocabulary).name

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(SparkFiles.get(name))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([counter(t) for t in batch.column("text").to_pylist()], pa.int64())], ["doc_id", "n_tokens"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(count, "doc_id bigint, n_tokens bigint")


def packing_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with the number of packs of each, by shortest-pack-first from the longest length down.

    Work and result follow the number of different lengths, not of items. Lengths are from 1 to ``capacity``.
    """
    open_: dict[int, list[list]] = defaultdict(list)
    emptiest: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def add(pattern: tuple[int, ...], packs: int) -> None:
        left = capacity - sum(pattern)
        if left:
            if not open_[left]:
                heapq.heappush(emptiest, -left)
            open_[left].append([pattern, packs])
        else:
            done.append((pattern, packs))

    for length in sorted(histogram, reverse=True):
        items = histogram[length]
        fresh: list[tuple[tuple[int, ...], int]] = []
        while items and emptiest and -emptiest[0] >= length:
            left = -emptiest[0]
            pattern, packs = open_[left].pop()
            each = min(left // length, max(1, items // packs))
            used = min(packs, items // each)
            if used < packs:
                open_[left].append([pattern, packs - used])
            if not open_[left]:
                heapq.heappop(emptiest)
            items -= used * each
            fresh.append((pattern + (length,) * each, used))
        each = capacity // length
        if items and not (emptiest and -emptiest[0] >= length):
            if items // each:
                fresh.append(((length,) * each, items // each))
            if items % each:
                fresh.append(((length,) * (items % each), 1))
        for pattern, packs in fresh:
            add(pattern, packs)
    return done + [(p, n) for rest in open_.values() for p, n in rest]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, first container, items per container, place in the container), by rising rank."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    first = 0
    for pattern, packs in patterns:
        at = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            out[length].append((used[length], first, each, at))
            used[length] += each * packs
            at += each * length
        first += packs
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def ranked(items: DataFrame, by: str, order: str, buckets: int = RANK_BUCKETS) -> DataFrame:
    """``items`` with ``rank``, a number from 0 within each value of ``by``; a value that very many rows share is spread over buckets."""
    salted = items.withColumn("_b", F.pmod(F.xxhash64(order), F.lit(buckets)))
    counts = salted.groupBy(by, "_b").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).select(by, "_b", F.coalesce("_before", F.lit(0)).alias("_before"))
    within = salted.withColumn("_r", F.row_number().over(Window.partitionBy(by, "_b").orderBy(order)) - 1)
    return within.join(before, [by, "_b"]).withColumn("rank", F.col("_r") + F.col("_before")).drop("_b", "_r", "_before")


def packed(sizes: DataFrame, capacity: int) -> DataFrame:
    """Every document's place: ``container_id``, ``doc_id``, ``piece``, ``first_token``, ``n_tokens``, ``place`` (tokens before it in the container).

    sizes: ``doc_id`` and ``n_tokens``, best a written table. Only a document longer than ``capacity`` has several pieces, all full but the last.
    A document without tokens takes no room: its ``container_id`` and ``place`` are NULL. The histogram has at most ``capacity`` lengths, so what
    reaches the driver is bounded by that.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    pieces = sizes.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / capacity).cast("int") - 1))).alias("piece"))
    pieces = pieces.select("doc_id", "piece", (F.col("piece") * F.lit(capacity).cast("bigint")).alias("first_token"), F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - F.col("piece") * capacity).alias("n_tokens"))
    histogram = {r["n_tokens"]: r["count"] for r in pieces.filter("n_tokens > 0").groupBy("n_tokens").count().collect()}
    where = places(packing_patterns(histogram, capacity))
    item = pieces.withColumn("_item", F.xxhash64("doc_id", "piece")).filter("n_tokens > 0")
    rows = ranked(item, "n_tokens", "_item").select("doc_id", "piece", "first_token", "n_tokens", "rank")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("n_tokens").to_numpy(), batch.column("rank").to_numpy()
            container, place = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                table = where[int(n)]
                row = table[np.searchsorted(table[:, 0], rank[at], "right") - 1]
                step = rank[at] - row[:, 0]
                container[at], place[at] = row[:, 1] + step // row[:, 2], row[:, 3] + step % row[:, 2] * n
            yield pa.RecordBatch.from_arrays([pa.array(container), *(batch.column(c) for c in ("doc_id", "piece", "first_token", "n_tokens")), pa.array(place)], ["container_id", "doc_id", "piece", "first_token", "n_tokens", "place"])

    placed = rows.mapInArrow(assign, "container_id bigint, doc_id bigint, piece int, first_token bigint, n_tokens bigint, place bigint")
    empty = pieces.filter("n_tokens = 0").select(F.lit(None).cast("bigint").alias("container_id"), "doc_id", "piece", "first_token", "n_tokens", F.lit(None).cast("bigint").alias("place"))
    return placed.unionByName(empty)


def packed_kinds(documents: DataFrame, kinds: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``packed`` for each kind of container: ``container_kind``, ``capacity_tokens`` and the places. Kinds without a positive capacity are left out."""
    spark: SparkSession = documents.sparkSession
    sizes = written(token_counts(documents, vocabulary), "token-counts")
    out = None
    for kind in kinds.filter("capacity_tokens > 0").distinct().orderBy("container_kind", "capacity_tokens").collect():
        one = packed(sizes, kind["capacity_tokens"]).select(F.lit(kind["container_kind"]).alias("container_kind"), F.lit(kind["capacity_tokens"]).alias("capacity_tokens"), "*")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "container_kind string, capacity_tokens int, container_id bigint, doc_id bigint, piece int, first_token bigint, n_tokens bigint, place bigint")
