"""Fetching of addresses as a distributed job, with the transport given by the caller.

Tables of addresses go in and tables of results come out; what opens an address is a function, so
the same job runs against a network, a folder or a table of stored answers.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BYTES = 32 * 1024 * 1024
#: Statuses that may pass by themselves.
TRANSIENT = frozenset({408, 425, 429, *range(500, 600)})
RESULT = "address string, state string, status int, content binary, sha256 string, etag string, modified string, attempts int, error string"


class Answer(NamedTuple):
    """What a transport gives for an address."""

    status: int
    content: bytes = b""
    etag: str | None = None
    modified: str | None = None


Transport = Callable[[str, str | None, str | None], Answer]


def retried(operation: Callable[[], Answer], attempts: int, pause: Callable[[int], None]) -> tuple[Answer | None, int, str | None]:
    """The answer, the attempts made and the error: only transient statuses and broken connections are tried again."""
    error = None
    for n in range(1, attempts + 1):
        try:
            answer = operation()
            if answer.status not in TRANSIENT:
                return answer, n, None
            error = f"status {answer.status}"
        except OSError as e:
            answer, error = None, f"{type(e).__name__}: {e}"
        if n < attempts:
            pause(n)
    return answer, attempts, error


def fetched(addresses: DataFrame, transport: Transport, hosts: frozenset[str], attempts: int = 3, most: int = MAX_BYTES, seconds: float = 1.0) -> DataFrame:
    """A row per address (address, etag, modified of the last time, both may be NULL) with its state: new, unchanged, refused (other host, no https), too_large or failed.

    Every failure is a row, so all are seen before any is acted upon.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for address, etag, modified in zip(batch.address, batch.etag, batch.modified, strict=True):
                parts = urlparse(address or "")
                if parts.scheme != "https" or parts.hostname not in hosts:
                    rows.append((address, "refused", None, None, None, etag, modified, 0, "host or scheme is not allowed"))
                    continue
                answer, tried, error = retried(lambda a=address, e=etag, m=modified: transport(a, e, m), attempts, lambda n: time.sleep(seconds * n))
                if answer is None or error or answer.status >= 400:
                    rows.append((address, "failed", answer and answer.status, None, None, etag, modified, tried, error or f"status {answer.status}"))
                elif answer.status == 304:
                    rows.append((address, "unchanged", 304, None, None, etag, modified, tried, None))
                elif len(answer.content) > most:
                    rows.append((address, "too_large", answer.status, None, None, etag, modified, tried, f"{len(answer.content)} bytes"))
                else:
                    rows.append((address, "new", answer.status, answer.content, hashlib.sha256(answer.content).hexdigest(), answer.etag, answer.modified, tried, None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"status": "Int32", "attempts": "Int32"})

    return addresses.select("address", "etag", "modified").mapInPandas(run, RESULT)


def paged(spark: SparkSession, read: Callable[[int], DataFrame | None], key: list[str], most: int) -> DataFrame | None:
    """The union of numbered pages until one is empty, missing or brings nothing new, or ``most`` are read; one row per key."""
    found = None
    for number in range(1, most + 1):
        page = read(number)
        if page is None or page.isEmpty():
            break
        if found is not None and page.join(found.select(*key), key, "left_anti").isEmpty():
            break
        found = page if found is None else found.unionByName(page)
    return found.dropDuplicates(key) if found is not None else None


def answers_from(table: DataFrame, queries: DataFrame, on: str) -> DataFrame:
    """Stored answers (key, payload) for queries; without one the payload is NULL and ``state`` is unanswered."""
    joined = queries.join(table.select(F.col("key").alias(on), "payload").dropDuplicates([on]), on, "left")
    return joined.withColumn("state", F.when(F.col("payload").isNull(), "unanswered").otherwise("answered"))
