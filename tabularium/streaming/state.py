"""Streams of checks and events: state by key, idempotent micro-batches, windows with late data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tabularium.sinks.tables import append_once

RESOURCE_OUT = "key string, checks bigint, changes bigint, digest string, last_change timestamp"
_RESOURCE_STATE = "checks bigint, changes bigint, digest string, last_change timestamp"


def _resource(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    checks, changes, digest, last = state.get if state.exists else (0, 0, None, None)
    for batch in batches:
        for at, content in batch.sort_values("at")[["at", "digest"]].itertuples(index=False):
            checks += 1
            if content is not None and content == content and content != digest:
                changes, digest, last = changes + 1, content, at
    state.update((checks, changes, digest, last))
    yield pd.DataFrame({"key": [key[0]], "checks": [checks], "changes": [changes], "digest": [digest], "last_change": [last]})


def resource_state(checks: DataFrame) -> DataFrame:
    """The state of each resource after each micro-batch of checks (key, at, digest; a NULL digest is a failed check, which keeps the state)."""
    return checks.groupBy("key").applyInPandasWithState(_resource, RESOURCE_OUT, _RESOURCE_STATE, "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, at: str, by: Sequence[str], window: str, late: str) -> DataFrame:
    """Counts per window of event time; events later than ``late`` behind the latest seen are left out."""
    return events.withWatermark(at, late).groupBy(F.window(at, window), *by).agg(F.count("*").alias("n")).select("window.start", "window.end", *by, "n")


def append_batches(stream: DataFrame, path: str, key: Sequence[str], checkpoint: str) -> StreamingQuery:
    """A stream appended to a table, every key once, also when a batch is delivered again after a failure; ends when the input at hand is done."""

    def write(batch: DataFrame, number: int) -> None:
        append_once(batch.dropDuplicates(list(key)), path, key)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def recounted_batches(stream: DataFrame, path: str, at: str, by: Sequence[str], window: str, checkpoint: str) -> StreamingQuery:
    """Counts per window of event time kept in a table, however late a row comes: each micro-batch adds its own part under its number, and ``recounted`` adds the parts up.

    A batch delivered again after a failure replaces its part, so nothing counts twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy(F.window(at, window).alias("w"), *by).agg(F.count("*").alias("n")).select("w.start", "w.end", *by, "n").write.mode("overwrite").parquet(f"{path}/part={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def recounted(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """The counts of ``recounted_batches`` so far: start, end, by, n."""
    return spark.read.option("basePath", path).parquet(path).groupBy("start", "end", *by).agg(F.sum("n").alias("n"))
