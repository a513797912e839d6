"""Writers: spreadsheets-safe CSV, long tables, manifests, packed payloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.scalars import display_list
from tabularium.operators.metrics import content_fingerprint
from tabularium.operators.supersede import append_conflicts, to_append
from tabularium.operators.validate import require_none
from tabularium.session import written


def guarded(text: Column) -> Column:
    """A text that no spreadsheet takes for a formula."""
    return F.when(text.rlike(r"^[=+@\-\t\r]"), F.concat(F.lit("'"), text)).otherwise(text)


def for_csv(rows: DataFrame) -> DataFrame:
    """Rows as they go into CSV: texts guarded, lists of texts in one cell, other nested values as JSON."""
    cells = []
    for f in rows.schema:
        kind = f.dataType.simpleString()
        if kind == "string":
            cells.append(guarded(F.col(f.name)).alias(f.name))
        elif kind == "array<string>":
            cells.append(guarded(display_list(F.col(f.name))).alias(f.name))
        elif kind.startswith(("array", "struct", "map")):
            cells.append(F.to_json(f.name).alias(f.name))
        else:
            cells.append(F.col(f.name))
    return rows.select(*cells)


def write_csv(rows: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """CSV with a header, quotes doubled, ordered if columns are given."""
    out = for_csv(rows)
    (out.orderBy(*order) if order else out).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def append_once(rows: DataFrame, path: str, key: Sequence[str]) -> int:
    """Rows added to a parquet table whose key it lacks; an error, and nothing written, if a key stands with other content. The number added.

    Running it again with the same rows adds nothing.
    """
    spark = rows.sparkSession
    try:
        existing = spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        existing = spark.createDataFrame([], rows.schema)
    values = [c for c in rows.columns if c not in key]
    require_none(append_conflicts(existing, rows, key, values), "key with other content")
    fresh = to_append(existing, rows, key)
    count = fresh.count()
    if count:
        fresh.write.mode("append").parquet(path)
    return count


def payload(rows: DataFrame, key: str) -> DataFrame:
    """Each row as one JSON text, NULLs kept: key, payload, sha256."""
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(key, text.alias("payload"), F.sha2(text, 256).alias("sha256"))


def manifest(files: DataFrame) -> DataFrame:
    """Sizes and hashes of binary files for a later check: path, byte_size, sha256."""
    return files.select("path", F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256"))


def archived_objects(files: DataFrame, path: str) -> DataFrame:
    """Contents put into a store under their SHA-256, each once, and read back: sha256, byte_size, ``created`` (not there before), ``verified``.

    files: ``content``. The store is a parquet table with the digest as its key, so writing again adds nothing and a content never replaces another.
    """
    spark = files.sparkSession
    given = files.filter(F.col("content").isNotNull()).select(F.sha2("content", 256).alias("sha256"), F.length("content").cast("bigint").alias("byte_size"), "content").dropDuplicates(["sha256"])
    try:
        held = written(spark.read.parquet(path).select("sha256"), "held")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        held = spark.createDataFrame([], "sha256 string")
    given.join(held, "sha256", "left_anti").withColumn("shelf", F.substring("sha256", 1, 2)).write.mode("append").partitionBy("shelf").parquet(path)
    back = spark.read.parquet(path).select("sha256", (F.sha2("content", 256) == F.col("sha256")).alias("verified"))
    asked = given.select("sha256", "byte_size").join(held.withColumn("_held", F.lit(True)), "sha256", "left")
    return asked.join(back, "sha256", "left").select("sha256", "byte_size", F.col("_held").isNull().alias("created"), F.coalesce("verified", F.lit(False)).alias("verified"))


def exported_bundle(tables: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Tables written side by side with a manifest of their counts and content hashes, from which they can be restored: the manifest."""
    marks = None
    for name, rows in tables.items():
        rows.write.mode("errorifexists").parquet(f"{path}/{name}")
        mark = content_fingerprint(rows.sparkSession.read.parquet(f"{path}/{name}"), []).select(F.lit(name).alias("table_name"), "n", "hash_xor", "hash_sum")
        marks = mark if marks is None else marks.unionByName(mark)
    marks.coalesce(1).write.mode("errorifexists").parquet(f"{path}/_manifest_")
    return marks.sparkSession.read.parquet(f"{path}/_manifest_")


def restored_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a bundle; an error if one is missing or not what the manifest says."""
    manifest = spark.read.parquet(f"{path}/_manifest_")
    out = {r["table_name"]: spark.read.parquet(f"{path}/{r['table_name']}") for r in manifest.collect()}
    for name, rows in out.items():
        found = content_fingerprint(rows, []).select(F.lit(name).alias("table_name"), "n", "hash_xor", "hash_sum")
        require_none(manifest.filter(F.col("table_name") == name).exceptAll(found), f"{name} is not what was exported")
    return out
