"""Readers for the supplied parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tabularium.session import shipped


def catalogued(spark: SparkSession, name: str, order: Sequence[str] = (), most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A table of the catalog, ordered and cut to a preview if asked for, and its columns with type and whether they can be NULL; an error if the catalog has none of that name."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"the catalog has no table {name}")
    columns = [(n, c.name, c.dataType, c.nullable) for n, c in enumerate(spark.catalog.listColumns(name))]
    rows = spark.table(name)
    rows = rows.orderBy(*order) if order else rows
    return rows if most is None else rows.limit(most), spark.createDataFrame(columns, "position int, name string, type string, nullable boolean")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the folder ``sf_dir``."""
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
