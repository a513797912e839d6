"""Numbers and running totals over one order of all rows, without gathering them in one task.

Rows are sorted by range partitions and written; each partition counts for itself, and what stands before a partition is
added from a table with one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.session import written


def running_total(rows: DataFrame, order: Sequence[Column | str], amount: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over all rows before each by ``order``, 0 for the first. Rows of equal order come in any sequence; NULL amounts count 0."""
    # sorted as written, so a row's place in its file's partition is its place in the order
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id(), "_amount": F.coalesce(amount, F.lit(0))}), "ordered")
    parts = placed.groupBy("_part").agg(F.sum("_amount").alias("_sum"))
    # one row per partition of the order
    before = parts.select("_part", F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("_amount").over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("_inside", inside).join(before, "_part").withColumn(name, F.col("_before") + F.col("_inside")).select(*rows.columns, name)


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``rows`` with their number by ``order``, from 0; the order should have no ties."""
    return running_total(rows, order, F.lit(1).cast("bigint"), name)
