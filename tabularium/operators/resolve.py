"""Conservative resolution of observations to subjects: an identifier links only while it is unambiguous."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.operators.components import components


def ambiguous_values(observations: DataFrame, name: str, identifier: str) -> DataFrame:
    """Identifiers seen under more than one name."""
    return observations.filter(F.col(identifier).isNotNull()).groupBy(identifier).agg(F.count_distinct(name).alias("names")).filter("names > 1").select(identifier)


def unambiguous(observations: DataFrame, name: str, identifier: str) -> DataFrame:
    """Observations whose identifier names one subject only."""
    return observations.filter(F.col(identifier).isNotNull()).join(ambiguous_values(observations, name, identifier), identifier, "left_anti")


def safe_links(observations: DataFrame, name: str, identifier: str, date: str) -> DataFrame:
    """Unambiguous observations with a name and only one row per identifier and date."""
    w = Window.partitionBy(identifier, date)
    named = unambiguous(observations, name, identifier).filter(F.trim(name) != "")
    return named.withColumn("_n", F.count("*").over(w)).filter("_n = 1").drop("_n")


def resolved(observations: DataFrame, id_: str, name: str, identifier: str, strong: Column | None = None) -> DataFrame:
    """Each observation with its subject: observations of one name that share an unambiguous identifier are one, also over several steps, by connected components.

    An observation may have several rows, one per identifier, and joins what shares any of them. strong: which identifiers may link. Edges run from an
    observation to its (name, identifier), so a group of any size gives as many edges as rows. ``subject`` is the least observation of the component, and
    NULL, unresolved, for an observation without any identifier that links.
    """
    linking = observations if strong is None else observations.filter(strong)
    safe = unambiguous(linking, name, identifier).filter(F.col(name).isNotNull() & F.col(id_).isNotNull())
    node = F.concat(F.lit("~"), F.sha2(F.concat_ws("\x1f", name, identifier), 256))
    edges = safe.select(F.concat(F.lit("!"), F.lpad(F.col(id_).cast("string"), 20, "0")).alias("a"), node.alias("b"))
    number = lambda c: F.regexp_extract(c, r"^!0*(\d+)$", 1).try_cast("bigint")
    roots = components(edges, "a", "b").withColumn(id_, number("node")).filter(F.col(id_).isNotNull())
    return observations.select(id_).distinct().join(roots.select(id_, number("root").alias("subject")), id_, "left").select(id_, "subject")
