"""Exact linkage of addresses to a reference of streets and accesses, and the choice among results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.fold import unaccented
from tabularium.functions.scalars import street_and_civic
from tabularium.operators.relations import top_one

#: First words of street names and the type each stands for, in the order in which they are tried.
ROAD_TYPES = (
    ("strada statale", "ss"), ("s s", "ss"), ("ss", "ss"), ("strada provinciale", "sp"), ("s p", "sp"), ("sp", "sp"), ("c da", "contrada"), ("cda", "contrada"), ("contrada", "contrada"), ("p zza", "piazza"), ("pzza", "piazza"), ("piazza", "piazza"),
    ("piazzale", "piazzale"), ("localita", "localita"), ("loc", "localita"), ("frazione", "frazione"), ("fraz", "frazione"), ("viale", "viale"), ("via", "via"), ("corso", "corso"), ("strada", "strada"), ("vicolo", "vicolo"), ("vico", "vico"), ("largo", "largo"), ("rione", "rione"),
)


def street_key(text: Column) -> Column:
    """A street's type and words for equality joins: ``type|words``; unspecified without a known type, empty without words."""
    spelt = F.array_join(F.regexp_extract_all(unaccented(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), " ")
    pattern = rf"^(?:({'|'.join(p for p, _ in ROAD_TYPES)})(?: |$))?(.*)$"
    kinds = F.create_map(*[F.lit(x) for pair in ROAD_TYPES for x in pair])
    words = F.regexp_extract(spelt, pattern, 2)
    return F.when(words == "", "").otherwise(F.concat_ws("|", F.coalesce(F.try_element_at(kinds, F.regexp_extract(spelt, pattern, 1)), F.lit("unspecified")), words))


def linked_to_reference(addresses: DataFrame, reference: DataFrame) -> DataFrame:
    """Addresses (address_id, municipality_code, street) with the reference's coordinates where the link is exact.

    reference: municipality_code, street, street_id, civic, latitude, longitude. Only streets that an address asks for are read on,
    by a semi-join on municipality and key. Result: address_id, status (no_street, ambiguous_street, civic, ambiguous_civic, street_only), latitude, longitude; a street
    without the civic number takes the median of its accesses.
    """
    parts = street_and_civic(F.col("street"))
    asked = addresses.select("address_id", "municipality_code", parts.alias("_p")).select("address_id", "municipality_code", street_key(F.col("_p.street")).alias("_key"), F.concat_ws("/", "_p.number", "_p.suffix").alias("_civic"), F.col("_p.number").alias("_number"))
    asked = asked.withColumn("_civic", F.when(F.col("_number").isNotNull(), F.col("_civic"))).drop("_number")
    known = reference.withColumn("_key", street_key(F.col("street"))).filter("_key <> ''").join(asked.select("municipality_code", "_key").distinct(), ["municipality_code", "_key"], "left_semi")
    streets = known.groupBy("municipality_code", "_key").agg(F.count_distinct("street_id").alias("_streets"), F.median("latitude").alias("_lat"), F.median("longitude").alias("_lon"))
    civic = F.upper(F.regexp_replace(F.trim("civic"), r"^0+(\d)|\s", "$1"))
    accesses = known.filter(F.col("civic").isNotNull()).groupBy("municipality_code", "_key", civic.alias("_civic")).agg(F.count_distinct(F.struct("latitude", "longitude")).alias("_points"), F.min("latitude").alias("_clat"), F.min("longitude").alias("_clon"))
    joined = asked.join(streets, ["municipality_code", "_key"], "left").join(accesses, ["municipality_code", "_key", "_civic"], "left")
    status = F.when(F.col("_streets").isNull(), "no_street").when(F.col("_streets") > 1, "ambiguous_street").when(F.col("_points") == 1, "civic").when(F.col("_points") > 1, "ambiguous_civic").otherwise("street_only")
    point = lambda c, s: F.when(status == "civic", F.col(c)).when(status == "street_only", F.col(s))
    return joined.select("address_id", status.alias("status"), point("_clat", "_lat").alias("latitude"), point("_clon", "_lon").alias("longitude"))


def best_results(results: DataFrame, address: str, ranks: Mapping[str, Sequence[str]], newest: str, id_: str) -> DataFrame:
    """One result per address: by the rank of several columns' values (unlisted last), then the newest, then the id."""
    order: list[Column] = [F.coalesce(*[F.when(F.col(c) == v, F.lit(i)) for i, v in enumerate(values)], F.lit(len(values))) for c, values in ranks.items()]
    return top_one(results, [address], [*order, F.col(newest).desc_nulls_last(), F.col(id_)])


def country(explicit: Column, prefix_status: Column, foreign_marker: Column, home: str = "IT") -> Column:
    """The country of an address: as stated, else home for a municipality's prefix, else a marker's, else NULL."""
    return F.coalesce(F.nullif(F.upper(F.trim(explicit)), F.lit("")), F.when(prefix_status == "unique", F.lit(home)), foreign_marker)
