"""Queries of the operators for training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import addresses, encoding, leakage, linkage, names, packing
from tabularium.llm.entries import by_first_row, entry_names
from tabularium.session import written
from tabularium.sources.tables import table


def _address_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    offices = addresses.address_parts(table(spark, sf_dir, "establishment_observation"), "establishment_observation_id", "full_address_raw")
    reviewed = table(spark, sf_dir, "address_review").filter(F.col("review_street").isNotNull())
    return offices.unionByName(addresses.address_parts(reviewed, "address_id", "review_municipality", "review_street", "review_civic"))


def _identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = by_first_row(table(spark, sf_dir, "identifier_observation"), table(spark, sf_dir, "entity_observation"), "normalised_value")
    return rows.groupBy("entry").agg(F.collect_set("normalised_value").alias("ids"))


FAMILIES = ("prefecture_list", "procurement_roll")


def p1_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of both families of lists that are one subject, with the confidence."""
    observations, editions = table(spark, sf_dir, "entity_observation"), table(spark, sf_dir, "source_edition")
    spelt = written(names.parsed_names(entry_names(observations, editions)), "spelt")
    common = names.common_words(spelt)
    family = table(spark, sf_dir, "source_series").select(F.col("source_series_key").alias("series"), F.col("source_family").alias("side")).filter(F.col("side").isin(*FAMILIES))
    named = spelt.join(family, "series").groupBy("entry").agg(F.min("side").alias("side"), F.collect_set("core").alias("names"))
    offices = by_first_row(table(spark, sf_dir, "establishment_observation"), observations, "full_address_raw").groupBy("entry").agg(F.collect_set("full_address_raw").alias("addresses"))
    profiles = named.join(_identifiers(spark, sf_dir), "entry", "left").join(offices, "entry", "left")
    links = linkage.linked_records(profiles, FAMILIES, common)
    return links.select(F.least("a", "b").alias("entry_id_1"), F.greatest("a", "b").alias("entry_id_2"), "pattern", "confidence")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of an entry of a prefecture list and an entry of a procurement roll that are one subject."""
    return p1_links(spark, sf_dir).select("entry_id_1", "entry_id_2")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of entries of one series that are one subject under different spellings."""
    spelt = entry_names(table(spark, sf_dir, "entity_observation"), table(spark, sf_dir, "source_edition"))
    pairs = names.name_variants(spelt, _identifiers(spark, sf_dir))
    return pairs.select(F.col("a").alias("entry_id_1"), F.col("b").alias("entry_id_2"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of address records of one location."""
    return addresses.pairs_of(addresses.locations(_address_parts(spark, sf_dir)), "record", "location", "address_record_1", "address_record_2")


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in containers of each kind."""
    return packing.packed_kinds(table(spark, sf_dir, "documents"), table(spark, sf_dir, "token_container"))


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of evaluation items, with the words covered and where they stand."""
    return leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of evaluation items."""
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id")


def p8_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of evaluation items, without these."""
    return leakage.cleaned_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled documents with their text restored as far as possible."""
    return encoding.garbled_texts(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a garbled passage."""
    return p9_restored(spark, sf_dir).select("doc_id").distinct()


QUERIES = {"p7_packed": p7_packed, "p9_found": p9_found, "p9_restored": p9_restored, "p8_found": p8_found, "p8_leaks": p8_leaks, "p8_cleaned": p8_cleaned, "p1_found": p1_found, "p1_links": p1_links, "p4_found": p4_found, "p5_found": p5_found}
SQL: dict[str, str] = {}
