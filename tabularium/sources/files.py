"""Readers of files: delimited text with a checked header, JSON lines, geocoding JSON, workbooks, word-processor tables, archives, hashed objects."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.session import shipped


def delimited(spark: SparkSession, path: str, columns: Sequence[str], separator: str = ";") -> DataFrame:
    """A delimited file as texts; its header must have the given columns, a byte-order mark before the first is dropped. Filters and projections reach the scan."""
    head = spark.read.option("sep", separator).option("header", True).csv(path)
    names = [c.lstrip("﻿").strip() for c in head.columns]
    if missing := [c for c in columns if c not in names]:
        raise ValueError(f"header lacks {', '.join(missing)}")
    return head.toDF(*names).select(*columns)


def json_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One object per line in a declared type; malformed lines are kept in ``_corrupt_record``."""
    return spark.read.schema(f"{ddl}, _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def objects(spark: SparkSession, path: str) -> DataFrame:
    """Binary files with their content hash: path, length, content, sha256."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def verified(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """A manifest (sha256, byte_size) with the state of each object: verified, damaged (other size) or missing."""
    seen = found.groupBy("sha256").agg(F.min("length").alias("_length"))
    joined = manifest.join(seen, "sha256", "left")
    return joined.withColumn("state", F.when(F.col("_length").isNull(), "missing").when(F.col("_length") != F.col("byte_size"), "damaged").otherwise("verified")).drop("_length")


def bundle_members(found: DataFrame, pinned: DataFrame, bundle: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The content of each labelled member of bundles, found by its pinned hash, and the members that are not there: a bundle without all of them is not to be used.

    found: ``sha256``, ``content``, as ``objects`` gives them. pinned: bundle, ``label``, ``sha256``. A single source is a bundle of one member.
    """
    held = found.select("sha256", "content").dropDuplicates(["sha256"])
    lacking = pinned.join(held.select("sha256"), "sha256", "left_anti")
    whole = pinned.join(lacking.select(*bundle).distinct(), list(bundle), "left_anti")
    return whole.join(held, "sha256").select(*bundle, "label", "sha256", "content"), lacking.select(*bundle, "label", "sha256")


def bundle_digest(members: DataFrame, bundle: Sequence[str], label: str, sha256: str) -> DataFrame:
    """One digest per bundle, of its members' hashes in order of their labels."""
    hashes = F.transform(F.array_sort(F.collect_list(F.struct(label, sha256))), lambda m: m[sha256])
    return members.groupBy(*bundle).agg(F.concat(F.lit("bundle:"), F.sha2(F.array_join(hashes, ""), 256)).alias("digest"))


def geocode_candidates(rows: DataFrame, payload: str) -> DataFrame:
    """Candidates of a FeatureCollection in order: rank from 1, label, latitude, longitude, kind, municipality, country_code; malformed payloads give none."""
    ddl = "features array<struct<geometry:struct<coordinates:array<double>>,properties:struct<geocoding:map<string,string>>>>"
    parsed = F.from_json(F.col(payload), ddl)
    fields = lambda *names: F.coalesce(*[F.nullif(F.trim(F.try_element_at(F.col("f.properties.geocoding"), F.lit(n))), F.lit("")) for n in names])
    exploded = rows.select(*[c for c in rows.columns if c != payload], F.posexplode(parsed["features"]).alias("_pos", "f"))
    return exploded.select(
        *[c for c in rows.columns if c != payload],
        (F.col("_pos") + 1).alias("rank"),
        fields("label", "name").alias("label"),
        F.try_element_at("f.geometry.coordinates", F.lit(2)).alias("latitude"),
        F.try_element_at("f.geometry.coordinates", F.lit(1)).alias("longitude"),
        fields("type", "osm_value").alias("kind"),
        fields("city", "town", "village", "municipality").alias("municipality"),
        F.upper(fields("country_code")).alias("country_code"),
    )


_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def workbook_cells(content: bytes) -> Iterator[tuple[str, int, str, str]]:
    """(sheet, row, column letters, text) of every filled cell of a workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet"):
            target = targets[sheet.get(f"{_R}id")]
            part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            for cell in ElementTree.fromstring(z.read(part)).iter(f"{_S}c"):
                place = re.match(r"([A-Z]+)(\d+)", cell.get("r", ""))
                value = cell.find(f"{_S}v")
                text = "".join(t.text or "" for t in cell.iter(f"{_S}t")) if cell.get("t") == "inlineStr" else (value.text or "") if value is not None else ""
                if cell.get("t") == "s" and text:
                    text = shared[int(text)]
                if place and text:
                    yield sheet.get("name", ""), int(place[2]), place[1], text


def document_table_cells(content: bytes) -> Iterator[tuple[int, int, int, str]]:
    """(table, row, cell, text) of the tables of a word-processor document."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
    for n, table in enumerate(body.iter(f"{_W}tbl")):
        for r, row in enumerate(table.findall(f"{_W}tr")):
            for c, cell in enumerate(row.findall(f"{_W}tc")):
                yield n, r, c, "\n".join("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in cell.iter(f"{_W}p")).strip()


def archive_members(content: bytes, suffix: str) -> tuple[str, bytes]:
    """Name and content of the one member of an archive with a suffix; none or several are an error."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        found = [n for n in z.namelist() if n.lower().endswith(suffix)]
        if len(found) != 1:
            raise ValueError(f"{len(found)} members end in {suffix}")
        return found[0], z.read(found[0])


Parser = Callable[[str, bytes, Mapping[str, str]], Iterator[dict]]
#: Parsers of files by name: (path, content, settings) to records.
PARSERS: dict[str, Parser] = {}


def parser(name: str) -> Callable[[Parser], Parser]:
    """Registers a parser under a name; a second one of the same name is an error."""

    def register(function: Parser) -> Parser:
        if PARSERS.setdefault(name, function) is not function:
            raise ValueError(f"parser {name} is registered twice")
        return function

    return register


@parser("workbook")
def _workbook(path: str, content: bytes, settings: Mapping[str, str]) -> Iterator[dict]:
    rows: dict[tuple[str, int], dict[str, str]] = {}
    for sheet, row, column, text in workbook_cells(content):
        rows.setdefault((sheet, row), {})[column] = text
    header: dict[str, str] | None = None
    for _, cells in sorted(rows.items()):
        if header is None:
            header = cells
        else:
            yield {header[c]: v for c, v in cells.items() if c in header}


@parser("document_tables")
def _document_tables(path: str, content: bytes, settings: Mapping[str, str]) -> Iterator[dict]:
    rows: dict[tuple[int, int], dict[int, str]] = {}
    for table, row, cell, text in document_table_cells(content):
        rows.setdefault((table, row), {})[cell] = text
    for (table, row), cells in sorted(rows.items()):
        header = rows[table, 0]
        if row:
            yield {header.get(c, str(c)): v for c, v in cells.items()}


@parser("html_tables")
def _html_tables(path: str, content: bytes, settings: Mapping[str, str]) -> Iterator[dict]:
    from tabularium.sources.html import tables

    for rows in tables(content.decode(settings.get("encoding", "utf-8"), "replace")):
        for row in rows[1:]:
            yield dict(zip(rows[0], row, strict=False))


def parsed_files(files: DataFrame, name: Column | str, settings: Mapping[str, str] | None = None) -> DataFrame:
    """Records of binary files (path, content) by the parser named for each: path, parser, position, record (map of texts), error.

    A file that can't be read gives one row with its error and no record, so one bad file stops nothing.
    """
    shipped(files.sparkSession)
    chosen = files.select("path", "content", (F.col(name) if isinstance(name, str) else name).alias("parser"))
    given = dict(settings or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content, which in zip(batch.path, batch.content, batch.parser, strict=True):
                try:
                    records = list(PARSERS[which](path, bytes(content), given))
                    rows += [(path, which, n, {str(k): str(v) for k, v in r.items()}, None) for n, r in enumerate(records)]
                except Exception as e:  # noqa: BLE001
                    rows.append((path, which, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "parser", "position", "record", "error"]).astype({"position": "Int32"})

    return chosen.mapInPandas(run, "path string, parser string, position int, record map<string,string>, error string")
