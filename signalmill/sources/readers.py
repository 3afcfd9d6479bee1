"""Readers of messy files: delimited text in unsure encodings, workbooks, feeds, line lists, keyed JSON maps."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENCODINGS = ("UTF-8", "windows-1252", "ISO-8859-1")


#: Characters of windows-1252 by the ISO-8859-1 character of the same byte. (Spark reads only the latter.)
_WINDOWS = {chr(i): bytes([i]).decode("cp1252") for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def clean_name(name: str) -> str:
    return name.replace("﻿", "").strip().strip('"').strip()


def encodings_of(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a path by encoding, each on its own: UTF-8 if all of its bytes are, else windows-1252 if it defines all of them, else ISO-8859-1.

    Whole files are looked at, on the executors; the driver gets their names.
    """
    files = spark.read.format("binaryFile").load(path)
    undefined = F.hex("content").rlike("^(..)*(81|8D|8F|90|9D)")
    encoding = F.when(F.is_valid_utf8(F.col("content").cast("string")), ENCODINGS[0]).when(undefined, ENCODINGS[2]).otherwise(ENCODINGS[1])
    out: dict[str, list[str]] = {}
    for name, file in sorted(files.select(encoding, "path").collect()):
        out.setdefault(name, []).append(file)
    return out


#: Column of a row's place in its source: file, block and number, which sorts as the files were written, whatever Spark's splits are.
ORDER = "row_idx"


def source_block() -> Column:
    """Of a scan of files: file and block of a row."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def source_order(block: Column | None = None) -> Column:
    """Of a scan of files, or of rows with their block: what ORDER holds."""
    return F.struct((source_block() if block is None else block).alias("block"), F.monotonically_increasing_id().alias("row"))


def read_delimited(spark: SparkSession, path: str, encoding: str | None = None, schema: T.StructType | None = None, order: bool = False) -> DataFrame:
    """All columns as text (or by ``schema``), blanks as empty strings, quoted line breaks kept, a byte-order mark and quotes taken off the names; with ``order``, ORDER beside them."""
    if encoding is None:
        found = encodings_of(spark, path)
        if len(found) > 1:  # a file at a time
            each = [_read_as(spark, files, encoding, schema, order) for encoding, files in found.items()]
            out = each[0]
            for other in each[1:]:
                out = out.unionByName(other)
            return out
        encoding = next(iter(found), ENCODINGS[0])
    return _read_as(spark, path, encoding, schema, order)


def _read_as(spark: SparkSession, path: str | list[str], encoding: str, schema: T.StructType | None, order: bool) -> DataFrame:
    windows = encoding == ENCODINGS[1]
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", ENCODINGS[2] if windows else encoding)
    out = (reader if schema is None else reader.schema(schema)).csv(path)
    names = out.columns if schema is not None else [clean_name(c.translate(str.maketrans(_WINDOWS)) if windows else c) for c in out.columns]
    if order:
        out, names = out.withColumn(ORDER, source_order()), [*names, ORDER]
    out = out.toDF(*names).fillna("")
    if windows:
        plain, real = "".join(_WINDOWS), "".join(_WINDOWS.values())
        out = out.select(*(F.translate(F.col(f"`{f.name}`"), plain, real).alias(f.name) if f.dataType == T.StringType() else F.col(f"`{f.name}`") for f in out.schema))
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file, folder or match of a pattern."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, kind: str = "csv") -> DataFrame:
    """A table, or none of its rows where there is no file. What is there and can't be read raises."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_delimited(spark, path, "UTF-8", schema) if kind == "csv" else spark.read.schema(schema).format(kind).load(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line: lines that are neither blank nor comments."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """title, link, description, published, source of RSS items or Atom entries in feed files."""
    def fields(row_tag: str) -> DataFrame:
        schema = "title string, link string, description string, summary string, pubDate string, published string, updated string, source string, id string"
        return spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE").schema(schema).load(path)

    rows = fields("item").unionByName(fields("entry"))
    return rows.select("title", F.coalesce(F.nullif("link", F.lit("")), "id").alias("link"), F.coalesce("description", "summary").alias("description"), F.coalesce("pubDate", "published").alias("published"), "updated", "source")


def read_map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """key and value of a JSON object in a file; nothing from a missing or broken file."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"key string, value {value}")
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", f"map<string, {value}>")).alias("key", "value"))


def newsletters(spark: SparkSession, path: str, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """path, day and first day of the week of dated files, newest first."""
    files = spark.read.format("binaryFile").load(path).select("path")
    day = F.regexp_extract("path", pattern, 1).try_cast("date")
    return files.withColumn("day", day).where("day is not null").withColumn("from_day", F.date_sub("day", 6)).orderBy(F.col("day").desc())


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheet_rows(content: bytes, sheet: str) -> Iterator[list[str | None]]:
    """The rows of one sheet of a workbook, as text."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        def xml(name: str) -> ElementTree.Element:
            return ElementTree.fromstring(book.read(name))

        shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in xml("xl/sharedStrings.xml").findall("m:si", _NS)] if "xl/sharedStrings.xml" in book.namelist() else []
        ids = {s.get("name"): s.get(_REL) for s in xml("xl/workbook.xml").find("m:sheets", _NS)}
        target = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}[ids[sheet]]
        for row in xml("xl/" + target.lstrip("/").removeprefix("xl/")).iter(f"{{{_NS['m']}}}row"):
            cells: list[str | None] = []
            for c in row.findall("m:c", _NS):
                column = 0
                for letter in re.match("[A-Z]+", c.get("r", "A"))[0]:
                    column = column * 26 + ord(letter) - 64
                cells += [None] * (column - len(cells))
                v = c.find("m:v", _NS)
                text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else None if v is None else v.text
                cells[column - 1] = shared[int(text)] if c.get("t") == "s" and text is not None else text
            yield cells


def table_of(rows: list[list[str | None]], marker: str) -> pd.DataFrame:
    """Rows below the first one with a cell that is ``marker``, which names the columns; rows without any value are left out."""
    head = next((i for i, r in enumerate(rows) if any((c or "").strip() == marker for c in r)), None)
    if head is None:
        raise ValueError(f"no header row with {marker!r}")
    names = [(c or "").strip() for c in rows[head]]
    body = [(r + [None] * len(names))[: len(names)] for r in rows[head + 1 :]]
    frame = pd.DataFrame([r for r in body if any(c not in (None, "") for c in r)], columns=names, dtype=object)
    return frame[[n for n in names if n]]


def read_workbook(spark: SparkSession, path: str, sheet: str, columns: list[str], marker: str = "Plant ID", order: bool = False) -> DataFrame:
    """A sheet read through Spark's binary files, so a path may be in any store; all columns are text; with ``order``, ORDER beside them."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"], strict=True):
                rows = table_of(list(sheet_rows(content, sheet)), marker).reindex(columns=columns).astype(object).where(lambda x: x.notna(), None)
                yield rows.assign(file_=file, row_=range(len(rows)))

    schema = T.StructType([*strings([*columns, "file_"]).fields, T.StructField("row_", T.LongType())])
    rows = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, schema)
    place = F.struct(F.struct(F.col("file_").alias("file"), F.lit(0).cast("long").alias("block")).alias("block"), F.col("row_").alias("row"))
    return rows.select(*(F.col(f"`{c}`") for c in columns), *([place.alias(ORDER)] if order else []))
