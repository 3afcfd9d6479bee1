"""Sinks: tables, keyed updates, snapshots, and small rendered files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import kml_colour, mw_label, slug, sqft_label, xml_escaped
from ..session import materialise
from .readers import read_or_empty


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one small file, whole, into any store that Spark can write."""
    fs, at = _file_system(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.mkdirs(at)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where there is no folder."""
    fs, at = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append a table's own columns; others are left out."""
    df.select(*columns).write.mode("append").parquet(path)


def append_new(df: DataFrame, path: str, key: str, columns: list[str]) -> None:
    """Append rows whose key isn't in the table yet, so that a repeated run changes nothing."""
    there = read_or_empty(df.sparkSession, path, df.select(*columns).schema, "parquet")
    append(df.dropDuplicates([key]).join(there.select(key), key, "left_anti"), path, columns)


def updated(table: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``table`` with the updates' values of ``columns`` where they have one."""
    new = updates.select(key, *(F.col(c).alias(f"new_{c}") for c in columns))
    out = table.join(new, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"new_{c}", c))
    return out.select(*table.columns)


def swap(df: DataFrame, path: str, version: str) -> str:
    """Write a new version of a table beside the others; readers are pointed to it once it is whole, and the last one is the backup."""
    out = f"{path}/version={version}"
    df.write.mode("errorifexists").parquet(out)
    return out


def snapshot(spark: SparkSession, inputs: str, archive: str, stamp: str) -> None:
    """Copies of the input files' bytes under a snapshot's partition. The same stamp again takes the place of its first copies."""
    files = spark.read.format("binaryFile").load(inputs).select("path", "modificationTime", "content")
    files.withColumn("snapshot_ts", F.lit(stamp)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_ts").parquet(archive)


def recent_snapshots(archive: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """What stays after snapshots older than ``days`` days are pruned."""
    return archive.where(F.to_timestamp("snapshot_ts", "yyyyMMdd_HHmmss") >= now - F.make_dt_interval(days=F.lit(days)))


def prune_snapshots(spark: SparkSession, archive: str, now: Column, days: int = 7) -> list[str]:
    """Delete the snapshots older than ``days`` days; their stamps. A folder whose stamp is no time stays."""
    old = spark.read.parquet(archive).select(F.col("snapshot_ts").cast("string").alias("snapshot_ts")).distinct()
    at = F.try_to_timestamp("snapshot_ts", F.lit("yyyyMMdd_HHmmss"))
    stamps = sorted(r["snapshot_ts"] for r in old.where(at < now - F.make_dt_interval(days=F.lit(days))).collect())
    for stamp in stamps:
        delete(spark, f"{archive}/snapshot_ts={stamp}")
    return stamps


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON text a row, for a data file that a page loads."""
    return df.select(F.to_json(F.struct("*")).alias("json"))


def page(title: str, datasets: dict[str, DataFrame], most_rows: int = 100_000) -> str:
    """An HTML page with each dataset as a constant. Datasets are reports; one over ``most_rows`` rows is refused."""
    parts = []
    for name, df in datasets.items():
        rows = json_rows(df).limit(most_rows + 1).collect()
        if len(rows) > most_rows:
            raise ValueError(f"{name} is no report: over {most_rows} rows")
        parts.append(f"const {name} = [{','.join(r['json'] for r in rows)}];".replace("</", "<\\/"))
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{title}</title></head><body><script>\n" + "\n".join(parts) + "\n</script></body></html>"


def placemarks(facilities: DataFrame, colours: dict[str, str]) -> DataFrame:
    """status, name and KML placemark of each facility."""
    label = F.concat_ws(", ", F.nullif(mw_label(F.col("mw")), F.lit("")), F.nullif(sqft_label(F.col("sqft")), F.lit("")))
    colour = F.coalesce(*(F.when(F.col("status") == s, kml_colour(F.lit(c), 255)) for s, c in colours.items()), kml_colour(F.lit("#888888"), 255))
    mark = F.format_string(
        "<Placemark><name>%s</name><styleUrl>#%s</styleUrl><description>%s</description><Style><IconStyle><color>%s</color></IconStyle></Style><Point><coordinates>%s,%s,0</coordinates></Point></Placemark>",
        xml_escaped(F.col("name")), slug(F.concat_ws("_", "status", "company_type")), xml_escaped(label), colour, F.col("lon").cast("string"), F.col("lat").cast("string"),
    )
    return facilities.select("status", "name", mark.alias("placemark"))


def kmz(marks: DataFrame, order: tuple[str, ...]) -> bytes:
    """One folder a status in a fixed order; a status without facilities has none. Written row by row, so only the archive is held."""
    out = io.BytesIO()
    place = F.array_position(F.array(*(F.lit(s) for s in order)), F.col("status"))
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open("doc.kml", "w") as f:
        f.write(b'<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>')
        now = None
        for r in marks.orderBy(F.when(place == 0, 99).otherwise(place), "status", "name").toLocalIterator():
            if r["status"] != now:
                f.write((b"</Folder>" if now is not None else b"") + f"<Folder><name>{r['status']}</name>".encode())
                now = r["status"]
            f.write(r["placemark"].encode())
        f.write((b"</Folder>" if now is not None else b"") + b"</Document></kml>")
    return out.getvalue()


#: Placemarks of one archive of a folder of archives.
ARCHIVE_ROWS = 50_000


def kmz_folder(marks: DataFrame, path: str, order: tuple[str, ...], most: int | None = None) -> None:
    """Archives of up to ``most`` placemarks each, numbered in the order of ``kmz``: each is whole by itself and is packed in a task.

    Only packed archives, one after another, come to the driver, which puts them into the store.
    """
    most = most or ARCHIVE_ROWS
    spark = marks.sparkSession
    place = F.array_position(F.array(*(F.lit(s) for s in order)), F.col("status"))
    rows = marks.select(F.when(place == 0, 99).otherwise(place).cast("int").alias("place"), "status", "name", "placemark")
    ordered = rows.repartitionByRange("place", "status", "name").sortWithinPartitions("place", "status", "name").select("status", "placemark")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((s.as_py(), m.as_py()) for b in batches for s, m in zip(b.column(0), b.column(1), strict=True))
        while first := next(pairs, None):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open("doc.kml", "w") as f:
                f.write(b'<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>')
                for status, of_status in groupby(chain([first], islice(pairs, most - 1)), key=lambda x: x[0]):
                    f.write(f"<Folder><name>{status}</name>".encode())
                    for _, mark in of_status:
                        f.write(mark.encode())
                    f.write(b"</Folder>")
                f.write(b"</Document></kml>")
            yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["content"])

    make_folder(spark, path)
    for n, r in enumerate(materialise(ordered.mapInArrow(pack, "content binary").withColumn("part", F.monotonically_increasing_id()), "archives").orderBy("part").select("content").toLocalIterator()):
        put(spark, f"{path}/part-{n:06d}.kmz", bytes(r["content"]))
