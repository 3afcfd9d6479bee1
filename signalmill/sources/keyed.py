"""Tables whose rows are updated by key without being rewritten.

Rows are dealt into a fixed number of buckets by hash of the key. A version of the table is a manifest, a small file that names the folder of each
bucket. An update reads and writes only the buckets of its own keys, into new folders, and then adds a manifest by a rename that fails if another
writer was first. Readers take the newest manifest, so they see one version whole; what a broken run leaves is named by none.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writers import delete, listed, make_folder, put, updated

#: Manifests that ``vacuum`` keeps.
KEPT = 2
_BUCKET = "bucket_"


class Conflict(RuntimeError):
    """Another writer added the version first."""


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """A rename that doesn't replace anything."""
    jvm = spark._jvm
    files, (a, b) = jvm.org.apache.hadoop.fs.FileContext, (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.getFileContext(a.toUri(), spark._jsc.hadoopConfiguration()).rename(a, b, options)
    except Exception as e:
        if "FileAlreadyExistsException" in str(e):
            raise Conflict(target) from e
        raise


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that are there, ascending."""
    return sorted(int(n.removesuffix(".json")) for n in listed(spark, f"{path}/manifests") if n.removesuffix(".json").isdigit())


def manifest(spark: SparkSession, path: str, version: int) -> dict:
    """key, schema, number of buckets, and the folder of each bucket that has rows."""
    lines = spark.read.option("wholetext", True).text(f"{path}/manifests/{version}.json")
    return json.loads(lines.first()[0])


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> dict[str, str]:
    """Folder of each bucket that has rows, in new ones."""
    data = f"data/{uuid.uuid4().hex}"
    dealt = rows.withColumn(_BUCKET, _bucket(key, buckets))
    dealt.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/{data}")
    return {n.split("=")[1]: f"{data}/{n}" for n in listed(rows.sparkSession, f"{path}/{data}") if n.startswith(f"{_BUCKET}=")}


def commit(spark: SparkSession, path: str, version: int, content: dict) -> None:
    """Add a version, or raise ``Conflict`` if it is there."""
    draft = f"{path}/drafts/{uuid.uuid4().hex}"
    put(spark, draft, json.dumps(content).encode())
    make_folder(spark, f"{path}/manifests")
    try:
        _rename(spark, draft, f"{path}/manifests/{version}.json")
    except Conflict:
        delete(spark, draft)
        raise


def create(rows: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Version 1 of a table. Keys are unique; rows without one are refused."""
    if not rows.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"rows without {key}")
    content = {"key": key, "schema": rows.schema.json(), "buckets": buckets, "folders": _write(rows, path, key, buckets)}
    commit(rows.sparkSession, path, 1, content)


def _load(spark: SparkSession, path: str, content: dict, only: list[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(content["schema"]))
    folders = [f"{path}/{f}" for b, f in content["folders"].items() if only is None or int(b) in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the table, the newest by itself."""
    return _load(spark, path, manifest(spark, path, version or versions(spark, path)[-1]))


def update(updates: DataFrame, path: str, columns: list[str], insert: bool = False) -> list[int]:
    """Set ``columns`` where ``updates`` have a value (one row a key), as a new version; with ``insert``, keys that aren't there are added, with null in other columns. Gives the buckets that were written.

    The driver gets the numbers of the buckets, of which there is a fixed number.
    """
    spark = updates.sparkSession
    newest = versions(spark, path)[-1]
    now = manifest(spark, path, newest)
    key, buckets = now["key"], now["buckets"]
    updates = updates.where(F.col(key).isNotNull())
    touched = sorted(r[0] for r in updates.select(_bucket(key, buckets)).distinct().collect())
    if not touched:
        return []
    old = _load(spark, path, now, touched)
    new = updated(old, updates, key, columns)
    if insert:
        added = updates.join(old.select(key), key, "left_anti")
        new = new.unionByName(added.select(key, *columns), allowMissingColumns=True)
    folders = {b: f for b, f in now["folders"].items() if int(b) not in touched} | _write(new, path, key, buckets)
    commit(spark, path, newest + 1, now | {"folders": folders})
    return touched


def vacuum(spark: SparkSession, path: str, kept: int = KEPT) -> list[str]:
    """Delete all but the newest versions, and the folders that none of those names; their names. Not to be run beside a writer."""
    there = versions(spark, path)
    named = {f.split("/")[1] + "/" + f.split("/")[2] for v in there[-kept:] for f in manifest(spark, path, v)["folders"].values()}
    for v in there[:-kept]:
        delete(spark, f"{path}/manifests/{v}.json")
    gone = []
    for data in listed(spark, f"{path}/data"):
        buckets = [n for n in listed(spark, f"{path}/data/{data}") if n.startswith(f"{_BUCKET}=")]
        free = [n for n in buckets if f"{data}/{n}" not in named]
        for n in [""] if len(free) == len(buckets) else free:
            delete(spark, f"{path}/data/{data}/{n}".rstrip("/"))
        gone += [f"{data}/{n}" for n in free]
    delete(spark, f"{path}/drafts")
    return gone
