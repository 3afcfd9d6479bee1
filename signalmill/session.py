"""Session defaults and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: Names of the scratch folders that tables go to now, the innermost last.
_scratch: ContextVar[tuple[str, ...]] = ContextVar("scratch", default=())

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def session(app: str = "signalmill", **conf: str) -> SparkSession:
    """A session with this library's defaults; anything may be overridden."""
    return SparkSession.builder.appName(app).config(map=DEFAULTS | conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where none is set, a temporary one in local mode, as in tests.

    On a cluster each machine would write to its own temporary folder, so there one must be set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="signalmill-")
    return _own[app]


def tables_dir(spark: SparkSession) -> str:
    """Where this application's intermediate tables and files are."""
    return f"{shared_dir(spark)}/signalmill/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    The lineage is cut, a lost executor costs no recomputation, and later readers
    prune columns. The table lives until the end of the ``scratch`` that it is written in, or until ``drop_tables``.
    """
    path = "/".join([tables_dir(df.sparkSession), *_scratch.get(), f"{name}-{uuid.uuid4().hex}"])
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch of pages, at most.
PAGE_BYTES = 2 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's bound on the bytes of an Arrow batch to PAGE_BYTES; a lower one stays. A batch is else 10,000 rows, however long they are."""
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH_CONF, str(2**31 - 1)).rstrip("b") or 0) > PAGE_BYTES:
        conf.set(_BATCH_CONF, str(PAGE_BYTES))
    return df


_STATIC_CONF, _MEASURED_CONF = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """Joins that are run inside broadcast a side by the bytes of its rows, which its shuffle has counted, and not by those of the files that it is read from.

    A column of rising or repeated values takes a few bits a row in a file and 16 bytes in a broadcast, which the driver holds, so millions of rows
    go below the bound by their files. The bound itself stays the session's. Broadcasts that a plan names are left.
    """
    before = {k: spark.conf.get(k, None) for k in (_STATIC_CONF, _MEASURED_CONF)}
    try:
        if before[_MEASURED_CONF] is None:
            spark.conf.set(_MEASURED_CONF, spark.conf.get(_STATIC_CONF))
        spark.conf.set(_STATIC_CONF, "-1")
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that are written inside are deleted at the end, but for those written by the function that this gives."""
    outer = _scratch.get()
    folder = f"scratch-{uuid.uuid4().hex}"

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _scratch.set(outer)
        try:
            return materialise(df, name)
        finally:
            _scratch.reset(inner)

    token = _scratch.set((*outer, folder))
    try:
        yield keep
    finally:
        _scratch.reset(token)
        _delete(spark, "/".join([tables_dir(spark), *outer, folder]))


def drop_tables(spark: SparkSession) -> None:
    """Delete what ``materialise`` wrote in this application; results that were read from it must be written before."""
    _delete(spark, tables_dir(spark))
