"""Tables of the data sets, what the session says about folders, exchanges and batches, and joins that no hot key holds up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import join_sized
from ..session import materialise, scratch, shared_dir

__all__ = ["join_sized", "materialise", "scratch", "shared_dir", "shuffle_width", "small_batches", "table", "text_digest", "without_rows"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of an Arrow batch of texts. Long texts would otherwise make batches of up to Spark's own bound.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's bound on the bytes of an Arrow batch to BATCH_BYTES; a lower one stays."""
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH_CONF, str(2**31 - 1)).rstrip("b") or 0) > BATCH_BYTES:
        conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df


def text_digest(text: Column) -> Column:
    """64 bits of a text, by which rows of one doc_id are told apart; a null text has those of an empty one."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def identity() -> dict[str, Column]:
    """What a row of documents is known by: doc_id and digest."""
    return {"doc_id": F.col("doc_id").cast("long"), "digest": text_digest(F.col("text"))}


#: Bits of the bitmap of rows that may go, in pieces of PIECE_BITS: 4 MB at most, whatever the tables' sizes.
BITMAP_BITS, PIECE_BITS = 1 << 25, 1 << 15


def _place(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BITMAP_BITS))


def _bitmap(places: DataFrame) -> DataFrame:
    """A broadcast bitmap of a column ``place``: of bounded size, whatever the table's."""
    pieces = places.select(F.floor(F.col("place") / PIECE_BITS).alias("piece"), (F.col("place") % PIECE_BITS).alias("bit")).groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return F.broadcast(materialise(pieces, "rows-bitmap"))


def _with_bit(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """``rows`` with ``may_``: whether the bit of their ``place`` is set."""
    met = rows.withColumns({"piece": F.floor(F.col("place") / PIECE_BITS), "bit": F.col("place") % PIECE_BITS}).join(bitmap, "piece", "left")
    byte = "cast(conv(hex(substring(bitmap, cast(bit div 8 AS int) + 1, 1)), 16, 10) AS int)"
    return met.withColumn("may_", F.expr(f"coalesce(shiftright({byte}, cast(bit % 8 AS int)) & 1 = 1, false)")).drop("piece", "bit", "bitmap", "place")


def only_with(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose ``key`` is in ``keys``. Those whose bit isn't set in a bitmap of the keys are left out where they are; only the others are exchanged."""
    may = _with_bit(rows.withColumn("place", _place(F.col(key))), _bitmap(keys.select(_place(F.col(key)).alias("place")))).where("may_").drop("may_")
    return may.join(keys.select(key), key, "left_semi")


def without_rows(docs: DataFrame, gone: DataFrame, again: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose ``identity`` isn't in ``gone``, and of each in ``again`` one. Null doc_ids are equal to each other.

    Rows whose bit isn't set in a bitmap of both tables, which is broadcast, stay where they are; only the others meet the tables.
    """
    place = _place(*identity())
    bitmap = _bitmap(gone.select(*identity()).unionByName(again.select(*identity())).select(place.alias("place")))
    met = _with_bit(docs.select(F.struct("*").alias("row"), *(c.alias(name) for name, c in identity().items())).withColumn("place", place), bitmap)
    open_ = met.where("may_").select("row", "doc_id", "digest")

    def of(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("doc_id_"), F.col("digest").alias("digest_"))
        return rows.join(keys, (rows["digest"] == keys["digest_"]) & rows["doc_id"].eqNullSafe(keys["doc_id_"]), how)

    stay = of(gone, "left_anti", open_)
    one = of(again, "left_semi", stay).groupBy("doc_id", "digest").agg(F.first("row").alias("row"))
    rest = of(again, "left_anti", stay).select("row.*").unionByName(one.select("row.*"))
    return met.where("not may_").select("row.*").unionByName(rest)
