"""Tables of the given folder, tables in the shared folder, and joins by measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.session import shared_folder

#: A side of a join is broadcast up to this many bytes, by its counted rows.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, without its lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table with a broadcast hint if its counted rows fit the limit.

    Beyond the limit the join shuffles; the answer is the same.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


#: Words of 64 bits in a bitmap of keys; a broadcast of it has at most so many rows.
BITMAP_WORDS = 1 << 20


def in_bitmap(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``df`` with a column ``listed``: false only if its ``key`` is not among ``keys``.

    A bitmap of bounded size tells most rows that need no join apart from those that may.
    """
    place = F.xxhash64(F.col(key))
    word = F.pmod(place, F.lit(BITMAP_WORDS))
    bit = F.shiftrightunsigned(place, 58).cast("int")
    bits = stored(
        keys.select(word.alias("_word"), F.expr("1L").alias("one"), bit.alias("bit"))
        .groupBy("_word")
        .agg(F.expr("bit_or(shiftleft(one, bit))").alias("_bits")),
        "bitmap",
    )
    test = F.shiftrightunsigned("_bits", 0).bitwiseAND(F.expr("shiftleft(1L, _bit)")) != 0
    marked = df.withColumn("_word", word).withColumn("_bit", bit)
    marked = marked.join(F.broadcast(bits), "_word", "left")
    return marked.withColumn("listed", F.coalesce(test, F.lit(False))).select(*df.columns, "listed")


def without(documents: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose ``doc_id`` is not among the dropped ids (a column ``doc_id``)."""
    ids = sized(stored(dropped.select("doc_id").distinct(), "dropped"), 16)
    return documents.join(ids, "doc_id", "left_anti").select(documents.columns)


def scan_parts(df: DataFrame) -> int:
    """A partition count for work on ``df``'s rows, as the session is set."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
