"""Exact duplicates over an extendible-hash index on shared files, in native functions.

Keys are 64-bit hashes of the normalised texts. The directory starts at the depth that the
number of keys asks for and doubles where a bucket holds more keys than its capacity. A key's
first bits lead through the directory to its bucket, and the bucket to the task that owns it:
owners hold whole buckets, ranges of keys that follow each other. The owner's file has an
entry for each key. Rows whose entry counts several send their texts to the owner of the
bucket; copies are combined by their bytes on the way. The owner chains the different texts
of a key, and a row finds its group in its bucket: at the key if the chain has one text,
else at the text with the same bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trunkline.llm.common import scan_parts, sized, stored, table, without

#: Keys that a bucket holds before it splits.
BUCKET_KEYS = 1 << 14
#: Times that the directory may double beyond the depth for evenly spread keys.
DOUBLINGS = 4
_LAST_ID = 9223372036854775807


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    """One number that orders by most code points, then smallest id; no id comes last."""
    by_id = F.lit(_LAST_ID).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)") + F.lit(1)
    by_id = F.coalesce(by_id, F.lit(0).cast("decimal(20,0)")).cast("decimal(22,0)")
    scale = F.lit("1" + "0" * 22).cast("decimal(23,0)")
    return (n_chars.cast("decimal(12,0)") * scale + by_id).cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    by_id = rank % F.lit("1" + "0" * 22).cast("decimal(23,0)")
    value = F.lit(_LAST_ID).cast("decimal(20,0)") - by_id + F.lit(1)
    return F.when(by_id > 0, value.cast("bigint"))


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth)


def directory(keys: DataFrame, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """The directory ``(prefix, depth, n_keys)`` over distinct keys, and its global depth.

    The counts by the longest prefix are summed for each depth. A prefix points to the
    bucket of the least depth that is not overfull; deeper ones come from doublings of the
    directory. A bucket that no doubling relieves keeps its keys together.
    """
    total = keys.count()
    least = max(1, ceil(log2(total / bucket_keys))) if total > bucket_keys else 1
    deepest = min(62, least + DOUBLINGS)
    level = stored(
        keys.groupBy(_prefix(F.col("key"), deepest).alias("prefix")).agg(
            F.count("*").alias("n_keys")
        ),
        "counts",
    )
    depth = F.lit(deepest)
    for d in range(deepest - 1, least - 1, -1):
        bucket = F.shiftright("prefix", deepest - d).alias(f"p{d}")
        sums = level.groupBy(bucket).agg(F.sum("n_keys").alias(f"n{d}"))
        level = level.withColumn(f"p{d}", F.shiftright("prefix", deepest - d))
        level = level.join(sums, f"p{d}")
        depth = F.when(F.col(f"n{d}") <= bucket_keys, F.lit(d)).otherwise(depth)
    return stored(level.select("prefix", depth.alias("depth"), "n_keys"), "directory"), deepest


def owned(entries: DataFrame) -> DataFrame:
    """``entries`` at the tasks that own their ``bucket``; no bucket is split between tasks."""
    return entries.repartitionByRange(scan_parts(entries), "bucket")


def chains(texts: DataFrame) -> DataFrame:
    """The chain of each key in its bucket: ``bucket, key, norm`` with ``n_texts`` of the key.

    ``texts``: ``bucket, key, norm, n_chars, doc_id``, one row for each copy. Copies are
    combined by their bytes in each task before any shuffle, so the owner gets a text
    once, however many copies it has.
    """
    combined = texts.groupBy("bucket", "key", "norm").agg(
        F.count("*").alias("group_size"),
        F.max(_rank(F.col("n_chars"), F.col("doc_id"))).alias("rank"),
    )
    of_key = Window.partitionBy("bucket", "key")
    return owned(combined).select(
        "bucket", "key", "norm", "group_size", _id_of(F.col("rank")).alias("keep_id"),
        F.count("*").over(of_key).alias("n_texts"),
    )


def build_index(
    documents: DataFrame,
    key: Callable[[Column], Column] = F.xxhash64,
    bucket_keys: int = BUCKET_KEYS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, index, directory)`` in the shared folder.

    ``rows``: key, id and digest of every row. ``index``: one entry a key with its bucket
    and its number of rows, in files of whole buckets, one file an owner.
    """
    text = F.col("text")
    norm = normalised(text)
    rows = stored(
        documents.select("doc_id", text, norm.alias("norm")).select(
            "doc_id",
            key(F.col("norm")).cast("bigint").alias("key"),
            F.sha2("norm", 256).alias("text_sha256"),
        ),
        "rows",
    )
    entries = rows.groupBy("key").agg(F.count("*").alias("n_rows"))
    keys = stored(entries, "keys")
    pointers, deepest = directory(keys, bucket_keys)
    placed = keys.withColumn("prefix", _prefix(F.col("key"), deepest)).join(
        sized(pointers.select("prefix", "depth"), 24), "prefix"
    )
    # A bucket is named by the first prefix that points to it: buckets in order of the name
    # are ranges of keys in unsigned order.
    bucket = F.expr(f"shiftleft(shiftright(prefix, {deepest} - depth), {deepest} - depth)")
    index = stored(
        owned(placed.select(bucket.alias("bucket"), "depth", "prefix", "key", "n_rows"))
        .sortWithinPartitions("bucket", "prefix", "key"),
        "index",
    )
    return rows, index, pointers


def exact_groups(
    documents: DataFrame,
    key: Callable[[Column], Column] = F.xxhash64,
    bucket_keys: int = BUCKET_KEYS,
) -> DataFrame:
    """Equal texts among ``doc_id, text``: the row that stays and the size of the group.

    Returns doc_id, keep_id, group_size, kept, text_sha256, one row for each row given.
    A null text is an empty one. Rows that share an id and a text are one document: all
    of them count in ``group_size`` and carry the same ``kept``. A null id stays only if
    the group has no other. An empty table gives no rows; other columns are not read.
    """
    documents = documents.select("doc_id", "text")
    rows, index, _ = build_index(documents, key, bucket_keys)
    repeated = stored(index.where("n_rows > 1").select("bucket", "key"), "repeated")
    norm = normalised(F.col("text"))
    length = F.length(F.coalesce("text", F.lit(""))).cast("bigint")
    texts = documents.select("doc_id", norm.alias("norm"), length.alias("n_chars"))
    texts = texts.withColumn("key", key(F.col("norm")).cast("bigint"))
    texts = texts.join(sized(repeated, 24), "key")
    groups = stored(chains(texts), "chains")
    alone = groups.where("n_texts = 1").select("key", "group_size", "keep_id")
    chained = groups.where("n_texts > 1")
    collisions = sized(stored(chained.select("key").distinct(), "collisions"), 16)
    # A key's only text: the key is enough.
    single = rows.join(collisions, "key", "left_anti").join(
        sized(stored(alone, "alone"), 40), "key", "left"
    )
    unique = F.col("group_size").isNull()
    single = single.select(
        "doc_id",
        F.when(unique, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        "text_sha256",
    )
    # Several texts of one key: each row looks its own bytes up in the chain.
    collided = (
        texts.join(collisions, "key", "left_semi")
        .join(chained.select("bucket", "key", "norm", "group_size", "keep_id"), ["bucket", "key", "norm"])
        .select("doc_id", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256"))
    )
    return single.unionByName(collided).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def exact_dedup_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without those that an equal one stands for."""
    return without(documents, exact_groups(documents).where("not kept"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
with n as (
  select doc_id, length(coalesce(text, ''))::bigint as n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents),
g as (
  select doc_id, norm, count(*) over (partition by norm) as group_size,
         first_value(doc_id) over (
           partition by norm order by n_chars desc, doc_id nulls last) as keep_id
  from n)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept,
       sha256(norm) as text_sha256
from g
"""
