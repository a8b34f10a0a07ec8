"""Parquet tables of the warehouse: writing, replacing and removing them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from trunkline.session import shared_folder
from trunkline.sources.discovery import path_is_folder


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        return path_is_folder(spark, path)
    except FileNotFoundError:
        return False


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, without its lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def materialized(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The same for the length of a block; the table is removed afterwards.

    It holds a copy of rows that can be derived again, so it goes even after a failure.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.parquet(path)
    finally:
        drop_table(spark, path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace a table that can be derived again from its files: staging and the plan."""
    df.write.mode("overwrite").parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table folder, if there is one."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write an answer as CSV with a header, or in another Spark format."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


# --- replaceable tables ---------------------------------------------------------
#
# New files go to a version folder of their own. A small text that says which folders count
# is then replaced by one rename, and only then are old folders removed. A failure
# at any point leaves the table as it was, or as it was to become.

_CURRENT = "_atual"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path


def read_current(spark: SparkSession, path: str) -> str:
    """What ``switch_current`` wrote last for the table; empty if there is no table."""
    fs, listed = _file_system(spark, f"{path}/{_CURRENT}")
    if not fs.exists(listed):
        return ""
    stream = fs.open(listed)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def switch_current(spark: SparkSession, path: str, text: str) -> None:
    """Let the text say what the table is, in one step."""
    jvm = spark._jvm
    fs, new = _file_system(spark, f"{path}/{_CURRENT}-{uuid.uuid4().hex}")
    stream = fs.create(new)
    stream.write(text.encode())
    stream.close()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(
        context.makeQualified(new),
        context.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{path}/{_CURRENT}")),
        options,
    )


def has_versions(spark: SparkSession, path: str) -> bool:
    return bool(read_current(spark, path))


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a versioned table by ``df``, which may be derived from it.

    The version before stays for running readers until the next replacement.
    """
    spark = df.sparkSession
    old, new = read_current(spark, path).split(), f"versao={uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{new}")
    switch_current(spark, path, "\n".join([new, *old[:1]]))
    for folder in old[1:]:
        drop_table(spark, f"{path}/{folder}")


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``replace_table`` wrote."""
    return spark.read.parquet(f"{path}/{read_current(spark, path).split()[0]}")
