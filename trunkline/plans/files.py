"""Input files with known names, written by tasks: what a user of the loads would have."""

from __future__ import annotations

import gzip
import shutil
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.schemas import NUMBERING_FILES, PORTABILITY_FILE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NAME = "_arquivo"


def _write_named(rows: DataFrame, name: Column, folder: str, order: list[str], **options) -> None:
    """One text file for each name, in order of some columns, with that very name."""
    spark = rows.sparkSession
    jvm = spark._jvm
    (
        rows.withColumn(_NAME, name)
        .repartition(_NAME)
        .sortWithinPartitions(_NAME, *order)
        .write.partitionBy(_NAME)
        .options(**options)
        .csv(f"{folder}/_novos")
    )
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    path = jvm.org.apache.hadoop.fs.Path
    for found in fs.globStatus(path(f"{folder}/_novos/{_NAME}=*/part-*")):
        name = found.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(found.getPath(), path(f"{folder}/{name}"))
    fs.delete(path(f"{folder}/_novos"), True)


def _file_system(folder: str):
    """The file system of a folder for a task, and the folder's path there."""
    import pyarrow.fs as pafs

    place = folder[len("file:") :] if folder.startswith("file:") else folder
    return pafs.FileSystem.from_uri("/" + place.lstrip("/") if "://" not in place else place)


#: Bytes of a part that a task holds while it copies it.
_COPIED = 4 << 20


def _join_parts(folder: str, head: bytes):
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _file_system(folder)
        for batch in batches:
            for name, parts in zip(batch["nome"], batch["partes"], strict=True):
                with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                    out.write(head)
                    for part in parts:
                        with fs.open_input_file(f"{root}/{part}") as found:
                            shutil.copyfileobj(found, out, _COPIED)
            yield batch[["nome"]]

    return join


def _write_in_parts(
    rows: DataFrame, name: Column, folder: str, order: list[Column], columns: list[str],
    head: bytes = b"", **options,
) -> None:
    """A few text files with given names, however large, each in order of some columns.

    Tasks write ranges of the files as parts, so no task holds a whole file. Then one task a
    file copies its parts one after another, some bytes at a time, after those of ``head``:
    texts in a row are a text, and gzip members in a row a gzip file.
    """
    spark = rows.sparkSession
    splits = 4 * rows.rdd.getNumPartitions()
    # Beyond the session's number, as many ranges as the rows want.
    most = [splits] if splits > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    (
        rows.withColumn(_NAME, name)
        .repartitionByRange(*most, F.col(_NAME), *order)
        .sortWithinPartitions(F.col(_NAME), *order)
        .select(*columns, _NAME)
        .write.partitionBy(_NAME)
        .options(**options)
        .csv(f"{folder}/_novos")
    )
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts: dict[str, list[str]] = {}
    for found in fs.globStatus(path(f"{folder}/_novos/{_NAME}=*/part-*")):
        place = found.getPath()
        part = f"_novos/{place.getParent().getName()}/{place.getName()}"
        parts.setdefault(place.getParent().getName().split("=", 1)[1], []).append(part)
    if parts:
        # One row a file; the names of its parts begin with the numbers of their ranges.
        listed = spark.createDataFrame(
            [(file, sorted(found)) for file, found in parts.items()], "nome string, partes array<string>"
        )
        joined = listed.repartition(len(parts)).mapInPandas(_join_parts(folder, head), "nome string")
        joined.write.format("noop").mode("overwrite").save()
    fs.delete(path(f"{folder}/_novos"), True)


def write_reports(lines: DataFrame, folder: str) -> None:
    """The report lines in the files that ``nome_arquivo`` names."""
    columns = PORTABILITY_FILE.fieldNames()
    _write_named(
        lines.select(*columns, F.col("nome_arquivo").alias(_NAME)),
        F.col(_NAME),
        folder,
        ["numero_bp"],
        sep=";", header=True, compression="gzip", emptyValue="",
        # The files are read once, so the fastest level of gzip costs least.
        **{"zlib.compress.level": "BEST_SPEED"},
    )


def write_calls(calls: DataFrame, folder: str, files: int = 4) -> None:
    """Dialled calls in gzip CSV files with a header, in order of the call."""
    columns = ["timestamp", "origem", "destino"]
    _write_in_parts(
        calls.select(
            F.col("call_id").alias("timestamp"),
            F.col("numero_a").alias("origem"),
            F.col("numero_b").alias("destino"),
        ),
        F.concat(F.lit("chamadas_"), F.col("timestamp") % files, F.lit(".csv.gz")),
        folder,
        [F.col(c) for c in columns],
        columns,
        head=gzip.compress(f"{','.join(columns)}\n".encode(), mtime=0),
        compression="gzip",
    )


def write_texts(documents: DataFrame, folder: str, encoding: str, prefix: str) -> None:
    """Texts in one file a language, in an order that large groups of copies do not upset."""
    _write_in_parts(
        documents.select("doc_id", "text", "lang"),
        F.concat(F.lit(f"{prefix}_"), F.col("lang"), F.lit(".csv")),
        folder,
        [F.xxhash64("doc_id", "text")],
        ["text", "lang"],
        encoding=encoding,
    )


def write_bytes(spark: SparkSession, path: str, content: bytes = b"") -> None:
    """A small file of some bytes, or of none."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    stream = hadoop_path.getFileSystem(conf).create(hadoop_path)
    stream.write(content)
    stream.close()


def _pack(kind: str, columns: list[str], folder: str, damaged: str | None):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        import io
        import zipfile

        name = rows[_NAME].iloc[0]
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("dados/", "")
            half = len(rows) // 2
            for part, some in (("a", rows.iloc[:half]), ("b", rows.iloc[half:])):
                text = some[columns].to_csv(sep=";", index=False, header=["x"] * len(columns))
                archive.writestr(f"dados/{part}.csv", text.encode("latin-1"))
        fs, root = _file_system(folder)
        fs.create_dir(root, recursive=True)
        contents = {name: buffer.getvalue()}
        if damaged:
            contents[damaged] = buffer.getvalue()[:40]
        for file, content in contents.items():
            with fs.open_output_stream(f"{root}/{file}") as out:
                out.write(content)
        return pd.DataFrame({"nome_arquivo": [name]})

    return pack


def write_archives(
    rows: DataFrame, kind: str, name: Column, folder: str, damaged: str | None = None
) -> None:
    """ZIP archives of two files each, and a damaged one if it is named."""
    columns = NUMBERING_FILES[kind].fieldNames()
    blank = [F.lit(None).cast("string").alias(c) for c in columns if c not in rows.columns]
    (
        rows.select("*", *blank, name.alias(_NAME))
        .select(*columns, _NAME)
        .groupBy(_NAME)
        .applyInPandas(_pack(kind, columns, folder, damaged), "nome_arquivo string")
        .write.format("noop").mode("overwrite").save()
    )
