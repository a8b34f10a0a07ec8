"""Finding input files through Spark's file systems."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File-name prefixes of the numbering-plan file types.
FILE_TYPE_PREFIXES = {
    "STFC": ["STFC"],
    "SMP_SME": ["SMP", "SME"],
    "CNG": ["CNG"],
    "SUP": ["SUP"],
}

# Kind of content by file extension.
FILE_FORMATS = {".csv": "texto", ".txt": "texto", ".log": "texto", ".gz": "gzip"}


def path_is_folder(spark: SparkSession, path: str) -> bool:
    """Whether an existing path is a folder; ``FileNotFoundError`` if nothing is there."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(hadoop_path):
        raise FileNotFoundError(f"{path} not found")
    return fs.getFileStatus(hadoop_path).isDirectory()


def file_options(spark: SparkSession, path: str, pattern: str) -> dict[str, str]:
    """Reader options: a folder is searched recursively for ``pattern``, a file is taken as is."""
    if path_is_folder(spark, path):
        return {"recursiveFileLookup": "true", "pathGlobFilter": pattern}
    return {}


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, modificationTime, length`` of the files, empty ones too; nothing is read.

    The file system lists them for the driver, which keeps one short row a file.
    """
    folder = path_is_folder(spark, path)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    hidden = jvm.org.apache.hadoop.fs.GlobFilter(pattern if folder else "*")
    rows, found = [], fs.listFiles(root, True)
    while found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if hidden.accept(status.getPath()) and not name.startswith(("_", ".")):
            seconds = status.getModificationTime() / 1000
            rows.append((status.getPath().toString(), seconds, status.getLen()))
    listed = spark.createDataFrame(rows, "path string, segundos double, length bigint")
    return listed.select(
        "path", F.timestamp_seconds("segundos").alias("modificationTime"), "length"
    )


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(name: Column) -> Column:
    """Last suffix of a file name with its dot, ``''`` without one."""
    return F.regexp_extract(name, r"[^.](\.[^.]+)$", 1)


def file_inventory(files: DataFrame, root: str | None = None) -> DataFrame:
    """Name, path below ``root``, size, extension and format of listed files."""
    name = base_name(F.col("path"))
    place = F.col("path")
    if root is not None:
        below = root.split(":", 1)[-1].rstrip("/") + "/"
        at = F.locate(below, place)
        place = F.when(at > 0, F.substr(place, at + len(below))).otherwise(place)
    suffix = extension(name)
    kinds = F.create_map(*[F.lit(v) for pair in FILE_FORMATS.items() for v in pair])
    return files.select(
        name.alias("nome"),
        place.alias("caminho"),
        F.col("length").alias("tamanho"),
        suffix.alias("extensao"),
        F.try_element_at(kinds, suffix).alias("formato"),
    )


def file_type(file_name: Column) -> Column:
    """Numbering-plan file type by name prefix, any case; NULL if unknown."""
    upper = F.upper(file_name)

    def starts(prefixes: Iterable[str]) -> Column:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | upper.startswith(p)
        return hit

    return F.coalesce(
        *[F.when(starts(p), F.lit(t)) for t, p in FILE_TYPE_PREFIXES.items()]
    )
