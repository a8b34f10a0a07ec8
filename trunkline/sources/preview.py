"""Looking at files before a load: first lines, headers, encodings."""

from __future__ import annotations

import codecs
import gzip
import io
import sys
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.sources.discovery import base_name, file_options

# The task functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LINES = "path string, membro string, linha_no int, linha string, erro string"


#: Bytes of a line that a preview shows.
LINE_BYTES = 64 * 1024


def _open(path: str) -> pa.NativeFile:
    """A seekable file from a task; the folder must be on a file system Arrow knows."""
    if path.startswith("file:"):
        path = path[len("file:") :]
        path = "/" + path.lstrip("/")
    elif path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://") :]
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def _numbered(stream, n: int, encoding: str) -> Iterator[tuple[int, str]]:
    """First lines with their numbers; of a longer line the first ``LINE_BYTES``."""
    for i in range(1, n + 1):
        line = stream.readline(LINE_BYTES)
        if not line:
            return
        text = codecs.getincrementaldecoder(encoding)()
        yield i, text.decode(line, final=line.endswith(b"\n")).strip()
        while line and not line.endswith(b"\n") and i < n:
            line = stream.readline(LINE_BYTES)


def _first_lines(path: str, n: int, encoding: str) -> Iterator[tuple]:
    """First lines of a text, gzip or ZIP file; only the head of the file is read."""
    member = None
    try:
        with _open(path) as raw:
            if path.endswith(".zip"):
                with zipfile.ZipFile(raw) as archive:
                    names = [i.filename for i in archive.infolist() if not i.is_dir()]
                    if not names:
                        return
                    member = names[0]
                    with archive.open(member) as stream:
                        for i, line in _numbered(stream, n, encoding):
                            yield path, member, i, line, None
                return
            stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
            for i, line in _numbered(io.BufferedReader(stream), n, encoding):
                yield path, member, i, line, None
    except Exception as error:  # a file that cannot be read is a row of the report
        yield path, member, None, None, f"{type(error).__name__}: {error}"


def preview_files(files: DataFrame, nrows: int = 5, encoding: str = "utf8") -> DataFrame:
    """First ``nrows`` lines of every listed file, one row per line.

    Of a ZIP archive the first file is shown, of a long line the first ``LINE_BYTES``
    bytes. A file that cannot be read gives one row with ``erro``, an empty file none.
    """
    columns = [c.split()[0] for c in _LINES.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                rows = list(_first_lines(path, nrows, encoding))
                if rows:
                    yield pd.DataFrame(rows, columns=columns).astype(
                        {"linha_no": "Int32"}
                    )

    return files.select("path").mapInPandas(read, _LINES).select(
        base_name(F.col("path")).alias("nome_arquivo"),
        "membro",
        "linha_no",
        "linha",
        "erro",
    )


def header_check(
    files: DataFrame, expected: Sequence[str], sep: str = ",", encoding: str = "utf8"
) -> DataFrame:
    """Expected header names that the first line of each file lacks.

    An empty file lacks all of them. A file that cannot be read has ``erro``.
    """
    first = preview_files(files, 1, encoding)
    named = files.select(base_name(F.col("path")).alias("nome_arquivo")).distinct()
    first = named.join(first, "nome_arquivo", "left")
    found = F.transform(
        F.split(F.coalesce("linha", F.lit("")), f"\\Q{sep}\\E"), lambda h: F.trim(h)
    )
    wanted = F.array(*[F.lit(e) for e in expected])
    missing = F.array_except(wanted, found)
    return first.select(
        "nome_arquivo",
        F.array_join(missing, sep).alias("faltando"),
        (F.size(missing) == 0).alias("valido"),
        "erro",
    )


def encoding_probe(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """First encoding that decodes every line of a text or gzip file.

    UTF-8 if every line is valid UTF-8; any byte is valid Latin-1, so nothing after
    it is ever reached. Lines are checked in the JVM and reduced per task.
    """
    lines = (
        spark.read.options(**file_options(spark, path, pattern))
        .text(path)
        .select(
            F.col("_metadata.file_name").alias("nome_arquivo"),
            F.is_valid_utf8("value").alias("utf8"),
        )
    )
    return lines.groupBy("nome_arquivo").agg(
        F.when(F.bool_and("utf8"), "utf8").otherwise("latin1").alias("encoding")
    )
