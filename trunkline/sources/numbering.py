"""Numbering-plan files: ``;`` Latin-1 files in ZIP archives, all text."""

from __future__ import annotations

import csv
import io
import itertools
import sys
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.functions.keys import decode_missing
from trunkline.schemas import NUMBERING_FILES
from trunkline.sources.discovery import base_name, file_options, file_type

ARCHIVE_PATTERN = "*.zip"

# The task functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RECORDS = "nome_arquivo string, campos array<string>, erro string"
_BATCH = 20_000


def _records(content: bytes, encoding: str) -> Iterator[list[str]]:
    """Records of all files in the archive, without their headers and without blank lines."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for info in archive.infolist():
            if info.is_dir():
                continue
            with archive.open(info) as member:
                lines = io.TextIOWrapper(member, encoding=encoding, newline="")
                rows = (r for r in csv.reader(lines, delimiter=";") if r)
                next(rows, None)
                yield from rows


def unzip_records(archives: DataFrame, encoding: str = "latin-1") -> DataFrame:
    """``(nome_arquivo, campos, erro)`` of archives given as ``(path, content)``.

    A ZIP member cannot be split, so one task reads one archive; it streams the
    records out in batches and Spark types them. An archive that cannot be read to its
    end adds one row with ``erro`` and no fields.
    """

    def batches_of(name: str, content: bytes) -> Iterator[pd.DataFrame]:
        records = _records(content, encoding)
        try:
            while rows := list(itertools.islice(records, _BATCH)):
                yield pd.DataFrame({"nome_arquivo": name, "campos": rows, "erro": None})
        except Exception as error:  # reported per file, like a rejected line
            message = f"{type(error).__name__}: {error}"
            yield pd.DataFrame(
                {"nome_arquivo": [name], "campos": [None], "erro": [message]}
            )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["nome_arquivo"], batch["content"]):
                yield from batches_of(name, content)

    named = archives.select(base_name(F.col("path")).alias("nome_arquivo"), "content")
    return named.mapInPandas(read, _RECORDS)


def scan_archives(
    spark: SparkSession, path: str, kind: str | None = None
) -> DataFrame:
    """``(path, content)`` of the archives, of one file type if ``kind`` is given.

    A folder is searched recursively for ``*.zip``; a single file may have any
    extension. Files of other types are pruned by name and not read.
    """
    files = (
        spark.read.format("binaryFile")
        .options(**file_options(spark, path, ARCHIVE_PATTERN))
        .load(path)
    )
    if kind is not None:
        files = files.where(file_type(F.col("_metadata.file_name")) == kind)
    return files.select("path", "content")


def stage_numbering(archives: DataFrame, kind: str) -> DataFrame:
    """Text columns of one file type, by position, with ``nome_arquivo``, ``erro``, ``motivo``.

    Missing marks become NULL. Fixed and mobile rows carry their service in ``servico``.
    A row with ``erro`` stands for an unreadable archive and has no values. ``motivo`` says
    why a row is rejected: too few fields, more fields with content than the type has, or
    the first required column that does not parse.
    """
    of_kind = archives.where(file_type(base_name(F.col("path"))) == kind)
    names = NUMBERING_FILES[kind].fieldNames()
    columns = [
        decode_missing(F.try_element_at("campos", F.lit(i + 1))).alias(name)
        for i, name in enumerate(names)
    ]
    surplus = F.slice("campos", len(names) + 1, F.greatest(F.size("campos"), F.lit(1)))
    width = (F.size("campos") < len(names)) | F.exists(surplus, lambda c: F.trim(c) != "")
    rows = unzip_records(of_kind).select(
        *columns, "nome_arquivo", "erro", F.coalesce(width, F.lit(False)).alias("_largura")
    )
    if kind in ("STFC", "SMP_SME"):
        rows = rows.withColumn("servico", F.lit(kind))
    reason = F.when(F.col("erro").isNotNull(), F.lit(None).cast("string")).when(
        F.col("_largura"), "numero de campos"
    )
    for name, value in _required(kind).items():
        reason = reason.when(value.isNull(), name)
    return rows.withColumn("motivo", reason).drop("_largura")


def _required(kind: str) -> dict[str, Column]:
    """Typed values that a row of the type must have, by column."""
    code = {"cnpj_prestadora": F.col("cnpj_prestadora").try_cast("bigint")}
    if kind == "SUP":
        return code
    if kind == "CNG":
        number = F.col("codigo_nao_geografico")
        return code | {"codigo_nao_geografico": number.try_cast("bigint")}
    out = code | {c: F.col(c).try_cast("int") for c in ("cn", "prefixo")}
    out |= {c: F.col(c).try_cast("bigint") for c in ("faixa_inicial", "faixa_final")}
    if kind == "STFC":
        out["codigo_cnl"] = F.coalesce("codigo_cnl", F.lit("0")).try_cast("int")
    return out


def fixed_and_mobile(fixed: DataFrame, mobile: DataFrame) -> DataFrame:
    """Fixed and mobile rows in one table; columns that a type lacks are NULL."""
    return fixed.unionByName(mobile, allowMissingColumns=True)


def readable(staged: DataFrame) -> DataFrame:
    """Rows of the archives that could be read, rejected ones included."""
    return staged.where(F.col("erro").isNull()).drop("erro")


def accepted_rows(staged: DataFrame) -> DataFrame:
    return readable(staged).where(F.col("motivo").isNull()).drop("motivo")


def rejected_rows(staged: DataFrame) -> DataFrame:
    return readable(staged).where(F.col("motivo").isNotNull())
