"""Portability reports: positional ``;`` files, usually gzip."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trunkline.functions.keys import (
    br_timestamp,
    code_to_int,
    decode_missing,
    flag_to_int,
)
from trunkline.schemas import PORTABILITY_FILE, STAGED_PORTABILITY
from trunkline.sources.discovery import file_options

REPORT_PATTERN = "*.csv.gz"

#: Holds the whole line where its number of fields is wrong.
BAD_LINE = "_linha_invalida"

CSV_OPTIONS = {
    "sep": ";",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD_LINE,
    # A pruned parser counts only the fields that a query asks for, so whether a line
    # is bad would depend on the query.
    "columnPruning": "false",
}

FILE_SCHEMA = T.StructType(
    [*PORTABILITY_FILE.fields, T.StructField(BAD_LINE, T.StringType())]
)


def scan_portability(
    spark: SparkSession, path: str, encoding: str = "UTF-8"
) -> DataFrame:
    """Report lines as text columns, with ``nome_arquivo``.

    Columns go by position, as the header repeats names. A folder is searched
    recursively for ``*.csv.gz``; a single file may have any extension.
    """
    reader = (
        spark.read.schema(FILE_SCHEMA)
        .options(**CSV_OPTIONS, encoding=encoding)
        .options(**file_options(spark, path, REPORT_PATTERN))
    )
    return with_file_name(reader.csv(path))


def scan_reports(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> DataFrame:
    """The same for files given by their paths."""
    reader = spark.read.schema(FILE_SCHEMA).options(**CSV_OPTIONS, encoding=encoding)
    return with_file_name(reader.csv(paths))


def damaged_reports(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Why files cannot be read to their ends, by path. Each is a job of its own."""

    def reason(path: str) -> str | None:
        try:
            spark.read.text(path).write.format("noop").mode("overwrite").save()
        except Exception as error:  # reported per file
            causes = re.findall(r"(?:java|org)\.[\w.]*(?:Exception|Error): [^\n]*", str(error))
            return (causes[-1] if causes else str(error).splitlines()[0])[:300]
        return None

    with ThreadPoolExecutor(8) as pool:
        found = zip(paths, pool.map(reason, paths), strict=True)
        return {path: why for path, why in found if why}


def with_file_name(lines: DataFrame) -> DataFrame:
    return lines.select("*", F.col("_metadata.file_name").alias("nome_arquivo"))


def type_portability(lines: DataFrame) -> DataFrame:
    """Typed staging columns plus ``motivo``, the reason a line is rejected, else NULL.

    The text columns are read once and typed by column expressions. A carrier code
    that is no number becomes NULL; every other column that does not parse rejects
    its line, and so does a missing required value.
    """
    text = {c: decode_missing(c) for c in PORTABILITY_FILE.fieldNames()}
    typed: dict[str, Column] = {
        "tipo_registro": text["tipo_registro"].try_cast("bigint"),
        "numero_bp": text["numero_bp"].try_cast("bigint"),
        "tn_inicial": text["tn_inicial"].try_cast("bigint"),
        "cod_receptora": code_to_int(text["cod_receptora"]),
        "nome_receptora": text["nome_receptora"],
        "cod_doadora": code_to_int(text["cod_doadora"]),
        "nome_doadora": text["nome_doadora"],
        "data_agendamento": br_timestamp(text["data_agendamento"]),
        "cod_status": text["cod_status"].try_cast("int"),
        "status": text["status"],
        "ind_portar_origem": flag_to_int(text["ind_portar_origem"]),
        "nome_arquivo": F.col("nome_arquivo"),
    }
    wrong_width = (
        F.col(BAD_LINE).isNotNull() if BAD_LINE in lines.columns else F.lit(False)
    )
    values = lines.select(
        *[typed[f.name].alias(f.name) for f in STAGED_PORTABILITY.fields],
        wrong_width.alias("_largura"),
        text["tipo_registro"].isNotNull().alias("_tem_tipo"),
    )
    reason = F.when(F.col("_largura"), "numero de campos").when(
        F.col("_tem_tipo") & F.col("tipo_registro").isNull(), "tipo_registro"
    )
    for required in (
        "numero_bp",
        "tn_inicial",
        "data_agendamento",
        "cod_status",
        "ind_portar_origem",
    ):
        reason = reason.when(F.col(required).isNull(), required)
    return values.select(*STAGED_PORTABILITY.fieldNames(), reason.alias("motivo"))


def accepted(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("motivo").isNull()).drop("motivo")


def rejected(typed: DataFrame) -> DataFrame:
    return typed.where(F.col("motivo").isNotNull())


def require_ids(df: DataFrame) -> DataFrame:
    """Rows that name a porting request and a number."""
    return df.dropna(subset=["numero_bp", "tn_inicial"])
