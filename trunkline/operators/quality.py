"""Reports over loads, calls and carrier answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_report(rows: DataFrame, reason: Column, fault: Column | None = None) -> DataFrame:
    """Rows read, loaded and rejected per source file, with the file's status.

    ``reason`` says why a row is rejected and is NULL for a good row; ``erro`` names one
    of the reasons of the file, its ``fault`` before others.
    """
    named = F.max(reason) if fault is None else F.coalesce(F.max(fault), F.max(reason))
    report = rows.groupBy("nome_arquivo").agg(
        F.count(F.lit(1)).alias("linhas_lidas"),
        F.count_if(reason.isNull()).alias("linhas"),
        F.count_if(reason.isNotNull()).alias("rejeitadas"),
        named.alias("erro"),
    )
    status = F.when(F.col("rejeitadas") == 0, "success").otherwise("error")
    return report.withColumn("status", status)


def load_totals(report: DataFrame, seconds: float | None = None) -> DataFrame:
    """Files, successes, errors and rows over a whole load.

    With the load's duration also its speed; files run in parallel, so there is no
    speed per file.
    """
    totals = report.agg(
        F.count(F.lit(1)).alias("arquivos"),
        F.count_if(F.col("status") == "success").alias("sucessos"),
        F.count_if(F.col("status") != "success").alias("erros"),
        F.coalesce(F.sum("linhas"), F.lit(0)).cast("bigint").alias("linhas"),
        F.coalesce(F.sum("rejeitadas"), F.lit(0)).cast("bigint").alias("rejeitadas"),
    )
    if seconds is None:
        return totals
    return totals.withColumns(
        {
            "segundos": F.lit(float(seconds)),
            "linhas_por_segundo": F.try_divide("linhas", F.lit(float(seconds))),
        }
    )


def portability_rate(resolved: DataFrame) -> DataFrame:
    """Share of ported numbers, in percent."""
    return resolved.agg((F.avg("ind_portado") * 100).alias("taxa_portabilidade"))


def carrier_counts(resolved: DataFrame) -> DataFrame:
    """Numbers per carrier name, most first; numbers without a carrier are left out."""
    return (
        resolved.where(F.col("nome_prestadora").isNotNull())
        .groupBy("nome_prestadora")
        .agg(F.count(F.lit(1)).alias("numeros"))
        .orderBy(F.desc("numeros"), "nome_prestadora")
    )


def both_valid(calls: DataFrame, valid_a: str, valid_b: str) -> DataFrame:
    """Calls with two valid numbers."""
    return calls.where(F.col(valid_a) & F.col(valid_b))


def invalid_count(calls: DataFrame, valid_a: str, valid_b: str) -> DataFrame:
    """How many calls have at least one invalid number."""
    return calls.agg(
        F.count_if(~(F.col(valid_a) & F.col(valid_b))).alias("invalidos")
    )
