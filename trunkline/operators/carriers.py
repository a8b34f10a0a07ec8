"""Carrier names: one name per carrier code, from several sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trunkline.functions.keys import UNKNOWN_CARRIER, UNKNOWN_CARRIER_NAME


def _pair(code: Column, name: Column) -> Column:
    return F.struct(
        code.try_cast("bigint").alias("codigo"),
        name.alias("nome"),
        code.isNull().alias("sem_codigo"),
    )


def _one_name_per_code(pairs: DataFrame) -> DataFrame:
    """The greatest name of every code, plus the unidentified carrier.

    ``pairs`` holds distinct combinations only, so it is small whatever the input.
    """
    named = pairs.where(~F.col("sem_codigo") | F.col("nome").isNotNull()).select(
        F.when(F.col("sem_codigo"), UNKNOWN_CARRIER)
        .otherwise(F.col("codigo"))
        .cast("bigint")
        .alias("cod_prestadora"),
        F.when(F.col("sem_codigo"), UNKNOWN_CARRIER_NAME)
        .otherwise(F.col("nome"))
        .alias("nome_prestadora"),
    )
    unknown = pairs.sparkSession.range(0, 1, 1, 1).select(
        F.lit(UNKNOWN_CARRIER).cast("bigint").alias("cod_prestadora"),
        F.lit(UNKNOWN_CARRIER_NAME).alias("nome_prestadora"),
    )
    return (
        named.where(F.col("cod_prestadora").isNotNull())
        .unionByName(unknown)
        .groupBy("cod_prestadora")
        .agg(F.max("nome_prestadora").alias("nome_prestadora"))
    )


def carriers_from_portability(staged: DataFrame) -> DataFrame:
    """Receivers and donors of staged portability rows, one name per code.

    One scan: distinct code/name combinations are reduced by hash in every task,
    then split into receiver and donor.
    """
    combinations = staged.select(
        "cod_receptora", "nome_receptora", "cod_doadora", "nome_doadora"
    ).distinct()
    pairs = combinations.select(
        F.inline(
            F.array(
                _pair(F.col("cod_receptora"), F.col("nome_receptora")),
                _pair(F.col("cod_doadora"), F.col("nome_doadora")),
            )
        )
    )
    return _one_name_per_code(pairs)


def carriers_from_numbering(staged: DataFrame) -> DataFrame:
    """Carriers of a staged numbering file type; the CNPJ is the code."""
    combinations = staged.select("cnpj_prestadora", "nome_prestadora").distinct()
    pairs = combinations.select(
        F.inline(F.array(_pair(F.col("cnpj_prestadora"), F.col("nome_prestadora"))))
    )
    return _one_name_per_code(pairs)


def upsert_carriers(carriers: DataFrame | None, sources: list[DataFrame]) -> DataFrame:
    """``carriers`` updated by each source in turn; the last source that has a code wins.

    Sources are the small outputs of the functions above, in the order portability,
    non-geographic, public utility, fixed and mobile; leave an absent one out.
    """
    tables = ([carriers] if carriers is not None else []) + list(sources)
    ranked = [
        t.select("cod_prestadora", "nome_prestadora", F.lit(i).alias("ordem"))
        for i, t in enumerate(tables)
    ]
    return (
        reduce(DataFrame.unionByName, ranked)
        .groupBy("cod_prestadora")
        .agg(F.max_by("nome_prestadora", "ordem").alias("nome_prestadora"))
    )
