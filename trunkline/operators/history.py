"""Portability history: keyed deduplication and upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trunkline.functions.keys import UNKNOWN_CARRIER, area_code
from trunkline.schemas import HISTORY, HISTORY_KEY

# Later values win; the order is total, so a result never depends on the plan.
_PRECEDENCE = [
    "nome_arquivo",
    "data_hora",
    "numero_bp",
    "cod_receptora",
    "cod_doadora",
    "cod_status",
    "ind_portar_origem",
]


def dedup_portability(staged: DataFrame) -> DataFrame:
    """One history row per number and day: the one from the greatest file name.

    The winner is an aggregate, ``max`` over a struct in order of precedence, so
    every task reduces its own rows to one per key before the shuffle; a key that
    holds a large part of the input never travels whole.
    """
    ranked = staged.select(
        F.col("tn_inicial").cast("bigint").alias("tn_inicial"),
        F.to_date("data_agendamento").alias("data_agendamento"),
        F.struct(
            *[
                F.col("data_agendamento").alias(c) if c == "data_hora" else F.col(c)
                for c in _PRECEDENCE
            ]
        ).alias("linha"),
    )
    winners = ranked.groupBy("tn_inicial", "data_agendamento").agg(
        F.max("linha").alias("linha")
    )
    unknown = F.lit(UNKNOWN_CARRIER)
    return winners.select(
        "tn_inicial",
        F.col("linha.numero_bp").cast("bigint").alias("numero_bp"),
        "data_agendamento",
        F.coalesce("linha.cod_receptora", unknown).cast("int").alias("cod_receptora"),
        F.coalesce("linha.cod_doadora", unknown).cast("int").alias("cod_doadora"),
        F.col("linha.cod_status").cast("int").alias("cod_status"),
        F.col("linha.ind_portar_origem").cast("int").alias("ind_portar_origem"),
        area_code("tn_inicial").alias("cn"),
        F.col("linha.nome_arquivo").alias("nome_arquivo"),
    )


def upsert_history(history: DataFrame, batch: DataFrame) -> DataFrame:
    """``history`` with the rows of a deduplicated ``batch`` added or replaced by key.

    Both sides are unique on the key. The anti join lets Spark broadcast a small
    monthly batch, in which case the history is not shuffled at all; a large
    batch becomes a sort-merge join on the full key.
    """
    columns = HISTORY.fieldNames()
    kept = history.select(columns).join(
        batch.select(HISTORY_KEY), HISTORY_KEY, "left_anti"
    )
    return kept.select(columns).unionByName(batch.select(columns))
