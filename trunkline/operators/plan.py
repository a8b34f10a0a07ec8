"""Numbering plan: typed ranges from the staged file types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trunkline.schemas import NUMBERING_PLAN

_NO_LOCALITY = -1


_PROVENANCE = ("nome_arquivo", "motivo")


def _typed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(
        *[
            columns[f.name].try_cast(f.dataType).alias(f.name)
            for f in NUMBERING_PLAN.fields
        ],
        *[c for c in _PROVENANCE if c in df.columns],
    )


def _geographic(fixed_and_mobile: DataFrame) -> DataFrame:
    def full_number(last: str) -> Column:
        return F.concat_ws("", "cn", "prefixo", last)

    return _typed(
        fixed_and_mobile,
        {
            "cn": F.col("cn"),
            "prefixo": F.col("prefixo"),
            "faixa_inicial": full_number("faixa_inicial"),
            "faixa_final": full_number("faixa_final"),
            "codigo_cnl": F.coalesce("codigo_cnl", F.lit(str(_NO_LOCALITY))),
            "cod_prestadora": F.col("cnpj_prestadora"),
        },
    )


def _non_geographic(codes: DataFrame) -> DataFrame:
    code = F.col("codigo_nao_geografico")
    return _typed(
        codes,
        {
            "cn": F.substring(code, 1, 2),
            "prefixo": F.substring(code, 3, 4),
            "faixa_inicial": code,
            "faixa_final": code,
            "codigo_cnl": F.lit(_NO_LOCALITY),
            "cod_prestadora": F.col("cnpj_prestadora"),
        },
    )


def _all_ranges(fixed_and_mobile: DataFrame, non_geographic: DataFrame) -> DataFrame:
    return _geographic(fixed_and_mobile).unionByName(_non_geographic(non_geographic))


def _complete() -> Column:
    complete = F.lit(True)
    for f in NUMBERING_PLAN.fields:
        complete = complete & F.col(f.name).isNotNull()
    return complete


def consolidate_plan(fixed_and_mobile: DataFrame, non_geographic: DataFrame) -> DataFrame:
    """Ranges of fixed, mobile and non-geographic numbers; every column is required."""
    ranges = _all_ranges(fixed_and_mobile, non_geographic)
    return ranges.where(_complete()).select(NUMBERING_PLAN.fieldNames())


def rejected_ranges(fixed_and_mobile: DataFrame, non_geographic: DataFrame) -> DataFrame:
    """Ranges that the plan leaves out, as far as their values parse.

    Rows with a column ``motivo`` have been rejected before, and all of them are given back
    with file and reason; of other rows those count that are not complete.
    """
    ranges = _all_ranges(fixed_and_mobile, non_geographic)
    return ranges if "motivo" in ranges.columns else ranges.where(~_complete())
