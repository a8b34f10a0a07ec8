"""Fixed, positional schemas of the files and tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


#: Portability report, as read (file order; the header row repeats names).
PORTABILITY_FILE = _strings(
    "tipo_registro numero_bp tn_inicial cod_receptora nome_receptora cod_doadora "
    "nome_doadora data_agendamento cod_status status ind_portar_origem"
)

#: Numbering-plan files by type, as read (file order).
NUMBERING_FILES = {
    "STFC": _strings(
        "nome_prestadora cnpj_prestadora uf cn prefixo faixa_inicial faixa_final "
        "codigo_cnl nome_localidade area_local sigla_area_local codigo_area_local status"
    ),
    "SMP_SME": _strings(
        "nome_prestadora cnpj_prestadora cn prefixo faixa_inicial faixa_final status"
    ),
    "CNG": _strings("nome_prestadora cnpj_prestadora codigo_nao_geografico status"),
    "SUP": _strings(
        "nome_prestadora cnpj_prestadora numero_sup extensao uf cn codigo_municipio "
        "nome_municipio instituicao tipo status"
    ),
}

STAGED_PORTABILITY = T.StructType(
    [
        T.StructField("tipo_registro", T.LongType()),
        T.StructField("numero_bp", T.LongType()),
        T.StructField("tn_inicial", T.LongType()),
        T.StructField("cod_receptora", T.IntegerType()),
        T.StructField("nome_receptora", T.StringType()),
        T.StructField("cod_doadora", T.IntegerType()),
        T.StructField("nome_doadora", T.StringType()),
        T.StructField("data_agendamento", T.TimestampNTZType()),
        T.StructField("cod_status", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("ind_portar_origem", T.IntegerType()),
        T.StructField("nome_arquivo", T.StringType()),
    ]
)

HISTORY = T.StructType(
    [
        T.StructField("tn_inicial", T.LongType()),
        T.StructField("numero_bp", T.LongType()),
        T.StructField("data_agendamento", T.DateType()),
        T.StructField("cod_receptora", T.IntegerType()),
        T.StructField("cod_doadora", T.IntegerType()),
        T.StructField("cod_status", T.IntegerType()),
        T.StructField("ind_portar_origem", T.IntegerType()),
        T.StructField("cn", T.IntegerType()),
        T.StructField("nome_arquivo", T.StringType()),
    ]
)

#: Key of the portability history.
HISTORY_KEY = ["cn", "tn_inicial", "data_agendamento"]

NUMBERING_PLAN = T.StructType(
    [
        T.StructField("cn", T.IntegerType()),
        T.StructField("prefixo", T.IntegerType()),
        T.StructField("faixa_inicial", T.LongType()),
        T.StructField("faixa_final", T.LongType()),
        T.StructField("codigo_cnl", T.IntegerType()),
        T.StructField("cod_prestadora", T.LongType()),
    ]
)
