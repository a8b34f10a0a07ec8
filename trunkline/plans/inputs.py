"""Call-record inputs derived from the given star-schema tables.

The tables hold no telephone data, so numbers, porting requests, numbering ranges
and calls are computed from their keys. Every derivation is one SQL expression that
Spark and DuckDB both understand; it covers the whole table and grows with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trunkline.functions.keys import MISSING_MARKS
from trunkline.session import shared_folder
from trunkline.sources.history_store import merge_history, read_history


def mobile(prefix: str, last: str) -> str:
    """An 11-digit mobile number from two whole-number expressions."""
    return (
        f"concat(cast(10*(1+({prefix})%9)+1 as string), '9', "
        f"lpad(cast(cast(floor(({prefix})/9) as bigint)%10000 as string),4,'0'), "
        f"lpad(cast(({last})%10000 as string),4,'0'))"
    )


def fixed(prefix: str, last: str) -> str:
    """A 10-digit fixed number from two whole-number expressions."""
    return (
        f"concat(cast(10*(1+({prefix})%9)+1 as string), '3', "
        f"lpad(cast(cast(floor(({prefix})/9) as bigint)%1000 as string),3,'0'), "
        f"lpad(cast(({last})%10000 as string),4,'0'))"
    )


def _case(key: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then {v}" for i, v in enumerate(values[:-1]))
    return f"case {key} {whens} else {values[-1]} end"


_BR_DATE = (
    "concat(lpad(cast(day(l_shipdate) as string),2,'0'),'/',"
    "lpad(cast(month(l_shipdate) as string),2,'0'),'/',"
    "cast(year(l_shipdate) as string),' ',"
    "lpad(cast(l_linenumber as string),2,'0'),':00:00')"
)

#: Report lines, all text, with missing, malformed and unknown values. The files that they
#: name hold so many orders each, so there are more files where there are more lines.
PORTABILITY_LINES = f"""
select '1' tipo_registro,
  case when l_orderkey%211=0 then '' else cast(l_orderkey*10+l_linenumber as string) end numero_bp,
  case when l_orderkey%223=0 then 'sem numero' else {mobile("l_partkey", "l_orderkey%50")} end tn_inicial,
  case when l_suppkey%40=0 then 'x' else concat('0',cast(100+l_suppkey%40 as string)) end cod_receptora,
  case when l_suppkey%40=0 then 'N/A' else concat('Operadora ',cast(100+l_suppkey%40 as string)) end nome_receptora,
  case when l_linenumber=1 then '' else concat('0',cast(100+l_linenumber as string)) end cod_doadora,
  case when l_linenumber=1 then '' else concat('Doadora ',cast(100+l_linenumber as string)) end nome_doadora,
  case when l_orderkey%307=0 then '31/02/2010 00:00:00' else {_BR_DATE} end data_agendamento,
  cast(1+l_linenumber%3 as string) cod_status,
  'Ativo' status,
  case when l_orderkey%401=0 then 'Talvez' when l_returnflag='R' then 'Sim' else 'Nao' end ind_portar_origem,
  concat('relatorio_',l_returnflag,l_linestatus,'_',
    lpad(cast(cast(floor(l_orderkey/100000) as bigint) as string),6,'0'),'.csv.gz') nome_arquivo
from lineitem"""

#: Staged porting requests, typed.
STAGED_PORTABILITY = f"""
select cast(1 as bigint) tipo_registro,
  l_orderkey*10+l_linenumber numero_bp,
  cast({mobile("l_partkey", "l_orderkey%50")} as bigint) tn_inicial,
  cast(nullif(100+l_suppkey%40,100) as int) cod_receptora,
  case when l_suppkey%40=0 then 'Sem codigo'
       when l_linenumber%2=0 then concat('OPERADORA ',cast(100+l_suppkey%40 as string))
       else concat('Operadora ',cast(100+l_suppkey%40 as string)) end nome_receptora,
  cast(nullif(100+l_linenumber,101) as int) cod_doadora,
  case when l_linenumber=1 then null else concat('Operadora ',cast(100+l_linenumber as string)) end nome_doadora,
  l_shipdate data_agendamento,
  cast(1+l_linenumber%3 as int) cod_status,
  'Ativo' status,
  cast(case when l_returnflag='R' then 1 else 0 end as int) ind_portar_origem,
  concat('relatorio_',l_returnflag,l_linestatus,'.csv.gz') nome_arquivo,
  l_orderkey%2 lote
from lineitem"""

_RANGE = """
select concat('Prestadora ',cast(p_partkey%20 as string)) nome_prestadora,
  cast({cnpj} as string) cnpj_prestadora,
  cast(10*(1+p_partkey%9)+1 as string) cn,
  case when p_partkey%4=0
    then concat('3',lpad(cast(cast(floor(p_partkey/9) as bigint)%1000 as string),3,'0'))
    else concat('9',lpad(cast(cast(floor(p_partkey/9) as bigint)%10000 as string),4,'0')) end prefixo,
  {first} faixa_inicial,
  {last} faixa_final,
  case when p_partkey%4=0 then cast(11000+p_partkey%50 as string) end codigo_cnl,
  case when p_partkey%4=0 then 'STFC' else 'SMP_SME' end servico
from part {where}"""

#: Fixed and mobile ranges, all text; some overlap and some are copies.
STAGED_NUMBERING = " union all ".join(
    _RANGE.format(cnpj=cnpj, first=first, last=last, where=where)
    for cnpj, first, last, where in [
        ("33000118000000+p_partkey%20", "'0000'",
         "case when p_partkey%3=0 then '0024' else '9999' end", ""),
        ("33000118000000+p_partkey%7", "'0010'", "'0029'", "where p_partkey%5=0"),
        ("33000118000000+p_partkey%6", "'0000'",
         "case when p_partkey%3=0 then '0024' else '9999' end", "where p_partkey%11=0"),
    ]
)

#: Non-geographic codes, all text.
STAGED_CNG = """
select concat('Gratuita ',cast(s_suppkey%10 as string)) nome_prestadora,
  cast(40432544000100+s_suppkey%10 as string) cnpj_prestadora,
  concat('800',lpad(cast(s_suppkey%10000000 as string),7,'0')) codigo_nao_geografico
from supplier"""

#: Public-utility codes, all text; they name carriers only.
STAGED_SUP = """
select case when c_custkey%30=3 then null else concat('Utilidade ',cast(c_custkey%30 as string)) end nome_prestadora,
  case when c_custkey%30=4 then null else cast(50000000000000+c_custkey%30 as string) end cnpj_prestadora,
  cast(190+c_custkey%10 as string) numero_sup
from customer"""

#: Numbers to look up, as text: mobile, fixed, non-geographic and of odd lengths.
NUMBERS = f"""
select case
    when o_orderkey%23=0 then concat('800',lpad(cast(o_custkey%10000000 as string),7,'0'))
    when o_orderkey%23=1 then substring({mobile("o_custkey", "o_orderkey%50")},4,8)
    when o_orderkey%23=2 then {fixed("o_custkey", "o_orderkey%50")}
    when o_orderkey%23=3 then concat('55',{mobile("o_custkey", "o_orderkey%50")})
    else {mobile("o_custkey", "o_orderkey%50")} end nu_terminal
from orders"""

#: Calls with clean numbers and the day of the call.
CALLS = f"""
select l_orderkey*10+l_linenumber call_id,
  cast({mobile("l_partkey", "l_suppkey%60")} as bigint) origem,
  cast({mobile("l_partkey+l_linenumber*40", "l_orderkey%60")} as bigint) destino,
  cast(l_shipdate as date) dia
from lineitem"""

_A = mobile("l_partkey", "l_suppkey%60")
_B = mobile("l_suppkey+l_orderkey", "l_partkey%10000")
_NOISE = (
    "cast((l_orderkey*48271+l_partkey*7919+l_suppkey*104729+l_linenumber*611953)"
    "%1000000007 as string)"
)
# Noise digits of 1 to 15 places, so that every branch of the grammar is reached.
_DIGITS = (
    f"substring(concat({_NOISE},reverse({_NOISE})),1,"
    "cast(3+l_linenumber+l_suppkey%6 as int))"
)

SPELLINGS = [
    "concat('(',substring(a,1,2),')',substring(a,3,5),'-',substring(a,8,4))",
    "concat(substring(a,1,7),'-',substring(a,8,4))",
    "a",
    "concat('+55',substring(a,1,7),'-',substring(a,8,4))",
    "concat('+55',a)",
    "concat('(0',substring(a,1,2),')',substring(a,3,5),'-',substring(a,8,4))",
    "concat('0',a)",
    "concat('90',a)",
    "concat('0 15 ',substring(a,1,2),' ',substring(a,3,9))",
    "concat(a,';123')",
    "concat('9090',a)",
    "concat(a,'ff')",
    "concat(substring(a,1,2),'3',substring(a,5,7))",
    "d",
    "concat('invalid ',substring(d,1,2))",
    "case when call_id%3=0 then null else concat('f',d,'oo') end",
]

LOCAL_SPELLINGS = [
    "substring(b,3,9)",
    "concat(substring(b,3,5),'-',substring(b,8,4))",
    "concat('3',substring(b,5,7))",
    "'190'",
    "concat('0800-',substring(b,4,3),'-',substring(b,7,4))",
    "concat('5511',substring('103211358190911',1,cast(3+call_id%3 as int)))",
    "b",
    "concat('00',b)",
    "concat('90',substring(b,3,9))",
    "concat('78',substring(b,6,6))",
    "concat(substring(b,1,2),'78',substring(b,6,6))",
    "d",
    "concat('55',d)",
    "concat(substring(b,1,2),d)",
    "concat('7x',substring(b,4,8))",
    "''",
]

#: Calls with numbers as dialled: many spellings, local forms and noise.
DIALLED_CALLS = f"""
select call_id,
  {_case("call_id%16", SPELLINGS)} numero_a,
  {_case("k", LOCAL_SPELLINGS)} numero_b,
  {_case("call_id%5", ["''", "'11'", "'21'", "'85'", "null"])} ddd
from (select l_orderkey*10+l_linenumber call_id, (l_partkey+l_suppkey*3)%16 k,
        {_A} a, {_B} b, {_DIGITS} d from lineitem) t"""

#: Text values among them every mark of a missing value.
MARKED_VALUES = (
    "select l_orderkey*10+l_linenumber id, "
    + _case(
        f"l_orderkey%{len(MISSING_MARKS) + 3}",
        [f"'{m}'" for m in MISSING_MARKS] + ["'na'", "'x'", "cast(l_partkey as string)"],
    )
    + " valor from lineitem"
)

#: File names of every type.
FILE_NAMES = (
    "select concat("
    + _case(
        "p_partkey%8",
        ["'STFC_'", "'stfc-fatb_'", "'SMP'", "'Sme_'", "'cng_'", "'SUP-'", "'PLANO_'", "'X_SMP_'"],
    )
    + ", cast(p_partkey as string), '.zip') nome_arquivo from part"
)

#: Reference dates as text in every accepted format and in others.
DATE_TEXTS = (
    "select o_orderkey, "
    + _case(
        "o_orderkey%7",
        [
            "concat(y,'-',lpad(m,2,'0'),'-',lpad(d,2,'0'))",
            "concat(lpad(d,2,'0'),'/',lpad(m,2,'0'),'/',y)",
            "concat(y,lpad(m,2,'0'),lpad(d,2,'0'))",
            "concat(d,'/',m,'/',y)",
            "concat(y,'-',m,'-',d)",
            "concat(lpad(d,2,'0'),'-',lpad(m,2,'0'),'-',y)",
            "concat(y,'-02-30')",
        ],
    )
    + " texto from (select o_orderkey, cast(year(o_orderdate) as string) y, "
    "cast(month(o_orderdate) as string) m, cast(day(o_orderdate) as string) d from orders) t"
)


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the derivations above over the parquet tables of ``sf_dir``."""
    tables = {}
    for table in ("lineitem", "orders", "part", "supplier", "customer"):
        if f"from {table}" in sql:
            tables[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
            sql = sql.replace(f"from {table}", f"from {{{table}}}")
    return spark.sql(sql, **tables)


_landed: dict[tuple[str, str, str], str] = {}


def land(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    build: Callable[[SparkSession, str], DataFrame],
) -> DataFrame:
    """A derived input as the parquet table that a user would have, written once a session.

    Queries then start at a scan, as they do in use, with its pushdown and pruning.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = shared_folder(spark, name)
        build(spark, sf_dir).write.parquet(path)
        _landed[key] = path
    return spark.read.parquet(_landed[key])


def land_history(
    spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """The history as the merge of the loads stores it, written once a session."""
    key = (spark.sparkContext.applicationId, sf_dir, "historico")
    if key not in _landed:
        path = shared_folder(spark, "historico")
        merge_history(spark, build(spark, sf_dir), path)
        _landed[key] = path
    return read_history(spark, _landed[key])


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of a scan over all cores, without a shuffle where its splits are enough for them.

    A table of some 4 MB a core has as many splits, and a larger one gets more of them, so
    that only small tables are dealt out and no task's share grows with the table.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def landed(spark: SparkSession, sf_dir: str, name: str, sql: str) -> DataFrame:
    return land(spark, sf_dir, name, lambda s, d: _spread(derive(s, d, sql)))


def passing(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A derived input that goes into files of its own, so it needs no table before them."""
    return _spread(derive(spark, sf_dir, sql))
