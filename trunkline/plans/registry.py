"""Registered queries: every operator over inputs derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.functions import keys
from trunkline.functions import normalize as norm
from trunkline.operators import calls as call_records
from trunkline.operators import carriers, history, plan, quality, resolve, segments, validity
from trunkline.plans import files, inputs, loads
from trunkline.plans.oracle import EARLIER_DATE, REFERENCE_DATE
from trunkline.schemas import NUMBERING_FILES
from trunkline.session import shared_folder
from trunkline.sources import discovery, history_store, numbering, portability, preview, tables
from trunkline.streaming import enrich_calls_stream, load_portability_stream

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs ---------------------------------------------------------------------


def portability_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.landed(spark, sf_dir, "lines", inputs.PORTABILITY_LINES)


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines on their way into report files."""
    return inputs.passing(spark, sf_dir, inputs.PORTABILITY_LINES)


def typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portability.type_portability(portability_lines(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.landed(spark, sf_dir, "staged", inputs.STAGED_PORTABILITY)


def staged_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.landed(spark, sf_dir, "numbering", inputs.STAGED_NUMBERING)


def staged_cng(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.landed(spark, sf_dir, "cng", inputs.STAGED_CNG)


def staged_sup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.landed(spark, sf_dir, "sup", inputs.STAGED_SUP)


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.landed(spark, sf_dir, "numbers", inputs.NUMBERS)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.landed(spark, sf_dir, "calls", inputs.CALLS)


def dialled_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.landed(spark, sf_dir, "dialled", inputs.DIALLED_CALLS)


def history_table_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored history, as the loader leaves it."""
    return inputs.land_history(spark, sf_dir, dedup_portability)


def plan_table_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored segments of the numbering plan."""
    return inputs.land(spark, sf_dir, "segmentos", plan_segments)


def carriers_table_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored carrier names."""
    return inputs.land(spark, sf_dir, "prestadoras", upsert_carriers)


def lookup_tables(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History, plan and carrier names."""
    return (
        history_table_of(spark, sf_dir),
        plan_table_of(spark, sf_dir),
        carriers_table_of(spark, sf_dir),
    )


def normalized_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = norm.normalize_number_pair("numero_a", "numero_b", F.col("ddd"))
    return (
        dialled_calls(spark, sf_dir)
        .select("call_id", pair.alias("par"))
        .select("call_id", "par.*")
    )


# --- sources --------------------------------------------------------------------


@query
def scan_portability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files with their names, read back by position and typed."""
    folder = shared_folder(spark, "reports")
    files.write_reports(report_lines(spark, sf_dir), folder)
    return portability.type_portability(portability.scan_portability(spark, folder))


def _archives(spark: SparkSession, sf_dir: str) -> str:
    """Archives of all four types, one that is damaged and one of unknown type."""
    folder = shared_folder(spark, "planos")
    rows = staged_numbering(spark, sf_dir)
    sets = [
        (rows.where("servico = 'STFC'"), "STFC", F.col("cn")),
        (rows.where("servico = 'SMP_SME'"), "SMP_SME", F.col("cn")),
        (staged_cng(spark, sf_dir), "CNG", F.col("codigo_nao_geografico").cast("bigint") % 3),
        (staged_sup(spark, sf_dir), "SUP", F.col("numero_sup").cast("bigint") % 3),
    ]
    for some, kind, part in sets:
        name = F.concat(F.lit(f"{kind.split('_')[0]}_"), part, F.lit(".zip"))
        damaged = {"SMP_SME": "SMP_ruim.zip", "SUP": "PLANO_x.zip"}.get(kind)
        files.write_archives(some, kind, name, folder, damaged)
    return folder


@query
def scan_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all four types in one folder, found, dealt by type and unpacked."""
    folder = _archives(spark, sf_dir)
    common = ["nome_prestadora", "cnpj_prestadora", "nome_arquivo", "motivo"]
    numbered = ["cn", "prefixo", "faixa_inicial", "faixa_final", "codigo_cnl", "servico"]
    staged_rows = {
        kind: numbering.readable(
            numbering.stage_numbering(numbering.scan_archives(spark, folder, kind), kind)
        )
        for kind in NUMBERING_FILES
    }
    ranges = numbering.fixed_and_mobile(staged_rows["STFC"], staged_rows["SMP_SME"])
    return (
        ranges.select(*common, *numbered)
        .unionByName(
            staged_rows["CNG"].select(*common, "codigo_nao_geografico"), allowMissingColumns=True
        )
        .unionByName(staged_rows["SUP"].select(*common, "numero_sup"), allowMissingColumns=True)
    )


def _loaded_plan(spark: SparkSession, sf_dir: str) -> tuple[loads.Warehouse, loads.LoadResult]:
    warehouse = loads.Warehouse(spark, shared_folder(spark, "warehouse"))
    return warehouse, loads.load_numbering(warehouse, _archives(spark, sf_dir))


@query
def load_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives to the plan, the whole load."""
    return _loaded_plan(spark, sf_dir)[0].read("numeracao")


@query
def load_numbering_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_plan(spark, sf_dir)[1].report


@query
def query_numbers_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to tables to an answer, with text among the numbers that is none."""
    warehouse, _ = _loaded_plan(spark, sf_dir)
    folder = shared_folder(spark, "reports")
    files.write_reports(report_lines(spark, sf_dir), folder)
    loads.load_portability(warehouse, folder)
    asked = numbers(spark, sf_dir)
    junk = spark.createDataFrame([("abc",), ("+5511x",), (None,), ("abc",)], asked.schema)
    return warehouse.query_numbers_carriers(asked.unionByName(junk), REFERENCE_DATE)


@query
def file_type_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = inputs.derive(spark, sf_dir, inputs.FILE_NAMES)
    return names.select(
        "nome_arquivo", discovery.file_type(F.col("nome_arquivo")).alias("tipo")
    )


@query
def na_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.decode_missing_all(
        inputs.derive(spark, sf_dir, inputs.MARKED_VALUES), ["valor"]
    )


@query
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.load_report(typed_lines(spark, sf_dir), F.col("motivo"))


@query
def load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.load_totals(load_report(spark, sf_dir))


@query
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portability.rejected(typed_lines(spark, sf_dir))


def _call_files(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark, "calls")
    files.write_calls(dialled_calls(spark, sf_dir), folder)
    return folder


@query
def preview_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = discovery.list_files(spark, _call_files(spark, sf_dir), "*.csv.gz")
    return preview.preview_files(listed, 5)


@query
def header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = discovery.list_files(spark, _call_files(spark, sf_dir), "*.csv.gz")
    return preview.header_check(listed, ["timestamp", "origem", "destino", "duracao"])


@query
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call files and an empty one; sizes depend on the compression."""
    folder = _call_files(spark, sf_dir)
    files.write_bytes(spark, f"{folder}/sub/vazio.log")
    found = discovery.file_inventory(discovery.list_files(spark, folder), folder)
    return found.select(
        "nome", "caminho", "extensao", "formato", (F.col("tamanho") > 0).alias("com_conteudo")
    )


@query
def encoding_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "texts")
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files.write_texts(texts, folder, "UTF-8", "utf8")
    files.write_texts(texts, folder, "ISO-8859-1", "latin1")
    return preview.encoding_probe(spark, folder, "*.csv")


# --- typing ---------------------------------------------------------------------


@query
def flag_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("ind_portar_origem")
    return portability_lines(spark, sf_dir).select(
        text.alias("texto"), keys.flag_to_int(text).alias("valor")
    )


@query
def code_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("cod_receptora")
    return portability_lines(spark, sf_dir).select(
        text.alias("texto"), keys.code_to_int(text).alias("valor")
    )


@query
def required_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = typed_lines(spark, sf_dir)
    return portability.require_ids(typed).select("numero_bp", "tn_inicial")


@query
def area_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir).select(
        "tn_inicial", keys.area_code("tn_inicial").alias("cn")
    )


@query
def cn_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cn = (F.col("l_orderkey") % 120).cast("int")
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        cn.alias("cn"),
        keys.cn_bucket(cn).alias("cn_bucket"),
    )


@query
def query_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers(spark, sf_dir).select(*keys.query_keys("nu_terminal"))


@query
def parse_ref_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.derive(spark, sf_dir, inputs.DATE_TEXTS)
    return texts.select("o_orderkey", keys.reference_date("texto").alias("data"))


# --- numbers --------------------------------------------------------------------


@query
def clean_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialled_calls(spark, sf_dir).select(
        "call_id", "numero_a", norm.clean_number("numero_a").alias("limpo")
    )


@query
def strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = norm.clean_number("numero_b")
    return dialled_calls(spark, sf_dir).select(
        "call_id", norm.strip_call_prefix(cleaned).alias("numero")
    )


@query
def normalize_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = norm.normalize_number("numero_b", F.col("ddd"))
    return (
        dialled_calls(spark, sf_dir)
        .select("call_id", "numero_b", result.alias("r"))
        .select("call_id", "numero_b", "r.*")
    )


@query
def normalize_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized_calls(spark, sf_dir)


@query
def normalize_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    dialled = dialled_calls(spark, sf_dir)
    return call_records.normalize_calls(dialled, "numero_a", "numero_b", F.col("ddd"))


@query
def both_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.both_valid(normalized_calls(spark, sf_dir), "valid_a", "valid_b")


@query
def invalid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.invalid_count(normalized_calls(spark, sf_dir), "valid_a", "valid_b")


@query
def classify_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = ("number_a", "valid_a", "number_b", "valid_b")
    return normalized_calls(spark, sf_dir).select(
        "call_id",
        "number_a",
        "number_b",
        norm.classify_call(*pair).alias("tipo"),
        norm.classify_call(*pair, "DDD", "OUTROS").alias("tipo_ddd"),
    )


# --- plan, names, history -------------------------------------------------------


@query
def consolidate_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.consolidate_plan(
        staged_numbering(spark, sf_dir), staged_cng(spark, sf_dir)
    )


@query
def plan_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint segments of the plan, each with its carrier."""
    return segments.plan_segments(consolidate_plan(spark, sf_dir))


@query
def carriers_from_portability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carriers.carriers_from_portability(staged(spark, sf_dir))


@query
def carriers_from_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carriers.carriers_from_numbering(staged_sup(spark, sf_dir))


@query
def upsert_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carriers.upsert_carriers(
        None,
        [
            carriers.carriers_from_portability(staged(spark, sf_dir)),
            carriers.carriers_from_numbering(staged_cng(spark, sf_dir)),
            carriers.carriers_from_numbering(staged_sup(spark, sf_dir)),
            carriers.carriers_from_numbering(staged_numbering(spark, sf_dir)),
        ],
    )


@query
def dedup_portability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.dedup_portability(staged(spark, sf_dir))


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The whole staging in two arrivals."""
    rows = staged(spark, sf_dir)
    first, second = (rows.where(F.col("lote") == i) for i in (0, 1))
    return history.dedup_portability(first), history.dedup_portability(second)


@query
def upsert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.upsert_history(*_two_batches(spark, sf_dir))


@query
def history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals merged into the partitioned table on disk."""
    path = shared_folder(spark, "history")
    for batch in _two_batches(spark, sf_dir):
        history_store.merge_history(spark, batch, path)
    return history_store.read_history(spark, path)


@query
def rebuild_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second arrival replaces the table that the first one made."""
    path = shared_folder(spark, "history")
    first, second = _two_batches(spark, sf_dir)
    history_store.merge_history(spark, first, path)
    history_store.merge_history(spark, second, path, rebuild=True)
    return history_store.read_history(spark, path)


@query
def load_portability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to history table, the whole load."""
    folder = shared_folder(spark, "reports")
    files.write_reports(report_lines(spark, sf_dir), folder)
    warehouse = loads.Warehouse(spark, shared_folder(spark, "warehouse"))
    loads.load_portability(warehouse, folder)
    return warehouse.history.drop("cn_bucket", "valido_ate")


def _streamed(spark: SparkSession, sf_dir: str) -> loads.Warehouse:
    """Two arrivals of files, each loaded by one run of the stream; the second one has a
    damaged file among them."""
    root = shared_folder(spark, "stream")
    warehouse = loads.Warehouse(spark, f"{root}/warehouse")
    lines = portability_lines(spark, sf_dir)
    order = F.col("data_agendamento").substr(7, 4)
    for i, arrival in enumerate((order < "1999", order >= "1999")):
        files.write_reports(lines.where(arrival), f"{root}/in/{i}")
        if i:
            files.write_bytes(spark, f"{root}/in/{i}/ruim.csv.gz", b"no gzip file")
        load_portability_stream(
            warehouse, f"{root}/in", f"{root}/checkpoint"
        ).awaitTermination()
    return warehouse


@query
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).history.drop("cn_bucket", "valido_ate")


@query
def incremental_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier names after two arrivals."""
    return _streamed(spark, sf_dir).read("prestadoras")


@query
def incremental_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines of both arrivals, with the arrival's number."""
    return _streamed(spark, sf_dir).read("portabilidade_rejeitada")


@query
def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of files after two arrivals, with the damaged one in quarantine."""
    ledger = _streamed(spark, sf_dir).read("arquivos_portabilidade")
    return ledger.select(
        discovery.base_name(F.col("caminho")).alias("nome_arquivo"), "lote", "estado"
    )


# --- carrier queries ------------------------------------------------------------


@query
def range_join_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = resolve.numbers_to_query(numbers(spark, sf_dir))
    return resolve.assigned_carrier(keyed, plan_table_of(spark, sf_dir))


@query
def asof_single_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = resolve.numbers_to_query(numbers(spark, sf_dir))
    day = keys.parse_reference_date(REFERENCE_DATE)
    return resolve.ported_carrier(
        keyed, history_table_of(spark, sf_dir), {"cod_receptora": day}
    ).select("nu_terminal", "cod_receptora")


@query
def asof_per_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.asof_per_call(
        calls(spark, sf_dir).select("call_id", "origem", "dia"),
        history_table_of(spark, sf_dir),
        "origem",
        "dia",
    )


@query
def resolve_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve_carriers(
        numbers(spark, sf_dir), *lookup_tables(spark, sf_dir), REFERENCE_DATE
    )


@query
def portability_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.portability_rate(resolve_carriers(spark, sf_dir))


@query
def carrier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.carrier_counts(resolve_carriers(spark, sf_dir))


@query
def result_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The carrier answer written as CSV and read back."""
    folder = shared_folder(spark, "answer")
    answer = resolve_carriers(spark, sf_dir)
    tables.write_result(answer, folder)
    return spark.read.schema(answer.schema).csv(folder, header=True)


@query
def carrier_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.carrier_change(
        numbers(spark, sf_dir),
        *lookup_tables(spark, sf_dir),
        EARLIER_DATE,
        REFERENCE_DATE,
    )


@query
def carrier_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of carrier between two dates over the whole history, without a list of numbers."""
    first, last = (keys.parse_reference_date(d) for d in (EARLIER_DATE, REFERENCE_DATE))
    return validity.carrier_changes(history_table_of(spark, sf_dir), first, last)


@query
def distinct_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = resolve.numbers_to_query(calls(spark, sf_dir), "origem", "destino")
    return keyed.select("nu_terminal")


@query
def enrich_cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.enrich_calls(
        calls(spark, sf_dir),
        *lookup_tables(spark, sf_dir),
        "origem",
        "destino",
        REFERENCE_DATE,
    )


@query
def enrich_cdr_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of calls, each enriched by one run of the stream."""
    root = shared_folder(spark, "chamadas")
    warehouse = loads.Warehouse(spark, f"{root}/warehouse")
    history_store.merge_history(
        spark, dedup_portability(spark, sf_dir), warehouse.path("portabilidade_historico")
    )
    tables.write_table(plan_table_of(spark, sf_dir), warehouse.path("numeracao_segmentos"))
    tables.replace_table(carriers_table_of(spark, sf_dir), warehouse.path("prestadoras"))
    rows = calls(spark, sf_dir)
    for i in (0, 1):
        rows.where(F.col("call_id") % 2 == i).write.mode("append").parquet(f"{root}/in")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        enrich_calls_stream(
            warehouse, arriving, "origem", "destino", f"{root}/out", f"{root}/checkpoint",
            REFERENCE_DATE,
        ).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("lote")
