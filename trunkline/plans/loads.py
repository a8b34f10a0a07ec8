"""End-to-end loads: files to warehouse tables."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.operators.carriers import (
    carriers_from_numbering,
    carriers_from_portability,
    upsert_carriers,
)
from trunkline.operators.history import dedup_portability
from trunkline.operators.plan import consolidate_plan, rejected_ranges
from trunkline.operators.quality import load_report, load_totals
from trunkline.operators.resolve import RefDate, resolve_carriers, unknown_numbers
from trunkline.operators.segments import plan_segments
from trunkline.schemas import NUMBERING_FILES
from trunkline.sources.discovery import base_name, file_type, list_files
from trunkline.sources.history_store import merge_history, read_history
from trunkline.sources.numbering import (
    ARCHIVE_PATTERN,
    accepted_rows,
    fixed_and_mobile,
    readable,
    rejected_rows,
    scan_archives,
    stage_numbering,
)
from trunkline.sources.portability import (
    FILE_SCHEMA,
    REPORT_PATTERN,
    accepted,
    damaged_reports,
    scan_portability,
    scan_reports,
    type_portability,
)
from trunkline.sources.tables import (
    drop_table,
    has_versions,
    materialize,
    read_versioned,
    replace_table,
    table_exists,
    write_table,
)


#: Numbers of a list up to which they are broadcast to cut the history down.
BROADCAST_NUMBERS = 1_000_000


@dataclass(frozen=True)
class LoadResult:
    """Report per file of a load, and how long the load took."""

    report: DataFrame
    seconds: float

    def totals(self) -> DataFrame:
        return load_totals(self.report, self.seconds)


@dataclass(frozen=True)
class Warehouse:
    """Table folders below one root that all nodes can reach."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        if has_versions(self.spark, self.path(table)):
            return read_versioned(self.spark, self.path(table))
        return self.spark.read.parquet(self.path(table))

    def has(self, table: str) -> bool:
        return table_exists(self.spark, self.path(table))

    @property
    def history(self) -> DataFrame:
        return read_history(self.spark, self.path("portabilidade_historico"))

    def query_numbers_carriers(
        self, numbers: Iterable | DataFrame, reference_date: RefDate = None
    ) -> DataFrame:
        """Carrier of each number from the stored tables, as ``resolve_carriers`` gives it.

        ``numbers`` is a list or other iterable of numbers or texts, or a DataFrame
        whose first column holds them. A list with text that is no number raises; in a
        DataFrame each different such text, and NULL, gives a row without number and
        name, neither ported nor assigned.
        """
        few = None
        if not isinstance(numbers, DataFrame):
            if isinstance(numbers, (str, bytes)) or not isinstance(numbers, Iterable):
                raise TypeError("numbers must be a list, an iterable or a DataFrame")
            rows = [(str(n),) for n in numbers]
            if not rows:
                raise ValueError("numbers cannot be empty")
            few = len(rows) <= BROADCAST_NUMBERS
            numbers = self.spark.createDataFrame(rows, "nu_terminal string")
            unknown = unknown_numbers(numbers, "nu_terminal").first()
            if unknown is not None:
                raise ValueError(f"not a number: {unknown[0]!r}")
        answer = resolve_carriers(
            numbers,
            self.history,
            self.read("numeracao_segmentos"),
            self.read("prestadoras"),
            reference_date,
            (numbers.columns[0],),
            few_numbers=few,
        )
        none = [F.lit(None).cast(answer.schema[c].dataType) for c in answer.columns[:2]]
        no_answer = unknown_numbers(numbers, numbers.columns[0]).select(*none, F.lit(0), F.lit(0))
        return answer.union(no_answer)


def update_carriers(warehouse: Warehouse) -> None:
    """Rebuild the carrier names from the old names and every staged table there is."""
    found = []
    if warehouse.has("stg_portabilidade"):
        staged = warehouse.read("stg_portabilidade").where(F.col("motivo").isNull())
        found.append(carriers_from_portability(staged))
    for table in ("stg_cng", "stg_sup", "stg_numeracao"):
        if warehouse.has(table):
            found.append(carriers_from_numbering(readable(warehouse.read(table))))
    old = warehouse.read("prestadoras") if warehouse.has("prestadoras") else None
    replace_table(upsert_carriers(old, found), warehouse.path("prestadoras"))


def apply_reports(warehouse: Warehouse, staged: DataFrame, rebuild: bool = False) -> None:
    """What follows on staging, for batch loads and streams: history, then names."""
    merge_history(
        warehouse.spark,
        dedup_portability(accepted(staged)),
        warehouse.path("portabilidade_historico"),
        rebuild,
    )
    update_carriers(warehouse)


def _unreadable(error: Exception) -> bool:
    """Whether a job failed because a file could not be read."""
    return "FAILED_READ_FILE" in str(error)


def _stage_reports(
    spark: SparkSession, path: str, files: DataFrame, stage: str, encoding: str
) -> dict[str, str]:
    """Write the staging table; the files that cannot be read, by path, with the reason.

    Only after such a failure are the files tried one by one, and the good ones staged.
    """
    try:
        write_table(type_portability(scan_portability(spark, path, encoding)), stage)
        return {}
    except Exception as error:
        if not _unreadable(error):
            raise
        # One short path a file, as the file system listed them.
        paths = [r.path for r in files.select("path").collect()]
        return _stage_good_files(spark, paths, stage, encoding)


def stage_files(
    spark: SparkSession, paths: list[str], stage: str, encoding: str
) -> dict[str, str]:
    """The same for files given by their paths."""
    try:
        write_table(type_portability(scan_reports(spark, paths, encoding)), stage)
        return {}
    except Exception as error:
        if not _unreadable(error):
            raise
        return _stage_good_files(spark, paths, stage, encoding)


def _stage_good_files(
    spark: SparkSession, paths: list[str], stage: str, encoding: str
) -> dict[str, str]:
    damaged = damaged_reports(spark, paths)
    good = [p for p in paths if p not in damaged]
    rows = scan_reports(spark, good, encoding) if good else _no_lines(spark)
    write_table(type_portability(rows), stage)
    return damaged


def _no_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FILE_SCHEMA).withColumn(
        "nome_arquivo", F.lit(None).cast("string")
    )


def with_all_files(
    report: DataFrame, files: DataFrame, damaged: dict[str, str] | None = None
) -> DataFrame:
    """The report with a line for every file, also those without rows or not readable."""
    spark = files.sparkSession
    why = spark.createDataFrame(list((damaged or {}).items()), "path string, _motivo string")
    names = files.join(why, "path", "left").groupBy(
        base_name(F.col("path")).alias("nome_arquivo")
    ).agg(F.max("_motivo").alias("_motivo"))
    return names.join(report, "nome_arquivo", "left").select(
        "nome_arquivo",
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("linhas_lidas", "linhas", "rejeitadas")
        ],
        F.coalesce("_motivo", "erro").alias("erro"),
        F.when(F.col("_motivo").isNotNull(), "error")
        .otherwise(F.coalesce("status", F.lit("success")))
        .alias("status"),
    )


def load_portability(
    warehouse: Warehouse,
    path: str,
    rebuild: bool = False,
    drop_staging: bool = False,
    encoding: str = "UTF-8",
) -> LoadResult:
    """Load portability reports into the history and the carrier names.

    Staging holds the lines of this load, rejected ones with their reason. Within one
    load the greatest file name wins; between loads the later load wins. A folder
    without reports changes nothing. A file that cannot be read is reported as an error,
    and nothing of it is loaded.
    """
    start = time.monotonic()
    spark = warehouse.spark
    files = list_files(spark, path, REPORT_PATTERN)
    if files.isEmpty():
        return _result(load_report(_no_rows(spark), F.lit(None).cast("string")), start)
    stage = warehouse.path("stg_portabilidade")
    damaged = _stage_reports(spark, path, files, stage, encoding)
    staged = spark.read.parquet(stage)
    report = load_report(staged, F.col("motivo"))
    result = _result(with_all_files(report, files, damaged), start)
    apply_reports(warehouse, staged, rebuild)
    if drop_staging:
        drop_table(spark, stage)
    return replace(result, seconds=time.monotonic() - start)


def load_numbering(
    warehouse: Warehouse, path: str, drop_staging: bool = False
) -> LoadResult:
    """Load numbering-plan archives into the plan and the carrier names.

    The plan and its segments are replaced; rejected rows go to ``numeracao_rejeitada`` instead, with file and
    reason, and count in the report. Public-utility files are staged and name
    carriers, but are no part of the plan. A file that cannot be read, or whose type is
    unknown, is reported as an error. A folder without archives changes nothing.
    """
    start = time.monotonic()
    spark = warehouse.spark
    files = list_files(spark, path, ARCHIVE_PATTERN)
    if files.isEmpty():
        return _result(load_report(_no_rows(spark), F.lit(None).cast("string")), start)
    rows = {
        kind: stage_numbering(scan_archives(spark, path, kind), kind)
        for kind in NUMBERING_FILES
    }
    staging = {
        "stg_numeracao": fixed_and_mobile(rows["STFC"], rows["SMP_SME"]),
        "stg_cng": rows["CNG"],
        "stg_sup": rows["SUP"],
    }
    for table, staged in staging.items():
        write_table(staged, warehouse.path(table))
    ranges = [warehouse.read(t) for t in ("stg_numeracao", "stg_cng")]
    write_table(consolidate_plan(*map(accepted_rows, ranges)), warehouse.path("numeracao"))
    write_table(plan_segments(warehouse.read("numeracao")), warehouse.path("numeracao_segmentos"))
    write_table(
        rejected_ranges(*map(rejected_rows, ranges)), warehouse.path("numeracao_rejeitada")
    )
    update_carriers(warehouse)
    lines = reduce(
        DataFrame.unionByName,
        [
            warehouse.read(t).select(
                "nome_arquivo", "erro", F.coalesce("erro", "motivo").alias("motivo")
            )
            for t in staging
        ],
    )
    report = with_all_files(load_report(lines, F.col("motivo"), F.col("erro")), files)
    known = file_type(F.col("nome_arquivo")).isNotNull()
    report = report.withColumns(
        {
            "erro": F.when(known, F.col("erro")).otherwise("tipo desconhecido"),
            "status": F.when(known, F.col("status")).otherwise("error"),
        }
    )
    result = _result(report, start)
    if drop_staging:
        for table in staging:
            drop_table(spark, warehouse.path(table))
    return replace(result, seconds=time.monotonic() - start)


def _no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "nome_arquivo string")


def _result(report: DataFrame, start: float) -> LoadResult:
    """The report as a table of its own, so that it outlives the staging tables."""
    return LoadResult(materialize(report, "report"), time.monotonic() - start)
