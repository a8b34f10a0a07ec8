"""Incremental load: new portability reports are merged as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trunkline.operators.quality import load_report
from trunkline.plans.loads import Warehouse, apply_reports, stage_files, with_all_files
from trunkline.sources.portability import REPORT_PATTERN, rejected
from trunkline.sources.tables import write_table

#: What the ledger of files says of a file.
LOADED, QUARANTINED = "carregado", "quarentena"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_LEDGER = "arquivos_portabilidade"


def arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of the report files of a folder as a stream; nothing of them is read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", REPORT_PATTERN)
        .load(folder)
        .select("path", "length")
    )


def _load_files(
    warehouse: Warehouse, files: DataFrame, lote: int, encoding: str
) -> tuple[int, int]:
    """Load what can be read of some files; how many were loaded and how many were not."""
    spark = warehouse.spark
    # One row a file, as the file system listed them.
    found = [tuple(r) for r in files.select("path", "length").collect()]
    if not found:
        return 0, 0
    stage = warehouse.path("stg_portabilidade")
    damaged = stage_files(spark, [path for path, _ in found], stage, encoding)
    staged = spark.read.parquet(stage)
    listed = spark.createDataFrame(found, "path string, length bigint")
    report = with_all_files(load_report(staged, F.col("motivo")), listed, damaged)
    ledger = spark.createDataFrame(
        [
            (path, length, QUARANTINED if path in damaged else LOADED, damaged.get(path))
            for path, length in found
        ],
        "caminho string, tamanho bigint, estado string, motivo string",
    )
    for table, rows in (
        ("relatorio_portabilidade", report),
        ("portabilidade_rejeitada", rejected(staged)),
    ):
        write_table(rows, f"{warehouse.path(table)}/lote={lote}")
    apply_reports(warehouse, staged)
    # Last, so that a file counts as loaded only once it is.
    write_table(ledger, f"{warehouse.path(_LEDGER)}/lote={lote}")
    return len(found) - len(damaged), len(damaged)


def load_portability_stream(
    warehouse: Warehouse, folder: str, checkpoint: str, encoding: str = "UTF-8"
) -> StreamingQuery:
    """Load every report that is new since the last run, as a batch load does, then stop.

    All files of one arrival form one micro-batch: inside a batch the greatest file
    name wins, between batches the later batch, so the batch boundaries are part of
    the result and files per trigger are not limited. History and names are updated,
    ``relatorio_portabilidade`` gets the batch's report, ``portabilidade_rejeitada`` its
    rejected lines and ``arquivos_portabilidade`` its files, all under ``lote``.

    A file that cannot be read to its end does not stop its arrival: nothing of it is
    loaded, the report names it as an error, and the ledger of files keeps it in quarantine
    with the reason until ``retry_quarantined`` can read it. Every step is idempotent, so a
    batch that is replayed after a failure changes nothing.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        _load_files(warehouse, batch, batch_id, encoding)

    return (
        arriving_files(warehouse.spark, folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def quarantined_files(warehouse: Warehouse) -> DataFrame:
    """Files that no load could read so far: ``caminho``, ``tamanho``, ``motivo``, ``lote``."""
    ledger = warehouse.read(_LEDGER)
    loaded = ledger.where(F.col("estado") == LOADED).select("caminho")
    waiting = ledger.where(F.col("estado") == QUARANTINED).join(loaded, "caminho", "left_anti")
    # Of several attempts the last one counts; retries go down from -1.
    order = F.when(F.col("lote") < 0, -F.col("lote")).otherwise(F.lit(0))
    last = F.max_by(F.struct("tamanho", "motivo", "lote"), order).alias("ultimo")
    return waiting.groupBy("caminho").agg(last).select("caminho", "ultimo.*")


def retry_quarantined(warehouse: Warehouse, encoding: str = "UTF-8") -> int:
    """Try the files in quarantine again, for instance after they were sent anew.

    Those that can be read now are one load of their own, the latest, under a negative
    ``lote``; the others stay in quarantine. Gives the number of files loaded.
    """
    if not warehouse.has(_LEDGER):
        return 0
    spark = warehouse.spark
    waiting = quarantined_files(warehouse).select(
        F.col("caminho").alias("path"), F.col("tamanho").alias("length")
    )
    last = warehouse.read(_LEDGER).agg(F.min("lote")).first()[0]
    files = spark.createDataFrame(waiting.collect(), waiting.schema)  # read before it is written
    return _load_files(warehouse, files, min(last, 0) - 1, encoding)[0]
