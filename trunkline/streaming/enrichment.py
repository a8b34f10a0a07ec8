"""Enrichment of calls as they arrive, against the stored tables."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trunkline.operators.resolve import RefDate, enrich_calls
from trunkline.plans.loads import Warehouse
from trunkline.sources.history_store import Manifest, is_complete, read_history, read_manifest
from trunkline.sources.tables import read_current, switch_current, write_table


def _snapshot(warehouse: Warehouse, target: str, batch_id: int) -> Manifest | None:
    """The state of the history for a batch: the one of its first attempt, if it is still there.

    The state is written down before the batch is worked on, so a replay gives the same rows
    though the history may have been merged since.
    """
    spark, history = warehouse.spark, warehouse.path("portabilidade_historico")
    place = f"{target}/_retratos/{batch_id}"
    text = read_current(spark, place)
    if text:
        pinned = Manifest(**json.loads(text))
        if is_complete(spark, history, pinned):
            return pinned
    found = read_manifest(spark, history)
    if found is not None:
        switch_current(spark, place, json.dumps(asdict(found)))
    return found


def enrich_calls_stream(
    warehouse: Warehouse,
    calls: DataFrame,
    origin: str,
    destination: str,
    target: str,
    checkpoint: str,
    reference_date: RefDate = None,
) -> StreamingQuery:
    """Add the carriers of both sides to a stream of calls, as ``enrich_calls`` does, then stop.

    Each micro-batch joins the history, plan and names as they are when it is first worked
    on, and replaces its own folder ``lote=<batch>`` of the table ``target``. So a batch that
    is replayed leaves no call twice. A history state that was compacted away in between is
    replaced by the current one.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = warehouse.path("portabilidade_historico")
        rows = enrich_calls(
            batch,
            read_history(spark, path, _snapshot(warehouse, target, batch_id)),
            warehouse.read("numeracao_segmentos"),
            warehouse.read("prestadoras"),
            origin,
            destination,
            reference_date,
        )
        write_table(rows, f"{target}/lote={batch_id}")

    return (
        calls.writeStream.foreachBatch(enrich)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
