"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Upper limit, in bytes of row data, for a side that is sent to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Row data of ``df`` in bytes: 8 per fixed-width value plus the text lengths.

    One distributed aggregate; on a parquet table with fixed-width columns only,
    it reads no column data.
    """
    texts = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    text_bytes = F.lit(0)
    for name in texts:
        text_bytes = text_bytes + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    rows, chars = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(text_bytes), F.lit(0))
    ).first()
    return rows * 8 * (len(df.columns) + 1) + chars


def broadcast_if_small(
    df: DataFrame, limit: int = BROADCAST_LIMIT, measured: DataFrame | None = None
) -> DataFrame:
    """Mark ``df`` for broadcast if its measured size is within ``limit``.

    ``measured`` is a table that bounds the size of ``df`` and is cheaper to measure.
    Beyond the limit ``df`` comes back unmarked: the join shuffles both sides, and the
    adaptive skew join splits hot keys.
    """
    small = measured_bytes(df if measured is None else measured) <= limit
    return F.broadcast(df) if small else df
