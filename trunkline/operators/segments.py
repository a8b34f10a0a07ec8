"""The numbering plan as disjoint segments, each with the one carrier that counts in it."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENTS = T.StructType(
    [
        T.StructField("cn", T.IntegerType()),
        T.StructField("prefixo", T.IntegerType()),
        T.StructField("faixa_inicial", T.LongType()),
        T.StructField("faixa_final", T.LongType()),
        T.StructField("cod_prestadora", T.LongType()),
    ]
)
_PREFIX = ["cn", "prefixo"]


class _Sweep:
    """One pass over the ranges of a prefix in order of their starts.

    Ranges that are still open stand in a heap, the one that counts on top: the greatest
    start, then the smallest end, then the smallest code.
    """

    def __init__(self) -> None:
        self.prefix: tuple[int, int] | None = None
        self.open: list[tuple[int, int, int]] = []
        self.at = 0
        self.out: list[tuple[int, int, int, int, int]] = []

    def _advance(self, to: int | None) -> None:
        """Segments up to, not with, ``to``; up to the end of all open ranges without it."""
        while self.open and (to is None or self.at < to):
            _, end, code = self.open[0]
            if end < self.at:
                heapq.heappop(self.open)
                continue
            last = end if to is None else min(end, to - 1)
            self.out.append((*self.prefix, self.at, last, code))
            self.at = last + 1

    def add(self, cn: int, prefix: int, start: int, end: int, code: int) -> None:
        if (cn, prefix) != self.prefix:
            self.finish()
            self.prefix = (cn, prefix)
        self._advance(start)
        self.at = start
        heapq.heappush(self.open, (-start, end, code))

    def finish(self) -> None:
        self._advance(None)
        self.open = []

    def taken(self) -> pd.DataFrame:
        """The segments since the last call."""
        rows, self.out = self.out, []
        return pd.DataFrame(rows, columns=SEGMENTS.fieldNames())


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sweep = _Sweep()
    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            sweep.add(*row)
        yield sweep.taken()
    sweep.finish()
    yield sweep.taken()


def plan_segments(plan: DataFrame) -> DataFrame:
    """Ranges cut at each other's ends, so that a number lies in at most one segment.

    Where ranges of one area code and prefix overlap, the one with the greatest start counts,
    then the smallest end, then the smallest carrier code; a segment is a longest stretch in
    which one range counts. Ranges that meet no other pass as
    they are; the others go through a sweep line, one prefix after the other in the order of
    starts, which holds the open ranges only. A range that ends before it starts holds no
    number and is left out.
    """
    fields = SEGMENTS.fieldNames()
    ranges = (
        plan.where("faixa_inicial <= faixa_final")
        .groupBy(*_PREFIX, "faixa_inicial", "faixa_final")
        .agg(F.min("cod_prestadora").alias("cod_prestadora"))
    )
    in_order = Window.partitionBy(*_PREFIX).orderBy("faixa_inicial", "faixa_final")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    marked = ranges.withColumns(
        {
            "_antes": F.max("faixa_final").over(before),
            "_depois": F.lead("faixa_inicial").over(in_order),
        }
    ).withColumn(
        "_so",
        F.coalesce(F.col("_antes") < F.col("faixa_inicial"), F.lit(True))
        & F.coalesce(F.col("_depois") > F.col("faixa_final"), F.lit(True)),
    )
    alone = marked.where("_so").select(fields)
    swept = (
        marked.where("not _so")
        .select(fields)
        .repartition(*_PREFIX)
        .sortWithinPartitions(*_PREFIX, "faixa_inicial", "faixa_final")
        .mapInPandas(_sweep, SEGMENTS)
    )
    return alone.unionByName(swept)


def segments_of(plan: DataFrame) -> DataFrame:
    """``plan`` itself if it is a table of segments, as the loads store it, else its segments."""
    return plan if plan.columns == SEGMENTS.fieldNames() else plan_segments(plan)
