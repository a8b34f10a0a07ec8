"""Repeated byte strings over a logarithmic family of sparse suffix arrays.

Documents arrive in batches. A batch gets a suffix array of its anchors: suffixes in order
of their first gram and of the span around it, as stored, sorted tables. Adding a batch
merge-scans it with the arrays of its own size, from the smallest level up: each equal
pair merges into one array of twice the size, and equal neighbours are long matches. A
last merge-scan over the levels that are left lets all suffixes meet. Places where only
a part around the anchor agrees go through narrower cells down to single windows, so the
answer is exact to the byte.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.llm import repeats
from trunkline.llm import text as tx
from trunkline.llm.common import stored, table
from trunkline.llm.repeats import covered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a match that counts, and of an anchor.
MATCH_BYTES, ANCHOR_BYTES = 400, 100
#: Batches of a one-off run; distances of the cells between whole spans and single windows.
BATCHES, CELL_BYTES = 4, 20


class Family:
    """Levels of sorted arrays; level i holds 2**i batches or none."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}
        self.matches: list[DataFrame] = []

    def add(self, entries: DataFrame) -> None:
        """Sort a batch, scan it with the levels that are full, and merge them."""
        level = 0
        while level in self.levels:
            entries = entries.unionByName(self.levels.pop(level))
            level += 1
        array = stored(repeats.compared(entries, closing=False), "array")
        self.matches.append(array.where(F.col("state") == repeats.REPEATED))
        self.levels[level] = array.where(F.col("state") == repeats.CANDIDATE)

    def close(self) -> list[DataFrame]:
        """Merge-scan all levels; the matches so far and the ones found last."""
        rest = None
        for array in self.levels.values():
            rest = array if rest is None else rest.unionByName(array)
        return [*self.matches, repeats.settled(rest, "array")]


def _cut(length: int):
    """Task function: the bytes outside all matches."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tx.pieces(batch):
                data, offsets = tx.utf8(piece.column(1))
                gone = covered(piece.column(3), offsets, length)
                begin = gone & np.append(True, ~gone[:-1]) if len(gone) else gone
                if len(gone):
                    starts = offsets[:-1][np.diff(offsets) > 0]
                    begin[starts] = gone[starts]
                removed = np.append(0, np.cumsum(gone))[offsets]
                yield pa.record_batch(
                    [
                        piece.column(0),
                        pa.array(np.diff(offsets)),
                        pa.array(np.diff(removed)),
                        pa.array(np.diff(np.append(0, np.cumsum(begin))[offsets])),
                        tx.binary(data[~gone], offsets - removed),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return cut


def remove_matches(
    documents: DataFrame, match_bytes: int = MATCH_BYTES, batches: int = BATCHES
) -> DataFrame:
    """``doc_id, text`` without the bytes of strings that start in several places.

    Returns doc_id, n_bytes, n_removed, n_spans (runs removed) and kept (the other bytes),
    one row for each row given. Null and empty texts have no bytes; a text shorter than a
    match keeps all. Repeated rows repeat each other and lose all of their matches. An
    empty table gives no rows; other columns are not read.
    """
    gram = min(ANCHOR_BYTES, max(1, match_bytes // 2))
    windows = repeats.Windows("byte", match_bytes, gram)
    rows = repeats.keyed(documents)
    family = Family()
    for b in range(batches):
        batch = rows.where(F.pmod("text_hash", F.lit(batches)) == b)
        family.add(batch.mapInArrow(repeats.cell_scan(windows, windows.grams, False), repeats.CELLS))
    found = family.close()
    narrow = repeats.refine(rows, found[-1], windows, CELL_BYTES)
    single = repeats.refine(rows, narrow, windows, 1)
    ranges = repeats.repeated([*found, narrow, single])
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return repeats.with_ranges(rows, ranges, "left").mapInArrow(_cut(match_bytes), schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_matches(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
