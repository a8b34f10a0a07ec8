"""Packing by online best fit with a fixed number of open bins.

Pieces come in the order of the table. Each task has bins of its own, a sequence each. Open
bins are keyed by their free space in a bitset: bit ``f`` is set while some open bin has
room for ``f`` more ids, so the bin that a piece fills best is the lowest set bit from the
piece's length on. If no open bin takes the piece, a new one opens; if the fixed number is
open, the fullest closes first. A task holds the bitset and one stack of bins a free space,
whatever the table's size.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from trunkline.llm import text as tx
from trunkline.llm import tokens
from trunkline.llm.common import stored, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEQUENCE, END = 1024, 2
#: Bins that a task keeps open.
OPEN_BINS = 1024
#: Sequence ids of one task lie together; a task makes fewer sequences than this.
TASK_SEQUENCES = 1 << 40
_SCHEMA = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, "
    "sequence_id bigint, offset bigint"
)


class OpenBins:
    """Bins of ``size`` ids, at most ``limit`` of them open."""

    def __init__(self, size: int, limit: int) -> None:
        self.size, self.limit = size, limit
        self.free = 0
        self.by_free: list[list[int]] = [[] for _ in range(size)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        found = stack.pop()
        if not stack:
            self.free ^= 1 << free
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece of 1 to ``size`` ids."""
        fitting = self.free >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            found = self._take(room)
        else:
            if self.open == self.limit and length < self.size:
                self._take((self.free & -self.free).bit_length() - 1)  # closed for good
            room, found = self.size, self.made
            self.made += 1
        left = room - length
        if left:
            self.by_free[left].append(found)
            self.free |= 1 << left
            self.open += 1
        return found, self.size - room


def cut(n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of the pieces of documents with ``n`` ids each.

    Only documents of more than ``size`` ids are cut; their first piece is what the whole
    pieces leave.
    """
    counts = -(-n // size)
    doc = np.repeat(np.arange(len(n)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    rest = (n - (counts - 1) * size)[doc]
    start = np.where(nth == 0, 0, rest + (nth - 1) * size)
    return doc, nth, start, np.where(nth == 0, rest, size)


def _pack(path: str, size: int, end: int, limit: int, with_ids: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.vocabulary(path)
        bins = OpenBins(size, limit)
        base = TaskContext.get().partitionId() * TASK_SEQUENCES
        for batch in batches:
            for piece in tx.pieces(batch):
                ids, ranges = tokens.with_end(*words.encode(piece.column(1)), end)
                doc, nth, start, length = cut(np.diff(ranges), size)
                first = ranges[:-1][doc] + start
                wide = ids.astype("<u4")
                crcs = [zlib.crc32(wide[a : a + m]) for a, m in zip(first, length, strict=True)]
                placed = np.array([bins.place(m) for m in length.tolist()], np.int64).reshape(-1, 2)
                yield pa.record_batch(
                    [
                        piece.column(0).take(pa.array(doc)),
                        pa.array(nth, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crcs, pa.int64()),
                        tx.binary(wide, np.append(first, len(wide)))
                        if with_ids
                        else pa.nulls(len(doc), pa.binary()),
                        pa.array(base + placed[:, 0]),
                        pa.array(np.ascontiguousarray(placed[:, 1])),
                    ],
                    names=[f.split()[0] for f in _SCHEMA.split(", ")],
                )

    return pack


def pack_best_fit(
    documents: DataFrame, size: int = SEQUENCE, end: int = END, open_bins: int = OPEN_BINS,
    with_ids: bool = False, path: str | None = None,
) -> DataFrame:
    """Pieces of the token ids of ``doc_id, text`` and their places in sequences.

    Returns doc_id, piece (from 0), start, length, ids_crc32, ids (null unless ``with_ids``;
    little-endian unsigned 32-bit integers), sequence_id (any number) and offset. Every
    document ends with ``end``; a null or empty text is that id alone. A document of more
    than ``size`` ids is cut into pieces of ``size``, the first of which may be shorter;
    others stay whole. Repeated rows, also of one id or of none, are packed one by one.
    An empty table gives no rows; other columns are not read. The result is a table of its
    own, since a task that runs again may meet its rows in another order.
    """
    task = _pack(path or tokens.tokenizer_path(), size, end, open_bins, with_ids)
    return stored(documents.select("doc_id", "text").mapInArrow(task, _SCHEMA), "packed")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(table(spark, sf_dir, "documents")).drop("ids")
