"""Windows that occur more than once, for sequences of bytes or words, without pairs.

A window's anchor is its least gram by hash, the leftmost of ties. Equal windows have equal
anchors at equal places, so only windows with a common anchor need to be compared. The
windows of one anchor, by their distance to it, fall into cells. A cell's ``core`` is the
part that all its windows have in common and its ``span`` what they cover together:

- cells of equal spans hold equal windows, all of them repeated;
- a core that occurs once proves that none of its windows is repeated;
- cells of equal cores and different spans stay open for a round with narrower cells, in
  which one cell stands for all of equal span. Cells of one window close the question.

Cells are rows of two hashes; equal ones meet by a shuffle on the core. Each task first
combines its own equal cells, so a group of copies sends one row a task and key. Rows of a
key are read in order and never held, so a group may have any size.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trunkline.llm import text as tx
from trunkline.llm.common import in_bitmap, scan_parts, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: States of a cell: to be compared, known as repeated, open for the next round.
CANDIDATE, REPEATED, OPEN = 0, 1, 2
CELLS = (
    "doc_id bigint, text_hash bigint, first bigint, last bigint, "
    "core bigint, span bigint, n int, state int"
)
_NAMES = ["doc_id", "text_hash", "first", "last", "core", "span", "n", "state"]
#: Cells that a task combines at once.
COMBINED = 400_000
_LOW = (1 << 24) - 1


@dataclass(frozen=True)
class Windows:
    """Length of a window and of an anchor's gram, in units; units are bytes or words."""

    unit: str
    length: int
    gram: int

    @property
    def grams(self) -> int:
        return self.length - self.gram + 1

    def units(self, piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, Callable]:
        """Sums over the units, each text's range of units, and the hash of a range."""
        data, offsets = tx.utf8(piece.column(1))
        if self.unit == "byte":
            return tx.byte_sums(data), offsets, tx.byte_hash
        hashes, _, _, of = tx.hashed_words(data, offsets, tx.separators("white"))
        return tx.word_sums(hashes), of, tx.word_hash


def least(h: np.ndarray, size: int) -> np.ndarray:
    """Place of the leftmost least value in each run of ``size`` values."""
    if len(h) <= _LOW:
        packed = (h & ~np.uint64(_LOW)) | np.arange(len(h), dtype=np.uint64)
        covered = 1
        while covered * 2 <= size:
            packed = np.minimum(packed[:-covered], packed[covered:])
            covered *= 2
        if covered < size:
            packed = np.minimum(packed[: len(h) - size + 1], packed[size - covered :])
        return (packed & np.uint64(_LOW)).astype(np.int64)
    h = h & ~np.uint64(_LOW)
    at, covered = np.arange(len(h)), 1
    while covered < size:
        step = min(covered, size - covered)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(h[right] < h[left], right, left)
        covered += step
    return at


_NO_CELLS = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, bool),)


def cells(
    windows: Windows, width: int, sums: np.ndarray, of: np.ndarray, hash_of: Callable,
    chosen: np.ndarray | None = None,
) -> tuple[np.ndarray, ...]:
    """Text number, first and last window, core, span of each cell of ``width`` distances, and
    whether the text holds the span.

    ``chosen``: a mark for each unit, to take only the windows that start there.
    """
    n, w, m = len(sums) - 1, windows.length, windows.grams
    if n < w:
        return _NO_CELLS
    ends = np.repeat(of[1:], np.diff(of))
    usable = ends[: n - w + 1] - np.arange(n - w + 1) >= w
    if chosen is not None:
        usable &= chosen[: n - w + 1]
    at = np.flatnonzero(usable)
    if not len(at):
        return _NO_CELLS
    grams = np.arange(n - windows.gram + 1)
    anchor = least(hash_of(sums, grams, grams + windows.gram), m)[at]
    cell = (anchor - at) // width
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = at[begin], at[np.append(begin[1:], len(at)) - 1]
    anchor, cell = anchor[begin], cell[begin]
    near = cell * width
    far = np.minimum(near + width, m) - 1
    doc = np.searchsorted(of, first, "right") - 1
    salt = (cell.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    core = tx.mix(hash_of(sums, anchor - near, anchor - far + w) + salt)
    left, right = anchor - far, anchor - near + w
    whole = (left >= of[doc]) & (right <= of[doc + 1])
    # A span that the text cuts off equals no other, but that of the same place and text.
    cut = tx.mix(core ^ (first - of[doc]).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    span = hash_of(sums, np.where(whole, left, 0), np.where(whole, right, 0))
    return doc, first - of[doc], last - of[doc], core, np.where(whole, span, cut), whole


def _signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64, copy=False).view(np.int64)


def _combined(parts: list[tuple]) -> pa.RecordBatch:
    """Rows of one task: of equal cells the first stays a candidate, all others are done."""
    ids = pa.chunked_array([p[0] for p in parts]).combine_chunks()
    text_hash, first, last, core, span = (np.concatenate([p[i] for p in parts]) for i in range(1, 6))
    order = np.lexsort((span, core))
    c, s = core[order], span[order]
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (s[1:] != s[:-1])
    n = np.zeros(len(c), np.int32)
    starts = np.flatnonzero(new)
    n[starts] = np.minimum(np.diff(np.append(starts, len(c))), 2)
    state = np.where(new, CANDIDATE, REPEATED).astype(np.int32)
    # Rows that are done keep out of the way of the key that they shared.
    c = np.where(new, c, _signed(tx.mix((text_hash[order] ^ first[order]).view(np.uint64))))
    return pa.record_batch(
        [ids.take(pa.array(order)), pa.array(text_hash[order]), pa.array(first[order]),
         pa.array(last[order]), pa.array(c), pa.array(s), pa.array(n), pa.array(state)],
        names=_NAMES,
    )


def cell_scan(windows: Windows, width: int, ranged: bool):
    """Task function over ``doc_id, text, text_hash`` and, if ``ranged``, the open ranges."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            for piece in tx.pieces(batch):
                found = one(piece)
                if len(found[1]):
                    parts.append(found)
                    rows += len(found[1])
                if rows >= COMBINED:
                    yield _combined(parts)
                    parts, rows = [], 0
        if rows:
            yield _combined(parts)

    def one(piece: pa.RecordBatch) -> tuple:
        sums, of, hash_of = windows.units(piece)
        chosen = None
        if ranged:
            chosen = covered(piece.column(3), of, 1)
        doc, first, last, core, span, whole = cells(windows, width, sums, of, hash_of, chosen)
        text_hash = piece.column(2).to_numpy(zero_copy_only=False)[doc]
        span = np.where(whole, span, span ^ tx.mix(text_hash.view(np.uint64)))
        return piece.column(0).take(pa.array(doc)), text_hash, first, last, _signed(core), _signed(span)

    return scan


def unpacked(ranges: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of further ones and text number of each packed range."""
    counts = ranges.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    packed = ranges.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return packed >> 24, packed & _LOW, np.repeat(np.arange(len(ranges)), counts)


def covered(ranges: pa.Array, of: np.ndarray, length: int) -> np.ndarray:
    """A mark for each unit in a window; ``ranges``: for each text the packed ranges of starts."""
    size = int(of[-1])
    first, further, doc = unpacked(ranges)
    if not len(first):
        return np.zeros(size, bool)
    first = first + of[:-1][doc]
    end = first + further + length
    change = np.bincount(first, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    return np.cumsum(change[:size]) > 0


def _compare(closing: bool):
    """Task function over cells in order of core and span.

    Of equal cells the first stands for all, the others are repeated. ``closing`` decides
    the first ones as well; else they stay candidates, with a count up to two.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_n, same_before = None, 0, False
        for batch in batches:
            state = batch.column(7).to_numpy()
            done = np.flatnonzero(state == REPEATED)
            if len(done):
                yield batch.take(pa.array(done))
                batch = batch.take(pa.array(np.flatnonzero(state != REPEATED)))
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            core, span = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            n = batch.column(6).to_numpy().astype(np.int64)
            if held is not None:
                n[0] = held_n
            new = np.ones(len(core), bool)
            new[1:] = (core[1:] != core[:-1]) | (span[1:] != span[:-1])
            starts = np.flatnonzero(new)
            total = np.minimum(np.add.reduceat(n, starts), 2)
            others = np.flatnonzero(~new)
            if len(others):
                yield marked(batch.take(pa.array(others)), REPEATED, 2)
            heads = core[starts]
            before = np.append(same_before, heads[1:] == heads[:-1])
            after = np.append(heads[:-1] == heads[1:], False)
            whole = slice(0, len(starts) - 1)  # the last may go on in the next batch
            yield from first_rows(batch, starts[whole], total[whole], (before | after)[whole])
            held = batch.slice(int(starts[-1]), 1)
            held_n, same_before = int(total[-1]), bool(before[-1])
        if held is not None:
            yield from first_rows(held, np.array([0]), np.array([held_n]), np.array([same_before]))

    def first_rows(batch, rows, total, mixed) -> Iterator[pa.RecordBatch]:
        if not closing:
            if len(rows):
                yield marked(batch.take(pa.array(rows)), CANDIDATE, total)
            return
        for pick, state in ((total > 1, REPEATED), (mixed, OPEN)):
            if pick.any():
                yield marked(batch.take(pa.array(rows[pick])), state, total[pick])

    def marked(batch: pa.RecordBatch, state: int, n) -> pa.RecordBatch:
        n = np.broadcast_to(np.asarray(n, np.int32), batch.num_rows)
        columns = batch.columns[:6] + [
            pa.array(np.ascontiguousarray(n, np.int32)),
            pa.array(np.full(batch.num_rows, state, np.int32)),
        ]
        return pa.record_batch(columns, names=_NAMES)

    return compare


def compared(found: DataFrame, closing: bool = True) -> DataFrame:
    """Cells after they met by core, in the order of a sorted array."""
    return (
        found.repartition(scan_parts(found), "core")
        .sortWithinPartitions("core", "span")
        .mapInArrow(_compare(closing), CELLS)
    )


def keyed(documents: DataFrame) -> DataFrame:
    """``doc_id, text, text_hash``: id and hash name a row; equal rows share a result."""
    return documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))


def with_ranges(documents: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """The keyed documents with their ranges of window starts, as one array a document.

    The ranges of a document are at most its windows. Only texts that a bitmap of the keys
    with ranges lets through are shuffled for the join.
    """
    by_row = stored(
        found.groupBy("doc_id", "text_hash").agg(
            # First start and number of further ones in one number; cells are no wider.
            # Rows that share id and text have equal ranges, which count once.
            F.collect_set(F.shiftleft("first", 24) + F.col("last") - F.col("first")).alias("ranges")
        ),
        "ranges",
    )
    listed = in_bitmap(documents, "text_hash", by_row.select("text_hash"))
    right = by_row.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("th"), "ranges")
    left = listed.where("listed").drop("listed")
    same = left["doc_id"].eqNullSafe(F.col("id")) & (left["text_hash"] == F.col("th"))
    joined = left.join(right, same, how).select("doc_id", "text", "text_hash", "ranges")
    if how == "inner":
        return joined
    none = F.lit(None).cast(by_row.schema["ranges"].dataType)
    others = listed.where("not listed").select("doc_id", "text", "text_hash", none.alias("ranges"))
    return joined.unionByName(others)


def settled(found: DataFrame, purpose: str) -> DataFrame:
    """The closing comparison as a table of ranges and their states."""
    return stored(compared(found).select("doc_id", "text_hash", "first", "last", "state"), purpose)


def refine(documents: DataFrame, found: DataFrame, windows: Windows, width: int) -> DataFrame:
    """The next round: the open cells of ``found`` in cells of ``width``, compared."""
    still_open = found.where(F.col("state") == OPEN)
    rows = with_ranges(documents, still_open, "inner")
    return settled(rows.mapInArrow(cell_scan(windows, width, True), CELLS), "cells")


def repeated(rounds: list[DataFrame]) -> DataFrame:
    """Ranges of windows known as repeated in any round."""
    out = None
    for found in rounds:
        part = found.where(F.col("state") == REPEATED).select("doc_id", "text_hash", "first", "last")
        out = part if out is None else out.unionByName(part)
    return out
