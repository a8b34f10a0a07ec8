"""Packing by the shortest pack first over the histogram of piece lengths.

Documents are cut into pieces of a sequence's length and a rest. The packing is computed on
the histogram of lengths alone: lengths go from the longest to the shortest, each to the
packs with the most room left, whose patterns and counts change accordingly. Patterns
then meet the pieces again by rank: the r-th piece of a length has one place in the list
of all slots for that length. The histogram has one row a length, so patterns, which only
the driver sees, depend on the sequence length and not on the data's size.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trunkline.llm import text as tx
from trunkline.llm import tokens
from trunkline.llm.common import sized, stored, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEQUENCE, END = 1024, 0
_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "ids binary, part int, rank bigint"
)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def _cut(path: str, size: int, end: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.forget("aligner ")
        words = tokens.vocabulary(path)
        part = TaskContext.get().partitionId()
        ranks = np.zeros(size + 1, np.int64)
        for batch in batches:
            for piece in tx.pieces(batch):
                ids, ranges = tokens.with_end(*words.encode(piece.column(1)), end)
                n = np.diff(ranges)
                counts = -(-n // size)
                doc = np.repeat(np.arange(len(n)), counts)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = nth * size
                length = np.minimum(size, n[doc] - start)
                first = ranges[:-1][doc] + start
                wide = ids.astype("<u4")
                crcs = [zlib.crc32(wide[a : a + m]) for a, m in zip(first, length, strict=True)]
                # Rank of a piece among those of its length in this task.
                order = np.argsort(length, kind="stable")
                in_order = length[order]
                place = np.arange(len(order)) - np.searchsorted(in_order, in_order)
                rank = np.empty(len(order), np.int64)
                rank[order] = place + ranks[in_order]
                ranks += np.bincount(length, minlength=size + 1)
                yield pa.record_batch(
                    [
                        piece.column(0).take(pa.array(doc)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crcs, pa.int64()),
                        pa.array(n[doc]),
                        tx.binary(wide, np.append(first, len(wide)))
                        if with_ids
                        else pa.nulls(len(doc), pa.binary()),
                        pa.array(np.full(len(doc), part, np.int32)),
                        pa.array(rank),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "part", "rank"],
                )

    return cut


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """Packs as ``(count, {length: pieces of it})`` that hold the whole histogram.

    The shortest packs, with the most room, take a length first. Where none has room, new
    packs take as many pieces of it as fit.
    """
    open_packs: dict[int, list[tuple[int, dict[int, int]]]] = {}
    full: list[tuple[int, dict[int, int]]] = []

    def put(room: int, count: int, pack: dict[int, int]) -> None:
        if count:
            (open_packs.setdefault(room, []) if room else full).append((count, pack))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in open_packs if r >= length), default=0)
            if not room:
                each = size // length
                put(size - each * length, left // each, {length: each})
                rest = left % each
                put(size - rest * length, 1 if rest else 0, {length: rest})
                break
            count, pack = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            taken = min(count, left)
            put(room, count - taken, pack)
            put(room - length, taken, pack | {length: pack.get(length, 0) + 1})
            left -= taken
    return full + [p for packs in open_packs.values() for p in packs]


def slots(packs: list[tuple[int, dict[int, int]]], size: int) -> dict[str, np.ndarray]:
    """For each length, ranges of ranks: first rank, first sequence, pieces a sequence, offset."""
    rows, sequence, seen = [], 0, {}
    for count, pack in packs:
        offset = 0
        for length, each in pack.items():
            rows.append((length, seen.get(length, 0), sequence, each, offset))
            seen[length] = seen.get(length, 0) + count * each
            offset += length * each
        sequence += count
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    names = ("length", "rank", "sequence", "each", "offset")
    return dict(zip(names, columns, strict=True))


def _place(found: dict[str, np.ndarray]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.int64(1) << 40  # ranks of one length are fewer
        keys = found["length"] * shift + found["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.searchsorted(keys, length * shift + rank, "right") - 1
            nth = rank - found["rank"][row]
            each = found["each"][row]
            out = batch.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(found["sequence"][row] + nth // each))
            yield out.append_column("offset", pa.array(found["offset"][row] + nth % each * length))

    return place


def pack(
    documents: DataFrame, size: int = SEQUENCE, end: int = END, with_ids: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Pieces of the token ids of ``doc_id, text`` and their places in sequences.

    Returns doc_id, start, length, ids_crc32, doc_tokens, ids (null unless ``with_ids``;
    little-endian unsigned 32-bit integers), sequence_id and offset. Every document ends
    with ``end``; a null or empty text is that id alone, so each row has at least one piece.
    Repeated rows are packed one by one. An empty table gives no rows; other columns are
    not read.
    """
    task = _cut(path or tokens.tokenizer_path(), size, end, with_ids)
    pieces = stored(documents.select("doc_id", "text").mapInArrow(task, _PIECES), "pieces")
    by_part = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(
        by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
        "ranks",
    )
    ranked = pieces.join(sized(base, 32), ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids",
        (F.col("base") + F.col("rank")).alias("rank"),
    )
    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "ids binary, sequence_id bigint, offset bigint"
    )
    if not histogram:
        return documents.sparkSession.createDataFrame([], schema)
    return ranked.mapInArrow(_place(slots(patterns(histogram, size), size)), schema)


def packing_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places; the last stage."""
    return pack(documents).drop("ids")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
