"""Token ids of documents as files of range-coded blocks, written in order of ids.

A file holds segments, each a row of one binary payload: whole documents, their ids and
sizes, then the blocks of their token ids. Segments say where they stand, so a reader
fetches those of a range of documents and reads no other. Spark's commit of the table makes
lost executors and repeated tasks harmless.
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trunkline.llm import rangecoder, tokens
from trunkline.llm import text as tx
from trunkline.llm.common import scan_parts, sized, stored, table
from trunkline.session import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The id after each document, the ids of a tokenizer, and the ids that close a segment.
END, VOCABULARY, SEGMENT_IDS = 2, 50_257, 1 << 20
_SEGMENTS = (
    "part int, segment bigint, start bigint, n_docs bigint, n_tokens bigint, "
    "first_doc bigint, last_doc bigint, payload binary"
)
_HEAD = "<4sQI"  # magic, documents, crc of their ids, marks and sizes
_MAGIC = b"TLS1"


def _payload(ids: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray, given: np.ndarray) -> bytes:
    head = doc_ids.astype("<i8").tobytes() + given.astype("u1").tobytes() + sizes.astype("<i8").tobytes()
    head_z = zlib.compress(head, 1)
    return (
        struct.pack(_HEAD, _MAGIC, len(sizes), zlib.crc32(head))
        + struct.pack("<I", len(head_z))
        + head_z
        + rangecoder.encode(ids, VOCABULARY)
    )


def _read(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token ids, sizes, ids and their marks of a segment."""
    magic, n, crc = struct.unpack_from(_HEAD, payload)
    at = struct.calcsize(_HEAD) + 4
    (size,) = struct.unpack_from("<I", payload, struct.calcsize(_HEAD))
    head = zlib.decompress(payload[at : at + size])
    if magic != _MAGIC or zlib.crc32(head) != crc:
        raise ValueError("damaged segment of token ids")
    doc_ids = np.frombuffer(head, "<i8", n)
    given = np.frombuffer(head, "u1", n, 8 * n).astype(bool)
    sizes = np.frombuffer(head, "<i8", n, 9 * n)
    return rangecoder.decode(payload[at + size :]), sizes, doc_ids, given


def _writer(path: str, end: int, segment_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.vocabulary(path)
        part = TaskContext.get().partitionId()
        parts: list = []
        held = number = start = 0

        def segment() -> pa.RecordBatch:
            nonlocal parts, held, number, start
            ids, sizes, docs, given = (np.concatenate([p[i] for p in parts]) for i in range(4))
            known = docs[given]
            row = {
                "part": part,
                "segment": number,
                "start": start,
                "n_docs": len(sizes),
                "n_tokens": len(ids),
                "first_doc": int(known[0]) if len(known) else None,
                "last_doc": int(known[-1]) if len(known) else None,
                "payload": _payload(ids, sizes, docs, given),
            }
            start, number, parts, held = start + len(ids), number + 1, [], 0
            types = [pa.int32()] + [pa.int64()] * 6 + [pa.binary()]
            return pa.record_batch(
                [pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row)
            )

        for batch in batches:
            for piece in tx.pieces(batch):
                ids, ranges = tokens.with_end(*words.encode(piece.column(1)), end)
                docs = piece.column(0)
                given = docs.is_valid().to_numpy(zero_copy_only=False)
                docs = docs.fill_null(0).to_numpy(zero_copy_only=False)
                parts.append((ids, np.diff(ranges), docs, given))
                held += len(ids)
                if held >= segment_ids:
                    yield segment()
        if parts:
            yield segment()

    return write


def write_tokens(
    documents: DataFrame, folder: str, end: int = END, path: str | None = None,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the token ids of ``doc_id, text`` to ``folder``, in ascending order of doc_id.

    Each document gets ``end`` after its ids; a null or empty text is that id alone. Null
    ids come first; rows with equal ids stand in the order of a hash of their texts. An
    empty table makes an empty one; other columns are not read. A segment closes at
    ``segment_ids`` ids with a whole document, so a longer document has one of its own.
    """
    # The hash spreads rows that share an id over several tasks.
    tie = F.xxhash64("text")
    rows = (
        documents.select("doc_id", "text", tie.alias("tie"))
        .repartitionByRange(scan_parts(documents), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    task = _writer(path or tokens.tokenizer_path(), end, segment_ids)
    rows.select("doc_id", "text").mapInArrow(task, _SEGMENTS).write.parquet(folder)


def read_tokens(
    spark: SparkSession, folder: str, first_doc: int | None = None, last_doc: int | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Documents of a folder of token files: doc_id, start, n_tokens, ids_crc32 and ids.

    ``start`` counts the ids of all documents before. ``ids`` are little-endian unsigned
    32-bit integers, null unless ``with_ids``. A range of ids reads its segments only.
    """
    segments = spark.read.parquet(folder)
    # One row a written file at most; the sums before it are its start.
    totals = stored(segments.groupBy("part").agg(F.sum("n_tokens").alias("n")), "totals")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if first_doc is not None:
        segments = segments.where(F.col("last_doc") >= first_doc)
    if last_doc is not None:
        segments = segments.where(F.col("first_doc") <= last_doc)
    segments = segments.join(sized(stored(base, "starts"), 24), "part")
    rows = segments.select((F.col("base") + F.col("start")).alias("start"), "payload")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sizes, docs, given = _read(batch.column(1)[i].as_py())
                wide = ids.astype("<u4")
                ranges = np.append(0, np.cumsum(sizes))
                crcs = [zlib.crc32(wide[a:b]) for a, b in zip(ranges[:-1], ranges[1:], strict=True)]
                yield pa.record_batch(
                    [
                        pa.array(docs, mask=~given),
                        pa.array(batch.column(0)[i].as_py() + ranges[:-1]),
                        pa.array(sizes),
                        pa.array(crcs, pa.int64()),
                        tx.binary(wide, ranges) if with_ids else pa.nulls(len(sizes), pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    found = rows.mapInArrow(read, schema)
    if first_doc is not None:
        found = found.where(F.col("doc_id") >= first_doc)
    return found if last_doc is None else found.where(F.col("doc_id") <= last_doc)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder, with_ids=False).drop("ids")
