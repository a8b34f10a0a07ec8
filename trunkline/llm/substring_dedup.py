"""Repeated passages by relative Lempel-Ziv parsing.

Every text is parsed against the indexed blocks of all texts, itself included. The index
holds each block's phrases, ranges of window starts that share an anchor, by the hash of
their words, and for each phrase one place to copy it from. Where a phrase is there only in
part, the range is looked up window by window, so the ends of a factor are checked at the
exact word. The parse goes through a text from left to right: a factor takes phrase after
phrase as long as the next one follows without a gap and goes on at the factor's source;
otherwise it ends and the next one begins. Factors have a window's length or more, so all
of their words are repeats; shorter ones are not made, and their words stay.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trunkline.llm import repeats
from trunkline.llm import text as tx
from trunkline.llm.common import stored, table
from trunkline.llm.repeats import covered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of the shortest factor that counts as a repeat, and of an anchor.
FACTOR_WORDS, ANCHOR_WORDS = 35, 8
#: Window starts of a factor that are handed on as one range.
RANGE_WORDS = 1 << 23
_PHRASES = "doc_id bigint, text_hash bigint, first bigint, last bigint, phrase bigint"


def _cut(length: int):
    """Task function: the words outside all factors, joined by one space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tx.pieces(batch):
                yield one(piece)

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = tx.utf8(piece.column(1))
        first, last, of = tx.words(data, offsets, tx.separators("white"))
        gone = covered(piece.column(3), of, length)
        removed = np.diff(np.append(0, np.cumsum(gone))[of])
        begin = gone & np.append(True, ~gone[:-1]) if len(gone) else gone
        if len(gone):
            starts = of[:-1][np.diff(of) > 0]
            begin[starts] = gone[starts]
        # Keep the bytes of kept words and, but for a text's last one, one byte after each.
        change = np.zeros(len(data) + 2, np.int32)
        keep = np.flatnonzero(~gone)
        doc = np.searchsorted(of, keep, "right") - 1
        final = np.ones(len(keep), bool)
        final[:-1] = doc[1:] != doc[:-1]
        change[first[keep]] += 1
        change[last[keep] + ~final] -= 1
        mask = np.cumsum(change[: len(data)]) > 0
        out = data.copy()
        out[last[keep][~final]] = 32
        place = np.append(0, np.cumsum(mask))[offsets]
        return pa.record_batch(
            [
                piece.column(0),
                pa.array(np.diff(of)),
                pa.array(removed),
                pa.array(np.diff(np.append(0, np.cumsum(begin))[of])),
                tx.binary(out[mask], place).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "n_spans", "kept"],
        )

    return cut


def _phrases(windows: repeats.Windows):
    """Task function: the ranges of each text with the hash of the words that they cover."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tx.pieces(batch):
                yield one(piece)

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        sums, of, hash_of = windows.units(piece)
        first, further, doc = repeats.unpacked(piece.column(3))
        begin = of[:-1][doc] + first
        words = further + windows.length
        phrase = tx.mix(hash_of(sums, begin, begin + words) + words.astype(np.uint64))
        return pa.record_batch(
            [
                piece.column(0).take(pa.array(doc)),
                piece.column(2).take(pa.array(doc)),
                pa.array(first),
                pa.array(first + further),
                pa.array(phrase.view(np.int64)),
            ],
            names=["doc_id", "text_hash", "first", "last", "phrase"],
        )

    return scan


def _place(doc_id: str, text_hash: str, start: str) -> Column:
    return F.struct(doc_id, text_hash, start)


def _parsed(rows: DataFrame, factor_words: int) -> DataFrame:
    """Factors of the keyed rows, once for rows that share id and text.

    Returns doc_id, text_hash, start, length, source (doc_id, text_hash, first), in words.
    """
    windows = repeats.Windows("word", factor_words, min(ANCHOR_WORDS, factor_words))
    cells = rows.mapInArrow(repeats.cell_scan(windows, windows.grams, False), repeats.CELLS)
    whole = repeats.settled(cells, "phrases")
    ends = repeats.refine(rows, whole, windows, 1)
    found = repeats.with_ranges(rows, repeats.repeated([whole, ends]), "inner")
    phrases = stored(
        found.mapInArrow(_phrases(windows), _PHRASES).dropDuplicates(
            ["doc_id", "text_hash", "first", "last"]
        ),
        "phrases",
    )
    place = _place("doc_id", "text_hash", "first")
    # The index: for each phrase its least place, and the greatest for the least one itself.
    # A table of its own, so that the join can split a phrase that has very many places.
    index = stored(
        phrases.groupBy("phrase").agg(F.min(place).alias("least"), F.max(place).alias("other")),
        "index",
    )
    source = F.when(F.col("least").eqNullSafe(place), F.col("other")).otherwise(F.col("least"))
    looked_up = phrases.join(index, "phrase").select(
        "doc_id", "text_hash", "first", "last", source.alias("source")
    )
    in_order = Window.partitionBy("doc_id", "text_hash").orderBy("first", F.desc("last"))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # Windows looked up one by one may lie in a phrase that was found whole as well.
    looked_up = looked_up.withColumn("reached", F.max("last").over(before)).where(
        F.col("reached").isNull() | (F.col("last") > F.col("reached"))
    )
    at = F.struct(
        "source.doc_id", "source.text_hash", (F.col("source.first") - F.col("first")).alias("shift")
    )
    goes_on = (F.lag("last").over(in_order) + 1 == F.col("first")) & F.lag(at).over(
        in_order
    ).eqNullSafe(at)
    begins = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    numbered = looked_up.withColumn("begins", begins).withColumn(
        "factor", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    taken = numbered.groupBy("doc_id", "text_hash", "factor").agg(
        F.min("first").alias("start"), F.max("last").alias("last"), F.min("source").alias("source")
    )
    length = F.col("last") - F.col("start") + F.lit(factor_words)
    return stored(
        taken.select("doc_id", "text_hash", "start", length.alias("length"), "source"), "factors"
    )


def factors(documents: DataFrame, factor_words: int = FACTOR_WORDS) -> DataFrame:
    """The factors of ``doc_id, text``: passages that start in several places.

    Returns doc_id, start, length, source_doc_id, source_start, in words, one row a factor:
    the words from ``start`` on equal those of the source from ``source_start`` on. Factors
    have ``factor_words`` words or more and may overlap by less than that. Of many places a
    phrase is copied from one, so a factor is not always the longest possible; every word
    of a repeated window lies in a factor. Rows that share id and text are parsed once, and
    their factors may name their own place. Null and empty texts have none.
    """
    return _parsed(repeats.keyed(documents), factor_words).select(
        "doc_id",
        "start",
        "length",
        F.col("source.doc_id").alias("source_doc_id"),
        F.col("source.first").alias("source_start"),
    )


def remove_repeats(documents: DataFrame, factor_words: int = FACTOR_WORDS) -> DataFrame:
    """``doc_id, text`` without the words of factors that start in several places.

    Returns doc_id, n_words, n_removed, n_spans (runs removed) and kept (the other words,
    joined by one space), one row for each row given. Null and empty texts have no words;
    a text shorter than a factor keeps all. Repeated rows repeat each other's words and
    lose them all. An empty table gives no rows; other columns are not read.
    """
    rows = repeats.keyed(documents)
    last = F.col("start") + F.col("length") - F.lit(factor_words)
    step = F.lit(RANGE_WORDS).cast("bigint")
    gone = (
        _parsed(rows, factor_words)
        .select("doc_id", "text_hash", last.alias("end"),
                F.explode(F.sequence("start", last, step)).alias("first"))
        .withColumn("last", F.least("end", F.col("first") + step - 1))
    )
    schema = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept string"
    return repeats.with_ranges(rows, gone, "left").mapInArrow(_cut(factor_words), schema)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
