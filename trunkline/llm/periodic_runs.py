"""Periodic runs of words, found by string synchronising sets.

A run is a longest stretch of words with smallest period ``q`` that repeats it at least four
times. A synchronising set of scale ``t`` holds the places ``i`` at which the least hash of
the windows of ``t`` words that start in ``i .. i + t`` belongs to the first or the last of
them. Whether ``i`` is in the set depends on the ``2 t`` words from ``i`` on only, so equal
contexts are chosen alike. Windows of period ``t / 4`` or less are left out, as they would
all tie; without them a set has about one place in ``t`` words.

Scales are the powers of two. A run of period ``q`` is found at the scale with
``t <= q < 2 t``: one of its first ``t`` places is in the set, since it is not periodic by
``t / 4``, and so is the place ``q`` words on, with the same context and no equal one
between (it would give the run a smaller period). So neighbours among equal contexts
propose periods. Windows that a scale leaves out lie in runs of periods below ``t / 4``,
which smaller scales have found already; periods below the first scale come from comparing
words at that distance directly. Every proposed period is extended word by word, so what
is returned is exact whatever the hashes; a run could be missed only if two different
contexts in one text had equal hashes of 64 bits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.llm import text as tx
from trunkline.llm.common import table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A run holds its period at least so often, and at least so many words.
REPEATS, LEAST_WORDS = 4, 6
#: The first scale; smaller periods are compared directly.
FIRST_SCALE = 4
_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_SCHEMA = f"doc_id bigint, n_words bigint, runs array<{_RUN}>, collapsed string"
_NONE = np.iinfo(np.uint64).max

Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, ends, periods


def word_ids(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    lengths = last - first
    ends = np.append(0, np.cumsum(lengths))
    inside = np.repeat(first - ends[:-1], lengths) + np.arange(ends[-1])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]
    )
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def least_of(h: np.ndarray, size: int) -> np.ndarray:
    """Least value of each ``size`` neighbours."""
    covered = 1
    while covered < size:
        step = min(covered, size - covered)
        h = np.minimum(h[: len(h) - step], h[step:])
        covered += step
    return h


def stretches(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each stretch of set marks."""
    change = np.flatnonzero(np.diff(np.concatenate(([0], mark.view(np.int8), [0]))))
    return change[::2], change[1::2]


def covered_by(first: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """A mark for each place in one of the ranges."""
    steps = np.bincount(first, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def direct_runs(ids: np.ndarray, text: np.ndarray, period: int) -> Found:
    """Runs of a small period, by comparing each word with the one a period on."""
    same = (ids[:-period] == ids[period:]) & (text[:-period] == text[period:])
    first, end = stretches(same)
    long = end - first >= (REPEATS - 1) * period
    first, end = first[long], end[long] + period
    return first, end, np.full(len(first), period)


def synchronising_set(
    sums: np.ndarray, ends: np.ndarray, scale: int, periodic: np.ndarray
) -> np.ndarray:
    """Places of the set; ``ends``: the end of each unit's text; ``periodic``: windows left out."""
    n = len(ends)
    at = np.arange(n - scale + 1)
    h = np.minimum(tx.word_hash(sums, at, at + scale), _NONE - np.uint64(1))
    h[periodic[: len(h)]] = _NONE
    low = least_of(h, scale + 1)
    at = at[: len(low)]
    chosen = (low != _NONE) & ((h[: len(low)] == low) | (h[scale:] == low))
    return np.flatnonzero(chosen & (at + 2 * scale <= ends[: len(low)]))


def proposals(
    sums: np.ndarray, text: np.ndarray, places: np.ndarray, scale: int
) -> tuple[np.ndarray, np.ndarray]:
    """A place and a period for each chain of neighbours with equal contexts."""
    context = tx.word_hash(sums, places, places + 2 * scale)
    order = np.argsort(context, kind="stable")
    here, there = places[order[:-1]], places[order[1:]]
    period = there - here
    pair = (context[order[1:]] == context[order[:-1]]) & (text[here] == text[there])
    pair &= (period >= scale) & (period < 2 * scale)
    here, period = here[pair], period[pair]
    order = np.lexsort((here, period))
    here, period = here[order], period[order]
    # Contexts that meet or overlap are one stretch of that period.
    new = np.ones(len(here), bool)
    new[1:] = (period[1:] != period[:-1]) | (here[1:] > here[:-1] + 2 * scale)
    return here[new], period[new]


def extended(
    ids: np.ndarray, begins: np.ndarray, ends: np.ndarray, at: np.ndarray, period: np.ndarray
) -> Found:
    """Proposed places and periods as the longest stretches that keep the period."""

    def reach(step: int) -> np.ndarray:
        """How many words from the place on (or before it) equal those a period on."""
        start = at if step > 0 else at - 1
        # The last place that can be compared, seen from the start.
        room = ends[at] - period - start if step > 0 else start - begins[at] + 1
        got, open_, size = np.zeros(len(at), np.int64), np.arange(len(at)), 16
        while len(open_):
            offsets = got[open_][:, None] + np.arange(size)
            inside = offsets < room[open_][:, None]
            where = np.where(inside, start[open_][:, None] + step * offsets, 0)
            other = np.where(inside, where + period[open_][:, None], 0)
            same = inside & (ids[where] == ids[other])
            whole = same.all(axis=1)
            got[open_] += np.where(whole, size, same.argmin(axis=1))
            open_ = open_[whole]
            size = max(16, min(2 * size, (1 << 20) // max(len(open_), 1)))
        return got

    first = at - reach(-1)
    end = at + reach(1) + period
    long = end - first >= REPEATS * period
    return first[long], end[long], period[long]


def _joined(parts: list[Found]) -> Found:
    return tuple(np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(3))


def find_runs(ids: np.ndarray, of: np.ndarray) -> Found:
    """Runs of all texts, in order of start and period; ``of``: each text's range of units.

    Texts too short for a scale are left out of the arrays from there on.
    """
    sizes, text = np.diff(of), tx.each_of(of)
    found = [direct_runs(ids, text, q) for q in range(1, FIRST_SCALE)]
    scale, units = FIRST_SCALE, np.arange(len(ids))
    while True:
        keep = sizes[text] >= REPEATS * scale
        if not keep.any():
            break
        if not keep.all():
            ids, text, units = ids[keep], text[keep], units[keep]
        # Texts stay whole, so places here and in all units differ by a shift for each text.
        edge = np.searchsorted(text, np.arange(len(of)))
        begins, ends = edge[text], edge[text + 1]
        shift = of[text] - begins
        first, end, period = _joined(found)
        home = np.searchsorted(of, first, "right") - 1
        small = (period <= scale // 4) & (end - first >= scale) & (sizes[home] >= REPEATS * scale)
        at = np.searchsorted(units, first[small])
        last = at + (end - first)[small] - scale + 1
        periodic = covered_by(at, last, len(ids))
        sums = tx.word_sums(tx.mix(ids.astype(np.uint64) + np.uint64(1)))
        places = synchronising_set(sums, ends, scale, periodic)
        if len(places) > 1:
            at, period = proposals(sums, text, places, scale)
            if len(at):
                first, end, period = extended(ids, begins, ends, at, period)
                move = shift[first] if len(first) else first
                found.append((first + move, end + move, period))
        scale *= 2
    first, end, period = _joined(found)
    order = np.lexsort((period, end, first))
    first, end, period = first[order], end[order], period[order]
    # A stretch found with several periods has the smallest of them.
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (end[1:] != end[:-1])
    new &= end - first >= LEAST_WORDS
    first, end, period = first[new], end[new], period[new]
    order = np.lexsort((period, first))
    return first[order], end[order], period[order]


def kept_bytes(
    data: np.ndarray, first: np.ndarray, last: np.ndarray, of: np.ndarray, kept: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each text, joined by one space, and each text's range."""
    words = np.flatnonzero(kept)
    text = tx.each_of(of)[words]
    follows = np.append(text[1:] == text[:-1], False) if len(words) else np.zeros(0, bool)
    lengths = last[words] - first[words] + follows
    ends = np.append(0, np.cumsum(lengths))
    inside = np.repeat(first[words] - ends[:-1], lengths) + np.arange(ends[-1])
    out = data[np.minimum(inside, len(data) - 1)] if len(inside) else np.zeros(0, np.uint8)
    out[(ends[1:] - 1)[follows]] = 32
    return out, ends[np.searchsorted(text, np.arange(len(of)))]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sep = tx.separators("white")
    for batch in batches:
        for piece in tx.pieces(batch):
            data, offsets = tx.utf8(piece.column(1))
            first, last, of = tx.words(data, offsets, sep)
            start, end, period = find_runs(word_ids(data, first, last), of)
            text = np.searchsorted(of, start, "right") - 1
            dropped = covered_by(start + period, end, len(first))
            joined, ranges = kept_bytes(data, first, last, of, ~dropped)
            runs = pa.StructArray.from_arrays(
                [pa.array(start - of[text]), pa.array(end - start), pa.array(period)],
                ["start", "length", "period"],
            )
            places = np.searchsorted(text, np.arange(len(of))).astype(np.int32)
            yield pa.record_batch(
                [
                    piece.column(0),
                    pa.array(np.diff(of)),
                    pa.ListArray.from_arrays(pa.array(places), runs),
                    tx.binary(joined, ranges).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(documents: DataFrame) -> DataFrame:
    """Runs of the words ``[^\\x20\\x09-\\x0D]+`` of ``doc_id, text``, one row a document.

    ``runs`` holds start (word number), length and smallest period in words of every run, by
    start, then period. ``collapsed`` is the text without the words that repeat others: all
    that some run holds after its first period; the rest is joined by one space. A null or
    empty text, and one of white space, has no words, no runs and an empty collapsed text.
    Each row is judged alone, so repeated rows and ids, and rows without an id, have rows of
    their own. An empty table gives no rows; other columns are not read. Nothing is shuffled;
    a task holds half a megabyte of texts, or one longer text.
    """
    return documents.select("doc_id", "text").mapInArrow(_scan, _SCHEMA)


def planted(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` with a periodic end in about a tenth of the texts, chosen by their id.

    With ``h`` the crc32 of the decimal id and ``g = floor(h / 10)``, where ``h % 10 = 0`` the
    words from ``a = g % n`` on become repetitions of the first ``1 + (n - a) div (3 + g % 8)``
    of them. Words are joined by one space then. Other texts stay as they are, and so do
    those without an id or without words.
    """
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return (
        documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("_h"))
        .withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
        .withColumn("_n", F.size("_words").cast("bigint"))
        .withColumn("_g", F.floor(F.col("_h") / 10))
        .withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
        .withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
        .withColumn(
            "_planted",
            F.expr(
                "slice(concat(slice(_words, 1, int(_a)), flatten(array_repeat("
                "slice(_words, int(_a) + 1, int(_p)), int((_n - _a) div _p + 1)))), 1, int(_n))"
            ),
        )
        .select(
            "doc_id",
            F.when(F.col("_n") > 0, F.array_join("_planted", " ")).otherwise(F.col("text")).alias("text"),
        )
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    # Runs are in order of start and period, so of equal exponents the first one stays.
    best = F.expr(
        f"aggregate(runs, cast(null as {_RUN}), (b, r) -> case when b is null "
        "or r.length * b.period > b.length * r.period then r else b end)"
    )
    lines = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best.alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
