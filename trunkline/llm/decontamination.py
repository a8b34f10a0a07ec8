"""Benchmark decontamination over a generalised suffix automaton of the items' words.

The automaton accepts every sequence of words that stands in some item. Training words
are streamed through it with the length of the longest match that ends at each word; a
match of a window's length marks its words. Words that no item has reset the match, so
stretches of known words that are too short for any window are passed over at once.
Marked words are cut out of their texts; only a row with more of them than a stated part of
its words goes as a whole.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.llm import text as tx
from trunkline.llm.common import sized, stored, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a window.
WINDOW = 10
#: Words of items that one automaton holds; more items make more automata, one scan each.
AUTOMATON_WORDS = 1_000_000
#: The part of a row's words that may be cut out; a row with more marked words is dropped.
COVERAGE = 0.04
#: Characters that are in no word, as in ``text.separators("alnum")`` with A-Z in lower case.
_BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
SPANS = (
    "doc_id bigint, n_words bigint, spans array<struct<first:bigint,last:bigint>>, "
    "items array<bigint>, text_hash bigint"
)
#: Stands for an item without an id; no id is as large.
_NO_ID = 1 << 63


class Automaton:
    """Generalised suffix automaton of word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        starts = []
        for item, sequence in items:
            state, path = 0, []
            for word in sequence:
                state = self._extend(state, word)
                path.append(state)
            starts.append((item, sequence, path))
        self.window = window
        #: The state of a window, or of a whole short item: its length and its items.
        self.marks: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
        found: dict[int, dict[int, set[int]]] = {}
        for item, sequence, path in starts:
            size = min(window, len(sequence))
            for end in range(size - 1, len(sequence)):
                state = path[end]
                while self.length[self.link[state]] >= size if state else False:
                    state = self.link[state]
                found.setdefault(state, {}).setdefault(size, set()).add(item)
        for state, sizes in found.items():
            self.marks[state] = [(n, tuple(sorted(i))) for n, i in sorted(sizes.items())]
        self.shortest = min((n for s in found.values() for n in s), default=0)
        #: The nearest state on the chain of suffixes that has a mark, itself included.
        self.marked = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.marked[state] = (
                state if state in self.marks else self.marked[self.link[state]] if state else -1
            )

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(word)
        if known is not None:
            if length[known] == length[last] + 1:
                return known
            return self._clone(last, word, known)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        state = last
        while state != -1 and word not in nxt[state]:
            nxt[state][word] = new
            state = link[state]
        if state == -1:
            link[new] = 0
        else:
            other = nxt[state][word]
            link[new] = (
                other if length[other] == length[state] + 1 else self._clone(state, word, other)
            )
        return new

    def _clone(self, state: int, word: int, other: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[other]))
        link.append(link[other])
        length.append(length[state] + 1)
        link[other] = copy
        while state != -1 and nxt[state].get(word) == other:
            nxt[state][word] = copy
            state = link[state]
        return copy

    def scan(self, sequence: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Marked spans of word numbers, in order of their ends, and the items found."""
        spans, items = [], set()
        nxt, link, length, marked = self.next, self.link, self.length, self.marked
        state = matched = 0
        for at, word in enumerate(sequence):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                matched += 1
            mark = marked[state]
            while mark != -1:
                for size, owners in self.marks[mark]:
                    if size <= matched:
                        spans.append((at + 1 - size, at + 1))
                        items.update(owners)
                mark = marked[link[mark]] if mark else -1
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _item_words(items: list[tuple[int, str]]) -> list[tuple[int, np.ndarray]]:
    if not items:
        return []
    texts = pa.array([t for _, t in items], pa.string())
    data, offsets = tx.utf8(texts)
    hashes, _, _, of = tx.hashed_words(tx.lowered(data), offsets, tx.separators("alnum"))
    return [(i, hashes[a:b]) for (i, _), a, b in zip(items, of[:-1], of[1:], strict=True) if b > a]


def automaton_of(
    items: list[tuple[int, str]], window: int = WINDOW
) -> tuple[np.ndarray, Automaton] | None:
    """The items' word hashes in order, and the automaton over their numbers."""
    sequences = _item_words(items)
    if not sequences:
        return None
    known = np.unique(np.concatenate([s for _, s in sequences]))
    numbered = [(i, np.searchsorted(known, s).tolist()) for i, s in sequences]
    return known, Automaton(numbered, window)


def _scanner(known: np.ndarray, automaton: Automaton):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
            ("items", pa.list_(pa.int64())),
            ("text_hash", pa.int64()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tx.pieces(batch):
                yield one(piece)

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = tx.utf8(piece.column(1))
        hashes, _, _, of = tx.hashed_words(tx.lowered(data), offsets, tx.separators("alnum"))
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        inside = known[at] == hashes
        # Stretches of known words within one text.
        border = np.zeros(len(hashes) + 1, bool)
        border[of] = True
        padded = np.append(inside, False)
        before = np.append(False, inside)
        first = np.flatnonzero(padded & (border | ~before))
        last = np.flatnonzero(before & (border | ~padded))
        long = last - first >= automaton.shortest
        first, last = first[long], last[long]
        doc = np.searchsorted(of, first, "right") - 1
        spans: list[list] = [[] for _ in range(piece.num_rows)]
        items: list[set] = [set() for _ in range(piece.num_rows)]
        for d, a, b in zip(doc.tolist(), first.tolist(), last.tolist(), strict=True):
            got, owners = automaton.scan(at[a:b].tolist())
            start = a - int(of[d])
            spans[d] += [(start + x, start + y) for x, y in got]
            items[d] |= owners
        return pa.record_batch(
            [
                piece.column(0),
                pa.array(np.diff(of)),
                pa.array([[{"first": a, "last": b} for a, b in merged(s)] for s in spans], schema[2].type),
                pa.array([sorted(i - {_NO_ID}) for i in items], schema[3].type),
                piece.column(2),
            ],
            schema=schema,
        )

    return scan


def _shards(benchmark: DataFrame, words: int) -> Iterator[list[tuple[int, str]]]:
    """The items in lists of about ``words`` words each, one list at a time."""
    shard: list[tuple[int, str]] = []
    size = 0
    for row in benchmark.where("text is not null").select("item_id", "text").toLocalIterator():
        shard.append((row.item_id, row.text))
        size += len(row.text) // 2 + 1  # no text has more words
        if size >= words:
            yield shard
            shard, size = [], 0
    if shard:
        yield shard


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    automaton_words: int = AUTOMATON_WORDS,
) -> DataFrame:
    """Words of ``doc_id, text`` inside a window of an item of ``item_id, text``.

    Returns doc_id, n_words, spans (disjoint, in words, ends excluded) and items (ids in
    order), one row for each row given. Null and empty texts have no words; items without
    words match nothing; an item with a null id marks words but is in no list. Rows that
    repeat are judged one by one, items that share an id count once. Empty tables give no
    rows or no hits. Other columns are not read. At most ``automaton_words`` words of
    items are on the driver and in a task at once; a larger set takes several scans.
    """
    documents = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    parts = []
    for shard in _shards(benchmark, automaton_words):
        built = automaton_of([(_NO_ID if i is None else i, t) for i, t in shard], window)
        if built:
            parts.append(documents.mapInArrow(_scanner(*built), SPANS))
    if not parts:
        none = automaton_of([(0, "0")], 1)
        none[1].shortest = sys.maxsize
        parts.append(documents.mapInArrow(_scanner(*none), SPANS))
    found = parts[0]
    if len(parts) > 1:
        found = _together(parts)
    return found.drop("text_hash")


def _together(parts: list[DataFrame]) -> DataFrame:
    """Results of several automata, one row for each row given.

    A row is its id, or none, and its text, by a hash of 64 bits; equal rows agree in all
    parts, and there are as many of them as in one part.
    """
    union = stored(parts[0].unionByName(parts[1]) if len(parts) == 2 else _union(parts), "hits")
    merged_spans = F.aggregate(
        F.array_sort(F.flatten(F.collect_set("spans"))),
        F.expr("cast(array() as array<struct<first:bigint,last:bigint>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["first"] <= F.element_at(done, -1)["last"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["first"].alias("first"),
                        F.greatest(F.element_at(done, -1)["last"], s["last"]).alias("last"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    copies = (F.count("*") / F.lit(len(parts))).cast("int")
    return (
        union.groupBy("doc_id", "text_hash", "n_words")
        .agg(
            merged_spans.alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            copies.alias("copies"),
        )
        .select(
            "doc_id", "n_words", "spans", "items", "text_hash",
            F.explode(F.sequence(F.lit(1), "copies")),
        )
        .drop("col")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def span_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and the characters after each of them."""
    words = F.regexp_extract_all(text, F.lit(f"[^{_BETWEEN}]+[{_BETWEEN}]*"), F.lit(0))
    kept = F.filter(
        words,
        lambda _, i: ~F.exists(spans, lambda s: (s["first"] <= i) & (i < s["last"])),
    )
    return F.concat(F.regexp_extract(text, rf"\A[{_BETWEEN}]*", 0), F.array_join(kept, ""))


def cut_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    automaton_words: int = AUTOMATON_WORDS,
) -> DataFrame:
    """``documents`` with the words of ``contamination`` cut out of their ``text``.

    A row with more than ``coverage`` of its words cut is dropped. Words that form a window
    only once others are gone are cut too, so no text that stays holds one. Each row is
    judged by its text alone, whatever its id; equal texts fare alike, by 64-bit hashes.
    Returns the columns given; only ``text`` differs, and only where it is cut.
    """
    texts = documents.select(F.xxhash64("text").alias("_key"), "text")

    def marked(rows: DataFrame) -> DataFrame:
        named = rows.select(F.col("_key").alias("doc_id"), "text")
        found = contamination(named, benchmark, window, automaton_words)
        found = found.where(F.size("spans") > 0).dropDuplicates(["doc_id"])
        return found.select(
            F.col("doc_id").alias("_key"), "n_words", span_words().alias("n_cut"), "spans"
        )

    def judged(found: DataFrame) -> DataFrame:
        over = F.col("n_cut") > F.lit(coverage) * F.col("n_words")
        return stored(found.withColumn("_over", over), "cuts")

    cuts = judged(marked(texts).withColumn("_rounds", F.array("spans")).drop("spans"))
    done, open_ = [cuts.where("_over")], cuts.where("not _over")
    # Only rows that were cut are read again, until none of them has a window.
    rest = texts.join(sized(open_.select("_key"), 16), "_key", "left_semi").dropDuplicates(["_key"])
    rest = stored(rest, "rest")
    while not open_.isEmpty():
        rest = rest.join(open_.select("_key", "_rounds"), "_key")
        last = F.element_at("_rounds", -1)
        rest = stored(rest.select("_key", without_spans(F.col("text"), last).alias("text")), "rest")
        more = stored(marked(rest).select("_key", F.col("n_cut").alias("n"), "spans"), "more")
        done.append(open_.join(more, "_key", "left_anti"))
        again = open_.join(more, "_key").select(
            "_key", "n_words", (F.col("n_cut") + F.col("n")).alias("n_cut"),
            F.concat("_rounds", F.array("spans")).alias("_rounds"),
        )
        again = judged(again)
        done.append(again.where("_over"))
        open_ = again.where("not _over")
    settled = done[0].select("_key", "_over", "_rounds")
    for part in done[1:]:
        settled = settled.unionByName(part.select("_key", "_over", "_rounds"))
    rows = documents.withColumn("_key", F.xxhash64("text")).join(
        sized(stored(settled, "settled"), 128), "_key", "left"
    )
    cut = F.aggregate("_rounds", F.col("text"), without_spans)
    return rows.where(~F.coalesce("_over", F.lit(False))).select(
        *[F.coalesce(cut, "text").alias(c) if c == "text" else F.col(c) for c in documents.columns]
    )


def decontamination_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the windows of benchmark items; those with many of them go.

    ``n_chars``, where a row has it, follows its text.
    """
    clean = cut_contamination(documents, table(spark, sf_dir, "benchmark"))
    if "n_chars" not in documents.columns:
        return clean
    length = F.when(F.col("n_chars").isNotNull(), F.length("text"))
    return clean.withColumn("n_chars", length.cast(documents.schema["n_chars"].dataType))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    n_hit = span_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
