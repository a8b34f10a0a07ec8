"""Near duplicates by a size-aware heavy-light join on word shingles.

Sets of shingles link when 100 * |A n B| >= 75 * |A u B|. Shingles are ordered from rare to
frequent, so that linked sets share a shingle among the first quarter of each, and two among
one shingle more. Small sets are enumerated: each pair of shingles in that prefix is a key.
Large sets scan inverted lists: each single shingle of the prefix is a key. The boundary is
where the pairs of the small sets would cost more than the lists that they save; sets just
below it stand in the lists as well, so that no link across it is lost.

Sets that share a key are candidates. Sets of one key are not paired at once. First each is
compared with one centre of its list, then with the set of its list that has most keys in
common with others: the text that edited copies come from, if it is there. Sets that are not
in one component after that meet by key, size and place: linked sets of sizes ``a`` and ``b``
share ``3 (a + b) / 7`` shingles, so their first shared one stands early in both. The more a
set has of its own, the later its shared shingles stand, and the fewer lists still hold it.
They share many keys besides, so sets with few keys in lists meet none of about their size,
and sets do not meet again at a key if they have one of those just before it in common too.
A parity sketch rules most other pairs out before their shingles are fetched: each bit in
which two sketches differ proves a shingle that one set has alone. What is left is compared
shingle by shingle. Documents of equal sets are one set throughout.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trunkline.llm import text as tx
from trunkline.llm.common import scan_parts, sized, stored, table, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a shingle.
SHINGLE = 5
#: A shingle in this many documents is frequent; the order knows at most so many of them.
#: Both only order shingles: any order finds the same links.
FREQUENT, MOST_FREQUENT = 32, 1_000_000
#: Shingles counted at once in a task, and the count from which a task reports one.
COUNTED, REPORTED = 2_000_000, 4
#: Sets that a task remembers, so as to send copies once.
REMEMBERED = 200_000
#: The largest set that may be enumerated; the cost picks a boundary up to here.
ENUMERATED = 64
#: Sizes of one class differ by less than this factor; sets meet those of the classes in reach.
SIZE_CLASS = 8 / 7
#: Earlier keys of a set that stand beside each of its keys, so that two sets meet once.
EARLIER = 4
#: Bits of a sketch: at least so many, and at least two a shingle, as a power of two.
SKETCH_BITS = 2048


def shingles(piece: pa.RecordBatch, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text and each text's range of them."""
    data, offsets = tx.utf8(piece.column(1))
    hashes, _, _, of = tx.hashed_words(tx.lowered(data), offsets, tx.separators("white"))
    n = np.diff(of)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = of[:-1][doc] + nth
    length = np.minimum(size, n[doc])
    found = tx.word_hash(tx.word_sums(hashes), first, first + length)
    found = tx.mix(found + length.astype(np.uint64))
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        found[a:b].sort()
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    found, doc = found[keep], doc[keep]
    return found, np.searchsorted(doc, np.arange(len(n) + 1))


def set_ids(found: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """One number for each set; equal sets have equal ones."""
    sums = np.append(np.uint64(0), np.cumsum(tx.mix(found ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64))
    n = np.diff(ranges).astype(np.uint64)
    return tx.mix(sums[ranges[1:]] - sums[ranges[:-1]] + n * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Token tables of an earlier job have no use here.
    tx.forget("vocabulary ", "aligner ")
    for batch in batches:
        for piece in tx.pieces(batch):
            found, ranges = shingles(piece)
            yield pa.record_batch(
                [piece.column(0), pa.array(np.diff(ranges)), pa.array(set_ids(found, ranges))],
                names=["doc_id", "n_shingles", "set_id"],
            )


def _count_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0

    def report() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        many = counts >= REPORTED
        return pa.record_batch(
            [pa.array(values[many].view(np.int64)), pa.array(counts[many].astype(np.int64))],
            names=["shingle", "n"],
        )

    for batch in batches:
        for piece in tx.pieces(batch):
            found, _ = shingles(piece)
            held.append(found)
            size += len(found)
            if size >= COUNTED:
                yield report()
                held, size = [], 0
    if held:
        yield report()


def frequent_shingles(documents: DataFrame) -> np.ndarray:
    """Shingles from the less to the more frequent; the most frequent ones if too many."""
    counted = documents.mapInArrow(_count_frequent, "shingle bigint, n bigint")
    total = counted.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    # The limit bounds what the driver holds; it changes the order only, never the links.
    rows = total.orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).select("shingle").toArrow()
    return rows.column(0).to_numpy()[::-1].view(np.uint64)


def _prefix_size(n: np.ndarray, shared: int) -> np.ndarray:
    """Shingles among which linked sets of size ``n`` have ``shared`` in common."""
    return np.minimum(n, n - (3 * n + 3) // 4 + shared)


def _key_task(frequent: np.ndarray, boundary: int, largest: int | None = None):
    """Task function: keys of every different set of the task, up to a size if given."""
    by_value = np.argsort(frequent)
    values = frequent[by_value]

    def find_frequent(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which shingles are frequent, and the places of those in the order."""
        begins = np.zeros(1 << 24, bool)
        begins[values >> np.uint64(40)] = True
        maybe = np.flatnonzero(begins[found >> np.uint64(40)])
        at = np.searchsorted(values, found[maybe])
        hit = values[np.minimum(at, len(values) - 1)] == found[maybe]
        often = np.zeros(len(found), bool)
        often[maybe[hit]] = True
        return often, by_value[at[hit]]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in tx.pieces(batch):
                found, ranges = shingles(piece)
                ids = set_ids(found, ranges)
                yield from one(found, ranges, ids, fresh(ids, seen))

    def fresh(ids: np.ndarray, seen: set[int]) -> np.ndarray:
        """Sets that the task has not sent yet; it forgets when it remembers too many."""
        _, first = np.unique(ids, return_index=True)
        new = np.zeros(len(ids), bool)
        new[[i for i in first if int(ids[i]) not in seen]] = True
        if len(seen) > REMEMBERED:
            seen.clear()
        seen.update(ids[new].tolist())
        return new

    def one(found, ranges, ids, new) -> Iterator[pa.RecordBatch]:
        n = np.diff(ranges)
        new &= n > 1  # a set of one links with its equals only
        if largest is not None:
            new &= n <= largest
        doc = np.repeat(np.arange(len(n)), n)
        keep = new[doc]
        found, doc = found[keep], doc[keep]
        if not len(found):
            return
        # Rare shingles first, in order of their hashes as they stand, then frequent ones by
        # frequency.
        begin = np.searchsorted(doc, np.arange(len(n)))
        nth = np.arange(len(doc)) - begin[doc]
        if len(values):
            often, places = find_frequent(found)
            at = np.flatnonzero(often)
            at = at[np.lexsort((places, doc[at]))]
            last = doc[at]
            rare = np.bincount(doc[~often], minlength=len(n))
            before = np.append(0, np.cumsum(~often))
            nth = before[:-1] - before[begin[doc]]
            nth[at] = rare[last] + np.arange(len(at)) - np.searchsorted(last, last)
            ordered = np.empty_like(found)
            ordered[begin[doc] + nth] = found
            found = ordered
            nth = np.arange(len(doc)) - begin[doc]
        # Large sets, and small ones that a large set may reach: single shingles.
        single = (nth < _prefix_size(n, 1)[doc]) & ((n[doc] > boundary) | (4 * n[doc] >= 3 * (boundary + 1)))
        yield rows(found[single], doc[single], nth[single], ids, n)
        small = np.flatnonzero(new & (n <= boundary))
        p = _prefix_size(n, 2)
        for size in np.unique(p[small]):
            which = small[p[small] == size]
            i, j = np.triu_indices(size, 1)
            base = begin[which][:, None]
            # The order is the same for all sets, so a pair has one key.
            pair = tx.mix(found[base + i] * np.uint64(0x9E3779B97F4A7C15) + tx.mix(found[base + j]))
            # One shared shingle stands before the pair's second one.
            yield rows(pair.ravel(), np.repeat(which, len(i)), np.tile(j - 1, len(which)), ids, n)

    def rows(key, doc, place, ids, n) -> pa.RecordBatch:
        return pa.record_batch(
            [
                pa.array(key.view(np.int64)),
                pa.array(ids[doc]),
                pa.array(n[doc].astype(np.int32)),
                pa.array(place.astype(np.int32)),
            ],
            names=["key", "set_id", "n", "place"],
        )

    return keys


_KEYS = "key bigint, set_id bigint, n int, place int"


def boundary_by_cost(documents: DataFrame, described: DataFrame, frequent: np.ndarray) -> int:
    """The size up to which enumerating pairs costs no more rows than scanning lists.

    A set in the lists costs its keys times the mean length of a list it meets, measured on
    all sets of at most ``ENUMERATED`` shingles.
    """
    sizes = described.where(F.col("n_shingles").between(2, ENUMERATED)).select("n_shingles", "set_id").distinct()
    number = {r[0]: r[1] for r in sizes.groupBy("n_shingles").count().collect()}
    if not number:
        return 0
    lists = documents.mapInArrow(_key_task(frequent, 0, ENUMERATED), _KEYS).distinct().groupBy("key").count()
    both = lists.agg(F.sum("count"), F.sum(F.col("count") * F.col("count"))).first()
    mean_list = both[1] / both[0] if both[0] else 1.0
    n = np.arange(ENUMERATED + 1)
    sets = np.array([number.get(int(a), 0) for a in n], np.float64)
    p2 = _prefix_size(n, 2)
    by_pairs = np.cumsum(sets * p2 * (p2 - 1) / 2)
    by_list = sets * _prefix_size(n, 1) * mean_list
    cost = [
        by_pairs[x] + by_list[(4 * n >= 3 * (x + 1))].sum() if x else by_list.sum()
        for x in range(ENUMERATED + 1)
    ]
    return int(np.argmin(cost))


def _scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of lists with two sets or more, in order of key, size and set, with centres.

    The centre of a row is the first set of its key and size class; that of a class's
    first set is the centre of the class before, if the sizes allow a link.
    """
    held = None  # the last row, whether one of its key came before, and its class's centre
    names = ["key", "set_id", "n", "place", "centre"]

    def classes(n: np.ndarray) -> np.ndarray:
        return np.floor(np.log(np.maximum(n, 1)) / np.log(4 / 3) + 1e-9).astype(np.int64)

    for batch in batches:
        key, ids, n, place = (batch.column(i).to_numpy() for i in range(4))
        if held is not None:
            key, ids, n = np.append(held[0], key), np.append(held[1], ids), np.append(held[2], n)
            place = np.append(held[7], place)
        same = np.zeros(len(key), bool)
        same[1:] = (key[1:] == key[:-1]) & (ids[1:] == ids[:-1])
        key, ids, n, place = key[~same], ids[~same], n[~same], place[~same]
        if not len(key):
            continue
        kind = classes(n)
        goes_on = np.zeros(len(key), bool)  # has a set of its key before it
        goes_on[1:] = key[1:] == key[:-1]
        opens = np.ones(len(key), bool)
        opens[1:] = ~goes_on[1:] | (kind[1:] != kind[:-1])
        starts = np.maximum.accumulate(np.where(opens, np.arange(len(key)), 0))
        centre, centre_n = ids[starts], n[starts]
        if held is not None:
            goes_on[0] = held[3]
            mine = starts == 0
            centre, centre_n = np.where(mine, held[4], centre), np.where(mine, held[5], centre_n)
        link = centre.copy()
        later = np.flatnonzero(opens & goes_on)
        later = later[later > 0]
        near = 4 * centre_n[later - 1].astype(np.int64) >= 3 * n[later].astype(np.int64)
        link[later] = np.where(near, centre[later - 1], ids[later])
        if held is not None and opens[0]:
            link[0] = held[6]
        has_next = np.append(goes_on[1:], False)
        out = (goes_on | has_next)[:-1]
        if out.any():
            yield pa.record_batch(
                [pa.array(x[:-1][out]) for x in (key, ids, n, place, link)], names=names
            )
        held = (key[-1], ids[-1], n[-1], bool(goes_on[-1]), centre[-1], centre_n[-1], link[-1], place[-1])
    if held is not None and held[3]:
        row = (held[0], held[1], held[2], held[7], held[6])
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        yield pa.record_batch([pa.array([x], t) for x, t in zip(row, types, strict=True)], names=names)


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every set's size and sketch: the parity of its shingles in each bit.

    The halves of a sketch, bit by bit, make the sketch of half the bits.
    """
    for batch in batches:
        for piece in tx.pieces(batch):
            found, ranges = shingles(piece)
            n = np.diff(ranges)
            doc = np.repeat(np.arange(len(n)), n)
            wanted = np.maximum(2 * n, SKETCH_BITS)
            bits = np.int64(1) << np.ceil(np.log2(wanted)).astype(np.int64)
            begin = np.append(0, np.cumsum(bits))
            bit = (tx.mix(found) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
            odd = np.bincount(begin[doc] + bit, minlength=int(begin[-1])).astype(np.uint8) & 1
            sketch = np.packbits(odd, bitorder="little").view(np.int64)
            yield pa.record_batch(
                [
                    pa.array(set_ids(found, ranges)),
                    pa.array(n.astype(np.int32)),
                    pa.ListArray.from_arrays(
                        pa.array((begin // 64).astype(np.int32)), pa.array(sketch)
                    ),
                ],
                names=["set_id", "n", "sketch"],
            )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every set with its shingles."""
    for batch in batches:
        for piece in tx.pieces(batch):
            found, ranges = shingles(piece)
            yield pa.record_batch(
                [
                    pa.array(set_ids(found, ranges)),
                    pa.array(np.diff(ranges).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ranges.astype(np.int32)), pa.array(found.view(np.int64))),
                ],
                names=["set_id", "n", "shingles"],
            )


_SKETCHES = "set_id bigint, n int, sketch array<bigint>"
_SETS = "set_id bigint, n int, shingles array<bigint>"


def _of_sets(documents: DataFrame, described: DataFrame, ids: DataFrame, task, schema: str) -> DataFrame:
    """A task's rows for the sets ``set_id``, from the document of least id for each.

    Documents that share that id give rows of their own, which repeat or match nothing.
    """
    wanted = described.join(sized(stored(ids.select("set_id").distinct(), "ids"), 16), "set_id", "left_semi")
    chosen = wanted.groupBy("set_id").agg(F.min("doc_id").alias("id")).select("id").distinct()
    chosen = stored(chosen, "chosen")
    texts = documents.join(sized(chosen, 16), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    return stored(texts.mapInArrow(task, schema), "sets")


def _folded(sketch: str, other: str) -> Column:
    """A sketch in half its bits, if the other one has no more."""
    half = F.size(other)
    return F.when(
        F.size(sketch) > half,
        F.zip_with(
            F.slice(sketch, F.lit(1), half),
            F.slice(sketch, half + 1, half),
            lambda x, y: x.bitwiseXOR(y),
        ),
    ).otherwise(F.col(sketch))


def _possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that sizes and sketches do not rule out.

    Sizes go first, with the sketches' sizes at most one doubling apart.
    """
    sizes = sketches.select("set_id", "n")
    sized_pairs = pairs
    for side in "ab":
        marked = sized(sizes, 24).select(F.col("set_id").alias(side), F.col("n").alias(f"n{side}"))
        sized_pairs = sized_pairs.join(marked, side)
    near = (4 * F.col("na") >= 3 * F.col("nb")) & (4 * F.col("nb") >= 3 * F.col("na"))
    left = stored(sized_pairs.where(near).distinct(), "near")
    for side in "ab":
        marked = sketches.select(F.col("set_id").alias(side), F.col("sketch").alias(f"s{side}"))
        left = left.join(marked, side)
    differ = F.aggregate(
        F.zip_with(_folded("sa", "sb"), _folded("sb", "sa"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda n, x: n + x,
    )
    left = left.where(7 * differ <= F.col("na") + F.col("nb"))
    return stored(left.drop("na", "nb", "sa", "sb").distinct(), "possible")


def _linked(common: Column, a: Column, b: Column) -> Column:
    return 100 * common >= 75 * (a + b - common)


def _verified(pairs: DataFrame, sets: DataFrame, row_bytes: int = 24) -> DataFrame:
    """The pairs ``(a, b)`` of sets that link, compared shingle by shingle."""
    pairs = sized(pairs, row_bytes)
    left = sets.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return stored(both.where(_linked(common, F.col("na"), F.col("nb"))).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """``(set_id, root)`` of all sets in links ``(a, b)``; the root is the least of them.

    Alternating stars: each set links its larger, then its smaller neighbours to the least
    one, until nothing changes. Every round is a table in the shared folder.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, state = stored(edges.distinct(), "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("set_id"), F.col("v").alias("root"))
        state = now
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")
        )
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        edges = stored(small.where("u > v").distinct(), "edges")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links, which are first taken to the old roots."""
    ends = _with_roots(_with_roots(links, roots, "a", "ra"), roots, "b", "rb")
    more = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    old = _with_roots(roots.select("set_id", F.col("root").alias("old")), more, "old", "root")
    new = more.join(sized(roots, 16), "set_id", "left_anti")
    return stored(old.select("set_id", "root").unionByName(new), "roots")


def _with_roots(df: DataFrame, roots: DataFrame, column: str, alias: str) -> DataFrame:
    """``df`` with the root of a column of sets; a set without links is its own."""
    right = sized(roots, 16).select(F.col("set_id").alias("_set"), F.col("root").alias("_root"))
    joined = df.join(right, F.col(column) == F.col("_set"), "left")
    return joined.withColumn(alias, F.coalesce("_root", column)).drop("_set", "_root")


def _roots(documents: DataFrame, described: DataFrame) -> DataFrame:
    """``(set_id, root)`` of all sets that link with others."""
    frequent = frequent_shingles(documents)
    boundary = boundary_by_cost(documents, described, frequent)
    keys = documents.mapInArrow(_key_task(frequent, boundary), _KEYS)
    lists = stored(
        keys.repartition(scan_parts(documents), "key")
        .sortWithinPartitions("key", "n", "set_id")
        .mapInArrow(_scan_lists, f"{_KEYS}, centre bigint"),
        "lists",
    )
    # Each set with its centres, as far as they may link.
    stars = lists.where("set_id <> centre").groupBy("set_id", "centre").agg(F.count("*").alias("votes"))
    stars = stars.select(F.col("set_id").alias("a"), F.col("centre").alias("b"), "votes")
    sketches = _of_sets(documents, described, lists, _sketch_rows, _SKETCHES)
    stars = _possible(stars, sketches)
    sets = _of_sets(documents, described, _ends(stars), _set_rows, _SETS)

    # First the centre that a set shares most keys with, then others in other components.
    first = stored(stars.groupBy("a").agg(F.max_by("b", "votes").alias("b")), "pairs")
    roots = components(_verified(first, sets))
    apart = _with_roots(_with_roots(stars, roots, "a", "ra"), roots, "b", "rb").where("ra <> rb")
    roots = _joined(roots, _verified(stored(apart.select("a", "b"), "pairs"), sets))

    # Then the set of a list that has most keys in lists, where the list is still mixed.
    weights = stored(lists.groupBy("set_id").agg(F.count("*").alias("weight")), "weights")
    rows = _mixed(lists.select("key", "set_id", "n", "place").join(sized(weights, 16), "set_id"), roots)
    pairs = _possible(_centred(rows), sketches)
    sets = _of_sets(documents, described, _ends(pairs), _set_rows, _SETS)
    roots = _joined(roots, _verified(pairs, sets))

    # All that is left: sets of one key in different components.
    pairs = _possible(_placed_pairs(_mixed(rows.drop("root"), roots)), sketches)
    sets = _of_sets(documents, described, _ends(pairs), _set_rows, _SETS)
    return _joined(roots, _verified(pairs, sets))


def _mixed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows, with their roots, of keys whose sets are in several components.

    Of keys with the same sets the first one in the order of shingles stands for all: it has
    the earliest places in each set, so the same pairs meet there.
    """
    placed = stored(_with_roots(rows, roots, "set_id", "root"), "placed")
    spans = placed.groupBy("key").agg(
        F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("set_id")).alias("sets"), F.min(F.struct("set_id", "place")).alias("least"),
    )
    first = F.min_by("key", F.struct("least.place", "key")).alias("key")
    mixed = stored(spans.where("x <> y").groupBy("sets", "size", "least.set_id").agg(first).select("key"), "mixed")
    return stored(placed.join(sized(mixed, 16), "key", "left_semi"), "rows")


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(SIZE_CLASS))).cast("int")


def _centred(rows: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of each set and the weightiest one of its key and size class."""
    classed = rows.withColumn("kind", _size_class(F.col("n")))
    best = F.max(F.struct("weight", "set_id", "root")).alias("best")
    centres = stored(classed.groupBy("key", "kind").agg(best), "centres")
    apart = F.col("root") != F.col("best.root")
    pairs = classed.join(sized(centres, 48), ["key", "kind"]).where(apart)
    return stored(pairs.select(F.col("set_id").alias("a"), F.col("best.set_id").alias("b")).distinct(), "pairs")


def _shared(a: Column, b: Column) -> Column:
    """Shingles that linked sets of these sizes share at least."""
    return F.ceil(3 * (a + b) / 7)


def _shared_keys(small: Column, large: Column) -> Column:
    """Keys in lists that linked sets of these sizes share at least, the smaller one first.

    All but so many of the shingles that they share stand in the prefixes of both, as the
    order is the same for both. It holds for sets whose single shingles are keys.
    """
    return F.when(small > ENUMERATED, _shared(small, large) - F.ceil(3 * large / 4) + 1).otherwise(1)


def _meetings(rows: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` in different components, the smaller one first, whose first shared key
    may stand where it does and which have keys enough in lists; some pairs more than once.

    A set of ``n`` shingles that shares ``s`` with another has the first of them at place
    ``n - s`` at most. The smaller set shares at least 6/7 of its own; the larger one looks
    into each size class that it can link with. A set's ``weight`` is the number of its keys
    in lists: long sets that have a few in common meet in every list of those, but do not link.

    A pair that also has one of the keys just before in common stands in that key's list, at
    earlier places in both sets, so it is left out; at its first shared key it never is.
    """
    before = Window.partitionBy("set_id").orderBy("place", "key").rowsBetween(-EARLIER, -1)
    rows = rows.withColumn("earlier", F.collect_list("key").over(before))
    size, place = F.col("n"), F.col("place")
    small = rows.where(place <= size - _shared(size, size)).select(
        "key", _size_class(size).alias("kind"), F.col("set_id").alias("a"), F.col("n").alias("na"),
        F.col("place").alias("pa"), F.col("root").alias("ra"), F.col("weight").alias("wa"),
        F.col("earlier").alias("ea"),
    )
    least = F.ceil(3 * size / 4)
    large = rows.withColumn("kind", F.explode(F.sequence(_size_class(least), _size_class(size))))
    # The least size of a class, or one less, as powers are not exact.
    reach = F.greatest(least, F.floor(F.pow(F.lit(SIZE_CLASS), F.col("kind"))) - 1)
    # The larger the smaller set is, the more keys both share.
    enough = _shared_keys(F.least(reach, size), size) <= F.col("weight")
    large = large.where((place <= size - _shared(size, reach)) & enough).select(
        F.col("key").alias("key_b"), F.col("kind").alias("kind_b"), F.col("set_id").alias("b"),
        F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("root").alias("rb"), F.col("weight").alias("wb"),
        F.col("earlier").alias("eb"),
    )
    shared = _shared(F.col("na"), F.col("nb"))
    ordered = (F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))
    meet = (
        (F.col("key") == F.col("key_b")) & (F.col("kind") == F.col("kind_b"))
        & ordered & (F.col("ra") != F.col("rb")) & (shared <= F.col("na"))
        & (F.col("pa") <= F.col("na") - shared) & (F.col("pb") <= F.col("nb") - shared)
        & (_shared_keys(F.col("na"), F.col("nb")) <= F.least("wa", "wb"))
        & ~F.arrays_overlap("ea", "eb")
    )
    return small.join(large, meet).select("a", "b")


def _placed_pairs(rows: DataFrame) -> DataFrame:
    return stored(_meetings(rows).distinct(), "pairs")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id")))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Components of linked texts among ``doc_id, text``.

    Returns doc_id, n_shingles, component_id (the least doc_id of the component) and
    component_size (rows), one row for each row given. Null texts and texts without words
    have no shingles and are alone. Repeated rows are in one component. A null id is in
    its component but never its name unless all are null. An empty table gives no rows;
    other columns are not read.
    """
    documents = documents.select("doc_id", "text")
    schema = "doc_id bigint, n_shingles bigint, set_id bigint"
    described = stored(documents.mapInArrow(_describe, schema), "described")
    roots = _roots(documents, described)
    rows = _with_roots(described, roots, "set_id", "root")
    filled = rows.where("n_shingles > 0")
    named = stored(
        filled.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("component_size")),
        "components",
    )
    alone = rows.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("bigint").alias("component_size")
    )
    return filled.join(sized(named, 32), "root").select(
        "doc_id", "n_shingles", "component_id", "component_size"
    ).unionByName(alone)


def jaccard_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the least id."""
    found = near_duplicates(documents)
    return without(documents, found.where("doc_id <> component_id"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
