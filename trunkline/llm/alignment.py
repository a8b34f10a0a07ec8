"""Alignment of the tokens of two public tokenizers by the bytes that they stand for.

A is the byte-level tokenizer of the tokenizers library on a space and the text, B the
sentencepiece model on the text, to which it adds that space. Where tokens of both end at the
same byte they are cut into groups. The libraries' spans (character offsets of A, spans of
B's proto) give the cuts between tokens that stand for whole characters. Between two such
cuts, tokens of a part of a character and byte-fallback tokens are placed by their decoded
bytes.

A never merges a letter, number or mark with a space after it, by its pattern, and B has no
token with a space after something else. So a text is cut before a space after a character
that is no space, and each different segment is aligned once in a worker. How often an id pair is linked counts over the whole table. Of the last tokens of a
group one ends with the bytes of the other, so a vocabulary has at most as many pairs as its
tokens have bytes; that bounds the table of pairs whatever the number of documents.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.llm import text as tx
from trunkline.llm import tokens
from trunkline.llm.common import stored, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECES = "piece_bpe_32k.model"
#: Ids of B in a pair's code ``a * B_IDS + b``; codes of both vocabularies fit 32 bits.
B_IDS = 32_000
#: Bits of a worker's table of segments, which it fills to a quarter, and the bytes that it
#: keeps, before it starts afresh.
TABLE_BITS, KEPT_BYTES = 21, 96 << 20
#: Segments that the libraries get at once, and that are looked up at once; another quarter of
#: the table takes those.
ALIGNED_AT_ONCE, LOOKED_UP = 2_000, 20_000
#: Bytes of texts that are aligned together; their groups take several times as much.
PIECE_BYTES = 1 << 18
#: Links that a task counts at once.
COUNTED = 1_000_000
_ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, links binary"
)
_SPACE_MARK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The bytes behind the characters of a byte-level vocabulary: printable characters of
    Latin-1 stand for themselves, the other bytes in order for those from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def clean(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether a token's span is as long as its bytes: it stands for whole characters."""
    return end - begin == sizes


def common_ends(
    size: int, a_ends: np.ndarray, a_clean: np.ndarray, a_sizes: np.ndarray,
    b_ends: np.ndarray, b_clean: np.ndarray, b_sizes: np.ndarray, borders: np.ndarray,
) -> np.ndarray:
    """Byte ends that tokens of A and B have in common, of ``size`` bytes that both cover.

    Ends of clean tokens are those of the spans and give coarse cuts; ``borders``, the ends
    of segments, are cuts too. Where a token between two of them is not clean, ends come
    from the decoded bytes.
    """

    def marked(ends: np.ndarray) -> np.ndarray:
        mark = np.zeros(size + 1, bool)
        mark[ends] = True
        return mark

    cut = marked(a_ends[a_clean]) & marked(b_ends[b_clean])
    cut[borders] = True
    a_decoded, b_decoded = np.cumsum(a_sizes), np.cumsum(b_sizes)
    coarse = np.flatnonzero(cut)
    fine = np.zeros(len(coarse), bool)  # stretches, by their end, with tokens that are not clean
    for decoded, whole in ((a_decoded, a_clean), (b_decoded, b_clean)):
        fine[np.searchsorted(coarse, decoded[~whole])] = True
    if fine.any():
        both = np.flatnonzero(marked(a_decoded) & marked(b_decoded))
        cut[both[fine[np.searchsorted(coarse, both)]]] = True
    return np.flatnonzero(cut)


class Bytes:
    """Byte strings by number, in one array."""

    def __init__(self, parts: list[bytes]) -> None:
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.base = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def joined(self, which: np.ndarray) -> np.ndarray:
        return gathered(self.data, self.base[which], self.sizes[which])


def gathered(values: np.ndarray, base: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Consecutive ranges of an array, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(base - (ends - sizes), sizes) + np.arange(total)]


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type) -> None:
        self.values, self.used = np.zeros(1 << 16, kind), 0

    def append(self, more: np.ndarray) -> int:
        """Where the appended values begin."""
        begin, self.used = self.used, self.used + len(more)
        while self.used > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[begin : self.used] = more
        return begin


class Aligned:
    """Alignments of some segments: for each the numbers of tokens of A and B and of groups
    (no groups: a tokenizer changes its bytes), the linked pairs and the groups as text."""

    def __init__(self, counts: np.ndarray, links: np.ndarray, text: np.ndarray, text_sizes: np.ndarray):
        self.counts, self.links, self.text, self.text_sizes = counts, links, text, text_sizes


class Aligner:
    """Both tokenizers, their tokens' bytes, and the segments aligned so far."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are ordinary text here
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = byte_alphabet()
        a_parts = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            a_parts[i] = bytes(letters[c] for c in token if c in letters)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_parts = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(_SPACE_MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.a_bytes, self.b_bytes = Bytes(a_parts), Bytes(b_parts)
        self.digits = Bytes([b"%d " % i for i in range(max(len(a_parts), len(b_parts)))])
        #: Whether no token of B goes on with a space after something else.
        self.separable = not any(
            x != 32 and y == 32 for t in b_parts for x, y in zip(t, t[1:], strict=False)
        )
        self.clear()

    def clear(self) -> None:
        size = 1 << TABLE_BITS
        self.key, self.place = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        self.entries = 0
        self.counts, self.base = Growing(np.int32), Growing(np.int32)
        self.links, self.text = Growing(np.int32), Growing(np.uint8)

    def align(self, segments: list[str]) -> Aligned:
        """The segments, each of which begins with a space, and has more."""
        data = np.frombuffer("".join(segments).encode(), np.uint8)
        a_found = self.a.encode_batch(segments, add_special_tokens=False)
        b_found = self.b.encode([s[1:] for s in segments], return_type="proto", num_threads=1)
        n = len(segments)
        letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        letter = np.append(0, np.cumsum([len(s) for s in segments]))
        base = letters[letter]

        def flat(lists) -> np.ndarray:
            return np.fromiter(chain.from_iterable(lists), np.int64)

        a_ids, a_n = flat(e.ids for e in a_found), np.array([len(e.ids) for e in a_found], np.int64)
        spans = flat(chain.from_iterable(e.offsets for e in a_found)).reshape(-1, 2)
        spans = letters[spans + letter[np.repeat(np.arange(n), a_n)][:, None]]
        pieces = [p.pieces for p in b_found]
        b_n = np.array([len(p) for p in pieces], np.int64)
        found = flat((x.id, x.begin, x.end) for p in pieces for x in p).reshape(-1, 3)
        b_ids, b_of = found[:, 0], np.repeat(np.arange(n), b_n)
        # B's spans do not count the space that it adds; its first token has it.
        b_begin, b_end = (found[:, k] + base[b_of] + 1 for k in (1, 2))
        b_first = np.cumsum(b_n)[b_n > 0] - b_n[b_n > 0]
        b_begin[b_first] = base[b_of[b_first]]

        # Segments whose bytes both give back; the others have no tokens.
        a_of = np.repeat(np.arange(n), a_n)
        good = self._same(data, base, self.a_bytes, a_ids, a_of)
        good &= self._same(data, base, self.b_bytes, b_ids, b_of)
        if not good.all():
            a_kept, b_kept = good[a_of], good[b_of]
            moved = base - np.append(0, np.cumsum(np.where(good, 0, np.diff(base))))
            shift = (base - moved)[:-1]
            a_ids, spans, a_of = a_ids[a_kept], spans[a_kept], a_of[a_kept]
            b_ids, b_begin, b_end, b_of = b_ids[b_kept], b_begin[b_kept], b_end[b_kept], b_of[b_kept]
            spans = spans - shift[a_of][:, None]
            b_begin, b_end = b_begin - shift[b_of], b_end - shift[b_of]
            base = moved
        counts = np.zeros((n, 3), np.int64)
        counts[:, 0] = np.bincount(a_of, minlength=n)
        counts[:, 1] = np.bincount(b_of, minlength=n)
        if not len(a_ids):
            return Aligned(counts, np.zeros(0, np.int32), np.zeros(0, np.uint8), counts[:, 2].copy())
        a_sizes, b_sizes = self.a_bytes.sizes[a_ids], self.b_bytes.sizes[b_ids]
        ends = common_ends(
            int(base[-1]),
            spans[:, 1], clean(spans[:, 0], spans[:, 1], a_sizes), a_sizes,
            b_end, clean(b_begin, b_end, b_sizes), b_sizes, base[1:][good],
        )
        # Last tokens of the groups.
        a_last = np.searchsorted(np.cumsum(a_sizes), ends)
        b_last = np.searchsorted(np.cumsum(b_sizes), ends)
        home = a_of[a_last]
        counts[:, 2] = np.bincount(home, minlength=n)
        links = (a_ids[a_last] * B_IDS + b_ids[b_last]).astype(np.int32)
        text, sizes = self._text(a_ids, a_last, b_ids, b_last, home, n)
        return Aligned(counts, links, text, sizes)

    def _same(self, data, base, parts: Bytes, ids, of) -> np.ndarray:
        """For each segment whether its tokens' bytes are its own."""
        n = len(base) - 1
        got = np.bincount(of, parts.sizes[ids], n).astype(np.int64)
        same = got == np.diff(base)
        use = same[of]
        mine = gathered(data, base[:-1][same], np.diff(base)[same])
        other = mine != parts.joined(ids[use])
        if other.any():
            which = np.repeat(np.flatnonzero(same), np.diff(base)[same])
            same[which[other]] = False
        return same

    def _text(self, a_ids, a_last, b_ids, b_last, home, n) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all segments, one after the other, and each one's size."""
        a_group = np.searchsorted(a_last, np.arange(len(a_ids)))
        b_group = np.searchsorted(b_last, np.arange(len(b_ids)))
        # Of each group the tokens of A stand before those of B.
        order = np.argsort(np.append(2 * a_group, 2 * b_group + 1), kind="stable")
        ids = np.append(a_ids, b_ids)[order]
        mark = np.full(len(ids), ord(","), np.uint8)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        mark[place[a_last]] = ord("|")
        mark[place[len(a_ids) + b_last]] = ord(";")
        text, sizes = self.digits.joined(ids), self.digits.sizes[ids]
        ends = np.cumsum(sizes)
        text[ends - 1] = mark
        of = np.append(home[a_group], home[b_group])[order]
        return text, np.bincount(of, sizes, n).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, or the free one where it belongs."""
        slot = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        left = np.flatnonzero((self.key[slot] != h) & (self.key[slot] != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.key) - 1)
            key = self.key[slot[left]]
            left = left[(key != h[left]) & (key != 0)]
        return slot

    def _keep(self, h: np.ndarray, found: Aligned) -> None:
        rows = np.column_stack([found.counts, found.text_sizes])
        links, text = self.links.append(found.links), self.text.append(found.text)
        base = np.column_stack([
            links + np.cumsum(rows[:, 2]) - rows[:, 2], text + np.cumsum(rows[:, 3]) - rows[:, 3]
        ])
        self.counts.append(rows.ravel())
        self.base.append(base.ravel())
        left = np.arange(len(h))
        while len(left):
            slot = self._find(h[left])
            self.key[slot] = h[left]
            won = self.key[slot] == h[left]
            self.place[slot[won]] = self.entries + left[won]
            left = left[~won]
        self.entries += len(h)

    def places(self, raw: bytes, h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Numbers of the kept segments of a piece, in order; new ones are aligned."""
        if self.entries > len(self.key) // 4 or self.text.used + self.links.used > KEPT_BYTES:
            self.clear()
        missing = np.flatnonzero(self.key[self._find(h)] != h)
        if len(missing):
            new, where = np.unique(h[missing], return_index=True)
            where = missing[where]
            for i in range(0, len(new), ALIGNED_AT_ONCE):
                at = where[i : i + ALIGNED_AT_ONCE]
                texts = [raw[x:y].decode() for x, y in zip(first[at], last[at], strict=True)]
                self._keep(new[i : i + ALIGNED_AT_ONCE], self.align(texts))
        return self.place[self._find(h)]


def segments(
    data: np.ndarray, offsets: np.ndarray, separable: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each segment, and each text's range of segments.

    A text is cut before a space after a letter, number or mark of the known classes.
    """
    begin = np.zeros(len(data) + 1, bool)
    if separable and len(data):
        kind = tokens.byte_kinds(data)
        solid = (kind == tokens._LETTER) | (kind == tokens._NUMBER) | (kind == tokens._MARK)
        begin[1:-1] = (data[1:] == 32) & solid[:-1]
    begin[offsets[1:] - 1] = False  # B adds no space to nothing: a last space stays with its word
    begin[offsets] = True
    begin[-1] = False
    first = np.flatnonzero(begin)
    return first, np.append(first[1:], len(data)), np.searchsorted(first, offsets)


def _align(a_path: str, b_path: str, digest: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = tx.kept(f"aligner {a_path} {b_path}", lambda: Aligner(a_path, b_path))
        for batch in batches:
            for piece in tx.pieces(batch, PIECE_BYTES):
                yield one(aligner, piece)

    def one(aligner: Aligner, piece: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = tx.utf8(piece.column(1))
        first, last, of = segments(data, offsets, aligner.separable)
        h = tx.byte_hash(tx.byte_sums(data), first, last) | np.uint64(1)
        raw, parts = data.tobytes(), []
        for i in range(0, len(h), LOOKED_UP):
            some = slice(i, i + LOOKED_UP)
            place = aligner.places(raw, h[some], first[some], last[some])
            rows = aligner.counts.values.reshape(-1, 4)[place].astype(np.int64)
            base = aligner.base.values.reshape(-1, 2)[place].astype(np.int64)
            parts.append((
                rows,
                gathered(aligner.links.values, base[:, 0], rows[:, 2]),
                gathered(aligner.text.values, base[:, 1], rows[:, 3]),
            ))
        rows = np.concatenate([p[0] for p in parts]) if parts else np.zeros((0, 4), np.int64)
        links = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int32)
        text = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.uint8)
        bad = rows[:, 2] == 0
        if bad.any():
            # A text with such a segment has no tokens at all.
            gone = np.repeat(np.add.reduceat(np.append(bad, False), of[:-1]) * (np.diff(of) > 0) > 0, np.diff(of))
            links, text = links[~np.repeat(gone, rows[:, 2])], text[~np.repeat(gone, rows[:, 3])]
            rows = np.where(gone[:, None], 0, rows)
        sums = np.vstack([np.zeros((1, 4), np.int64), np.cumsum(rows, axis=0)])[of]
        per_text = np.diff(sums, axis=0)
        # Every group ends with a mark; the last one of a text has none.
        ends = sums[1:, 3][per_text[:, 3] > 0]
        kept = np.ones(len(text), bool)
        kept[ends - 1] = False
        text_ends = np.append(0, np.cumsum(per_text[:, 3] - (per_text[:, 3] > 0)))
        if digest:
            raw = text[kept].tobytes()
            ranges = zip(text_ends[:-1].tolist(), text_ends[1:].tolist(), strict=True)
            parts = (raw[x:y] for x, y in ranges)
            groups = pa.array([sha256(x).hexdigest() if x else "" for x in parts], pa.string())
        else:
            groups = tx.binary(text[kept], text_ends).cast(pa.string())
        return pa.record_batch(
            [
                piece.column(0),
                *[pa.array(np.ascontiguousarray(per_text[:, k])) for k in range(3)],
                groups,
                tx.binary(links.astype("<i4"), sums[:, 2]),
            ],
            names=[f.split()[0] for f in _ALIGNED.split(", ")],
        )

    return align


def align_tokens(
    documents: DataFrame, a_path: str | None = None, b_path: str | None = None,
    digest: bool = False,
) -> DataFrame:
    """Groups of tokens that stand for the same bytes, one row for each of ``doc_id, text``.

    Returns doc_id, n_a, n_b (tokens), n_groups, groups (``a1,a2|b1;a3|b2,b3``: decimal ids
    in order; with ``digest`` the lowercase hex sha256 of that, which takes less room) and
    links (little-endian 32-bit codes ``a * B_IDS + b`` of the tokens of A and B
    that end together, one a group). Texts without tokens have zeros, no groups and no
    links: null and empty ones, and texts whose bytes a tokenizer does not give back. The
    strings of special tokens are ordinary text. Each row is aligned alone, so repeated
    rows, ids and rows without an id are kept. An empty table gives no rows; other columns
    are not read. Nothing is shuffled.
    """
    task = _align(a_path or tokens.tokenizer_path(), b_path or tokens.tokenizer_path(PIECES), digest)
    # Null where there is no text: the space alone would be a token.
    spaced = F.when(F.col("text") != "", F.concat(F.lit(" "), F.col("text")))
    return documents.select("doc_id", spaced.alias("text")).mapInArrow(task, _ALIGNED)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, sums = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def merged(codes, sums, waiting):
        new, n = np.unique(np.concatenate(waiting), return_counts=True)
        both, inverse = np.unique(np.concatenate([codes, new]), return_inverse=True)
        return both, np.bincount(inverse, np.concatenate([sums, n]), len(both)).astype(np.int64)

    waiting, size = [], 0
    for batch in batches:
        data, _ = tx.utf8(batch.column(0))
        waiting.append(np.frombuffer(data.tobytes(), "<i4"))
        size += len(waiting[-1])
        if size >= COUNTED:
            codes, sums = merged(codes, sums, waiting)
            waiting, size = [], 0
    if waiting:
        codes, sums = merged(codes, sums, waiting)
    yield pa.record_batch([pa.array(codes), pa.array(sums)], names=["code", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a_id, b_id, n (links of the pair in all rows) and whether n is the most of its b_id.

    Each task counts its own links first. The result has at most as many rows as the
    vocabularies have bytes in their tokens, and is a table of its own. No links, no rows.
    """
    counted = aligned.select("links").mapInArrow(_count, "code int, n bigint")
    a_id, b_id = F.expr(f"code div {B_IDS}"), F.col("code") % B_IDS
    pairs = stored(
        counted.groupBy("code").agg(F.sum("n").alias("n")).select(
            a_id.cast("int").alias("a_id"), b_id.cast("int").alias("b_id"), "n"
        ),
        "pairs",
    )
    most = pairs.groupBy("b_id").agg(F.max("n").alias("most"))  # a row a token of B at most
    return pairs.join(F.broadcast(most), "b_id").select(
        "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best")
    )


def _score(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = shared.value
        for batch in batches:
            data, offsets = tx.utf8(batch.column("links"))
            ends = offsets // 4
            at = np.searchsorted(codes, np.frombuffer(data.tobytes(), "<i4"))
            sums = [np.append(0, np.cumsum(v))[ends] for v in (best[at].astype(np.int64), n[at])]
            out = batch.drop_columns(["links"])
            for name, column in zip(("n_links", "n_best", "count_sum"), (ends, *sums), strict=True):
                out = out.append_column(name, pa.array(np.diff(column)))
            yield out

    return score


def link_counts(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """``aligned`` with n_links, n_best and count_sum in place of ``links``.

    ``pairs`` is what ``pair_counts`` made of the same rows: bounded by the vocabularies, so
    it is fetched and sent to the tasks.
    """
    found = pairs.select((F.col("a_id") * B_IDS + F.col("b_id")).alias("code"), "n", "best")
    found = found.toArrow().sort_by("code")
    values = (
        found["code"].to_numpy().astype(np.int32),
        found["n"].to_numpy().astype(np.int64),
        found["best"].to_numpy(),
    )
    shared = aligned.sparkSession.sparkContext.broadcast(values)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name != "links"]
    added = ["n_links bigint", "n_best bigint", "count_sum bigint"]
    return aligned.mapInArrow(_score(shared), ", ".join(kept + added))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_tokens(table(spark, sf_dir, "documents"), digest=True)
    # Counted first, then given the counts.
    aligned = stored(aligned.withColumnRenamed("groups", "groups_sha256"), "aligned")
    return link_counts(aligned, pair_counts(aligned))
