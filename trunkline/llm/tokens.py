"""Token ids of whole texts by a public tokenizer, with the pieces of a text looked up.

The byte-level tokenizer splits a text into pieces (words with their space, numbers, marks,
white space) and merges inside a piece only. Pieces are found here for a whole batch at
once; each different piece is encoded once by the model of the tokenizers library, which
takes new pieces by the thousand, in the letters that stand for their bytes, and
kept by its hash in the worker. A text with characters outside the scripts whose classes are
listed here, or with the string of a special token, is encoded by the library as it is. Both
give the ids of ``encode``: a special token's string is that token, as the library has it by
default.
"""

from __future__ import annotations

import os
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from trunkline.llm import text as tx

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENIZER = "byte_bpe_50k.json"
#: Bits of the worker's piece table, and the ids it holds, before it starts afresh.
TABLE_BITS, TABLE_IDS = 21, 8_000_000
#: New pieces that go to the library in one text; what it keeps for a text grows with it.
TOGETHER = 4096
_LETTER, _NUMBER, _SPACE, _MARK, _UNKNOWN = 1, 2, 3, 4, 5


def _classes() -> np.ndarray:
    return tx.kept("classes", _make_classes)


def _make_classes() -> np.ndarray:
    """Class of every code point below 0x500; the rest is unknown."""
    out = np.full(0x800, _UNKNOWN, np.uint8)
    for code in range(0x500):
        kind = unicodedata.category(chr(code))
        out[code] = _LETTER if kind[0] == "L" else _NUMBER if kind[0] == "N" else _MARK
        if kind == "Cn":
            out[code] = _UNKNOWN
    out[list(tx.WHITE)] = _SPACE
    out[[*range(0x1C, 0x20), 0x85, 0xA0]] = _UNKNOWN  # white space in some libraries only
    return out


def _letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + i) for i, byte in enumerate(others)}


def byte_kinds(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to."""
    kinds = _classes()
    kind = kinds.take(data)  # right for ASCII
    lead = np.flatnonzero(data >= 0x80)
    if len(lead):
        b = data[lead]
        two = lead[(b >= 0xC2) & (b <= 0xDF)]
        kind[lead] = _UNKNOWN
        code = ((data[two].astype(np.int64) & 0x1F) << 6) | (data[two + 1] & 0x3F)
        kind[two] = kind[two + 1] = kinds[code]
        # General punctuation in three bytes: dashes, quotes, dots.
        three = lead[b == 0xE2]
        three = three[(data[three + 1] == 0x80) & (data[three + 2] >= 0x90) & (data[three + 2] <= 0xA7)]
        for i in range(3):
            kind[three + i] = _MARK
    return kind


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A mark for each byte that begins a piece, and for each text whether it has bytes of
    unknown class (its marks mean nothing then)."""
    n = len(data)
    kind = byte_kinds(data)
    odd = np.zeros(len(offsets) - 1, bool)
    odd[np.searchsorted(offsets, np.flatnonzero(kind == _UNKNOWN), "right") - 1] = True
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    blank = data == 32
    # After a blank a piece goes on, unless white space follows it.
    begin = change[:n].copy()
    begin[1:] &= ~(blank[:-1] & (kind[1:] != _SPACE))
    # The last character of longer white space before something else begins a piece.
    space = kind == _SPACE
    last = space & np.append(~space[1:], True) & ~border[1:]
    begin |= last
    begin |= border[:n]
    if n:
        quotes = np.flatnonzero((data == 39) & begin)
        doc_end = offsets[np.searchsorted(offsets, quotes, "right")] if len(quotes) else quotes
        for suffix in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
            end = quotes + 1 + len(suffix)
            hit = end <= doc_end
            for i, c in enumerate(suffix):
                at = np.minimum(quotes + 1 + i, n - 1)
                hit &= data[at] == c
            hit, end = quotes[hit], end[hit]
            for i in range(len(suffix)):
                begin[hit + 1 + i] = False
            begin[end[end < n]] = True
    return begin, odd


class Vocabulary:
    """A tokenizer and an open-addressing table of the ids of pieces by their hash."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in added]
        self.letters = _letters()
        # The model alone, on pieces that no letter of theirs separates.
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        words = self.pieces.get_vocab()
        self.bytes = np.zeros(max(words.values()) + 1, np.int64)
        self.bytes[list(words.values())] = [len(word) for word in words]
        self.clear()
        # Reading the file takes several times what is kept of it.
        tx.give_back()

    def clear(self) -> None:
        size = 1 << TABLE_BITS
        self.key = np.zeros(size, np.uint64)
        self.at = np.zeros(size, np.int32)
        self.n = np.zeros(size, np.int32)
        self.ids = np.zeros(1 << 20, np.uint16)
        self.used = self.entries = 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, or of the free slot where it belongs."""
        mask = len(self.key) - 1
        slot = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        key = self.key[slot]
        left = np.flatnonzero((key != h) & (key != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & mask
            key = self.key[slot[left]]
            left = left[(key != h[left]) & (key != 0)]
        return slot

    def _encoded(self, raw: bytes, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after another, and how many each has."""
        runs = [
            self._together(raw, first[i : i + TOGETHER], last[i : i + TOGETHER])
            for i in range(0, len(first), TOGETHER)
        ]
        ids, n = zip(*runs, strict=True)
        return np.concatenate(ids), np.concatenate(n)

    def _together(self, raw: bytes, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [raw[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        letters = b"".join(parts).decode("latin-1").translate(self.letters)
        ends = np.cumsum(last - first)
        apart = "\n".join(
            [letters[a:b] for a, b in zip((ends - (last - first)).tolist(), ends.tolist(), strict=True)]
        )
        (encoded,) = self.pieces.encode_batch_fast([apart], add_special_tokens=False)
        ids = np.array(encoded.ids, np.uint16)
        # A piece ends where its bytes do.
        done = np.append(0, np.cumsum(self.bytes[ids]))
        of = np.searchsorted(done, ends)
        if (done.take(of, mode="clip") == ends).all():
            return ids, np.diff(of, prepend=0)
        # The vocabulary lacks some bytes, which the library leaves out.
        each = self.pieces.encode_batch_fast(apart.split("\n"), add_special_tokens=False)
        return ids, np.fromiter(map(len, each), np.int64, len(each))

    def _insert(self, h: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        total = len(ids)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + total] = ids
        at = self.used + np.append(0, np.cumsum(n[:-1]))
        self.used += total
        self.entries += len(h)
        left = np.arange(len(h))
        while len(left):
            slot = self._find(h[left])
            self.key[slot] = h[left]
            won = self.key[slot] == h[left]
            self.at[slot[won]], self.n[slot[won]] = at[left[won]], n[left[won]]
            left = left[~won]

    def _with_special(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text whether the string of a special token stands in it."""
        found = np.zeros(len(offsets) - 1, bool)
        raw = data.tobytes()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                found[text] |= at + len(token) <= offsets[text + 1]
                at = raw.find(token, at + 1)
        return found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and each text's range of them; null counts as empty."""
        data, offsets = tx.utf8(column)
        begin, odd = split(data, offsets)
        odd |= self._with_special(data, offsets)
        first = np.flatnonzero(begin)
        last = np.append(first[1:], len(data))
        of = np.searchsorted(first, offsets)
        h = tx.byte_hash(tx.byte_sums(data), first, last) | np.uint64(1)
        if odd.any():
            # Texts encoded as a whole stand in the table under a hash of their own.
            return self._with_whole(data, offsets, odd, h, first, last, of)
        return self._gather(data, h, first, last, of)

    def _gather(self, data, h, first, last, of):
        if self.entries > len(self.key) // 2 or self.used > TABLE_IDS:
            self.clear()
        slot = self._find(h)
        missing = np.flatnonzero(self.key[slot] != h)
        if len(missing):
            new, where = np.unique(h[missing], return_index=True)
            where = missing[where]
            raw = memoryview(data)
            if self.entries + len(new) > len(self.key) * 3 // 4:
                return self._beyond(raw, h, first, last, of)
            self._insert(new, *self._encoded(raw, first[where], last[where]))
            slot = self._find(h)
        n = self.n[slot].astype(np.int64)
        ends = np.append(0, np.cumsum(n))
        ids = self.ids[np.repeat(self.at[slot] - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[of]

    def _beyond(self, raw, h, first, last, of):
        """A batch with more different pieces than the table takes: they are encoded for it alone."""
        _, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        flat, size = self._encoded(raw, first[where], last[where])
        at, n = (np.cumsum(size) - size)[inverse], size[inverse]
        ends = np.append(0, np.cumsum(n))
        return flat[np.repeat(at - ends[:-1], n) + np.arange(ends[-1])], ends[of]

    def _with_whole(self, data, offsets, odd, h, first, last, of):
        keep = np.repeat(~odd, np.diff(of))
        sizes = np.where(odd, 0, np.diff(of))
        plain, ranges = self._gather(
            data, h[keep], first[keep], last[keep], np.append(0, np.cumsum(sizes))
        )
        raw = data.tobytes()
        parts, counts = [], np.diff(ranges)
        for i in range(len(odd)):
            if odd[i]:
                text = raw[offsets[i] : offsets[i + 1]].decode()
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                parts.append(np.array(ids, np.uint16))
                counts[i] = len(ids)
            else:
                parts.append(plain[ranges[i] : ranges[i + 1]])
        return np.concatenate(parts), np.append(0, np.cumsum(counts))


def vocabulary(path: str) -> Vocabulary:
    """The worker's own vocabulary of a file, kept from task to task."""
    return tx.kept(f"vocabulary {path}", lambda: Vocabulary(path))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_end(ids: np.ndarray, ranges: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text."""
    return np.insert(ids, ranges[1:], np.uint16(end)), ranges + np.arange(len(ranges))
