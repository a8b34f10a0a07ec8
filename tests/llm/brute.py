"""Plain answers to the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WHITE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def encode(tokenizer, text, end):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
    return np.array(ids, "<u4")


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def near_duplicates(docs, size=5):
    """doc_id, set size, component; ``docs`` are (row number, text)."""
    sets = {}
    for row, text in docs:
        w = WHITE_WORD.findall(lower(text))
        sets[row] = frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()
    root = {r: r for r in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    rows = list(sets)
    for i, a in enumerate(rows):
        for b in rows[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {r: (len(sets[r]), find(r)) for r in sets}


def covered(sequences, window):
    """A mark for each unit in a window that starts in several places."""
    counts = Counter()
    for s in sequences:
        counts.update(hash(s[i : i + window]) for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        marks = bytearray(len(s))
        for i in range(len(s) - window + 1):
            if counts[hash(s[i : i + window])] > 1:
                marks[i : i + window] = b"\1" * window
        out.append(marks)
    return out


def substring_rows(docs, window=35):
    words = [tuple(WHITE_WORD.findall(t or "")) for _, t in docs]
    rows = []
    for (doc, _), w, m in zip(docs, words, covered(words, window), strict=True):
        kept = " ".join(x for x, gone in zip(w, m, strict=True) if not gone)
        rows.append((doc, len(w), sum(m), hashlib.sha256(kept.encode()).hexdigest()))
    return rows


def suffix_rows(docs, window=400):
    texts = [(t or "").encode() for _, t in docs]
    rows = []
    for (doc, _), s, m in zip(docs, texts, covered(texts, window), strict=True):
        kept = bytes(x for x, gone in zip(s, m, strict=True) if not gone)
        runs = sum(1 for i, x in enumerate(m) if x and (not i or not m[i - 1]))
        rows.append((doc, len(s), sum(m), runs, hashlib.sha256(kept).hexdigest()))
    return rows


def contamination_rows(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM_WORD.findall(lower(text))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(item)
    sizes = {len(w) for w in windows}
    rows = []
    for doc, text in docs:
        w = ALNUM_WORD.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                got = windows.get(tuple(w[i : i + size]))
                if got:
                    hit.update(range(i, i + size))
                    found |= got
        found.discard(None)
        joined = ",".join(sorted(map(str, found)))
        digest = hashlib.sha256(joined.encode()).hexdigest()
        rows.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return rows


def exact_rows(docs):
    groups = defaultdict(list)
    for row, (doc, text) in enumerate(docs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append(row)
    out = []
    for norm, rows in groups.items():
        def rank(row):
            doc, text = docs[row]
            return (-len(text or ""), doc is None, doc or 0)

        keep = docs[min(rows, key=rank)][0]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(docs[r][0], keep, len(rows), docs[r][0] == keep, digest) for r in rows]
    return out


def same_rows(found, expected):
    """Equal as bags of rows."""
    def key(row):
        return tuple((x is None, x if x is not None else 0) for x in row)

    return sorted(map(tuple, found), key=key) == sorted(map(tuple, expected), key=key)
