"""Token ids in blocks of an adaptive context-mixing range coder.

A block starts with an empty model, so blocks are read independently. Its ids form lanes of
consecutive ids, coded in step: at step t every lane codes its t-th id under the model that
all lanes' earlier ids made. Reader and writer update the model alike after each step.

The model mixes three orders. Order 2 and order 1 each predict one id from the last two or
the last id, with a confidence; order 0 holds the frequencies of all ids. Probabilities
of the predictions follow their success at that confidence, and the weights of the orders
follow their share in the mixture. An id is coded in the interval of the order-2 prediction,
of the order-1 prediction, or in the rest, there by order 0. The coder keeps a lane's
interval in 48 bits and moves 16 bits at a time. All sums that decide an interval are of
integers or elementwise, so every machine gets the same.
"""

from __future__ import annotations

import struct
import sys
import zlib

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"TLR1"
#: Ids of a block and steps of a lane.
BLOCK_IDS, LANE_IDS = 1 << 20, 128
_HEADER = "<4sIIIIII"  # magic, ids, steps, vocabulary, bytes, crc of bytes, crc of ids
_MASK, _BOTTOM = (1 << 48) - 1, 1 << 24
_SCALE_BITS = 16
_SCALE = 1 << _SCALE_BITS
_SLOTS = 18
_LEVEL_BITS = 3
_LEVELS = 1 << _LEVEL_BITS
#: What a lane saw in a step, as one number: the confidence of order 1, that of order 2, whether
#: their predictions are equal, and whether the id is that of order 2 and of order 1.
_EQUAL, _HIT2, _HIT1 = _LEVELS * _LEVELS, 2 * _LEVELS * _LEVELS, 4 * _LEVELS * _LEVELS
_CASES = 2 * _HIT1


def _changes(level: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Change of an order's confidence by case, and all bits set where the id becomes its
    prediction: after a miss without confidence."""
    change = np.where(hit, np.minimum(level + 1, _LEVELS - 1), np.maximum(level - 1, 0)) - level
    return change.astype(np.int32), -(~hit & (level == 0)).astype(np.int32)


_ALL = np.arange(_CASES)
_CHANGES2 = _changes(_ALL >> _LEVEL_BITS & (_LEVELS - 1), _ALL & _HIT2 > 0)
_CHANGES1 = _changes(_ALL & (_LEVELS - 1), _ALL & _HIT1 > 0)


class Model:
    """Predictions, confidences, frequencies and weights of one block."""

    def __init__(self, vocabulary: int) -> None:
        # An order's prediction and, in the lowest bits, its confidence.
        self.first = np.zeros(vocabulary, np.int32)
        self.second = np.zeros(1 << _SLOTS, np.int32)
        self.counts = np.ones(vocabulary, np.int32)
        self.ends = np.empty(vocabulary, np.int32)
        # Successes and trials of each order by confidence, order 2 first.
        self.right = np.tile(np.arange(1, _LEVELS + 1, dtype=np.int64), (2, 1))
        self.tried = np.full((2, _LEVELS), _LEVELS + 2, np.int64)
        # Share of order 2 against order 1, by both confidences, in 1/1024.
        self.share = np.full((_LEVELS * _LEVELS, 2), 1024, np.int64)

    def widths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Widths out of 2**16 of the prediction of order 2 and of both, by both confidences,
        then of equal predictions; start and width of an id's part by case."""
        rates = self.right * (_SCALE - 2048) // self.tried
        p2, p1 = rates[0][:, None], rates[1]
        share = self.share.reshape(_LEVELS, _LEVELS, 2)
        weight = share[:, :, 0] * 1024 // (share[:, :, 0] + share[:, :, 1])
        start, width = np.zeros((2, 4, 2, _LEVELS, _LEVELS), np.int64)
        width[1, 0] = p2 * weight // 1024 + 1
        width[1, 1] = np.maximum(p2, p1) + 1
        width[2, 0] = p1 * (1024 - weight) // 1024 + 1
        width[3] = start[2] = width[1]
        start[0] = width[1] + width[2]
        width[0] = _SCALE - start[0]
        return width[1].ravel(), start[0].ravel(), start.ravel(), width.ravel()

    def predict(self, before: np.ndarray, last: np.ndarray):
        """Both predictions, the lanes' cases without hits, and what the update needs."""
        # Bits 5 to 22 of the sum, so 32 bits of it do.
        slot = before.view(np.uint32) * 40503
        slot += last.view(np.uint32) * 2654435761
        slot = (slot >> 5 & ((1 << _SLOTS) - 1)).astype(np.intp)
        last = last.astype(np.intp)
        packed2, packed1 = self.second.take(slot), self.first.take(last)
        two, one = packed2 >> _LEVEL_BITS, packed1 >> _LEVEL_BITS
        case = ((packed2 & (_LEVELS - 1)) << _LEVEL_BITS) + (packed1 & (_LEVELS - 1))
        case += (two == one).astype(np.int32) * _EQUAL
        return two, one, case, (slot, packed2, last, packed1)

    def update(self, ids: np.ndarray, case: np.ndarray, context) -> None:
        """``case`` tells the orders' hits too."""
        slot, packed2, last, packed1 = context
        # Lanes by hit of order 1, hit of order 2, equal predictions and both confidences.
        seen = np.bincount(case, minlength=_CASES).reshape(2, 2, 2, _LEVELS, _LEVELS)
        self.tried[0] += seen.sum(axis=(0, 1, 2, 4))
        self.tried[1] += seen.sum(axis=(0, 1, 2, 3))
        self.right[0] += seen[:, 1].sum(axis=(0, 1, 3))
        self.right[1] += seen[1].sum(axis=(0, 1, 2))
        self.share[:, 0] += 16 * seen[:, 1, 0].sum(axis=0).ravel()
        self.share[:, 1] += 16 * seen[1, :, 0].sum(axis=0).ravel()
        known = ids << _LEVEL_BITS
        for table, at, packed, (change, fresh) in (
            (self.second, slot, packed2, _CHANGES2),
            (self.first, last, packed1, _CHANGES1),
        ):
            packed += change.take(case)
            fresh = fresh.take(case)
            packed &= ~fresh
            packed |= known & fresh
            # Lanes that write to one place: the last of them counts, in both directions.
            table[at] = packed
        np.add.at(self.counts, ids.astype(np.intp), np.int32(15))

    def sums(self) -> np.ndarray:
        """The frequencies of all ids up to each, valid until the next step."""
        return np.cumsum(self.counts, out=self.ends)


class _Lanes:
    """The intervals of all lanes."""

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, _MASK, np.int64)

    def narrow(self, lanes: np.ndarray | slice, step, start, width):
        """Takes the part of each lane's interval from ``start``, in steps. Gives the lanes that
        move 16 bits, again and again until all intervals are wide enough."""
        low, size = self.low[lanes] + step * start, step * width
        self.low[lanes], self.range[lanes] = low, size
        while len(low):
            together = (low ^ (low + size - 1)) < 1 << 32
            ready = np.flatnonzero(together | (size < _BOTTOM))
            if not len(ready):
                return
            lanes = ready if isinstance(lanes, slice) else lanes[ready]
            low, size, together = low[ready], size[ready], together[ready]
            small = np.flatnonzero(~together)
            size[small] = _BOTTOM - (low[small] & (_BOTTOM - 1))
            # An interval cut short lies in one cell of 2**24, so its top 16 bits agree.
            yield lanes, low
            low, size = (low << 16) & _MASK, size << 16
            self.low[lanes], self.range[lanes] = low, size


def _shape(n: int) -> tuple[int, int]:
    steps = min(LANE_IDS, max(1, n // 64))
    return -(-n // steps), steps


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """One block of at most ``BLOCK_IDS`` ids below ``vocabulary``."""
    n = len(ids)
    lanes, steps = _shape(n)
    grid = np.zeros((lanes, steps), np.int32)
    grid.reshape(-1)[:n] = ids
    columns = np.ascontiguousarray(grid.T)
    model, state = Model(vocabulary), _Lanes(lanes)
    before, last = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    # The words of a lane stand below each other.
    out = np.zeros((steps + 16) * lanes, np.uint16)
    at = np.arange(lanes)

    def narrow(which: np.ndarray | slice, step, start, width) -> None:
        for ready, low in state.narrow(which, step, start, width):
            place = at[ready]
            out[place] = (low >> 32).astype(np.uint16)
            at[ready] = place + lanes

    for t in range(steps):
        # An interval moves three times at most when narrowed, and has three words at the end.
        if at.max(initial=0) + 9 * lanes > len(out):
            out = np.concatenate([out, np.zeros_like(out)])
        # All lanes, or all but the last one, which may be shorter.
        active = slice(lanes if (lanes - 1) * steps + t < n else lanes - 1)
        x, b, a = columns[t][active], before[active], last[active]
        two, one, case, context = model.predict(b, a)
        _, _, start, width = model.widths()
        case += (x == two).astype(np.int32) * _HIT2
        case += (x == one).astype(np.int32) * _HIT1
        case = case.astype(np.intp)
        narrow(active, state.range[active] >> _SCALE_BITS, start.take(case), width.take(case))
        other = np.flatnonzero(case < _HIT2)
        if len(other):
            ends = model.sums()
            y = x[other].astype(np.intp)
            counts = model.counts.take(y)
            narrow(other, state.range[other] // int(ends[-1]), ends.take(y) - counts, counts)
        model.update(x, case, context)
        before, last = last, columns[t]
    for shift in (32, 16, 0):
        out[at] = (state.low >> shift) & 0xFFFF
        at += lanes
    at //= max(lanes, 1)
    out = np.ascontiguousarray(out.reshape(-1, max(lanes, 1))[:, :lanes].T)
    used = np.arange(out.shape[1]) < at[:, None]
    body = at.astype("<u2").tobytes() + out[used].astype("<u2").tobytes()
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    return struct.pack(_HEADER, MAGIC, n, steps, vocabulary, len(body), zlib.crc32(body), crc) + body


def _found(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The id whose counts hold each value; values in order are found much faster."""
    order = np.sort((values << 32) | np.arange(len(values)))
    out = np.empty(len(values), np.intp)
    out[order & 0xFFFFFFFF] = np.searchsorted(ends, (order >> 32).astype(ends.dtype), "right")
    return out


def decode_block(data: memoryview) -> tuple[np.ndarray, int]:
    """The ids of the block at the start of ``data``, and the bytes it takes."""
    magic, n, steps, vocabulary, size, body_crc, ids_crc = struct.unpack_from(_HEADER, data)
    body = data[struct.calcsize(_HEADER) : struct.calcsize(_HEADER) + size]
    if magic != MAGIC or zlib.crc32(body) != body_crc:
        raise ValueError("damaged block of token ids")
    lanes = -(-n // steps)
    words = np.frombuffer(body, "<u2", lanes).astype(np.int64)
    stream = np.frombuffer(body, "<u2", offset=2 * lanes)
    at = np.cumsum(words) - words
    code = np.zeros(lanes, np.int64)
    for _ in range(3):
        code = (code << 16) | stream[at]
        at += 1
    model, state = Model(vocabulary), _Lanes(lanes)
    before, last = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    columns = np.zeros((steps, lanes), np.int32)

    def narrow(which: np.ndarray | slice, step, start, width) -> None:
        for ready, _ in state.narrow(which, step, start, width):
            place = at[ready]
            code[ready] = ((code[ready] << 16) & _MASK) | stream.take(place)
            at[ready] = place + 1

    for t in range(steps):
        active = slice(lanes if (lanes - 1) * steps + t < n else lanes - 1)
        b, a = before[active], last[active]
        two, one, case, context = model.predict(b, a)
        width2, both, start, width = model.widths()
        step = state.range[active] >> _SCALE_BITS
        inside = code[active] - state.low[active]
        in2, known = inside < step * width2.take(case), inside < step * both.take(case)
        x = columns[t][active]
        x[:] = np.where(in2, two, one)
        # The id of order 2 is that of order 1 too if they predict the same.
        hit1 = known & (~in2 | (two == one))
        case += in2.astype(np.int32) * _HIT2
        case += hit1.astype(np.int32) * _HIT1
        case = case.astype(np.intp)
        narrow(active, step, start.take(case), width.take(case))
        other = np.flatnonzero(~known)
        if len(other):
            ends = model.sums()
            total = int(ends[-1])
            step = state.range[other] // total
            # Below 2**48 the quotient of floats has the right whole part.
            value = ((code[other] - state.low[other]) / step).astype(np.int64)
            y = _found(ends, np.minimum(value, total - 1))
            counts = model.counts.take(y)
            narrow(other, step, ends.take(y) - counts, counts)
            x[other] = y
        model.update(x, case, context)
        before, last = last, columns[t]
    grid = np.ascontiguousarray(columns.T)
    ids = grid.reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("ids differ from those written")
    return ids.astype(np.int64), struct.calcsize(_HEADER) + size


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    """Blocks of any number of ids, one after another."""
    return b"".join(
        encode_block(ids[i : i + BLOCK_IDS], vocabulary) for i in range(0, len(ids), BLOCK_IDS)
    )


def decode(data: bytes) -> np.ndarray:
    view, parts = memoryview(data), []
    while len(view):
        ids, size = decode_block(view)
        parts.append(ids)
        view = view[size:]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)
