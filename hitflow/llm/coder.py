"""Context-mixing range coder for token ids.

A stream of ids is cut into blocks. Each block starts with an empty model, so any block decodes alone. All
blocks of a segment are coded in lockstep, one numpy lane per block, which is what makes an adaptive coder fast
enough here.

Model. Order 2 and order 1 each predict the id that last followed the same context in the block (slots found by a
hash of the context, with a confidence from 0 to 7). Both are mixed: an id is coded as "what order 2 says", "what order
1 says" or an escape, with probabilities that depend on both confidences and on whether both say the same. An escaped
id is coded by order 0, by its frequency among the escaped ids that follow an id of the same class; classes are found by
what follows their ids. Probabilities, classes and frequencies are fitted to the whole segment and stated in its
header, so blocks stay short and independent without learning them anew. Classes are fitted on evenly spread places
of a long segment; everything else counts every id. All arithmetic of the decoder is in integers, so decoding is exact
anywhere.

The range coder carries: 64-bit low, at least 32 bits of range, 32-bit output. The two choices of an id are one step.
"""

from __future__ import annotations

import struct
import zlib
from math import isqrt

import numpy as np

BLOCK = 2048
IDS = 1 << 16
SLOTS = 512
MAGIC = b"HFTK"
VERSION = 3

_HEAD = struct.Struct("<4sHHIIII")  # magic, version, classes, block, blocks, bytes of the fit, their crc
_ENTRY = np.dtype([("ids", "<u4"), ("units", "<u4"), ("payload_crc", "<u4"), ("ids_crc", "<u4")])

_FLOOR = np.uint64(1 << 32)
_U32 = np.uint64(32)
_MIX_BITS, _PRIOR_BITS = 12, 17
_MIX, _PRIOR = 1 << _MIX_BITS, 1 << _PRIOR_BITS
_TOTAL_BITS = np.uint64(_MIX_BITS + _PRIOR_BITS)
_LAST = np.uint64((1 << _MIX_BITS + _PRIOR_BITS) - 1)
_STEPS = 64  # that are prepared at once
_CLASSES, _FITTED, _ROUNDS = 8, 1 << 17, 6
_CONTEXTS = 128  # both confidences, and whether both orders say the same
# Counts are stored as eighths of their logarithm: 2^(q/8), rounded down by exact eighth roots.
_LEVELS = np.array([0] + [isqrt(isqrt(isqrt(1 << (q + 64)))) for q in range(255)], np.int64)
_NOTHING = 0xFFFF << 3  # a slot that predicts no id in use, without confidence
# By confidence, and 8 more where the slot was right. Right: one up. Wrong: halved, and replaced once it was one or none.
_CHANGE = np.array([(c >> 1) - c for c in range(8)] + [min(c + 1, 7) - c for c in range(8)], np.int32)
_REPLACED = np.arange(16) < 2


class _Model:
    """Predictions of all lanes; row 0 of each array is order 1, row 1 order 2."""

    def __init__(self, lanes: int):
        self.table = np.full(2 * lanes * SLOTS, _NOTHING, np.int32)
        self.base = (np.arange(2 * lanes, dtype=np.int64) * SLOTS).reshape(2, lanes)
        self.at = self.base.copy()
        self.before = np.zeros(lanes, np.int64)

    def predict(self) -> np.ndarray:
        """The context of the mixture in each lane."""
        self.slots = self.table.take(self.at)
        self.trust = self.slots & 7
        self.guesses = self.slots >> 3
        same = self.guesses[0] == self.guesses[1]
        return (self.trust[0] << 3) + self.trust[1] + (same.view(np.int8).astype(np.int32) << 6)

    def learn(self, ids: np.ndarray) -> np.ndarray:
        """Take in the ids; where each order was right."""
        right = self.guesses == ids
        self.trust += right.view(np.int8) << 3
        self.slots += _CHANGE.take(self.trust)
        self.table[self.at] = np.where(_REPLACED.take(self.trust), (ids << 3) + 1, self.slots)
        hashed = ids * np.int64(40503)
        # The context of order 2 adds the hash that the id before the last had.
        self.before *= 3
        self.before += hashed
        np.right_shift(hashed, 4, out=self.at[0])
        np.right_shift(self.before, 5, out=self.at[1])
        self.at &= SLOTS - 1
        self.at += self.base
        self.before = hashed
        return right


def _classes(before: np.ndarray, ids: np.ndarray, number: int) -> np.ndarray:
    """A class for each id, such that ids of a class are followed by similar ids: k-means by likelihood."""
    classes = np.zeros(IDS, np.uint8)
    if number == 1 or not len(ids):
        return classes
    stride = -(-len(ids) // _FITTED)
    known, p = np.unique(before[::stride], return_inverse=True)
    seen, q = np.unique(ids[::stride], return_inverse=True)
    own = np.random.default_rng(0).integers(0, number, len(known))
    for _ in range(_ROUNDS):
        counts = np.bincount(own[p] * len(seen) + q, minlength=number * len(seen)).reshape(number, -1) + 0.02
        gain = np.log2(counts / counts.sum(axis=1, keepdims=True))
        own = np.array([np.bincount(p, gain[k].take(q), len(known)) for k in range(number)]).argmax(axis=0)
    classes[known] = own
    return classes


class _Fit:
    """What the header of a segment states: mixture, classes of ids, frequencies of escaped ids by class."""

    def __init__(self, stored: bytes, number: int):
        data = zlib.decompress(stored)
        if len(data) != 4 * _CONTEXTS + IDS + number * IDS:
            raise ValueError("frequencies of a segment are damaged")
        mix = np.frombuffer(data, "<u2", 2 * _CONTEXTS).reshape(2, _CONTEXTS).astype(np.int64)
        #: Of each context, where "what order 2 says" ends, where both predictions end, and what is left to escapes.
        self.p2, self.both = (mix << _PRIOR_BITS).astype(np.int32)
        self.left = (_MIX - mix[1]).astype(np.int32)
        self.classes = np.frombuffer(data, np.uint8, IDS, 4 * _CONTEXTS)
        weights = _LEVELS.take(np.frombuffer(data, np.uint8, number * IDS, 4 * _CONTEXTS + IDS).reshape(number, IDS))
        present = weights > 0
        spare = _PRIOR - present.sum(axis=1, keepdims=True)
        widths = present + weights * spare // np.maximum(weights.sum(axis=1, keepdims=True), 1)
        # What rounding leaves falls to the most frequent id.
        widths[np.arange(number), widths.argmax(axis=1)] += _PRIOR - widths.sum(axis=1)
        #: The ids that occur after an id of a class, class by class, with their starts and widths.
        self.keys = np.flatnonzero(widths)
        self.ids = (self.keys & (IDS - 1)).astype(np.int32)
        self.width = widths.ravel().take(self.keys).astype(np.int32)
        self.start = (np.cumsum(widths, axis=1) - widths).ravel().take(self.keys).astype(np.int32)

    @staticmethod
    def stored(mix: np.ndarray, before: np.ndarray, ids: np.ndarray, number: int) -> bytes:
        """``mix`` counts what was right in each context: order 2, order 1 alone, none. The others are escaped ids."""
        # Each outcome keeps a probability above zero; order 1 is not right alone where both say the same.
        counts = mix.astype(np.int64) * 64 + 1
        counts[_CONTEXTS // 2 :, 1] = 0
        ends = np.cumsum(counts, axis=1) * (_MIX - 3) // counts.sum(axis=1, keepdims=True)
        p2 = ends[:, 0] + 1
        both = np.where(counts[:, 1] > 0, ends[:, 1] + 2, p2)
        classes = _classes(before, ids, number)
        found = np.zeros(number * IDS, np.int64)
        for start in range(0, len(ids), 1 << 19):
            part = slice(start, start + (1 << 19))
            found += np.bincount(classes.take(before[part]) * np.int64(IDS) + ids[part], minlength=number * IDS)
        levels = np.searchsorted(_LEVELS, found << 8, side="right").astype(np.uint8) - 1
        return zlib.compress(np.array([p2, both], "<u2").tobytes() + classes.tobytes() + levels.tobytes(), 6)

    def lookup(self) -> np.ndarray:
        """The place in ``keys`` of each unit of the frequencies, class by class."""
        return np.repeat(np.arange(len(self.keys), dtype=np.uint16 if len(self.keys) <= IDS else np.int32), self.width)


def _lengths(count: int) -> list[int]:
    return [BLOCK] * (count // BLOCK) + ([count % BLOCK] if count % BLOCK else [])


def encode(ids: np.ndarray) -> bytes:
    """A segment: header, one entry per block, payloads. ``ids`` are below 65535."""
    if len(ids) and (int(ids.max()) >= IDS - 1 or int(ids.min()) < 0):
        raise ValueError("ids must lie between 0 and 65534")
    lengths = _lengths(len(ids))
    lanes, steps = len(lengths), max(lengths, default=0)
    number = min(_CLASSES, max(1, len(ids) >> 16))
    padded = np.zeros(lanes * BLOCK, np.uint16)
    padded[: len(ids)] = ids
    # A row is a step of all lanes.
    grid = np.ascontiguousarray(padded.reshape(lanes, BLOCK).T[:steps])
    # The last lane may be shorter; a step beyond its end is outcome 3, which has a width of everything.
    unused = np.zeros((steps, lanes), bool)
    if lanes:
        unused[lengths[-1] :, -1] = True

    context, outcome = np.empty((steps, lanes), np.uint8), np.empty((steps, lanes), np.uint8)
    model = _Model(lanes)
    for step in range(steps):
        context[step] = model.predict()
        right = model.learn(grid[step].astype(np.int32))
        outcome[step] = np.where(right[1], 0, 2 - right[0].view(np.int8))
    last = np.zeros_like(grid)
    last[1:] = grid[:-1]
    context[unused], outcome[unused] = 0, 3
    escaped = outcome == 2
    mix = np.zeros(4 * _CONTEXTS, np.int64)
    for since in range(0, steps, _STEPS):
        part = slice(since, since + _STEPS)
        mix += np.bincount((context[part].astype(np.int64) * 4 + outcome[part]).ravel(), minlength=4 * _CONTEXTS)
    stored = _Fit.stored(mix.reshape(_CONTEXTS, 4)[:, :3], last[escaped], grid[escaped], number)
    fit = _Fit(stored, number)
    # Starts and widths of every outcome of the mixture. Those of an escape are multiplied by those of its id; the last
    # entry, for all others, changes nothing.
    nothing = np.zeros(_CONTEXTS, np.int64)
    starts = np.stack([nothing, fit.p2, fit.both, nothing], axis=1).ravel()
    widths = np.stack([fit.p2, fit.both - fit.p2, fit.left, nothing + (1 << int(_TOTAL_BITS))], axis=1).ravel()
    own_start, own_width = np.zeros(number * IDS + 1, np.int32), np.ones(number * IDS + 1, np.int32)
    own_start[fit.keys], own_width[fit.keys] = fit.start, fit.width
    first_key = np.arange(number, dtype=np.int64) * IDS
    first_key = first_key.take(fit.classes)

    # Each step sends at most one unit; two end a lane.
    sent, units = np.zeros((steps + 2, lanes), bool), np.empty((steps + 2, lanes), np.uint32)
    carried = np.zeros((steps, lanes), bool)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    for since in range(0, steps, _STEPS):
        part = slice(since, since + _STEPS)
        cell = context[part].astype(np.int64) * 4 + outcome[part]
        start, width = starts.take(cell), widths.take(cell)
        key = np.where(escaped[part], first_key.take(last[part]) + grid[part], number * IDS)
        start += own_start.take(key) * width
        width *= own_width.take(key)
        start, width = start.view(np.uint64), width.view(np.uint64)
        for step in range(since, min(since + _STEPS, steps)):
            span >>= _TOTAL_BITS
            moved = low + span * start[step - since]
            np.less(moved, low, out=carried[step])
            span *= width[step - since]
            low = moved
            np.less(span, _FLOOR, out=sent[step])
            units[step] = low >> _U32
            shift = sent[step].astype(np.uint64) << np.uint64(5)
            low <<= shift
            span <<= shift
    sent[steps:] = True
    units[steps], units[steps + 1] = low >> _U32, low & (_FLOOR - np.uint64(1))
    # Lane by lane from here.
    sent = np.ascontiguousarray(sent.T)
    used = sent.sum(axis=1)
    payload = units.T[sent].astype("<u4")
    # A carry adds one to the last unit that its lane had sent, and goes on where that one was full.
    lane, step = np.nonzero(np.ascontiguousarray(carried.T))
    at = lane * (steps + 2) + step
    place = np.cumsum(sent, dtype=np.int32).take(at) - sent.ravel().take(at) - 1
    while len(place):
        payload[place] += np.uint32(1)
        place = place[payload[place] == 0] - 1
    entries = np.zeros(lanes, _ENTRY)
    at = 0
    for lane, length in enumerate(lengths):
        own = padded[lane * BLOCK :][:length].astype("<u4")
        entries[lane] = (length, used[lane], zlib.crc32(payload[at : at + used[lane]]), zlib.crc32(own))
        at += used[lane]
    head = _HEAD.pack(MAGIC, VERSION, number, BLOCK, lanes, len(stored), zlib.crc32(stored))
    return head + stored + entries.tobytes() + payload.tobytes()


def blocks(data: bytes) -> tuple[_Fit, np.ndarray, np.ndarray]:
    """The fit of a segment, entries of its blocks and its payload units, after the checks that need no decoding."""
    if len(data) < _HEAD.size:
        raise ValueError("segment is cut off")
    magic, version, number, block, lanes, size, crc = _HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION or block != BLOCK:
        raise ValueError("not a segment of this format")
    start = _HEAD.size + size
    at = start + lanes * _ENTRY.itemsize
    if len(data) < at:
        raise ValueError("segment is cut off")
    stored = data[_HEAD.size : start]
    if zlib.crc32(stored) != crc:
        raise ValueError("frequencies of a segment are damaged")
    entries = np.frombuffer(data, _ENTRY, lanes, start)
    if len(data) != at + 4 * int(entries["units"].sum()):
        raise ValueError("segment is cut off")
    units = np.frombuffer(data, "<u4", int(entries["units"].sum()), at)
    for entry in entries:
        end = at + 4 * int(entry["units"])
        if zlib.crc32(data[at:end]) != int(entry["payload_crc"]):
            raise ValueError("payload of a block is damaged")
        at = end
    return _Fit(stored, number), entries, units


def decode(data: bytes, only: slice = slice(None)) -> np.ndarray:
    """The ids of a segment, or of a slice of its blocks, as unsigned 32-bit numbers."""
    fit, entries, units = blocks(data)
    ends = np.cumsum(entries["units"], dtype=np.int64)
    place = (ends - entries["units"])[only]
    entries = entries[only]
    lengths = entries["ids"].astype(np.int64)
    lanes = len(entries)
    if not lanes:
        return np.empty(0, np.uint32)
    steps = int(lengths.max())
    grid = np.empty((steps, lanes), np.uint16)
    # A lane that has ended goes on with what comes, which is left out in the end.
    end = len(units)
    units = np.concatenate([units, np.zeros(1, np.uint32)]).astype(np.uint64)
    span = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    code = units[place] << _U32 | units[place + 1]
    place = place + 2
    lookup, model = fit.lookup(), _Model(lanes)
    first_unit = fit.classes.astype(np.int32) << _PRIOR_BITS
    ids = np.zeros(lanes, np.int32)
    for step in range(steps):
        context = model.predict()
        span >>= _TOTAL_BITS
        value = np.minimum(code // span, _LAST).astype(np.int32)
        p2, both, left = fit.p2.take(context), fit.both.take(context), fit.left.take(context)
        by2, escaped = value < p2, value >= both
        # As if every id had escaped, at the first unit of its class if it has not.
        unit = np.maximum(value - both, 0).view(np.uint32) // left.view(np.uint32)
        own = lookup.take(first_unit.take(ids) + unit.view(np.int32))
        start = np.where(escaped, both + fit.start.take(own) * left, np.where(by2, 0, p2))
        width = np.where(escaped, fit.width.take(own) * left, np.where(by2, p2, both - p2))
        ids = np.where(escaped, fit.ids.take(own), np.where(by2, model.guesses[1], model.guesses[0]))
        grid[step] = ids
        code -= span * start.astype(np.uint64)
        span *= width.astype(np.uint64)
        short = np.flatnonzero(span < _FLOOR)
        at = place[short]
        code[short] = code[short] << _U32 | units[np.minimum(at, end)]
        span[short] <<= _U32
        place[short] = at + 1
        model.learn(ids)
    parts = []
    for own, length, crc in zip(grid.T, lengths, entries["ids_crc"]):
        own = own[:length].astype("<u4")
        if zlib.crc32(own) != int(crc):
            raise ValueError("ids of a block are damaged")
        parts.append(own)
    return np.concatenate(parts).astype(np.uint32)
