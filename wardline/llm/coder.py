"""Adaptive context-mixing range coder for token ids.

A frame holds blocks that stand alone and carry checksums, and before them a model with a checksum of its own: how often
each id occurs (order 0), and which ids follow an id often and how often others do (order 1). Within a block an order-2
context predicts the id that followed it last; how much of the coding range that prediction gets is learned as the
block goes on, from how it did lately. Where it fails the order-1 frequencies code the id, or an escape to those of order 0.
All blocks of a call advance together, one id each at a step, so the arithmetic runs over arrays.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import zstandard

BLOCK = 2048
#: Steps between new shares of order 2, its contexts in a block, and how often ids must meet to be in the order-1 model.
_WEIGH, _SLOTS, _OFTEN = 64, 10, 3
#: Bits of the shares of order 2 and of the frequencies of order 1; cells of a table of all pairs of ids.
_SHARE, _FIRST, _TABLE = 12, 16, 1 << 24
_U = np.uint64
_FULL = _U(1 << 32)
_MAGIC = b"WTI2"
#: Counts are kept in eighths of octaves.
_COUNTS = np.array([int(16 * 2 ** (q / 8)) for q in range(256)], np.int64)


class Damaged(ValueError):
    """A block's ids do not give its checksum, or a frame is not one."""


def _shares(counts: np.ndarray, groups: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies of at least 1 that add up to ``2 ** bits`` in each group; ``groups`` are where groups begin."""
    sizes = np.diff(np.append(groups, len(counts)))
    total = np.add.reduceat(counts, groups)
    out = 1 + counts * np.repeat((1 << bits) - sizes, sizes) // np.repeat(total, sizes)
    out[groups] += (1 << bits) - np.add.reduceat(out, groups)
    return out


class _Model:
    """The frequencies of a frame. Ids are numbered in ascending order; ``n`` stands for none.

    Order 1 has entries in order of (id before, id), an id before with any entry having an escape as the first.
    """

    def __init__(self, values: np.ndarray, counts0: np.ndarray, listed: np.ndarray, lengths: np.ndarray, after: np.ndarray, counts1: np.ndarray):
        self.values, self.n = values, len(values)
        self.parts = values, counts0, listed, lengths, after, counts1
        self.bits0 = min(max(16, self.n.bit_length() + 2), 24)
        self.freq0 = _shares(_COUNTS[counts0], np.zeros(1, np.int64), self.bits0) if self.n else np.zeros(0, np.int64)
        self.cum0 = np.concatenate([[0], np.cumsum(self.freq0)])
        self.first = np.cumsum(lengths) - lengths
        self.place = np.full(self.n + 1, -1)  # of an id before among the listed ones
        self.place[listed] = np.arange(len(listed))
        self.after = after
        self.freq1 = _shares(_COUNTS[counts1], self.first, _FIRST) if len(listed) else np.zeros(0, np.int64)
        ends = np.cumsum(self.freq1)
        self.reach1 = ends - self.freq1  # a listed id's entries share 2 ** _FIRST, one id after the other
        self.start1 = self.reach1 - np.repeat(np.arange(len(listed)) << _FIRST, lengths)

    @classmethod
    def of(cls, ids: np.ndarray, block: int) -> tuple[_Model, np.ndarray]:
        """The model of some ids, and their numbers."""
        if len(ids) and int(ids.max()) < 1 << 22:
            counts = np.bincount(ids)
            values = np.flatnonzero(counts)
            numbers = (np.cumsum(counts > 0) - 1).astype(np.int32)[ids]
            counts = counts[values]
        else:
            values, numbers, counts = np.unique(ids, return_inverse=True, return_counts=True)
        n = len(values)
        if n >= 1 << 23:
            raise ValueError("a frame takes fewer than 2**23 different ids")
        before = numbers[:-1]
        inside = np.ones(len(before), bool)
        inside[block - 1 :: block] = False  # the first id of a block has none before it
        kind = np.uint32 if n < 1 << 16 else np.int64  # the shorter ones sort much faster
        pair = before[inside].astype(kind) * kind(n) + numbers[1:][inside].astype(kind)
        often, met = np.unique(pair, return_counts=True)
        often, met = often[met >= _OFTEN].astype(np.int64), met[met >= _OFTEN]
        listed, lengths = np.unique(often // n, return_counts=True) if n else (often, often)
        seldom = np.bincount(before[inside], minlength=n)[listed] - np.bincount(np.repeat(np.arange(len(listed)), lengths), met, len(listed)).astype(np.int64)
        at = np.cumsum(lengths) - lengths
        after = np.insert(often % n if n else often, at, n)
        met = np.insert(met, at, np.maximum(seldom, 1))
        def eighths(c):
            return np.round(8 * np.log2(c)).astype(np.uint8)
        return cls(values.astype(np.uint32), eighths(counts) if n else np.zeros(0, np.uint8), listed, lengths + 1, after, eighths(met)), numbers

    def packed(self) -> bytes:
        values, counts0, listed, lengths, after, counts1 = self.parts
        def planes(a):
            return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
        gaps = np.diff(after, prepend=0)
        raw = b"".join([planes(np.diff(values.astype(np.int64), prepend=0)), counts0.tobytes(), planes(np.diff(listed, prepend=0)),
                        planes(lengths), planes(gaps & 0xFFFFFFFF), counts1.tobytes()])
        return struct.pack("<III", len(values), len(listed), len(after)) + zstandard.compress(raw, 9)

    @classmethod
    def unpacked(cls, data: bytes) -> _Model:
        n, n_listed, n_after = struct.unpack_from("<III", data)
        raw, at = zstandard.decompress(data[12:]), 0

        def take(size):
            nonlocal at
            at += size
            return np.frombuffer(raw, np.uint8, size, at - size)

        def planes(size):
            return np.ascontiguousarray(take(4 * size).reshape(4, size).T).view("<u4").ravel().astype(np.int64)
        values, counts0 = np.cumsum(planes(n)), take(n)
        listed, lengths = np.cumsum(planes(n_listed)), planes(n_listed)
        gaps = planes(n_after)
        gaps[gaps >= 1 << 31] -= 1 << 32
        return cls(values.astype(np.uint32), counts0, listed, lengths, np.cumsum(gaps), take(n_after))

    def entries(self, before: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Where each id's entry after the one before it is, its escape if it has none, or -1 without a list."""
        place = self.place[before]
        if not len(self.after):
            return place
        escape = np.where(place >= 0, self.first[place], -1)
        owner = np.repeat(np.flatnonzero(self.place >= 0), self.parts[3])
        key = owner * (self.n + 1) + np.where(self.after == self.n, 0, self.after + 1)
        if (self.n + 1) * (self.n + 1) <= _TABLE:
            table = np.zeros((self.n + 1) ** 2, np.int32)
            table[key] = np.arange(1, len(key) + 1)
            found = table[before * np.int64(self.n + 1) + numbers + 1] - 1
        else:
            wanted = before * np.int64(self.n + 1) + numbers + 1
            found = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            found = np.where(key[found] == wanted, found, -1)
        return np.where(found >= 0, found, escape)


class _Recent:
    """Order 2 of all blocks, which encoder and decoder change alike."""

    def __init__(self, lanes: int, none: int):
        self.none, lane = none, np.arange(lanes, dtype=np.int64)
        self.base, self.of_share = lane << _SLOTS, lane << 2
        self.by2 = np.full(lanes << _SLOTS, none, np.int32)
        self.one, self.two = np.full(lanes, none, np.int64), np.full(lanes, none, np.int64)
        self.lately = np.zeros(lanes, np.int64)  # whether the last two predictions were right
        # Wrong and right predictions by how the last two went.
        self.counts = np.tile(np.array([[24, 8], [16, 16], [16, 16], [4, 28]], np.int64), (lanes, 1)).reshape(-1)

    def predict(self, n: int, t: int):
        """Predictions (``none`` where there is none) and the shares that they get."""
        if t % _WEIGH == 0:
            counts = self.counts.reshape(-1, 2)
            share = counts[:, 1] * (1 << _SHARE) // (counts[:, 0] + counts[:, 1])
            self.share = np.clip(share, 32, (1 << _SHARE) - 32).astype(np.uint64)
            self.counts = (counts - (counts >> 2) + 1).reshape(-1)
        self.at = self.base[:n] + (((self.one[:n] * 0x85EBCA6B + self.two[:n] * 0xC2B2AE35) >> 9) & ((1 << _SLOTS) - 1))
        found = self.by2[self.at]
        self.row = self.of_share[:n] + self.lately[:n]
        return found, self.share[self.row]

    def learn(self, n: int, numbers: np.ndarray, asked: np.ndarray, right: np.ndarray) -> None:
        """``asked``: blocks with a prediction; ``right``: whether it was, of these."""
        self.counts[2 * self.row[asked] + right] += 1
        self.lately[asked] = (self.lately[asked] << 1 & 2) + right
        self.by2[self.at] = numbers
        self.two[:n] = self.one[:n]
        self.one[:n] = numbers


def _narrow(low, span, at, start, size, bits: int) -> None:
    r = span[at] >> _U(bits)
    low[at] += r * start.astype(np.uint64)
    span[at] = r * size.astype(np.uint64)


def _shift(low, span, emit) -> None:
    """Moves a settled 32-bit word out of every block whose range became short.

    A range that still straddles two words is cut to the part below the border.
    """
    at = np.flatnonzero(span < _FULL)
    if len(at):
        l, s = low[at], span[at]
        s = np.where((l ^ (l + s)) >= _FULL, (_U(0) - l) & (_FULL - _U(1)), s)
        emit(at, (l >> _U(32)).astype(np.uint32))
        low[at], span[at] = l << _U(32), s << _U(32)


def encode(ids: np.ndarray, block: int | None = None) -> bytes:
    """One frame with all ids: the model, a table of blocks (ids, words, checksum of the ids), then their words.

    Blocks of few ids are shorter, so that there are enough of them to advance together.
    """
    ids = np.ascontiguousarray(ids, np.uint32)
    block = block or min(BLOCK, max(256, 1 << (len(ids) // 1000).bit_length()))
    blocks = -(-len(ids) // block)
    sizes = np.minimum(block, len(ids) - np.arange(blocks) * block)
    model, numbers = _Model.of(ids, block)
    before = np.concatenate([np.array([model.n], numbers.dtype), numbers[:-1]])[: len(ids)]
    before[::block] = model.n

    def by_step(values):
        table = np.zeros((blocks, block), np.int32)
        table.ravel()[: len(ids)] = values
        return np.ascontiguousarray(table.T)

    steps, entry = by_step(numbers), by_step(model.entries(before, numbers))
    room = 2 * block + 8
    out, used = np.zeros(blocks * room, np.uint32), np.arange(blocks) * room
    low, span = np.zeros(blocks, np.uint64), np.full(blocks, ~_U(0))
    recent, whole = _Recent(blocks, model.n), _U(1 << _SHARE)

    def emit(i, words):
        out[used[i]] = words
        used[i] += 1

    for t in range(int(sizes.max()) if blocks else 0):
        n = blocks if t < sizes[-1] else blocks - 1  # only the last block can be shorter
        now, e, l, s = steps[t, :n], entry[t, :n], low[:n], span[:n]
        found, share = recent.predict(n, t)
        asked = np.flatnonzero(found != model.n)
        hit = found == now
        right, p = hit[asked], share[asked]
        _narrow(l, s, asked, np.where(right, _U(0), p), np.where(right, p, whole - p), _SHARE)
        listed = np.flatnonzero(~hit & (e >= 0))
        _narrow(l, s, listed, model.start1[e[listed]], model.freq1[e[listed]], _FIRST)
        _shift(l, s, emit)
        escaped = np.flatnonzero(~hit & ((e < 0) | (model.after[e] == model.n) if len(model.after) else e < 0))
        if len(escaped):
            _narrow(l, s, escaped, model.cum0[now[escaped]], model.freq0[now[escaped]], model.bits0)
            _shift(l, s, emit)
        recent.learn(n, now, asked, right)
    for shift in (32, 0):
        out[used] = (low >> _U(shift)).astype(np.uint32)
        used = used + 1
    words = used - np.arange(blocks) * room
    head = np.zeros(blocks, np.dtype([("ids", "<u4"), ("words", "<u4"), ("crc", "<u4")]))
    head["ids"], head["words"] = sizes, words
    raw = ids.astype("<u4")
    head["crc"] = [zlib.crc32(raw[k * block : (k + 1) * block]) for k in range(blocks)]
    body = [out[k * room : k * room + words[k]].astype("<u4").tobytes() for k in range(blocks)]
    primed = model.packed()
    return _MAGIC + struct.pack("<IIII", block, blocks, len(primed), zlib.crc32(primed)) + primed + head.tobytes() + b"".join(body)


def decode(frame: bytes, only: list[int] | None = None) -> np.ndarray:
    """All ids of a frame, or those of the blocks named, one after the other; checks every checksum."""
    if frame[:4] != _MAGIC or len(frame) < 20:
        raise Damaged("not a frame of token ids")
    _, blocks, size, crc = struct.unpack_from("<IIII", frame, 4)
    primed = frame[20 : 20 + size]
    if zlib.crc32(primed) != crc or len(frame) < 20 + size + 12 * blocks:
        raise Damaged("the model does not give its checksum")
    model = _Model.unpacked(primed)
    head = np.frombuffer(frame, np.dtype([("ids", "<u4"), ("words", "<u4"), ("crc", "<u4")]), blocks, 20 + size)
    begin = 20 + size + 12 * blocks + 4 * np.concatenate([[0], np.cumsum(head["words"].astype(np.int64))])
    if begin[-1] != len(frame):
        raise Damaged("a frame is cut short")
    chosen = np.arange(blocks) if only is None else np.asarray(only)
    order = chosen[np.argsort(-head["ids"][chosen].astype(np.int64), kind="stable")]
    sizes, lanes = head["ids"][order].astype(np.int64), len(order)
    # The words of the blocks one after the other, with some zeros behind them.
    words = np.concatenate([np.frombuffer(frame, "<u4", int(head["words"][k]), int(begin[k])) for k in order] + [np.zeros(8, np.uint32)]).astype(np.uint64)
    at = np.concatenate([[0], np.cumsum(head["words"][order].astype(np.int64))])[:-1]
    code = np.zeros(lanes, np.uint64)
    for _ in range(2):
        code = code << _U(32) | words[at]
        at = at + 1
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, ~_U(0))
    steps, recent = np.zeros((int(sizes.max()) if lanes else 0, lanes), np.int32), _Recent(lanes, model.n)
    whole = _U(1 << _SHARE)

    def take(i, _):
        code[i] = code[i] << _U(32) | words[np.minimum(at[i], len(words) - 1)]
        at[i] += 1

    def point(i, bits):
        """Where in its range, of ``2 ** bits`` parts, the code of a block is."""
        return np.minimum((c[i] - l[i]) // (s[i] >> _U(bits)), _U((1 << bits) - 1)).astype(np.int64)

    for t in range(len(steps)):
        n = int(np.searchsorted(-sizes, -t, "left"))
        l, s, c = low[:n], span[:n], code[:n]
        found, share = recent.predict(n, t)
        now = found.astype(np.int64)
        asked = np.flatnonzero(found != model.n)
        p = share[asked]
        right = point(asked, _SHARE).astype(np.uint64) < p
        _narrow(l, s, asked, np.where(right, _U(0), p), np.where(right, p, whole - p), _SHARE)
        now[asked[~right]] = model.n
        open_ = now == model.n
        place = model.place[recent.one[:n]]
        listed = np.flatnonzero(open_ & (place >= 0))
        if len(listed):
            e = np.searchsorted(model.reach1, (place[listed] << _FIRST) + point(listed, _FIRST), "right") - 1
            now[listed] = model.after[e]
            _narrow(l, s, listed, model.start1[e], model.freq1[e], _FIRST)
        _shift(l, s, take)
        escaped = np.flatnonzero(now == model.n)
        if len(escaped):
            found0 = np.searchsorted(model.cum0, point(escaped, model.bits0), "right") - 1
            now[escaped] = np.minimum(found0, model.n - 1)
            _narrow(l, s, escaped, model.cum0[now[escaped]], model.freq0[now[escaped]], model.bits0)
            _shift(l, s, take)
        steps[t, :n] = now
        recent.learn(n, now, asked, right)
    table = np.ascontiguousarray(steps.T)
    rows = {int(k): model.values[table[i, : sizes[i]]].astype("<u4") for i, k in enumerate(order)}
    for k in chosen.tolist():
        if zlib.crc32(rows[k]) != head["crc"][k]:
            raise Damaged(f"block {k} does not give its checksum")
    return np.concatenate([rows[k] for k in chosen.tolist()] + [np.zeros(0, "<u4")])
