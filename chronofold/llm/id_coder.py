"""Adaptive coder for token ids: predictions of order 0 to 2 are mixed and drive an arithmetic coder.

Ids are cut into blocks that are coded on their own: each begins with empty models and ends with nothing carried
over, and has a checksum of its ids. An id is sixteen binary decisions, from its highest bit on. For each of them the models
of order 0 (the id's bits so far), order 1 (and the id before) and order 2 (and the two ids before) have a learned chance. The
three are mixed in the logistic domain with weights that each block learns, a set for each bit; the mixed chance codes
the bit, and the bit corrects the weights and the three chances.

All blocks of a call are coded side by side, a bit of every block at a time, so that numpy works on long
arrays. All sums are on integers, so any machine decodes what another has coded. The coder is a carryless range
coder on 64 bits that writes 16 bits at a time.

Executors code with ``id_coder.java``, which gives the same bytes many times faster: a change here belongs there too.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
LANES = 1024
ID_BITS = 16
MOST_ID = (1 << ID_BITS) - 1
ORDERS = 3
# Slots of a block for each order, by a hash of the context and the bits so far.
SLOT_BITS = (12, 13, 13)
U = np.uint64
TOP, BOTTOM = U(1 << 48), U(1 << 32)
SHIFT16, TOP_BITS = U(16), U(48)
# Mixed chances are out of 4096; learned ones out of 65536, with a count of up to 15 below.
ONE_BITS = 12
ONE = 1 << ONE_BITS
COUNT_BITS, MOST_COUNT = 4, 15
# Logits in 256ths, up to 8.
LOGIT_ONE, LOGIT_MOST = 256, 2047
# Weights have 14 bits behind the point and stay below 8, so that no sum leaves 32 bits.
WEIGHT_BITS = 14
WEIGHT_ONE, WEIGHT_MOST = 1 << WEIGHT_BITS, (1 << 17) - 1
RATE = 10


def _stretch() -> np.ndarray:
    """Logits of the chances (k + 1/2) / 4096."""
    p = (np.arange(ONE) + 0.5) / ONE
    return np.clip(np.rint(LOGIT_ONE * np.log(p / (1 - p))), -LOGIT_MOST, LOGIT_MOST).astype(np.int32)


def _squash() -> np.ndarray:
    """Chances of the logits from -2047 on; none is 0 or 1."""
    x = np.arange(-LOGIT_MOST, LOGIT_MOST + 1) / LOGIT_ONE
    return np.clip(np.rint(ONE / (1 + np.exp(-x))), 1, ONE - 1).astype(np.int32)


STRETCH, SQUASH = _stretch(), _squash()
MOST_CHANCE = (1 << 16) - 1
# A chance moves by its error over its count and a half, in 16384ths.
STEPS = np.array([(1 << 14) * 2 // (2 * n + 3) for n in range(MOST_COUNT + 1)], np.int32)


class Mixer:
    """What the blocks have learned so far: chances by order, and the weights that mix them.

    Arrays have a row for each order and a column for each block.
    """

    def __init__(self, lanes: int) -> None:
        slots = [lanes << bits for bits in SLOT_BITS]
        self.chances = np.full(sum(slots), 1 << (15 + COUNT_BITS), np.int32)
        begins = np.cumsum([0, *slots[:-1]])
        self.first = np.stack([b + (np.arange(lanes) << bits) for b, bits in zip(begins, SLOT_BITS)]).astype(np.int32)
        self.shift = np.array([[32 - bits] for bits in SLOT_BITS], np.uint32)
        self.weights = np.full((ID_BITS, ORDERS, lanes), WEIGHT_ONE * 2 // 5, np.int32)
        self.last = np.zeros(lanes, np.int32)
        self.before = np.zeros(lanes, np.int32)

    def begin(self, n: int) -> None:
        """Of the next id of the first ``n`` blocks."""
        one = self.last[:n].astype(np.uint32) * np.uint32(0x9E3779B1)
        two = (one ^ (self.before[:n].astype(np.uint32) + np.uint32(1))) * np.uint32(0x85EBCA6B)
        self.hashes = np.stack([np.zeros(n, np.uint32), one, two ^ (two >> np.uint32(15))])
        self.lanes = self.first[:, :n]

    def chance(self, n: int, bit: int, node: np.ndarray) -> np.ndarray:
        """The mixed chance, out of 4096, that the next bit is set; ``node`` has the bits so far after a one."""
        mixed = (self.hashes + node.view(np.uint32) * np.uint32(0x2C1B3C6D)) * np.uint32(0x9E3779B1)
        slot = (mixed >> self.shift).view(np.int32)
        if bit < SLOT_BITS[0]:
            slot[0] = node  # the first twelve bits have an order 0 of their own
        self.at = self.lanes + slot
        self.found = self.chances.take(self.at)
        self.logits = STRETCH.take(self.found >> (16 + COUNT_BITS - ONE_BITS))
        self.used = self.weights[bit, :, :n]
        parts = self.logits * self.used
        dot = (parts[0] + parts[1] + parts[2]) >> WEIGHT_BITS
        self.mixed = SQUASH.take(dot + LOGIT_MOST, mode="clip")
        return self.mixed

    def learn(self, n: int, bit: int, value: np.ndarray) -> None:
        """Take in the bits: weights by what each logit would have helped, chances by their errors."""
        error = ((value << ONE_BITS) - self.mixed) * RATE
        # logits and errors have 8 and 12 bits behind the point
        moved = self.used + ((self.logits * error + (1 << 11)) >> 12)
        self.weights[bit, :, :n] = np.minimum(np.maximum(moved, -WEIGHT_MOST), WEIGHT_MOST)
        chance = self.found >> COUNT_BITS
        chance += (value * MOST_CHANCE - chance) * STEPS.take(self.found & MOST_COUNT) >> 14
        self.chances[self.at] = (chance << COUNT_BITS) | np.minimum((self.found & MOST_COUNT) + 1, MOST_COUNT)

    def end(self, n: int, ids: np.ndarray) -> None:
        self.before[:n] = self.last[:n]
        self.last[:n] = ids + 1


def settle(low: np.ndarray, range_: np.ndarray, emit) -> None:
    """Shift settled units out of intervals, in place, until all are wide enough.

    An interval that has become narrow across a boundary is cut at it, so nothing is carried.
    ``emit`` is told which intervals shift, before they do.
    """
    move = np.flatnonzero(((low ^ (low + range_)) < TOP) | (range_ < BOTTOM))
    while len(move):
        lo, ra = low[move], range_[move]
        cut = (lo ^ (lo + ra)) >= TOP
        if cut.any():
            ra[cut] = (~lo[cut] + U(1)) & (BOTTOM - U(1))
        emit(move, lo)
        lo <<= SHIFT16
        ra <<= SHIFT16
        low[move], range_[move] = lo, ra
        move = move[((lo ^ (lo + ra)) < TOP) | (ra < BOTTOM)]


class Coder:
    """Range coders of many blocks. A set bit takes the lower part of an interval."""

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, U)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, U)

    def narrow(self, n: int, value: np.ndarray, chance: np.ndarray, unit: np.ndarray) -> None:
        """To the part of the bits. At most two between calls of ``settle``."""
        part = unit * chance.astype(U)
        clear = value == 0
        self.low[:n] += np.where(clear, part, U(0))
        self.range[:n] = np.where(clear, (unit << U(ONE_BITS)) - part, part)

    def unit(self, n: int) -> np.ndarray:
        return self.range[:n] >> U(ONE_BITS)


class Writer(Coder):
    """Each block writes 16-bit units into a row of its own."""

    def __init__(self, lanes: int) -> None:
        super().__init__(lanes)
        self.out = np.zeros((lanes, BLOCK), np.uint16)
        self.size = np.zeros(lanes, np.int64)

    def settle(self, n: int) -> None:
        def emit(move, low):
            if self.size[move].max() >= self.out.shape[1]:
                self.out = np.concatenate([self.out, np.zeros_like(self.out[:, : BLOCK // 2])], axis=1)
            self.out[move, self.size[move]] = (low >> TOP_BITS).astype(np.uint16)
            self.size[move] += 1

        settle(self.low[:n], self.range[:n], emit)

    def finish(self) -> list[bytes]:
        ends = ((self.low[:, None] >> np.array([48, 32, 16, 0], U)) & U(0xFFFF)).astype("<u2")
        return [o[:n].astype("<u2").tobytes() + e.tobytes() for o, n, e in zip(self.out, self.size, ends)]


class Reader(Coder):
    """The counterpart of ``Writer``."""

    def __init__(self, blocks: list[bytes]) -> None:
        super().__init__(len(blocks))
        starts = np.cumsum([0] + [len(b) // 2 for b in blocks])[:-1]
        self.units = np.concatenate([np.frombuffer(b"".join(blocks), "<u2"), np.zeros(8, np.uint16)])
        self.at = starts.copy()
        self.code = np.zeros(len(blocks), U)
        for _ in range(4):
            self.code = (self.code << SHIFT16) | self.units[self.at].astype(U)
            self.at += 1

    def settle(self, n: int) -> None:
        def emit(move, _):
            units = self.units[np.minimum(self.at[move], len(self.units) - 1)]
            self.code[move] = (self.code[move] << SHIFT16) | units.astype(U)
            self.at[move] += 1

        settle(self.low[:n], self.range[:n], emit)

    def bits(self, n: int, chance: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """The next bit of each block."""
        return ((self.code[:n] - self.low[:n]) < unit * chance.astype(U)).astype(np.int32)


def encode(ids: np.ndarray) -> bytes:
    """Ids from 0 to 65535 as blocks: for each its length, bytes, checksum of the ids, and code."""
    if len(ids) and (ids.min() < 0 or ids.max() > MOST_ID):
        raise ValueError(f"ids must lie between 0 and {MOST_ID}")
    out = [struct.pack("<I", -(-len(ids) // BLOCK))]
    for i in range(0, len(ids), LANES * BLOCK):
        out.append(_encode(np.asarray(ids[i : i + LANES * BLOCK], np.int32)))
    return b"".join(out)


def _encode(ids: np.ndarray) -> bytes:
    lanes = -(-len(ids) // BLOCK)
    grid = np.zeros(lanes * BLOCK, np.int32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, BLOCK).T)
    last = len(ids) - (lanes - 1) * BLOCK
    mixer, writer = Mixer(lanes), Writer(lanes)
    for step in range(min(BLOCK, len(ids))):
        n = lanes if step < last else lanes - 1
        x = grid[step, :n]
        mixer.begin(n)
        node = np.ones(n, np.int32)
        for bit in range(ID_BITS):
            value = (x >> (ID_BITS - 1 - bit)) & 1
            writer.narrow(n, value, mixer.chance(n, bit, node), writer.unit(n))
            mixer.learn(n, bit, value)
            node = node * 2 + value
            if bit % 2:
                writer.settle(n)
        mixer.end(n, x)
    out = []
    for k, code in enumerate(writer.finish()):
        block = ids[k * BLOCK : (k + 1) * BLOCK]
        out.append(struct.pack("<III", len(block), len(code), zlib.crc32(block.astype("<u4").tobytes())) + code)
    return b"".join(out)


def decode(raw: bytes) -> np.ndarray:
    """The ids; a block whose checksum differs raises an error."""
    (n,) = struct.unpack_from("<I", raw)
    at, blocks = 4, []
    for _ in range(n):
        length, size, crc = struct.unpack_from("<III", raw, at)
        blocks.append((length, crc, raw[at + 12 : at + 12 + size]))
        at += 12 + size
    if at != len(raw) or any(len(code) < 8 or not 0 < length <= BLOCK for length, _, code in blocks):
        raise ValueError("the coded ids are cut short")
    found = [_decode(blocks[i : i + LANES]) for i in range(0, n, LANES)]
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def _decode(blocks: list[tuple[int, int, bytes]]) -> np.ndarray:
    lanes, last = len(blocks), blocks[-1][0]
    grid = np.zeros((max(b[0] for b in blocks), lanes), np.int32)
    mixer, reader = Mixer(lanes), Reader([b[2] for b in blocks])
    for step in range(len(grid)):
        n = lanes if step < last else lanes - 1
        mixer.begin(n)
        node = np.ones(n, np.int32)
        for bit in range(ID_BITS):
            chance, unit = mixer.chance(n, bit, node), reader.unit(n)
            value = reader.bits(n, chance, unit)
            reader.narrow(n, value, chance, unit)
            mixer.learn(n, bit, value)
            node = node * 2 + value
            if bit % 2:
                reader.settle(n)
        grid[step, :n] = node - (1 << ID_BITS)
        mixer.end(n, grid[step, :n])
    out = []
    for k, (length, crc, _) in enumerate(blocks):
        ids = np.ascontiguousarray(grid[:length, k])
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"checksum of block {k} differs")
        out.append(ids)
    return np.concatenate(out)
