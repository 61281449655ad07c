"""Elias-Fano sequences and a two-level n-gram trie on them, kept in memory-mapped files."""

from __future__ import annotations

import tempfile

import numpy as np

STRIDE = 512        # set bits from one sample of the high bits to the next
STEPS = 4096        # quantisation steps of a factor of ten
NOTHING = 65_535    # code of probability zero


def quantise(p: np.ndarray) -> np.ndarray:
    """Probabilities as 16-bit codes of their logarithm: 4,096 steps to a factor of ten."""
    with np.errstate(divide="ignore"):
        codes = np.where(p > 0, np.rint(-STEPS * np.log10(np.maximum(p, 1e-300))), NOTHING)
    return np.minimum(codes, NOTHING).astype(np.uint16)


def dequantise(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == NOTHING, 0.0, 10.0 ** (-codes.astype(np.float64) / STEPS))


class MonotoneSequence:
    """A non-decreasing sequence: low bits packed, high bits as gaps in unary, with samples.

    About 2 + log2(universe / length) bits an item. ``window`` decodes any stretch from the
    nearest sample on.
    """

    def __init__(self, length: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.length, self.width, self.low, self.high, self.samples = length, width, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> "MonotoneSequence":
        n = len(values)
        values = values.astype(np.uint64)
        most = int(values[-1]) + 1 if n else 1
        width = max(0, (most // max(n, 1)).bit_length() - 1)
        low = (values & np.uint64((1 << width) - 1))
        bits = ((low[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(n, width, np.packbits(bits.ravel()), np.packbits(unary), ones[::STRIDE].astype(np.uint64))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.length, self.width], np.uint64), self.low, self.high, self.samples]

    @classmethod
    def of(cls, head: np.ndarray, low, high, samples) -> "MonotoneSequence":
        return cls(int(head[0]), int(head[1]), low, high, samples)

    def window(self, start: int, end: int) -> np.ndarray:
        """Items start to end - 1."""
        end = min(end, self.length)
        if start >= end:
            return np.zeros(0, np.int64)
        block = start // STRIDE
        first = int(self.samples[block])
        after = (end - 1) // STRIDE + 1
        last = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        byte = first // 8
        bits = np.unpackbits(np.asarray(self.high[byte:(last + 8) // 8]))
        ones = np.flatnonzero(bits[first - 8 * byte:]) + first
        places = np.arange(start, end)
        high = ones[start - block * STRIDE:end - block * STRIDE] - places
        if not self.width:
            return high
        a, b = start * self.width, end * self.width
        packed = np.unpackbits(np.asarray(self.low[a // 8:(b + 7) // 8]))[a - a // 8 * 8:][:b - a]
        low = packed.reshape(-1, self.width).astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))
        return (high << self.width) | low


class NgramTrie:
    """Contexts and, below each, the words seen after it with their quantised probability.

    Level one holds the ids of the contexts, monotone pointers to their first successor and the
    quantised weight that a context leaves to the unigrams. Level two holds the successors. Their
    ids rise within a context only, so each is stored plus the last stored value of the context
    before, which makes the whole level monotone; a look-up subtracts that base again. All arrays
    lie in one file without a name, mapped into memory, that goes with the object.
    """

    PARTS = 4 * 3 + 2
    WINDOW = 1 << 16  # successors decoded at a time

    def __init__(self, context: np.ndarray, word: np.ndarray, p: np.ndarray, left: np.ndarray):
        """Pairs sorted by context and word, each once; ``left`` by pair, equal within a context."""
        starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(context)].astype(np.int64)
        tops = np.cumsum(word[ends - 1] + 1) if len(starts) else np.zeros(0, np.int64)
        base = np.r_[0, tops[:-1]] if len(starts) else tops
        stored = word + np.repeat(base, ends - starts)
        parts = [
            *MonotoneSequence.encode(context[starts]).arrays(),
            *MonotoneSequence.encode(np.r_[starts, len(context)]).arrays(),
            *MonotoneSequence.encode(stored).arrays(), quantise(left[starts]), quantise(p)]
        self._file = tempfile.TemporaryFile()
        places, at = [], 0
        for part in parts:
            self._file.write(part.tobytes())
            pad = -part.nbytes % 8
            self._file.write(b"\0" * pad)
            places.append((at, part.dtype, len(part)))
            at += part.nbytes + pad
        self._file.flush()
        self.nbytes = at
        mapped = np.memmap(self._file, np.uint8, "r", shape=(at,)) if at else np.zeros(0, np.uint8)
        views = [mapped[a:a + n * d.itemsize].view(d) for a, d, n in places]
        self.contexts = MonotoneSequence.of(*views[0:4])
        self.pointers = MonotoneSequence.of(*views[4:8])
        self.successors = MonotoneSequence.of(*views[8:12])
        self.left, self.codes = views[12], views[13]

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each pair, ``NOTHING`` where it was never seen; pairs sorted by context."""
        out = np.full(len(context), NOTHING, np.uint16)
        n, done, base = self.contexts.length, 0, 0
        while done < n:
            # so many contexts that their successors fill a window, one at least
            some = min(n, done + self.WINDOW)
            pointers = self.pointers.window(done, some + 1)
            some = done + max(1, int(np.searchsorted(pointers, pointers[0] + self.WINDOW, "right")) - 1)
            pointers = pointers[:some - done + 1]
            ids = self.contexts.window(done, some)
            stored = self.successors.window(int(pointers[0]), int(pointers[-1]))
            bases = np.r_[base, stored[pointers[1:-1] - 1 - pointers[0]] + 1]
            a, b = np.searchsorted(context, ids[0], "left"), np.searchsorted(context, ids[-1], "right")
            place = np.minimum(np.searchsorted(ids, context[a:b]), len(ids) - 1)
            known = ids[place] == context[a:b]
            # the successor in the level's own order, which must lie below this context
            wanted = word[a:b] + bases[place]
            at = np.minimum(np.searchsorted(stored, wanted), len(stored) - 1)
            hit = known & (stored[at] == wanted) & (at >= pointers[place] - pointers[0]) & (at < pointers[place + 1] - pointers[0])
            found = out[a:b]
            found[hit] = self.codes[int(pointers[0]):int(pointers[-1])][at[hit]]
            base, done = int(stored[-1]) + 1, some
        return out

    def close(self) -> None:
        self.contexts = self.pointers = self.successors = self.left = self.codes = None
        self._file.close()
