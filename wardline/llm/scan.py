"""Array scans of UTF-8 text: where its words lie, and a 64-bit hash of each.

A batch of texts is one byte buffer; everything below runs over whole buffers, not over words. Hashes
are sums modulo 2**64 of random byte values times position weights, then mixed. They stand for the
words: two different words share a hash with a chance of 2**-64.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BLOCK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random odd 64-bit numbers that follow from the seed."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
        return mix(steps + _U(seed)) | _U(1)


_BYTE = stream(11, 256)
_PLACE = stream(12, _BLOCK)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)  # ASCII marks that start a piece of their own after a letter
_MARK[list(b'!"#$%&()*+,-./:;=?@[]^_`{}~')] = True


def join(bodies: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts between line feeds, and where each begins; the last entry is the end."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) + 1
    return b"\n" + b"\n".join(bodies) + b"\n", np.concatenate([[1], 1 + np.cumsum(sizes)])


def lower(buffer: bytes) -> bytes:
    """A-Z in lower case, all other bytes as they are."""
    return buffer.translate(_LOWER)


def lower_ascii(buffer: bytes) -> bytes:
    """A-Z in lower case, but stretches between white space that hold other than ASCII as they are."""
    if buffer.isascii():
        return lower(buffer)
    data = np.frombuffer(buffer, np.uint8)
    stretch = np.cumsum(_SPACE[data])
    other = np.zeros(int(stretch[-1]) + 1, bool)
    other[stretch[data >= 128]] = True
    return np.where(other[stretch], data, np.frombuffer(lower(buffer), np.uint8)).tobytes()


class Words:
    """Words of a joined buffer: ``starts``, ``ends`` and ``hashes``.

    With ``marks`` a word is also cut between an ASCII letter and a mark that follows it.
    """

    def __init__(self, buffer: bytes, marks: bool = False):
        data = np.frombuffer(buffer, np.uint8)
        space = _SPACE[data]
        first = ~space
        first[1:] &= space[:-1]
        last = space.copy()
        last[0] = False
        last[1:] &= ~space[:-1]
        if marks:
            cut = _MARK[data]
            cut[1:] &= _LETTER[data[:-1]]
            cut[0] = False
            first |= cut
            last |= cut
        self.buffer = buffer
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last)
        sizes = self.ends - self.starts
        before = np.cumsum(sizes) - sizes
        with np.errstate(over="ignore"):
            place = np.arange(int(sizes.sum())) - np.repeat(before, sizes)
            if len(sizes) and sizes.max() >= _BLOCK:
                weight = _PLACE[place % _BLOCK] + (place // _BLOCK).astype(_U) * _U(0xD6E8FEB86659FD93)
            else:
                weight = _PLACE[place]
            values = _BYTE[data[~space]] * weight
            self.hashes = mix(np.add.reduceat(values, before) + sizes.astype(_U)) if len(sizes) else np.zeros(0, _U)

    def piece(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]]

    def counts(self, texts_at: np.ndarray) -> np.ndarray:
        """The number of words of each text; ``texts_at`` as ``join`` gives it."""
        return np.diff(np.searchsorted(self.starts, texts_at))


class HashTable:
    """An open-addressing map from 64-bit hashes to 0, 1, 2, ... in the order of insertion."""

    def __init__(self, slots: int = 1 << 16):
        self._keys = np.zeros(slots, _U)
        self._numbers = np.zeros(slots, np.int32)
        self.size = 0

    def _place(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        mask = _U(len(self._keys) - 1)
        slot = (keys & mask).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = self._keys[slot[left]] == 0
            tried = left[free]
            self._keys[slot[tried]] = keys[tried]
            won = np.zeros(len(left), bool)
            won[free] = self._keys[slot[tried]] == keys[tried]
            self._numbers[slot[left[won]]] = numbers[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & int(mask)

    def add(self, keys: np.ndarray) -> None:
        """Insert distinct keys that are not in the map."""
        keys = np.where(keys == 0, _U(1), keys)
        while 2 * (self.size + len(keys)) > len(self._keys):
            used = self._keys != 0
            old, numbers = self._keys[used], self._numbers[used]
            self._keys = np.zeros(2 * len(self._keys), _U)
            self._numbers = np.zeros(len(self._keys), np.int32)
            self._place(old, numbers)
        self._place(keys, np.arange(self.size, self.size + len(keys), dtype=np.int32))
        self.size += len(keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        keys = np.where(keys == 0, _U(1), keys)
        mask = len(self._keys) - 1
        slot = (keys & _U(mask)).astype(np.int64)
        out = np.full(len(keys), -1, np.int32)
        left = np.arange(len(keys))
        while len(left):
            at = slot[left]
            there = self._keys[at]
            hit = there == keys[left]
            out[left[hit]] = self._numbers[at[hit]]
            left = left[~hit & (there != 0)]
            slot[left] = (slot[left] + 1) & mask
        return out


def slices(bodies: list[bytes], limit: int = 1 << 20):
    """Consecutive slices (from, to) of texts, of about ``limit`` bytes or one text each."""
    start = size = 0
    for i, body in enumerate(bodies):
        if size and size + len(body) > limit:
            yield start, i
            start, size = i, 0
        size += len(body)
    if start < len(bodies):
        yield start, len(bodies)
