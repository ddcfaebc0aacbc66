"""Arrow text columns as numpy buffers: words, fingerprints of runs, and pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer document is cut where that is possible.
PIECE = 1 << 20

U = np.uint64
_BASES = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A random-looking number for each byte value.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = []
        for b in (int(_BASES[base]), pow(int(_BASES[base]), -1, 2**64)):
            p = np.full(size, U(b))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


class Runs:
    """Quick fingerprints of runs of a sequence of 64-bit values, from its prefix sums.

    Equal runs have equal fingerprints, but long runs of a regular kind can share one without
    being equal: modulo a power of two, the Thue-Morse word and its complement do. They are good for
    choosing positions and not for calling runs equal.
    """

    def __init__(self, values: np.ndarray, base: int = 0):
        n = len(values)
        power, self.inverse = powers(base, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * power[:n], out=self.sums[1:])

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.inverse[start])

    def everywhere(self, length: int) -> np.ndarray:
        """The fingerprint of the run of ``length`` at each start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


#: A prime that a product can be reduced by with shifts, and two bases for it.
PRIME = (1 << 61) - 1
_FIELD_BASES = (0x1B873593CC9E2D51 % PRIME, 0x0A54D38E9B6F27C3 % PRIME)
_FIELD_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_FIELD_HALVES: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Bytes that are summed at once, so that they stay in the processor's cache.
BLOCK = 1 << 14


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & U(PRIME)) + (x >> U(61))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def times(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """Products modulo the prime, by halves of 30 and 31 bits."""
    low = U((1 << 31) - 1)
    a1, a0, b1, b0 = a >> U(31), a & low, b >> U(31), b & low
    cross = a1 * b0 + a0 * b1
    return _reduced(((a1 * b1) << U(1)) + (cross >> U(30)) + ((cross & U((1 << 30) - 1)) << U(31)) + a0 * b0)


def field_powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo the prime."""
    have = _FIELD_POWERS.get(base)
    if have is None or len(have[0]) < n:
        out = []
        for b in (_FIELD_BASES[base], pow(_FIELD_BASES[base], -1, PRIME)):
            p = np.ones(1, dtype=np.uint64)
            while len(p) < max(n, 1 << 16):
                p = np.concatenate([p, times(p, U(pow(b, len(p), PRIME)))])
            out.append(p)
        have = _FIELD_POWERS[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


class FieldRuns:
    """Fingerprints of runs of 64-bit values that stand for equality: polynomials over a prime field.

    Two different runs of n values share a fingerprint for at most n of 2**61 bases, and one of
    both bases independently. A sequence has up to four million values.
    """

    def __init__(self, values: np.ndarray, base: int = 0):
        n = len(values)
        power, self.inverse = field_powers(base, n + 1)
        terms = times(_reduced(values), power[:n])
        high, low = np.cumsum(terms >> U(31)), np.cumsum(terms & U((1 << 31) - 1))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        self.sums[1:] = _reduced((high >> U(30)) + ((high & U((1 << 30) - 1)) << U(31)) + low)

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        between = _reduced(self.sums[start + length] + (U(PRIME) - self.sums[start]))
        return mixed(times(between, self.inverse[start]))


class ByteRuns:
    """Fingerprints of runs of bytes, by the same polynomials as ``FieldRuns``.

    Bytes are so small that their products can be summed as they are, for up to four million
    bytes: only the sums that are asked for are reduced.
    """

    def __init__(self, data: np.ndarray, base: int = 0):
        n = len(data)
        self.inverse = field_powers(base, n + 1)[1]
        self.halves = np.zeros((2, n + 1), dtype=np.uint64)
        for half, power in zip(self.halves, _power_halves(base, n), strict=True):
            for a in range(0, n, BLOCK):
                part = half[a + 1 : a + BLOCK + 1]
                np.multiply(data[a : a + BLOCK], power[a : a + BLOCK], out=part)
                part[0] += half[a]
                np.cumsum(part, out=part)

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        high, low = (half[start + length] - half[start] for half in self.halves)
        between = _reduced((high >> U(30)) + ((high & U((1 << 30) - 1)) << U(31)) + low)
        return mixed(times(between, self.inverse[start]))


def _power_halves(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base, by halves of 30 and 31 bits."""
    have = _FIELD_HALVES.get(base)
    if have is None or len(have[0]) < n:
        power = field_powers(base, max(n, 1 << 16))[0]
        have = _FIELD_HALVES[base] = (power >> U(31), power & U((1 << 31) - 1))
    return have[0][:n], have[1][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins (and the last ends); NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    starts = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, dtype=np.uint8), starts - starts[0]
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def document_runs(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``most`` bytes together; a longer one is alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a range of documents.

    ``values`` has a 64-bit hash per word, ``begins`` the number of the first word of each
    document (and the end), ``starts`` and ``ends`` the words' places in ``data``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, last: int, lower: bool = False):
        lo, hi = int(offsets[first]), int(offsets[last])
        values, starts, ends = [], [], []
        for a, b in self._cuts(data, lo, hi):
            s, e, v = _words(data[a:b], offsets[first : last + 1] - a, lower)
            values.append(v)
            starts.append(s + a)
            ends.append(e + a)
        self.values = np.concatenate(values) if values else np.empty(0, dtype=np.uint64)
        self.starts = np.concatenate(starts) if starts else np.empty(0, dtype=np.int64)
        self.ends = np.concatenate(ends) if ends else np.empty(0, dtype=np.int64)
        self.begins = np.searchsorted(self.starts, offsets[first : last + 1])
        self.begins[-1] = len(self.starts)

    @staticmethod
    def _cuts(data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """Parts of at most about two pieces, cut at spaces."""
        while lo < hi:
            cut = min(lo + 2 * PIECE, hi)
            while cut < hi:
                spaces = np.flatnonzero(IS_SPACE[data[cut : cut + PIECE]])
                if len(spaces):
                    cut += int(spaces[0])
                    break
                cut = min(cut + PIECE, hi)
            yield lo, cut
            lo = cut


def _words(data: np.ndarray, borders: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of some bytes; no word crosses a border."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~IS_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[borders[(borders >= 0) & (borders <= n)]] = True
    change = inside[1:] != inside[:-1]
    begin = inside[1:] & (change | cut)
    end = inside[:-1] & (change | cut)
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    return starts, ends, word_hashes(LOWER[data] if lower else data, starts, ends - starts)


#: Words of more bytes than this are hashed one by one.
LONG_WORD = 64
_KEPT = U(2**64 - 1) >> (U(8) * (U(8) - np.minimum(np.arange(9, dtype=np.uint64), U(8)))).clip(0, 63)
_KEPT[0] = 0


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight at a time; no polynomial, so that words made to a
    pattern do not share one."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = mixed(lengths.astype(np.uint64) + U(0x9E3779B97F4A7C15))
    own = np.arange(len(starts))
    for done in range(0, LONG_WORD, 8):
        own = own[lengths[own] > done]
        if not len(own):
            break
        chunk = np.ascontiguousarray(eights[starts[own] + done]).view("<u8")[:, 0]
        chunk = chunk & _KEPT[np.minimum(lengths[own] - done, 8)]
        out[own] = mixed(out[own] * U(0xD6E8FEB86659FD93) ^ chunk)
    for i in np.flatnonzero(lengths > LONG_WORD):
        word = data[starts[i] : starts[i] + lengths[i]].tobytes()
        out[i] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
    return out


def array_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the values of all rows, one after the other."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
