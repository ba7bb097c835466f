"""Vectorised text primitives shared by the training-data operators.

Everything works on slices of Arrow batches of a bounded number of bytes, so a
worker's memory follows the slice size (or the longest single text), not the
partition.  Texts are treated as UTF-8 bytes.

Two kinds of rolling hashes: quick ones modulo 2**64, which only place cuts and
anchors, as structured strings can collide there whatever the base; and those
modulo the prime 2**61 - 1, by which equality is judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INV = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = -(-n // (1 << 18)) << 18
            steps = np.full(size, _BASE, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = _INV
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def byte_table(seed: int, fold_case: bool) -> np.ndarray:
    """A random 64-bit value per byte, for prefix_hash; A-Z share those of a-z if fold_case."""
    table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1))
    if fold_case:
        table[65:91] = table[97:123]
    return table


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """S of which span_hash reads the hash of any span of values."""
    up, _ = _POWERS.get(len(values) + 1)
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * up[: len(values)], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _POWERS.get(len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * down[starts])


def window_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """The hashes of all spans of one width."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, down = _POWERS.get(len(prefix))
    return mix64((prefix[width:] - prefix[:n]) * down[:n])


PRIME = np.uint64((1 << 61) - 1)
_BASE61 = 0x1B7E151628AED2A6


#: Values that are worked on at once, so that they stay in a core's cache.
_RUN = 1 << 14


def _folded(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below 2**64."""
    x = (x >> np.uint64(61)) + (x & PRIME)
    return np.minimum(x, x - PRIME)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> np.uint64(31), a & low, b >> np.uint64(31), b & low
    middle = a0 * b1
    middle += a1 * b0
    out = a1 * b1
    out += out
    out += middle >> np.uint64(30)
    middle &= np.uint64((1 << 30) - 1)
    middle <<= np.uint64(31)
    out += middle
    out += a0 * b0
    return _folded(out)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for a and b below it; b may be a single value."""
    if len(a) <= _RUN:
        return _product(a, b)
    out = np.empty(len(a), np.uint64)
    for i in range(0, len(a), _RUN):
        out[i : i + _RUN] = _product(a[i : i + _RUN], b if len(b) == 1 else b[i : i + _RUN])
    return out


class _Powers61:
    """Powers of a base and of its inverse modulo the prime, doubled on demand."""

    def __init__(self) -> None:
        p = int(PRIME)
        self.steps = _BASE61 % p, pow(_BASE61, -1, p)
        self.up, self.down = (np.ones(1, np.uint64) for _ in range(2))

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            have = len(self.up)
            more = (np.array([pow(step, have, int(PRIME))], np.uint64) for step in self.steps)
            self.up, self.down = (np.concatenate([x, _times(x, y)]) for x, y in zip((self.up, self.down), more))
        return self.up[:n], self.down[:n]


_POWERS61 = _Powers61()


def prefix61(values: np.ndarray) -> np.ndarray:
    """P of which span61 reads the hash of any span of values; values are below the prime, or 16-bit codes below 2**12."""
    n = len(values)
    up, _ = _POWERS61.get(n + 1)
    out = np.zeros(n + 1, np.uint64)
    codes = values.dtype == np.uint16
    shift, carry = np.uint64(31 if codes else 32), np.uint64(0)
    low, top = np.uint64((1 << int(shift)) - 1), np.uint64(61) - shift
    for i in range(0, n, _RUN):
        power, value = up[i : min(n, i + _RUN)], values[i : i + _RUN]
        # sums of halves stay below 2**58
        if codes:
            value = value.astype(np.uint64)
            high, rest = np.cumsum(value * (power >> shift)), np.cumsum(value * (power & low))
        else:
            term = _product(value, power)
            high, rest = np.cumsum(term >> shift), np.cumsum(term & low)
        rest += high >> top
        high &= np.uint64((1 << int(top)) - 1)
        high <<= shift
        rest += high
        rest += carry
        rest = _folded(rest)
        out[i + 1 : i + 1 + len(rest)] = rest
        carry = rest[-1]
    return out


def span61(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scrambled hashes of spans; equal spans of one length have equal ones."""
    _, down = _POWERS61.get(len(prefix))
    return mix64(_times(_folded(prefix[ends] + PRIME - prefix[starts]), down[starts]))


def window61(prefix: np.ndarray, width: int) -> np.ndarray:
    """The hashes of all spans of one width."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, down = _POWERS61.get(len(prefix))
    out = np.empty(n, np.uint64)
    for i in range(0, n, _RUN):
        j = min(n, i + _RUN)
        out[i:j] = mix64(_product(_folded(prefix[i + width : j + width] + PRIME - prefix[i:j]), down[i:j]))
    return out


def byte_codes(seed: int, fold_case: bool) -> np.ndarray:
    """A code below 2**12 per byte, for prefix61; A-Z share those of a-z if fold_case."""
    codes = np.random.default_rng(seed).permutation(1 << 12)[:256].astype(np.uint16)
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


class Slice:
    """Some rows of a batch: their number range, bytes and offsets."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray) -> None:
        self.first, self.data, self.offsets = first, data, offsets
        self.n = len(offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow column, null as empty, in slices of most bytes (or one text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    else:
        column = column.cast(pa.large_binary())
    column = pc.fill_null(column, b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        j = min(j, n)
        yield Slice(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def separators(pattern: str) -> np.ndarray:
    """Bytes that are not part of words: 'space' for the ASCII white space, 'alnum' for all ASCII but letters and digits."""
    out = np.zeros(256, bool)
    if pattern == "space":
        out[[32, 9, 10, 11, 12, 13]] = True
    else:
        out[:128] = True
        out[48:58] = out[65:91] = out[97:123] = False
    return out


class Words:
    """Word spans of a slice and their hashes; row i has the words first[i] to first[i + 1]; base is prefix61 of the codes, where known."""

    def __init__(self, s: Slice, separator: np.ndarray, codes: np.ndarray, base: np.ndarray | None = None) -> None:
        data, n = s.data, len(s.data)
        inside = ~separator[data]
        edge = np.zeros(n + 1, bool)
        edge[s.offsets] = True
        before = np.empty(n, bool)
        if n:
            before[0] = True
            before[1:] = ~inside[:-1]
        self.starts = np.flatnonzero(inside & (before | edge[:n]))
        after = np.empty(n, bool)
        if n:
            after[-1] = True
            after[:-1] = ~inside[1:]
        self.ends = np.flatnonzero(inside & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, s.offsets)
        self.hashes = span61(prefix61(codes[data]) if base is None else base, self.starts, self.ends)

    def sequence(self) -> np.ndarray:
        """Of which span61 and window61 read the hashes of spans of words."""
        return prefix61(self.hashes >> np.uint64(3))


def gram_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all spans of width words of the slice, and whether a span lies in one row."""
    grams = window61(words.sequence(), width)
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    same = row[: len(grams)] == row[width - 1 : width - 1 + len(grams)] if len(grams) else np.zeros(0, bool)
    return grams, same
