"""Words of whole texts, and their hashes, by arrays instead of by word.

A word is a run of bytes other than 0x20 and 0x09-0x0D, unchanged.  Word hashes
are 64 bits: a polynomial over random values of the bytes, mixed; words above
``LONG_WORD`` bytes (where two crafted strings could meet) are hashed by XXH3.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: The words of a text.
WORD = re.compile("[^\x20\x09-\x0d]+")
#: Lower-cases A-Z and nothing else.
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
LONG_WORD = 256
#: Bytes of text hashed at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_GRAM_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def mix_one(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], _U))[0])


_BYTES = np.arange(256, dtype=_U)
_VALUE = mix(_BYTES + _U(0x632BE59BD9B4E019))
_VALUE_LOWER = _VALUE[np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])]
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; tables of a usual chunk are kept."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    size = max(n, CHUNK_BYTES + 1)
    tables = []
    for base in (_BASE, _INVERSE):
        steps = np.full(size, base, _U)
        steps[0] = 1
        tables.append(np.cumprod(steps, dtype=_U))
    if size <= 2 * CHUNK_BYTES:
        _powers[:] = tables
    return tables[0][:n], tables[1][:n]


class Tokens(NamedTuple):
    """The words of some rows: row (from ``first``), byte range in ``data`` and hash of each."""

    first: int
    rows: int
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray

    def bounds(self) -> np.ndarray:
        """The words of row ``first + i`` are bounds[i]:bounds[i + 1]."""
        return np.searchsorted(self.row, np.arange(self.rows + 1) + self.first)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    power, inverse = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, _U)
    sums[0] = 0
    np.cumsum((_VALUE_LOWER if lower else _VALUE)[data] * power[:-1], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U) * _U(_GRAM_BASE))
    for i in np.flatnonzero(end - start > LONG_WORD):
        word = data[start[i] : end[i]].tobytes()
        hashes[i] = xxhash.xxh3_64_intdigest(word.lower() if lower else word)
    return hashes


def tokens(texts: pa.Array, lower: bool = False) -> Iterator[Tokens]:
    """The words of a column of texts, in chunks of rows; a null text has none."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    everything = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        data = everything[offsets[first] : offsets[last]]
        edges = offsets[first : last + 1] - offsets[first]
        full = np.zeros(len(data) + 2, bool)
        full[1:-1] = ~_SPACE[data]
        opens = full[1:-1] & ~full[:-2]
        closes = full[1:-1] & ~full[2:]
        inner = edges[(edges > 0) & (edges < len(data))]
        opens[inner] |= full[inner + 1]
        closes[inner - 1] |= full[inner]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        row = np.searchsorted(edges, start, "right") - 1 + first
        yield Tokens(first, last - first, row, start, end, _hashes(data, start, end, lower), data)
        first = last


def windows(t: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and Rabin-Karp hash of each run of ``n`` words within one row."""
    count = len(t.row) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    rolled = np.zeros(count, _U)
    for j in range(n):
        rolled = rolled * _U(_GRAM_BASE) + t.hash[j : j + count]
    at = np.flatnonzero(t.row[:count] == t.row[n - 1 :])
    return at, mix(rolled[at])


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text in turn, the sorted set of its ``n``-word shingles, A-Z lower-cased.

    With fewer words the whole sequence is the one shingle; without any, the set is empty.
    """
    for t in tokens(texts, lower=True):
        at, hashes = windows(t, n)
        cuts = np.searchsorted(t.row[at], np.arange(t.rows + 1) + t.first)
        bounds = t.bounds()
        for i in range(t.rows):
            if cuts[i] < cuts[i + 1]:
                yield np.unique(hashes[cuts[i] : cuts[i + 1]])
            elif bounds[i] < bounds[i + 1]:
                whole = bounds[i + 1] - bounds[i]
                rolled = int(whole)
                for h in t.hash[bounds[i] : bounds[i + 1]].tolist():
                    rolled = (rolled * _GRAM_BASE + h) & 0xFFFFFFFFFFFFFFFF
                yield mix(np.array([rolled], _U))
            else:
                yield np.zeros(0, _U)
