"""Words of whole texts as numpy arrays, for functions that run on Arrow batches.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. Those six bytes never occur inside a
multi-byte UTF-8 character, so words are cut on the raw UTF-8 bytes of a whole batch at
once; a null text has no words. Word hashes are 64-bit polynomial sums of a random byte
table, finished with an avalanche step; they depend on the bytes of the word only.

A batch is worked on in slices of whole documents of about ``SLICE`` bytes (one very long
document is a slice of its own), so the memory of a task follows its longest document.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTES_LOWER = _BYTES.copy()
_BYTES_LOWER[65:91] = _BYTES[97:123]
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INV)):
            table = np.full(n, base, _U)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=_U)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche step of a 64-bit hash."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Words:
    """Documents of one slice: ``data[starts[k]:ends[k]]`` is word k; document i owns the words
    ``first[i]:first[i + 1]`` and the bytes ``offsets[i]:offsets[i + 1]``."""

    row: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word; ``lower`` reads A-Z as a-z."""
        return span_hashes(self.data, self.starts, self.ends, lower)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of the bytes of every span; spans ascend and do not overlap."""
    table = _BYTES_LOWER if lower else _BYTES
    out = np.empty(len(starts), _U)
    k = 0
    while k < len(starts):
        lo = starts[k]
        j = max(k + 1, int(np.searchsorted(ends, lo + SLICE, "right")))
        hi = ends[j - 1]
        power, inverse = _power_tables(int(hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum(table[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        out[k:j] = (sums[ends[k:j] - lo] - sums[starts[k:j] - lo]) * inverse[starts[k:j] - lo]
        k = j
    return mix(out)


def per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]`` for every i."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every (hash, document): whether it occurs twice or more, and whether it has occurred before."""
    keys = mix(hashes + docs.astype(_U) * _U(0xA24BAED4963EE407))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    again, many = np.empty(len(keys), bool), np.empty(len(keys), bool)
    again[order] = same[:-1]
    many[order] = same[:-1] | same[1:]
    return many, again


def _trim():
    """The C library's call that gives freed pages back to the system, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None


_TRIM = _trim()


def tidy() -> None:
    """Give back what earlier batches needed: workers are kept for later stages, and the peak of each would add up."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    tidy()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + len(texts) + 1] if len(texts) \
        else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs


def cut(data: np.ndarray, offsets: np.ndarray, row: int = 0) -> Words:
    """Words of the documents whose bytes are ``data[offsets[i]:offsets[i + 1]]``, ``offsets[0] == 0``."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(row, data, offsets, none, none, np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[data]
    begins = offsets[:-1][offsets[:-1] < n]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[begins] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(row, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(texts: pa.Array | pa.ChunkedArray) -> Iterator[Words]:
    """The documents of a string column, in order, in slices of whole documents."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    data, offs = text_buffers(texts)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + SLICE, "right")) - 1)
        yield cut(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], lo)
        lo = hi
    del data, offs
    tidy()


def grams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the n words from word k on, whether those n words lie in one document), for every word k."""
    total = len(hashes)
    out = np.zeros(total, _U)
    for i in range(n):
        out[: total - i] += hashes[i:] * _U(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64))
    left = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    return mix(out + _U(n)), left >= n


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return x.view(np.int64)
