"""Words of whole texts as 64-bit hashes, on the bytes of Arrow buffers: no Python object per word.

A word is a run of bytes other than white space; A-Z count as a-z. Multi-byte characters hold no such bytes, so bytes
and characters agree. A word's hash depends on its bytes alone, not on its place or on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SHINGLE = 5
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def _random(seed: int, n: int, dtype=np.uint64) -> np.ndarray:
    bits = np.iinfo(dtype).bits
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << bits, n, dtype=dtype, endpoint=False)


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _random(1, 256) | U64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BYTE[IS_SPACE] = 0
_PLACE = _random(2, SHINGLE) | U64(1)
_SHORT = _random(3, SHINGLE)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, _BLOCK)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            with np.errstate(over="ignore"):
                _powers[name] = np.concatenate([[U64(1)], np.cumprod(np.full(size - 1, base, U64))])
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow text column and the bounds of its rows; null rows are empty."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each row the range of its words: ``bounds`` in words."""
    hashes, starts, at = [], [], 0
    first_of_row = np.zeros(len(data) + 1, bool)
    first_of_row[bounds] = True
    while at < len(data):
        end = _cut(data, first_of_row, at)
        block = data[at:end]
        space = IS_SPACE[block]
        first = ~space
        first[1:] &= space[:-1] | first_of_row[at + 1 : end]
        places = np.flatnonzero(first)
        if len(places):
            up, down = _power(len(block))
            with np.errstate(over="ignore"):
                sums = np.add.reduceat(_BYTE[block] * up[: len(block)], places)
                hashes.append(mixed(sums * down[places]))
            starts.append(places + at)
        at = end
    if not hashes:
        return np.zeros(0, U64), np.zeros(len(bounds), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)


def _cut(data: np.ndarray, first_of_row: np.ndarray, at: int) -> int:
    """Where a block from ``at`` ends: at a space or row border near ``_BLOCK``, or the next one after it."""
    if len(data) - at <= _BLOCK:
        return len(data)
    fits = np.flatnonzero(IS_SPACE[data[at : at + _BLOCK]] | first_of_row[at + 1 : at + _BLOCK + 1])
    if len(fits):
        return at + int(fits[-1]) + 1
    for start in range(at + _BLOCK, len(data), _BLOCK):
        more = np.flatnonzero(IS_SPACE[data[start : start + _BLOCK]] | first_of_row[start + 1 : start + _BLOCK + 1])
        if len(more):
            return start + int(more[0]) + 1
    return len(data)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its five-word shingles; fewer words make one, none make no shingle."""
    words, bounds = word_hashes(*buffers(texts))
    with np.errstate(over="ignore"):
        whole = np.zeros(max(0, len(words) - SHINGLE + 1), U64)
        for k in range(SHINGLE):
            whole += words[k : k + len(whole)] * _PLACE[k]
        whole = mixed(whole)
        for first, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            n = end - first
            if n >= SHINGLE:
                yield np.unique(whole[first : end - SHINGLE + 1])
            elif n:
                yield mixed(np.atleast_1d((words[first:end] * _PLACE[:n]).sum(dtype=U64) + _SHORT[n]))
            else:
                yield np.zeros(0, U64)
