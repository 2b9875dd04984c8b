"""Vectorised words, word hashes and shingle sets of Arrow string columns.

Words are the maximal runs of bytes other than space and ``\\x09-\\x0D``. Every hash is a
fixed function of the bytes, so any executor, retry or run gives the same values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 18
#: Bytes from which a word is hashed by a digest.
LONG_WORD = 256

_U = np.uint64
_BASE = 0x9E3779B97F4A7C17
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(29))
    x = x * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


def word_hashes(letters: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The hash of every word: eight bytes after eight are taken in and mixed.

    Each step is a bijection of what came before, so words of up to eight bytes never
    collide within one size, and no pattern of letters makes longer ones collide. Words
    beyond ``LONG_WORD`` bytes, which are rare, get a cryptographic digest.
    """
    if not len(size):
        return np.zeros(0, _U)
    padded = np.concatenate((letters, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(letters) + 1, "<u8", padded.data, strides=(1,))
    out = mix64(size.astype(_U) * _U(_BASE))
    active, left, at = np.arange(len(size)), np.minimum(size, LONG_WORD), start
    while len(active):
        spare = np.maximum(8 - left, 0).astype(_U) * _U(8)  # bits beyond the word
        lane = eight[at] << spare
        out[active] = mix64(mix64(out[active] ^ lane) + _U(_BASE))
        more = left > 8
        active, left, at = active[more], left[more] - 8, at[more] + 8
    for i in np.flatnonzero(size > LONG_WORD):
        word = letters[start[i] : start[i] + size[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return out


@dataclass
class Words:
    """Words of some texts: ``hash[first[i]:first[i + 1]]`` are those of text ``i``.

    ``start`` and ``end`` are byte positions in ``data``.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows (null: empty)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def split_words(data: np.ndarray, offsets: np.ndarray, fold_case: bool) -> Words:
    """Words of the texts between consecutive offsets; fold_case lower-cases A-Z."""
    low = int(offsets[0])
    data, offsets = data[low : int(offsets[-1])], offsets - low
    n = len(data)
    inside = np.zeros(n + 2, bool)
    np.logical_not(_WHITE[data], out=inside[1:-1])
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashed = word_hashes(_FOLD[data] if fold_case else data, start, end - start)
    return Words(data, start, end, hashed, np.searchsorted(start, offsets))


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes are worked on at once."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        stop = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1
        stop = min(rows, max(stop, at + 1))
        yield at, stop
        at = stop


def chunks(texts: pa.Array, fold_case: bool) -> Iterator[tuple[int, Words]]:
    """The words of a column, a bounded number of bytes at a time, with the first row."""
    data, offsets = _buffers(texts)
    for at, stop in pieces(offsets):
        yield at, split_words(data, offsets[at : stop + 1], fold_case)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive word hashes (none when there are fewer)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for k in range(width):
        total = total * _U(_BASE) + words[k : k + n]
    return mix64(total)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text; fewer words make one shingle, none none."""
    if not len(words):
        return np.zeros(0, _U)
    return np.unique(window_hashes(words, min(width, len(words))))


def circulant_signatures(elements: np.ndarray, first: np.ndarray, n_hashes: int) -> np.ndarray:
    """Circulant MinHash of the sets ``elements[first[i]:first[i + 1]]``, none of them empty.

    Coordinate k of a set is the least ``pi((sigma(x) - k) mod 2**32)`` over its elements.
    ``sigma`` is the low half of the element hash, which is already a random permutation;
    ``pi`` is one fixed permutation of the 32-bit integers. No coordinate has a
    permutation of its own: each uses the one before, circularly shifted by a step.
    Returns ``n_hashes`` rows, one column per set.
    """
    sigma = elements.astype(np.uint32)
    out = np.empty((n_hashes, len(first) - 1), np.uint32)
    x, t = np.empty_like(sigma), np.empty_like(sigma)
    for k in range(n_hashes):
        np.subtract(sigma, np.uint32(k + 1), out=x)
        for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B), (16, 1)):
            np.right_shift(x, np.uint32(shift), out=t)
            np.bitwise_xor(x, t, out=x)
            if factor != 1:
                np.multiply(x, np.uint32(factor), out=x)
        np.minimum.reduceat(x, first[:-1], out=out[k])
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each ``rows`` coordinates: an array of sets by bands."""
    bands = len(signatures) // rows
    keys = np.empty((signatures.shape[1], bands), _U)
    for band in range(bands):
        total = np.full(signatures.shape[1], band + 1, _U)
        for row in signatures[band * rows : (band + 1) * rows]:
            total = mix64(total * _U(_BASE) + row.astype(_U))
        keys[:, band] = total
    return keys
