"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of consecutive words with a smallest period q that is at least
``exponent`` times q long and cannot be extended. Take the power of two l <= q < 2 l: the
first block of l words, cut at multiples of l, that lies in the run comes again q words
later, hence in the window of l starting places after it.

1. Prefix doubling ranks every place by its first 1, 2, 4, ... words and leaves the
   places sorted: a suffix array, as deep as the longest block needs.
2. All places where a block stands are one range of that array. A wavelet tree over it
   answers, for all blocks at once, which place of a range comes next after a given one.
3. The places of a block inside its window are an arithmetic progression. One or two
   places give one or two candidate periods. Three or more say that the block itself has
   the progression's step as its period; the ends of the stretch around the block and of
   the one around the progression are then one period of the run apart.
4. A candidate is extended to both sides by comparing ranks, and kept if long enough.

Words are numbered per text, so texts are worked on many at once and never meet. Each
text is one row and stays in its task: there is no shuffle. Memory is some
``4 log2(n)`` bytes a word for the longest texts.

Defined cases: a null or empty text has no word and no run; a row without an id is a row
like others; equal rows get equal results, one each; an empty table gives an empty one;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm import wordhash

#: Periods that a run holds at least, and words.
EXPONENT, LEAST_WORDS = 4, 6

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def numbered(words: wordhash.Words) -> np.ndarray:
    """For every word how many words sort before it, by text and then by hash."""
    text = np.repeat(np.arange(len(words)), np.diff(words.first))
    order = np.lexsort((words.hash, text))
    same = (text[order][1:] == text[order][:-1]) & (words.hash[order][1:] == words.hash[order][:-1])
    return _ranks(order, ~same)


def _ranks(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The rank of each place: the first index of its group in the sorted order."""
    heads = np.flatnonzero(np.concatenate(([True], new)))
    out = np.empty(len(order), np.int32)
    out[order] = np.repeat(heads, np.diff(np.append(heads, len(order))))
    return out


def doubled(first: np.ndarray, deepest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks by the first 2**k words for k = 0, 1, ..., and the places in the last one's order.

    Ends at blocks of ``deepest`` words, or before if no longer block comes twice.
    """
    n = len(first)
    levels, order = [first], np.argsort(first, kind="stable")
    while 1 << len(levels) <= deepest:
        step = 1 << (len(levels) - 1)
        last = levels[-1].astype(np.int64)
        if not _repeated(last).any():
            break
        key = last * (n + 1)
        key[: max(n - step, 0)] += last[step:] + 1
        order = np.argsort(key, kind="stable")
        levels.append(_ranks(order, np.diff(key[order]) != 0))
    return levels, order


def _repeated(rank: np.ndarray) -> np.ndarray:
    return np.bincount(rank, minlength=len(rank)) > 1


class WaveletTree:
    """Numbers 0 .. n - 1 in some order, asked about ranges of that order."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []  # of each bit, zeros before each index
        now = values.astype(np.int32)
        for bit in range(self.bits - 1, -1, -1):
            one = (now >> bit) & 1
            zeros = np.zeros(len(now) + 1, np.int32)
            np.cumsum(1 - one, out=zeros[1:])
            self.zeros.append(zeros)
            now = np.concatenate((now[one == 0], now[one == 1]))

    def less(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many numbers of each range [low, high) are less than a given one."""
        count, all_of = np.zeros(len(low), np.int64), high - low
        for k, zeros in enumerate(self.zeros):
            bit = (than >> (self.bits - 1 - k)) & 1 == 1
            a, b = zeros[low], zeros[high]
            count += np.where(bit, b - a, 0)
            low, high = np.where(bit, zeros[-1] + low - a, a), np.where(bit, zeros[-1] + high - b, b)
        return np.where(than >> self.bits > 0, all_of, count)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number of each range [low, high) that has ``k`` smaller ones in it."""
        out = np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            a, b = zeros[low], zeros[high]
            bit = k >= b - a
            out |= np.where(bit, 1 << (self.bits - 1 - level), 0)
            k = np.where(bit, k - (b - a), k)
            low, high = np.where(bit, zeros[-1] + low - a, a), np.where(bit, zeros[-1] + high - b, b)
        return out


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Equal words from places a < b on (step 1), or before them (step -1)."""
    n = len(levels[0])
    total = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size, rank = 1 << k, levels[k]
        active = np.arange(len(a))
        while len(active):
            shift = total[active] if step > 0 else -total[active] - size
            low, high = a[active] + shift, b[active] + shift
            inside = (low >= 0) & (high < n)
            active, low, high = active[inside], low[inside], high[inside]
            active = active[rank[low] == rank[high]]
            total[active] += size
            if k < len(levels) - 1:
                break
    return total


def _candidates(levels: list[np.ndarray], tree: WaveletTree, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, period) pairs of the blocks of 2**k words."""
    size, rank = 1 << k, levels[k]
    block = np.arange(0, len(rank), size)
    counts = np.bincount(rank, minlength=len(rank))
    block = block[counts[rank[block]] > 1]
    low = rank[block].astype(np.int64)
    number = counts[low]
    before = tree.less(low, low + number, block + size)

    def occurrence(which: np.ndarray, nth: int) -> np.ndarray:
        """The nth place in the window of some blocks, or a place beyond every window."""
        out = np.full(len(which), 1 << 62, np.int64)
        has = np.flatnonzero(before[which] + nth < number[which])
        at = which[has]
        out[has] = tree.smallest(low[at], low[at] + number[at], before[at] + nth)
        return out

    which = np.arange(len(block))
    places = []
    for nth in range(3):
        place = occurrence(which, nth)
        near = place < block[which] + 2 * size
        which, place = which[near], place[near]
        places.append((which, place))
    (one, p1), (two, p2), (three, _) = places
    few = ~np.isin(one, three)
    few2 = ~np.isin(two, three)
    blocks = [block[one[few]], block[two[few2]]]
    periods = [p1[few] - block[one[few]], p2[few2] - block[two[few2]]]
    if len(three):
        at, first = block[three], p1[np.searchsorted(one, three)]
        step = p2[np.searchsorted(two, three)] - first
        apart = (first + common(levels, first, first + step, 1)) - (at + common(levels, at, at + step, 1))
        good = (apart >= size) & (apart < 2 * size)
        blocks.append(at[good])
        periods.append(apart[good])
    return np.concatenate(blocks), np.concatenate(periods)


def find_runs(words: wordhash.Words, exponent: int = EXPONENT,
              least_words: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and then period; places count over all texts."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(words.hash):
        return none
    deepest = int(np.diff(words.first).max()) // exponent
    levels, order = doubled(numbered(words), deepest)
    tree = WaveletTree(order)
    found = [_candidates(levels, tree, k) for k in range(len(levels)) if 1 << k <= deepest]
    if not found:
        return none
    block, period = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
    end = block + period + common(levels, block, block + period, 1)
    start = block - common(levels, block, block + period, -1)
    long = end - start >= np.maximum(least_words, exponent * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # A stretch is found with its smallest period and perhaps with multiples of it.
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _rows(exponent: int, least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words in wordhash.chunks(batch.column("text"), fold_case=False):
                start, end, period = find_runs(words, exponent, least_words)
                n = len(words.hash)
                covered = np.zeros(n + 1, np.int64)
                np.add.at(covered, start + period, 1)
                np.add.at(covered, end, -1)
                stays = np.cumsum(covered)[:n] == 0
                text = np.searchsorted(words.first, start, "right") - 1
                raw = words.data.tobytes()
                kept = np.flatnonzero(stays)
                tokens = [raw[a:b] for a, b in zip(words.start[kept].tolist(), words.end[kept].tolist(),
                                                   strict=True)]
                cuts = np.searchsorted(kept, words.first).tolist()
                runs = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (start - words.first[text], end - start, period)], fields=list(RUN))
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(at, len(words)).cast(pa.int64()),
                    "n_words": pa.array(np.diff(words.first).astype(np.int64)),
                    "runs": pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(text, np.arange(len(words) + 1)).astype(np.int32)), runs),
                    "collapsed": pa.array([b" ".join(tokens[a:b]) for a, b in zip(
                        cuts[:-1], cuts[1:], strict=True)], pa.binary()).cast(pa.string())})

    return run


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    ``runs`` are in the order of their start, then period; ``collapsed`` is the text
    without the words of any run after its first period, words joined by one space.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_rows(exponent, least_words), RUNS)
