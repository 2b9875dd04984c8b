"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are partitioned by size. For each size class a document is cut into overlapping
windows of twice the class, so an item that is somewhere in a long text fills a quarter
of some window at least, and its MinHash coordinates agree with the window's often: of 64
coordinates at least one does, with chance 1 - 6e-7 for likeness 0.2. Window signatures
of the larger classes are minima of the smaller ones', so all classes cost one pass. Every
candidate is then verified exactly: the share of the item's shingles in the document.

Items come in blocks of bounded size; each block goes to all tasks, which pass over all
documents once. Nothing else is broadcast and no text is shuffled.

Defined cases: null and empty texts, and items of fewer words than a shingle, match
nothing; a row with a null id is searched and reported with that null id; equal rows give
equal matches; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm import wordhash

SHINGLE_WORDS = 5
CONTAINED = 0.8
COORDINATES = 64
SMALLEST_CLASS = 8
#: Bytes of item texts that go to all tasks at once.
BLOCK_BYTES = 8 << 20

MATCHES = "doc_id long, item_id long, n_shingles long, n_found long, containment double"


def size_class(n_shingles: int) -> int:
    """The power of two from SMALLEST_CLASS on that holds so many shingles."""
    return max(SMALLEST_CLASS, 1 << (n_shingles - 1).bit_length())


class Items:
    """A block of items: exact shingle sets, and an index of MinHash values by size class."""

    def __init__(self, rows: list[tuple[int | None, str | None]]) -> None:
        self.ids: list[int | None] = []
        self.sets: list[np.ndarray] = []
        for item_id, text in rows:
            _, words = next(iter(wordhash.chunks(pa.array([text], pa.string()), True)))
            if len(words.hash) >= SHINGLE_WORDS:
                self.ids.append(item_id)
                self.sets.append(wordhash.shingles(words.hash, SHINGLE_WORDS))
        classes = np.array([size_class(len(s)) for s in self.sets], np.int64)
        self.index = {}
        for size in np.unique(classes):
            members = np.flatnonzero(classes == size)
            first = np.concatenate(([0], np.cumsum([len(self.sets[m]) for m in members])))
            values = wordhash.circulant_signatures(
                np.concatenate([self.sets[m] for m in members]), first, COORDINATES)
            keys = (np.arange(COORDINATES, dtype=np.uint64)[:, None] << np.uint64(32)) | values
            order = np.argsort(keys, axis=None, kind="stable")
            maybe = np.zeros((COORDINATES, 1 << 16), bool)  # by the low half of a value
            maybe[np.arange(COORDINATES)[:, None], values & np.uint32(0xFFFF)] = True
            self.index[int(size)] = (keys.ravel()[order], np.tile(members, COORDINATES)[order], maybe)

    def candidates(self, values: np.ndarray, owner: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) that agree in a coordinate; values: of blocks of SMALLEST_CLASS
        shingles, in order, of the texts in ``owner``."""
        found: set[tuple[int, int]] = set()
        size, largest = SMALLEST_CLASS, max(self.index, default=0)
        while size <= largest:
            if size in self.index:
                keys, items, maybe = self.index[size]
                windows = values.copy()
                same = owner[1:] == owner[:-1]
                windows[:, :-1][:, same] = np.minimum(values[:, :-1], values[:, 1:])[:, same]
                k, at = np.nonzero(maybe[np.arange(COORDINATES)[:, None], windows & np.uint32(0xFFFF)])
                wanted = (k.astype(np.uint64) << np.uint64(32)) | windows[k, at]
                low, high = (np.searchsorted(keys, wanted, s) for s in ("left", "right"))
                for i in np.flatnonzero(high > low):
                    text = int(owner[at[i]])
                    found.update((text, int(m)) for m in items[low[i] : high[i]])
            start = np.concatenate(([True], owner[1:] != owner[:-1]))
            first = np.flatnonzero(start)
            place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
            pair = np.flatnonzero(place % 2 == 0)
            values, owner = np.minimum.reduceat(values, pair, axis=1), owner[pair]
            size *= 2
        return found


def _search(items: Items, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for at, words in wordhash.chunks(batch.column("text"), fold_case=True):
                texts = {i: wordhash.window_hashes(words.hash[a:b], SHINGLE_WORDS) for i, (a, b) in
                         enumerate(zip(words.first[:-1], words.first[1:], strict=True))
                         if b - a >= SHINGLE_WORDS}
                if not texts:
                    continue
                sizes = np.array([len(t) for t in texts.values()])
                blocks = -(-sizes // SMALLEST_CLASS)
                owner = np.repeat(np.fromiter(texts, np.int64), blocks)
                inner = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                first = np.repeat(np.cumsum(sizes) - sizes, blocks) + inner * SMALLEST_CLASS
                values = wordhash.circulant_signatures(
                    np.concatenate(list(texts.values())), np.append(first, sizes.sum()), COORDINATES)
                for text, item in sorted(items.candidates(values, owner)):
                    own = items.sets[item]
                    shared = int(np.isin(own, texts[text]).sum())
                    if shared >= least * len(own):
                        rows.append((ids[at + text], items.ids[item], len(own), shared,
                                     shared / len(own)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            names = ("doc_id", "item_id", "n_shingles", "n_found", "containment")
            yield pa.record_batch({n: pa.array(c, k) for n, c, k in
                                   zip(names, columns, kinds, strict=True)})

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = CONTAINED,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of every item held by a document.

    ``docs``: doc_id, text; ``benchmark``: item_id, text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    found = None
    for block in range(blocks):
        # A stated query set, a bounded block at a time, against all documents.
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        part = docs.mapInArrow(_search(Items([tuple(r) for r in mine.collect()]), least), MATCHES)
        found = part if found is None else found.unionByName(part)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns are kept, and rows without an id."""
    held = leaks(docs, benchmark, **settings).select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti")
