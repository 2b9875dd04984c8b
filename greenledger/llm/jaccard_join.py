"""N-gram Jaccard join: an exact self-join of shingle sets by T-occurrence search.

Two sets are linked when they share at least ``percent`` hundredths of their union. A set
of n elements then shares at least T = ceil(percent n / 100) with every partner of its
size or less: partners are the sets that occur at least T times in its inverted lists.

1. A count sketch of fixed size over all shingles gives one order of the shingles that
   puts those of many documents last. Any order is right; this one keeps lists short.
2. Texts of equal sets are one class. Linked sets share one of their first n - T + 1
   elements in that order, so only these are shuffled, one row each.
3. All sets that hold one element meet at the element's head, the one of them that hashes
   least. Sets with many first elements in common have few heads, and a group never holds
   more than the sets that share a first element with its head: links are not closed
   transitively before they are verified.
4. Bitmaps of two to four bits an element tell for most sets that nothing in their cell
   can be linked with them: a bit that one lacks is an element that it lacks.
5. In each cell every set that is left searches the ones that are not larger by
   DivideSkip: its short inverted lists are merged by a heap that skips ahead, the long
   ones are probed by binary search for what the merge left over, and what reaches the
   overlap that both sizes ask for is linked. A task gives a spanning star and numbers of
   links, no pairs. A cell too large for one task is cut into blocks and each two meet.
6. The components of all stars are the result.

Defined cases: a null or empty text has an empty set and is linked with nothing; a text of
fewer words than a shingle has one shingle, its whole sequence; equal rows are one set;
different texts under one doc_id are different sets under one name; a row with a null
doc_id is linked with nothing; every row gives one row, repeated rows included; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm import wordhash
from greenledger.llm.components import components
from greenledger.llm.tables import written

SHINGLE_WORDS = 5
#: Likeness from which documents are linked, in hundredths.
LINK_PERCENT = 80
#: The count sketch: rows of counters, and bits of a row's index.
SKETCH_ROWS, SKETCH_BITS = 3, 17
#: Documents, and shingles, of a cell that meet in one task.
BLOCK_DOCS = 1500
BLOCK_SHINGLES = 3_000_000
#: Tasks that as many documents, or shingles, of small cells are dealt over.
SHARE = 8
#: Cost of a step of the heap against a probe, for the choice of the long lists.
HEAP_COST = 0.0085

DRAWN = "doc_id long, tag int, n_shingles long, digest binary, first array<long>, bits binary"
NEAR = "doc_id long, tag int, head long, cell long"
FOUND = "node long, root long, links long"

_U = np.uint64


def _sets(batches: Iterator[pa.RecordBatch], width: int):
    """(batch, first row, shingle sets) of a bounded number of texts at a time."""
    for batch in batches:
        for at, words in wordhash.chunks(batch.column("text"), fold_case=True):
            yield batch, at, [wordhash.shingles(words.hash[a:b], width)
                              for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


def _slots(elements: np.ndarray) -> list[np.ndarray]:
    """The counter of each element in each row of the sketch."""
    shift = _U(64 - SKETCH_BITS)
    return [(wordhash.mix64(elements + _U(row + 1)) >> shift).astype(np.int64) + (row << SKETCH_BITS)
            for row in range(SKETCH_ROWS)]


def _counted(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH_ROWS << SKETCH_BITS, np.int64)
        for _, _, sets in _sets(batches, width):
            for slots in _slots(np.concatenate(sets)):
                np.add.at(counts, slots, 1)
        used = np.flatnonzero(counts)
        yield pa.record_batch({"slot": pa.array(used.astype(np.int32)), "n": pa.array(counts[used])})

    return run


def count_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """How many documents hold a shingle, at most, by counter: an array of fixed size."""
    rows = docs.mapInArrow(_counted(width), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = rows.toPandas()  # no more rows than counters
    counts = np.zeros(SKETCH_ROWS << SKETCH_BITS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    return counts


def overlap(size: int, percent: int) -> int:
    """Elements that a set shares at least with a linked one of its size or less."""
    return -(-percent * size // 100)


def bitmap(elements: np.ndarray) -> bytes:
    """One bit for each element, of at least two for each; half as many are its two halves in one."""
    size = max(64, 1 << (2 * len(elements) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(elements & _U(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _drawn(width: int, percent: int, counts: np.ndarray):
    def first(elements: np.ndarray, seen: np.ndarray) -> np.ndarray:
        if not len(elements):
            return elements
        n = len(elements) - overlap(len(elements), percent) + 1
        order = np.lexsort((elements, seen))[:n]
        return elements[order[seen[order] > 1]]  # what is counted once is nowhere else

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at, sets in _sets(batches, width):
            sizes = np.array([len(s) for s in sets], np.int64)
            seen = np.minimum.reduce([counts[s] for s in _slots(np.concatenate(sets))])
            parts = [first(s, c) for s, c in zip(sets, np.split(seen, np.cumsum(sizes)[:-1]), strict=True)]
            ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").slice(at, len(sets)),
                "tag": batch.column("tag").slice(at, len(sets)),
                "n_shingles": pa.array(sizes),
                "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                                   pa.binary()),
                "first": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                                  pa.array(np.concatenate(parts).view(np.int64))),
                "bits": pa.array([bitmap(s) for s in sets], pa.binary())})

    return run


def merge_skip(lists: list[tuple[list[int], list[int]]], need: int) -> list[tuple[int, int, int]]:
    """Ranges of places that stand in at least ``need`` lists, with the number of lists.

    A list is given by the starts and ends of its runs of consecutive places, in order.
    The heap holds the next place of every list. When fewer than ``need`` lists stand at
    the least place, the need - 1 least lists jump to the place of the next one: nothing
    before it can stand in enough lists.
    """
    heap = [(starts[0], i) for i, (starts, _) in enumerate(lists)]
    heapify(heap)
    at = [0] * len(lists)
    found = []
    while len(heap) >= need:
        place = heap[0][0]
        popped = []
        while heap and heap[0][0] == place:
            popped.append(heappop(heap)[1])
        if len(popped) >= need:
            target = min(lists[i][1][at[i]] for i in popped)
            if heap:
                target = min(target, heap[0][0])
            found.append((place, target, len(popped)))
        else:
            while heap and len(popped) < need - 1:
                popped.append(heappop(heap)[1])
            if not heap:
                break
            target = heap[0][0]
        for i in popped:
            starts, ends = lists[i]
            k = bisect_right(ends, target, at[i])  # the first run that ends after the target
            if k < len(ends):
                at[i] = k
                heappush(heap, (max(starts[k], target), i))
    return found


class InvertedLists:
    """Inverted lists of some sets, which stand in the order of their sizes."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.n = len(sets)
        elements = np.concatenate(sets)
        owner = np.repeat(np.arange(self.n), self.sizes)
        order = np.argsort(elements, kind="stable")
        element, owner = elements[order], owner[order]
        token = np.cumsum(np.concatenate(([0], element[1:] != element[:-1])))
        shared = np.bincount(token)[token] > 1
        self.owner, token = owner[shared], token[shared]
        token = np.cumsum(np.concatenate(([0], np.diff(token) != 0)))[: len(token)]
        #: Token and owner in one number, in order: an inverted list is a range of it.
        self.keys = token * self.n + self.owner
        starts = np.ones(len(token), bool)
        starts[1:] = (np.diff(token) != 0) | (np.diff(self.owner) != 1)
        self.run = np.cumsum(starts) - 1
        begin = np.flatnonzero(starts)
        self.starts = self.owner[begin].tolist()
        self.ends = (self.owner[np.append(begin[1:], len(token)) - 1] + 1).tolist() if len(token) else []
        by_owner = np.argsort(self.owner, kind="stable")
        self.tokens = token[by_owner]
        self.of = np.searchsorted(self.owner[by_owner], np.arange(self.n + 1))

    def _clipped(self, a: int, b: int, low: int, high: int) -> tuple[list[int], list[int]]:
        first, last = self.run[a], self.run[b - 1] + 1
        starts, ends = self.starts[first:last], self.ends[first:last]
        starts[0], ends[-1] = max(starts[0], low), min(ends[-1], high)
        return starts, ends

    def partners(self, x: int, percent: int) -> np.ndarray:
        """The sets before ``x`` that are linked with it."""
        none = np.zeros(0, np.int64)
        size = int(self.sizes[x])
        least = overlap(size, percent)
        low = int(np.searchsorted(self.sizes, least))
        tokens = self.tokens[self.of[x] : self.of[x + 1]]
        if len(tokens) < least or low >= x:
            return none
        a = np.searchsorted(self.keys, tokens * self.n + low)
        b = np.searchsorted(self.keys, tokens * self.n + x)
        full = np.flatnonzero(b > a)
        if len(full) < least:
            return none
        full = full[np.argsort((b - a)[full], kind="stable")]
        longest = int((b - a)[full[-1]])
        n_long = min(least - 1, int(least / (HEAP_COST * math.log2(longest) + 1)))
        short, long = full[: len(full) - n_long], full[len(full) - n_long :][::-1]
        ranges = merge_skip([self._clipped(a[i], b[i], low, x) for i in short.tolist()], least - n_long)
        if not ranges:
            return none
        begin, end, count = (np.array(v) for v in zip(*ranges, strict=True))
        places = np.repeat(begin - np.cumsum(end - begin) + (end - begin), end - begin) + np.arange(
            (end - begin).sum())
        count = np.repeat(count, end - begin)
        for k in range(0, len(long), 64):  # the shortest of the long lists come last
            probed = tokens[long[k : k + 64], None] * self.n + places[None, :]
            at = np.searchsorted(self.keys, probed)
            count = count + (self.keys[np.minimum(at, len(self.keys) - 1)] == probed).sum(axis=0)
            left = max(0, len(long) - k - 64)
            stay = count + left >= least
            places, count = places[stay], count[stay]
        union = size + self.sizes[places] - count
        return places[100 * count >= percent * union]


def linked(ids: np.ndarray, sets: list[np.ndarray], percent: int, counts_here) -> tuple[np.ndarray, np.ndarray]:
    """(least id reachable, number of links) of each set; ``counts_here(x, ys)`` says which
    links of x are counted in this group."""
    order = np.lexsort((ids, [len(s) for s in sets]))
    lists = InvertedLists([sets[i] for i in order])
    label, links = ids[order].copy(), np.zeros(len(ids), np.int64)
    for x in range(len(order)):
        ys = lists.partners(x, percent)
        if not len(ys):
            continue
        both = np.unique(np.append(label[ys], label[x]))
        if len(both) > 1:
            label[np.isin(label, both)] = both[0]
        ys = ys[counts_here(order[x], order[ys])]
        links[x] += len(ys)
        links[ys] += 1
    out_label, out_links = np.empty_like(label), np.empty_like(links)
    out_label[order], out_links[order] = label, links
    return out_label, out_links


def _one_group(group: pd.DataFrame, sets: list[np.ndarray], percent: int) -> pd.DataFrame:
    ids = group["doc_id"].to_numpy(np.int64)
    head, size_class, low, high, blocks = (group[c].iat[0] for c in ("head", "cell", "low", "high", "blocks"))
    block, own = group["block"].to_numpy(), group["own"].to_numpy()
    heads = list(group["heads"])
    # Sets that share several heads meet in several groups; the least one counts their link.
    least = np.array([h.min() == head for h in heads])
    # Two sets of one block meet in each task of the block; the one with the next block counts.
    mine = np.where(block == low, high == (low + 1) % blocks, low == (high + 1) % blocks)

    def counts_here(x: int, ys: np.ndarray) -> np.ndarray:
        counted = least[ys] | least[x]
        for k in np.flatnonzero(~counted):
            counted[k] = np.intersect1d(heads[x], heads[ys[k]]).min() == head
        if blocks > 1:
            counted &= (block[ys] != block[x]) | mine[x]
        return counted & (own[ys] | own[x])  # two of the class below meet there too

    root, links = linked(ids, sets, percent, counts_here)
    told = (root != ids) | (links > 0)
    return pd.DataFrame({"node": ids[told], "root": root[told], "links": links[told]})


def _search(width: int, percent: int):
    def run(task: pd.DataFrame) -> pd.DataFrame:
        sets = [s for _, words in wordhash.chunks(pa.array(task["text"], pa.large_string()), fold_case=True)
                for s in (wordhash.shingles(words.hash[a:b], width)
                          for a, b in zip(words.first[:-1], words.first[1:], strict=True))]
        parts = [_one_group(task.iloc[rows], [sets[i] for i in rows], percent)
                 for rows in task.groupby(["head", "cell"], sort=False).indices.values()]
        return pd.concat(parts, ignore_index=True)

    return run


def maybe_linked(bits: list[bytes], sizes: np.ndarray, percent: int) -> np.ndarray:
    """The sets that may be linked with another, by their bitmaps.

    Each bit of one set that another lacks is an element that it lacks, which bounds what
    they share from above.
    """
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    least = min(len(b) for b in bits)
    rows = np.zeros((len(bits), least), np.uint8)
    for k, i in enumerate(order):
        rows[k] = np.bitwise_or.reduce(np.frombuffer(bits[i], np.uint8).reshape(-1, least), axis=0)
    rows = rows.view(np.uint64)
    near = np.zeros(len(bits), bool)
    for x in range(1, len(bits)):
        low = int(np.searchsorted(sizes[:x], overlap(int(sizes[x]), percent)))
        if low == x:
            continue
        mine, theirs = rows[x], rows[low:x]
        shared = np.minimum(sizes[x] - np.bitwise_count(mine & ~theirs).sum(axis=1, dtype=np.int64),
                            sizes[low:x] - np.bitwise_count(theirs & ~mine).sum(axis=1, dtype=np.int64))
        may = np.flatnonzero(100 * shared >= percent * (sizes[x] + sizes[low:x] - shared))
        near[low + may] = True
        near[x] |= len(may) > 0
    out = np.empty(len(bits), bool)
    out[order] = near
    return out


def _near(percent: int):
    def run(task: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, group in task.groupby(["head", "cell"], sort=False):
            may = maybe_linked(list(group["bits"]), group["n_shingles"].to_numpy(np.int64), percent)
            parts.append(group.loc[may, ["doc_id", "tag", "head", "cell"]])
        return pd.concat(parts, ignore_index=True)

    return run


def groups(drawn: DataFrame) -> DataFrame:
    """(doc_id, tag, n_shingles, bits, heads) of the classes that share a first element with another."""
    reps = drawn.groupBy("digest").agg(
        F.min(F.struct("doc_id", "tag", "n_shingles", "first", "bits")).alias("rep")).select("rep.*")
    firsts = reps.select("doc_id", "tag", F.explode("first").alias("element"))
    shared = firsts.groupBy("element").agg(
        F.min(F.xxhash64("doc_id", "tag")).alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    heads = firsts.join(shared, "element").groupBy("doc_id", "tag").agg(F.collect_set("head").alias("heads"))
    return reps.drop("first").join(heads, ["doc_id", "tag"])


def cells(members: DataFrame, percent: int) -> DataFrame:
    """(doc_id, tag, n_shingles, head, own, cell): members by group and class of sizes.

    Linked sets differ in size by no more than the factor 100 / percent, the width of a
    class, so each set goes to the cell of its class and to that of the next one.
    """
    width = math.log(100 / percent) * (1 + 1e-9) or 1e-9  # a bit wider, so that rounding splits no pair
    size_class = F.floor(F.log("n_shingles") / F.lit(width))
    headed = members.select("doc_id", "tag", "n_shingles", F.explode("heads").alias("head"), size_class.alias("class"))
    return headed.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("own")).withColumn(
        "cell", F.col("class") + F.when(F.col("own"), 0).otherwise(1)).drop("class")


def in_tasks(placed: DataFrame, block_docs: int, block_shingles: int) -> DataFrame:
    """Rows of cells with the tasks they go to: (.., blocks, block, task, low, high).

    A cell of one set, or without one of its own class, has nothing to compare and drops
    out. Small cells share a task; a large one is cut into blocks, and each two blocks meet.
    """
    cut = written(placed.groupBy("head", "cell").agg(
        F.count("*").alias("docs"), F.bool_or("own").alias("own"), F.sum("n_shingles").alias("shingles"),
    ).where("docs > 1 and own").select("head", "cell", "docs", "shingles", F.greatest(
        F.ceil(F.col("docs") / block_docs), F.ceil(F.col("shingles") / block_shingles)).cast("int").alias("blocks")))
    small = cut.where("blocks = 1").agg(F.sum("docs"), F.sum("shingles")).first()
    tasks = 1 + int(SHARE * max((small[0] or 0) / block_docs, (small[1] or 0) / block_shingles))
    rows = placed.join(cut.drop("docs", "shingles"), ["head", "cell"]).withColumn(
        "block", F.pmod(F.hash("doc_id", "tag"), F.col("blocks")))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.filter(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("block")))
    cell = F.xxhash64("head", "cell")
    return rows.withColumn("other", F.explode(others)).select(
        "*", F.when(F.col("blocks") == 1, F.pmod(cell, F.lit(tasks))).otherwise(cell).alias("task"),
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).drop("other")


TASK = ("task", "blocks", "low", "high")


def searched(members: DataFrame, docs: DataFrame, width: int, percent: int, block_docs: int,
             block_shingles: int) -> DataFrame:
    """(node, root, links): stars of the links inside each cell."""
    doc = ["doc_id", "tag"]
    placed = cells(members, percent)
    sketched = in_tasks(placed, block_docs, block_shingles).join(members.select(*doc, "bits"), doc)
    near = written(sketched.groupBy(*TASK).applyInPandas(_near(percent), NEAR).distinct())
    left = in_tasks(placed.join(near, [*doc, "head", "cell"]), block_docs, block_shingles)
    at = ("head", "cell", "own", "block", *TASK)
    kept = left.groupBy(*doc).agg(F.collect_list(F.struct(*at)).alias("at"))
    texts = docs.join(kept.join(members.select(*doc, "heads"), doc), doc).dropDuplicates(doc)
    rows = texts.select("doc_id", "heads", "text", F.inline("at"))
    return rows.groupBy(*TASK).applyInPandas(_search(width, percent), FOUND)


def jaccard_join(docs: DataFrame, percent: int = LINK_PERCENT, width: int = SHINGLE_WORDS,
                 block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per row of ``docs``.

    ``n_links`` is the number of other sets that the document's set is linked with.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.hash("text").alias("tag"), "text")
    counts = count_sketch(docs.select("text"), width)
    drawn = written(docs.mapInArrow(_drawn(width, percent, counts), DRAWN))
    filled = drawn.where("doc_id is not null and n_shingles > 0")
    members = written(groups(filled))
    found = written(searched(members, docs, width, percent, block_docs, block_shingles))
    roots = components(found.select(F.col("node").alias("hi"), F.col("root").alias("lo")))
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = filled.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    known = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").join(
        links.withColumnRenamed("node", "rep"), "rep", "left")
    # An empty set gets a key of its own, so that no task sees all empty texts.
    key = F.when(F.col("n_shingles") > 0, F.col("digest")).otherwise(
        F.col("doc_id").cast("string").cast("binary"))
    out = drawn.select("doc_id", "n_shingles", key.alias("digest")).join(known, "digest", "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return out.select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(
            F.coalesce("root", "rep", "doc_id")).alias("component_id"),
        F.when(alone, F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"))
