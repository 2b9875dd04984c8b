"""Repeated passages: exact windows of words, found by super-k-mer partitioning.

A window is a fixed number of consecutive words. Its minimiser is the least hash of the
shorter word groups inside it. Consecutive windows with the same minimiser travel as one
packed string (a super-k-mer) to the bucket of that minimiser, so all equal windows meet
in one bucket while a text is sent about three times, compressed, instead of once per
window. A bucket sorts its windows, which finds the least document of each.

Hot minimisers: the occurrences of a minimiser are counted first. One with more than
``HOT`` goes another way: its windows are rows, aggregated before they are shuffled and
joined back by a join whose partitions can be split. Both ways are exact.

Defined cases: a null or empty text has no word; a text shorter than a window loses
nothing; a row with a null doc_id has no smaller document and is none itself; equal rows
get equal results, one each; other columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm import wordhash

WINDOW_WORDS = 13
#: Words in the groups whose least hash is the minimiser.
GROUP_WORDS = 3
#: Occurrences of a minimiser from which its windows are aggregated as rows.
HOT = 100_000
#: Occurrences in one batch from which a minimiser is counted at all.
COUNTED = 8
#: Bytes of packed strings meant for a bucket, and of text packed at once.
BUCKET_BYTES = 16 << 20
PACK_BYTES = 8 << 20
#: A text's packed strings take about so many times its bytes.
PACKED_PER_TEXT = 3.0

RANGES = "doc_id long, key long, low int, high int"
BLOCKS = "bucket int, doc_id binary, key binary, at binary, size binary, packed binary"


def runs(hashes: np.ndarray, width: int, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, number of windows) of each super-k-mer of one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
    small = wordhash.window_hashes(hashes, group)
    span, reach = width - group + 1, 1
    least = small
    while reach < span:  # the least of ``reach`` groups, doubled
        step = min(reach, span - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return least[first], first, np.diff(np.append(first, n))


def _texts(batches: Iterator[pa.RecordBatch], width: int, group: int):
    """Each text's words with its super-k-mers: (doc_id, key, bytes, start, end, runs)."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        for at, words in wordhash.chunks(batch.column("text"), fold_case=False):
            raw = words.data.tobytes()
            for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                if b - a >= width:
                    yield (ids[at + i], keys[at + i], raw, words.start[a:b],
                           words.end[a:b], runs(words.hash[a:b], width, group))


def _count(width: int, group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for *_, found in _texts(iter([batch]), width, group):
                counts.update(found[0].tolist())
            often = [(m, n) for m, n in counts.items() if n >= COUNTED]
            yield pa.record_batch({
                "minimiser": pa.array(np.array([m for m, _ in often], np.uint64).view(np.int64)),
                "n": pa.array([n for _, n in often], pa.int64())})

    return run


def _pack(width: int, group: int, buckets: int, hot: np.ndarray):
    def blocks(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        least = np.concatenate([h[0] for h in held])
        bucket = (least % np.uint64(buckets)).astype(np.int64)
        ids, keys, at = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3))
        strings = [s for h in held for s in h[4]]
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        squeeze = zstandard.ZstdCompressor(level=3)
        rows: list[list] = [[] for _ in range(6)]
        for part in np.split(order, cuts):
            texts = [strings[i] for i in part]
            sizes = np.array([len(t) for t in texts], np.int32)
            cells = (int(bucket[part[0]]), *(squeeze.compress(x.tobytes()) for x in (
                ids[part], keys[part], at[part], sizes)), squeeze.compress(b"".join(texts)))
            for column, cell in zip(rows, cells, strict=True):
                column.append(cell)
        yield pa.record_batch({
            "bucket": pa.array(rows[0], pa.int32()),
            **{name: pa.array(rows[k], pa.binary()) for k, name in enumerate(
                ("doc_id", "key", "at", "size", "packed"), 1)}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for doc, key, raw, start, end, (least, first, n) in _texts(batches, width, group):
            if len(hot):
                cold = ~np.isin(least, hot)
                least, first, n = least[cold], first[cold], n[cold]
            low, high = start[first].tolist(), end[first + n + (width - 2)].tolist()
            strings = [raw[a:b] for a, b in zip(low, high, strict=True)]
            count = len(strings)
            held.append((least, np.full(count, doc, np.int64), np.full(count, key, np.int64),
                         first.astype(np.int32), strings))
            size += int(end[-1] - start[0])
            if size >= PACK_BYTES:
                yield from blocks(held)
                held, size = [], 0
        yield from blocks(held)

    return run


def _unpacked(group: pd.DataFrame):
    """(doc_id, key, first window, word hashes, bounds of each string's words) of a bucket."""
    expand = zstandard.ZstdDecompressor().decompress
    columns: list[list] = [[] for _ in range(3)]
    hashes, sizes, words = [], [], []
    for row in group.itertuples(index=False):
        for column, name, kind in zip(columns, ("doc_id", "key", "at"),
                                      (np.int64, np.int64, np.int32), strict=True):
            column.append(np.frombuffer(expand(getattr(row, name)), kind))
        data = np.frombuffer(expand(row.packed), np.uint8)
        offsets = np.concatenate(([0], np.cumsum(np.frombuffer(expand(row.size), np.int32), dtype=np.int64)))
        for at, stop in wordhash.pieces(offsets):
            part = wordhash.split_words(data, offsets[at : stop + 1], fold_case=False)
            hashes.append(part.hash)
            sizes.append(np.diff(part.first))
            words.append(part)
    first = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    return (*(np.concatenate(c) for c in columns), np.concatenate(hashes), first, words)


def _word_bytes(words: list, index: int, width: int) -> tuple[bytes, ...]:
    """The words of the window that starts at a word of the bucket."""
    for part in words:
        if index < len(part.hash):
            return tuple(part.data[part.start[k] : part.end[k]].tobytes()
                         for k in range(index, index + width))
        index -= len(part.hash)
    raise IndexError(index)


def _repeats(width: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        docs, keys, at, hashes, first, words = _unpacked(group)
        per = np.diff(first) - (width - 1)
        owner = np.repeat(np.arange(len(per)), per)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        start = first[owner] + inner  # the word at which each window starts
        doc = docs[owner]
        window = wordhash.window_hashes(hashes, width)[start]
        order = np.lexsort((doc, window))
        new = np.concatenate(([True], window[order][1:] != window[order][:-1]))
        head = order[np.flatnonzero(new)][np.cumsum(new) - 1]  # least document of the run
        later = doc[order] > doc[head]
        mine, least = order[later], head[later]
        same = np.ones(len(mine), bool)
        for k in range(width):
            same &= hashes[start[mine] + k] == hashes[start[least] + k]
        removed = np.zeros(len(owner), bool)
        removed[mine[same]] = True
        for value in np.unique(window[mine[~same]]):  # different words, one window hash
            members = np.flatnonzero(window == value)
            known: dict = {}
            for i in members:
                known.setdefault(_word_bytes(words, int(start[i]), width), []).append(i)
            for like in known.values():
                low = doc[like].min()
                removed[like] = doc[like] > low
        flagged = np.flatnonzero(removed)
        if not len(flagged):
            return pd.DataFrame({"doc_id": [], "key": [], "low": [], "high": []})
        cut = np.concatenate(([True], (np.diff(flagged) > 1) | (np.diff(owner[flagged]) > 0)))
        begin = flagged[cut]
        finish = flagged[np.append(np.flatnonzero(cut)[1:], len(flagged)) - 1]
        place = at[owner[begin]] + inner[begin]
        return pd.DataFrame({
            "doc_id": docs[owner[begin]], "key": keys[owner[begin]], "low": place,
            "high": place + (finish - begin) + width})

    return run


def _hot_windows(width: int, group: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for doc, key, raw, start, end, (least, first, n) in _texts(iter([batch]), width, group):
                for k in np.flatnonzero(np.isin(least, hot)):
                    low, high = int(first[k]), int(first[k] + n[k])
                    tokens = [raw[start[i] : end[i]] for i in range(low, high + width - 1)]
                    for i in range(high - low):
                        for column, cell in zip(rows, (doc, key, low + i, b" ".join(
                                tokens[i : i + width])), strict=True):
                            column.append(cell)
            yield pa.record_batch({
                "doc_id": pa.array(rows[0], pa.int64()), "key": pa.array(rows[1], pa.int64()),
                "low": pa.array(rows[2], pa.int32()), "window": pa.array(rows[3], pa.binary())})

    return run


def repeats(docs: DataFrame, width: int = WINDOW_WORDS, group: int = GROUP_WORDS,
            hot_from: int = HOT) -> DataFrame:
    """(doc_id, key, low, high): ranges of words that windows of smaller documents cover.

    ``docs``: doc_id, key (of the text) and text.
    """
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null")
    counted = docs.mapInArrow(_count(width, group), "minimiser long, n long")
    # At most the number of all occurrences over ``hot_from`` of them.
    often = counted.groupBy("minimiser").agg(F.sum("n").alias("n")).where(F.col("n") > hot_from)
    hot = np.array([r["minimiser"] for r in often.collect()], np.int64).view(np.uint64)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                  int(size * PACKED_PER_TEXT / BUCKET_BYTES))
    blocks = docs.mapInArrow(_pack(width, group, buckets, hot), BLOCKS)
    found = blocks.groupBy("bucket").applyInPandas(_repeats(width), RANGES)
    if not len(hot):
        return found
    windows = docs.mapInArrow(_hot_windows(width, group, hot),
                              "doc_id long, key long, low int, window binary")
    first = windows.groupBy("window").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least < last")
    covered = windows.join(first.drop("last"), "window").where("doc_id > least")
    return found.unionByName(covered.select(
        "doc_id", "key", "low", (F.col("low") + width).cast("int").alias("high")))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, removed, kept = [], [], []
        for text, ranges in zip(batch.column("text"), batch.column("ranges"), strict=True):
            words = (text.as_py() or "").encode().split()
            total.append(len(words))
            if ranges.is_valid:
                stay = np.ones(len(words), bool)
                for r in ranges.as_py():
                    stay[r["low"] : r["high"]] = False
                words = [words[i] for i in np.flatnonzero(stay)]
            removed.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.record_batch({
            "doc_id": batch.column("doc_id").cast(pa.int64()), "n_words": pa.array(total, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})


def without_repeats(docs: DataFrame, width: int = WINDOW_WORDS, group: int = GROUP_WORDS,
                    hot_from: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text), one row per row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("key"), "text")
    ranges = repeats(docs, width, group, hot_from).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("low", "high")).alias("ranges"))
    # Rows without an id cannot match; a key of their own spreads them.
    joined = docs.join(ranges, ["doc_id", "key"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(
        _without, "doc_id long, n_words long, n_removed long, kept_text string")
