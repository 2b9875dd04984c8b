"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification.

1. Each text becomes its set of distinct word shingles, a digest of that set and the band
   keys of its circulant MinHash signature.
2. Texts of equal sets are one class; only the class's least id goes on.
3. Classes that share a band key are candidates. They are joined by stars (each to the
   least id of the bucket), whose components are the candidate groups, so a bucket of any
   size makes as many links as it has members.
4. Each group's full sets meet in one task, once, and every pair in it is compared
   exactly by a matrix product. What leaves the task is a spanning star, not the pairs.
   A group too large for one task is cut into blocks and each two blocks meet in a task.

Defined cases: a null or empty text has an empty set and is linked with nothing; a text of
fewer words than a shingle has one shingle, its whole sequence; rows of one doc_id are
one document; a row with a null doc_id is linked with nothing and kept; every row gives
one row, repeated rows included; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

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
LINK_PERCENT = 85
#: With 40 bands of 8 coordinates a pair of likeness 0.85 is missed with chance 3e-6.
BANDS, BAND_ROWS = 40, 8
#: Documents, and shingles, of a candidate group that meet in one task.
BLOCK_DOCS = 1500
BLOCK_SHINGLES = 3_000_000

SKETCH = "doc_id long, n_shingles long, digest binary, bands array<long>"


def sketches(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for at, words in wordhash.chunks(batch.column("text"), fold_case=True):
                sets = [wordhash.shingles(words.hash[a:b], width)
                        for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                keys = np.zeros((0, bands), np.uint64)
                if len(full):
                    first = np.concatenate(([0], np.cumsum(sizes[full])))
                    keys = wordhash.band_keys(wordhash.circulant_signatures(
                        np.concatenate(sets), first, bands * rows), rows)
                ends = np.concatenate(([0], np.cumsum(np.where(sizes > 0, bands, 0))))
                yield pa.record_batch({
                    "doc_id": ids.slice(at, len(sets)).cast(pa.int64()),
                    "n_shingles": pa.array(sizes),
                    "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                                        for s in sets], pa.binary()),
                    "bands": pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(keys.ravel().view(np.int64))),
                })

    return run


def full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words in wordhash.chunks(batch.column("text"), fold_case=True):
                sets = [wordhash.shingles(words.hash[a:b], width).tobytes()
                        for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
                kept = batch.drop_columns(["text"]).slice(at, len(sets))
                yield kept.append_column("shingles", pa.array(sets, pa.binary()))

    return run


def shared_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many elements each two sets have in common, as a matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    new = np.concatenate(([True], elements[1:] != elements[:-1]))
    column = np.cumsum(new) - 1
    common = np.bincount(column)[column] > 1  # an element of one set is shared by no two
    owner, column = owner[common], np.unique(column[common], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [low, low + columns])
        has = np.zeros((len(sets), columns), np.float32)
        has[owner[a:b], column[a:b] - low] = 1
        out += has @ has.T
    return out


def stars(ids: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The least id reachable from each row over a symmetric matrix of links."""
    label = ids
    while True:
        least = np.where(linked, label[None, :], label[:, None]).min(axis=1)
        if (least == label).all():
            return label
        label = least


def links_in(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["doc_id"].to_numpy(np.int64)
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        sizes = np.array([len(s) for s in sets], np.int64)
        both = shared_counts(sets).astype(np.int64)
        linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
        root = stars(ids, linked)
        away = root != ids
        return pd.DataFrame({"node": ids[away], "root": root[away]})

    return run


def candidate_groups(reps: DataFrame) -> DataFrame:
    """(node, root): groups of ids joined by equal band keys; reps: (doc_id, bands)."""
    keys = reps.select("doc_id", F.explode("bands").alias("band"))
    heads = keys.groupBy("band").agg(
        F.min("doc_id").alias("head"), F.max("doc_id").alias("last")).where("head < last")
    links = keys.join(heads.drop("last"), "band").where("doc_id <> head")
    return components(links.select(F.col("doc_id").alias("hi"), F.col("head").alias("lo")))


def verified(groups: DataFrame, docs: DataFrame, sizes: DataFrame, width: int, percent: int,
             block_docs: int, block_shingles: int) -> DataFrame:
    """(node, root): the components of the exact links inside candidate groups."""
    cut = groups.join(sizes, groups["node"] == sizes["doc_id"]).groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / block_docs),
                   F.ceil(F.sum("n_shingles") / block_shingles)).cast("int").alias("blocks"))
    cut = written(cut)
    members = groups.join(cut, "root").select(
        F.col("node").alias("doc_id"), "root", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    rows = members.join(docs, "doc_id").select("doc_id", "root", "blocks", "block", "text")
    sets = rows.mapInArrow(full_sets(width), "doc_id long, root long, blocks int, block int, "
                                             "shingles binary")
    # A block meets every other one; a group of one block is met as it is.
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.filter(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("block")))
    met = sets.withColumn("other", F.explode(others)).select(
        "root", "blocks", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"), "doc_id", "shingles")
    found = met.groupBy("root", "blocks", "low", "high")
    schema = "node long, root long"
    whole = written(found.applyInPandas(_tagged(percent), f"{schema}, final boolean"))
    if not cut.where("blocks > 1").head(1):
        return whole.select("node", "root")
    parts = components(whole.where("not final").select(
        F.col("node").alias("hi"), F.col("root").alias("lo")))
    return whole.where("final").select("node", "root").unionByName(parts.select("node", "root"))


def _tagged(percent: int):
    inner = links_in(percent)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return inner(group).assign(final=bool(key[1] == 1))

    return run


def near_duplicates(docs: DataFrame, percent: int = LINK_PERCENT, width: int = SHINGLE_WORDS,
                    bands: int = BANDS, rows: int = BAND_ROWS, block_docs: int = BLOCK_DOCS,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    drawn = written(docs.mapInArrow(sketches(width, bands, rows), SKETCH))
    filled = drawn.where("doc_id is not null and n_shingles > 0")
    classes = filled.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = filled.join(classes, "digest").where("doc_id = rep")
    groups = candidate_groups(reps.select("doc_id", "bands"))
    sizes = filled.groupBy("doc_id").agg(F.sum("n_shingles").alias("n_shingles"))
    roots = verified(groups, docs, sizes, width, percent, block_docs, block_shingles)
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("root", "rep", "doc_id"))
    known = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    # An empty set gets a key of its own, so that no task sees all empty texts.
    key = F.when(F.col("n_shingles") > 0, F.col("digest")).otherwise(
        F.col("doc_id").cast("string").cast("binary"))
    out = drawn.select("doc_id", "n_shingles", key.alias("digest")).join(known, "digest", "left")
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose document stays: one of each group; all columns are kept."""
    found = near_duplicates(docs, **settings)
    return docs.join(found.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti")
