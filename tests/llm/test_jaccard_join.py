"""The n-gram Jaccard join against brute force, by sets and by whole tables."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from greenledger.llm import jaccard_join, queries
from test_operators import ODD, brute_components, doc_rows, near_copies, shingle_set, table


def links_by_hand(rows, percent):
    """Number of other sets that the set of each document is linked with."""
    sets = {d: frozenset(shingle_set(t)) for d, t in rows}
    classes = {s for s in sets.values() if s}
    out = collections.Counter()
    for x in classes:
        for y in classes:
            both = len(x & y)
            if x != y and 100 * both >= percent * (len(x) + len(y) - both):
                out[x] += 1
    return {d: out[s] for d, s in sets.items()}


def joined(df, **settings):
    return {r[0]: tuple(r)[1:] for r in jaccard_join.jaccard_join(df, **settings).collect()}


def by_hand(rows, percent=80):
    links = links_by_hand(rows, percent)
    return {d: (n, root, links[d]) for d, (n, root, _) in brute_components(rows, percent).items()}


def test_query_equals_brute_force(spark, sf_dir):
    got = {r[0]: tuple(r)[1:] for r in queries.op11_jaccard_join(spark, sf_dir).collect()}
    assert got == by_hand(doc_rows(spark, sf_dir))


@pytest.mark.parametrize("block", [3, 7, 1000])
@pytest.mark.parametrize("percent", [60, 80, 100])
def test_a_large_group_in_blocks(spark, block, percent):
    rows = near_copies(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df, percent=percent, block_docs=block) == by_hand(rows, percent)


def test_a_passage_in_every_document_links_nothing(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(d, " ".join(f"x{rng.randrange(10**6)}" for _ in range(60)) + " " + passage) for d in range(80)]
    rows += [(200 + d, rows[d][1] + " more words here") for d in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df) == by_hand(rows)


def test_a_chain_of_likenesses_stays_in_small_groups(spark):
    """Each text shares much with the next: no group holds more than the neighbours of its head."""
    words = [f"w{k}" for k in range(2000)]
    rows = [(d, " ".join(words[20 * d : 20 * d + 80])) for d in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df) == by_hand(rows)
    from pyspark.sql import functions as F
    docs = df.withColumn("tag", F.hash("text"))
    counts = jaccard_join.count_sketch(docs.select("text"), 5)
    drawn = docs.mapInArrow(jaccard_join._drawn(5, 80, counts), jaccard_join.DRAWN)
    heads = jaccard_join.groups(drawn).select(F.explode("heads").alias("head")).groupBy("head").count()
    assert heads.agg(F.max("count")).first()[0] <= 9


def test_odd_rows(spark):
    got = collections.Counter(tuple(r) for r in jaccard_join.jaccard_join(table(spark, ODD)).collect())
    assert sum(got.values()) == len(ODD)
    assert got[(6, 11, 5, 0)] == 2 and got[(5, 11, 5, 0)] == 1 and got[(2, 0, 2, 0)] == 1
    assert got[(None, 11, None, 0)] == 1 and got[(4, 1, 4, 0)] == 1
    none = jaccard_join.jaccard_join(table(spark, []))
    assert none.count() == 0 and none.columns == ["doc_id", "n_shingles", "component_id", "n_links"]


@pytest.mark.parametrize("seed", range(6))
def test_merge_skip_equals_counting(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n, lists = rng.randrange(1, 40), []
        for _ in range(rng.randrange(1, 9)):
            places = sorted(rng.sample(range(n), rng.randrange(1, n + 1)))
            if rng.random() < 0.5:  # long runs
                a = rng.randrange(n)
                places = list(range(a, rng.randrange(a, n) + 1))
            starts = [p for p in places if p - 1 not in places]
            ends = [p + 1 for p in places if p + 1 not in places]
            lists.append((starts, ends))
        need = rng.randrange(1, len(lists) + 1)
        counts = [sum(any(a <= p < b for a, b in zip(*x, strict=True)) for x in lists) for p in range(n)]
        got = {p: c for a, b, c in jaccard_join.merge_skip(lists, need) for p in range(a, b)}
        assert got == {p: c for p, c in enumerate(counts) if c >= need}


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_partners_equal_all_pairs(percent):
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 2**63, 120).astype(np.uint64)
    sets = []
    for _ in range(150):
        keep = base[rng.random(120) < rng.choice([0.5, 0.9, 0.97])]
        sets.append(np.unique(np.append(keep, rng.integers(0, 2**63, rng.integers(1, 12)).astype(np.uint64))))
    sets.sort(key=len)
    lists = jaccard_join.InvertedLists(sets)
    for x in range(len(sets)):
        want = []
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                want.append(y)
        assert sorted(lists.partners(x, percent).tolist()) == want


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_bitmaps_never_hide_a_link(percent):
    rng = np.random.default_rng(percent + 1)
    for _ in range(20):
        base = rng.integers(0, 2**63, rng.integers(1, 150)).astype(np.uint64)
        sets = [np.unique(np.append(base[rng.random(len(base)) < rng.choice([0.5, 0.9, 0.97])],
                                    rng.integers(0, 2**63, rng.integers(1, 12)).astype(np.uint64)))
                for _ in range(30)]
        sizes = np.array([len(s) for s in sets])
        may = jaccard_join.maybe_linked([jaccard_join.bitmap(s) for s in sets], sizes, percent)
        for x, a in enumerate(sets):
            for y, b in enumerate(sets[:x]):
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    assert may[x] and may[y]
    far = [np.arange(1, 200, dtype=np.uint64) * np.uint64(7919 + k) for k in range(5)]
    assert not jaccard_join.maybe_linked([jaccard_join.bitmap(s) for s in far], np.full(5, 199), 80).any()
