"""Stages of the corpus pipeline against brute force."""

from __future__ import annotations

import random

from test_operators import SCHEMA, brute_components, brute_leaks, doc_rows, near_copies, shingle_set

import corpus_pipeline
from greenledger.llm import tables


def between(n, seed=11):
    """Pairs of texts of likeness 0.80 to 0.85: one copy has a run of other words at its end."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = [f"p{k}w{j}" for j in range(104)]
        end = [f"q{k}w{j}" for j in range(rng.randrange(9, 12))]
        rows += [(1000 + 2 * k, " ".join(words)), (1001 + 2 * k, " ".join(words[: -len(end)] + end))]
    return rows


def kept_ids(stage, spark, rows, sf_dir):
    docs = spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], SCHEMA)
    out = stage(spark, docs, sf_dir)
    assert out.columns == docs.columns
    return sorted(r.doc_id for r in out.select("doc_id").collect())


def test_near_duplicate_stage_equals_brute_force_at_80(spark, sf_dir):
    pairs = between(40)
    for (_, a), (_, b) in zip(pairs[::2], pairs[1::2], strict=True):
        x, y = shingle_set(a), shingle_set(b)
        assert 0.80 <= len(x & y) / len(x | y) < 0.85
    for rows in (near_copies(60) + pairs, doc_rows(spark, sf_dir)):
        got = kept_ids(corpus_pipeline.drop_near_duplicates, spark, rows, sf_dir)
        assert got == sorted(d for d, (_, _, kept) in brute_components(rows, 80).items() if kept)


def test_leak_stage_equals_brute_force(spark, sf_dir):
    rows = doc_rows(spark, sf_dir)
    items = [tuple(r) for r in tables.read(spark, sf_dir, "benchmark", "item_id", "text").collect()]
    held = {d for d, *_ in brute_leaks(rows, items)}
    got = kept_ids(corpus_pipeline.drop_benchmark_leaks, spark, rows, sf_dir)
    assert held and got == sorted(d for d, _ in rows if d not in held)
