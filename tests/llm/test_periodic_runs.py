"""Periodic runs against their definition, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from greenledger.llm import periodic_runs, queries, wordhash
from test_operators import LONG, ODD, doc_rows, table


def brute(words, exponent=4, least=6):
    """(start, length, period) of all runs."""
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def random_words(rng):
    words, size = [], rng.randrange(0, 120)
    letters = rng.choice(("ab", "abc", "abcdefg"))
    while len(words) < size:
        unit = [rng.choice(letters) for _ in range(rng.randrange(1, 14))]
        if rng.random() < 0.5:
            unit = unit[:1] * rng.randrange(1, 20) + unit
        words += (unit * 9)[: rng.randrange(1, 8) * len(unit) + rng.randrange(0, len(unit))]
        words += [rng.choice(letters) for _ in range(rng.randrange(0, 9))]
    return words


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_random_words_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [random_words(rng) for _ in range(40)]
    (_, words), = wordhash.chunks(pa.array([" ".join(t) for t in texts]), fold_case=False)
    start, end, period = periodic_runs.find_runs(words)
    text = np.searchsorted(words.first, start, "right") - 1
    got = [[] for _ in texts]
    for t, s, e, q in zip(text, start, end, period, strict=True):
        got[t].append((int(s - words.first[t]), int(e - s), int(q)))
    assert got == [brute(t) for t in texts]


@pytest.mark.parametrize("exponent, least", [(4, 1), (5, 6), (6, 20)])
def test_other_exponents(exponent, least):
    rng = random.Random(9)
    texts = [random_words(rng) for _ in range(60)]
    (_, words), = wordhash.chunks(pa.array([" ".join(t) for t in texts]), fold_case=False)
    start, end, period = periodic_runs.find_runs(words, exponent, least)
    got = sorted((int(s), int(e - s), int(q)) for s, e, q in zip(start, end, period, strict=True))
    assert got == sorted((int(words.first[k]) + s, n, q) for k, t in enumerate(texts)
                         for s, n, q in brute(t, exponent, least))


def test_wavelet_tree():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        low = rng.integers(0, n, 200)
        high = low + rng.integers(1, n + 1 - low)
        than = rng.integers(0, 2 * n + 2, 200)
        less = tree.less(low, high, than)
        assert less.tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, than)]
        k = rng.integers(0, high - low)
        assert tree.smallest(low, high, k).tolist() == [
            int(np.sort(values[a:b])[j]) for a, b, j in zip(low, high, k)]


def planted(doc, words):
    h = zlib.crc32(str(doc).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_brute_force(spark, sf_dir):
    want = {}
    for doc, text in doc_rows(spark, sf_dir):
        words = [w.decode() for w in (text or "").encode().split()]
        words = planted(doc, words)
        runs = brute(words) if len(words) < 3000 else None
        if runs is None:
            continue
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want[doc] = (len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    assert {d: got[d] for d in want} == want and len(got) >= len(want) > 100
    assert sum(v[0] > 0 for v in want.values()) > 5


def test_odd_rows(spark):
    got = periodic_runs.periodic_runs(table(spark, ODD)).collect()
    assert len(got) == len(ODD) and not any(r["runs"] for r in got)
    assert {r["collapsed"] for r in got if r["doc_id"] in (1, 2, 3)} == {""}
    assert next(r for r in got if r["doc_id"] == 7)["collapsed"] == LONG
    assert periodic_runs.periodic_runs(table(spark, [])).count() == 0


def test_long_texts(spark):
    texts = ["a " * 100_000, ("a " * 50 + "b ") * 2000, " ".join(
        "a" if bin(i).count("1") % 2 else "b" for i in range(50_000)), LONG + " " + LONG]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(df).collect()}
    assert [tuple(r) for r in got[0]["runs"]] == [(0, 100_000, 1)] and got[0]["collapsed"] == "a"
    assert tuple(got[1]["runs"][0]) == (0, 50, 1) and (0, 102_000, 51) in [tuple(r) for r in got[1]["runs"]]
    assert got[1]["collapsed"] == "a b" and len(got[1]["runs"]) == 2001
    assert not got[2]["runs"] and not got[3]["runs"]  # no fourth power; only a square
