"""Toxic passages: log-odds of tokens, maximum-scoring segments, extreme-value calibration.

1. From a bounded sample of labelled texts, every word and word beginning gets the log-odds
   of standing in a toxic text, smoothed by a Dirichlet prior that follows its overall
   frequency. Those that are significant are the lexicon.
2. A text is a row of token scores: the lexicon's log-odds less a drift, so that ordinary
   text drifts down. One linear pass finds all maximal scoring segments.
3. Scores of segments become evidence by the extreme-value law of such segments in
   ordinary text (Karlin and Altschul, with sum statistics over several segments), and
   evidence becomes a probability by a logistic curve fitted on the same sample.

Defined cases: a null or empty text has no token and the score of no evidence; without
toxic or without clean samples every score is the share of toxic ones (0 without any);
rows with a null label or id are not learned from; every row gives one row, repeated rows
included; other columns are left alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.tables import held_out, written

#: Labelled documents learned from at most: those of least hash.
TRAIN_DOCS = 20000
#: Lengths of word beginnings that are looked at beside the word.
BEGINNINGS = (4, 5, 6)
#: Weight of the prior, as a share of the sample.
PRIOR = 0.05
#: Standard errors from which a log-odds is in the lexicon.
SIGNIFICANT = 3.0
#: What each token costs, so that ordinary text has a falling score.
DRIFT = 2.0
#: Expected number of ordinary segments as good, up to which a passage is reported.
EXPECTED = 0.05
#: Scores are multiples of this, so that their law can be counted.
STEP = 0.25

_WORD = re.compile(r"[^\W_]+")


def features(word: str) -> list[str]:
    """A word and its beginnings (marked by a final ``*``)."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


@dataclass
class Model:
    """``lexicon``: log-odds by feature; ``rate`` and ``scale``: the law's lambda and K."""

    lexicon: dict[str, float]
    rate: float = 1.0
    scale: float = 1.0
    offset: float = 0.0
    slope: float = 0.0


class _Scores(dict):
    """Token scores, remembered up to a bound."""

    LIMIT = 500_000

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        known = [self.lexicon[f] for f in features(word) if f in self.lexicon]
        self[word] = score = (max(known) if known else 0.0) - DRIFT
        return score


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time, in order.

    Runs are kept on a stack with the running totals at their ends; a new one is joined
    to the last that started lower, if that ended lower too. Each run remembers the last
    one that started lower than itself, so runs in between are never looked at again. Only
    tokens above zero start a run, so ordinary text costs one vectorised pass.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[int, int, float, float, int]] = []
    for at in np.flatnonzero(scores > 0).tolist():
        start, low, high = at, float(total[at]), float(total[at + 1])
        k = len(stack) - 1
        while True:
            while k >= 0 and stack[k][2] >= low:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= high:
                break
            start, _, low, _, lower = stack[k]
            del stack[k:]
            k = lower
        stack.append((start, at + 1, low, high, k))
    return [(a, b, high - low) for a, b, low, high, _ in stack]


def evidence(scores: list[float], tokens: int, rate: float, scale: float) -> float:
    """-log of the chance that ordinary text of this length has segments as good.

    Over the best r segments the normalised scores add up; the best r counts.
    """
    best = total = 0.0
    log_room = math.log(max(scale * tokens, 1e-9))
    for r, score in enumerate(sorted(scores, reverse=True), 1):
        total += rate * score - log_room
        if total <= 0:
            break
        chance = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r)
        best = max(best, chance)
    return best


def _tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def sample(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled documents outside the held-out part."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(limit)
    # The chosen rows are bounded by ``limit``, so they may go to every task.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") > 0).alias("toxic"))


def _count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            counts[bool(toxic)].update({f for w in set(_tokens(text)) for f in features(w)})
        names = list(counts[0].keys() | counts[1].keys())
        yield pd.DataFrame({"feature": names, "clean": [counts[0][f] for f in names],
                            "toxic": [counts[1][f] for f in names]})


def lexicon(train: DataFrame, prior: float = PRIOR, least: float = SIGNIFICANT) -> dict[str, float]:
    """Significant positive log-odds by feature; counted over distinct texts."""
    counts = written(train.mapInPandas(
        _count_features, "feature string, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("y0"), F.sum("toxic").alias("y1")))
    n0, n1 = counts.agg(F.sum("y0"), F.sum("y1")).first()
    if not n0 or not n1:
        return {}
    a, whole = (F.col("y0") + F.col("y1")) * prior, prior * (n0 + n1)

    def odds(y: str, n: int):
        return F.log((F.col(y) + a) / (F.lit(n + whole) - F.col(y) - a))

    found = counts.where("y1 > 0").select(
        "feature", (odds("y1", n1) - odds("y0", n0)).alias("odds"),
        F.sqrt(1 / (F.col("y1") + a) + 1 / (F.col("y0") + a)).alias("error"))
    found = found.where((F.col("odds") > DRIFT) & (F.col("odds") >= least * F.col("error")))
    return {r["feature"]: round(r["odds"] / STEP) * STEP for r in found.collect()}


def _segment_rows(words: dict[str, float]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Scores(words)
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                scores = np.array([known[t] for t in _tokens(text)], np.float64)
                level = np.bincount(np.rint((scores + DRIFT) / STEP).astype(int)) if len(scores) else []
                rows.append((bool(toxic), len(scores), [int(n) for n in level],
                             [s for _, _, s in segments(scores)]))
            yield pd.DataFrame(rows, columns=["toxic", "tokens", "levels", "found"])

    return run


def extreme_law(levels: np.ndarray, found: list[float], tokens: int) -> tuple[float, float]:
    """lambda and K of the best segments of ordinary text with these token scores."""
    steps = np.arange(len(levels)) * STEP - DRIFT
    share = levels / levels.sum()

    def excess(rate: float) -> float:
        return float((share * np.exp(rate * steps)).sum()) - 1

    low, high = 0.0, 20.0
    if not (levels[steps > 0] > 0).any():
        high = low = 5.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    rate = max(low, 1e-3)
    floor = rate * min(found, default=0.0)
    return rate, (len(found) + 1) / (max(tokens, 1) * math.exp(-floor))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Offset and slope of a logistic curve, by Newton steps."""
    columns, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(columns @ beta, -30, 30)))
        slope = columns.T @ (p - y) + ridge * beta
        bend = (columns * (p * (1 - p))[:, None]).T @ columns + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Model:
    train = sample(docs, labels, limit).distinct()
    words = lexicon(train)
    schema = "toxic boolean, tokens long, levels array<long>, found array<double>"
    rows = train.mapInPandas(_segment_rows(words), schema).collect() if words else []
    if not rows:
        share = train.agg(F.avg(F.col("toxic").cast("int"))).first()[0] or 0.0
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Model({}, offset=math.log(share / (1 - share)))
    clean = [r for r in rows if not r["toxic"]]
    levels = np.zeros(max(2, *(len(r["levels"]) for r in rows)))
    for r in clean:
        levels[: len(r["levels"])] += r["levels"]
    rate, scale = extreme_law(levels + 1e-9, [s for r in clean for s in r["found"]],
                              sum(r["tokens"] for r in clean))
    x = np.array([evidence(r["found"], r["tokens"], rate, scale) for r in rows])
    offset, slope = logistic(np.log1p(x), np.array([r["toxic"] for r in rows], float))
    return Model(words, rate, scale, offset, slope)


def _judge(model: Model, texts: list[str | None]) -> tuple[list[float], list[list[dict]]]:
    """Scores and significant passages of some texts."""
    known = _Scores(model.lexicon)
    score, passages = [], []
    for text in texts:
        lowered = (text or "").lower()
        words = _WORD.findall(lowered)
        found = segments(np.array([known[w] for w in words], np.float64))
        x = evidence([s for _, _, s in found], len(words), model.rate, model.scale)
        z = model.offset + model.slope * math.log1p(x)
        score.append(1 / (1 + math.exp(-min(max(z, -40.0), 40.0))))
        room = model.scale * max(len(words), 1)
        good = [f for f in found if room * math.exp(-model.rate * f[2]) <= EXPECTED]
        places = [m.span() for m in _WORD.finditer(lowered)] if good else []
        passages.append([{"start": places[a][0], "end": places[b - 1][1], "score": s}
                         for a, b, s in good])
    return score, passages


_PASSAGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, passages): every significant passage as places in the lower-cased text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, passages = _judge(model, batch.column("text").to_pylist())
            yield pa.record_batch({"doc_id": batch.column("doc_id"),
                                   "score": pa.array(score, pa.float64()),
                                   "passages": pa.array(passages, _PASSAGES)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, "
             "passages array<struct<start: long, end: long, score: double>>")


def without_toxic(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``; all columns pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, _ = _judge(model, batch.column("text").to_pylist())
            yield batch.filter(pa.array([s < least for s in score], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def predictions(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages) of every row, learned from ``labels``."""
    out = scored(docs, fit(docs, labels, limit))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      F.size("passages").cast("long").alias("n_passages"))
