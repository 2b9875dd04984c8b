"""Language identification: a string kernel, Nystrom landmarks and kernel ridge regression.

The kernel of two texts is the number of letter groups (of one to three letters, word
edges included) present in both, over the geometric mean of their own numbers: a blended
spectrum of presences. It is taken against a few landmark texts only (Nystrom), as one
matrix product per block of texts; one ridge regression per language against the rest
scores them.

Landmarks and training rows are a bounded sample of labelled rows: those of least hash,
``LANDMARKS`` and ``TRAIN`` per language, of texts up to ``SAMPLE_CHARS``. Every text is
then scored whole.

Defined cases: a null text and one without letters are ``und`` with score 0; rows with a
null language or id are not learned from; without any labelled row all texts are ``und``;
of equal scores the first language in order wins; every row gives one row, repeated rows
included; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenledger.llm.tables import held_out

UNDETERMINED = "und"
LANDMARKS, TRAIN, SAMPLE_CHARS = 32, 400, 8000
#: Letter groups are counted in so many slots; two groups in one slot count as one.
SLOT_BITS = 20
LONGEST = 3
RIDGE = 1e-4
#: Scores are a softmax of the regression values times this.
SHARPNESS = 6.0
BLOCK_TEXTS = 256

_U = np.uint64
_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def slots(text: str | None) -> np.ndarray:
    """The slots of the letter groups of a text, with repeats; empty without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.where(letter, codes, 0)
    codes = np.concatenate(([0], codes[letter | np.append(True, letter[:-1])], [0])).astype(_U)
    found, total = [], np.zeros(len(codes), _U)
    for n in range(1, LONGEST + 1):
        total = total[: len(codes) - n + 1] * _U(0x9E3779B97F4A7C15) + codes[n - 1 :] + _U(n)
        found.append((total * _U(0xD6E8FEB86659FD93)) >> _U(64 - SLOT_BITS))
    return np.concatenate(found).astype(np.int64)


class Presence:
    """Rows of kernel values of texts against landmarks."""

    def __init__(self, landmarks: list[np.ndarray]) -> None:
        """landmarks: the distinct slots of each."""
        columns = np.unique(np.concatenate(landmarks))
        self.column = np.full(1 << SLOT_BITS, -1, np.int32)
        self.column[columns] = np.arange(len(columns))
        self.matrix = np.zeros((len(columns), len(landmarks)), np.float32)
        for k, own in enumerate(landmarks):
            self.matrix[self.column[own], k] = 1 / np.sqrt(len(own))
        self.seen = np.zeros(1 << SLOT_BITS, bool)

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        has = np.zeros((len(texts), len(self.matrix)), np.float32)
        own = np.ones(len(texts), np.float32)
        for k, found in enumerate(texts):
            if len(found):
                self.seen[found] = True
                own[k] = np.count_nonzero(self.seen)
                self.seen[found] = False
                column = self.column[found]
                has[k, column[column >= 0]] = 1
        return (has @ self.matrix) / np.sqrt(own)[:, None]


@dataclass
class Model:
    languages: list[str]
    landmarks: list[np.ndarray]
    weights: np.ndarray


def _kernel_rows(landmarks: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(landmarks)
        for batch in batches:
            rows = presence.kernel([slots(t.as_py()) for t in batch.column("text")])
            yield pa.record_batch({"lang": batch.column("lang"),
                                   "row": pa.array(list(rows.astype(np.float64)))})

    return run


def fit(docs: DataFrame, landmarks: int = LANDMARKS, train: int = TRAIN) -> Model:
    """docs: doc_id, text, lang."""
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
        & (F.length("text") <= SAMPLE_CHARS) & F.regexp_like("text", F.lit("\\p{L}")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = usable.select("doc_id", "lang", F.row_number().over(order).alias("rank"))
    chosen = ranked.where(F.col("rank") <= train)
    # At most ``train`` rows per language, so they may go to every task.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    first = sample.where(F.col("rank") <= landmarks).select("lang", "rank", "text").collect()
    first.sort(key=lambda r: (r["lang"], r["rank"], r["text"]))
    marks = [m for m in (np.unique(slots(r["text"])) for r in first) if len(m)]
    if not marks:
        return Model([], [], np.zeros((0, 0)))
    rows = sample.select("lang", "text").mapInArrow(
        _kernel_rows(marks), "lang string, row array<double>").collect()
    languages = sorted({r["lang"] for r in rows})
    rows.sort(key=lambda r: (r["lang"], r["row"]))
    near = np.array([r["row"] for r in rows])
    target = np.array([[1.0 if r["lang"] == k else -1.0 for k in languages] for r in rows])
    among = Presence(marks).kernel(marks).astype(np.float64)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # to the Nystrom features
    mapped = near @ root
    ridge = RIDGE * len(rows) * np.eye(mapped.shape[1])
    return Model(languages, marks, root @ np.linalg.solve(mapped.T @ mapped + ridge, mapped.T @ target))


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(model.landmarks)
        weights = model.weights.astype(np.float32)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_TEXTS):
                part = batch.slice(at, BLOCK_TEXTS)
                texts = [slots(t.as_py()) for t in part.column("text")]
                values = SHARPNESS * (presence.kernel(texts) @ weights).astype(np.float64)
                chance = np.exp(values - values.max(axis=1, keepdims=True))
                chance /= chance.sum(axis=1, keepdims=True)
                best = chance.argmax(axis=1)
                full = [len(t) > 0 for t in texts]
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    "lang_pred": pa.array([model.languages[b] if f else UNDETERMINED
                                           for b, f in zip(best, full, strict=True)]),
                    "score": pa.array([float(chance[i, b]) if f else 0.0 for i, (b, f) in
                                       enumerate(zip(best, full, strict=True))], pa.float64())})

    return run


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; docs: doc_id, text, lang."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs)
    if model.languages:
        out = docs.select("doc_id", "text").mapInArrow(
            _predict(model), "doc_id long, lang_pred string, score double")
    else:
        out = docs.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
