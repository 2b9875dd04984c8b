"""What the licence model learns comes from every document."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from greenledger.llm import licences

WORDS = "thnt erin ouat andon lyre ingea thesth blere".split()


def test_commonness_counts_all_documents(spark):
    ids = spark.range(1000).select(F.col("id").alias("doc_id"))
    order = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    # A word of a template is on a fifth of all lines, in the documents of greatest hash only.
    rows = [(d, f"erin ouat {d}" if k < 800 else f"version {d} erin") for k, d in enumerate(order)]
    model = licences.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "version" not in model.words and "licensed" in model.words


def test_every_document_is_learned_from(spark):
    ids = spark.range(1000).select(F.col("id").alias("doc_id"))
    order = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    rows = [(d, f"erin ouat {d}") for d in order]
    # The document of greatest hash holds as many ordinary lines as half of all others.
    near = [f"erin {k} ouat" for k in range(500)]
    without, model = (licences.fit(spark.createDataFrame(r, "doc_id long, text string"))
                      for r in (rows, [*rows[:-1], (order[-1], "\n".join(near))]))
    assert without.words == model.words
    assert max(abs(a - b) for a, b in zip(without.intercepts, model.intercepts, strict=True)) > 0.01


def test_many_ordinary_lines_drown_no_licence(spark):
    runs = [" ".join(w) for w in itertools.permutations(WORDS, 6)]  # 20,160 different lines
    docs = [(k, "\n".join(f"{r} {k}" for r in runs)) for k in range(3)]
    docs += [(100, "erin ouat\nReleased under the MIT License."), (101, licences.TEMPLATES["GPL"][2])]
    got = {r.doc_id: tuple(r)[1:] for r in licences.licences(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[100] == (1, 0, "MIT") and got[101] == (1, 0, "GPL")
    assert all(got[k] == (0, 0, "") for k in range(3))
