"""The fill-in-the-middle transformation against its definition, and on odd rows."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from greenledger.llm import fill_middle, queries, tables
from test_operators import ODD, doc_rows, table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_query_equals_brute_force(spark, sf_dir):
    want = {}
    for doc, text in doc_rows(spark, sf_dir):
        *left, out = brute(doc, text)
        want[doc] = (*left, sha(out), sha(text or ""))
    got = {r["doc_id"]: tuple(r) for r in queries.op12_fill_middle(spark, sf_dir).collect()}
    assert got == want
    assert {v[2] for v in got.values()} == {"plain", "psm", "spm"}


def test_query_equals_its_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf_dir}/documents.parquet')")
    want = sorted(con.execute(queries.ORACLES["op12_fill_middle"]).fetchall())
    assert sorted(tuple(r) for r in queries.op12_fill_middle(spark, sf_dir).collect()) == want


TEXTS = ["a", "ab cd", "\n", "a\nb\r\n", "$1 \\ $0 {x}", "é ü 漢字 😀😀 z", "<P>", "x<S>y", "a<M>", "<P", "S>", " " * 50,
         "w" * 100_000, "a." * 200_000, "é   \u0085", "\u0000a"]


def test_odd_texts_come_back(spark):
    rows = [(k, text) for k, text in enumerate(TEXTS * 8)]
    made = fill_middle.transformed(spark.createDataFrame(rows, "doc_id long, text string")).withColumn(
        "back", fill_middle.original(F.col("form"), F.col("output")))
    got = {r["doc_id"]: tuple(r) for r in made.collect()}
    assert got == {k: (*brute(k, text), text) for k, text in rows}


def test_odd_rows_and_settings(spark):
    made = fill_middle.transformed(table(spark, ODD), seed=7, percent=100, suffix_first=100).collect()
    assert len(made) == len(ODD)
    assert {r["form"] for r in made} == {"plain", "spm"}
    assert {r["output"] for r in made if r["form"] == "plain"} == {""}
    none = fill_middle.transformed(table(spark, []))
    assert none.count() == 0
    assert none.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_the_plan_has_no_shuffle_and_no_python(spark, sf_dir):
    plan = fill_middle.transformed(tables.read(spark, sf_dir, "documents", "doc_id", "text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
    assert text.count("regexp_extract_all") == 1  # the units are counted once
