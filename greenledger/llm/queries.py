"""The registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm import (
    benchmark_leaks, fill_middle, fingerprints, jaccard_join, languages, licences, near_dups, packing,
    periodic_runs, personal_data, repeated_passages, secrets, toxicity,
)
from greenledger.llm.tables import read

#: The key of the surrogates in the queries; a user gives a secret one.
SURROGATE_KEY = "public example key"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return secrets.digest(secrets.find_secrets(docs))


@query
def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.predictions(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeated_passages.without_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op4_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.predictions(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query
def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks.leaks(read(spark, sf_dir, "documents", "doc_id", "text"),
                                 read(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.found(read(spark, sf_dir, "documents", "doc_id", "text"), SURROGATE_KEY)

    def number(kind: str):
        return F.size(F.filter("entities", lambda e: e["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", "text", *(number(k) for k in personal_data.KINDS))


@query
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transformed(read(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.original(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


ORACLES["op12_fill_middle"] = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id::VARCHAR) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents),
numbers AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n,
         concat('0x', substr(h, 1, 8))::BIGINT AS h1, concat('0x', substr(h, 9, 8))::BIGINT AS h2,
         concat('0x', substr(h, 17, 8))::BIGINT AS h3, concat('0x', substr(h, 25, 8))::BIGINT AS h4
  FROM drawn),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:], '') AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""


def planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a run planted in every text whose id's checksum ends in 0."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long"))
    g = F.floor(F.col("h") / 10)
    rows = rows.select("doc_id", "text", "words", "n", F.when(F.col("n") > 0, g % F.col("n")).alias("a"), g.alias("g"))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    changed = F.transform("words", lambda w, i: F.when(
        i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(
        F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_runs(read(spark, sf_dir, "documents", "doc_id", "text"))
    found = periodic_runs.periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.shorter")
    return rows.select("doc_id", "n_runs", (-F.col("best.before")).alias("start"), length.alias("length"),
                       period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(read(spark, sf_dir, "documents", "doc_id", "text"))


#: Sets of shingles, their links in hundredths of the union, and what links reach.
_LINKED_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 5 AND len(w) > 0 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM split),
sized AS (SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(list_sort(s), chr(10))) AS k FROM sets),
elements AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM elements a JOIN elements b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y, p.k AS kx, q.k AS ky
  FROM shared JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y
  WHERE 100 * c >= {percent} * (p.n + q.n - c)),
reached(node, root) AS (
  SELECT doc_id, doc_id FROM sized UNION SELECT y, root FROM reached JOIN links ON x = node),
roots AS (SELECT node AS doc_id, min(root) AS component_id FROM reached GROUP BY node),
degrees AS (SELECT x AS doc_id, count(DISTINCT ky) FILTER (ky <> kx) AS n_links FROM links GROUP BY x)
SELECT doc_id, n AS n_shingles, component_id, {more}
FROM sized JOIN roots USING (doc_id) LEFT JOIN degrees USING (doc_id)"""
ORACLES["op1_near_dups"] = _LINKED_SQL.format(percent=85, more="doc_id = component_id AS kept")
ORACLES["op11_jaccard_join"] = _LINKED_SQL.format(
    percent=80, more="coalesce(n_links, 0)::BIGINT AS n_links")


ORACLES["op8_repeated_passages"] = """
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split)),
firsts AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, i + k AS place
  FROM (SELECT doc_id, i, unnest(range(0, 13)) AS k FROM windows JOIN firsts USING (g) WHERE least < doc_id)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM split),
kept AS (
  SELECT doc_id, count(*)::BIGINT AS n_kept, string_agg(word, ' ' ORDER BY place) AS text
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""
