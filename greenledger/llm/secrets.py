"""Secret scan: fixed patterns, plus Markov models of random strings and identifiers.

All of it is built-in functions. The patterns give the base spans. Two character models,
one of random strings and one of ordinary identifiers, are counted from labelled samples:
the values the patterns match are labelled random, other long tokens of the same texts
ordinary. A token is a further secret where the log-likelihood ratio of its character
steps under the two models is high enough per step.

Defined cases: a null text is empty and has no span; every row gives one row, repeated
rows included; without any labelled sample of one kind both models are uniform and no
span is added; other columns are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.llm.tables import written

# The kinds of base spans in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = (
    "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE_CHARS = 12
# A match is a whole run, so the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"

#: Tokens the models look at: runs of these characters, of at least so many.
TOKEN_CHARS = 16
TOKEN = "[A-Za-z0-9+/_=-]{%d,}" % TOKEN_CHARS
#: Characters the models know; all others count as one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
STATES = len(ALPHABET) + 1
#: At most so many labelled strings of a kind are learned from (those of least hash).
TRAIN_STRINGS = 20000
#: Steps that the overall shares of the characters count for.
BACKING = 500.0
#: Mean log-likelihood ratio (natural) per step from which a token is a secret.
THRESHOLD = 1.0

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def matches(text: Column, pattern: str, kind: str, value: int = 0) -> Column:
    """Array of spans of the leftmost non-overlapping matches, in code points.

    What stands between the matches is their text split by the pattern, so the positions
    are running sums of lengths; ``value`` is the group kept as the value.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if value == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"),
                         found.alias("match"), values.alias("value"))
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                        pair["value"].alias("value")).cast(SPAN)
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    none = F.array().cast(f"array<{SPAN}>")
    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(
        pairs, empty, step, lambda acc: acc["spans"])).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` spans in order, and ``tokens``: the spans of the long tokens."""
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        F.filter(matches(text, ASSIGN, "assign", value=2),
                 lambda s: F.length(s["value"]) >= ASSIGN_VALUE_CHARS).alias("assign"),
        matches(text, ACCESS, "access").alias("access"),
        matches(text, HEX, "hex").alias("hex"),
        matches(text, TOKEN, "markov").alias("tokens"))
    rows = rows.withColumn("base", in_order(F.concat(*KINDS)))
    clear = F.filter("tokens", lambda t: ~F.exists(
        "base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return rows.select("doc_id", "base", clear.alias("tokens"))


def in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    rank = F.array(*(F.lit(k) for k in (*KINDS, "markov")))
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s.alias("span")))
    return F.transform(F.sort_array(keyed), lambda s: s["span"])


def labelled_strings(scanned: DataFrame, limit: int = TRAIN_STRINGS) -> DataFrame:
    """(random, value): at most ``limit`` distinct strings of each label, those of least hash."""
    def least(spans: str, random: bool) -> DataFrame:
        values = scanned.select(F.explode(F.transform(spans, lambda s: s["value"])).alias("value"))
        return values.distinct().orderBy(F.xxhash64("value"), "value").limit(limit).select(
            F.lit(random).alias("random"), "value")

    return least("base", True).unionByName(least("tokens", False))


def letters(value: Column) -> Column:
    """The characters of a string; splitting leaves an empty one at the end."""
    return F.slice(F.split(value, ""), F.lit(1), F.length(value))


def step_ratios(strings: DataFrame, backing: float = BACKING) -> list[float]:
    """Log ratio of the chance of each step between two characters, random over ordinary.

    A step's chance is its share among the steps from its first character, backed by the
    overall share of its second one, so steps never seen count as rare as their characters.
    The steps are counted by Spark; what comes back is one row per pair of characters.
    """
    state = F.transform(letters(F.col("value")), lambda c: F.instr(F.lit(ALPHABET), c))
    steps = strings.select("random", state.alias("s")).select("random", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("s") - 1),
        lambda i: F.get("s", i - 1) * STATES + F.get("s", i))).alias("step"))
    counts = [[0] * (STATES * STATES) for _ in range(2)]
    for row in steps.groupBy("random", "step").count().collect():
        counts[int(row["random"])][row["step"]] += row["count"]
    logs = []
    for table in counts:
        to = [sum(table[b::STATES]) + 0.5 for b in range(STATES)]
        whole, leaving = sum(to), [sum(table[a * STATES:(a + 1) * STATES]) for a in range(STATES)]
        logs.append([math.log((n + backing * to[k % STATES] / whole) / (leaving[k // STATES] + backing))
                     for k, n in enumerate(table)])
    return [round(r - o, 4) for o, r in zip(*logs, strict=True)]


def mean_ratio(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per step of a string."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    start = F.struct(F.lit(-1).alias("at"), F.lit(0.0).alias("sum"))

    def step(acc: Column, char: Column) -> Column:
        at = F.instr(F.lit(ALPHABET), char)
        more = F.when(acc["at"] < 0, F.lit(0.0)).otherwise(F.get(table, acc["at"] * STATES + at))
        return F.struct(at.alias("at"), (acc["sum"] + more).alias("sum"))

    return F.aggregate(letters(value), start, step,
                       lambda acc: acc["sum"] / F.greatest(F.length(value) - 1, F.lit(1)))


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: base spans, and those with the added ones, in order."""
    scanned = written(scan(docs))
    ratios = step_ratios(labelled_strings(scanned))
    added = F.filter("tokens", lambda t: mean_ratio(t["value"], ratios) >= threshold)
    return scanned.select("doc_id", "base", in_order(F.concat("base", added)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind and the spans as text, one row per document."""
    def listed(spans: str) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    return found.select("doc_id", *(number(k) for k in KINDS), F.sha2(listed("base"), 256).alias("base_sha256"),
                        listed("spans").alias("spans"), added)
