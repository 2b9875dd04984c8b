"""Fill-in-the-middle transformation by a counted-quantifier regular expression.

A text is a sequence of units: a run of letters A-Z and a-z, or any other single code
point. ``regexp_count`` gives their number n. Two cuts a <= b are drawn from a keyed
hash of the document, and one pattern is written for the row: possessive groups of a and
of b - a units, then the rest. One match of it captures prefix, middle and suffix, and
its replacement puts them in the order of the form. A possessive counted group is matched
by a loop, without recursion and without going back, so the length of a text has no limit.

Everything is built-in Spark expressions on one row: no shuffle, no Python.

Defined cases: a null text is the empty text; an empty text, or one that holds a marker,
stays plain; a row without an id draws as the empty id; equal rows get equal results, one
each; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Documents in a hundred that are transformed, and of those the ones that begin with the suffix.
TRANSFORMED_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20

#: The three parts in one match; both counts are those of the row.
_CUT = rf"(?s)\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)(.*)"
_ORDERED = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
#: The parts of an output by form, and the replacement that puts them back.
_BACK = {"psm": (rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)", "$1$3$2"),
         "spm": (rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)", "$2$3$1")}


def draws(seed: int) -> list[Column]:
    """The first four numbers of 32 bits of the hash of ``seed:doc_id``."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}")
            for k in range(4)]


def _marker_at(marker: str) -> Column:
    """Characters before a marker of the output."""
    return F.instr("output", marker).cast("long") - 1


def transformed(docs: DataFrame, seed: int = 1, percent: int = TRANSFORMED_PERCENT,
                suffix_first: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row of ``docs``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *draws(seed))
    marked = F.greatest(*(F.instr("text", m) for m in (PREFIX, SUFFIX, MIDDLE))) > 0
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= percent)
    rows = rows.select(
        "*", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
        F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm").alias("form"))
    cuts = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    rows = rows.select("doc_id", "text", "n", "form", F.least(*cuts).alias("a"),
                       F.abs(cuts[0] - cuts[1]).alias("between"))
    order = F.when(F.col("form") == "psm", _ORDERED["psm"]).otherwise(_ORDERED["spm"])
    whole = F.regexp_replace(F.col("text"), F.format_string(_CUT, "a", "between"), order)
    rows = rows.select("doc_id", "n", "form",
                       F.when(F.col("form") == "plain", F.col("text")).otherwise(whole).alias("output"))
    # Texts with markers stay plain, so each marker of an output stands there once.
    prefix_end = F.when(F.col("form") == "psm", _marker_at(SUFFIX)).otherwise(_marker_at(MIDDLE))
    prefix = F.when(F.col("form") != "plain", prefix_end - _marker_at(PREFIX) - len(PREFIX))
    middle = F.when(F.col("form") != "plain", F.length("output") - _marker_at(MIDDLE) - len(MIDDLE))
    return rows.select("doc_id", "n", "form", prefix.cast("long").alias("prefix_chars"),
                       middle.cast("long").alias("middle_chars"), "output")


def original(form: Column, output: Column) -> Column:
    """The text that an output was made from."""
    back = F.when(form == "plain", output)
    for name, (pattern, parts) in _BACK.items():
        back = back.when(form == name, F.regexp_replace(output, F.lit(pattern), F.lit(parts)))
    return back
