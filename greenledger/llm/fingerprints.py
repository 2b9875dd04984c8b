"""Document fingerprints: bottom-k sketches of word-shingle hashes, in built-in functions.

A sketch is the sorted array of the ``k`` least distinct hashes of the shingles of a
text. Sketches of parts merge to the sketch of the whole; two of them estimate
resemblance and containment, one the number of distinct shingles.

Defined cases: a null text counts as empty and has the empty sketch; a text of fewer
words than a shingle has one shingle, its whole word sequence; two empty sketches
resemble each other fully, an empty and a non-empty one not at all. Every row gives one
row, repeated rows included; other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashes kept of a text; the error of a likeness is about 0.5 / sqrt(SKETCH_SIZE).
SKETCH_SIZE = 128
SHINGLE_WORDS = 5
#: Documents of neighbouring ids brought together to find the text that follows.
ROWS_PER_RANGE = 512
#: Ranges brought together to find the range that follows.
RANGES_PER_GROUP = 65536


def words(text: Column) -> Column:
    """Lower-cased words: what stands between spaces and ``\\x09-\\x0D``."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\x09-\\x0D]+")
    return F.filter(parts, lambda w: w != "")


def sketch_of_hashes(hashed: Column, k: int = SKETCH_SIZE, width: int = SHINGLE_WORDS) -> Column:
    """The sketch of a text given as the array of its word hashes."""
    n = F.size(hashed)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))))
    # Single elements, as slice() would copy the whole array for every shingle; those
    # past the end are null and leave the hash as it is.
    shingle = F.transform(
        starts, lambda i: F.xxhash64(*(F.get(hashed, i + j) for j in range(width))))
    least = F.slice(F.sort_array(F.array_distinct(shingle)), 1, k)
    return F.coalesce(least, F.array().cast("array<bigint>"))


def with_sketch(df: DataFrame, text: str, out: str, k: int = SKETCH_SIZE) -> DataFrame:
    """``df`` with the sketch of a text column."""
    hashed = f"__words_{out}"
    return df.withColumn(hashed, F.transform(words(F.col(text)), lambda w: F.xxhash64(w))).withColumn(
        out, sketch_of_hashes(F.col(hashed), k)).drop(hashed)


def merged(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, keys: list[str], sketch: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One sketch per group of rows, however many rows a group has.

    Only the ``k`` least hashes of each group in each task are shuffled.
    """
    hashes = df.select(*keys, F.explode(sketch).alias(sketch)).distinct()
    order = Window.partitionBy(*keys).orderBy(sketch)
    least = hashes.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list(sketch)).alias(sketch))


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated Jaccard likeness of the shingle sets of two texts, 0 to 1."""
    union = merged(a, b, k)
    both = F.array_intersect(F.array_intersect(a, b), union)
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
        F.size(both).cast("double") / F.size(union))


def distinct_shingles(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    spread = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / spread)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too, 0 to 1."""
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    own = distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / own))


def as_text(sketch: Column) -> Column:
    """A sketch as a string: its hashes in order, in hexadecimal."""
    return F.lower(F.concat_ws("-", F.transform(sketch, lambda h: F.hex(h))))


def with_following(docs: DataFrame, width: int) -> DataFrame:
    """Each document with ``own``, ``next_text`` and ``after``: its sketch, and the text and
    sketch of the next id (after the last: the first).

    Ids are cut into ranges of ``width``; a window finds what follows inside a range, and
    the first document of the next range that has rows closes the gap, so texts are
    shuffled once and no task needs more than a range. Rows with a null id stand in no
    order and have no next text.
    """
    unplaced = F.col("doc_id").isNull()
    lone = F.lit(-(1 << 62)) - F.pmod(F.xxhash64("text"), F.lit(4096))
    spot = F.expr(f"doc_id div {width}")
    ranged = docs.select("doc_id", "text", F.when(unplaced, lone).otherwise(spot).alias("range"))
    placed = ranged.where(~unplaced)
    inside = Window.partitionBy("range").orderBy("doc_id", "text")

    firsts = placed.withColumn("rank", F.row_number().over(inside)).where("rank = 1").select(
        F.col("range").alias("next_range"), F.col("text").alias("first_text"))
    firsts = with_sketch(firsts, "first_text", "first_sketch")
    ranges = placed.select("range").distinct()
    group = F.expr(f"range div {RANGES_PER_GROUP}")
    near = ranges.select("range", group.alias("grp")).withColumn(
        "near", F.lead("range").over(Window.partitionBy("grp").orderBy("range")))
    groups = ranges.groupBy(group.alias("grp")).agg(F.min("range").alias("head"))
    in_order = Window.orderBy("grp")  # one row per RANGES_PER_GROUP ranges
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    ahead = groups.select("grp", F.coalesce(
        F.lead("head").over(in_order), F.first("head").over(so_far)).alias("far"))
    bridge = near.join(ahead, "grp").select(
        "range", F.coalesce("near", "far").alias("next_range")).join(firsts, "next_range")

    rows = with_sketch(ranged.repartition("range"), "text", "own")
    rows = rows.withColumns({
        "lead_text": F.lead("text").over(inside), "lead_sketch": F.lead("own").over(inside)})
    rows = rows.join(bridge.drop("next_range"), "range", "left")
    nothing = F.array().cast("array<bigint>")
    return rows.select(
        "doc_id", "text", "own",
        F.when(unplaced, F.lit("")).otherwise(F.coalesce("lead_text", "first_text")).alias("next_text"),
        F.when(unplaced, nothing).otherwise(F.coalesce("lead_sketch", "first_sketch")).alias("after"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited form, and their likenesses.

    The edited text ends in the beginning of the next document's text: the last
    ``floor(n_chars / 2)`` code points are replaced by the first as many of it.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    reach = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                     F.count("doc_id").alias("n")).first()
    span = (reach["high"] - reach["low"] + 1) if reach["n"] else 1
    width = max(1, span // max(1, reach["n"])) * ROWS_PER_RANGE
    rows = with_following(docs, width).withColumn("n_chars", F.length("text").cast("long"))
    half = F.expr("int(n_chars div 2)")
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring("next_text", F.lit(1), half)))
    rows = with_sketch(rows, "edited", "changed")
    near_next = F.when(F.col("doc_id").isNull(), F.lit(0.0)).otherwise(
        resemblance(F.col("own"), F.col("after")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
        near_next.alias("near_next"),
        distinct_shingles(F.col("own")).alias("n_shingles_estimate"),
        containment(F.col("own"), F.col("changed")).alias("kept_share"),
    )
