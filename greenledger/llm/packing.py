"""Best-fit packing of texts into sequences of several permitted lengths.

Lengths are in tokens of a byte-level vocabulary: the UTF-8 bytes of a text and one end
mark (any other length column can be given). A text longer than the greatest permitted
length is cut into pieces. Pieces are dealt into shards of bounded size, and each shard is
packed by itself: in falling order of length, a piece goes to the open bin it fits best,
else it opens a bin. Which sizes may be opened is chosen jointly: every ceiling on them
is tried, each opening the size of least cost per token, then each bin is downsized to the
least permitted length that holds its contents, and the cheapest plan of the shard stays.

Defined cases: a null or empty text is one piece of its end mark alone; a row with a null
id is packed like any other; equal rows are packed each; with no row there is no bin;
other columns are left alone.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Permitted sequence lengths.
CAPACITIES = (2048, 4096, 8192, 16384)
#: What a sequence costs besides its length.
BIN_COST = 64
#: Pieces that are packed together.
SHARD_PIECES = 20000

PIECES = ("doc_id long, piece int, start long, length long, shard long, bin long, capacity long, "
          "offset long, filled long")


def token_length(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def open_size(length: int, sizes: tuple[int, ...], bin_cost: int) -> int:
    """The size of least cost per token among those that hold the piece."""
    return min((s for s in sizes if s >= length), key=lambda s: ((s + bin_cost) / s, s))


def best_fit(lengths: list[int], sizes: tuple[int, ...], bin_cost: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece; lengths fall. Bins are numbered as they open."""
    open_bins: list[tuple[int, int]] = []  # (room, bin), sorted
    filled: list[int] = []
    out = []
    for length in lengths:
        k = bisect_left(open_bins, (length, -1))
        if k < len(open_bins):
            room, at = open_bins.pop(k)
        else:
            room, at = open_size(length, sizes, bin_cost), len(filled)
            filled.append(0)
        out.append((at, filled[at]))
        filled[at] += length
        if room > length:
            insort(open_bins, (room - length, at))
    return out


def plan(lengths: list[int], capacities: tuple[int, ...], bin_cost: int):
    """((bin, offset) of each piece, downsized capacity of each bin) of least cost."""
    best = None
    for ceiling in capacities:
        needed = capacities[bisect_left(capacities, lengths[0])]
        sizes = tuple(c for c in capacities if c <= max(ceiling, needed))
        placed = best_fit(lengths, sizes, bin_cost)
        filled: dict[int, int] = {}
        for (at, _), length in zip(placed, lengths, strict=True):
            filled[at] = filled.get(at, 0) + length
        final = {at: capacities[bisect_left(capacities, n)] for at, n in filled.items()}
        cost = sum(final.values()) + bin_cost * len(final)
        if best is None or cost < best[0]:
            best = (cost, placed, final, filled)
    return best[1:]


def _pack(capacities: tuple[int, ...], bin_cost: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "mark", "piece"],
                                  ascending=[False, True, True, True], kind="stable")
        lengths = group["length"].tolist()
        placed, final, filled = plan(lengths, capacities, bin_cost)
        bins = [at for at, _ in placed]
        return pd.DataFrame({
            "doc_id": group["doc_id"], "piece": group["piece"], "start": group["start"],
            "length": lengths, "shard": group["shard"], "bin": bins,
            "capacity": [final[b] for b in bins], "offset": [o for _, o in placed],
            "filled": [filled[b] for b in bins]})

    return run


def packed(docs: DataFrame, length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES,
           bin_cost: int = BIN_COST, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: its document, place in it, shard, bin, the bin's capacity, its offset
    in the bin and how full the bin is. (shard, bin) names a sequence."""
    capacities = tuple(sorted(capacities))
    longest = capacities[-1]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"),
        (token_length(F.col("text")) if length is None else length.cast("long")).alias("total"))
    pieces = rows.select("doc_id", "mark", "total", F.explode(F.sequence(
        F.lit(0), F.greatest(F.ceil(F.col("total") / longest).cast("int") - 1, F.lit(0)))).alias("piece"))
    start = F.col("piece").cast("long") * longest
    pieces = pieces.select("doc_id", "mark", "piece", start.alias("start"),
                           F.least(F.col("total") - start, F.lit(longest)).alias("length"))
    # Shards are dealt by id, text and piece, so no document or source fills one.
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "mark", "piece"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(_pack(capacities, bin_cost), PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: capacity, fill and the pieces in their order."""
    return pieces.groupBy("shard", "bin").agg(
        F.first("capacity").alias("capacity"), F.first("filled").alias("filled"),
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length"))).alias("pieces"))
