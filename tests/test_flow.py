"""As-of joins, streams, late days and sketches against plain recomputation."""

from __future__ import annotations

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from greenledger.operators import asof, incremental, sketches
from greenledger.operators.rollup import rollup_demand
from greenledger.streaming import weekly

START = datetime.datetime(2024, 1, 1)


def instant(rng, hours=24 * 40):
    return START + datetime.timedelta(minutes=rng.randrange(0, hours * 60, 30))


@pytest.mark.parametrize("keys, seconds", [([], 3600), ([], 10**9), (["site"], 86_400), (["site"], 1800)])
def test_asof_equals_a_search(spark, keys, seconds):
    rng = random.Random(seconds)
    left = [(k, rng.choice(("a", "b", "c", None)), instant(rng) if k % 17 else None) for k in range(300)]
    left += [(900 + k, "a", START + datetime.timedelta(days=9)) for k in range(100)]  # one hot instant
    right = [(rng.choice(("a", "b", None)), instant(rng), float(rng.randrange(100))) for _ in range(60)]
    lf = spark.createDataFrame(left, "id int, site string, at timestamp_ntz")
    rf = spark.createDataFrame(right, "site string, at timestamp_ntz, v double")
    got = {r["id"]: r["v"] for r in asof.asof_join(lf, rf if keys else rf.drop("site"), "at", ["v"], keys,
                                                   seconds).collect()}
    assert len(got) == len(left)
    for i, site, at in left:
        fits = [(t, v) for s, t, v in right if at is not None and t <= at and (
            not keys or (s is not None and s == site))]
        assert got[i] == (max(fits)[1] if fits else None)


def test_asof_with_an_empty_side(spark):
    none = spark.createDataFrame([], "at timestamp_ntz, v double")
    some = spark.createDataFrame([(1, START)], "id int, at timestamp_ntz")
    assert [tuple(r) for r in asof.asof_join(some, none, "at", ["v"]).collect()] == [(1, START, None)]
    assert asof.asof_join(some.limit(0), none, "at", ["v"]).count() == 0


EVENTS = "event_id long, ts timestamp_ntz, event_type string, value double"


def batch_rollup(rows):
    out = {}
    for _, ts, kind, value in {r[0]: r for r in rows}.values():
        cell = kind, (ts - START).days // 7 + 1
        n, total = out.get(cell, (0, 0.0))
        out[cell] = n + 1, total + value
    return {k: (n, round(t, 6)) for k, (n, t) in out.items()}


def test_stream_equals_the_batch_after_late_and_repeated_files(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, instant(rng), rng.choice("xy"), float(rng.randrange(50))) for k in range(400)]
    rows.sort(key=lambda r: r[1])
    late = rows[200:230]
    files = [rows[:200], rows[230:300], late, rows[230:300], rows[300:], late[:5]]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], EVENTS).schema

    def put(part):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)

    def stored():
        return {(r["crop"], r["week_id"]): (r["active_tray_rows"], round(r["kwh_used"], 6))
                for r in weekly.stored_weeks(spark, out).collect()}

    def run():
        weekly.run_weekly(spark, source, schema, out, state, "2024-01-01", "30 days").awaitTermination()

    seen = []
    for part in files:  # each run is a restart from the checkpoint
        put(part)
        run()
        seen += part
        assert stored() == batch_rollup(seen)
    # A batch that is written again leaves the same rows.
    last = sorted(os.listdir(out), key=lambda n: int(n.split("=")[1]))[-1]
    again = spark.read.parquet(f"{out}/{last}")
    spark.createDataFrame(again.collect(), again.schema).write.mode("overwrite").parquet(f"{out}/{last}")
    assert stored() == batch_rollup(rows)


def test_rows_later_than_the_delay_are_dropped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], EVENTS).schema
    day = datetime.timedelta(days=1)
    for part in ([(1, START, "x", 1.0)], [(2, START + 60 * day, "x", 1.0)], [(3, START + 70 * day, "x", 1.0)],
                 [(4, START + day, "x", 1.0)]):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)
        weekly.run_weekly(spark, source, schema, out, state, "2024-01-01", "7 days").awaitTermination()
    got = {r["week_id"]: r["active_tray_rows"] for r in weekly.stored_weeks(spark, out).collect()}
    assert got == {1: 1, 9: 1, 11: 1}


def test_late_days_rewrite_their_week_only(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for d in range(56):
        date = (START + datetime.timedelta(days=d)).date().isoformat()
        rows += [(date, d // 7 + 1, c, float(rng.randrange(1, 30))) for c in "abc" for _ in range(rng.randrange(3))]
    schema = "date string, week_id int, crop string, demand_lbs double"
    late = {r[0] for r in rows if r[1] == 3 and rng.random() < 0.4} | {rows[0][0]}
    folder = str(tmp_path)
    put = lambda part: incremental.deliver_days(spark, folder, spark.createDataFrame(part, schema))

    def files():
        return {week: sorted(os.listdir(f"{folder}/demand_days.parquet/{week}"))
                for week in os.listdir(f"{folder}/demand_days.parquet") if week.startswith("week_id")}

    def weeks(df):
        return {(r["crop"], r["week_id"]): r["demand_lbs"] for r in df.collect()}

    put([r for r in rows if r[0] not in late])
    before = files()
    put([r for r in rows if r[0] in late])
    after = files()
    assert {w for w in after if before.get(w) != after[w]} == {"week_id=1", "week_id=3"}
    want = weeks(rollup_demand(spark.createDataFrame(rows, schema)))
    assert weeks(incremental.stored_weekly(spark, folder)) == want
    put([r for r in rows if r[0] in late])  # the same days again change nothing
    assert weeks(incremental.stored_weekly(spark, folder)) == want
    changed = [(r[0], r[1], r[2], r[3] + 1) for r in rows if r[0] == rows[0][0]]
    put(changed)
    assert weeks(incremental.stored_weekly(spark, folder)) == weeks(rollup_demand(spark.createDataFrame(
        [r for r in rows if r[0] != rows[0][0]] + changed, schema)))


def test_merged_sketches_are_close_and_equal_one_pass(spark):
    rng = random.Random(1)
    rows = [(f"t{rng.randrange(4000)}", rng.choice("ab"), rng.randrange(1, 9), int(rng.gauss(30, 8)))
            for _ in range(20_000)]
    df = spark.createDataFrame(rows, "tray_id string, crop string, week_id int, stage_age_days int").repartition(6)
    merged = sketches.merged_sketches(sketches.telemetry_sketches(df), ["crop"]).collect()
    whole = sketches.merged_sketches(
        sketches.telemetry_sketches(df.withColumn("week_id", F.lit(0))), ["crop"]).collect()
    one = {r["crop"]: r["approx_trays"] for r in whole}
    for r in merged:
        mine = [x for x in rows if x[1] == r["crop"]]
        trays = len({x[0] for x in mine})
        ages = sorted(x[3] for x in mine)
        assert abs(r["approx_trays"] - trays) <= 0.05 * trays
        assert r["approx_trays"] == one[r["crop"]]  # registers merge without loss
        assert r["ages_seen"] == len(mine)
        low, high = ages.index(r["approx_median_age"]), len(ages) - ages[::-1].index(r["approx_median_age"])
        assert low <= 0.53 * len(ages) and high >= 0.47 * len(ages)
