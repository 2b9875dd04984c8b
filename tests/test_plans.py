"""Plan operators against literal recurrences, enumeration and brute force."""

from __future__ import annotations

import itertools
import math
import collections
import random

import pytest
from pyspark.sql import functions as F

from greenledger.plans import audit, capacity, costs, feasibility, ledger, schedule, selection
from greenledger.sources.parameters import CropParam, Scenario, params_table, scenario_table

PLAN = "crop string, plant_week int, harvest_week int, trays long"
DEMAND = "crop string, week_id int, demand_lbs double"
PRICE = "week_id int, price_per_kwh double"
CROPS = (
    CropParam("a", 1, 2, 2.0, 0.0, 0.5, 1.0, 1.0, 0.5, 1.0),
    CropParam("b", 2, 3, 1.0, 0.1, 0.2, 0.4, 2.0, 0.1, 3.0),
)


@pytest.fixture(scope="module")
def two(spark):
    return params_table(spark, CROPS)


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_back_schedule_skips_unreachable_weeks(spark, two):
    demand = spark.createDataFrame(
        [("a", 1, 9.0), ("a", 3, 3.0), ("b", 3, 0.0), ("b", 4, 0.9), ("b", 2, 5.0)], DEMAND
    )
    assert rows(schedule.back_schedule(demand, two), "crop", "plant_week", "harvest_week",
                "trays") == [("a", 2, 3, 2), ("b", 2, 4, 1)]


def test_ledger_counts_weeks_in_the_rack(spark, two):
    plan = spark.createDataFrame([("b", 1, 4, 5), ("b", 3, 5, 2), ("a", 2, 2, 7)], PLAN)
    stock = rows(ledger.occupancy(plan), "crop", "week_id", "trays_in_stock")
    assert stock == [("b", 1, 5), ("b", 2, 5), ("b", 3, 7), ("b", 4, 2)]
    assert sum(s[2] for s in stock) == 5 * 3 + 2 * 2


def recurrence(planted, harvested, init, crop, weeks, top):
    """Stock by (week, age), one week from the other, as the constraints state it."""
    stock = {}
    for week in range(1, weeks + 1):
        for age in range(top + 1):
            if age == 0:
                before = planted.get((crop, week), 0)
            elif week == 1:
                before = init.get((crop, age - 1), 0)
            else:
                before = stock[week - 1, age - 1]
            stock[week, age] = before - harvested.get((crop, week, age), 0)
    return stock


@pytest.mark.parametrize("seed", range(3))
def test_wip_matches_the_recurrence(spark, two, seed):
    rng = random.Random(seed)
    weeks, top = 8, 3
    planted = {(c, w): rng.randint(0, 5) for c in "ab" for w in range(1, weeks + 1)}
    init = {(c, a): rng.randint(0, 4) for c in "ab" for a in range(0, 3)}
    limit = {"a": 2, "b": 3}
    init = {k: v for k, v in init.items() if k[1] < limit[k[0]]}
    harvested = {(c, w, a): rng.randint(0, 3) for c in "ab" for w in range(1, weeks + 1)
                 for a in range(top + 1)}
    got = {
        (r.crop, r.week_id, r.age): r.wip
        for r in ledger.wip_by_age(
            spark.createDataFrame([(c, w, n) for (c, w), n in planted.items()],
                                  "crop string, plant_week int, trays long"),
            spark.createDataFrame([(c, w - a, w, n) for (c, w, a), n in harvested.items()], PLAN),
            two, weeks,
            spark.createDataFrame([(c, a, n) for (c, a), n in init.items()],
                                  "crop string, age int, qty long"),
        ).collect()
    }
    for crop in "ab":
        for (week, age), wip in recurrence(planted, harvested, init, crop, weeks, top).items():
            # Cells of a cohort that was never planted nor held start below the table.
            assert got.get((crop, week, age), 0) == wip


def test_lag_finds_the_cell_before(spark, two):
    plan = spark.createDataFrame([("b", 1, 3, 4)], PLAN)
    wip = ledger.wip_by_age(schedule.planted(plan), plan, two, 4)
    assert rows(ledger.join_age_lag(wip), "week_id", "age", "wip", "previous_wip") == [
        (2, 1, 4, 4), (3, 2, 0, 4), (4, 3, 0, 0)]


@pytest.mark.parametrize("seed", range(2))
def test_shift_choice_is_the_cheapest_split(spark, seed):
    """Against trying every number of shift trays, with one tray = one harvest hour."""
    rng = random.Random(seed)
    scen = Scenario(base_labor_hours_per_week=20.0, overtime_block_hours=(5.0, 5.0),
                    shift_fixed_cost_per_week=40.0, shift_labor_reduction_pct=0.25)
    weeks = [(w, float(rng.randint(0, 15)), rng.randint(0, 25)) for w in range(1, 60)]
    labor = spark.createDataFrame([(w, p, float(h)) for w, p, h in weeks],
                                  "week_id int, plant_hours double, harvest_hours double")
    got = {r.week_id: r for r in capacity.shift_choice(labor, scen).collect()}
    for week, plant, harvest in weeks:
        best = None
        for on in (0, 1):
            for shifted in range(harvest * on + 1):
                hours = plant + harvest - 0.25 * shifted
                overtime = max(0.0, hours - 20.0)
                if overtime <= 10.0:
                    cost = 24.0 * hours + 12.0 * overtime + 40.0 * on
                    best = cost if best is None else min(best, cost)
        row = got[week]
        assert row.overtime_feasible == (best is not None)
        if best is not None:
            assert row.labor_cost == pytest.approx(best)


def test_overtime_blocks(spark):
    labor = spark.createDataFrame([(1, 200.0), (2, 221.0), (3, 260.0), (4, 261.0), (5, 400.0)],
                                  "week_id int, labor_used_hours double")
    got = capacity.overtime_need(labor, Scenario())
    assert rows(got, "week_id", "overtime_hours", "overtime_blocks_enabled",
                "overtime_feasible") == [
        (1, 0.0, 0, True), (2, 1.0, 1, True), (3, 40.0, 1, True), (4, 41.0, 2, True),
        (5, 180.0, 2, False)]
    none = Scenario(overtime_block_hours=())
    assert rows(capacity.overtime_need(labor, none), "overtime_blocks_enabled",
                "overtime_feasible")[-1] == (0, True)


def exact_cost(crop, demand, price, scen, trays):
    """Cost of one crop's plan {(plant, harvest): trays}, or None if a constraint breaks."""
    weeks = len(demand)
    gain = crop.yield_lbs_per_tray * (1 - crop.shrink)
    total = 0.0
    for week in range(1, weeks + 1):
        harvested = sum(n for (p, h), n in trays.items() if h == week)
        planted = sum(n for (p, h), n in trays.items() if p == week)
        stock = sum(n for (p, h), n in trays.items() if p <= week < h)
        waste = gain * harvested - demand[week - 1]
        if waste < -1e-9 or stock > scen.rack_capacity_trays_per_week \
                or harvested > scen.base_process_capacity_trays_per_week:
            return None
        options = []
        for on in (0, 1):
            hours = planted * crop.plant_hours_per_tray + harvested * crop.harvest_hours_per_tray \
                * (1 - on * scen.shift_labor_reduction_pct)
            overtime = max(0.0, hours - scen.base_labor_hours_per_week)
            if overtime <= sum(scen.overtime_block_hours) + 1e-9:
                options.append(scen.base_wage_per_hour * hours
                               + scen.overtime_premium_per_hour * overtime
                               + scen.shift_fixed_cost_per_week * on)
        if not options:
            return None
        total += min(options) + crop.seed_cost_per_tray * planted \
            + crop.nutrient_cost_per_tray_week * stock \
            + crop.energy_kwh_per_tray_week * price[week - 1] * stock \
            + scen.disposal_cost_per_lb_waste * waste
    return total


def test_certificate_against_every_plan(spark):
    """Small random instances, all solved at once as facilities and by enumeration."""
    rng = random.Random(7)
    crop = CROPS[0]
    one = params_table(spark, [crop])
    slots = [(p, p + a) for p in (1, 2, 3) for a in (1, 2) if p + a <= 4]
    cases = []
    for _ in range(60):
        demand = [0.0] + [rng.choice([0.0, 1.5, 2.0, 3.0, 4.0]) for _ in range(3)]
        price = [rng.choice([0.05, 0.4]) for _ in range(4)]
        scen = Scenario(
            rack_capacity_trays_per_week=rng.choice([1, 2, 3, 9]),
            base_process_capacity_trays_per_week=rng.choice([1, 2, 3]),
            base_labor_hours_per_week=rng.choice([0.5, 1.5, 3.0]),
            overtime_block_hours=rng.choice([(0.5,), (1.0, 1.0), ()]),
            shift_fixed_cost_per_week=rng.choice([2.0, 20.0]),
        )
        best = None
        for counts in itertools.product(range(4), repeat=len(slots)):
            cost = exact_cost(crop, demand, price, scen,
                              {s: n for s, n in zip(slots, counts) if n})
            if cost is not None:
                best = cost if best is None else min(best, cost)
        cases.append((demand, price, scen, best))
    key = ["facility"]
    demand = spark.createDataFrame(
        [(k, "a", w + 1, d) for k, c in enumerate(cases) for w, d in enumerate(c[0])],
        "facility long, " + DEMAND)
    price = spark.createDataFrame(
        [(k, w + 1, p) for k, c in enumerate(cases) for w, p in enumerate(c[1])],
        "facility long, " + PRICE)
    sizes = spark.createDataFrame(
        [(k, float(s.rack_capacity_trays_per_week), float(s.base_process_capacity_trays_per_week),
          s.base_labor_hours_per_week, list(s.overtime_block_hours), s.shift_fixed_cost_per_week)
         for k, (_, _, s, _) in enumerate(cases)],
        "facility long, r double, p double, l double, o array<double>, f double")
    scen = scenario_table(
        sizes, Scenario(), rack_capacity_trays_per_week=F.col("r"),
        base_process_capacity_trays_per_week=F.col("p"), base_labor_hours_per_week=F.col("l"),
        overtime_block_hours=F.col("o"), shift_fixed_cost_per_week=F.col("f"),
    )
    got = {r.facility: r for r in selection.plan_certificate(demand, one, price, scen, 4, key)
           .collect()}
    seen = set()
    for k, (_, _, _, best) in enumerate(cases):
        row = got[k]
        seen.add(row.status)
        if row.status == "infeasible_proven":
            assert best is None
        elif row.status == "optimal":
            assert best == pytest.approx(row.total_cost)
        elif row.status == "feasible_gap":
            assert row.lower_bound - 1e-9 <= best <= row.total_cost + 1e-9
        if best is not None:
            assert row.lower_bound <= best + 1e-9
    assert {"infeasible_proven", "optimal", "undecided"} <= seen


def test_certificate_with_initial_stock_never_claims_optimality(spark, two):
    demand = spark.createDataFrame([("a", 2, 2.0)], DEMAND)
    price = spark.createDataFrame([(1, 0.1), (2, 0.1)], PRICE)
    plan = schedule.back_schedule(demand, two)
    evaluated = costs.evaluate_weeks(plan, demand, two, price, Scenario(), 2)
    assert selection.certify(evaluated).first().status == "optimal"
    assert selection.certify(evaluated, initial_stock=True).first().status == "feasible"


def test_policy_sweep_against_each_policy(spark, two):
    """Every policy evaluated on its own gives the same cost as the sweep."""
    demand = spark.createDataFrame(
        [(c, w, float((w * 7 + len(c)) % 9)) for c in "ab" for w in range(4, 11)], DEMAND)
    price = spark.createDataFrame([(w, 0.05 * (1 + w % 3)) for w in range(1, 11)], PRICE)
    scen = Scenario(base_labor_hours_per_week=3.0, overtime_block_hours=(4.0, 4.0),
                    shift_fixed_cost_per_week=3.0)
    swept = {r.policy: (r.total_cost, r.feasible) for r in selection.evaluate_policies(
        demand, two, price, scen, 10).collect()}
    assert len(swept) == 4
    for policy in range(4):
        offset = F.when(F.col("crop") == "a", policy % 2).otherwise(policy // 2)
        plan = selection.offset_plans(demand, two).filter(F.col("age_offset") == offset)
        dense = demand.unionByName(
            spark.range(1, 11).selectExpr("'a' AS crop", "cast(id AS int) AS week_id",
                                          "0D AS demand_lbs"))
        row = costs.cost_breakdown(
            costs.evaluate_weeks(plan, dense, two, price, scen, 10)).first()
        assert swept[policy][0] == pytest.approx(row.total_cost)
    best = selection.policy_sweep(demand, two, price, scen, 10).first()
    feasible = {p: c for p, (c, ok) in swept.items() if ok}
    assert best.feasible_policies == len(feasible)
    assert best.best_cost == pytest.approx(min(feasible.values()))


def test_cost_parts_add_up(spark, two):
    demand = spark.createDataFrame(
        [(c, w, float(w % 4)) for c in "ab" for w in range(4, 9)], DEMAND)
    price = spark.createDataFrame([(w, 0.2) for w in range(1, 9)], PRICE)
    scen = Scenario(base_labor_hours_per_week=2.0)
    plan = schedule.back_schedule(demand, two)
    whole = costs.cost_breakdown(costs.evaluate_weeks(plan, demand, two, price, scen, 8)).first()
    parts = [
        costs.cost_seed(plan, two), costs.cost_nutrient(plan, two),
        costs.cost_energy(plan, two, price), costs.cost_labor_base(plan, two, scen),
        costs.cost_overtime(plan, two, scen), costs.cost_shift(plan, two, scen),
        costs.cost_disposal(plan, demand, two, scen),
    ]
    values = [df.first()[0] for df in parts]
    assert values == pytest.approx(list(whole)[:7])
    assert sum(values) == pytest.approx(whole.total_cost)


@pytest.mark.parametrize("seed", range(4))
def test_fifo_plan_is_clean(spark, two, seed):
    """No stock is lost, none is harvested outside its window or twice, and demand that
    planting can reach is met."""
    rng = random.Random(seed)
    stock = [(c, a, rng.randint(0, 6)) for c in "ab" for a in range(0, 4)]
    wanted = [(c, w, float(rng.randint(0, 6))) for c in "ab" for w in range(1, 9)]
    init = spark.createDataFrame(stock, "crop string, age int, qty long")
    demand = spark.createDataFrame(wanted, DEMAND)
    plan = schedule.initial_wip_fifo(demand, init, two)
    found = rows(plan, "crop", "plant_week", "harvest_week", "trays")
    window = {"a": (1, 2), "b": (2, 3)}
    assert all(window[c][0] <= h - p <= window[c][1] and n > 0 for c, p, h, n in found)
    usable = sum(q for c, a, q in stock if a < window[c][1])
    assert sum(n for c, p, h, n in found if p <= 0) == usable
    kinds = {r.kind for r in audit.constraint_audit(
        plan, demand, two, Scenario(), 8, init=init).collect()}
    assert kinds <= {"demand_balance"}
    short = [r for r in ledger.demand_balance(plan, demand, two, 8).collect() if r.is_short]
    assert all(r.week_id <= window[r.crop][0] for r in short)
    # In each crop the stock serves as much as any matching of lots to weeks can.
    per_tray = {"a": 2.0, "b": 0.9}
    for crop in "ab":
        low, high = window[crop]
        lots = [(a, q) for c, a, q in stock if c == crop and a < high]
        needs = {w: math.ceil(d / per_tray[crop] - 1e-9) for c, w, d in wanted if c == crop and w <= high}
        got = collections.Counter()
        for c, p, h, n in found:
            if c == crop and p <= 0:
                got[h] += n
        served = sum(min(got[w], needs[w]) for w in needs)
        assert served == most_served(lots, needs, low, high)


def most_served(lots, needs, low, high):
    """Greatest number of trays that lots can serve: over every set of weeks, what the lots
    that fit one of them hold bounds it, and the least bound is reached."""
    weeks = list(needs)
    best = sum(needs.values())
    for k in range(1, len(weeks) + 1):
        for chosen in itertools.combinations(weeks, k):
            reach = sum(q for a, q in lots if any(low <= a + w <= high for w in chosen))
            best = min(best, reach + sum(n for w, n in needs.items() if w not in chosen))
    return best


def test_a_young_lot_waits_for_its_week(spark):
    crop = (CropParam("x", 3, 4, 1.0, 0.0, 0.1, 0.1, 0.1, 0.1, 0.1),)
    init = spark.createDataFrame([("x", 3, 20), ("x", 0, 10)], "crop string, age int, qty long")
    demand = spark.createDataFrame([("x", 1, 10.0), ("x", 3, 10.0)], DEMAND)
    plan = rows(schedule.initial_wip_fifo(demand, init, params_table(spark, crop)),
                "plant_week", "harvest_week", "trays")
    assert (0, 3, 10) in plan and (-3, 1, 10) in [(p, h, min(n, 10)) for p, h, n in plan]


def test_feasibility_issues(spark, two):
    demand = spark.createDataFrame([("a", 1, 4.0), ("a", 2, 600.0), ("b", 5, 1.0)], DEMAND)
    issues = feasibility.issues_all(demand, two, Scenario())
    assert {r.kind for r in issues.collect()} == {"early_demand", "process_cap", "labor_cap"}
    early = [r.message for r in issues.collect() if r.kind == "early_demand"]
    assert early == ["Demand for crop=a, week=1 is 4.00 lbs but no initial WIP is configured and "
                     "harvest cannot occur that early."]
    any_stock = spark.createDataFrame([("b", 0, 0)], "crop string, age int, qty long")
    assert "early_demand" not in {
        r.kind for r in feasibility.issues_all(demand, two, Scenario(), any_stock).collect()}
    barren = two.withColumn("shrink", F.when(F.col("crop") == "a", 1.0).otherwise(F.col("shrink")))
    assert feasibility.issue_nonpositive_yield(demand, barren).count() == 2
    row = feasibility.feasibility_only(demand.filter("crop = 'b'"), two, Scenario()).first()
    assert row.feasible and row.termination_condition == "feasible_precheck_passed"


def test_audit_names_each_fault(spark, two):
    demand = spark.createDataFrame([("a", 3, 4.0)], DEMAND)
    plan = spark.createDataFrame([("a", 1, 4, 1), ("a", 2, 3, 1)], PLAN)
    planted = spark.createDataFrame([("a", 1, 2), ("a", 2, 0)],
                                    "crop string, plant_week int, trays long")
    scen = Scenario(rack_capacity_trays_per_week=1.0, base_labor_hours_per_week=0.1,
                    overtime_block_hours=())
    kinds = {r.kind for r in audit.constraint_audit(plan, demand, two, scen, 4, planted).collect()}
    assert kinds == {"harvest_available", "harvest_window", "max_age_clear", "demand_balance",
                     "rack_capacity", "labor_capacity"}


def test_more_rack_never_costs_more(spark, two):
    demand = spark.createDataFrame([("a", w, 6.0) for w in range(3, 7)], DEMAND)
    price = spark.createDataFrame([(w, 0.2) for w in range(1, 7)], PRICE)
    knobs = {"rack_capacity_trays_per_week": (1.0, 1000.0, 1400.0), "base_wage_per_hour": (20.0, 24.0)}
    sweep = selection.scenario_sweep(demand, two, price, Scenario(), knobs, 6)
    assert sweep.count() == 6 and sweep.filter("NOT feasible").count() == 2
    check = selection.monotone_check(sweep, ["base_wage_per_hour"]).collect()
    assert len(check) == 4 and all(r.monotone for r in check)


def test_price_gaps_and_repeats_change_no_status(spark, two):
    """A missing price takes the mean, several count as one, with or without a horizon."""
    demand = spark.createDataFrame(
        [(c, w, 40.0) for c in (CROPS[0].crop, CROPS[1].crop) for w in range(6, 11)],
        "crop string, week_id int, demand_lbs double")
    full = [(w, 0.2) for w in range(1, 11)]
    tables = {
        "full": full,
        "gaps": [r for r in full if r[0] not in (7, 8, 9)],
        "twice": full + full,
    }
    scen = Scenario(rack_capacity_trays_per_week=20)
    seen = set()
    for rows in tables.values():
        price = spark.createDataFrame(rows, PRICE)
        for weeks in (None, 10):
            r = selection.plan_certificate(demand, two, price, scen, weeks).first()
            seen.add((round(r.total_cost, 6), r.status, r.rack_over_weeks))
    assert len(seen) == 1
    empty = spark.createDataFrame([], PRICE)
    assert selection.plan_certificate(demand, two, empty, scen, 10).first().total_cost > 0
