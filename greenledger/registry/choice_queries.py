"""Plans chosen among many policies, bounds with overtime, and exact capacity breakpoints."""

from __future__ import annotations

from greenledger.plans import bound, breakpoints, costs, ledger, policy, schedule
from greenledger.registry.base import query
from greenledger.registry.inputs import FACILITY, LOOSE, WEEKS, Inputs
from greenledger.registry.sql import CTES, SHIFT_OUT, add_evaluation, certificate_sql, rnd, scenario_sql

D = "::DOUBLE"
#: Labor that every policy meets only with overtime in some weeks.
OVERTIME = {**LOOSE, "labor": 650.0, "block": 60.0}
CTES["scen_overtime"] = scenario_sql(OVERTIME)
add_evaluation("qv", "pol_plan", "pol_demand", "dense_price", "scen_overtime", "weeks", ("policy",))
CTES["pol_over_rated"] = certificate_sql("qv_ev", "policy, ")
CTES["pol_best"] = """
    SELECT arg_min(policy, (round(total_cost, 4), policy)) AS policy,
           arg_min(total_cost, (round(total_cost, 4), policy)) AS total_cost
    FROM pol_over_rated WHERE status IN ('optimal', 'feasible_gap')"""


def _choice(i: Inputs):
    return policy.policy_choice(i.late_demand, i.params, i.price, i.scenario(OVERTIME), WEEKS)


@query(
    "policy_choice",
    f"""SELECT crop, age_offset::INTEGER AS age_offset, {rnd('total_cost', 'total_cost')}, true AS feasible
        FROM policies JOIN pol_best USING (policy)""",
)
def _(i: Inputs):
    return _choice(i).filter("feasible")


@query(
    "policy_plan",
    "SELECT crop, plant_week, harvest_week, trays FROM pol_plan JOIN pol_best USING (policy)",
)
def _(i: Inputs):
    return policy.policy_plan(i.late_demand, i.params, _choice(i))


# Capacity breakpoints -------------------------------------------------------------------


def _ledger(i: Inputs):
    plan = schedule.back_schedule(i.late_demand, i.params)
    return ledger.week_ledger(plan, i.late_demand, i.params, i.price, WEEKS)


@query(
    "rack_breakpoints",
    f"""SELECT round(c, 6) AS capacity, (SELECT count(*) FROM rv_wk WHERE round(stock{D}, 6) > round(c, 6)) AS weeks_over
        FROM (SELECT DISTINCT stock{D} AS c FROM rv_wk UNION SELECT 0.0{D})""",
)
def _(i: Inputs):
    return breakpoints.load_breakpoints(_ledger(i), "trays_in_stock")


CTES["labor_corners"] = f"""
    SELECT DISTINCT round(b, 9) AS base FROM (
      SELECT unnest([0.0{D}, h_off, h_on, h_off - ceiling, h_on - ceiling,
                     h_off - (shift_cost - wage * (h_off - h_on)) / premium]) AS b FROM rv_in)
    WHERE b >= 0"""
CTES["labor_at"] = SHIFT_OUT.format(
    src="(SELECT * EXCLUDE (labor), base AS labor FROM rv_in CROSS JOIN labor_corners)")


@query(
    "labor_breakpoints",
    f"""SELECT {rnd('labor', 'capacity')}, {rnd('sum(labor_cost)', 'labor_cost')},
               count(*) FILTER (NOT overtime_feasible) AS weeks_over
        FROM labor_at GROUP BY labor""",
)
def _(i: Inputs):
    return breakpoints.labor_breakpoints(_ledger(i), i.scenario()).drop("slope")


# Bounds ------------------------------------------------------------------------------------

BOUND_ROUNDS = 3
CTES["bound_options"] = f"""
    SELECT crop, harvest_week, age, harvest_week - age AS plant_week, trays * plant_hours_per_tray AS ph,
           trays * (seed_cost_per_tray + nutrient_cost_per_tray_week * age
             + energy_kwh_per_tray_week * (SELECT sum(price_per_kwh) FROM dense_price p
                 WHERE p.week_id BETWEEN harvest_week - age AND harvest_week - 1)) AS tray_cost
    FROM (SELECT *, unnest(range(g_min_weeks, least(g_max_weeks, harvest_week - 1) + 1)) AS age
          FROM reach_plan JOIN params USING (crop))"""
CTES["bound_weeks"] = f"""
    SELECT week, sum(hh) AS hh, sum(waste) AS waste FROM (
      SELECT harvest_week AS week, trays * harvest_hours_per_tray AS hh, trays * eff - demand_lbs AS waste
      FROM reach_plan JOIN params USING (crop) JOIN reach ON reach.crop = reach_plan.crop AND week_id = harvest_week
      UNION ALL SELECT plant_week, 0.0{D}, 0.0{D} FROM bound_options) GROUP BY week"""
CTES["bound_p0"] = f"SELECT week, 0.0{D} AS mu FROM bound_weeks"
for _k in range(BOUND_ROUNDS):
    CTES[f"bound_c{_k}"] = f"""
    SELECT arg_min(plant_week, (round(money, 6), age)) AS week, arg_min(ph, (round(money, 6), age)) AS ph,
           arg_min(money, (round(money, 6), age)) AS money
    FROM (SELECT o.*, tray_cost + (wage + mu) * ph AS money
          FROM bound_options o JOIN bound_p{_k} ON week = plant_week CROSS JOIN scen_overtime)
    GROUP BY crop, harvest_week"""
    CTES[f"bound_w{_k}"] = f"""
    SELECT w.week, mu, coalesce(ph, 0.0{D}) AS ph, coalesce(money, 0.0{D}) AS money, (wage + mu) * hh AS off_cost,
           (wage + mu) * hh * (1.0{D} - red) + shift_cost AS on_cost, hh, waste, labor, premium, red, disposal
    FROM bound_weeks w JOIN bound_p{_k} USING (week) CROSS JOIN scen_overtime
    LEFT JOIN (SELECT week, sum(ph) AS ph, sum(money) AS money FROM bound_c{_k} GROUP BY week) USING (week)"""
    CTES[f"bound_p{_k + 1}"] = f"""
    SELECT week, greatest(0.0{D}, least(premium, mu + {4.0 / (_k + 1)}{D} * premium * (ph
             + CASE WHEN on_cost < off_cost THEN hh * (1.0{D} - red) ELSE hh END - labor)
             / greatest(labor, 1.0{D}))) AS mu FROM bound_w{_k}"""
CTES["bound_all"] = " UNION ALL ".join(
    f"SELECT {k} AS k, sum(money + least(off_cost, on_cost) - mu * labor + disposal * waste) AS b FROM bound_w{k}"
    for k in range(BOUND_ROUNDS))


@query(
    "overtime_bound",
    f"""SELECT {rnd('max(b) FILTER (k = 0)', 'free_overtime_bound')}, {rnd('max(b)', 'overtime_bound')}
        FROM bound_all""",
)
def _(i: Inputs):
    return bound.overtime_bound(
        i.late_demand, i.params, i.price, i.scenario(OVERTIME), WEEKS, rounds=BOUND_ROUNDS)


# Totals over every set of columns ---------------------------------------------------------------


@query(
    "cost_cube",
    f"""SELECT facility::INTEGER AS facility, crop, week_id, grouping(facility, crop, week_id)::INTEGER AS level,
               sum(stock)::BIGINT AS tray_weeks, {rnd('sum(seed_cost)', 'seed_cost')},
               {rnd('sum(nutrient_cost)', 'nutrient_cost')}, {rnd('sum(waste_lbs)', 'waste_lbs')}
        FROM nv_cw GROUP BY CUBE (facility, crop, week_id)""",
)
def _(i: Inputs):
    plan = schedule.back_schedule(i.nation_demand, i.params, FACILITY)
    valued = ledger.valued_ledger(
        ledger.crop_ledger(plan, i.nation_demand, WEEKS, FACILITY), i.params, FACILITY)
    return costs.cost_cube(valued, ("facility", "crop", "week_id"))
