"""Plans: feasibility, evaluation, audits, selection, reports and whole runs."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from greenledger.operators.rollup import rollup_price
from greenledger.plans import audit, capacity, costs, feasibility, jobs, ledger, report, selection
from greenledger.plans import schedule
from greenledger.registry.base import query
from greenledger.registry.inputs import (
    FACILITY,
    LATE_WEEKS,
    LOOSE,
    MONOTONE,
    SEED,
    SWEEP,
    SWEEP_RATES,
    SYNTH_START,
    SYNTH_WEEKS,
    TIGHT,
    WEEKS,
    Inputs,
)
from greenledger.registry.sql import (
    CTES,
    SHIFT_OUT,
    SHIFT_SQL,
    UTIL_COLS,
    COST_NAMES,
    blocks_used,
    certificate_out,
    certificate_sql,
    cost_sql,
    rnd,
)
from greenledger.session import scratch_dir, written
from greenledger.sources import schemas, tables

D = "::DOUBLE"

# Feasibility -----------------------------------------------------------------------

ISSUE_COLS = "kind, crop, week_id, value, \"limit\", message"


def _issue_sql(kind: str, crop: str, value: str, limit: str, message: str, rest: str) -> str:
    return (f"SELECT '{kind}' AS kind, {crop} AS crop, week_id, {rnd(value, 'value')}, "
            f"{rnd(limit, '\"limit\"')}, {message} AS message {rest}")


CTES["required"] = f"""
    SELECT week_id, sum(demand_lbs / eff) AS trays,
           sum(demand_lbs / eff * (plant_hours_per_tray + harvest_hours_per_tray * 0.85{D})) AS hours
    FROM dense JOIN params USING (crop) GROUP BY ALL"""
# The texts of the issues, as the operators write them.
EARLY_SQL = _issue_sql(
    "early_demand", "crop", "demand_lbs", f"0.0{D}",
    "printf('Demand for crop=%s, week=%d is %.2f lbs but no initial WIP is configured and "
    "harvest cannot occur that early.', crop, week_id, demand_lbs)",
    f"FROM dense JOIN params USING (crop) WHERE demand_lbs > 1e-6{D} AND week_id <= g_min_weeks",
)
YIELD_SQL = _issue_sql(
    "nonpositive_yield", "crop", f"0.0{D}", f"0.0{D}",
    "printf('Crop=%s has non-positive effective yield.', crop)",
    "FROM dense WHERE crop IN ('LARGE', 'SMALL')",
)
PROCESS_SQL = _issue_sql(
    "process_cap", "NULL::VARCHAR", "trays", "process",
    "printf('Week %d: required harvested trays %.1f exceeds process cap %.1f.', week_id, trays, "
    "process)",
    f"FROM required CROSS JOIN scen WHERE trays > process + 1e-6{D}",
)
LABOR_SQL = _issue_sql(
    "labor_cap", "NULL::VARCHAR", "hours", "labor + list_sum(blocks)",
    "printf('Week %d: required labor %.1f hours exceeds max labor cap %.1f.', week_id, hours, "
    "labor + list_sum(blocks))",
    f"FROM required CROSS JOIN scen WHERE hours > labor + list_sum(blocks) + 1e-6{D}",
)
# The shipped cap is above every week's need; the check is also shown at a tighter cap.
LOW_LABOR = {**TIGHT, "labor": 480.0}


@query("issue_early_demand", EARLY_SQL)
def _(i: Inputs):
    return feasibility.issue_early_demand(i.demand, i.params)


@query("issue_nonpositive_yield", YIELD_SQL)
def _(i: Inputs):
    lossy = F.when(F.col("crop").isin("LARGE", "SMALL"), 1.0).otherwise(F.col("shrink"))
    return feasibility.issue_nonpositive_yield(i.demand, i.params.withColumn("shrink", lossy))


@query("issue_process_cap", PROCESS_SQL)
def _(i: Inputs):
    return feasibility.issue_process_cap(i.demand, i.params, i.scenario())


CTES["scen_low_labor"] = CTES["scen"].replace("620.0::DOUBLE", "480.0::DOUBLE")


@query("issue_labor_cap", LABOR_SQL.replace("CROSS JOIN scen ", "CROSS JOIN scen_low_labor "))
def _(i: Inputs):
    return feasibility.issue_labor_cap(i.demand, i.params, i.scenario(LOW_LABOR))


@query("issues_all", f"{EARLY_SQL} UNION ALL {PROCESS_SQL} UNION ALL {LABOR_SQL}")
def _(i: Inputs):
    return feasibility.issues_all(i.demand, i.params, i.scenario())


def _exact_sql(name: str, used: str) -> str:
    return _issue_sql(
        f"{name}_exact", "NULL::VARCHAR", f"{used}{D}", name,
        f"printf('Week %d: the least possible {name} use %.1f exceeds its cap %.1f, so no plan "
        f"exists.', week_id, {used}{D}, {name})",
        f"FROM jv_wk CROSS JOIN scen WHERE {used} > {name} + 1e-6{D}",
    )


@query(
    "issue_rack_or_process_exact",
    f"{_exact_sql('rack', 'stock')} UNION ALL {_exact_sql('process', 'harvested')}",
)
def _(i: Inputs):
    return feasibility.issue_rack_or_process_exact(i.demand, i.params, i.scenario(), WEEKS)


@query(
    "feasibility_only",
    f"""SELECT 'not_run' AS solver_status,
               CASE WHEN n = 0 THEN 'feasible_precheck_passed' ELSE 'feasible_precheck_failed' END
                 AS termination_condition, n = 0 AS feasible, n AS issues
        FROM (SELECT count(*) AS n FROM ({EARLY_SQL} UNION ALL {PROCESS_SQL}
              UNION ALL {LABOR_SQL}))""",
)
def _(i: Inputs):
    return feasibility.feasibility_only(i.demand, i.params, i.scenario())


# Plan evaluation -----------------------------------------------------------------------


@query("plan_backschedule", "SELECT crop, plant_week, harvest_week, trays FROM jit")
def _(i: Inputs):
    return i.plan


@query("wip_by_age", "SELECT crop, week_id, age, wip FROM jit_wip")
def _(i: Inputs):
    return ledger.wip_by_age(i.plan_planted, i.plan, i.params, WEEKS)


@query("wip_by_age_initial", "SELECT crop, week_id, age, wip FROM fifo_wip")
def _(i: Inputs):
    plan = schedule.initial_wip_fifo(i.demand_after_stock, i.initial_stock, i.params)
    return ledger.wip_by_age(
        schedule.planted(plan), plan, i.params, LATE_WEEKS, i.initial_stock
    )


@query("audit_harvest_available", "SELECT crop, week_id, age, wip FROM over_wip WHERE wip < 0")
def _(i: Inputs):
    harvested = i.changed_harvest(11, 2)
    return audit.audit_harvest_available(
        ledger.wip_by_age(i.plan_planted, harvested, i.params, WEEKS)
    )


@query(
    "audit_harvest_window",
    """SELECT crop, plant_week, harvest_week, trays, harvest_week - plant_week AS age
       FROM late JOIN params USING (crop)
       WHERE harvest_week - plant_week NOT BETWEEN g_min_weeks AND g_max_weeks""",
)
def _(i: Inputs):
    return audit.audit_harvest_window(i.late_plan(), i.params).select(
        "crop", "plant_week", "harvest_week", "trays", "age"
    )


@query(
    "audit_max_age_clear",
    """SELECT crop, week_id, age, wip, g_max_weeks FROM left_wip JOIN params USING (crop)
       WHERE age >= g_max_weeks AND wip > 0""",
)
def _(i: Inputs):
    harvested = i.changed_harvest(13, -1)
    wip = ledger.wip_by_age(i.plan_planted, harvested, i.params, WEEKS)
    return audit.audit_max_age_clear(wip, i.params)


@query(
    "demand_balance",
    f"""SELECT crop, week_id, harvested AS trays_harvested, {rnd('produced_lbs', 'produced_lbs')},
               {rnd('demand_lbs', 'demand_lbs')}, {rnd('waste_lbs', 'waste_lbs')},
               {rnd('shortfall_lbs', 'shortfall_lbs')}, is_short FROM sv_cw""",
)
def _(i: Inputs):
    return ledger.demand_balance(i.changed_harvest(10, -1), i.demand, i.params, WEEKS)


PLANTING_SQL = "SELECT crop, week_id, planted AS trays_planted FROM jv_cw"


@query("planting_by_week", PLANTING_SQL)
def _(i: Inputs):
    return ledger.planting_by_week(i.plan, i.crop_grid)


def _usage_sql(name: str, used: str) -> str:
    return f"""
    SELECT week_id, {rnd(f'{used}{D}', f'{name}_used_trays')}, {rnd(name, f'{name}_capacity_trays')},
           {rnd(f'{used} / greatest({name}, 1)', f'{name}_utilization')},
           {used} > {name} + 1e-6{D} AS over_capacity
    FROM jv_wk CROSS JOIN scen WHERE {used} > 0"""


@query("rack_usage", _usage_sql("rack", "stock"))
def _(i: Inputs):
    return capacity.rack_usage(i.plan, i.scenario(), WEEKS)


@query("process_usage", _usage_sql("process", "harvested"))
def _(i: Inputs):
    return capacity.process_usage(i.plan, i.scenario(), WEEKS)


@query(
    "labor_hours",
    f"""SELECT week_id, {rnd('plant_hours', 'plant_hours')}, {rnd('harvest_hours', 'harvest_hours')},
               {rnd('h_off', 'labor_hours_shift_off')}, {rnd('h_on', 'labor_hours_shift_on')}
        FROM jv_in WHERE planted + harvested > 0""",
)
def _(i: Inputs):
    return capacity.labor_hours(i.plan, i.params, i.scenario(), WEEKS)


CTES["ot_need"] = f"""
    SELECT week_id, h_off, greatest(h_off - labor, 0.0{D}) AS ot, blocks, ceiling FROM jv_in
    WHERE planted + harvested > 0"""


@query(
    "overtime_need",
    f"""SELECT week_id, {rnd('h_off', 'labor_used_hours')}, {rnd('ot', 'overtime_hours')},
               {blocks_used('ot')} AS overtime_blocks_enabled,
               ot <= ceiling + 1e-6{D} AS overtime_feasible FROM ot_need""",
)
def _(i: Inputs):
    labor = capacity.labor_hours(i.plan, i.params, i.scenario(), WEEKS).select(
        "week_id", F.col("labor_hours_shift_off").alias("labor_used_hours")
    )
    return capacity.overtime_need(labor, i.scenario())


@query(
    "shift_choice",
    f"""SELECT week_id, shift_on, {rnd('labor_used_hours', 'labor_used_hours')},
               {rnd('overtime_hours', 'overtime_hours')},
               {blocks_used('overtime_hours')} AS overtime_blocks_enabled, overtime_feasible,
               {rnd('labor_cost', 'labor_cost')}, {rnd('labor_cost_floor', 'labor_cost_floor')}
        FROM jv_sh WHERE planted + harvested > 0""",
)
def _(i: Inputs):
    return capacity.shift_choice(capacity.labor_base(i.plan, i.params, WEEKS), i.scenario())


def _part_sql(name: str) -> str:
    return f"SELECT {rnd(f'sum({name})', name)} FROM jv_ev"


@query("cost_seed", _part_sql("seed_cost"))
def _(i: Inputs):
    return costs.cost_seed(i.plan, i.params)


@query("cost_nutrient", _part_sql("nutrient_cost"))
def _(i: Inputs):
    return costs.cost_nutrient(i.plan, i.params, WEEKS)


@query("cost_energy", _part_sql("energy_cost"))
def _(i: Inputs):
    return costs.cost_energy(i.plan, i.params, i.price, WEEKS)


@query(
    "cost_energy_weekly",
    f"""SELECT week_id, {rnd('energy_kwh', 'energy_kwh')}, {rnd('price_per_kwh', 'price_per_kwh')},
               {rnd('energy_cost', 'energy_cost')} FROM jv_ev WHERE stock > 0""",
)
def _(i: Inputs):
    return costs.energy_by_week(i.plan, i.params, i.price, WEEKS)


@query("cost_labor_base", _part_sql("labor_base_cost"))
def _(i: Inputs):
    return costs.cost_labor_base(i.plan, i.params, i.scenario(), WEEKS)


@query("cost_overtime", _part_sql("overtime_premium_cost"))
def _(i: Inputs):
    return costs.cost_overtime(i.plan, i.params, i.scenario(), WEEKS)


@query("cost_shift", _part_sql("shift_fixed_cost"))
def _(i: Inputs):
    return costs.cost_shift(i.plan, i.params, i.scenario(), WEEKS)


@query("cost_disposal", _part_sql("disposal_cost"))
def _(i: Inputs):
    return costs.cost_disposal(i.plan, i.demand, i.params, i.scenario(), WEEKS)


def _evaluated(i: Inputs):
    return costs.evaluate_weeks(i.plan, i.demand, i.params, i.price, i.scenario(), WEEKS)


@query("cost_breakdown", cost_sql("jv_ev"))
def _(i: Inputs):
    return costs.cost_breakdown(_evaluated(i))


def _audit_sql(plan: str, wip: str, ev: str) -> str:
    none = "NULL::INTEGER"
    return f"""
    SELECT kind, crop, week_id, age::INTEGER AS age, {rnd('value', 'value')},
           {rnd('lim', '"limit"')} FROM (
      SELECT 'harvest_available' AS kind, crop, week_id, age, wip{D} AS value, 0.0{D} AS lim
      FROM {wip} WHERE wip < 0
      UNION ALL
      SELECT 'harvest_window', crop, harvest_week, harvest_week - plant_week,
             harvest_week - plant_week,
             CASE WHEN harvest_week - plant_week < g_min_weeks THEN g_min_weeks ELSE g_max_weeks END
      FROM {plan} JOIN params USING (crop)
      WHERE harvest_week - plant_week NOT BETWEEN g_min_weeks AND g_max_weeks
      UNION ALL
      SELECT 'max_age_clear', crop, week_id, age, wip, 0.0 FROM {wip} JOIN params USING (crop)
      WHERE age >= g_max_weeks AND wip > 0
      UNION ALL
      SELECT 'demand_balance', crop, week_id, {none}, produced_lbs, demand_lbs
      FROM {ev}_cw WHERE is_short
      UNION ALL
      SELECT 'rack_capacity', NULL, week_id, {none}, stock, rack FROM {ev}_in
      WHERE stock > rack + 1e-6{D}
      UNION ALL
      SELECT 'process_capacity', NULL, week_id, {none}, harvested, process FROM {ev}_in
      WHERE harvested > process + 1e-6{D}
      UNION ALL
      SELECT 'labor_capacity', NULL, week_id, {none}, overtime_hours, ceiling FROM {ev}_sh
      WHERE NOT overtime_feasible)"""


@query("constraint_audit", _audit_sql("late", "late_wip", "xv"))
def _(i: Inputs):
    return audit.constraint_audit(i.late_plan(), i.demand, i.params, i.scenario(), WEEKS)


@query("constraint_audit_separate", _audit_sql("over_h", "over_wip", "ov"))
def _(i: Inputs):
    return audit.constraint_audit(
        i.changed_harvest(11, 2), i.demand, i.params, i.scenario(), WEEKS, i.plan_planted
    )


@query("initial_wip_fifo", "SELECT crop, plant_week, harvest_week, trays FROM fifo_plan")
def _(i: Inputs):
    return schedule.initial_wip_fifo(i.demand_after_stock, i.initial_stock, i.params)


# Selection --------------------------------------------------------------------------------


@query("plan_certificate", certificate_out(certificate_sql("rv_ev")))
def _(i: Inputs):
    return selection.plan_certificate(i.late_demand, i.params, i.price, i.scenario(), WEEKS)


@query("plan_certificate_price_gaps", certificate_out(certificate_sql("rv_ev")))
def _(i: Inputs):
    """The same from the weekly prices as they are: a week without one takes the mean."""
    price = rollup_price(i.prices_daily())
    return selection.plan_certificate(i.late_demand, i.params, price, i.scenario(), WEEKS)


@query("plan_certificate_loose", certificate_out(certificate_sql("lv_ev")))
def _(i: Inputs):
    return selection.plan_certificate(i.late_demand, i.params, i.price, i.scenario(LOOSE), WEEKS)


SWEEP_KEYS = "rack, process, labor, "
SWEEP_NAMES = (
    "rack AS rack_capacity_trays_per_week, process AS base_process_capacity_trays_per_week, "
    "labor AS base_labor_hours_per_week, "
)
RATE_KEYS = "wage, price_factor, "
RATE_NAMES = "wage AS base_wage_per_hour, price_factor, "
SCALE_SQL = "(SELECT count(*)::DOUBLE / 60000.0::DOUBLE FROM lineitem)"


def _values(name: str, values: tuple[float, ...], scaled: bool) -> str:
    rows = ", ".join(f"({v}{D}{' * ' + SCALE_SQL if scaled else ''})" for v in values)
    return f"(VALUES {rows}) {name}_t({name})"


def _sweep_ctes(p: str, knobs: dict[str, tuple[float, ...]], scaled: bool) -> None:
    """Evaluate the rv week ledger under every scenario of a grid. A grid of capacities
    starts from the tight scenario, a grid of rates from the loose one."""
    grid = " CROSS JOIN ".join(_values(n, v, scaled) for n, v in knobs.items())
    fixed = ", ".join(n for n in ("rack", "process", "labor", "blocks", "shift_cost", "wage",
                                  "premium", "red", "disposal") if n not in knobs)
    price = "price_per_kwh"
    if "price_factor" in knobs:
        price = "price_per_kwh * price_factor AS price_per_kwh"
    source = "scen" if scaled else "scen_loose"
    CTES[f"{p}_base"] = f"""
    SELECT w.*, {fixed}, {', '.join(knobs)}, {price}
    FROM rv_wk w JOIN dense_price USING (week_id) CROSS JOIN (SELECT {fixed} FROM {source})
    CROSS JOIN {grid}"""
    CTES[f"{p}_in"] = SHIFT_SQL.format(src=f"{p}_base")
    CTES[f"{p}_sh"] = SHIFT_OUT.format(src=f"{p}_in")
    CTES[f"{p}_ev"] = f"""
    SELECT *, seed_cost + nutrient_cost + price_per_kwh * energy_kwh + wage * labor_used_hours
              + premium * overtime_hours + shift_cost * shift_on + disposal * waste_lbs
              AS total_cost FROM {p}_sh"""


SHORT_NAMES = {
    "rack_capacity_trays_per_week": "rack",
    "base_process_capacity_trays_per_week": "process",
    "base_labor_hours_per_week": "labor",
    "base_wage_per_hour": "wage",
    "price_factor": "price_factor",
}
for _p, _grid, _scaled in (("cs", SWEEP, True), ("ms", MONOTONE, True),
                           ("rs", SWEEP_RATES, False)):
    _sweep_ctes(_p, {SHORT_NAMES[n]: v for n, v in _grid.items()}, _scaled)
CTES["cs_rated"] = certificate_sql("cs_ev", SWEEP_KEYS)
CTES["ms_rated"] = certificate_sql("ms_ev", SWEEP_KEYS)
CTES["rs_rated"] = certificate_sql("rs_ev", RATE_KEYS)


def _sweep_out(source: str, names: str) -> str:
    return (f"SELECT {names}{rnd('total_cost', 'total_cost')}, "
            f"{rnd('total_cost - gap', 'lower_bound')}, {rnd('gap', 'gap')}, early_cells, "
            f"rack_over_weeks, process_over_weeks, labor_over_weeks, status, "
            f"status IN ('optimal', 'feasible_gap') AS feasible FROM {source}")


def _capacity_sweep(i: Inputs, grid=SWEEP):
    knobs = {name: [F.lit(v) * i.scale for v in values] for name, values in grid.items()}
    return selection.scenario_sweep(
        i.late_demand, i.params, i.price, i.scenario(), knobs, WEEKS
    )


@query("scenario_sweep", _sweep_out("cs_rated", SWEEP_NAMES))
def _(i: Inputs):
    return _capacity_sweep(i)


@query("scenario_sweep_rates", _sweep_out("rs_rated", RATE_NAMES))
def _(i: Inputs):
    return selection.scenario_sweep(
        i.late_demand, i.params, i.price, i.scenario(LOOSE), SWEEP_RATES, WEEKS
    )


@query(
    "policy_sweep",
    f"""SELECT count(*) AS policies, count(*) FILTER (feasible) AS feasible_policies,
               arg_min(policy, (c, policy)) FILTER (feasible) AS best_policy,
               {rnd("arg_min(total_cost, (c, policy)) FILTER (feasible)", "best_cost")}
        FROM (SELECT *, round(total_cost, 4) AS c, status IN ('optimal', 'feasible_gap')
              AS feasible FROM pol_rated)""",
)
def _(i: Inputs):
    return selection.policy_sweep(i.late_demand, i.params, i.price, i.scenario(LOOSE), WEEKS)


@query(
    "policy_costs",
    f"""SELECT policy, {rnd('total_cost', 'total_cost')},
               status IN ('optimal', 'feasible_gap') AS feasible FROM pol_rated""",
)
def _(i: Inputs):
    return selection.evaluate_policies(i.late_demand, i.params, i.price, i.scenario(LOOSE), WEEKS)


@query(
    "monotone_check",
    f"""SELECT {SWEEP_NAMES}{rnd('total_cost', 'total_cost')},
               {rnd('previous_cost', 'previous_cost')},
               coalesce(total_cost <= previous_cost + 1e-6{D}, true) AS monotone
        FROM (SELECT *, lag(total_cost) OVER (PARTITION BY process, labor ORDER BY rack)
              AS previous_cost FROM ms_rated WHERE status IN ('optimal', 'feasible_gap'))""",
)
def _(i: Inputs):
    others = [name for name in MONOTONE if name != "rack_capacity_trays_per_week"]
    return selection.monotone_check(_capacity_sweep(i, MONOTONE), others)


# Outputs and reports --------------------------------------------------------------------------


@query("solution_planting", PLANTING_SQL)
def _(i: Inputs):
    path = tables.table_path(scratch_dir(i.spark), "solution_planting", "csv")
    tables.write_csv(ledger.planting_by_week(i.plan, i.crop_grid), path)
    return tables.read_csv(i.spark, path, schemas.SOLUTION_PLANTING)


HARVEST_SQL = f"""
    SELECT crop, week_id, harvested AS trays_harvested, {rnd('produced_lbs', 'produced_lbs')},
           {rnd('demand_lbs', 'demand_lbs')}, {rnd('waste_lbs', 'waste_lbs')} FROM jv_cw"""


def _harvest(i: Inputs):
    return costs.solution_harvest(i.plan, i.demand, i.params, WEEKS)


@query("solution_harvest", HARVEST_SQL)
def _(i: Inputs):
    return _harvest(i)


@query("utilization_weekly", f"SELECT {UTIL_COLS} FROM jv_ev")
def _(i: Inputs):
    return costs.utilization_weekly(_evaluated(i))


@query("json_sink", cost_sql("jv_ev"))
def _(i: Inputs):
    path = tables.table_path(scratch_dir(i.spark), "cost_breakdown", "json")
    tables.write_json(costs.cost_breakdown(_evaluated(i)), path)
    return tables.read_json(i.spark, path, schemas.COST_BREAKDOWN)


@query("json_scan", f"SELECT crop, week_id, {rnd('demand_lbs', 'demand_lbs')} FROM dense")
def _(i: Inputs):
    path = tables.table_path(scratch_dir(i.spark), "demand_weekly", "json")
    tables.write_json(i.demand, path)
    return tables.read_json(i.spark, path, schemas.DEMAND_WEEKLY)


CTES["lv_rated"] = certificate_sql("lv_ev")


@query(
    "plan_summary",
    f"""SELECT {rnd("CASE WHEN ok THEN total_cost END", "objective_value")},
               CASE WHEN ok THEN 'ok' ELSE 'warning' END AS solver_status,
               status AS termination_condition, ok AS feasible
        FROM (SELECT *, status IN ('optimal', 'feasible_gap') AS ok FROM lv_rated)""",
)
def _(i: Inputs):
    return selection.plan_summary(
        selection.plan_certificate(i.late_demand, i.params, i.price, i.scenario(LOOSE), WEEKS)
    )


def _total(expr: str, source: str) -> str:
    return f"(SELECT {expr} FROM {source})"


RATIOS = {
    "rack": "stock / greatest(rack, 1)",
    "labor": "labor_used_hours / greatest(labor + overtime_hours, 1e-6)",
    "process": "harvested / greatest(process, 1)",
}
TOTALS_SQL = ", ".join([
    rnd(_total("sum(demand_lbs)", "demand_weekly"), "total_demand_lbs"),
    rnd(_total("sum(produced_lbs)", "jv_cw"), "total_produced_lbs"),
    rnd(_total("sum(waste_lbs)", "jv_cw"), "total_waste_lbs"),
])
MEANS_SQL = ", ".join(rnd(_total(f"avg({e})", "jv_ev"), f"avg_{n}_utilization")
                      for n, e in RATIOS.items())
SUMMARY_SQL = f"""
    SELECT {WEEKS}::INTEGER AS weeks, (SELECT count(*) FROM params)::INTEGER AS num_crops,
           {TOTALS_SQL}, {MEANS_SQL}, {rnd(_total("sum(total_cost)", "jv_ev"), "total_cost")}"""


@query("totals", f"SELECT {TOTALS_SQL}")
def _(i: Inputs):
    return report.plan_totals(i.demand_weekly, _harvest(i))


@query("mean_utilization", f"SELECT {MEANS_SQL}")
def _(i: Inputs):
    return report.mean_utilization(costs.utilization_weekly(_evaluated(i)))


@query(
    "production_vs_demand",
    f"""SELECT week_id, {rnd('produced_lbs', 'produced_lbs')}, {rnd('demand_lbs', 'demand_lbs')}
        FROM jv_wk""",
)
def _(i: Inputs):
    return report.production_by_week(_harvest(i))


def _summary(i: Inputs):
    evaluated = _evaluated(i)
    breakdown = costs.cost_breakdown(evaluated)
    summary = report.report_summary(
        i.demand_weekly, _harvest(i), costs.utilization_weekly(evaluated), breakdown, i.params,
        WEEKS,
    )
    return summary, breakdown


@query("report_summary", SUMMARY_SQL)
def _(i: Inputs):
    return _summary(i)[0]


LINE_TEXTS = [
    ("- Weeks: %d", "weeks"), ("- Crops: %d", "num_crops"),
    ("- Total demand (lbs): %.2f", "total_demand_lbs"),
    ("- Total produced (lbs): %.2f", "total_produced_lbs"),
    ("- Total waste (lbs): %.2f", "total_waste_lbs"),
    ("- Average rack utilization: %.2f%%", "avg_rack_utilization * 100"),
    ("- Average labor utilization: %.2f%%", "avg_labor_utilization * 100"),
    ("- Average process utilization: %.2f%%", "avg_process_utilization * 100"),
    ("- Total cost: $%.2f", "total_cost"),
]
# The texts of the report lines.
LINES_SQL = " UNION ALL ".join(
    [f"SELECT {n}::INTEGER AS line_no, printf('{text}', {expr}) AS line FROM summary_row"
     for n, (text, expr) in enumerate(LINE_TEXTS, 1)]
    + [f"SELECT {n}::INTEGER, printf('- {name}: $%.2f', {name}) FROM cost_row"
       for n, name in enumerate((*COST_NAMES, "total_cost"), len(LINE_TEXTS) + 1)]
)
CTES["summary_row"] = SUMMARY_SQL
CTES["cost_row"] = cost_sql("jv_ev")


@query("report_lines", LINES_SQL)
def _(i: Inputs):
    return report.report_lines(*_summary(i))


# Many facilities at once ---------------------------------------------------------------------


def _nation_weeks(i: Inputs):
    plan = schedule.back_schedule(i.nation_demand, i.params, FACILITY)
    return costs.evaluate_weeks(
        plan, i.nation_demand, i.params, i.price, i.scenario(share=0.04), WEEKS, FACILITY
    )


@query("cost_breakdown_by_facility", cost_sql("nv_ev", "facility, "))
def _(i: Inputs):
    return costs.cost_breakdown(_nation_weeks(i), FACILITY)


#: Sums of short decimals end in an exact half, which engines round either way.
OFF_HALVES = 1e-6
_LINE_VALUES = [
    ("weeks", f"{WEEKS}::INTEGER"), ("num_crops", "(SELECT count(*) FROM params)::INTEGER"),
    ("total_demand_lbs", f"coalesce(d, 0.0{D})"), ("total_produced_lbs", "sum(produced_lbs)"), ("total_waste_lbs", "sum(waste_lbs)"),
    *((f"avg_{n}_utilization", f"avg({e})") for n, e in RATIOS.items()), ("total_cost", "sum(total_cost)"),
]
_OFF = {"total": f" + {OFF_HALVES}{D}"}
CTES["nat_summary"] = f"""
    SELECT facility, {', '.join(f'{e}{_OFF.get(n[:5], "")} AS {n}' for n, e in _LINE_VALUES)}
    FROM nv_ev LEFT JOIN (SELECT facility, sum(demand_lbs) AS d FROM nat_facts GROUP BY facility) USING (facility)
    GROUP BY facility, d"""
CTES["nat_costs"] = "SELECT facility, " + ", ".join(
    f"sum({c}) + {OFF_HALVES}{D} AS {c}" for c in (*COST_NAMES, "total_cost")) + " FROM nv_ev GROUP BY facility"


@query(
    "report_lines_by_facility",
    re.sub(r"SELECT (\d+::INTEGER)", r"SELECT facility, \1", LINES_SQL).replace(
        "summary_row", "nat_summary").replace("cost_row", "nat_costs"),
)
def _(i: Inputs):
    """The report of every facility, as lines."""
    weeks = written(_nation_weeks(i))
    plan = schedule.back_schedule(i.nation_demand, i.params, FACILITY)
    harvest = costs.solution_harvest(plan, i.nation_demand, i.params, WEEKS, FACILITY)
    breakdown = costs.cost_breakdown(weeks, FACILITY)
    summary = report.report_summary(
        i.nation_lines(), harvest, costs.utilization_weekly(weeks, FACILITY), breakdown, i.params, WEEKS, FACILITY)

    def off_halves(df):
        return df.withColumns({c: F.col(c) + OFF_HALVES for c in df.columns if c.startswith("total") or c in COST_NAMES})

    return report.report_lines(off_halves(summary), off_halves(breakdown), FACILITY)


CTES["nv_rated"] = certificate_sql("nv_ev", "facility, ")


@query("plan_certificate_by_facility", certificate_out("SELECT * FROM nv_rated", "facility, "))
def _(i: Inputs):
    return selection.certify(_nation_weeks(i), FACILITY)


CTES["nat_required"] = f"""
    SELECT facility, week_id, sum(demand_lbs / eff) AS trays,
           sum(demand_lbs / eff * (plant_hours_per_tray + harvest_hours_per_tray * 0.85{D})) AS hours
    FROM nat_dense JOIN params USING (crop) GROUP BY ALL"""
CTES["nat_issues"] = f"""
    SELECT facility FROM nat_dense JOIN params USING (crop)
    WHERE demand_lbs > 1e-6{D} AND week_id <= g_min_weeks
    UNION ALL SELECT facility FROM nat_required CROSS JOIN nat_scen WHERE trays > process + 1e-6{D}
    UNION ALL SELECT facility FROM nat_required CROSS JOIN nat_scen
              WHERE hours > labor + list_sum(blocks) + 1e-6{D}"""


@query(
    "feasibility_by_facility",
    """SELECT facility, 'not_run' AS solver_status, CASE WHEN n = 0 THEN 'feasible_precheck_passed'
              ELSE 'feasible_precheck_failed' END AS termination_condition, n = 0 AS feasible, n AS issues
       FROM (SELECT n_nationkey::INTEGER AS facility, (SELECT count(*) FROM nat_issues i
                    WHERE i.facility = n_nationkey) AS n FROM nation)""",
)
def _(i: Inputs):
    return feasibility.feasibility_only(
        i.nation_demand, i.params, i.scenario(share=0.04), keys=FACILITY)


# Whole runs ------------------------------------------------------------------------------------


@query(
    "run_aggregate",
    f"""SELECT 'demand_weekly' AS table_name, crop, week_id, {rnd('demand_lbs', 'value')}
        FROM demand_weekly
        UNION ALL SELECT 'energy_price_weekly', NULL, week_id, {rnd('price_per_kwh', 'value')}
        FROM price_weekly
        UNION ALL SELECT 'telemetry_weekly', crop, week_id, {rnd('sum(kwh_used)', 'value')}
        FROM tele_rows GROUP BY ALL
        UNION ALL SELECT 'crop_params', crop, NULL, {rnd('yield_lbs_per_tray', 'value')} FROM used_params""",
)
def _(i: Inputs):
    out = f"{scratch_dir(i.spark)}/weekly"
    jobs.aggregate_frames(i.spark, _daily(i, i.telemetry_rows()), out)
    return _stacked(i, out)


def _daily(i: Inputs, telemetry) -> dict:
    """The four daily tables, from the given ones."""
    return {"demand_daily": i.demand_daily(), "prices_energy_daily": i.prices_daily(),
            "crop_params": i.used_params, "telemetry_tray_daily": telemetry}


def _stacked(i: Inputs, out: str, keys: tuple[str, ...] = ()):
    """The four weekly tables in one shape."""
    none = {"crop": F.lit(None).cast("string"), "week_id": F.lit(None).cast("int")}

    def rows(name: str, value: str):
        df = tables.read_table(i.spark, out, name)
        keyed = [F.col(k) if k in df.columns else F.lit(None).alias(k) for k in keys]
        cells = [F.col(c) if c in df.columns else none[c].alias(c) for c in ("crop", "week_id")]
        return df.select(*keyed, F.lit(name).alias("table_name"), *cells,
                         F.col(value).alias("value"))

    return (
        rows("demand_weekly", "demand_lbs")
        .unionByName(rows("energy_price_weekly", "price_per_kwh"))
        .unionByName(rows("telemetry_weekly", "kwh_used"))
        .unionByName(rows("crop_params", "yield_lbs_per_tray"))
    )


@query(
    "run_generate_aggregate",
    f"""SELECT 'demand_weekly' AS table_name, crop, week_id, {rnd('demand_lbs', 'value')}
        FROM demand_weekly
        UNION ALL SELECT 'energy_price_weekly', NULL, week_id, {rnd('price_per_kwh', 'value')}
        FROM price_weekly
        UNION ALL SELECT 'telemetry_weekly', crop, week_id, {rnd('sum(kwh_used)', 'value')}
        FROM tele_counts GROUP BY ALL
        UNION ALL SELECT 'crop_params', crop, NULL, {rnd('yield_lbs_per_tray', 'value')} FROM used_params""",
)
def _(i: Inputs):
    """Daily batch counts made from the events, then the weekly tables, in one session."""
    out = f"{scratch_dir(i.spark)}/weekly"
    jobs.aggregate_frames(i.spark, _daily(i, i.telemetry_counts()), out)
    return _stacked(i, out)


@query("run_all", SUMMARY_SQL)
def _(i: Inputs):
    """Aggregate, plan and report over the given tables, each stage written and read."""
    paths = jobs.run_given(
        i.spark, _daily(i, i.telemetry_rows()), scratch_dir(i.spark), i.params, i.scenario(), WEEKS
    )
    return tables.read_json(i.spark, paths["report_summary"], schemas.REPORT_SUMMARY)
