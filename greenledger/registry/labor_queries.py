"""Plans and proofs when labor is short."""

from __future__ import annotations

from greenledger.plans import labor
from greenledger.registry.base import query
from greenledger.registry.inputs import FACILITY, LOOSE, WEEKS, Inputs
from greenledger.registry.sql import (
    CTES, add_evaluation, certificate_sql, plan_sql, rnd, scenario_sql,
)

D = "::DOUBLE"
#: Labor that some weeks lack in the back-scheduled plan and earlier plantings find.
SHORT = {**LOOSE, "labor": 570.0, "block": 35.0}
#: Labor that no plan fits.
SCARCE = {**LOOSE, "labor": 500.0, "block": 35.0}
CTES["scen_short"] = scenario_sql(SHORT)
CTES["scen_scarce"] = scenario_sql(SCARCE)
CTES["nat_short"] = scenario_sql(SHORT, 0.045)


def _job_ctes(p: str, plan: str, scen: str, k: str = "") -> None:
    """CTEs {p}_jobs, {p}_room (planting hours a week offers), {p}_moved (the plan)."""
    names = [c.strip() for c in k.split(",") if c.strip()]
    on = "".join(f" AND r.{c} = x.{c}" for c in names)
    CTES[f"{p}_jobs"] = f"""
    SELECT {k}crop, harvest_week, greatest(harvest_week - g_max_weeks, 1)::INTEGER AS earliest,
           plant_week AS latest, plant_hours_per_tray AS hours, harvest_hours_per_tray AS hh, trays
    FROM {plan} JOIN params USING (crop)"""
    every = f"(SELECT DISTINCT {k}0 AS z FROM {p}_jobs)" if names else "(SELECT 0 AS z)"
    CTES[f"{p}_room"] = f"""
    SELECT {''.join(f'e.{c}, ' for c in names)}w.week_id AS week,
           labor + list_sum(blocks) - coalesce((SELECT sum(trays * hh) FROM {p}_jobs x
             WHERE x.harvest_week = w.week_id{''.join(f' AND x.{c} = e.{c}' for c in names)}), 0.0{D})
             * (1.0{D} - red) AS room
    FROM weeks w CROSS JOIN {every} e CROSS JOIN {scen}"""
    job = "STRUCT(earliest INTEGER, harvest_week INTEGER, crop VARCHAR, hours DOUBLE, trays BIGINT)"
    done = "STRUCT(crop VARCHAR, plant_week INTEGER, harvest_week INTEGER, trays BIGINT)"
    takes = (f"CASE WHEN j.earliest >= acc.week OR j.hours <= 0 THEN j.trays ELSE "
             f"least(j.trays, greatest(floor((acc.room + 1e-6{D}) / j.hours)::BIGINT, 0)) END")
    CTES[f"{p}_pools"] = f"""
    SELECT {''.join(f'r.{c}, ' for c in names)}week, room, coalesce(list({{'earliest': x.earliest,
             'harvest_week': x.harvest_week, 'crop': x.crop, 'hours': x.hours, 'trays': x.trays}}::{job})
             FILTER (x.crop IS NOT NULL), []::{job}[]) AS jobs
    FROM {p}_room r LEFT JOIN {p}_jobs x ON x.latest = r.week{on} GROUP BY ALL"""
    CTES[f"{p}_run"] = f"""
    SELECT DISTINCT {k}{WEEKS + 1} AS week, {{'week': {WEEKS + 1}, 'room': 0.0{D}, 'planted': []::{done}[],
           'waiting': []::{job}[]}} AS state FROM {p}_pools
    UNION ALL
    SELECT {''.join(f'r.{c}, ' for c in names)}r.week, list_reduce(
        list_reverse_sort(x.state.waiting || r.jobs),
        lambda acc, j: {{'week': acc.week, 'room': acc.room - ({takes}) * j.hours,
          'planted': acc.planted || CASE WHEN ({takes}) > 0 THEN [{{'crop': j.crop, 'plant_week': acc.week,
             'harvest_week': j.harvest_week, 'trays': ({takes})}}::{done}] ELSE []::{done}[] END,
          'waiting': acc.waiting || CASE WHEN ({takes}) < j.trays THEN [{{'earliest': j.earliest,
             'harvest_week': j.harvest_week, 'crop': j.crop, 'hours': j.hours,
             'trays': j.trays - ({takes})}}::{job}] ELSE []::{job}[] END}},
        {{'week': r.week, 'room': r.room, 'planted': []::{done}[], 'waiting': []::{job}[]}})
    FROM {p}_run x JOIN {p}_pools r ON r.week = x.week - 1{on}"""
    CTES[f"{p}_moved"] = f"""
    SELECT {k}d.crop, d.plant_week, d.harvest_week, d.trays
    FROM (SELECT {k}unnest(state.planted) AS d FROM {p}_run)"""


CTES["nat_reach"] = f"""
    SELECT facility, crop, week_id, CASE WHEN week_id > g_min_weeks THEN demand_lbs ELSE 0.0{D} END AS demand_lbs
    FROM nat_dense JOIN params USING (crop)"""
CTES["nat_reach_plan"] = plan_sql("nat_reach", "facility, ")

_job_ctes("ls", "reach_plan", "scen_short")
_job_ctes("lx", "reach_plan", "scen_scarce")
_job_ctes("ln", "nat_reach_plan", "nat_short", "facility, ")


def _intervals_sql(p: str, k: str = "") -> str:
    """Every run of weeks, its need and its hours; per last week the one most short."""
    names = [c.strip() for c in k.split(",") if c.strip()]
    on = "".join(f" AND r.{c} = j.{c}" for c in names)
    same = "".join(f" AND a.{c} = b.{c}" for c in names)
    ka = "".join(f"a.{c}, " for c in names)
    kr = "".join(f"r.{c}, " for c in names)
    return f"""
    SELECT {k}arg_max(first_week, (round(need - offer, 6), first_week))::INTEGER AS first_week,
           last_week::INTEGER AS last_week, arg_max(need, (round(need - offer, 6), first_week)) AS needed_hours,
           arg_max(offer, (round(need - offer, 6), first_week)) AS available_hours
    FROM (SELECT {kr}r.first_week, r.last_week, r.offer, coalesce(sum(j.trays * j.hours), 0.0{D}) AS need
          FROM (SELECT {ka}a.week AS first_week, b.week AS last_week, b.total - a.total + a.room AS offer
                FROM {p}_sums a JOIN {p}_sums b ON a.week <= b.week{same}) r
          LEFT JOIN {p}_jobs j ON j.earliest >= r.first_week AND j.latest <= r.last_week{on}
          GROUP BY ALL)
    GROUP BY ALL"""


def _interval_ctes(p: str, k: str = "") -> None:
    by = f"PARTITION BY {k.rstrip(', ')} " if k else ""
    last = f"(SELECT max(harvest_week) FROM {p}_jobs)" if not k else (
        f"(SELECT max(harvest_week) FROM {p}_jobs j WHERE j.facility = r.facility)")
    CTES[f"{p}_sums"] = f"""
    SELECT *, sum(room) OVER ({by}ORDER BY week) AS total FROM {p}_room r WHERE week <= {last}"""
    CTES[f"{p}_runs"] = _intervals_sql(p, k)


for _p, _k in (("ls", ""), ("lx", ""), ("ln", "facility, ")):
    _interval_ctes(_p, _k)


@query("labor_schedule", "SELECT * FROM ls_moved")
def _(i: Inputs):
    return labor.labor_schedule(i.late_demand, i.params, i.scenario(SHORT))


@query(
    "labor_intervals",
    f"""SELECT first_week, last_week, {rnd('needed_hours', 'needed_hours')},
               {rnd('available_hours', 'available_hours')},
               {rnd('needed_hours - available_hours', 'excess_hours')} FROM lx_runs""",
)
def _(i: Inputs):
    return labor.labor_intervals(i.late_demand, i.params, i.scenario(SCARCE))


add_evaluation("lb", "reach_plan", "reach", "dense_price", "scen_short", "weeks")
add_evaluation("lm", "ls_moved", "reach", "dense_price", "scen_short", "weeks")
add_evaluation("mb", "reach_plan", "reach", "dense_price", "scen_scarce", "weeks")
add_evaluation("mm", "lx_moved", "reach", "dense_price", "scen_scarce", "weeks")
add_evaluation("nb", "nat_reach_plan", "nat_reach", "dense_price", "nat_short", "weeks", ("facility",))
add_evaluation("nm", "ln_moved", "nat_reach", "dense_price", "nat_short", "weeks", ("facility",))
for _p, _k in (("lb", ""), ("lm", ""), ("mb", ""), ("mm", ""), ("nb", "facility, "), ("nm", "facility, ")):
    CTES[f"{_p}_rated"] = certificate_sql(f"{_p}_ev", _k)


def _certificate_sql(first: str, moved: str, runs: str, k: str = "") -> str:
    using = f"USING ({k.rstrip(', ')})" if k else "ON true"
    excess = f"(SELECT {k}count(*) AS short_runs FROM {runs} WHERE needed_hours - available_hours > 1e-6{D}"
    excess += f" GROUP BY {k.rstrip(', ')})" if k else ")"
    return f"""
    SELECT {k}status, plan, {rnd('cost', 'total_cost')}, {rnd('bound', 'lower_bound')},
           {rnd('cost - bound', 'gap')}, short_runs
    FROM (SELECT *, CASE plan WHEN 'labor_schedule' THEN moved_cost WHEN 'back_schedule' THEN first_cost END AS cost
          FROM (SELECT *, CASE WHEN status IN ('optimal', 'feasible_gap') THEN
                  CASE WHEN first_status = 'undecided' THEN 'labor_schedule' ELSE 'back_schedule' END END AS plan
                FROM (SELECT *, CASE WHEN first_status <> 'undecided' THEN first_status
                        WHEN short_runs > 0 THEN 'infeasible_proven'
                        WHEN fits AND moved_cost - bound <= 1e-6{D} THEN 'optimal'
                        WHEN fits THEN 'feasible_gap' ELSE 'undecided' END AS status
                      FROM (SELECT {'a.' + k if k else ''}a.status AS first_status, a.total_cost AS first_cost,
                                   a.total_cost - a.gap AS bound, b.total_cost AS moved_cost,
                                   b.status IN ('optimal', 'feasible_gap') AS fits,
                                   coalesce(e.short_runs, 0)::BIGINT AS short_runs
                            FROM {first} a LEFT JOIN {moved} b {using} LEFT JOIN {excess} e {using}))))"""


@query("labor_certificate", _certificate_sql("lb_rated", "lm_rated", "ls_runs"))
def _(i: Inputs):
    return labor.labor_certificate(i.late_demand, i.params, i.price, i.scenario(SHORT), WEEKS)


@query("labor_certificate_scarce", _certificate_sql("mb_rated", "mm_rated", "lx_runs"))
def _(i: Inputs):
    return labor.labor_certificate(i.late_demand, i.params, i.price, i.scenario(SCARCE), WEEKS)


@query("labor_certificate_by_facility", _certificate_sql("nb_rated", "nm_rated", "ln_runs", "facility, "))
def _(i: Inputs):
    reachable = i.reachable(i.nation_demand)
    return labor.labor_certificate(
        reachable, i.params, i.price, i.scenario(SHORT, 0.045), WEEKS, FACILITY)
