"""The same results as SQL over the given tables, as composable CTEs.

The SQL is written from the definitions (range joins, recurrences spelled out as
enumerations), not from the DataFrame code, so agreement means something.
"""

from __future__ import annotations

import re
from dataclasses import fields

from greenledger.registry.inputs import (
    ANCHOR,
    EVENT_ANCHOR,
    LATE_ANCHOR,
    LATE_WEEKS,
    LINES_PER_UNIT,
    LOOSE,
    PARAMS,
    SEED,
    SYNTH_START,
    SYNTH_WEEKS,
    TIGHT,
    WEEKS,
)

CTES: dict[str, str] = {}
D = "::DOUBLE"


#: Ratios and prices, which are compared at nine places: at six, exact decimals such
#: as 0.9856875 would be ties that engines round apart.
FINE_COLUMNS = frozenset(
    ["price_per_kwh", "energy_price_per_kwh", "weight", "share_of_week"]
    + [f"{p}{kind}_utilization" for p in ("", "avg_") for kind in ("rack", "labor", "process")]
)


def places(expr: str, name: str) -> str:
    """Round as ``base.rounded`` does: six places, three for a million and more, since
    sums that large differ in the seventh place with the order of addition."""
    if name in FINE_COLUMNS:
        return f"round({expr}, 9) + 0.0::DOUBLE"
    return (f"(CASE WHEN abs({expr}) < 1e6::DOUBLE THEN round({expr}, 6) "
            f"ELSE round({expr}, 3) END) + 0.0::DOUBLE")


def rnd(expr: str, name: str) -> str:
    return f"{places(expr, name)} AS {name}"


def with_ctes(final: str) -> str:
    """Prefix a query with the CTEs it uses, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"[a-z_0-9]+", text)):
            if name in CTES and name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(final)
    if not needed:
        return final
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed)
    return f"WITH RECURSIVE {parts}\n{final}"


def _params_sql() -> str:
    names = [f.name for f in fields(PARAMS[0])]
    rows = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v)
                        for v in (getattr(p, n) for n in names)) + ")"
        for p in PARAMS
    )
    casts = ", ".join(
        n if n == "crop" else f"{n}::{'INTEGER' if n.startswith('g_m') else 'DOUBLE'} AS {n}"
        for n in names
    )
    return (f"SELECT *, yield_lbs_per_tray * (1.0::DOUBLE - shrink) AS eff FROM "
            f"(SELECT {casts} FROM (VALUES {rows}) t({', '.join(names)}))")


PARAM_NAMES = ", ".join(f.name for f in fields(PARAMS[0]))


def week_of(date: str, anchor: str) -> str:
    return f"(floor((CAST({date} AS DATE) - DATE '{anchor}') / 7.0) + 1)::INTEGER"


def iso(date: str) -> str:
    return f"strftime(CAST({date} AS DATE), '%Y-%m-%d')"


def weeks_sql(n: int) -> str:
    return f"SELECT range::INTEGER AS week_id FROM range(1, {n + 1})"


def scenario_sql(caps: dict[str, float], share: float = 1.0) -> str:
    k = f"(SELECT count(*)::DOUBLE / {LINES_PER_UNIT}::DOUBLE FROM lineitem)"

    def sized(name: str) -> str:
        return f"{caps[name] * share}::DOUBLE * {k}"

    return (
        f"SELECT {sized('rack')} AS rack, {sized('process')} AS process, {sized('labor')} AS labor, "
        f"[{sized('block')}, {sized('block')}] AS blocks, {sized('shift')} AS shift_cost, "
        f"24.0{D} AS wage, 12.0{D} AS premium, 0.15{D} AS red, 0.35{D} AS disposal"
    )


def plan_sql(demand: str, k: str = "") -> str:
    return f"""
    SELECT {k}crop, week_id - g_min_weeks AS plant_week, week_id AS harvest_week,
           ceil(demand_lbs / eff - 1e-9{D})::BIGINT AS trays
    FROM {demand} JOIN params USING (crop)
    WHERE week_id > g_min_weeks AND ceil(demand_lbs / eff - 1e-9{D}) > 0"""


def dense_sql(facts: str, grid: str, cells: str) -> str:
    on = " AND ".join(f"f.{c.strip()} = g.{c.strip()}" for c in cells.split(","))
    out = ", ".join(f"g.{c.strip()}" for c in cells.split(","))
    return f"""
    SELECT {out}, coalesce(sum(f.demand_lbs), 0.0){D} AS demand_lbs
    FROM {grid} g LEFT JOIN {facts} f ON {on} GROUP BY {out}"""


SHIFT_SQL = f"""
    SELECT *, plant_hours + harvest_hours AS h_off,
           plant_hours + harvest_hours * (1.0{D} - red) AS h_on,
           list_sum(blocks) AS ceiling FROM {{src}}"""

SHIFT_OUT = f"""
    SELECT *,
      CASE WHEN shift_on = 1 THEN h_on ELSE h_off END AS labor_used_hours,
      CASE WHEN shift_on = 1 THEN ot_on ELSE ot_off END AS overtime_hours,
      CASE WHEN shift_on = 1 THEN ot_on ELSE ot_off END <= ceiling + 1e-6{D} AS overtime_feasible,
      CASE WHEN shift_on = 1 THEN cost_on ELSE cost_off END AS labor_cost,
      least(wage * h_off, wage * h_on + shift_cost) AS labor_cost_floor
    FROM (
      SELECT *, CASE
        WHEN ot_off <= ceiling + 1e-6{D} AND ot_on <= ceiling + 1e-6{D}
          THEN (cost_on < cost_off)::INTEGER
        WHEN ot_off <= ceiling + 1e-6{D} THEN 0
        WHEN ot_on <= ceiling + 1e-6{D} THEN 1
        ELSE (h_on < h_off)::INTEGER END AS shift_on
      FROM (
        SELECT *, wage * h_off + premium * ot_off AS cost_off,
               wage * h_on + premium * ot_on + shift_cost AS cost_on
        FROM (SELECT *, greatest(h_off - labor, 0){D} AS ot_off,
                     greatest(h_on - labor, 0){D} AS ot_on FROM {{src}})))"""


def blocks_used(hours: str) -> str:
    """Fewest ordered blocks covering the hours, all of them when none does."""
    return f"""(CASE WHEN {hours} <= 1e-6{D} THEN 0 ELSE coalesce(
        (SELECT min(i) FROM range(1, len(blocks) + 1) r(i)
         WHERE list_sum(blocks[1:i]) + 1e-6{D} >= {hours}), len(blocks)) END)::INTEGER"""


def add_evaluation(
    p: str, plan: str, demand: str, price: str, scen: str, weeks: str,
    keys: tuple[str, ...] = (), scen_keys: tuple[str, ...] = (),
    price_keys: tuple[str, ...] = (),
) -> None:
    """CTEs {p}_occ, {p}_cw (crop weeks), {p}_wk, {p}_ev (evaluated weeks), {p}_cost."""
    k = "".join(f"{c}, " for c in keys)
    cells = f"{k}crop, week_id"
    CTES[f"{p}_occ"] = f"""
    SELECT {k}crop, w.week_id, sum(trays)::BIGINT AS stock
    FROM {plan} pl JOIN {weeks} w ON w.week_id >= plant_week AND w.week_id < harvest_week
    GROUP BY ALL"""
    CTES[f"{p}_cw"] = f"""
    SELECT {cells}, coalesce(planted, 0)::BIGINT AS planted,
           coalesce(harvested, 0)::BIGINT AS harvested, coalesce(stock, 0)::BIGINT AS stock,
           demand_lbs, coalesce(harvested, 0) * eff AS produced_lbs,
           greatest(coalesce(harvested, 0) * eff - demand_lbs, 0.0{D}) AS waste_lbs,
           greatest(demand_lbs - coalesce(harvested, 0) * eff, 0.0{D}) AS shortfall_lbs,
           coalesce(harvested, 0) * eff - demand_lbs < -1e-6{D} AS is_short,
           demand_lbs > 1e-6{D} AND week_id <= g_min_weeks AS is_early,
           coalesce(planted, 0) * plant_hours_per_tray AS plant_hours,
           coalesce(harvested, 0) * harvest_hours_per_tray AS harvest_hours,
           coalesce(planted, 0) * seed_cost_per_tray AS seed_cost,
           coalesce(stock, 0) * nutrient_cost_per_tray_week AS nutrient_cost,
           coalesce(stock, 0) * energy_kwh_per_tray_week AS energy_kwh
    FROM {demand} JOIN params USING (crop)
    LEFT JOIN (SELECT {k}crop, plant_week AS week_id, sum(trays) AS planted FROM {plan}
               WHERE plant_week >= 1 GROUP BY ALL) USING ({cells})
    LEFT JOIN (SELECT {k}crop, harvest_week AS week_id, sum(trays) AS harvested FROM {plan}
               GROUP BY ALL) USING ({cells})
    LEFT JOIN {p}_occ USING ({cells})"""
    CTES[f"{p}_wk"] = f"""
    SELECT {k}week_id, sum(planted)::BIGINT AS planted, sum(harvested)::BIGINT AS harvested,
           sum(stock)::BIGINT AS stock, sum(demand_lbs) AS demand_lbs,
           sum(produced_lbs) AS produced_lbs, sum(waste_lbs) AS waste_lbs,
           sum(plant_hours) AS plant_hours, sum(harvest_hours) AS harvest_hours,
           sum(seed_cost) AS seed_cost, sum(nutrient_cost) AS nutrient_cost,
           sum(energy_kwh) AS energy_kwh, count(*) FILTER (is_short) AS short_cells,
           count(*) FILTER (is_early) AS early_cells
    FROM {p}_cw GROUP BY ALL"""
    scen_join = f"JOIN {scen} USING ({', '.join(scen_keys)})" if scen_keys else f"CROSS JOIN {scen}"
    price_on = ", ".join((*price_keys, "week_id"))
    CTES[f"{p}_in"] = SHIFT_SQL.format(
        src=f"(SELECT * FROM {p}_wk {scen_join} JOIN {price} USING ({price_on}))"
    )
    CTES[f"{p}_sh"] = SHIFT_OUT.format(src=f"{p}_in")
    CTES[f"{p}_ev"] = f"""
    SELECT *, price_per_kwh * energy_kwh AS energy_cost, wage * labor_used_hours AS labor_base_cost,
           premium * overtime_hours AS overtime_premium_cost,
           shift_cost * shift_on AS shift_fixed_cost, disposal * waste_lbs AS disposal_cost,
           seed_cost + nutrient_cost + price_per_kwh * energy_kwh + wage * labor_used_hours
             + premium * overtime_hours + shift_cost * shift_on + disposal * waste_lbs AS total_cost
    FROM {p}_sh"""


COST_NAMES = (
    "seed_cost", "nutrient_cost", "energy_cost", "labor_base_cost", "overtime_premium_cost",
    "shift_fixed_cost", "disposal_cost",
)


def cost_sql(ev: str, k: str = "") -> str:
    parts = ", ".join(rnd(f"sum({c})", c) for c in (*COST_NAMES, "total_cost"))
    return f"SELECT {k}{parts} FROM {ev}" + (f" GROUP BY {k.rstrip(', ')}" if k else "")


def certificate_sql(ev: str, k: str = "") -> str:
    group = f" GROUP BY {k.rstrip(', ')}" if k else ""
    return f"""
    SELECT *, CASE
        WHEN greatest(early_cells, short_cells, rack_over_weeks, process_over_weeks) > 0
          THEN 'infeasible_proven'
        WHEN labor_over_weeks > 0 THEN 'undecided'
        WHEN gap <= 1e-6{D} THEN 'optimal' ELSE 'feasible_gap' END AS status
    FROM (SELECT {k}sum(total_cost) AS total_cost, sum(labor_cost - labor_cost_floor) AS gap,
                 sum(early_cells)::BIGINT AS early_cells, sum(short_cells)::BIGINT AS short_cells,
                 count(*) FILTER (stock > rack + 1e-6{D}) AS rack_over_weeks,
                 count(*) FILTER (harvested > process + 1e-6{D}) AS process_over_weeks,
                 count(*) FILTER (NOT overtime_feasible) AS labor_over_weeks
          FROM {ev}{group})"""


def certificate_out(source: str, k: str = "") -> str:
    return (f"SELECT {k}{rnd('total_cost', 'total_cost')}, "
            f"{rnd('total_cost - gap', 'lower_bound')}, {rnd('gap', 'gap')}, "
            f"early_cells, rack_over_weeks, process_over_weeks, labor_over_weeks, status "
            f"FROM ({source})")


UTIL_COLS = ", ".join([
    "week_id", rnd(f"stock{D}", "rack_used_trays"), rnd("rack", "rack_capacity_trays"),
    rnd("stock / greatest(rack, 1)", "rack_utilization"),
    rnd("labor_used_hours", "labor_used_hours"),
    rnd("labor + overtime_hours", "labor_capacity_hours"),
    rnd("labor_used_hours / greatest(labor + overtime_hours, 1e-6)", "labor_utilization"),
    rnd(f"harvested{D}", "process_used_trays"), rnd("process", "process_capacity_trays"),
    rnd("harvested / greatest(process, 1)", "process_utilization"),
    rnd("overtime_hours", "overtime_hours"),
    blocks_used("overtime_hours") + " AS overtime_blocks_enabled", "shift_on",
    rnd("energy_cost", "energy_cost"),
])

# Shared inputs ----------------------------------------------------------------

CTES["params"] = _params_sql()
CTES["weeks"] = weeks_sql(WEEKS)
CTES["part_crops"] = "SELECT DISTINCT p_type AS crop FROM part"
CTES["used_params"] = "SELECT * FROM params JOIN part_crops USING (crop)"
CTES["lines"] = f"""
    SELECT {iso('l_shipdate')} AS date, {week_of('l_shipdate', ANCHOR)} AS week_id,
           p_type AS crop, l_quantity AS demand_lbs, l_suppkey
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
CTES["prices"] = f"""
    SELECT {iso('o_orderdate')} AS date, {week_of('o_orderdate', ANCHOR)} AS week_id,
           o_totalprice / 1e6{D} AS energy_price_per_kwh FROM orders"""
CTES["tele_rows"] = f"""
    SELECT {iso('ts')} AS date, {week_of('ts', EVENT_ANCHOR)} AS week_id, event_type AS crop,
           user_id::VARCHAR AS tray_id,
           json_extract_string(props, '$.k')::INTEGER AS stage_age_days,
           value AS kwh_used, true AS is_active FROM events"""
CTES["tele_counts"] = """
    SELECT date, week_id, crop, crop || '_' || date AS batch_id, count(*) AS active_trays,
           max(stage_age_days) AS stage_age_days, sum(kwh_used) AS kwh_used,
           count(*) > 0 AS is_active
    FROM tele_rows GROUP BY date, week_id, crop"""
CTES["demand_weekly"] = "SELECT crop, week_id, sum(demand_lbs) AS demand_lbs FROM lines GROUP BY ALL"
CTES["price_weekly"] = (
    "SELECT week_id, avg(energy_price_per_kwh) AS price_per_kwh FROM prices GROUP BY ALL"
)
CTES["grid"] = "SELECT crop, week_id FROM params CROSS JOIN weeks"
CTES["dense"] = dense_sql("demand_weekly", "grid", "crop, week_id")
CTES["dense_price"] = f"""
    SELECT w.week_id, coalesce(p.price_per_kwh,
             (SELECT avg(price_per_kwh) FROM price_weekly WHERE week_id BETWEEN 1 AND {WEEKS}),
             0.13{D}) AS price_per_kwh
    FROM weeks w LEFT JOIN price_weekly p USING (week_id)"""
CTES["reach"] = f"""
    SELECT crop, week_id, CASE WHEN week_id > g_min_weeks THEN demand_lbs ELSE 0.0{D} END
           AS demand_lbs FROM dense JOIN params USING (crop)"""
CTES["scen"] = scenario_sql(TIGHT)
CTES["scen_loose"] = scenario_sql(LOOSE)

# Plans --------------------------------------------------------------------------

CTES["jit"] = plan_sql("dense")
CTES["reach_plan"] = plan_sql("reach")
CTES["late"] = """
    SELECT crop, plant_week - harvest_week % 3 AS plant_week, harvest_week, trays FROM jit
    WHERE plant_week - harvest_week % 3 >= 1"""
CTES["short_plan"] = """
    SELECT crop, plant_week, harvest_week,
           trays - (harvest_week % 10 = 0)::INTEGER AS trays FROM jit
    WHERE trays - (harvest_week % 10 = 0)::INTEGER > 0"""
CTES["over_h"] = """
    SELECT crop, plant_week, harvest_week, trays + 2 * (harvest_week % 11 = 0)::INTEGER AS trays
    FROM jit"""
CTES["left_h"] = """
    SELECT crop, plant_week, harvest_week, trays - (harvest_week % 13 = 0)::INTEGER AS trays
    FROM jit WHERE trays - (harvest_week % 13 = 0)::INTEGER > 0"""
CTES["jit_planted"] = "SELECT crop, plant_week, sum(trays)::BIGINT AS trays FROM jit GROUP BY ALL"

add_evaluation("jv", "jit", "dense", "dense_price", "scen", "weeks")
add_evaluation("rv", "reach_plan", "reach", "dense_price", "scen", "weeks")
add_evaluation("lv", "reach_plan", "reach", "dense_price", "scen_loose", "weeks")
add_evaluation("sv", "short_plan", "dense", "dense_price", "scen", "weeks")


def wip_sql(planted: str, harvested: str, weeks: int, init: str | None = None) -> str:
    """Stock per cohort and age by counting what was harvested up to each week."""
    lots = f"""UNION ALL SELECT crop, -age AS cohort, qty FROM {init} JOIN params USING (crop)
               WHERE age BETWEEN 0 AND g_max_weeks - 1""" if init else ""
    return f"""
    SELECT crop, (cohort + age)::INTEGER AS week_id, age::INTEGER AS age,
           (qty - coalesce((SELECT sum(h.trays) FROM {harvested} h
                            WHERE h.crop = c.crop AND h.plant_week = c.cohort
                              AND h.harvest_week <= c.cohort + a.age), 0))::BIGINT AS wip
    FROM (SELECT crop, cohort, sum(qty) AS qty FROM (
            SELECT crop, plant_week AS cohort, trays AS qty FROM {planted}
            UNION ALL SELECT DISTINCT crop, plant_week, 0 FROM {harvested} {lots}) GROUP BY ALL) c
    CROSS JOIN (SELECT range AS age FROM range(0, (SELECT max(g_max_weeks) FROM params) + 1)) a
    WHERE cohort + age BETWEEN 1 AND {weeks}"""


CTES["jit_wip"] = wip_sql("jit_planted", "jit", WEEKS)
CTES["over_wip"] = wip_sql("jit_planted", "over_h", WEEKS)
CTES["left_wip"] = wip_sql("jit_planted", "left_h", WEEKS)

# Initial stock -------------------------------------------------------------------

CTES["late_lines"] = f"""
    SELECT {week_of('l_shipdate', LATE_ANCHOR)} AS week_id, p_type AS crop,
           l_quantity AS demand_lbs, l_suppkey
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
CTES["late_weeks"] = weeks_sql(LATE_WEEKS)
CTES["late_grid"] = "SELECT crop, week_id FROM params CROSS JOIN late_weeks"
CTES["stock0"] = """
    SELECT crop, -week_id AS age, sum(demand_lbs)::BIGINT AS qty FROM late_lines
    WHERE week_id <= 0 GROUP BY ALL"""
CTES["late_dense"] = dense_sql("late_lines", "late_grid", "crop, week_id")
CTES["fifo_need"] = f"""
    SELECT * FROM (SELECT crop, week_id, g_min_weeks, g_max_weeks,
                          ceil(demand_lbs / eff - 1e-9{D})::BIGINT AS trays
                   FROM late_dense JOIN params USING (crop)) WHERE trays > 0"""
CTES["fifo_lots"] = """
    SELECT crop, age, qty FROM stock0 JOIN params USING (crop) WHERE qty > 0 AND age < g_max_weeks"""
CTES["fifo_pairs"] = """
    SELECT *, row_number() OVER (PARTITION BY crop ORDER BY week_id, age DESC) AS k
    FROM (SELECT l.crop, l.age, l.li, n.week_id, n.ni
          FROM (SELECT *, row_number() OVER (PARTITION BY crop ORDER BY age DESC) AS li FROM fifo_lots) l
          JOIN (SELECT *, row_number() OVER (PARTITION BY crop ORDER BY week_id) AS ni FROM fifo_need) n
          ON l.crop = n.crop AND l.age + n.week_id BETWEEN n.g_min_weeks AND n.g_max_weeks)"""
CTES["fifo_run"] = """
    SELECT crop, 0::BIGINT AS k, l.lots, n.needs, 0::BIGINT AS served
    FROM (SELECT crop, list(qty ORDER BY age DESC) AS lots FROM fifo_lots GROUP BY crop) l
    JOIN (SELECT crop, list(trays ORDER BY week_id) AS needs FROM fifo_need GROUP BY crop) n USING (crop)
    UNION ALL
    SELECT crop, k, lots[1:li-1] || [lots[li] - s] || lots[li+1:],
           needs[1:ni-1] || [needs[ni] - s] || needs[ni+1:], s
    FROM (SELECT p.*, r.lots, r.needs, least(r.lots[p.li], r.needs[p.ni])::BIGINT AS s
          FROM fifo_run r JOIN fifo_pairs p ON p.crop = r.crop AND p.k = r.k + 1)"""
CTES["fifo_served"] = """
    SELECT crop, age, week_id, served FROM fifo_run JOIN fifo_pairs USING (crop, k) WHERE served > 0"""
CTES["fifo_plan"] = """
    SELECT crop, plant_week::INTEGER AS plant_week, harvest_week::INTEGER AS harvest_week,
           sum(trays)::BIGINT AS trays
    FROM (
      SELECT crop, -age AS plant_week, week_id AS harvest_week, served AS trays FROM fifo_served
      UNION ALL
      SELECT l.crop, -l.age, g_max_weeks - l.age,
             qty - coalesce((SELECT sum(served) FROM fifo_served s
                             WHERE s.crop = l.crop AND s.age = l.age), 0)
      FROM fifo_lots l JOIN params USING (crop)
      UNION ALL
      SELECT n.crop, week_id - g_min_weeks, week_id,
             trays - coalesce((SELECT sum(served) FROM fifo_served s
                               WHERE s.crop = n.crop AND s.week_id = n.week_id), 0)
      FROM fifo_need n WHERE week_id > g_min_weeks)
    WHERE trays > 0 GROUP BY ALL"""
CTES["fifo_planted"] = """
    SELECT crop, plant_week, sum(trays)::BIGINT AS trays FROM fifo_plan WHERE plant_week >= 1
    GROUP BY ALL"""
CTES["fifo_wip"] = wip_sql("fifo_planted", "fifo_plan", LATE_WEEKS, "stock0")

# Policies: digit i of the policy code is the age offset of the i-th crop ------------

CTES["radix"] = """
    SELECT crop, g_max_weeks - g_min_weeks + 1 AS width,
           coalesce(product(g_max_weeks - g_min_weeks + 1) OVER (
             ORDER BY crop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1)::BIGINT AS stride,
           product(g_max_weeks - g_min_weeks + 1) OVER ()::BIGINT AS policies FROM params"""
CTES["policies"] = """
    SELECT policy, crop, (policy // stride) % width AS age_offset
    FROM (SELECT *, unnest(range(0, policies)) AS policy FROM radix)"""
CTES["pol_plan"] = f"""
    SELECT policy, d.crop, (week_id - least(g_min_weeks + age_offset, week_id - 1))::INTEGER
             AS plant_week, week_id AS harvest_week,
           ceil(demand_lbs / eff - 1e-9{D})::BIGINT AS trays
    FROM reach d JOIN params USING (crop) JOIN policies USING (crop)
    WHERE week_id > g_min_weeks AND ceil(demand_lbs / eff - 1e-9{D}) > 0"""
CTES["pol_demand"] = """
    SELECT policy, crop, week_id, demand_lbs FROM reach
    CROSS JOIN (SELECT DISTINCT policy FROM policies)"""
add_evaluation("pv", "pol_plan", "pol_demand", "dense_price", "scen_loose", "weeks", ("policy",))
CTES["pol_rated"] = certificate_sql("pv_ev", "policy, ")

# Facilities and synthetic tables ------------------------------------------------------

CTES["fac"] = f"""
    SELECT s_suppkey AS facility, 60 + floor(abs(s_acctbal) / 250){D} AS rack,
           15 + floor(abs(s_acctbal) / 1000){D} AS process,
           10 + floor(abs(s_acctbal) / 1000){D} AS labor,
           [4.0{D}, 1.0 + floor(abs(s_acctbal) / 2000){D}] AS blocks, 180.0{D} AS shift_cost,
           24.0{D} AS wage, 12.0{D} AS premium, 0.15{D} AS red, 0.35{D} AS disposal
    FROM supplier"""
CTES["synth_weeks"] = weeks_sql(SYNTH_WEEKS)
CTES["synth_days"] = f"""
    SELECT strftime(DATE '{SYNTH_START}' + i::INTEGER, '%Y-%m-%d') AS date,
           (i // 7 + 1)::INTEGER AS week_id, (i % 7)::INTEGER AS day FROM range(0, {7 * SYNTH_WEEKS}) r(i)"""


def _digest(tag: str, *keys: str) -> str:
    return f"md5(concat_ws('|', '{SEED}', '{tag}', {', '.join(f'{k}::VARCHAR' for k in keys)}))"


def _word(digest: str, start: int = 1) -> str:
    return f"('0x' || substr({digest}, {start}, 8))::BIGINT{D}"


def uniform(tag: str, *keys: str, low: float = 0.0, high: float = 1.0) -> str:
    return f"({low}{D} + {_word(_digest(tag, *keys))} / 4294967296{D} * {high - low}{D})"


def normal(tag: str, *keys: str, mean: float = 0.0, std: float = 1.0) -> str:
    d = _digest(tag, *keys)
    return (f"({mean}{D} + {std}{D} * sqrt(-2.0{D} * ln(({_word(d)} + 1) / 4294967296{D})) "
            f"* cos(2.0{D} * pi() * ({_word(d, 9)} / 4294967296{D})))")


def season(base: float, amplitude: float) -> str:
    return f"({base}{D} + {amplitude}{D} * sin(2.0{D} * pi() * week_id / {SYNTH_WEEKS}{D}))"


def apportion_sql(src: str, total: str, out: str) -> str:
    """Largest remainder within (facility, week_id)."""
    return f"""
    SELECT *, (whole + (row_number() OVER (PARTITION BY facility, week_id
                          ORDER BY part DESC, crop) <= {total} - sum(whole) OVER (
                          PARTITION BY facility, week_id))::INTEGER)::BIGINT AS {out}
    FROM (SELECT *, floor({total} * weight) AS whole,
                 round({total} * weight - floor({total} * weight), 9) AS part FROM {src})"""


def weights_sql(src: str, tag: str, low: float, high: float) -> str:
    return f"""
    SELECT * EXCLUDE (w), w / sum(w) OVER (PARTITION BY facility, week_id) AS weight
    FROM (SELECT *, {uniform(f'{tag}_base', 'facility', 'crop')}
                  * {uniform(f'{tag}_jitter', 'facility', 'crop', 'week_id', low=low, high=high)} AS w
          FROM {src})"""


CTES["limits"] = f"""
    SELECT *, greatest(8, round_even(tray_limit * 0.70{D}, 0)::BIGINT)::BIGINT AS target
    FROM (SELECT *, greatest(1.0{D}, least(rack / greatest(avg_grow, 1.0{D}), process,
                 (labor + list_sum(blocks)) / greatest(avg_hours, 1e-6{D}))) AS tray_limit
          FROM fac CROSS JOIN (
            SELECT avg((g_min_weeks + g_max_weeks) / 2.0{D}) AS avg_grow,
                   avg(plant_hours_per_tray + harvest_hours_per_tray) AS avg_hours FROM params))"""
CTES["week_totals"] = f"""
    SELECT facility, week_id, greatest(0.0{D}, least(
             round_even(target * {season(1.0, 0.12)} * greatest(0.55{D},
               1.0{D} + {normal('demand_noise', 'facility', 'week_id', std=0.08)}), 0),
             round_even(tray_limit * 0.92{D}, 0)))::BIGINT AS total_trays
    FROM limits CROSS JOIN synth_weeks"""
CTES["elig"] = """
    SELECT facility, week_id, total_trays, p.* FROM week_totals JOIN params p
    ON week_id > g_min_weeks"""
CTES["demand_weights"] = weights_sql("elig", "demand", 0.8, 1.2)
CTES["demand_split"] = apportion_sql("demand_weights", "total_trays", "trays")
CTES["synth_demand"] = f"""
    SELECT facility, crop, week_id, coalesce(s.trays * s.eff * 0.90{D}, 0.0{D}) AS demand_lbs,
           coalesce(s.trays, 0)::BIGINT AS demand_trays_est
    FROM (SELECT facility, crop, week_id FROM fac CROSS JOIN params CROSS JOIN synth_weeks)
    LEFT JOIN demand_split s USING (facility, crop, week_id)"""
CTES["synth_daily"] = f"""
    SELECT date, facility, week_id, crop,
           CASE WHEN demand_lbs > 0
                THEN demand_lbs * (draw / sum(draw) OVER (PARTITION BY facility, crop, week_id))
                ELSE 0.0{D} END AS demand_lbs
    FROM (SELECT d.date, facility, week_id, crop, demand_lbs,
                 -ln(({_word(_digest('day_share', 'facility', 'crop', 'week_id', 'd.day'))} + 1)
                     / 4294967297{D}) AS draw
          FROM synth_demand JOIN synth_days d USING (week_id))"""
CTES["synth_prices"] = f"""
    SELECT date, facility, week_id, greatest(0.02{D}, 0.13{D} * {season(1.0, 0.08)}
             * (1.0{D} + {normal('price_noise', 'facility', 'date', std=0.01)}))
             AS energy_price_per_kwh
    FROM fac CROSS JOIN synth_days"""
CTES["tele_total"] = f"""
    SELECT facility, week_id, crop, floor(greatest(40.0{D}, least(rack,
             round_even(rack * {season(0.55, 0.10)} * greatest(0.35{D},
               1.0{D} + {normal('telemetry_noise', 'facility', 'week_id', std=0.08)}), 0))))::BIGINT
             AS total_active
    FROM fac CROSS JOIN synth_weeks CROSS JOIN (SELECT crop FROM params)"""
CTES["tele_weights"] = weights_sql("tele_total", "telemetry", 0.85, 1.15)
CTES["tele_levels"] = apportion_sql("tele_weights", "total_active", "level")
CTES["synth_counts"] = f"""
    SELECT date, facility, week_id, crop, facility || '_' || crop || '_' || date AS batch_id,
           active_trays,
           (1 + floor({uniform('age', 'facility', 'crop', 'date')}
                      * (greatest(g_max_weeks * 7, 2) - 1)))::INTEGER AS stage_age_days,
           active_trays * (energy_kwh_per_tray_week / 7.0{D})
             * {uniform('kwh_jitter', 'facility', 'crop', 'date', low=0.9, high=1.1)} AS kwh_used,
           active_trays > 0 AS is_active
    FROM (SELECT d.date, facility, week_id, crop,
                 greatest(0, round_even(level * {uniform('day_jitter', 'facility', 'crop', 'd.date',
                                                          low=0.93, high=1.07)}, 0))::BIGINT AS active_trays
          FROM tele_levels JOIN synth_days d USING (week_id)) JOIN params USING (crop)"""
CTES["synth_rows"] = f"""
    SELECT date, facility, week_id, crop,
           facility || '_' || crop || '_' || replace(date, '-', '') || '_' || printf('%05d', tray)
             AS tray_id,
           (1 + floor({uniform('tray_age', 'facility', 'crop', 'date', 'tray')}
                      * (greatest(g_max_weeks * 7, 2) - 1)))::INTEGER AS stage_age_days,
           greatest(0.01{D}, (energy_kwh_per_tray_week / 7.0{D})
             * {normal('tray_kwh', 'facility', 'crop', 'date', 'tray', mean=1.0, std=0.12)})
             AS kwh_used,
           true AS is_active
    FROM (SELECT date, facility, week_id, crop, unnest(range(0, active_trays)) AS tray
          FROM synth_counts) JOIN params USING (crop)"""

CTES["fac_demand"] = "SELECT facility, crop, week_id, sum(demand_lbs) AS demand_lbs FROM synth_daily GROUP BY ALL"
CTES["fac_price"] = ("SELECT facility, week_id, avg(energy_price_per_kwh) AS price_per_kwh "
                     "FROM synth_prices GROUP BY ALL")
CTES["fac_plan"] = plan_sql("fac_demand", "facility, ")
add_evaluation("fv", "fac_plan", "fac_demand", "fac_price", "fac", "synth_weeks", ("facility",),
               ("facility",), ("facility",))

# Supplier nations as facilities --------------------------------------------------------

CTES["nat_facts"] = """
    SELECT s_nationkey AS facility, crop, week_id, demand_lbs
    FROM lines JOIN supplier ON l_suppkey = s_suppkey"""
CTES["nat_grid"] = "SELECT n_nationkey AS facility, crop, week_id FROM nation CROSS JOIN grid"
CTES["nat_dense"] = dense_sql("nat_facts", "nat_grid", "facility, crop, week_id")
CTES["nat_plan"] = plan_sql("nat_dense", "facility, ")
CTES["nat_scen"] = scenario_sql(TIGHT, 0.04)
add_evaluation("nv", "nat_plan", "nat_dense", "dense_price", "nat_scen", "weeks", ("facility",))

add_evaluation("xv", "late", "dense", "dense_price", "scen", "weeks")
add_evaluation("ov", "over_h", "dense", "dense_price", "scen", "weeks")
CTES["late_planted"] = "SELECT crop, plant_week, sum(trays)::BIGINT AS trays FROM late GROUP BY ALL"
CTES["late_wip"] = wip_sql("late_planted", "late", WEEKS)
