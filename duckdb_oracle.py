"""DuckDB SQL for every registered query of the marts (the correctness oracle).

Written from the meaning of each mart, in a shape of its own: no calendar join
(a pick's calendar day and labels are computed from its date and the calendar's
bounds), scalar subqueries, conditional aggregates, window statistics and list
aggregates where the Spark jobs aggregate, join and window differently.

Conventions so both engines agree bit for bit:
* sums are cast to BIGINT (DuckDB widens them to HUGEINT);
* means are a DOUBLE sum over a count;
* rounding is ``floor(x * 10^d + 0.5) / 10^d``;
* a division by zero is NULL;
* variances come from exact whole sums: (n * sum(x^2) - sum(x)^2) / (n * (n - 1)).
"""

from __future__ import annotations

# Fixed values shared with the Spark side (see pickmarts.sources.tpch_adapter,
# pickmarts.functions.bins, pickmarts.operators.common).
CALENDAR_START = "1995-07-01"
CALENDAR_END = "2001-06-30"
BIN_EDGES = (0, 50, 150, 350, 600, 900, 200000)
BIN_LABELS = ("mini", "small", "medium", "large", "extra_large", "extreme")
DRILL_DOWNS = ("product_group", "origin", "warehouse_section")
STAGED = (
    "product_id warehouse_section origin order_number position_in_order pick_volume quantity_unit "
    "pick_timestamp pick_date"
).split()

# Calendar labels of a day column.
LABELS = {
    "date": "{d}",
    "year": "CAST(year({d}) AS INTEGER)",
    "week": "strftime({d}, '%Y_%W')",
    "month": "strftime({d}, '%Y_%m')",
    "quarter": "year({d}) || '_Q' || quarter({d})",
    "year_half": "year({d}) || '_H' || CASE WHEN month({d}) > 6 THEN 2 ELSE 1 END",
}


def _padded(expr: str, width: int) -> str:
    return f"lpad({expr}::VARCHAR, greatest({width}, length({expr}::VARCHAR))::INTEGER, '0')"


def _half_up(expr: str, digits: int) -> str:
    return f"(floor(({expr}) * {10**digits}.0 + 0.5) / {10**digits}.0)"


def _percent(part: str, whole: str) -> str:
    return f"({_half_up(f'({part})::DOUBLE / nullif(({whole})::DOUBLE, 0)', 4)} * 100.0)"


def _labels(day: str, *names: str) -> str:
    return ", ".join(f"{LABELS[n].format(d=day)} AS {n}" for n in names)


# day: the pick date where the calendar holds it, else NULL.
PICKS = f"""
WITH picks AS (
  SELECT {_padded('l_partkey', 8)} AS product_id,
    CASE l_returnflag WHEN 'A' THEN 'AKL' WHEN 'N' THEN 'HRL' ELSE 'Manuell' END AS warehouse_section,
    (CASE l_orderkey % 3 WHEN 0 THEN 46 ELSE 48 END)::INTEGER AS origin,
    {_padded('(l_orderkey // 8)', 8)} AS order_number,
    {_padded('l_linenumber', 4)} AS position_in_order,
    (CASE WHEN l_tax = 0 THEN 0 WHEN l_tax > 0.075 AND l_discount > 0.095 THEN -1 ELSE 1 END
      * trunc(l_quantity)::BIGINT * (l_partkey % 12 + 1))::BIGINT AS pick_volume,
    'St' AS quantity_unit,
    l_shipdate::TIMESTAMP + to_seconds((l_orderkey * 7919 + l_partkey * 3571 + l_linenumber * 613) % 86400) AS pick_timestamp,
    l_shipdate::DATE AS pick_date,
    order_number || '_' || year(pick_timestamp) AS sk_order_id,
    CASE WHEN pick_date BETWEEN DATE '{CALENDAR_START}' AND DATE '{CALENDAR_END}' THEN pick_date END AS day,
    (SELECT CASE WHEN p_partkey % 50 != 7 THEN p_type END FROM part WHERE p_partkey = l_partkey) AS product_group,
    (SELECT p_name FROM part WHERE p_partkey = l_partkey) AS description
  FROM lineitem
),
f AS (SELECT * FROM picks WHERE pick_volume > 0),
days AS (SELECT unnest(generate_series(DATE '{CALENDAR_START}', DATE '{CALENDAR_END}', INTERVAL 1 DAY))::DATE AS day)
"""

POSITION = """count(*) OVER (PARTITION BY sk_order_id, origin
  ORDER BY pick_timestamp, position_in_order, product_id, warehouse_section, pick_volume
  ROWS UNBOUNDED PRECEDING)::INTEGER AS sk_position_in_order"""


def _by(g: str | None, prefix: str = "") -> str:
    return f", {prefix}{g}" if g else ""


def total_pick_volume(g: str | None) -> str:
    return PICKS + f"""
SELECT {_labels('any_value(day)', 'date', 'week', 'month', 'quarter', 'year_half', 'year')}{_by(g)},
  sum(pick_volume)::BIGINT AS pick_volume
FROM f GROUP BY pick_date{_by(g)}"""


def total_orders_processed(g: str | None) -> str:
    empty = f", NULL AS {g}" if g else ""
    return PICKS + f"""
, counted AS (
  SELECT day{_by(g)}, count(sk_order_id) AS n FROM (SELECT DISTINCT day{_by(g)}, sk_order_id FROM f) WHERE day IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT day{empty}, 0 FROM (FROM days EXCEPT SELECT day FROM f)
)
SELECT {_labels('day', 'date', 'week', 'month', 'quarter', 'year_half', 'year')}{_by(g)}, n::BIGINT AS order_volume FROM counted"""


def pick_errors(g: str | None) -> str:
    same = f" AND f.{g} = e.{g}" if g else ""
    return PICKS + f"""
, e AS (SELECT day{_by(g)}, count(*) AS n FROM picks WHERE pick_volume = 0 GROUP BY ALL)
SELECT {_labels('e.day', 'date', 'week', 'month')}{_by(g, 'e.')}, n::BIGINT AS total_errors,
  nullif((SELECT count(*) FROM f WHERE f.day = e.day{same}), 0)::BIGINT AS total_picks
FROM e"""


def top_n_products_weekly(g: str | None, n: int = 10) -> str:
    return PICKS + f"""
, counts AS (SELECT {_labels('day', 'week')}{_by(g)}, product_id, count(*) AS c FROM f GROUP BY ALL),
best AS (
  SELECT week{_by(g)}, list({{'product_id': product_id, 'total_picks': c::BIGINT}} ORDER BY c DESC, product_id)[1:{n}] AS l
  FROM counts GROUP BY ALL
)
SELECT week{_by(g)}, unnest(l, recursive := true) FROM best"""


def pick_throughput_hourly() -> str:
    return PICKS + """
, hours AS (SELECT date_trunc('hour', pick_timestamp) AS h, sum(pick_volume) AS v FROM f GROUP BY h)
SELECT h::DATE AS pick_date, date_part('hour', h)::INTEGER AS pick_hour, v::BIGINT AS pick_volume FROM hours"""


def pick_throughput_weekly(g: str | None) -> str:
    # the mean of hourly sums is the whole volume over the number of hours with picks
    mean = "sum(pick_volume)::DOUBLE / count(DISTINCT date_trunc('hour', pick_timestamp))"
    return PICKS + f"""
SELECT {_labels('day', 'week')}{_by(g)}, {_half_up(mean, 2)} AS weekly_pick_throughput_avg FROM f GROUP BY 1{_by(g)}"""


def order_mix() -> str:
    return PICKS + f"""
, cells AS (SELECT DISTINCT sk_order_id, warehouse_section FROM f)
SELECT sk_order_id, warehouse_section,
  (SELECT min(pick_date) FROM f WHERE f.sk_order_id = cells.sk_order_id) AS order_date,
  {_percent(
      "SELECT sum(pick_volume) FROM f WHERE f.sk_order_id = cells.sk_order_id AND f.warehouse_section IS NOT DISTINCT FROM cells.warehouse_section",
      "SELECT sum(pick_volume) FROM f WHERE f.sk_order_id = cells.sk_order_id",
  )} AS section_pick_percentage
FROM cells"""


def avg_products_picked_per_order() -> str:
    return PICKS + f"""
, firsts AS (SELECT sk_order_id, min(pick_date) AS low FROM f GROUP BY 1),
placed AS (
  SELECT DISTINCT sk_order_id, product_id,
    (SELECT CASE WHEN low BETWEEN DATE '{CALENDAR_START}' AND DATE '{CALENDAR_END}' THEN low END
     FROM firsts WHERE firsts.sk_order_id IS NOT DISTINCT FROM f.sk_order_id) AS first_day
  FROM f
)
SELECT {_labels('first_day', 'week')}, count(*)::DOUBLE / count(DISTINCT coalesce(sk_order_id, '')) AS avg_products_picked_per_order
FROM placed GROUP BY 1"""


def order_count_by_type() -> str:
    a, b = "coalesce(v48, 0)", "coalesce(v46, 0)"
    ratio = "CASE WHEN {1} > 0 THEN {2} ELSE 0.0 END"
    return PICKS + f"""
, weeks AS (
  SELECT {_labels('day', 'week')},
    CASE WHEN bool_or(origin = 48) THEN count(DISTINCT sk_order_id) FILTER (origin = 48) END AS v48,
    CASE WHEN bool_or(origin = 46) THEN count(DISTINCT sk_order_id) FILTER (origin = 46) END AS v46
  FROM f GROUP BY 1
),
-- days outside the calendar have no week in common: one row for each origin
rows_ AS (
  SELECT week, v48, v46 FROM weeks WHERE week IS NOT NULL AND coalesce(v48, v46) IS NOT NULL
  UNION ALL SELECT NULL, v48, NULL FROM weeks WHERE week IS NULL AND v48 IS NOT NULL
  UNION ALL SELECT NULL, NULL, v46 FROM weeks WHERE week IS NULL AND v46 IS NOT NULL
)
SELECT week, {a}::BIGINT AS order_volume_48, {b}::BIGINT AS order_volume_46, (v48 + v46)::BIGINT AS total_order_volume,
  {_percent('v48', 'v48 + v46')} AS order_percentage_48, {_percent('v46', 'v48 + v46')} AS order_percentage_46,
  {ratio.format(b, a, _half_up(f'{b}::DOUBLE / {a}', 2))} AS ratio_46_48,
  {ratio.format(a, b, _half_up(f'{a}::DOUBLE / {b}', 2))} AS ratio_48_46
FROM rows_"""


def warehouse_utilization_per_section() -> str:
    return PICKS + f"""
, volumes AS (SELECT {_labels('day', 'week')}, warehouse_section, sum(pick_volume) AS v FROM f WHERE day IS NOT NULL GROUP BY ALL)
SELECT week, warehouse_section,
  {_percent('v', 'SELECT sum(o.v) FROM volumes o WHERE o.week = volumes.week')} AS section_utilization FROM volumes
UNION ALL
SELECT DISTINCT NULL, NULL, 0.0::DOUBLE FROM f WHERE day IS NULL"""


def binned_order_volume() -> str:
    bins = ", ".join(
        f"{{'lo': {lo}, 'hi': {hi}, 'bins': '{name}'}}" for lo, hi, name in zip(BIN_EDGES, BIN_EDGES[1:], BIN_LABELS)
    )
    return PICKS + f"""
, orders AS (SELECT day, sum(pick_volume) AS v FROM f GROUP BY day, pick_date, sk_order_id),
grid AS (SELECT day, unnest([{bins}], recursive := true) FROM days)
SELECT {_labels('grid.day', 'date', 'week', 'month', 'quarter', 'year_half')}, bins,
  (SELECT count(*) FROM orders WHERE orders.day = grid.day AND v > lo AND v <= hi)::BIGINT AS order_volume
FROM grid"""


def zscores(period: str = "week", outliers: bool = False) -> str:
    n, x, xx = "count(*) OVER p", "sum(v) OVER p", "sum(v::HUGEINT * v) OVER p"
    mean = f"({x})::DOUBLE / ({n})::DOUBLE"
    spread = f"(({n})::HUGEINT * ({xx}) - ({x})::HUGEINT * ({x}))::DOUBLE"
    std = f"CASE WHEN {n} > 1 THEN sqrt({spread} / (({n})::DOUBLE * ({n} - 1)::DOUBLE)) ELSE 1.0 END"
    z = f"(v::DOUBLE - {mean}) / nullif({std}, 0)"
    return PICKS + f"""
, orders AS (SELECT sk_order_id, {_labels('day', period)}, sum(pick_volume)::BIGINT AS v FROM f GROUP BY ALL),
scored AS (SELECT sk_order_id, {period}, v, CASE WHEN {period} IS NOT NULL THEN {z} END AS z FROM orders WINDOW p AS (PARTITION BY {period}))
SELECT sk_order_id, {period}, v AS pick_volume, z AS zscore
FROM scored {'WHERE abs(z) > 3' if outliers else ''}"""


MEMBERS = (None, *DRILL_DOWNS)


def family(mart) -> str:
    """A mart and its drill-downs one under the other; ``mart`` gives each member's SQL."""
    parts = [
        f"SELECT '{g or 'none'}' AS drill_down, * FROM ({mart(g)}\n)" for g in MEMBERS
    ]
    return "\nUNION ALL BY NAME\n".join(parts)


def shared_inputs() -> dict[str, str]:
    groups = ", ".join(f"any_value(g{i}) AS {g}" for i, g in enumerate(DRILL_DOWNS))
    keyed = ", ".join(f"{g} AS g{i}" for i, g in enumerate(DRILL_DOWNS))

    def over(source: str, keys: str, cells: str, out: str) -> str:
        # equal cells meet through a hashed row of their values
        return PICKS + f"""
, rows_ AS (SELECT *, {keyed}, {keys} AS cell FROM {source})
SELECT {cells}, {groups}, {out} FROM rows_ GROUP BY cell, g0, g1, g2"""

    rows = "count(*)::BIGINT AS _rows"
    volume = "sum(pick_volume)::BIGINT AS pick_volume"
    hour = "date_trunc('hour', pick_timestamp)"
    return {
        "input_hourly_volume": over("f", hour, f"any_value(pick_date) AS pick_date, any_value({hour})::TIMESTAMP AS pick_timestamp", f"{volume}, {rows}"),
        "input_product_counts": over("f", "row(pick_date, product_id)", "any_value(pick_date) AS pick_date, any_value(product_id) AS product_id", rows),
        "input_error_counts": over("(FROM picks WHERE pick_volume = 0)", "pick_date", "any_value(pick_date) AS pick_date", rows),
        "input_order_days": over("f", "row(pick_date, sk_order_id)", "any_value(pick_date) AS pick_date, any_value(sk_order_id) AS sk_order_id", volume),
    }


SECTIONS = """SELECT s_name AS abbreviation, (SELECT n_name FROM nation WHERE n_nationkey = s_nationkey) AS description,
  (SELECT n_regionkey::VARCHAR FROM nation WHERE n_nationkey = s_nationkey) AS "group",
  CASE WHEN s_suppkey % 7 != 0 THEN CASE WHEN s_acctbal < 0 THEN 'C' WHEN s_acctbal < 5000 THEN 'B' ELSE 'A' END END AS pick_reference
FROM supplier"""


def _picks(where: str = "true", extra: str = "", **renamed: str) -> str:
    columns = ", ".join(renamed.get(c, c) for c in STAGED)
    return PICKS + f""", placed AS (SELECT *, {POSITION} FROM picks)
SELECT {columns}, sk_order_id, sk_position_in_order{extra} FROM placed WHERE {where}"""


def oracle_queries() -> dict[str, str]:
    attributes = ", description, product_group"
    q: dict[str, str] = {
        "staged_pick_data": PICKS + f"SELECT {', '.join(STAGED)} FROM picks",
        "csv_pick_data": PICKS + f"SELECT {', '.join(STAGED)} FROM picks",
        "csv_warehouse_sections": SECTIONS,
        "d_warehouse_section": SECTIONS,
        "d_product_details": f"""SELECT {_padded('p_partkey', 8)} AS product_id, p_name AS description,
          CASE WHEN p_partkey % 50 != 7 THEN p_type END AS product_group FROM part""",
        "sk_order_id": PICKS + f"SELECT {', '.join(STAGED)}, sk_order_id FROM picks",
        "sk_position_in_order": _picks(),
        "f_pick_errors": _picks("pick_volume = 0"),
        "f_returns": _picks(
            "pick_volume < 0",
            pick_volume="abs(pick_volume) AS return_volume",
            pick_timestamp="pick_timestamp AS return_timestamp",
            pick_date="pick_date AS return_date",
        ),
        "f_order_picks": _picks("pick_volume > 0"),
        "enrich_order_picks": _picks("pick_volume > 0", attributes),
        "enrich_pick_errors": _picks("pick_volume = 0", attributes),
        "pick_throughput_hourly": pick_throughput_hourly(),
        "order_mix": order_mix(),
        "avg_products_picked_per_order": avg_products_picked_per_order(),
        "order_count_by_type": order_count_by_type(),
        "warehouse_utilization_per_section": warehouse_utilization_per_section(),
        "binned_order_volume": binned_order_volume(),
        "weekly_zscore_distribution": zscores(),
        "zscore_outliers": zscores(outliers=True),
        "top_3_products_weekly": top_n_products_weekly(None, 3),
    }
    for g in (None, *DRILL_DOWNS):
        name = f"_{g}" if g else ""
        q[f"total_pick_volume{name}"] = total_pick_volume(g)
        q[f"total_orders_processed{name}"] = total_orders_processed(g)
        q[f"pick_errors{name}"] = pick_errors(g)
        q[f"top_n_products_weekly{name}"] = top_n_products_weekly(g)
        q[f"pick_throughput_weekly{name}"] = pick_throughput_weekly(g)
    families = {
        "total_pick_volume": total_pick_volume,
        "total_orders_processed": total_orders_processed,
        "pick_errors": pick_errors,
        "top_n_products_weekly": top_n_products_weekly,
        "pick_throughput_weekly": pick_throughput_weekly,
    }
    q.update({f"family_{name}": family(mart) for name, mart in families.items()})
    q.update(shared_inputs())
    for period in ("month", "year", "date", "quarter", "year_half"):
        q[f"zscore_distribution_{period}"] = zscores(period)
    return q
