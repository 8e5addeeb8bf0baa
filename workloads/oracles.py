"""Equivalent SQL for DuckDB over the same tables.

Written from the definitions, not from the Spark plans: interval self-joins
instead of range frames, joins back instead of carried columns, counts instead
of `mode`.
"""

from __future__ import annotations

import csv
from importlib import resources

STATION = "'st' || (user_id % 3)"
PER_USER = "'u' || user_id"


def _bands() -> dict[str, list[dict[str, str]]]:
    """The breakpoint rows by pollutant."""
    text = (resources.files("vayumark") / "data" / "breakpoints.csv").read_text("utf-8")
    found: dict[str, list[dict[str, str]]] = {}
    for row in csv.DictReader(line for line in text.splitlines() if not line.startswith("#")):
        found.setdefault(row["pollutant"], []).append(row)
    return found


def _index_of(pollutant: str, value: str) -> str:
    """Index of a concentration as one scalar expression: its band's line, held at the top of the scale."""
    lines = [
        (r["conc_low"], f"round({r['index_low']} + (least({value}, {r['conc_high']}) - {r['conc_low']})"
         f" * ({r['index_high']} - {r['index_low']}) / ({r['conc_high']}::DOUBLE - {r['conc_low']}))")
        for r in _bands()[pollutant]
    ]
    steps = " ".join(f"WHEN {value} >= {low} THEN {line}" for low, line in reversed(lines))
    return f"CAST(CASE {steps} END AS INTEGER)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def readings(city: str = STATION) -> str:
    def mean(kind: str) -> str:
        return (
            f"floor(avg(CASE WHEN event_type = '{kind}' "
            "THEN CAST(round(value * 100) AS BIGINT) END) + 0.5) / 100"
        )

    return f"""readings AS (
    SELECT city_id, observed_at, CAST(observed_at AS DATE) AS observed_date,
           pm2_5, pm10, no2, so2, o3, o3 * 40 AS co, o3 * 40 / 1000.0 AS co_mg_m3, newest
    FROM (
        SELECT {city} AS city_id, date_trunc('hour', ts) AS observed_at,
               {mean('view')} AS pm2_5, {mean('click')} AS pm10, {mean('purchase')} AS no2,
               {mean('signup')} AS so2, {mean('error')} AS o3, max(ts) AS newest
        FROM events GROUP BY 1, 2
    )
)"""


MEANS = """means AS (
    SELECT city_id, observed_date, count(*) AS hours_reported,
           round(avg(pm2_5), 9) AS pm2_5_24h, count(pm2_5) AS pm2_5_hours,
           round(avg(pm10), 9) AS pm10_24h, count(pm10) AS pm10_hours,
           round(avg(no2), 9) AS no2_24h, count(no2) AS no2_hours,
           round(avg(so2), 9) AS so2_24h, count(so2) AS so2_hours
    FROM readings GROUP BY ALL
)"""

EIGHT_HOURS = """eight_hours AS (
    SELECT r.city_id, r.observed_date, r.observed_at,
           round(avg(earlier.o3), 9) AS o3_8h_avg, count(earlier.o3) AS o3_8h_hours,
           round(avg(earlier.co_mg_m3), 9) AS co_8h_avg, count(earlier.co_mg_m3) AS co_8h_hours
    FROM readings r JOIN readings earlier
      ON earlier.city_id = r.city_id
     AND r.observed_at - earlier.observed_at >= INTERVAL 0 HOUR
     AND r.observed_at - earlier.observed_at < INTERVAL 8 HOUR
    GROUP BY ALL
)"""

HIGHEST = """highest AS (
    SELECT city_id, observed_date,
           max(o3_8h_avg) FILTER (o3_8h_hours >= 6) AS o3_8h_max,
           max(co_8h_avg) FILTER (co_8h_hours >= 6) AS co_8h_max
    FROM eight_hours GROUP BY ALL
)"""

DAILY = """daily AS (
    SELECT * FROM means LEFT JOIN highest USING (city_id, observed_date)
)"""

MEASURED = """measured AS (
    SELECT city_id, observed_date, unnest([
        {'pollutant': 'pm2_5', 'value': pm2_5_24h, 'is_valid': pm2_5_hours >= 16},
        {'pollutant': 'pm10', 'value': pm10_24h, 'is_valid': pm10_hours >= 16},
        {'pollutant': 'no2', 'value': no2_24h, 'is_valid': no2_hours >= 16},
        {'pollutant': 'so2', 'value': so2_24h, 'is_valid': so2_hours >= 16},
        {'pollutant': 'o3', 'value': o3_8h_max, 'is_valid': o3_8h_max IS NOT NULL},
        {'pollutant': 'co', 'value': co_8h_max, 'is_valid': co_8h_max IS NOT NULL}
    ], recursive := true)
    FROM daily
)"""

# Fixed value: which pollutant is named if several are equally bad.
PRIORITY = ("pm2_5", "pm10", "no2", "o3", "so2", "co")


def _wide() -> str:
    usable = {p: (f"{p}_24h", f"{p}_hours >= 16") for p in ("pm2_5", "pm10", "no2", "so2")}
    usable |= {p: (f"{p}_8h_max", f"{p}_8h_max IS NOT NULL") for p in ("o3", "co")}
    columns = ",\n           ".join(
        f"CASE WHEN {ok} THEN {_index_of(p, value)} END AS {p}_sub_index" for p, (value, ok) in usable.items()
    )
    return f"""wide AS (
    SELECT city_id, observed_date,
           {columns}
    FROM daily
)"""


WIDE = _wide()
INDEXED = "indexed AS (" + " UNION ALL ".join(
    f"SELECT city_id, observed_date, '{p}' AS pollutant, {p}_sub_index AS sub_index FROM wide"
    f" WHERE {p}_sub_index IS NOT NULL"
    for p in PRIORITY
) + ")"

ROLLED = f"""rolled AS (
    SELECT *,
           list_filter([{", ".join(f"{{'p': '{p}', 'i': {p}_sub_index}}" for p in PRIORITY)}],
                       lambda x: x.i = max_sub_index)[1].p AS top_pollutant,
           CAST({" + ".join(f"({p}_sub_index IS NOT NULL)::INT" for p in PRIORITY)} AS BIGINT) AS pollutants_used,
           (coalesce(pm2_5_sub_index, pm10_sub_index) IS NOT NULL)::INT AS has_particulates
    FROM (SELECT *, greatest({", ".join(f"{p}_sub_index" for p in PRIORITY)}) AS max_sub_index FROM wide)
    WHERE max_sub_index IS NOT NULL
)"""


def category(aqi: str) -> str:
    limits = [(50, "Good"), (100, "Satisfactory"), (200, "Moderate"), (300, "Poor"), (400, "Very Poor")]
    steps = " ".join(f"WHEN {aqi} <= {top} THEN '{name}'" for top, name in limits)
    return f"CASE WHEN {aqi} IS NULL THEN NULL {steps} ELSE 'Severe' END"


def ordinal(column: str) -> str:
    names = "['Good', 'Satisfactory', 'Moderate', 'Poor', 'Very Poor', 'Severe']"
    return f"CAST(list_position({names}, {column}) - 1 AS INTEGER)"


def label(column: str) -> str:
    names = {"pm2_5": "PM2.5", "pm10": "PM10", "no2": "NO₂", "so2": "SO₂", "o3": "O₃", "co": "CO"}
    steps = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in names.items())
    return f"CASE {column} {steps} ELSE '–' END"


def shown(x: str, decimals: int = 1) -> str:
    return f"round({x}, {decimals})"


TREND = f"""
           aqi - lag(aqi) OVER series AS aqi_change_vs_prev_day,
           {shown('avg(aqi) OVER (series ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS aqi_7d_avg"""

FACT = f"""scored AS (
    SELECT city_id || '|' || observed_date AS daily_aqi_id, city_id, observed_date, hours_reported,
           coalesce(pollutants_used, 0) AS pollutants_used,
           coalesce(pollutants_used >= 3 AND has_particulates = 1, false) AS is_aqi_valid,
           CASE WHEN is_aqi_valid THEN max_sub_index END AS aqi,
           {category('(CASE WHEN is_aqi_valid THEN max_sub_index END)')} AS aqi_category,
           CASE WHEN is_aqi_valid THEN top_pollutant END AS dominant_pollutant,
           pm2_5_sub_index, pm10_sub_index, no2_sub_index, so2_sub_index, o3_sub_index, co_sub_index,
           {shown('pm2_5_24h')} AS pm2_5_24h_ug_m3,
           {shown('pm10_24h')} AS pm10_24h_ug_m3,
           {shown('no2_24h')} AS no2_24h_ug_m3,
           {shown('so2_24h')} AS so2_24h_ug_m3,
           {shown('o3_8h_max')} AS o3_8h_max_ug_m3,
           {shown('co_8h_max', 2)} AS co_8h_max_mg_m3
    FROM daily LEFT JOIN rolled USING (city_id, observed_date)
),
fact AS (
    SELECT *, {TREND}
    FROM scored WINDOW series AS (PARTITION BY city_id ORDER BY observed_date)
)"""

TO_DAILY = (MEANS, EIGHT_HOURS, HIGHEST, DAILY)
TO_FACT = (*TO_DAILY, WIDE, ROLLED, FACT)

CITIES = """cities AS (
    SELECT 'st' || n_nationkey AS city_id, n_name AS city_name, 'state ' || n_nationkey AS state,
           r_name AS region, CAST(n_nationkey AS DOUBLE) AS latitude,
           CAST(n_regionkey AS DOUBLE) AS longitude
    FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

SUMMARY = """valid AS (SELECT * FROM fact WHERE is_aqi_valid),
last_month AS (
    SELECT * FROM valid WHERE date_diff('day', observed_date, (SELECT max(observed_date) FROM valid)) < 30
),
newest AS (
    SELECT city_id, observed_date AS latest_date, aqi AS latest_aqi, aqi_category AS latest_category
    FROM valid v
    WHERE observed_date = (SELECT max(observed_date) FROM valid w WHERE w.city_id = v.city_id)
),
usual AS (
    SELECT city_id, arg_min(dominant_pollutant, place) AS usual_dominant_pollutant FROM (
        SELECT city_id, dominant_pollutant,
               row_number() OVER (PARTITION BY city_id ORDER BY count(*) DESC, dominant_pollutant) AS place
        FROM last_month GROUP BY city_id, dominant_pollutant
    ) GROUP BY city_id
),
stats AS (
    SELECT city_id, count(*) AS days_measured, CAST(round(avg(aqi)) AS INTEGER) AS avg_aqi_30d,
           max(aqi) AS worst_aqi_30d, min(aqi) AS best_aqi_30d,
           count(*) FILTER (aqi <= 100) AS good_or_satisfactory_days,
           count(*) FILTER (aqi > 200) AS poor_or_worse_days
    FROM last_month GROUP BY city_id
),
summary AS (
    SELECT city_id, city_name, state, region, latest_date, latest_aqi, latest_category,
           days_measured, avg_aqi_30d, worst_aqi_30d, best_aqi_30d,
           good_or_satisfactory_days, poor_or_worse_days, usual_dominant_pollutant,
           CAST(rank() OVER (ORDER BY avg_aqi_30d DESC NULLS LAST) AS INTEGER) AS pollution_rank_30d
    FROM cities LEFT JOIN newest USING (city_id) LEFT JOIN stats USING (city_id)
         LEFT JOIN usual USING (city_id)
)"""

RECENT = """recent AS (
    SELECT city_id, city_name, CAST(observed_date AS VARCHAR) AS d, aqi, aqi_category,
           dominant_pollutant, aqi_7d_avg
    FROM fact JOIN cities USING (city_id)
    WHERE date_diff('day', observed_date, (SELECT max(observed_date) FROM fact)) < 90
)"""

DOMINANT = """dominant AS (
    SELECT city_id, city_name, arg_max(dominant_pollutant, d) AS dominant_pollutant
    FROM recent WHERE aqi IS NOT NULL GROUP BY ALL
)"""

ORDER_SERIES = """order_series AS (
    SELECT o_orderpriority AS city_id, CAST(o_orderdate AS DATE) AS observed_date,
           CAST(floor(avg(CAST(round(o_totalprice * 100) AS BIGINT)) / 100000 + 0.5) AS INTEGER) AS aqi,
           count(*) AS orders
    FROM orders GROUP BY ALL
)"""

ORDER_CITIES = """order_cities AS (
    SELECT DISTINCT o_orderpriority AS city_id,
           substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) AS city_name
    FROM orders
)"""



def shifts(days: str, k: float = 1.0) -> str:
    """Level shifts from the definition: valid days by number, joined with the 14 before and the 14 from there on."""
    return f"""by_number AS (
    SELECT city_id, observed_date, aqi, row_number() OVER (PARTITION BY city_id ORDER BY observed_date) AS no
    FROM {days}
),
jumps AS (
    SELECT x.city_id, x.observed_date, x.no,
           avg(y.aqi) FILTER (y.no < x.no) AS level_before, avg(y.aqi) FILTER (y.no >= x.no) AS level_after,
           level_after - level_before AS jump,
           sqrt((var_samp(y.aqi) FILTER (y.no < x.no) + var_samp(y.aqi) FILTER (y.no >= x.no)) / 2) AS spread
    FROM by_number x JOIN by_number y ON y.city_id = x.city_id AND y.no - x.no BETWEEN -14 AND 13
    GROUP BY x.city_id, x.observed_date, x.no
    HAVING count(*) FILTER (y.no < x.no) >= 10 AND count(*) FILTER (y.no >= x.no) >= 10
),
shifts AS (
    SELECT city_id || '|' || observed_date AS level_shift_id, city_id, observed_date AS shift_date,
           CAST(round(level_before) AS INTEGER) AS before_avg_aqi,
           CAST(round(level_after) AS INTEGER) AS after_avg_aqi,
           CAST(round(jump) AS INTEGER) AS shift_aqi,
           if(jump > 0, 'up', 'down') AS direction
    FROM jumps j
    WHERE abs(jump) >= greatest(50, {k} * spread)
      AND NOT EXISTS (FROM jumps n WHERE n.city_id = j.city_id AND abs(n.no - j.no) <= 7 AND abs(n.jump) > abs(j.jump))
)"""


SHIFTS = shifts("order_series")
STEPPED = """stepped AS (
    SELECT city_id, observed_date, aqi + if(observed_date >= DATE '1995-06-17', 900, 0) AS aqi
    FROM order_series WHERE orders > 1
)"""


def _grouped(by: str, gap: int) -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""starts AS (
    SELECT *, shift_date - lag(shift_date) OVER ({part} ORDER BY shift_date, level_shift_id) <= {gap} AS goes_on
    FROM shifts
),
numbered AS (
    SELECT *, count(*) FILTER (goes_on IS NOT true)
              OVER ({part} ORDER BY shift_date, level_shift_id) AS group_no
    FROM starts
),
grouped AS (
    SELECT {by + ', ' if by else ''}group_no, min(shift_date) AS first_date, count(*) AS shifts,
           CAST(round_even(avg(before_avg_aqi), 0) AS INTEGER) AS before,
           CAST(round_even(avg(after_avg_aqi), 0) AS INTEGER) AS after
    FROM numbered GROUP BY {by + ', ' if by else ''}group_no
)"""


CAUSE = """CASE WHEN shifts >= 3 THEN 'Several cities at once: probably a data-source change'
            ELSE 'Single city: could be real (season, local event) or data' END AS likely_cause"""

MISLABELLED = f"""mislabelled AS (
    SELECT city_id || '|' || observed_date AS daily_aqi_id, city_id, observed_date, aqi,
           {category('(aqi + 10)')} AS aqi_category
    FROM order_series
)"""

UPSERT = """keyed AS (
    SELECT user_id, CAST(ts AS DATE) AS day, event_id, ts, event_type, value,
           event_type IN ('view', 'click', 'purchase') AS stored
    FROM events
),
newest_copy AS (
    SELECT * FROM keyed
    QUALIFY row_number() OVER (PARTITION BY user_id, day, stored ORDER BY ts DESC, event_id DESC) = 1
)"""

RESULTS = f"""results(model, "check", failures) AS (
    SELECT 'lineitem', 'l_suppkey not null', count(*) FILTER (l_suppkey IS NULL) FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_quantity in range', count(*) FILTER (l_quantity NOT BETWEEN 1 AND 40) FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_returnflag accepted', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem
    UNION ALL SELECT 'order_series', 'aqi_category matches aqi',
                     count(*) FILTER (aqi_category <> {category('aqi')}) FROM mislabelled
    UNION ALL SELECT 'order_series', 'aqi in range', count(*) FILTER (aqi NOT BETWEEN 0 AND 500) FROM mislabelled
    UNION ALL SELECT 'lineitem', 'l_orderkey + l_linenumber unique', count(*)
              FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'order_series', 'daily_aqi_id unique', count(*)
              FROM (SELECT 1 FROM mislabelled GROUP BY daily_aqi_id HAVING count(*) > 1)
)"""

TO_SHIFTS = (ORDER_SERIES, SHIFTS)
TO_SUMMARY = (readings(), *TO_FACT, CITIES, SUMMARY)
TO_RECENT = (readings(), *TO_FACT, CITIES, RECENT)

FACT_SQL = _with(readings(), *TO_FACT) + "SELECT * FROM fact"
SUMMARY_SQL = _with(*TO_SUMMARY) + "SELECT * FROM summary"



def _unique(table: str, columns: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {columns} HAVING count(*) > 1))"


def _orphans(table: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE city_id NOT IN (SELECT city_id FROM cities))"


def _where(table: str, condition: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {condition})"


FACT_SHIFTS = shifts("valid")
LABELS = "('Good', 'Satisfactory', 'Moderate', 'Poor', 'Very Poor', 'Severe')"
DECLARED = [
    ("raw", "city_id not null", _where("readings", "city_id IS NULL")),
    ("raw", "observed_at not null", _where("readings", "observed_at IS NULL")),
    ("hourly", "city_id not null", _where("readings", "city_id IS NULL")),
    ("hourly", "observed_at not null", _where("readings", "observed_at IS NULL")),
    ("hourly", "pm2_5 in range", _where("readings", "pm2_5 NOT BETWEEN 0 AND 2000")),
    ("hourly", "pm10 in range", _where("readings", "pm10 NOT BETWEEN 0 AND 3000")),
    ("hourly", "city_id + observed_at unique", _unique("readings", "city_id, observed_at")),
    ("hourly", "city_id known", _orphans("readings")),
    ("pollutant_daily", "city_id + observed_date unique", _unique("daily", "city_id, observed_date")),
    ("dim_city", "city_id not null", _where("cities", "city_id IS NULL")),
    ("dim_city", "city_id unique", _unique("cities", "city_id")),
    ("daily_aqi", "daily_aqi_id not null", _where("fact", "daily_aqi_id IS NULL")),
    ("daily_aqi", "city_id not null", _where("fact", "city_id IS NULL")),
    ("daily_aqi", "aqi in range", _where("fact", "aqi NOT BETWEEN 0 AND 500")),
    ("daily_aqi", "aqi_category accepted", _where("fact", f"aqi_category NOT IN {LABELS}")),
    (
        "daily_aqi",
        "dominant_pollutant accepted",
        _where("fact", "dominant_pollutant NOT IN ('pm2_5', 'pm10', 'no2', 'so2', 'o3', 'co')"),
    ),
    ("daily_aqi", "hours_reported in range", _where("fact", "hours_reported NOT BETWEEN 1 AND 24")),
    ("daily_aqi", "aqi_category matches aqi", _where("fact", f"aqi_category <> {category('aqi')}")),
    ("daily_aqi", "observed_date not in future", _where("fact", "observed_date > current_date")),
    ("daily_aqi", "daily_aqi_id unique", _unique("fact", "daily_aqi_id")),
    ("daily_aqi", "city_id + observed_date unique", _unique("fact", "city_id, observed_date")),
    ("daily_aqi", "city_id known", _orphans("fact")),
    ("city_summary", "city_id not null", _where("summary", "city_id IS NULL")),
    ("city_summary", "city_id unique", _unique("summary", "city_id")),
    ("level_shifts", "level_shift_id not null", _where("shifts", "level_shift_id IS NULL")),
    ("level_shifts", "city_id not null", _where("shifts", "city_id IS NULL")),
    ("level_shifts", "direction accepted", _where("shifts", "direction NOT IN ('up', 'down')")),
    ("level_shifts", "level_shift_id unique", _unique("shifts", "level_shift_id")),
    ("level_shifts", "city_id known", _orphans("shifts")),
]
DECLARED_SQL = (
    _with(*TO_SUMMARY, FACT_SHIFTS)
    + 'SELECT *, CASE WHEN failures = 0 THEN \'pass\' ELSE \'fail\' END AS status FROM (\n'
    + "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, '{check}' AS \"check\", {count} AS failures"
        for model, check, count in DECLARED
    )
    + ")"
)

# day of the month -> broken field and problem
DAMAGE = "(VALUES (3, 'sulphur_dioxide', 'length'), (6, 'nitrogen_dioxide', 'negative'), (9, 'pm10', 'unit'), " \
         "(12, 'carbon_monoxide', 'missing'), (15, 'nitrogen_dioxide', 'negative'), (15, 'pm10', 'unit'), " \
         "(21, 'city_id', 'missing')) " \
         "AS damage(month_day, field, problem)"

ORACLES = {
    "stage_hourly": """
        SELECT 'st' || (user_id % 3) AS city_id, date_trunc('hour', ts) AS observed_at,
               CAST(ts AS DATE) AS observed_date,
               CASE event_type WHEN 'view' THEN value END AS pm2_5,
               CASE event_type WHEN 'click' THEN value END AS pm10,
               CASE event_type WHEN 'purchase' THEN value END AS no2,
               CASE event_type WHEN 'signup' THEN value END AS so2,
               CASE event_type WHEN 'error' THEN value END AS o3,
               CASE event_type WHEN 'error' THEN value * 40 / 1000.0 END AS co_mg_m3,
               event_type AS source, ts AS ingested_at, lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id % 3, date_trunc('hour', ts)
                                   ORDER BY ts DESC, event_id DESC) = 1""",
    "dedupe_latest": """
        SELECT user_id, event_type, ts, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_latest": _with(UPSERT) + """
        SELECT user_id, day, event_id, ts, event_type, value FROM newest_copy
        QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, stored) = 1""",
    "upsert_counts": _with(UPSERT) + """
        SELECT count(*) FILTER (t.user_id IS NULL) AS inserted, count(*) FILTER (s.ts >= t.ts) AS updated
        FROM (SELECT * FROM newest_copy WHERE NOT stored) s
        LEFT JOIN (SELECT * FROM newest_copy WHERE stored) t ON t.user_id = s.user_id AND t.day = s.day""",
    "conform_columns": """
        SELECT CAST(user_id AS VARCHAR) AS city_id, ts AS observed_at, value AS pm2_5,
               CAST(NULL AS DOUBLE) AS pm10, CAST(NULL AS VARCHAR) AS run_id
        FROM events""",
    "payload_flatten": _with(readings(PER_USER)) + """
        SELECT city_id, observed_at, pm2_5, pm10, no2, so2, o3, co FROM readings
        WHERE day(observed_date) NOT IN (3, 6, 9, 12, 15, 21)""",
    "payload_documents": _with(readings(PER_USER)) + """
        SELECT city_id, observed_at, pm2_5, pm10, no2, so2, o3, co FROM readings
        WHERE day(observed_date) NOT IN (3, 6, 9, 12, 15, 21)""",
    "contract_violations": _with(readings(PER_USER)) + f"""
        SELECT CASE WHEN month_day <> 21 THEN city_id END AS city_id, first_hour, field, problem
        FROM (SELECT city_id, observed_date, min(observed_at) AS first_hour FROM readings GROUP BY ALL)
        JOIN {DAMAGE} ON month_day = day(observed_date)""",
    "daily_averages": _with(readings(PER_USER), MEANS) + "SELECT * FROM means",
    "rolling_8h": _with(readings(PER_USER), EIGHT_HOURS) + "SELECT * FROM eight_hours",
    "rolling_any_time": """
        SELECT e.user_id, e.event_id, round(avg(w.value), 9) AS value_8h_avg, count(w.value) AS value_8h_hours
        FROM events e JOIN events w ON w.user_id = e.user_id
         AND w.ts <= e.ts AND w.ts > e.ts - INTERVAL 8 HOUR
        GROUP BY ALL""",
    "daily_rolling_max": _with(readings(), EIGHT_HOURS, HIGHEST) + "SELECT * FROM highest",
    "pollutant_daily": _with(readings(), *TO_DAILY) + "SELECT * FROM daily",
    "unpivot_pollutants": _with(readings(), *TO_DAILY, MEASURED) + "SELECT * FROM measured",
    "sub_indices": _with(readings(), *TO_DAILY, WIDE, INDEXED) + "SELECT * FROM indexed",
    "per_day": _with(readings(), *TO_DAILY, WIDE, ROLLED) + "SELECT * FROM rolled",
    "daily_aqi": FACT_SQL,
    "aqi_trends": _with(ORDER_SERIES) + f"""
        SELECT city_id, observed_date, aqi, {TREND}
        FROM (SELECT city_id, observed_date, CASE WHEN orders > 1 THEN aqi END AS aqi FROM order_series)
        WINDOW series AS (PARTITION BY city_id ORDER BY observed_date)""",
    "category_scale": _with(ORDER_SERIES) + f"""
        SELECT city_id, observed_date, aqi, {category('aqi')} AS aqi_category,
               {ordinal(category('aqi'))} AS category_ordinal
        FROM order_series""",
    "incremental_fact": FACT_SQL,
    "backfill_fact": FACT_SQL,
    "dim_city": _with(CITIES) + "SELECT * FROM cities",
    "latest_per_city": _with(*TO_SUMMARY) + "SELECT * FROM newest",
    "city_summary": SUMMARY_SQL,
    "level_shifts": _with(*TO_SHIFTS) + "SELECT * FROM shifts",
    "named_shifts": _with(*TO_SHIFTS, ORDER_CITIES) + """
        SELECT CAST(shift_date AS VARCHAR) AS shift_date, city_name, before_avg_aqi, after_avg_aqi, shift_aqi
        FROM shifts JOIN order_cities USING (city_id)""",
    "shift_groups": _with(*TO_SHIFTS, _grouped("", 3)) + f"""
        SELECT CAST(first_date AS VARCHAR) AS group_date, shifts, before, after, {CAUSE} FROM grouped""",
    "shift_groups_by_city": _with(*TO_SHIFTS, _grouped("city_id", 30)) + f"""
        SELECT city_id, CAST(first_date AS VARCHAR) AS group_date, shifts, before, after, {CAUSE}
        FROM grouped""",
    "shift_group_members": _with(*TO_SHIFTS, _grouped("", 3)) + """
        SELECT level_shift_id, city_id, shift_date, before_avg_aqi, after_avg_aqi, shift_aqi, direction,
               CAST(first_date AS VARCHAR) AS group_date
        FROM numbered JOIN grouped USING (group_no)""",
    "history_stats": _with(readings(PER_USER)) + """
        SELECT count(*) AS hourly_rows, count(DISTINCT city_id) AS cities, min(observed_date) AS first_day,
               max(observed_date) AS last_day, count(DISTINCT observed_date) AS days, 0 AS has_synthetic
        FROM readings""",
    "recent_daily": _with(*TO_RECENT) + "SELECT * FROM recent",
    "recent_orders": _with(ORDER_SERIES, ORDER_CITIES) + f"""
        SELECT city_id, city_name, CAST(observed_date AS VARCHAR) AS d, aqi, {category('aqi')} AS aqi_category,
               'pm10' AS dominant_pollutant, aqi_7d_avg
        FROM (SELECT *, {TREND} FROM order_series
              WINDOW series AS (PARTITION BY city_id ORDER BY observed_date))
        JOIN order_cities USING (city_id)
        WHERE observed_date > (SELECT max(observed_date) FROM order_series) - 90""",
    "heatmap": _with(*TO_RECENT) + f"""
        SELECT city_name, d, aqi, {ordinal('aqi_category')} AS category_ordinal,
               {label('dominant_pollutant')} AS dominant_label
        FROM recent""",
    "latest_dominant": _with(*TO_RECENT, DOMINANT) + "SELECT * FROM dominant",
    "summary_table": _with(*TO_SUMMARY) + f"""
        SELECT *, {label('usual_dominant_pollutant')} AS usual_dominant_label FROM summary""",
    "kpi_worst": _with(*TO_SUMMARY) + """
        SELECT city_name, avg_aqi_30d, poor_or_worse_days FROM summary
        ORDER BY pollution_rank_30d, city_id LIMIT 1""",
    "kpi_cleanest": _with(*TO_SUMMARY) + """
        SELECT city_name, latest_aqi, latest_category, latest_date FROM summary
        WHERE latest_aqi > 0 ORDER BY latest_aqi, pollution_rank_30d, city_id LIMIT 1""",
    "kpi_poor_cities": _with(*TO_SUMMARY) + """
        SELECT count(*) FILTER (latest_aqi > 200) AS poor_cities,
               (SELECT count(DISTINCT city_id) FROM readings) AS cities
        FROM summary""",
    "latest_bars": _with(*TO_SUMMARY, RECENT, DOMINANT) + f"""
        SELECT s.city_name, latest_aqi, latest_category, {label('dominant_pollutant')} AS dominant_label
        FROM summary s LEFT JOIN dominant USING (city_id) WHERE latest_aqi IS NOT NULL""",
    "dq_not_null": """
        SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id, event_type AS source
        FROM events WHERE event_type <> 'view'""",
    "dq_unique": """
        SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""",
    "dq_unique_combination": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_range": "SELECT event_id, value FROM events WHERE value NOT BETWEEN 5 AND 100",
    "dq_accepted": "SELECT event_id, event_type FROM events WHERE event_type = 'error'",
    "dq_relationships": """
        SELECT l_suppkey, count(*) AS n FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
        GROUP BY l_suppkey""",
    "dq_category": _with(ORDER_SERIES, MISLABELLED) + f"""
        SELECT daily_aqi_id, aqi, aqi_category FROM mislabelled WHERE aqi_category <> {category('aqi')}""",
    "dq_no_future": _with(ORDER_SERIES) + """
        SELECT city_id || '|' || observed_date AS daily_aqi_id, observed_date FROM order_series
        WHERE observed_date > DATE '1999-06-30'""",
    "dq_freshness": """
        SELECT max(ts) AS max_loaded_at,
               CASE WHEN date_diff('second', max(ts), TIMESTAMP '2024-02-01 12:00:00') > 54 * 3600 THEN 'error'
                    WHEN date_diff('second', max(ts), TIMESTAMP '2024-02-01 12:00:00') > 30 * 3600 THEN 'warn'
                    ELSE 'pass' END AS status
        FROM events""",
    "dq_results": _with(ORDER_SERIES, MISLABELLED, RESULTS) + """
        SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM results""",
    "health": _with(ORDER_SERIES, MISLABELLED, RESULTS) + """
        SELECT count(*) AS tests_total, count(*) FILTER (failures = 0) AS tests_passed,
               count(DISTINCT model) FILTER (model <> 'lineitem') AS models,
               string_agg("check", ', ' ORDER BY "check") FILTER (failures > 0) AS failed,
               'warn' AS freshness, (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S UTC') FROM events) AS max_loaded_at,
               (SELECT strftime(min(ts) + INTERVAL 95 SECOND, '%Y-%m-%d %H:%M:%S UTC') FROM events) AS built_at,
               95.3 AS elapsed_s
        FROM results""",
    "cities_from_csv": _with(CITIES) + "SELECT * FROM cities",
    "lake_codec": """
        SELECT count(DISTINCT CAST(ts AS DATE)) AS files, count(DISTINCT CAST(ts AS DATE)) AS zstd_files FROM events""",
    "history_labels": _with(readings(PER_USER)) + """
        SELECT count(*) AS hourly_rows, count(DISTINCT city_id) AS cities,
               strftime(min(observed_date), '%d %b %Y') AS first_day, strftime(max(observed_date), '%d %b %Y') AS last_day,
               count(DISTINCT observed_date) AS days, 1 AS has_synthetic
        FROM readings""",
    "lineage": """
        SELECT event_id, 'events' AS source, '20240120T200000Z' AS run_id, TIMESTAMP '2024-01-20 20:00:00' AS ingested_at
        FROM events""",
    "valid_level_shifts": _with(ORDER_SERIES, STEPPED, shifts("stepped", 2.0))
    + "SELECT * FROM shifts",
    "land_reload": _with(readings()) + """
        SELECT city_id, observed_at, pm2_5,
               CASE WHEN again THEN pm10 + 1 ELSE pm10 END AS pm10,
               CASE WHEN again THEN 'r2' ELSE 'r1' END AS run_id
        FROM (SELECT *, city_id = 'st1' AND observed_date >= DATE '2024-01-25' AS again FROM readings)""",
    "merge_reload": _with(readings()) + """
        SELECT city_id, observed_at, pm2_5,
               CASE WHEN hour(observed_at) < 12 THEN 'r1' ELSE 'r2' END AS run_id
        FROM readings""",
    "arriving_payloads": _with(readings(PER_USER)) + """
        SELECT city_id, observed_at, pm2_5, pm10, no2, so2, o3, co, 'payloads' AS source
        FROM readings WHERE day(observed_date) NOT IN (3, 6, 9, 12, 15, 21)""",
    "land_payloads": _with(readings(PER_USER)) + """
        SELECT city_id, observed_at, pm2_5, pm10, no2, so2, o3, co, 'payloads' AS source, 'r1' AS run_id
        FROM readings WHERE day(observed_date) NOT IN (3, 6, 9, 12, 15, 21)""",
    "ingest_strict": _with(readings(PER_USER)) + f"""
        SELECT field, problem, count(*) AS documents,
               (SELECT count(*) FROM readings WHERE day(observed_date) NOT IN (3, 6, 9, 12, 15, 21)) AS rows_landed
        FROM (SELECT DISTINCT city_id, observed_date FROM readings) JOIN {DAMAGE} ON month_day = day(observed_date)
        GROUP BY field, problem""",
    "rolling_outlier": """
        WITH spiked AS (
            SELECT user_id, ts, event_id, CASE WHEN event_id % 997 = 0 THEN pow(2, 100) ELSE value END AS value FROM events),
        means AS (
            SELECT e.user_id, e.event_id, avg(w.value) AS mean, count(w.value) AS value_8h_hours
            FROM spiked e JOIN spiked w ON w.user_id = e.user_id
             AND w.ts <= e.ts AND w.ts > e.ts - INTERVAL 8 HOUR
            GROUP BY ALL)
        SELECT user_id, event_id, value_8h_hours, mean > 1e20 AS spiked,
               CASE WHEN mean < 1e20 THEN round(mean, 9) END AS value_8h_avg
        FROM means""",
    "read_lake_days": _with(readings()) + """
        SELECT city_id, observed_at, pm2_5 FROM readings
        WHERE observed_date IN (DATE '2024-01-05', DATE '2024-01-17')""",
    "read_lake_from": _with(readings()) + """
        SELECT city_id, observed_at, pm2_5 FROM readings WHERE observed_date >= DATE '2024-01-11'""",
    "raw_files": "SELECT count(DISTINCT CAST(ts AS DATE)) AS raw_files FROM events",
    "audit_gate": FACT_SQL,
    "schema_append": _with(readings(), *TO_FACT) + """
        SELECT daily_aqi_id, observed_date, aqi,
               CASE WHEN observed_date >= DATE '2024-01-12' THEN isodow(observed_date) >= 6 END AS is_weekend
        FROM fact""",
    "build_tables": SUMMARY_SQL,
    "declared_checks": DECLARED_SQL,
    "late_bad_slice": _with(readings()) + """
        SELECT 'hourly' AS model, 'pm10 in range' AS "check", count(*) AS failures, 'fail' AS status
        FROM readings WHERE city_id = 'st1' AND observed_date = DATE '2024-01-05'""",
    "failed_build_keeps_fact": FACT_SQL,
    "late_days_recomputed": FACT_SQL,
    "dead_run_keeps_tables": FACT_SQL,
    "tampered_day": _with(readings(), *TO_FACT) + """
        SELECT 'daily_aqi' AS model, name AS "check", count(*) AS failures, 'fail' AS status
        FROM fact CROSS JOIN (VALUES ('daily_aqi_id unique'), ('city_id + observed_date unique')) AS c(name)
        WHERE observed_date = DATE '2024-01-05' GROUP BY name""",
    "run_times": _with(readings(), *TO_FACT) + "SELECT daily_aqi_id, true AS stamped FROM fact",
    "late_days_reported": """
        SELECT DISTINCT CAST(ts AS DATE) AS observed_date, false AS recomputed
        FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'""",
    "lake_ledger": _with(readings()) + """
        SELECT observed_date AS date, run_id, CAST(count(*) AS BIGINT) AS rows
        FROM readings CROSS JOIN (VALUES ('r1'), ('r2')) AS r(run_id)
        WHERE run_id = 'r1' OR observed_date >= DATE '2024-01-25' GROUP BY ALL""",
    "bucketed_reload": _with(readings()) + """
        SELECT city_id, observed_at, pm2_5,
               CASE WHEN again THEN pm10 + 1 ELSE pm10 END AS pm10,
               CASE WHEN again THEN 'r2' ELSE 'r1' END AS run_id
        FROM (SELECT *, city_id = 'st1' AND observed_date >= DATE '2024-01-25' AS again FROM readings)""",
    "finished_days_only": """
        SELECT event_id, CAST(ts AS DATE) AS date FROM events WHERE ts < TIMESTAMP '2024-01-21'""",
    "last_finished_days": """
        SELECT event_id, CAST(ts AS DATE) AS date FROM events
        WHERE ts >= TIMESTAMP '2024-01-18' AND ts < TIMESTAMP '2024-01-21'""",
}
