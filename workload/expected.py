"""What the registered queries should return, in DuckDB's SQL over the same files.

Rates and averages are worked out in whole numbers and rounded by integer
division, so they do not share arithmetic with the queries they check.
"""

from __future__ import annotations

from roadlens.functions.text import CONTEXT_RULES
from roadlens.plans.contract import CONTRACT
from roadlens.sources.schema import FLAGS, RENAME, TABLE_COLUMNS, TYPES
from workload.incidents import DAYLIGHT, DESCRIPTIONS, FLAG_DIVISORS, STATES, WEATHER, WINDS, ZONES


def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def half_away(num: str, den: str) -> str:
    """num / den rounded half away from zero, as a whole number."""
    return (
        f"(CASE WHEN ({den}) > 0 THEN CAST(sign({num}) AS BIGINT) * "
        f"((2 * abs({num}) + ({den})) // (2 * ({den}))) END)"
    )


def fixed(num: str, den: str, digits: int, factor: int = 1) -> str:
    return f"(CAST({half_away(f'(({num}) * {factor * 10 ** digits})', den)} AS DOUBLE) / {10 ** digits})"


def pct(num: str, den: str, digits: int = 2) -> str:
    return fixed(num, den, digits, 100)


def _rules(text: str, rules) -> str:
    return " ".join(f"WHEN regexp_matches(lower({text}), '{'|'.join(p)}') THEN '{label}'" for label, p in rules)


_FLAGS = ", ".join(f"(p % {d} = 0) AS {f}" if d else f"false AS {f}" for f, d in FLAG_DIVISORS.items())
_LIGHT = ", ".join(
    f"CASE WHEN p % 24 BETWEEN {a} AND {b} THEN 'Day' ELSE 'Night' END AS {name}" for name, (a, b) in DAYLIGHT.items()
)
_DAY = " AND ".join(f"{c} = 'Day'" for c in DAYLIGHT)
_NIGHT = " AND ".join(f"{c} = 'Night'" for c in DAYLIGHT)

INCIDENTS = f"""numbers AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS p,
         o_orderdate AS d, o_orderpriority AS pr, o_orderstatus AS st
  FROM orders
), basic AS (
  SELECT k, c, p, k + 1 AS id, k * 3 + 1 AS source_id,
    CASE st WHEN 'F' THEN 'Source1' WHEN 'O' THEN 'Source2' ELSE 'Source3' END AS source,
    CAST(CASE substr(pr, 1, 1) WHEN '1' THEN 4 WHEN '2' THEN 3 WHEN '3' THEN 2 ELSE 1 END AS INTEGER) AS severity,
    d + to_seconds(p % 24 * 3600 + (p // 24) % 60 * 60 + (p // 1440) % 60) AS start_time,
    p % 200000 - 5000 AS secs,
    CAST(25 AS DOUBLE) + (p % 2400) / 100 AS start_lat,
    CAST(-124 AS DOUBLE) + (c * 7919 % 5700) / 100 AS start_lng,
    p % 5000 AS distance_m, (p % 5000) / 1000 AS distance_mi,
    'Street ' || (c % 211) AS street, 'City ' || (c % 97) AS city, 'County ' || (c % 31) AS county,
    {_list(STATES)}[c % {len(STATES)} + 1] AS state,
    CASE WHEN c % 50 <> 0 THEN lpad(CAST(c % 1000 AS VARCHAR), 5, '0') END AS zipcode,
    {_list(ZONES)}[c % 4 + 1] AS timezone, 'K' || lpad(CAST(c % 200 AS VARCHAR), 3, '0') AS airport_code,
    d + to_seconds(p % 24 * 3600) AS weather_timestamp,
    (p % 1300 - 100) / 10 AS temperature_f, CAST(p % 101 AS DOUBLE) AS humidity_pct,
    (p % 200 + 2900) / 100 AS pressure_in, (p % 41) / 4 AS visibility_mi,
    {_list(WINDS)}[p % 5 + 1] AS wind_direction, (p % 500) / 10 AS wind_speed_mph,
    (p % 30) / 100 AS precipitation_in, {_list(WEATHER)}[(p // 11) % {len(WEATHER)} + 1] AS weather_condition,
    {_FLAGS}, {_LIGHT},
    {_list(DESCRIPTIONS)}[(p // 7) % {len(DESCRIPTIONS)} + 1] || (c % 90) AS description
  FROM numbers
), inc AS (
  SELECT *, start_time + to_seconds(secs) AS end_time,
    {half_away("secs * 100", "60")} AS dur_c, {half_away("secs * 100", "60")} / 100 AS duration_mins,
    CAST(hour(start_time) AS INTEGER) AS hour_of_day, dayname(start_time) AS day_of_week,
    isodow(start_time) >= 6 AS is_weekend,
    hour(start_time) IN (7, 8, 9, 16, 17, 18) AS is_rush_hour,
    CASE WHEN temperature_f <= 32 THEN 'Freezing' WHEN temperature_f <= 50 THEN 'Cold'
         WHEN temperature_f <= 70 THEN 'Mild' WHEN temperature_f <= 90 THEN 'Warm' ELSE 'Hot' END AS temp_bucket,
    CASE WHEN visibility_mi <= 1 THEN 'Low' WHEN visibility_mi <= 5 THEN 'Moderate' ELSE 'Clear' END AS visibility_bucket,
    CASE WHEN {_DAY} THEN 'Full_Day' WHEN {_NIGHT} THEN 'Full_Night' ELSE 'Dawn_Dusk_Transition' END
      AS light_condition_category,
    CASE {_rules("description", CONTEXT_RULES)}
      WHEN junction AND regexp_matches(lower(description), '\\bexit\\b|\\bramp\\b') THEN 'location_highway_exit'
      WHEN junction THEN 'location_junction' WHEN crossing THEN 'location_crossing'
      WHEN traffic_signal THEN 'location_signalized_intersection' ELSE 'other' END AS incident_context
  FROM basic
)"""

N = "count(*)"
CRIT = "count(*) FILTER (WHERE severity = 4)"
AVG_SEV = fixed("sum(severity)", "count(*)", 3)
VALID = "FILTER (WHERE dur_c > 0 AND dur_c < 144000)"
AVG_DUR = fixed(f"sum(dur_c) {VALID}", f"count(*) {VALID} * 100", 2)
BIG = "CAST({} AS BIGINT)"
# rows of the raw file that cleaning drops: unreadable start, missing wind speed, missing zip
DROPPED = "(p % 997 = 0 OR p % 37 = 0 OR c % 50 = 0)"


def over_incidents(sql: str) -> str:
    return f"WITH {INCIDENTS} {sql}"


def _share(by: str, extra: str = "", names: str = "") -> str:
    inner = f"SELECT {by}, {N} AS accident_count{extra} FROM inc GROUP BY {by}"
    return f"SELECT {by}, accident_count, {pct('accident_count', 'sum(accident_count) OVER ()')} AS pct_of_total{names} FROM ({inner})"


def _change(by: str, prev: str, diff: str, rate: str, expr: str) -> str:
    return f"""SELECT {by}, accident_count, {prev}, accident_count - {prev} AS {diff},
      {pct(f'(accident_count - {prev})', prev)} AS {rate}
      FROM (SELECT *, lag(accident_count) OVER (ORDER BY {by}) AS {prev}
            FROM (SELECT {expr} AS {by}, {N} AS accident_count FROM inc GROUP BY 1))"""


MONTH = "CAST(date_trunc('month', start_time) AS DATE)"
FUNNEL = f"""{N} AS total, count(*) FILTER (WHERE severity >= 2) AS s2,
  count(*) FILTER (WHERE severity >= 3) AS s3, {CRIT} AS s4"""


def _questions() -> dict[str, str]:
    q = {
        "scan_count": f"SELECT {N} AS total_accidents FROM inc",
        "severity_share": _share("severity"),
        "state_share_rank": f"SELECT *, rank() OVER (ORDER BY accident_count DESC) AS state_rank FROM ({_share('state')})",
        "source_share": _share("source"),
        "context_share": _share("incident_context"),
        "hour_share": _share("hour_of_day"),
        "weekday_order": _share("day_of_week"),
        "top15_category": _share("weather_condition", f", {AVG_SEV} AS avg_severity", ", avg_severity")
        + " ORDER BY accident_count DESC, weather_condition LIMIT 15",
        "bucket_stats": f"SELECT temp_bucket, {N} AS accident_count, {AVG_SEV} AS avg_severity, {AVG_DUR} AS avg_duration_mins FROM inc GROUP BY 1",
        "monthly_change": _change("accident_month", "prev_month_count", "mom_change", "mom_pct_change", MONTH),
        "yearly_change": _change(
            "accident_year", "prev_year_count", "yoy_change", "yoy_pct_change", "CAST(year(start_time) AS INTEGER)"
        ),
        "running_total": f"""SELECT accident_month, monthly_count,
            CAST(sum(monthly_count) OVER (ORDER BY accident_month) AS BIGINT) AS running_total
            FROM (SELECT {MONTH} AS accident_month, {N} AS monthly_count FROM inc GROUP BY 1)""",
        "hour_ranks": f"""SELECT hour_of_day, {N} AS accident_count, {AVG_SEV} AS avg_severity,
            rank() OVER (ORDER BY avg(severity) DESC NULLS FIRST) AS severity_rank,
            rank() OVER (ORDER BY {N} DESC) AS volume_rank FROM inc GROUP BY 1""",
        "flag_split": _share(
            "is_rush_hour", f", {AVG_SEV} AS avg_severity, {AVG_DUR} AS avg_duration_mins", ", avg_severity, avg_duration_mins"
        ),
        "weekend_split": f"SELECT is_weekend, {N} AS accident_count, {AVG_SEV} AS avg_severity, {AVG_DUR} AS avg_duration_mins FROM inc GROUP BY 1",
        "top20_city": f"""SELECT * FROM (SELECT *, rank() OVER (ORDER BY accident_count DESC) AS city_rank FROM (
            SELECT city, state, {N} AS accident_count, {AVG_SEV} AS avg_severity, {AVG_DUR} AS avg_duration_mins
            FROM inc GROUP BY 1, 2)) WHERE city_rank <= 20""",
        "top5_per_state": f"""SELECT * FROM (
            SELECT *, rank() OVER (PARTITION BY state ORDER BY accident_count DESC) AS rank_within_state FROM (
            SELECT state, city, {N} AS accident_count, {AVG_SEV} AS avg_severity FROM inc GROUP BY 1, 2))
            WHERE rank_within_state <= 5""",
        "visibility_stats": f"""SELECT visibility_bucket, {N} AS accident_count, {AVG_SEV} AS avg_severity,
            {fixed('sum(distance_m)', 'count(*) * 1000', 3)} AS avg_distance_mi FROM inc GROUP BY 1""",
        "light_stats": f"SELECT light_condition_category, {N} AS accident_count, {AVG_SEV} AS avg_severity FROM inc GROUP BY 1",
        "flag_compare": " UNION ALL ".join(
            f"""SELECT '{f}' AS poi_feature,
            {fixed(f'sum(severity) FILTER (WHERE {f})', f'count(*) FILTER (WHERE {f})', 3)} AS avg_sev_true,
            {fixed(f'sum(severity) FILTER (WHERE NOT {f})', f'count(*) FILTER (WHERE NOT {f})', 3)} AS avg_sev_false,
            count(*) FILTER (WHERE {f}) AS count_true FROM inc"""
            for f in FLAGS
        ),
        "compound_flags": f"""SELECT CASE WHEN junction AND traffic_signal THEN 'junction + signal'
            WHEN junction AND NOT traffic_signal THEN 'junction only'
            WHEN NOT junction AND traffic_signal THEN 'signal only' ELSE 'neither' END AS road_context,
            {N} AS accident_count, {AVG_SEV} AS avg_severity, {AVG_DUR} AS avg_duration_mins FROM inc GROUP BY 1""",
        "category_pivot": """SELECT state,
            count(*) FILTER (WHERE weather_condition ILIKE '%clear%') AS clear,
            count(*) FILTER (WHERE weather_condition ILIKE '%rain%' OR weather_condition ILIKE '%shower%') AS rain,
            count(*) FILTER (WHERE weather_condition ILIKE '%snow%' OR weather_condition ILIKE '%sleet%') AS snow,
            count(*) FILTER (WHERE weather_condition ILIKE '%fog%' OR weather_condition ILIKE '%mist%') AS fog,
            count(*) FILTER (WHERE weather_condition ILIKE '%cloud%' OR weather_condition ILIKE '%overcast%') AS cloudy,
            count(*) AS total FROM inc WHERE state IN ('CA', 'FL', 'TX', 'SC', 'NY') GROUP BY 1""",
        "funnel_overall": f"""SELECT total AS total_accidents, s2 AS severity_2_plus, s3 AS severity_3_plus,
            s4 AS severity_4_critical, {pct('s2', 'total')} AS pct_sev_2_plus, {pct('s3', 'total')} AS pct_sev_3_plus,
            {pct('s4', 'total')} AS pct_sev_4 FROM (SELECT {FUNNEL} FROM inc)""",
        "funnel_by_light": f"""SELECT light_condition_category, total, s2 AS sev_2_plus, s3 AS sev_3_plus, s4 AS sev_4,
            {pct('s4', 'total')} AS pct_critical
            FROM (SELECT light_condition_category, {FUNNEL} FROM inc GROUP BY 1)""",
        "funnel_by_context": f"""SELECT incident_context, total, s3 AS serious_or_worse, s4 AS critical,
            {pct('s4', 'total')} AS critical_rate_pct
            FROM (SELECT incident_context, {FUNNEL} FROM inc GROUP BY 1)""",
        "monthly_cohort": f"""SELECT cohort_month, total, s4 AS critical, {pct('s4', 'total')} AS critical_rate_pct,
            {pct('lead(s4) OVER w', 'lead(total) OVER w')} AS next_month_critical_rate
            FROM (SELECT {MONTH} AS cohort_month, {FUNNEL} FROM inc GROUP BY 1) WINDOW w AS (ORDER BY cohort_month)""",
        "state_funnel": f"""SELECT state, total AS total_accidents, s4 AS critical, {pct('s4', 'total')} AS critical_rate_pct,
            rank() OVER (ORDER BY s4 / total DESC) AS critical_rate_rank, avg_severity
            FROM (SELECT state, {FUNNEL}, {AVG_SEV} AS avg_severity FROM inc GROUP BY 1)""",
    }
    dense = f"""SELECT state, {N} AS accident_count, {AVG_SEV} AS avg_severity,
        dense_rank() OVER (ORDER BY avg(severity) DESC NULLS FIRST) AS severity_rank,
        dense_rank() OVER (ORDER BY {N} DESC) AS volume_rank FROM inc GROUP BY 1"""
    q["state_dense_rank"] = dense
    q["rank_divergence"] = (
        f"SELECT *, abs(severity_rank - volume_rank) AS rank_divergence FROM ({dense}) "
        "ORDER BY rank_divergence DESC, state LIMIT 15"
    )
    return {name: over_incidents(sql) for name, sql in q.items()}


# ------------------------------------------------------------- models, marts

_INT_TEMPORAL = f"""SELECT 'monthly' AS granularity, period, accident_count, avg_severity,
    CAST(NULL AS DOUBLE) AS avg_duration_mins, prev AS prev_period_count, {pct('(accident_count - prev)', 'prev')} AS pct_change
  FROM (SELECT *, lag(accident_count) OVER (ORDER BY period) AS prev FROM (
    SELECT CAST(date_trunc('month', start_time) AS TIMESTAMP) AS period, {N} AS accident_count, {AVG_SEV} AS avg_severity
    FROM inc GROUP BY 1))
  UNION ALL SELECT 'yearly', period, accident_count, avg_severity, NULL, prev, {pct('(accident_count - prev)', 'prev')}
  FROM (SELECT *, lag(accident_count) OVER (ORDER BY period) AS prev FROM (
    SELECT CAST(date_trunc('year', start_time) AS TIMESTAMP) AS period, {N} AS accident_count, {AVG_SEV} AS avg_severity
    FROM inc WHERE year(start_time) < 2001 GROUP BY 1))
  UNION ALL SELECT 'hourly', TIMESTAMP '2000-01-01 00:00:00' + to_hours(hour_of_day), {N}, {AVG_SEV},
    CAST(hour_of_day AS DOUBLE), NULL, NULL FROM inc GROUP BY hour_of_day"""

_GEO = f"""{N} AS accident_count, {AVG_SEV} AS avg_severity, {AVG_DUR} AS avg_duration_mins,
    {CRIT} AS critical_count, {pct(CRIT, N)} AS critical_rate_pct"""
_INT_GEO = f"""SELECT 'city' AS geo_level, *, rank() OVER (ORDER BY accident_count DESC) AS volume_rank,
    rank() OVER (ORDER BY avg_severity DESC NULLS FIRST) AS severity_rank,
    rank() OVER (PARTITION BY state ORDER BY accident_count DESC) AS rank_within_state
  FROM (SELECT city, state, {_GEO} FROM inc GROUP BY 1, 2)
  UNION ALL SELECT 'state', NULL, *, rank() OVER (ORDER BY accident_count DESC),
    dense_rank() OVER (ORDER BY avg_severity DESC NULLS FIRST), rank() OVER (ORDER BY critical_rate_pct DESC NULLS FIRST)
  FROM (SELECT state, {_GEO} FROM inc GROUP BY 1)"""


def _environment(kind: str, column: str) -> str:
    return f"""SELECT '{kind}' AS analysis_type, category, accident_count, avg_severity, avg_duration_mins, critical_count,
      critical_rate_pct, CAST(NULL AS DOUBLE) AS avg_sev_false,
      {pct('accident_count', 'sum(accident_count) OVER ()')} AS pct_of_total
      FROM (SELECT {column} AS category, {_GEO} FROM inc GROUP BY 1)"""


def _flag(kind: str, label: str, yes: str, no: str) -> str:
    return f"""SELECT '{kind}', '{label}', count(*) FILTER (WHERE {yes}),
      {fixed(f'sum(severity) FILTER (WHERE {yes})', f'count(*) FILTER (WHERE {yes})', 3)}, NULL, NULL, NULL,
      {fixed(f'sum(severity) FILTER (WHERE {no})', f'count(*) FILTER (WHERE {no})', 3)}, NULL FROM inc"""


_INT_WEATHER = " UNION ALL ".join(
    [
        _environment("weather_condition", "weather_condition"),
        _environment("visibility_bucket", "visibility_bucket"),
        _environment("light_condition", "light_condition_category"),
        *[_flag(f, f, f, f"NOT {f}") for f in ("junction", "crossing", "traffic_signal", "roundabout")],
        _flag("junction_and_signal", "junction + signal", "junction AND traffic_signal", "NOT junction AND NOT traffic_signal"),
    ]
)


def _funnel_rows(dimension: str, value: str, group: str) -> str:
    return f"""SELECT '{dimension}' AS funnel_dimension, value AS dimension_value, total, s2 AS sev_2_plus, s3 AS sev_3_plus,
      s4 AS critical, {pct('s2', 'total')} AS pct_sev_2_plus, {pct('s3', 'total')} AS pct_sev_3_plus,
      {pct('s4', 'total')} AS critical_rate_pct, CAST(NULL AS DATE) AS cohort_period,
      CAST(NULL AS DOUBLE) AS next_period_critical_rate
      FROM (SELECT {value} AS value, {FUNNEL} FROM inc {group})"""


_INT_FUNNEL = " UNION ALL ".join(
    [
        _funnel_rows("overall", "'all'", ""),
        _funnel_rows("by_light", "light_condition_category", "GROUP BY 1"),
        _funnel_rows("by_context", "incident_context", "GROUP BY 1"),
        f"""SELECT 'monthly_cohort', strftime(m, '%Y-%m'), total, NULL, NULL, s4, NULL, NULL, {pct('s4', 'total')}, m,
          {pct('lead(s4) OVER w', 'lead(total) OVER w')}
          FROM (SELECT {MONTH} AS m, {FUNNEL} FROM inc WHERE year(start_time) < 2001 GROUP BY 1)
          WINDOW w AS (ORDER BY m)""",
    ]
)

_MART_TEMPORAL = f"""SELECT granularity, period AS period_date, accident_count, avg_severity, prev_period_count,
    pct_change AS mom_pct_change,
    CASE WHEN granularity = 'monthly' THEN CAST(sum(accident_count) OVER (
      PARTITION BY granularity ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END AS running_total,
    CASE WHEN granularity = 'hourly' THEN rank() OVER (PARTITION BY granularity ORDER BY avg_severity DESC NULLS FIRST) END AS severity_rank,
    CASE WHEN granularity = 'hourly' THEN rank() OVER (PARTITION BY granularity ORDER BY accident_count DESC) END AS volume_rank
  FROM ({_INT_TEMPORAL})"""
_MART_GEO = f"""SELECT * EXCLUDE (rank_within_state), rank_within_state AS critical_rate_rank,
    CASE WHEN geo_level = 'state' THEN abs(volume_rank - severity_rank) END AS rank_divergence
  FROM ({_INT_GEO}) WHERE geo_level = 'state' OR volume_rank <= 20 OR rank_within_state <= 5"""
_MART_WEATHER = f"""WITH base AS ({_INT_WEATHER})
  SELECT * FROM (SELECT *, rank() OVER (ORDER BY accident_count DESC) AS display_rank FROM base
    WHERE analysis_type = 'weather_condition') WHERE display_rank <= 15
  UNION ALL SELECT *, rank() OVER (PARTITION BY analysis_type ORDER BY avg_severity DESC NULLS FIRST) FROM base
    WHERE analysis_type IN ('visibility_bucket', 'light_condition')
  UNION ALL SELECT *, rank() OVER (ORDER BY avg_severity DESC NULLS LAST) FROM base
    WHERE analysis_type NOT IN ('weather_condition', 'visibility_bucket', 'light_condition')"""
_MART_FUNNEL = f"""SELECT *, CASE WHEN funnel_dimension IN ('by_light', 'by_context')
    THEN rank() OVER (PARTITION BY funnel_dimension ORDER BY critical_rate_pct DESC NULLS FIRST) END AS context_rank
  FROM ({_INT_FUNNEL})"""


def _models() -> dict[str, str]:
    q = {
        "int_temporal": _INT_TEMPORAL,
        "int_geo": _INT_GEO,
        "int_weather_poi": f"SELECT * FROM ({_INT_WEATHER})",
        "int_funnel": _INT_FUNNEL,
        "mart_temporal": _MART_TEMPORAL,
        "mart_geo": _MART_GEO,
        "mart_weather_poi": f"SELECT * FROM ({_MART_WEATHER})",
        "mart_funnel": _MART_FUNNEL,
        "mart_export": _MART_FUNNEL,
        "mart_temporal_arrivals": _MART_TEMPORAL,
        "mart_geo_arrivals": _MART_GEO,
        "mart_weather_poi_arrivals": f"SELECT * FROM ({_MART_WEATHER})",
        "mart_funnel_arrivals": _MART_FUNNEL,
        "mart_temporal_export": _MART_TEMPORAL,
        "mart_geo_export": _MART_GEO,
        "mart_weather_poi_export": f"SELECT * FROM ({_MART_WEATHER})",
        "highlights": f"""SELECT
            (SELECT {pct(CRIT, N)} FROM inc) AS national_critical_rate,
            (SELECT {pct(CRIT, N)} FROM inc WHERE light_condition_category = 'Full_Night') AS night_critical_rate,
            (SELECT {pct(CRIT, N)} FROM inc WHERE light_condition_category = 'Full_Day') AS day_critical_rate,
            (SELECT count(*) FROM inc WHERE state = 'CA') AS state_accidents,
            (SELECT {pct(CRIT, N)} FROM inc WHERE state = 'CA') AS state_critical_rate,
            (SELECT {AVG_SEV} FROM inc WHERE roundabout) AS roundabout_severity,
            (SELECT {AVG_SEV} FROM inc WHERE junction) AS junction_severity,
            (SELECT incident_context FROM inc GROUP BY 1 ORDER BY {pct(CRIT, N)} DESC, 1 LIMIT 1) AS top_context_name,
            (SELECT {pct(CRIT, N)} AS r FROM inc GROUP BY incident_context ORDER BY r DESC LIMIT 1) AS top_context_rate""",
    }
    return {name: over_incidents(sql) for name, sql in q.items()}


# ---------------------------------------------------------------------- star


def _key(columns, null_as: str | None = "null") -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    if null_as is not None:
        texts = [f"coalesce({t}, '{null_as}')" for t in texts]
    return "md5(" + " || '|' || ".join(texts) + ")"


LOCATION = ("city", "county", "state", "zipcode", "street", "timezone", "airport_code")
WEATHER_COLUMNS = ("weather_condition", "wind_direction", "temp_bucket", "visibility_bucket", "light_condition_category", *DAYLIGHT)
_LOCATION_KEY, _WEATHER_KEY, _TIME_KEY = _key(LOCATION), _key(WEATHER_COLUMNS), _key(["start_time"], None)
_ROAD_KEY = _key(["coalesce(incident_context, 'null')", *FLAGS], None)
_FACT = f"""SELECT id AS accident_id, source_id, source, {_LOCATION_KEY} AS location_id, {_TIME_KEY} AS time_id,
    {_WEATHER_KEY} AS weather_id, {_ROAD_KEY} AS road_id, severity, duration_mins, distance_mi, start_lat, start_lng,
    temperature_f, humidity_pct, pressure_in, visibility_mi, wind_speed_mph, precipitation_in, start_time, hour_of_day,
    day_of_week, is_weekend, is_rush_hour, description FROM inc"""


def _star() -> dict[str, str]:
    def dim(name: str, key: str, columns) -> str:
        return f"SELECT {key} AS {name}, {', '.join(columns)} FROM (SELECT DISTINCT {', '.join(columns)} FROM inc)"

    q = {
        "dim_location": dim("location_id", _LOCATION_KEY, LOCATION),
        "dim_weather": dim("weather_id", _WEATHER_KEY, WEATHER_COLUMNS),
        "dim_road": dim("road_id", _ROAD_KEY, ("incident_context", *FLAGS)),
        "dim_time": f"""SELECT {_TIME_KEY} AS time_id, start_time, CAST(hour(start_time) AS INTEGER) AS hour_of_day,
            dayname(start_time) AS day_of_week, dayofweek(start_time) IN (0, 6) AS is_weekend,
            hour(start_time) IN (7, 8, 16, 17, 18) AS is_rush_hour, CAST(month(start_time) AS INTEGER) AS month_num,
            monthname(start_time) AS month_name, CAST(year(start_time) AS INTEGER) AS year_num,
            CAST(quarter(start_time) AS INTEGER) AS quarter_num, {MONTH} AS month_start,
            CAST(date_trunc('year', start_time) AS DATE) AS year_start,
            year(start_time) = 2020 AND month(start_time) BETWEEN 3 AND 6 AS is_covid_lockdown_period
            FROM (SELECT DISTINCT start_time FROM inc)""",
        "fact": _FACT,
        "star_join": f"""SELECT id AS accident_id, {_LOCATION_KEY} AS location_id, severity, duration_mins, city, county, state,
            zipcode, CAST(month(start_time) AS INTEGER) AS month_num, monthname(start_time) AS month_name,
            CAST(quarter(start_time) AS INTEGER) AS quarter_num, weather_condition, temp_bucket, incident_context, junction
            FROM inc""",
        "star_join_whole": f"""SELECT f.*, {', '.join('i.' + c for c in (*LOCATION, *WEATHER_COLUMNS, 'incident_context', *FLAGS))},
            CAST(month(i.start_time) AS INTEGER) AS month_num, monthname(i.start_time) AS month_name,
            CAST(year(i.start_time) AS INTEGER) AS year_num, CAST(quarter(i.start_time) AS INTEGER) AS quarter_num,
            CAST(date_trunc('month', i.start_time) AS DATE) AS month_start, CAST(date_trunc('year', i.start_time) AS DATE) AS year_start,
            year(i.start_time) = 2020 AND month(i.start_time) BETWEEN 3 AND 6 AS is_covid_lockdown_period
            FROM ({_FACT}) f JOIN inc i ON i.id = f.accident_id""",
        "star_by_location": f"""SELECT id AS accident_id, {_LOCATION_KEY} AS location_id, severity, city, county, state, zipcode,
            timezone FROM inc""",
        "star_by_time": f"""SELECT id AS accident_id, {_TIME_KEY} AS time_id, severity, start_time, CAST(month(start_time) AS INTEGER) AS month_num,
            monthname(start_time) AS month_name, CAST(quarter(start_time) AS INTEGER) AS quarter_num FROM inc""",
        "star_rollup": f"""SELECT state, CAST(quarter(start_time) AS INTEGER) AS quarter_num, incident_context,
            {N} AS accident_count, {AVG_SEV} AS avg_severity FROM inc GROUP BY ALL""",
    }
    return {name: over_incidents(sql) for name, sql in q.items()}


# ------------------------------------------------------------------ cleaning


def _cleaned(name: str) -> str:
    if name == "precipitation_in":
        return "CASE WHEN p % 3 = 0 THEN 0 ELSE precipitation_in END AS precipitation_in"
    return name


_CLEAN_ROWS = f"FROM inc WHERE NOT {DROPPED}"

DOCUMENT_RULES = (
    ("licensed", ("licen[cs]e",)),
    ("english", (r"\bthe\b", r"\band\b")),
    ("german", (r"\bund\b", r"\bder\b")),
    ("french", (r"\bles\b", r"\bdes\b")),
)


def _cleaning() -> dict[str, str]:
    clean = f"SELECT {', '.join(_cleaned(c) for c in RENAME.values())} {_CLEAN_ROWS}"
    staged = ", ".join(_cleaned(c) for c in TABLE_COLUMNS)
    q = {
        "clean_pipeline": clean,
        "clean_stream": clean,
        "clean_file_round_trip": clean,
        "load_and_stage": f"SELECT row_number() OVER (ORDER BY source_id) AS accident_id, {staged} {_CLEAN_ROWS}",
        "raw_line_breaks": f"SELECT source_id, description || chr(10) || 'second line' AS description {_CLEAN_ROWS}",
        "raw_split_read": f"""SELECT source_id, description || chr(10) || 'a "second", line' AS description
            {_CLEAN_ROWS}""",
        "raw_header_order": f"SELECT source_id, city, county {_CLEAN_ROWS}",
        "clean_unreadable": f"""SELECT {N} AS rows_seen, count(*) FILTER (WHERE bad) AS rows_unreadable,
            count(*) FILTER (WHERE NOT bad AND {DROPPED}) AS rows_dropped,
            count(*) FILTER (WHERE NOT bad AND NOT {DROPPED}) AS rows_kept,
            {pct(f'count(*) FILTER (WHERE NOT bad AND {DROPPED})', N, 3)} AS dropped_pct
            FROM (SELECT *, k % 41 = 0 OR k % 43 = 0 AS bad FROM inc)""",
        "clean_strings": """SELECT source_id, zipcode, timezone, count(*) AS n FROM inc GROUP BY ALL""",
        "parse_time": """SELECT source_id, CASE WHEN p % 997 <> 0 THEN start_time END AS start_time, end_time FROM inc""",
        "drop_null_rows": f"""SELECT {N} AS rows_seen, count(*) FILTER (WHERE {DROPPED}) AS rows_dropped,
            count(*) FILTER (WHERE NOT {DROPPED}) AS rows_kept,
            {pct(f'count(*) FILTER (WHERE {DROPPED})', N, 3)} AS dropped_pct FROM inc""",
        "drop_null_rows_observed": f"""SELECT {N} AS rows_seen,
            count(*) FILTER (WHERE p % 997 = 0 OR p % 37 = 0) AS rows_dropped,
            count(*) FILTER (WHERE NOT (p % 997 = 0 OR p % 37 = 0)) AS rows_kept,
            {pct('count(*) FILTER (WHERE p % 997 = 0 OR p % 37 = 0)', N, 3)} AS dropped_pct FROM inc""",
        "time_features": """SELECT id, duration_mins, hour_of_day, day_of_week, is_weekend, is_rush_hour FROM inc""",
        "bucket_labels": """SELECT id, temp_bucket, visibility_bucket, light_condition_category FROM inc""",
        "incident_context": "SELECT id, incident_context FROM inc",
        "staged": f"SELECT id AS accident_id, {', '.join(TABLE_COLUMNS)} FROM inc",
    }
    out = {name: over_incidents(sql) for name, sql in q.items()}
    # here \b means ASCII word boundaries; the texts are in four languages, so spell out the Unicode ones
    edge = r"[^\p{L}\p{N}_]"
    spelled = [
        (label, [f"(?:^|{edge}){p[2:-2]}(?:$|{edge})" if p.startswith("\\b") else p for p in patterns])
        for label, patterns in DOCUMENT_RULES
    ]
    out["keyword_context"] = f"""SELECT doc_id, CASE {_rules('text', spelled)}
        WHEN quality = 1 THEN 'rated_good' WHEN toxic = 1 THEN 'rated_toxic' ELSE 'other' END AS topic
        FROM documents LEFT JOIN labels USING (doc_id)"""
    return out


# ---------------------------------------------------------------- dashboards

_CHOSEN = """state IN ('CA', 'TX', 'NY', 'FL', 'OH') AND year(start_time) BETWEEN 1996 AND 1999
    AND hour_of_day BETWEEN 5 AND 20 AND severity IN (2, 3, 4) AND dur_c BETWEEN 0 AND 60000"""
_SWITCHED = "is_weekend AND is_rush_hour AND junction"
RADIUS, STEP = 80000.0, 2.0
# Levels of a cell pyramid.
LEVELS = 5


def _statistics(where: str) -> str:
    levels = ", ".join(f"count(*) FILTER (WHERE severity = {s}) AS sev{s}" for s in (1, 2, 3, 4))
    shares = ", ".join(f"coalesce({pct(f'sev{s}', 'total', 1)}, 0) AS pct{s}" for s in (1, 2, 3, 4))
    return f"""SELECT *, {shares} FROM (SELECT {N} AS total, {AVG_SEV} AS avg_severity,
        {fixed(f'sum(dur_c) {VALID}', f'count(*) {VALID} * 100', 1)} AS avg_duration,
        {pct(CRIT, N)} AS critical_rate, {levels} FROM inc WHERE {where})"""


_COLOURS = """CASE severity WHEN 1 THEN '0,200,100,180' WHEN 2 THEN '255,220,0,180' WHEN 3 THEN '255,140,0,200'
    WHEN 4 THEN '220,30,30,220' ELSE '150,150,150,180' END"""


def _maps() -> dict[str, str]:
    # the plane the hexagons lie on, with one degree at latitude 39.5
    north = "(CAST(6371008.8 AS DOUBLE) * pi() / 180)"
    east = f"({north} * cos(radians(CAST(39.5 AS DOUBLE))))"
    hexes = f"""SELECT id, severity, qf, rf, -qf - rf AS sf FROM (
        SELECT id, severity, start_lng * ({east} / {RADIUS}) * (sqrt(3) / 3) - start_lat * ({north} / {RADIUS}) * (CAST(1 AS DOUBLE) / 3) AS qf,
          start_lat * ({north} / {RADIUS}) * (CAST(2 AS DOUBLE) / 3) AS rf FROM inc)"""
    rounded = f"""SELECT *, floor(qf + 0.5) AS q0, floor(rf + 0.5) AS r0, floor(sf + 0.5) AS s0 FROM ({hexes})"""
    moved = f"SELECT *, abs(q0 - qf) AS mq, abs(r0 - rf) AS mr, abs(s0 - sf) AS ms FROM ({rounded})"
    q = {
        "filter_stats": _statistics(_CHOSEN),
        "filter_stats_switches": _statistics(_SWITCHED),
        "filter_stats_all": _statistics("true"),
        "point_sample": f"""SELECT id, start_lat AS lat, start_lng AS lng, severity, city, state, incident_context,
            strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time, duration_mins, weather_condition, hour_of_day,
            {_COLOURS} AS colour
            FROM inc WHERE hour_of_day BETWEEN 6 AND 20 ORDER BY md5('7|' || id), id LIMIT 1000""",
        "record_detail": """SELECT id, source_id, severity, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
            strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, duration_mins, start_lat, start_lng, distance_mi, city, county,
            state, zipcode, street, timezone, weather_condition, temperature_f, humidity_pct, visibility_mi, wind_speed_mph,
            precipitation_in, wind_direction, incident_context, light_condition_category, junction, crossing, traffic_signal,
            roundabout, is_rush_hour, is_weekend, description FROM inc WHERE id = (SELECT max(id) FROM inc)""",
        "filter_options": """SELECT 'state' AS filter_name, state AS value FROM inc UNION
            SELECT 'weather_condition', weather_condition FROM inc WHERE weather_condition IS NOT NULL UNION
            SELECT 'incident_context', incident_context FROM inc""",
        "distinct_sorted": "SELECT DISTINCT weather_condition FROM inc WHERE weather_condition IS NOT NULL ORDER BY 1",
        "severity_names": f"""SELECT severity, CASE severity WHEN 1 THEN 'Minor' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Serious'
            WHEN 4 THEN 'Critical' END AS label, {_COLOURS} AS colour, {N} AS accident_count FROM inc GROUP BY ALL""",
        "hex_bin": f"""SELECT cell_q, cell_r, {N} AS accident_count, {AVG_SEV} AS avg_severity,
            round(cell_r * CAST(1.5 AS DOUBLE) * {RADIUS} / {north}, 6) AS lat,
            round((cell_q + cell_r / CAST(2 AS DOUBLE)) * sqrt(3) * {RADIUS} / {east}, 6) AS lng FROM (
            SELECT severity, CAST(CASE WHEN mq > mr AND mq > ms THEN -r0 - s0 ELSE q0 END AS BIGINT) AS cell_q,
              CAST(CASE WHEN NOT (mq > mr AND mq > ms) AND mr > ms THEN -q0 - s0 ELSE r0 END AS BIGINT) AS cell_r
            FROM ({moved})) GROUP BY 1, 2""",
        "heat_grid": f"""SELECT *, CAST((cell_row + 0.5) * {STEP} AS DOUBLE) AS lat, CAST((cell_col + 0.5) * {STEP} AS DOUBLE) AS lng FROM (
            SELECT CAST(floor(start_lat / {STEP}) AS BIGINT) AS cell_row, CAST(floor(start_lng / {STEP}) AS BIGINT) AS cell_col,
              {N} AS accident_count, {AVG_SEV} AS mean_weight FROM inc GROUP BY 1, 2)""",
        "heat_grid_weighted": f"""SELECT *, CAST((cell_row + 0.5) * {STEP} AS DOUBLE) AS lat,
            CAST((cell_col + 0.5) * {STEP} AS DOUBLE) AS lng FROM (
            SELECT CAST(floor(start_lat / {STEP}) AS BIGINT) AS cell_row, CAST(floor(start_lng / {STEP}) AS BIGINT) AS cell_col,
              {N} AS accident_count, {fixed("sum(dur_c)", "count(*) * 100", 3)} AS mean_weight FROM inc GROUP BY 1, 2)""",
    }
    return {name: over_incidents(sql) for name, sql in q.items()}


# ---------------------------------------------------- profiles, checks, load

# all columns but the ids and the description
REPORTED = tuple(c for c in RENAME.values() if c not in ("source_id", "description"))
NUMBERS = tuple(c for c in REPORTED if TYPES.get(c, "string").startswith(("int", "double", "decimal")))
PROFILED = tuple(c for c in REPORTED if c not in NUMBERS or c in ("severity", "hour_of_day"))
SUMMARISED = tuple(c for c in NUMBERS if c not in ("severity", "hour_of_day"))


def _frequencies() -> str:
    one = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM inc WHERE {c} IS NOT NULL" for c in PROFILED
    )
    return f""", counted AS (SELECT column_name, value, count(*) AS n FROM ({one}) GROUP BY 1, 2),
      placed AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place,
        count(*) OVER (PARTITION BY column_name) AS u, sum(n) OVER (PARTITION BY column_name) AS t FROM counted),
      folded AS (SELECT column_name, u, t, place, value, n FROM placed WHERE u <= 20 OR place <= 15
        UNION ALL SELECT column_name, u, t, 16, '__other__', sum(n) FROM placed WHERE u > 20 AND place > 15 GROUP BY 1, 2, 3)
      SELECT column_name, u AS unique_values_total, u > 20 AS truncated_to_top_n, CAST(place AS BIGINT) AS place, value,
        CAST(n AS BIGINT) AS count, {pct('n', 't', 3)} AS pct FROM folded"""


def _summary(column: str) -> str:
    q = ", ".join(
        f"round(quantile_cont({column}, {p}), 3) AS {name}" for p, name in ((0.5, "median"), (0.25, "q1_25pct"), (0.75, "q3_75pct"))
    )
    return f"""SELECT '{column}' AS column_name, count({column}) AS count, round(min({column}), 3) AS min,
      round(max({column}), 3) AS max, round(avg({column}), 3) AS mean, round(stddev_pop({column}), 3) AS std, {q} FROM inc"""


def _raw_columns() -> list[tuple[str, str, str]]:
    """(name, type, condition of a missing value) of the raw file as it is read."""
    missing = {"wind_speed_mph": "p % 37 = 0", "precipitation_in": "p % 3 = 0", "zipcode": "c % 50 = 0"}
    rows = []
    for raw, name in list(RENAME.items())[:42]:
        kind = TYPES.get(name, "string")
        kind = "double" if kind.startswith("decimal") else "string" if kind.startswith(("timestamp", "bigint")) else kind
        rows.append((raw, kind, missing.get(name, "false")))
    return rows + [(c, "string", "false") for c in ("End_Lat", "End_Lng", "Country", "Wind_Chill(F)")]


def _null_audit() -> str:
    one = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS dtype, count(*) FILTER (WHERE {missing}) AS m, count(*) AS t FROM inc"
        for name, kind, missing in _raw_columns()
    )
    return f"""SELECT column_name, dtype, m AS missing_count, {pct('m', 't', 3)} AS missing_pct, t AS total_rows,
      count(*) OVER () AS total_columns, count(*) FILTER (WHERE m > 0) OVER () AS columns_with_missing_values FROM ({one})"""


def _classes() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CASE WHEN count(DISTINCT {c}) <= 25 THEN 'categorical' ELSE 'numeric' END AS kind FROM inc"
        if c in NUMBERS else f"SELECT '{c}', 'categorical'"
        for c in REPORTED
    ]
    return "SELECT * FROM (SELECT '' AS column_name, '' AS kind WHERE false) UNION ALL " + " UNION ALL ".join(parts)


def _report() -> str:
    """All frequencies and summaries, with the figures of the report's header; the rows are read once and unpivoted."""
    head = f"(SELECT count(*) FROM kept) AS total_rows, CAST({len(REPORTED)} AS BIGINT) AS total_columns_analyzed, 'id,source_id,description' AS columns_skipped"
    texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in PROFILED)
    numbers = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMBERS)
    quartiles = ", ".join(
        f"round(quantile_cont(value, {p}), 3) AS {name}" for p, name in ((0.5, "median"), (0.25, "q1_25pct"), (0.75, "q3_75pct"))
    )
    return f""", kept AS MATERIALIZED (SELECT {', '.join(REPORTED)} FROM inc),
      cells AS (UNPIVOT (SELECT {texts} FROM kept) ON COLUMNS(*) INTO NAME column_name VALUE value),
      values_of AS (UNPIVOT (SELECT {numbers} FROM kept) ON COLUMNS(*) INTO NAME column_name VALUE value),
      n AS MATERIALIZED (SELECT column_name, count(value) AS count, round(min(value), 3) AS min, round(max(value), 3) AS max,
        round(avg(value), 3) AS mean, round(stddev_pop(value), 3) AS std, {quartiles}, count(DISTINCT value) AS u
        FROM values_of GROUP BY column_name),
      counted AS (SELECT column_name, value, count(*) AS n FROM cells GROUP BY 1, 2),
      placed AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place,
        count(*) OVER (PARTITION BY column_name) AS u, sum(n) OVER (PARTITION BY column_name) AS t FROM counted),
      folded AS (SELECT column_name, u, t, place, value, n FROM placed WHERE u <= 20 OR place <= 15
        UNION ALL SELECT column_name, u, t, 16, '__other__', sum(n) FROM placed WHERE u > 20 AND place > 15 GROUP BY 1, 2, 3)
      SELECT column_name, 'categorical' AS kind, CAST(place AS BIGINT) AS place, value, CAST(n AS BIGINT) AS count,
        {pct('n', 't', 3)} AS pct, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS median,
        NULL::DOUBLE AS std, NULL::DOUBLE AS q1_25pct, NULL::DOUBLE AS q3_75pct, {head}
      FROM folded WHERE column_name NOT IN (SELECT column_name FROM n WHERE u > 25)
      UNION ALL SELECT column_name, 'numeric', NULL, NULL, count, NULL, min, max, mean, median, std, q1_25pct, q3_75pct, {head}
      FROM n WHERE u > 25"""


def _contract() -> str:
    """All checks that pass on a cleanly built set of tables, with their names."""
    rows = []
    for model, rules in CONTRACT.items():
        rows += [(model, c, "not_null") for c in rules.get("not_null", ())]
        rows += [(model, c, "accepted_values") for c in rules.get("accepted", {})]
        rows += [(model, c, "unique") for c in rules.get("unique", ())]
        rows += [(model, c, "relationships") for c in rules.get("relationships", {})]
    values = ", ".join(f"('{m}', '{c}', '{k}', CAST(0 AS BIGINT))" for m, c, k in rows)
    return f"SELECT * FROM (VALUES {values}) AS t(model, column_name, \"check\", failures)"


#: What is wrong with one table of each layer, as ``contract_damage`` damages them; all other checks pass.
_DAMAGE = {
    ("incidents", "id", "unique"): "(SELECT count(*) FROM inc WHERE id % 13 = 0)",
    ("incidents", "severity", "not_null"): "(SELECT sum(times) FROM t WHERE id % 5 = 0)",
    ("incidents", "severity", "accepted_values"): "(SELECT sum(times) FROM t WHERE id % 5 <> 0 AND id % 7 = 0)",
    ("staged", "state", "not_null"): "(SELECT count(*) FROM inc WHERE id % 11 = 0)",
    ("int_temporal", "granularity", "accepted_values"): "(SELECT count(DISTINCT hour_of_day) FROM inc)",
    ("int_temporal", "accident_count", "not_null"): "(SELECT count(DISTINCT year(start_time)) FROM inc WHERE year(start_time) < 2001)",
    ("dim_location", "location_id", "unique"): f"(SELECT count(DISTINCT {_LOCATION_KEY}) FROM inc WHERE state = 'CA')",
    ("dim_location", "state", "not_null"): f"(SELECT count(DISTINCT {_LOCATION_KEY}) FROM inc WHERE state = 'TX')",
    ("mart_funnel", "dimension_value", "not_null"): "(SELECT count(DISTINCT light_condition_category) FROM inc)",
}


def _damage() -> str:
    rows = []
    for model in dict.fromkeys(m for m, _, _ in _DAMAGE):
        for kind, check in (("not_null", "not_null"), ("accepted", "accepted_values"), ("unique", "unique")):
            for column in CONTRACT[model].get(kind, ()):
                failures = _DAMAGE.get((model, column, check), "0")
                rows.append(f"""SELECT '{model}' AS model, '{column}' AS column_name, '{check}' AS "check",
                    CAST(coalesce({failures}, 0) AS BIGINT) AS failures""")
    return " UNION ALL ".join(rows)


_FAILURES = """SELECT 'fact' AS model, column_name, "check", failures FROM (
      SELECT 'accident_id' AS column_name, 'unique' AS "check", count(*) FILTER (WHERE id % 13 = 0) AS failures FROM inc
      UNION ALL SELECT 'severity', 'not_null', CAST(coalesce(sum(times) FILTER (WHERE id % 5 = 0), 0) AS BIGINT) FROM t
      UNION ALL SELECT 'start_time', 'not_null', 0
      UNION ALL SELECT 'severity', 'accepted_values', CAST(coalesce(sum(times) FILTER (WHERE id % 5 <> 0 AND id % 7 = 0), 0) AS BIGINT) FROM t
      UNION ALL SELECT 'location_id', 'relationships', CAST(coalesce(sum(times) FILTER (WHERE id % 11 = 0), 0) AS BIGINT) FROM t)"""
_TIMES = ", t AS (SELECT id, CASE WHEN id % 13 = 0 THEN 2 ELSE 1 END AS times FROM inc)"


def _checks() -> dict[str, str]:
    q = {
        "null_audit": _null_audit(),
        "column_classes": _classes(),
        "column_profile": " UNION ALL ".join(_summary(c) for c in SUMMARISED),
        "dq_not_null": " UNION ALL ".join(
            f"""SELECT 'raw' AS model, '{name}' AS column_name, 'not_null' AS "check",
            count(*) FILTER (WHERE {missing}) AS failures FROM inc""" for name, _, missing in _raw_columns()
        ),
        "layout_clustered": f"""SELECT state, severity, incident_context, {N} AS accident_count FROM inc
            WHERE hour_of_day = 8 AND severity >= 2 GROUP BY ALL""",
        "point_lookup": """SELECT id, source_id, city, state, severity, description FROM inc
            WHERE id = (SELECT max(id) FROM inc) AND city IS NOT NULL""",
        "first_rows": "SELECT least(50, count(*)) AS n_rows, least(50, count(*)) AS n_known FROM inc",
        "versioned_refresh": f"""SELECT step, severity, {N} AS accident_count FROM inc,
            (VALUES ('first'), ('after_failure'), ('refreshed'), ('held')) AS steps(step)
            WHERE step = 'refreshed' OR severity <= 2 GROUP BY ALL""",
        "heat_pyramid": " UNION ALL ".join(f"""SELECT *, CAST((cell_row + 0.5) * step AS DOUBLE) AS lat, CAST((cell_col + 0.5) * step AS DOUBLE) AS lng
            FROM (SELECT CAST({level} AS BIGINT) AS level, CAST({STEP * 2**level} AS DOUBLE) AS step,
              CAST(floor(start_lat / {STEP * 2**level}) AS BIGINT) AS cell_row, CAST(floor(start_lng / {STEP * 2**level}) AS BIGINT) AS cell_col,
              {N} AS accident_count, {AVG_SEV} AS mean_weight FROM inc GROUP BY ALL)""" for level in range(LEVELS)),
        "layout_read": f"""SELECT state, severity, CAST(year(start_time) AS INTEGER) AS year, {N} AS accident_count FROM inc
            WHERE year(start_time) BETWEEN 1997 AND 1998 GROUP BY ALL""",
        "load_verify": f"""SELECT 'total' AS section, 'all' AS value, {N} AS row_count FROM inc
            UNION ALL SELECT 'severity', CAST(severity AS VARCHAR), {N} FROM inc GROUP BY 2
            UNION ALL SELECT * FROM (SELECT 'state', state, {N} AS n FROM inc GROUP BY 2 ORDER BY n DESC, state LIMIT 5)""",
        "contract_checks": _contract(),
    }
    out = {name: over_incidents(sql) for name, sql in q.items()}
    out["value_frequencies"] = f"WITH {INCIDENTS}{_frequencies()}"
    out["contract_damage"] = f"WITH {INCIDENTS}{_TIMES} {_damage()}"
    out["contract_failures"] = f"WITH {INCIDENTS}{_TIMES} {_FAILURES}"
    out["check_summary"] = f"""WITH {INCIDENTS}{_TIMES} SELECT "check", count(*) AS checks,
        count(*) FILTER (WHERE failures = 0) AS passed, count(*) FILTER (WHERE failures > 0) AS failed
        FROM ({_FAILURES}) GROUP BY 1"""
    out["stats_report"] = f"WITH {INCIDENTS}{_report()}"
    out["dq_unique"] = """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1"""
    out["dq_accepted"] = """SELECT 'orders' AS model, column_name, 'accepted_values' AS "check", failures FROM (
        SELECT 'o_orderpriority' AS column_name, count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS failures FROM orders
        UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders)"""
    out["dq_relationships"] = """SELECT * FROM (
        SELECT 'documents' AS model, 'doc_id' AS column_name, 'relationships' AS "check",
          (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS failures
        UNION ALL SELECT 'lineitem', 'l_orderkey', 'relationships',
          (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
        UNION ALL SELECT 'lineitem', 'l_suppkey', 'relationships',
          (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)))"""
    out["dq_relationships_dense"] = out["dq_relationships"]
    out["null_report_file"] = over_incidents(f"SELECT *, 'raw incidents' AS source_file FROM ({_null_audit()})")
    out["stats_report_file"] = f"""SELECT *, 'incidents' AS source_file FROM ({out["stats_report"]})"""
    out["serial_id"] = """SELECT row_number() OVER (
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
          l_returnflag, l_linestatus, l_shipdate) AS id, * FROM lineitem"""
    return out


def expected_sql() -> dict[str, str]:
    return {**_questions(), **_models(), **_star(), **_cleaning(), **_maps(), **_checks()}
