"""SQL twins of the catalogue, for DuckDB over the same test tables."""

from __future__ import annotations

import re

from meterlens.functions.hashing import bloom_size
from meterlens.plans import catalog as Q
from meterlens.schema import DEFAULT_THRESHOLDS, FEATURES, PRIMARY_USES

READINGS = """
SELECT e.event_id AS row_id, e.user_id AS building_id, e.ts AS "timestamp",
  CASE WHEN e.k = 0 THEN NULL ELSE e.value END AS meter_reading,
  CAST(CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS anomaly,
  c.c_mktsegment AS primary_use, CAST(c.c_nationkey AS INTEGER) AS site_id,
  CAST(floor(abs(c.c_acctbal) * 12) AS DOUBLE) AS square_feet,
  CAST(1 + c.c_custkey % 10 AS DOUBLE) AS floor_count,
  CAST(1950 + c.c_custkey % 70 AS INTEGER) AS year_built,
  CAST(CASE WHEN e.k = 99 THEN NULL ELSE e.k * 0.5 - 10 END AS DOUBLE) AS air_temperature,
  CAST((e.event_id % 31) * 0.5 AS DOUBLE) AS wind_speed,
  CAST(e.event_id % 10 AS DOUBLE) AS cloud_coverage,
  CAST(CASE WHEN e.k = 99 THEN NULL ELSE e.k * 0.5 - 10 END - 2 - e.event_id % 7 AS DOUBLE)
    AS dew_temperature,
  CAST(1000 + (e.event_id * 7) % 40 AS DOUBLE) AS sea_level_pressure,
  CAST(extract(hour FROM e.ts) AS INTEGER) AS "hour",
  CAST(extract(isodow FROM e.ts) - 1 AS INTEGER) AS "weekday",
  CAST(extract(month FROM e.ts) AS INTEGER) AS "month"
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
JOIN customer c ON c.c_custkey = e.user_id
"""

STATS = """
SELECT building_id, avg(meter_reading) AS mean, stddev_pop(meter_reading) AS std,
  min(meter_reading) AS "min", max(meter_reading) AS "max", count(*) AS "count",
  quantile_cont(meter_reading, 0.5) AS median,
  quantile_cont(meter_reading, 0.75) AS q75, quantile_cont(meter_reading, 0.25) AS q25
FROM usable GROUP BY building_id
"""

# Each usable reading with its building's statistics and the verdicts of two methods.
JUDGED = """
SELECT u.*, s.mean, s.std, s.q25, s.q75,
  CASE WHEN s.std > 0 THEN abs(meter_reading - mean) / std ELSE 0 END AS z_score,
  CASE WHEN s.std > 0 THEN abs(meter_reading - mean) / std > 3 ELSE false END AS sigma_anomaly,
  CASE WHEN s.std > 0 THEN least(abs(meter_reading - mean) / std / 3, 1) ELSE 0 END
    AS sigma_confidence,
  CASE WHEN s.std = 0 THEN 'No variance in data'
    ELSE format('Z-score: {:.2f}', abs(meter_reading - mean) / std) END AS sigma_details,
  q25 - 1.5 * (q75 - q25) AS low, q75 + 1.5 * (q75 - q25) AS high,
  CASE WHEN q75 = q25 THEN false
    ELSE meter_reading < q25 - 1.5 * (q75 - q25) OR meter_reading > q75 + 1.5 * (q75 - q25)
    END AS iqr_anomaly,
  CASE WHEN q75 = q25 THEN 0 ELSE least(greatest(q25 - 1.5 * (q75 - q25) - meter_reading,
    meter_reading - q75 - 1.5 * (q75 - q25), 0) / (q75 - q25), 1) END AS iqr_confidence
FROM usable u JOIN stats s USING (building_id)
"""

MOVING = """
SELECT row_id, n, moving_avg, moving_std,
  n >= 24 AND moving_std > 0 AND abs(meter_reading - moving_avg) > 2 * moving_std AS ma_anomaly,
  CASE WHEN n >= 24 AND moving_std > 0
    THEN least(abs(meter_reading - moving_avg) / (2 * moving_std), 1) ELSE 0 END AS ma_confidence
FROM (
  SELECT row_id, meter_reading, count(*) OVER w AS n, avg(meter_reading) OVER w AS moving_avg,
    stddev_pop(meter_reading) OVER w AS moving_std
  FROM usable
  WINDOW w AS (PARTITION BY building_id ORDER BY "timestamp", row_id
    ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
"""

LATEST = """
SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY building_id ORDER BY "timestamp" DESC, row_id DESC) AS rn FROM usable)
WHERE rn = 1
"""

ASOF = f"""
SELECT building_id, n AS n_readings, cur AS current_reading, moving_avg, moving_std,
  n >= 24 AND moving_std > 0 AND abs(cur - moving_avg) > 2 * moving_std AS ma_anomaly,
  CASE WHEN n >= 24 AND moving_std > 0 THEN least(abs(cur - moving_avg) / (2 * moving_std), 1)
    ELSE 0 END AS ma_confidence
FROM (
  SELECT building_id, max(n) AS n, max(CASE WHEN rn = n THEN meter_reading END) AS cur,
    avg(CASE WHEN rn < n THEN meter_reading END) AS moving_avg,
    stddev_pop(CASE WHEN rn < n THEN meter_reading END) AS moving_std
  FROM (
    SELECT *, count(*) OVER (PARTITION BY building_id) AS n FROM (
      SELECT u.*, row_number() OVER (
        PARTITION BY u.building_id ORDER BY u."timestamp", u.row_id) AS rn
      FROM usable u JOIN latest l USING (building_id)
      WHERE u."timestamp" >= l."timestamp" - INTERVAL {Q.RANGE_HOURS} HOUR)
    WHERE rn <= 25)
  GROUP BY building_id)
"""

LONG = "SELECT row_id, building_id, parameter, value FROM ({}) UNPIVOT (value FOR parameter IN ({}))"
FEATURE_COLUMNS = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in FEATURES)
QUOTED_FEATURES = ", ".join(f'"{c}"' for c in FEATURES)


def long_features(source: str) -> str:
    rows = f"SELECT row_id, building_id, {FEATURE_COLUMNS} FROM {source}"
    return LONG.format(rows, QUOTED_FEATURES)


THRESHOLDS = """
SELECT parameter, avg(value) AS mean, stddev_samp(value) AS std,
  avg(value) - 3 * stddev_samp(value) AS "min", avg(value) + 3 * stddev_samp(value) AS "max",
  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
FROM long_usable GROUP BY parameter
"""

COMMON = {
    "r": READINGS,
    "usable": "SELECT * FROM r WHERE meter_reading IS NOT NULL",
    "labelled": "SELECT * FROM usable WHERE anomaly = 1",
    "stats": STATS,
    "judged": JUDGED,
    "moving": MOVING,
    "latest": LATEST,
    "at_latest": ASOF,
    "long_usable": long_features("usable"),
    "thresholds": THRESHOLDS,
    "weather": "SELECT * FROM usable WHERE air_temperature IS NOT NULL AND wind_speed IS NOT NULL",
}

EXPLORED = """
SELECT * FROM r WHERE building_id >= 3 AND building_id <= 120 AND meter_reading >= 2.5
  AND air_temperature <= 30 AND wind_speed >= 1
  AND "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-21'
"""


def md5_mod(text: str, modulus: int) -> str:
    rest = "0"
    for start in (1, 9, 17, 25):
        chunk = f"CAST('0x' || substr(md5({text}), {start}, 8) AS BIGINT)"
        rest = f"(({rest}) * 4294967296 + {chunk}) % {modulus}"
    return rest


def placed(source: str, item: str, capacity: int, error_rate: float) -> str:
    """CTEs: items in order, their bits, and when each bit was first set."""
    bits, hashes = bloom_size(capacity, error_rate)
    return f"""
items AS (SELECT *, {item} AS item,
  row_number() OVER (ORDER BY "timestamp", row_id) AS seq FROM {source}),
placed AS (SELECT row_id, seq, {md5_mod("item || '_' || i", bits)} AS bit
  FROM items, (SELECT unnest(range({hashes})) AS i)),
first_set AS (SELECT bit, min(seq) AS first_set FROM placed GROUP BY bit),
marked AS (SELECT row_id, max(first_set) < max(seq) AS is_duplicate
  FROM placed JOIN first_set USING (bit) GROUP BY row_id)"""


ITEM = "building_id || '_' || format('{:.2f}', meter_reading)"
ALERT_ITEM = (
    "building_id || '_' || strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f') || '_' "
    "|| format('{:.3f}', sigma_confidence)"
)


def bloom_statistics(capacity: int, error_rate: float, extra: str = "") -> str:
    bits, hashes = bloom_size(capacity, error_rate)
    return f"""
SELECT total_processed, duplicates_detected,
  duplicates_detected / total_processed * 100 AS duplicate_rate,
  CAST({capacity} AS BIGINT) AS capacity, items_added,
  CAST({bits} AS BIGINT) AS bit_array_size, bits_set, bits_set / {bits} AS utilization,
  round(pow(1 - pow(1 - 1 / CAST({bits} AS DOUBLE), {hashes} * items_added), {hashes}), 9)
    AS estimated_fpr, {hashes} AS hash_functions{extra}
FROM (SELECT count(*) AS total_processed, count(*) FILTER (is_duplicate) AS duplicates_detected,
    count(*) FILTER (NOT is_duplicate) AS items_added FROM marked),
  (SELECT count(*) AS bits_set FROM first_set)
"""


def closed_form(n: str) -> str:
    size = f"(length(bin({n} + 1)) - 1)"
    rest = f"({n} + 1 - (CAST(1 AS BIGINT) << {size}))"
    largest = f"((CAST(1 AS BIGINT) << {size}) >> 1)"
    return f"""
  CAST(CASE WHEN {n} > 0 THEN {rest} + {largest} - 1 ELSE 0 END AS BIGINT) AS estimate_per_size,
  CAST({n} - ({largest} - ({largest} >> 1)) AS BIGINT) AS estimate_classic,
  CAST({size} + bit_count({rest}) AS BIGINT) AS bucket_count,
  CAST(({size} + bit_count({rest})) * 16 AS BIGINT) AS memory_bytes"""


def with_common(body: str, extra: str = "") -> str:
    """Prefix a query with the common tables it uses."""
    text = extra + body
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        for other in COMMON:
            if other != name and used(other, COMMON[name]):
                visit(other)
        needed.append(name)

    for name in COMMON:
        if used(name, text):
            visit(name)
    tables = ",\n".join(f"{n} AS ({COMMON[n]})" for n in needed)
    return f"WITH {tables}{',' if extra and tables else ''}{extra}\n{body}"


def used(name: str, text: str) -> bool:
    return re.search(rf"\b(FROM|JOIN)\s+{name}\b|,\s*{name}\s+[a-z]\b", text) is not None


PATTERN = """round(avg(meter_reading), 9) AS mean, count(meter_reading) AS "count",
  CAST(sum(anomaly) AS BIGINT) AS anomalies"""

COLUMNS = ("row_id", "building_id", "timestamp", "meter_reading", "anomaly")
READING = ", ".join(f'"{c}"' for c in COLUMNS)


def verdict(prefix: str, method: str, extra: str = "", details: str = "") -> str:
    return (
        f"{READING}, {extra} {prefix}_anomaly AS is_anomaly, "
        f"round({prefix}_confidence, 9) AS confidence, '{method}' AS method{details}"
    )


def corr(y: str) -> str:
    return f"corr(meter_reading, {y})"


def trend(measure: str) -> str:
    fit = f"""regr_slope(meter_reading, {measure}) AS slope,
    regr_intercept(meter_reading, {measure}) AS intercept"""
    return f"""SELECT '{measure}' AS measure, points, round(slope, 9) AS slope,
  round(intercept, 9) AS intercept, x_min, x_max,
  round(intercept + slope * x_min, 9) AS y_min, round(intercept + slope * x_max, 9) AS y_max
FROM (SELECT count(*) AS points, {fit}, min({measure}) AS x_min, max({measure}) AS x_max
  FROM weather)"""


def describe(column: str) -> str:
    v = f'CAST("{column}" AS DOUBLE)'
    quartiles = ", ".join(
        f"round(quantile_cont({v}, {q / 100}), 6) AS p{q}" for q in (25, 50, 75)
    )
    return f"""SELECT '{column}' AS column_name, count({v}) AS "count",
  round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS std, round(min({v}), 6) AS "min",
  {quartiles}, round(max({v}), 6) AS "max" FROM r"""


ALL = ["row_id", "building_id", "timestamp", "meter_reading", "anomaly", "primary_use", "site_id",
       "square_feet", "floor_count", "year_built", "air_temperature", "wind_speed",
       "cloud_coverage", "dew_temperature", "sea_level_pressure", "hour", "weekday", "month"]
NUMERIC = [c for c in ALL if c not in ("timestamp", "primary_use")]


def side(column: str) -> str:
    left = f'count("{column}")' if column in COLUMNS else "NULL"
    right = f'count("{column}")' if column != "anomaly" else "NULL"
    name = "left only" if column == "anomaly" else "common" if column in COLUMNS else "right only"
    return (
        f"SELECT '{column}' AS column_name, CAST({left} AS BIGINT) AS left_values, "
        f"CAST({right} AS BIGINT) AS right_values, '{name}' AS side FROM r"
    )


def listed(table: str, column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(DISTINCT {column}) AS distinct_values,
  coalesce(CASE WHEN count(DISTINCT {column}) < 20 THEN array_to_string(
    list_sort(list(DISTINCT {column})), '|') END, '') AS listed
FROM {table}"""


def windows(starts: str, width: str) -> str:
    return f"""SELECT w AS window_start, w + INTERVAL '{width}' AS window_end, primary_use,
  count(*) AS readings, count(*) FILTER (anomaly = 1) AS anomalies FROM ({starts}) GROUP BY ALL"""


DEFAULTS = ", ".join(str(row) for row in DEFAULT_THRESHOLDS)
OUTSIDE = """SELECT l.row_id, l.building_id, l.parameter, l.value, t.mean, t."min" AS low,
    t."max" AS high, CASE WHEN t.std > 0 THEN abs(l.value - t.mean) / t.std ELSE 0 END AS deviation
  FROM long_all l JOIN {} t USING (parameter) WHERE l.value < t."min" OR l.value > t."max\""""
SEVERITY = "CASE WHEN deviation > 4 THEN 'HIGH' WHEN deviation > 3 THEN 'MEDIUM' ELSE 'LOW' END"
RANGE = "format('{:.2f} - {:.2f}', low, high)"

TRAINING = (
    f"SELECT row_id, {FEATURE_COLUMNS}, anomaly FROM r WHERE "
    + " AND ".join(f'"{c}" IS NOT NULL' for c in FEATURES)
)

INSIGHTS = """
types AS (SELECT primary_use, avg(meter_reading) AS mean FROM r GROUP BY 1),
hours AS (SELECT "hour" AS h, avg(meter_reading) AS mean FROM r GROUP BY 1),
buildings AS (SELECT building_id, sum(anomaly) AS a FROM r GROUP BY 1),
found AS (
  (SELECT 'most_efficient_type' AS kind, primary_use AS subject, mean AS value FROM types
   WHERE (SELECT count(*) FROM types) > 1 ORDER BY mean, primary_use LIMIT 1)
  UNION ALL (SELECT 'least_efficient_type', primary_use, mean FROM types
   WHERE (SELECT count(*) FROM types) > 1 ORDER BY mean DESC, primary_use LIMIT 1)
  UNION ALL (SELECT 'worst_building', CAST(building_id AS VARCHAR), a FROM buildings
   WHERE a > 0 ORDER BY a DESC, building_id LIMIT 1)
  UNION ALL (SELECT 'temperature_effect', CASE WHEN c > 0 THEN 'increases' ELSE 'decreases' END, c
   FROM (SELECT corr(meter_reading, air_temperature) AS c FROM r) WHERE abs(c) > 0.3)
  UNION ALL (SELECT 'peak_hour', CAST(h AS VARCHAR), mean FROM hours
   WHERE (SELECT count(*) FROM hours) > 12 ORDER BY mean DESC, h LIMIT 1))"""

BINNED = """
bounds AS (SELECT min(air_temperature) AS lo, max(air_temperature) AS hi FROM weather),
binned AS (SELECT meter_reading, CAST(CASE WHEN hi > lo THEN greatest(1, least(5,
  ceil((air_temperature - lo) * 5 / (hi - lo)))) ELSE 3 END AS INTEGER) AS bin
  FROM weather, bounds)"""

ENSEMBLE = """
SELECT j.*, m.ma_anomaly, m.ma_confidence,
  CAST(sigma_anomaly AS INTEGER) + CAST(iqr_anomaly AS INTEGER) + CAST(ma_anomaly AS INTEGER)
    AS votes FROM judged j JOIN moving m USING (row_id)"""

PREDICTED = "SELECT anomaly AS label, CAST(sigma_anomaly AS INTEGER) AS prediction FROM judged"

SHUFFLED = "md5('42_' || row_id)"

ENTRY = """
SELECT row_id, building_id * 2 - 5 AS building_id, meter_reading - 0.5 AS meter_reading,
  CASE WHEN row_id % 17 <> 0 THEN date_trunc('minute', "timestamp") END AS "timestamp",
  air_temperature, wind_speed - 0.5 AS wind_speed, anomaly,
  CASE WHEN building_id * 2 - 5 > 199 THEN 'New Building' ELSE 'Office' END AS primary_use,
  concat_ws(',', CASE WHEN building_id * 2 - 5 < 0 THEN 'building_id' END,
    CASE WHEN coalesce(meter_reading - 0.5 < 0, true) THEN 'meter_reading' END,
    CASE WHEN row_id % 17 = 0 THEN 'timestamp' END,
    CASE WHEN wind_speed - 0.5 < 0 THEN 'wind_speed' END) AS errors
FROM r"""

Q_ORACLES = {
    "ingest_readings": """SELECT * FROM r UNION ALL
SELECT * REPLACE (CAST(NULL AS DOUBLE) AS wind_speed) FROM r WHERE row_id % 89 = 0""",
    "iso_times": """SELECT row_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS iso FROM r""",
    "missing_features": """SELECT row_id, 'wind_speed,square_feet,floor_count' AS missing_features,
  CAST(0 AS DOUBLE) AS wind_speed, CAST(0 AS DOUBLE) AS square_feet,
  CAST(0 AS DOUBLE) AS floor_count, meter_reading FROM r""",
    "recent_detections": """SELECT building_id, "timestamp", meter_reading,
  round(iqr_confidence, 9) AS anomaly_score, 'iqr' AS detection_method,
  "timestamp" + INTERVAL 1 HOUR AS detected_at FROM judged WHERE iqr_anomaly
ORDER BY detected_at DESC, building_id, "timestamp" DESC LIMIT 20""",
    "classification_form": f"""SELECT row_id, primary_use IN ({', '.join(repr(u) for u in PRIMARY_USES)})
  AS known_type, true AS is_probability, true AS prediction_fits,
  round(CASE WHEN square_feet > 0 THEN meter_reading / square_feet END, 9) AS use_per_area,
  CAST(2025 - year_built AS INTEGER) AS building_age, "weekday" >= 5 AS is_weekend,
  "hour" BETWEEN 8 AND 18 AS is_business_hours FROM r WHERE row_id % 50 = 0""",
    "table_counts": """SELECT 'meter_readings' AS table_name, count(*) AS row_count FROM r
UNION ALL SELECT 'anomalies', count(*) FROM judged WHERE sigma_anomaly""",
    "entry_validate": f"SELECT *, errors = '' AS is_valid FROM ({ENTRY})",
    "project_readings": """SELECT building_id, meter_reading, anomaly, air_temperature, wind_speed,
  cloud_coverage, primary_use, square_feet, floor_count, "hour", "weekday", "month", "timestamp"
FROM usable""",
    "non_null_readings": "SELECT * FROM usable",
    "labeled_anomalies": "SELECT * FROM labelled",
    "time_range": """SELECT row_id, "timestamp", meter_reading FROM r WHERE "timestamp" BETWEEN
  TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "drop_null_weather": """SELECT row_id, building_id, "timestamp", meter_reading, anomaly,
  air_temperature, wind_speed, cloud_coverage, dew_temperature, sea_level_pressure, "hour",
  "weekday", "month" FROM weather""",
    "explore_filter": EXPLORED,
    "join_on_row_id": "SELECT * FROM r",
    "schema_compare": " UNION ALL ".join(side(c) for c in ALL),
    "overall_stats": """SELECT count(*) AS total_readings,
  count(DISTINCT building_id) AS total_buildings, count(*) FILTER (anomaly = 1) AS labeled_anomalies,
  count(*) FILTER (anomaly <> 1) AS normal_readings,
  round_even(count(*) FILTER (anomaly = 1) / count(*) * 100, 2) AS anomaly_rate,
  (SELECT count(*) FROM judged WHERE sigma_anomaly) AS detected_anomalies FROM r""",
    "distinct_buildings": "SELECT count(DISTINCT building_id) AS total_buildings FROM r",
    "building_types": """SELECT primary_use, count(*) AS row_count FROM r GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10""",
    "building_summary": """SELECT building_id, arg_min(primary_use, ("timestamp", row_id))
    AS primary_use, arg_min(site_id, ("timestamp", row_id)) AS site_id,
  arg_min(square_feet, ("timestamp", row_id)) AS square_feet,
  arg_min(floor_count, ("timestamp", row_id)) AS floor_count, count(*) AS total_readings,
  count(*) FILTER (anomaly = 1) AS anomaly_count, max("timestamp") AS last_reading,
  round(avg(meter_reading), 9) AS avg_consumption,
  count(*) FILTER (anomaly = 1) / count(*) * 100 AS anomaly_rate,
  count(*) FILTER (anomaly = 1) / count(*) * 100 > 5 AS is_marked FROM r GROUP BY 1""",
    "building_detail": """SELECT building_id, round(avg(meter_reading), 9) AS avg_consumption,
  min(meter_reading) AS min_consumption, max(meter_reading) AS max_consumption,
  count(*) AS total_readings, count(*) FILTER (anomaly = 1) AS anomaly_count FROM usable GROUP BY 1""",
    "building_info": """SELECT DISTINCT ON (building_id) building_id, primary_use, site_id,
  square_feet, floor_count, year_built FROM r ORDER BY building_id, "timestamp", row_id""",
    "building_statistics": """SELECT building_id, round(mean, 9) AS mean, round(std, 9) AS std,
  "min", "max", "count", round(median, 9) AS median, round(q75, 9) AS q75,
  round(q25, 9) AS q25 FROM stats""",
    "anomaly_distribution": "SELECT anomaly, count(*) AS row_count FROM r GROUP BY 1",
    "weather_correlation": f"""SELECT count(*) AS sample_size,
  round({corr('air_temperature')}, 9) AS temperature, round({corr('wind_speed')}, 9) AS wind_speed,
  round({corr('cloud_coverage')}, 9) AS cloud_coverage FROM weather HAVING count(*) >= 100""",
    "weather_dashboard": f"""SELECT count(*) AS sample_size,
  round({corr('air_temperature')}, 9) AS temperature, round({corr('wind_speed')}, 9) AS wind_speed
FROM usable WHERE air_temperature IS NOT NULL HAVING count(*) >= 100""",
    "weather_trend": trend("air_temperature") + " UNION ALL " + trend("wind_speed"),
    "type_performance": """SELECT *, round_even(anomaly_sum / meter_reading_count * 100, 2)
    AS anomaly_rate,
  round_even(meter_reading_mean / square_feet_mean * 1000, 3) AS consumption_per_sqft
FROM (SELECT primary_use, round_even(avg(meter_reading), 2) AS meter_reading_mean,
  round_even(stddev_samp(meter_reading), 2) AS meter_reading_std,
  count(meter_reading) AS meter_reading_count, CAST(sum(anomaly) AS BIGINT) AS anomaly_sum,
  round_even(avg(square_feet), 2) AS square_feet_mean FROM r GROUP BY 1)""",
    "size_performance": f"""SELECT *, round(anomalies / "count" * 100, 9) AS anomaly_rate
FROM (SELECT CASE WHEN square_feet <= 10000 THEN 'Small' WHEN square_feet <= 50000 THEN 'Medium'
  WHEN square_feet <= 100000 THEN 'Large' ELSE 'Very Large' END AS size_category, {PATTERN}
  FROM r WHERE square_feet > 0 GROUP BY 1)""",
    "hourly_patterns": f"""SELECT "hour", {PATTERN}, count(meter_reading) > 10
  AND avg(meter_reading) > (SELECT avg(meter_reading) FROM r) AS is_peak FROM r GROUP BY 1""",
    "weekday_patterns": f"""SELECT "weekday", {PATTERN},
  (['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'])["weekday" + 1] AS day_name,
  count(meter_reading) > 10 AS is_shown FROM r GROUP BY 1""",
    "monthly_patterns": f'SELECT "month", {PATTERN} FROM r GROUP BY 1',
    "anomaly_comparison": """SELECT total_readings, total_anomalies,
  total_anomalies / total_readings * 100 AS anomaly_rate, round(a, 9) AS anomaly_avg,
  round(n, 9) AS normal_avg, round(a - n, 9) AS difference,
  round((a / n - 1) * 100, 9) AS percent_difference
FROM (SELECT count(*) AS total_readings, CAST(sum(anomaly) AS BIGINT) AS total_anomalies,
  avg(meter_reading) FILTER (anomaly = 1) AS a, avg(meter_reading) FILTER (anomaly = 0) AS n
  FROM r)""",
    "anomaly_by_type": """SELECT primary_use, count(*) FILTER (anomaly = 1) AS anomalies,
  count(*) AS total, count(*) FILTER (anomaly = 1) / count(*) * 100 AS rate FROM r GROUP BY 1
HAVING count(*) FILTER (anomaly = 1) > 0 ORDER BY 2 DESC, 1 LIMIT 5""",
    "worst_building": """SELECT building_id, CAST(sum(anomaly) AS BIGINT) AS anomaly_count FROM r
GROUP BY 1 HAVING sum(anomaly) > 0 ORDER BY 2 DESC, 1 LIMIT 1""",
    "feature_thresholds": """SELECT parameter, round(mean, 6) AS mean, round(std, 6) AS std,
  round("min", 6) AS "min", round("max", 6) AS "max", round(q1, 6) AS q1, round(q3, 6) AS q3
FROM thresholds""",
    "explore_summary": f"""SELECT count(*) AS total_records,
  count(DISTINCT building_id) AS unique_buildings, count(*) FILTER (anomaly = 1) AS total_anomalies,
  round(avg(meter_reading), 1) AS avg_consumption FROM ({EXPLORED})""",
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(\"{c}\") AS non_null, "
        f'round((1 - count("{c}") / count(*)) * 100, 9) AS null_percent FROM r' for c in ALL
    ),
    "numeric_describe": " UNION ALL ".join(describe(c) for c in NUMERIC),
    "categorical_profile": " UNION ALL ".join(
        [listed("r", "primary_use"), listed("events", "event_type"), listed("events", "props")]
    ),
    "label_distribution": """SELECT 'anomaly' AS column_name, CAST(anomaly AS VARCHAR) AS value,
  count(*) AS row_count, count(*) / (SELECT count(*) FROM r) * 100 AS percentage
FROM r GROUP BY anomaly""",
    "latest_reading": """SELECT building_id, row_id, "timestamp", meter_reading, primary_use,
  site_id FROM latest""",
    "recent_24": """SELECT row_id, building_id, "timestamp", meter_reading, anomaly,
  air_temperature, "hour", CAST(rn AS INTEGER) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY "timestamp" DESC, row_id DESC)
    AS rn FROM usable) WHERE rn <= 24""",
    "recent_readings": """SELECT row_id, building_id, "timestamp", meter_reading, anomaly,
  primary_use, air_temperature FROM usable ORDER BY "timestamp" DESC, row_id DESC LIMIT 50""",
    "recent_anomalies": """SELECT row_id, building_id, "timestamp", meter_reading, primary_use,
  air_temperature, site_id FROM labelled ORDER BY "timestamp" DESC, row_id DESC LIMIT 20""",
    "building_page": """SELECT building_id, arg_min(primary_use, ("timestamp", row_id))
    AS primary_use, arg_min(site_id, ("timestamp", row_id)) AS site_id,
  arg_min(square_feet, ("timestamp", row_id)) AS square_feet,
  arg_min(floor_count, ("timestamp", row_id)) AS floor_count, count(*) AS total_readings,
  count(*) FILTER (anomaly = 1) AS anomaly_count, max("timestamp") AS last_reading,
  count(*) FILTER (anomaly = 1) / count(*) * 100 AS anomaly_rate,
  count(*) FILTER (anomaly = 1) / count(*) * 100 > 5 AS is_marked
FROM r GROUP BY 1 ORDER BY 1 LIMIT 20 OFFSET 20""",
    "explore_page": f"""SELECT row_id, building_id, "timestamp", meter_reading, 3 AS page,
  (SELECT count(*) FROM ({EXPLORED})) AS total,
  CAST(ceil((SELECT count(*) FROM ({EXPLORED})) / 50) AS BIGINT) AS pages
FROM ({EXPLORED}) ORDER BY "timestamp" DESC, row_id DESC LIMIT 50 OFFSET 100""",
    "all_anomalies": """SELECT building_id, "timestamp", meter_reading, primary_use,
  air_temperature, site_id, 'labeled' AS source FROM labelled
UNION ALL SELECT building_id, "timestamp", meter_reading, NULL, NULL, NULL, 'detected'
FROM judged WHERE sigma_anomaly""",
    "reading_context": """SELECT row_id, CASE WHEN square_feet > 0
    THEN round(meter_reading / square_feet, 9) END AS use_per_area,
  2025 - year_built AS building_age, "weekday" >= 5 AS is_weekend,
  "hour" BETWEEN 8 AND 18 AS is_business_hours FROM r""",
    "three_sigma": "SELECT "
    + verdict("sigma", "3sigma", "round(z_score, 9) AS z_score,", ", sigma_details AS details")
    + " FROM judged",
    "iqr": "SELECT "
    + verdict(
        "iqr", "iqr", "round(low, 9) AS lower_bound, round(high, 9) AS upper_bound,"
    )
    + " FROM judged",
    "moving_average": "SELECT " + ", ".join(f'u."{c}"' for c in COLUMNS) + """,
  m.n AS n_readings, round(m.moving_avg, 9) AS moving_avg, round(m.moving_std, 9) AS moving_std,
  ma_anomaly AS is_anomaly, round(ma_confidence, 9) AS confidence, 'moving_avg' AS method
  FROM usable u JOIN moving m USING (row_id)""",
    "moving_average_asof": """SELECT building_id, n_readings, current_reading,
  round(moving_avg, 9) AS moving_avg, round(moving_std, 9) AS moving_std,
  ma_anomaly AS is_anomaly, round(ma_confidence, 9) AS confidence, 'moving_avg' AS method
FROM at_latest""",
    "ensemble": f"""SELECT {READING}, votes, sigma_anomaly, iqr_anomaly, ma_anomaly,
  votes >= 2 AS is_anomaly,
  round((sigma_confidence + iqr_confidence + ma_confidence) / 3, 9) AS confidence,
  'ensemble' AS method FROM ({ENSEMBLE})""",
    "detect_batch": """SELECT building_id, meter_reading, "timestamp", votes >= 2 AS is_anomaly,
  round(c, 9) AS confidence, 'ensemble' AS method, votes || '/3' AS votes FROM (
  SELECT l.building_id, l.meter_reading, l."timestamp",
    CAST(sigma_anomaly AS INTEGER) + CAST(iqr_anomaly AS INTEGER) + CAST(ma_anomaly AS INTEGER)
      AS votes, (sigma_confidence + iqr_confidence + ma_confidence) / 3 AS c
  FROM latest l JOIN judged j USING (row_id) JOIN at_latest a ON a.building_id = l.building_id)""",
    "detect_latest": """SELECT l.building_id, l.meter_reading, l."timestamp",
  z_score > 3 AS is_anomaly, round(least(z_score / 3, 1), 9) AS confidence,
  round(z_score, 9) AS z_score, '3-sigma' AS method, l.primary_use, l.site_id,
  round(s.mean, 9) AS mean, round(s.std, 9) AS std, s."count" AS total_readings
FROM latest l JOIN judged j USING (row_id) JOIN stats s ON s.building_id = l.building_id""",
    "sample_readings": f"""SELECT row_id, building_id, "timestamp", meter_reading, anomaly,
  air_temperature, wind_speed, cloud_coverage, dew_temperature, sea_level_pressure, "hour",
  "weekday", "month" FROM usable ORDER BY {SHUFFLED} LIMIT {Q.SAMPLE}""",
    "training_set": TRAINING,
    "stratified_split": f"""SELECT row_id, anomaly, rn <= round_even(n * 0.2, 0) AS is_test
FROM (SELECT row_id, anomaly, row_number() OVER (PARTITION BY anomaly ORDER BY {SHUFFLED}) AS rn,
  count(*) OVER (PARTITION BY anomaly) AS n FROM ({TRAINING}))""",
    "confusion_matrix": f"SELECT *, count(*) AS row_count FROM ({PREDICTED}) GROUP BY ALL",
    "classification_report": f"""SELECT class, round(p, 9) AS precision, round(q, 9) AS recall,
  round(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END, 9) AS f1, support,
  round(accuracy, 9) AS accuracy FROM (
  SELECT c AS class,
    coalesce(count(*) FILTER (label = c AND prediction = c) / nullif(count(*) FILTER (prediction = c), 0), 0) AS p,
    coalesce(count(*) FILTER (label = c AND prediction = c) / nullif(count(*) FILTER (label = c), 0), 0) AS q,
    count(*) FILTER (label = c) AS support, count(*) FILTER (label = prediction) / count(*) AS accuracy
  FROM ({PREDICTED}), (SELECT unnest([0, 1]) AS c) GROUP BY c)""",
    "dgim_closed_form": f"""SELECT building_id, ones, {closed_form('ones')}
FROM (SELECT building_id, count(*) FILTER (anomaly = 1) AS ones FROM r GROUP BY 1)""",
    "exact_window_count": f"""SELECT DISTINCT building_id, "timestamp", ones_in_window FROM (
  SELECT building_id, "timestamp", count(*) FILTER (anomaly = 1) OVER (PARTITION BY building_id
    ORDER BY "timestamp" RANGE BETWEEN INTERVAL {3 * Q.DAY} SECOND PRECEDING AND CURRENT ROW)
    AS ones_in_window FROM r)""",
    "exact_dedup": f"""SELECT {ITEM} AS item, arg_min(row_id, ("timestamp", row_id)) AS row_id,
  min("timestamp") AS "timestamp", count(*) AS copies FROM labelled GROUP BY 1""",
    "tumbling_counts": windows(
        "SELECT *, time_bucket(INTERVAL '6 hours', \"timestamp\") AS w FROM r", "6 hours"
    ),
    "sliding_counts": windows(
        "SELECT *, time_bucket(INTERVAL '6 hours', \"timestamp\") - to_hours(h) AS w "
        "FROM r, (SELECT unnest([0, 6]) AS h)", "12 hours"
    ),
    "session_counts": f"""SELECT building_id, min("timestamp") AS window_start,
  max("timestamp") + INTERVAL {6 * Q.HOUR} SECOND AS window_end, count(*) AS readings,
  count(*) FILTER (anomaly = 1) AS anomalies FROM (
  SELECT *, sum(starts) OVER (PARTITION BY building_id ORDER BY "timestamp", row_id) AS session
  FROM (SELECT *, CASE WHEN "timestamp" <= lag("timestamp") OVER (PARTITION BY building_id
      ORDER BY "timestamp", row_id) + INTERVAL {6 * Q.HOUR} SECOND THEN 0 ELSE 1 END AS starts
    FROM r)) GROUP BY building_id, session""",
}

LABELS = ['Very Cold', 'Cold', 'Moderate', 'Warm', 'Hot']
EXTRA = {
    "row_compare": (
        """
rounded_rows AS (SELECT row_id, "hour", wind_speed, CAST(floor(meter_reading) AS BIGINT) AS reading FROM r),
odd AS (SELECT "hour", wind_speed, reading FROM rounded_rows WHERE row_id % 2 = 1),
few AS (SELECT "hour", wind_speed, reading FROM rounded_rows WHERE row_id % 3 = 0),
both_sides AS (SELECT "hour", wind_speed, reading, CAST(sum(l) AS BIGINT) AS l, CAST(sum(x) AS BIGINT) AS x
  FROM (SELECT *, 1 AS l, 0 AS x FROM odd UNION ALL SELECT *, 0, 1 FROM few) GROUP BY ALL)""",
        """SELECT "hour", wind_speed, reading, least(l, x) AS in_both,
  greatest(l - x, 0) AS left_only, greatest(x - l, 0) AS right_only FROM both_sides""",
    ),
    "gbt_facts": (
        f"""\nlong_all AS ({long_features('r')}),
split AS ({Q_ORACLES['stratified_split']}),
outside AS ({OUTSIDE.format('thresholds')})""",
        """SELECT s.row_id, s.anomaly, CAST(count(o.parameter) AS INTEGER) AS anomaly_count,
  0 AS n_missing, true AS sums_to_one, true AS is_likelier, true AS confidence_is_greater,
  true AS label_fits FROM split s LEFT JOIN outside o ON o.row_id = s.row_id
WHERE s.is_test GROUP BY 1, 2""",
    ),
    "ingest_rejects": (
        "\nfew AS (SELECT * FROM r WHERE row_id % 97 = 0)",
        """SELECT reasons, loaded, fields, count(*) AS row_count FROM (
  SELECT 'line does not fit the header' AS reasons, false AS loaded, 17 AS fields FROM few
  UNION ALL SELECT 'building_id: b' || building_id, false, 18 FROM few
  UNION ALL SELECT 'timestamp: missing', false, 18 FROM few
  UNION ALL SELECT 'wind_speed: calm', true, 18 FROM r WHERE row_id % 89 = 0
) GROUP BY ALL""",
    ),
    "head_types": (
        "\nhead AS (SELECT * FROM r ORDER BY row_id LIMIT 50)",
        """SELECT 'row_id' AS column_name, 'int' AS data_type, count(row_id) AS non_null FROM head
UNION ALL SELECT 'meter_reading', 'double', count(meter_reading) FROM head
UNION ALL SELECT 'primary_use', 'string', count(primary_use) FROM head""",
    ),
    "insights": (INSIGHTS, "SELECT kind, subject, round(value, 9) AS value FROM found"),
    "temperature_ranges": (
        BINNED,
        f"""SELECT CAST(g.bin AS INTEGER) AS bin, round(avg(meter_reading), 9) AS mean,
  round(stddev_samp(meter_reading), 9) AS std, count(meter_reading) AS "count",
  ({LABELS})[g.bin] AS temp_range
FROM range(1, 6) g(bin) LEFT JOIN binned b ON b.bin = g.bin GROUP BY g.bin""",
    ),
    "anomalous_parameters": (
        f"\nlong_all AS ({long_features('r')})",
        f"""SELECT row_id, building_id, parameter, round(value, 6) AS value,
  {RANGE} AS expected_range, round(mean, 6) AS mean, round(deviation, 6) AS deviation,
  {SEVERITY} AS severity FROM ({OUTSIDE.format('thresholds')})""",
    ),
    "default_thresholds": (
        f"""\nlong_all AS ({long_features('r')}),
defaults(parameter, mean, std, "min", "max", q1, q3) AS (VALUES {DEFAULTS})""",
        f"""SELECT parameter, {SEVERITY} AS severity, {RANGE} AS expected_range,
  count(*) AS row_count FROM ({OUTSIDE.format('defaults')}) GROUP BY ALL""",
    ),
    "bloom_build": (
        placed("labelled", ITEM, Q.CAPACITY, Q.ERROR_RATE), "SELECT bit FROM first_set"
    ),
    "bloom_dedup": (
        placed("labelled", ITEM, Q.CAPACITY, Q.ERROR_RATE),
        """SELECT row_id, building_id, "timestamp", meter_reading, item, is_duplicate
FROM items JOIN marked USING (row_id)""",
    ),
    "bloom_stats": (
        placed("labelled", ITEM, Q.CAPACITY, Q.ERROR_RATE),
        bloom_statistics(Q.CAPACITY, Q.ERROR_RATE),
    ),
    "anomaly_dedup_stats": (
        placed("labelled", ITEM, Q.DEMO_CAPACITY, Q.DEMO_ERROR_RATE),
        bloom_statistics(
            Q.DEMO_CAPACITY, Q.DEMO_ERROR_RATE, "," + closed_form("total_processed")
        ),
    ),
    "bloom_probe": (
        placed("labelled", ITEM, Q.CAPACITY, Q.ERROR_RATE)
        + f""",
asked AS (SELECT row_id, building_id, meter_reading,
    {md5_mod(f"{ITEM} || '_' || i", bloom_size(Q.CAPACITY, Q.ERROR_RATE)[0])} AS bit
  FROM usable, (SELECT unnest(range({bloom_size(Q.CAPACITY, Q.ERROR_RATE)[1]})) AS i))""",
        """SELECT a.row_id, a.building_id, a.meter_reading, bool_and(f.bit IS NOT NULL)
  AS maybe_present FROM asked a LEFT JOIN first_set f ON f.bit = a.bit GROUP BY 1, 2, 3""",
    ),
    "alert_dedup": (
        "\nalerts AS (SELECT * FROM judged WHERE anomaly = 1),"
        + placed("alerts", ALERT_ITEM, Q.CAPACITY, 0.01),
        f"""SELECT row_id, building_id, "timestamp", item, is_duplicate,
  count(*) FILTER (NOT is_duplicate) OVER (ORDER BY "timestamp"
    RANGE BETWEEN INTERVAL {Q.HOUR} SECOND PRECEDING AND CURRENT ROW) AS ones_in_window
FROM items JOIN marked USING (row_id)""",
    ),
}

ORACLES = {name: with_common(body) for name, body in Q_ORACLES.items()}
ORACLES.update({name: with_common(body, extra) for name, (extra, body) in EXTRA.items()})

# The tables of the full run: report, table, query, subject and numbers of each.
FULL_RUN = [
    ("weather", "correlations", "weather_correlation", "NULL",
     ["sample_size", "temperature", "wind_speed", "cloud_coverage"]),
    ("weather", "temperature_ranges", "temperature_ranges", "temp_range",
     ["bin", "mean", "std", "count"]),
    ("weather", "trend", "weather_trend", "measure",
     ["points", "slope", "intercept", "x_min", "x_max", "y_min", "y_max"]),
    ("buildings", "types", "type_performance", "primary_use",
     ["meter_reading_mean", "meter_reading_std", "meter_reading_count", "anomaly_sum",
      "square_feet_mean", "anomaly_rate", "consumption_per_sqft"]),
    ("buildings", "sizes", "size_performance", "size_category",
     ["mean", "count", "anomalies", "anomaly_rate"]),
    ("temporal", "hours", "hourly_patterns", "hour", ["mean", "count", "anomalies"]),
    ("temporal", "weekdays", "weekday_patterns", "day_name",
     ["weekday", "mean", "count", "anomalies"]),
    ("temporal", "months", "monthly_patterns", "month", ["mean", "count", "anomalies"]),
    ("anomalies", "comparison", "anomaly_comparison", "NULL",
     ["total_readings", "total_anomalies", "anomaly_rate", "anomaly_avg", "normal_avg",
      "difference", "percent_difference"]),
    ("anomalies", "types", "anomaly_by_type", "primary_use", ["anomalies", "total", "rate"]),
    ("insights", "insights", "insights", "kind", ["value"]),
]


def full_run() -> str:
    """Every number of the full run, which reads the usable readings only."""
    def over_usable(name: str) -> str:
        extra, body = EXTRA.get(name) or ("", Q_ORACLES[name])
        extra, body = (re.sub(r"\bFROM\s+r\b", "FROM usable", x) for x in (extra, body))
        return with_common(body, extra)

    numbers = [
        f"""SELECT '{report}' AS report, '{table}' AS table_name,
  CAST("{subject}" AS VARCHAR) AS subject, '{measure}' AS measure, CAST("{measure}" AS DOUBLE) AS value
FROM ({over_usable(name)})""".replace('"NULL"', "NULL")
        for report, table, name, subject, measures in FULL_RUN for measure in measures
    ]
    peaks = f"""SELECT 'temporal', 'peak_hours', CAST("hour" AS VARCHAR), 'listed', 1.0
FROM ({over_usable('hourly_patterns')}) WHERE is_peak"""
    return f"""SELECT report, table_name, subject, measure, round(value, 6) AS value
FROM ({' UNION ALL '.join([*numbers, peaks])}) WHERE value IS NOT NULL"""


ORACLES["full_analysis"] = full_run()

# Buckets after each bit of a building, newest first. The leading levels with two buckets, k of
# them, move up: the new bucket is followed by each such level's newer one at double size.
ORACLES["dgim_count"] = with_common("SELECT * FROM estimated", f"""
bits AS (SELECT building_id, "timestamp", anomaly = 1 AS one, epoch_us("timestamp") AS t,
    row_number() OVER (PARTITION BY building_id ORDER BY "timestamp", row_id) AS i FROM r),
folded AS (
  SELECT DISTINCT building_id, CAST(0 AS BIGINT) AS i,
    CAST([] AS STRUCT(t BIGINT, size BIGINT)[]) AS b FROM bits
  UNION ALL
  SELECT f.building_id, n.i, list_filter(CASE WHEN n.one THEN list_concat(
      [struct_pack(t := n.t, size := CAST(1 AS BIGINT))],
      list_transform(range(f.k), lambda j: struct_pack(
        t := f.b[2 * j + 1].t, size := 2 * f.b[2 * j + 1].size)),
      f.b[2 * f.k + 1:]) ELSE f.b END, lambda x: x.t >= n.t - {14 * Q.DAY * 1_000_000})
  FROM (SELECT *, len(list_filter(range(40), lambda j: len(b) >= 2 * j + 2
          AND b[2 * j + 2].size = CAST(1 AS BIGINT) << j)) AS k FROM folded) f
  JOIN bits n ON n.building_id = f.building_id AND n.i = f.i + 1),
ends AS (SELECT building_id, count(*) AS total_bits, max("timestamp") AS last_time FROM bits GROUP BY 1),
sizes AS (SELECT f.building_id, total_bits, last_time, list_transform(b, lambda x: x.size) AS s
  FROM folded f JOIN ends l ON l.building_id = f.building_id AND l.total_bits = f.i),
estimated AS (SELECT building_id, total_bits, last_time,
  CAST(coalesce(list_sum(s), 0) - coalesce(list_sum(list_transform(list_distinct(s),
    lambda x: x - (x >> 1))), 0) AS BIGINT) AS estimate_per_size,
  CAST(coalesce(list_sum(s), 0) - coalesce(list_max(s) - (list_max(s) >> 1), 0) AS BIGINT)
    AS estimate_classic,
  CAST(len(s) AS INTEGER) AS bucket_count, CAST(len(s) * 16 AS INTEGER) AS memory_bytes FROM sizes)""").replace("WITH ", "WITH RECURSIVE ", 1)
