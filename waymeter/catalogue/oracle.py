"""The same questions in ANSI-style SQL for DuckDB, written apart from the Spark code.

Shared steps are common table expressions, put before each statement in the order they need.
"""

from __future__ import annotations

REPORT_DAY = "DATE '2024-01-15'"
# Asia/Colombo is UTC+05:30 for all of the data.
LOCAL_SHIFT = "INTERVAL 330 MINUTE"


def _six(value: str) -> str:
    """Six digits; the nudge lifts values off the middle between two roundings."""
    return f"round({value} + 1e-9, 6) + 0.0"


def _one_decimal(value: str) -> str:
    return f"coalesce(printf('%.1f', round(round({value}, 6), 1) + 0.0), 'nan')"


def _level(value: str) -> str:
    return (f"CASE WHEN round({value}, 6) >= 70 THEN 'SEVERE' "
            f"WHEN round({value}, 6) >= 40 THEN 'MODERATE' ELSE 'LOW' END")


def _stored(value: str, digits: int) -> str:
    return f"CAST(CAST(round({value}, 6) AS DECIMAL(18, 6)) AS DECIMAL({digits}, 2))"


def _closed() -> str:
    """The watermark at the end of the input, in whole milliseconds."""
    return "date_trunc('millisecond', (SELECT max(event_time) FROM reading)) - INTERVAL 2 MINUTE"


def _padded(name: str, width: int) -> str:
    return f"rpad({name}, greatest(length({name}), {width})::INTEGER, ' ')"


READING = """
reading AS (
  SELECT event_id, event_type,
         printf('J%03d', (user_id % 8)::INTEGER + 1) AS sensor_id,
         'Junction ' || (user_id % 8 + 1) AS junction_name,
         ts AS event_time,
         CAST(props ->> '$.k' AS INTEGER) AS vehicle_count,
         round(value % 75, 2) AS avg_speed,
         round(value % 75, 2) < 10 AS is_critical
  FROM events
)"""

CW = f"""
summed AS (
  SELECT sensor_id, junction_name,
         time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
         avg(avg_speed) AS mean_speed_kmph,
         CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles
  FROM reading WHERE event_time IS NOT NULL
  GROUP BY 1, 2, 3
),
scored AS (
  SELECT *, total_vehicles / 100.0::DOUBLE * (1 - mean_speed_kmph / 60) * 100 AS congestion_index
  FROM summed
),
cw AS (
  SELECT sensor_id, junction_name, window_start,
         window_start + INTERVAL 5 MINUTE AS window_end, mean_speed_kmph, total_vehicles,
         congestion_index, {_level('congestion_index')} AS congestion_level
  FROM scored
)"""

# As the table stores them.
CS = f"""
cs AS (
  SELECT sensor_id, junction_name, window_start, window_end,
         {_stored('mean_speed_kmph', 6)} AS mean_speed_kmph, total_vehicles,
         {_stored('congestion_index', 12)} AS congestion_index, congestion_level
  FROM cw
)"""


# Batches of ten days, every twentieth reading in the last one; that batch meets the watermark of the first.
ARRIVALS = """
arrived AS (
  SELECT *, CASE WHEN event_id % 20 = 0 OR event_time >= TIMESTAMP '2024-01-21' THEN 2
                 WHEN event_time >= TIMESTAMP '2024-01-11' THEN 1 ELSE 0 END AS batch
  FROM reading
),
met AS (
  SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 2 MINUTE AS watermark FROM arrived WHERE batch = 0
),
told AS (
  SELECT arrived.*, watermark,
         batch = 2 AND coalesce(time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE <= watermark, false) AS late
  FROM arrived CROSS JOIN met
)"""


def _hr(shift: str = "INTERVAL 0 MINUTE", where: str = "true", source: str = "cw") -> str:
    return f"""
hr AS (
  SELECT sensor_id, junction_name, date_trunc('hour', window_start + {shift}) AS hour_slot,
         avg(CAST(mean_speed_kmph AS DOUBLE)) AS avg_speed,
         CAST(sum(total_vehicles) AS BIGINT) AS total_vehicles,
         avg(CAST(congestion_index AS DOUBLE)) AS avg_ci
  FROM {source} WHERE {where}
  GROUP BY 1, 2, 3
)"""


HR = _hr()
DAY_ONLY = f"CAST(window_start AS DATE) = {REPORT_DAY}"
HR_DAY = _hr(where=DAY_ONLY)

PK = """
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY CAST(hour_slot AS DATE), sensor_id
    ORDER BY total_vehicles DESC NULLS LAST, hour_slot, junction_name) AS place
  FROM hr
),
pk AS (
  SELECT CAST(hour_slot AS DATE) AS day, sensor_id, junction_name,
         CAST(hour(hour_slot) AS INTEGER) AS peak_hour, total_vehicles, avg_speed, avg_ci,
         printf('%02d:00–%02d:00', hour(hour_slot)::INTEGER, (hour(hour_slot)::INTEGER + 1) % 24)
           AS peak_hour_label
  FROM ranked WHERE place = 1
)"""

FLAGGED = f"""
flagged AS (
  SELECT *, CASE
    WHEN avg_ci >= 60 THEN 'CI=' || {_one_decimal('avg_ci')} || ' (≥60.0)'
    WHEN avg_speed < 15 THEN 'Avg speed ' || {_one_decimal('avg_speed')} || ' km/h (<15)'
  END AS reason
  FROM pk
)"""

VOLUME = f"""
volume AS (
  SELECT sensor_id, junction_name, CAST(hour_slot AS DATE) AS day,
         CAST(hour(hour_slot) AS INTEGER) AS hour,
         printf('%02d:00', hour(hour_slot)::INTEGER) AS hour_label,
         total_vehicles, avg_speed AS avg_speed_kmph, avg_ci AS congestion_index,
         {_level('avg_ci')} AS congestion_level
  FROM hr
)"""

VOLUME_PEAK = """
volume_peak AS (
  SELECT * EXCLUDE place FROM (
    SELECT *, row_number() OVER (
      PARTITION BY day, sensor_id
      ORDER BY total_vehicles DESC NULLS LAST, hour, junction_name) AS place
    FROM volume)
  WHERE place = 1
)"""

VOLUME_COLUMNS = f"""sensor_id, junction_name, day, hour, hour_label, total_vehicles,
       {_six('avg_speed_kmph')} AS avg_speed_kmph,
       {_six('congestion_index')} AS congestion_index, congestion_level"""

PEAK_COLUMNS = f"""day, sensor_id, junction_name, peak_hour, total_vehicles,
       {_six('avg_speed')} AS avg_speed, {_six('avg_ci')} AS avg_ci, peak_hour_label"""

DAILY_COLUMNS = f"""day AS report_date, sensor_id, junction_name, peak_hour, total_vehicles,
       {_stored('avg_speed', 6)} AS avg_speed, {_stored('avg_ci', 12)} AS avg_ci, peak_hour_label,
       reason IS NOT NULL AS needs_police, reason"""

HOURLY_COLUMNS = f"""sensor_id, junction_name, hour_slot, {_six('avg_speed')} AS avg_speed,
       total_vehicles, {_six('avg_ci')} AS avg_ci"""

STORED_ALERT_COLUMNS = f"""sensor_id, junction_name, vehicle_count, event_time AS alert_time,
       {_stored('avg_speed', 6)} AS avg_speed, 'CRITICAL' AS severity, false AS acknowledged"""

# Texts of one row; list positions number the lines.
PEAK_TEXTS = f"""[
    '  ' || sensor_id || ' | ' || junction_name,
    '    Peak Hour  : ' || peak_hour_label,
    '    Vehicles   : ' || total_vehicles,
    '    Avg Speed  : ' || {_one_decimal('avg_speed')} || ' km/h',
    '    Cong. Index: ' || {_one_decimal('avg_ci')}]"""

INTERVENTION_TEXTS = """[
    '  ⚠  ' || sensor_id || ' — ' || junction_name,
    '      Peak Hour : ' || peak_hour_label,
    '      Reason    : ' || reason]"""

VOLUME_PEAK_TEXTS = f"""[
    '  ' || sensor_id || ' | ' || junction_name,
    '    Peak Hour  : ' || hour_label,
    '    Vehicles   : ' || total_vehicles,
    '    Avg Speed  : ' || {_one_decimal('avg_speed_kmph')} || ' km/h',
    '    Cong. Index: ' || {_one_decimal('congestion_index')} || ' (' || congestion_level || ')']"""

INTERVENTION_SUMMARY_TEXT = f"""'  ⚠  ' || sensor_id || ' — ' || {_padded('junction_name', 26)}
       || ' (Peak CI: ' || {_one_decimal('avg_ci')} || ' — ' || {_level('avg_ci')} || ')'"""


def _alert_text(shift: str = "INTERVAL 0 MINUTE") -> str:
    return f"""'  ' || sensor_id || ' | ' || {_padded('junction_name', 14)} || ' | '
       || printf('%04.1f', round(round(avg_speed, 6), 1) + 0.0) || ' km/h | '
       || strftime(event_time + {shift}, '%H:%M') || ' | CRITICAL'"""


def _lines(source: str, texts: str) -> str:
    return f"""
SELECT day, sensor_id, CAST(i AS INTEGER) AS line_no, texts[i] AS line
FROM (SELECT day, sensor_id, {texts} AS texts FROM {source}),
     LATERAL (SELECT unnest(range(1, len(texts) + 1)) AS i)"""


def _with(*steps: str, select: str) -> str:
    return "WITH " + ",".join(step.strip("\n") for step in steps) + "\n" + select.strip("\n")


# Sound and faulty messages by kind of event, as the fields a tolerant reader gets from them.
DECODED = """
decoded AS (
  SELECT event_time AS kafka_ts,
         CASE WHEN event_type IN ('signup', 'view', 'purchase') THEN sensor_id END AS sensor_id,
         CASE WHEN event_type = 'signup' THEN junction_name END AS junction_name,
         CASE WHEN event_type IN ('signup', 'view') THEN event_time END AS event_time,
         CASE WHEN event_type IN ('signup', 'purchase') THEN vehicle_count END AS vehicle_count,
         CASE WHEN event_type = 'signup' THEN avg_speed END AS avg_speed,
         CASE WHEN event_type = 'signup' THEN is_critical END AS is_critical
  FROM reading
)"""

BAD = """
bad AS (
  SELECT CASE event_type
           WHEN 'click' THEN 'not json ' || event_id
           WHEN 'error' THEN '[{"sensor_id":"' || sensor_id || '"},{"sensor_id":"' || sensor_id || '"}]'
           ELSE '{"sensor_id":"' || sensor_id || '","timestamp":"junk ' || event_id
                || '","vehicle_count":' || vehicle_count || '}'
         END AS json_str,
         event_time AS kafka_ts,
         CASE WHEN event_type = 'purchase' THEN sensor_id END AS sensor_id,
         CASE WHEN event_type = 'purchase' THEN 'junk ' || event_id END AS "timestamp"
  FROM reading WHERE event_type IN ('click', 'error', 'purchase')
)"""


def _fixed(section: int, *texts: str, when: str = "true") -> str:
    """Fixed lines of a report section, given as SQL text expressions."""
    rows = ", ".join(f"({i}, {text})" for i, text in enumerate(texts))
    return (f"SELECT {section} AS section, CAST(NULL AS TIMESTAMP) AS \"at\", "
            f"CAST(NULL AS VARCHAR) AS sensor_id, CAST(i AS INTEGER) AS line_no, line "
            f"FROM (VALUES {rows}) AS fixed(i, line) WHERE {when}")


def _items(section: int, source: str, texts: str, at: str = "CAST(NULL AS TIMESTAMP)") -> str:
    return (f"SELECT {section} AS section, \"at\", sensor_id, CAST(i - 1 AS INTEGER) AS line_no, "
            f"texts[i] AS line FROM (SELECT {at} AS \"at\", sensor_id, {texts} AS texts FROM {source}), "
            f"LATERAL (SELECT unnest(range(1, len(texts) + 1)) AS i)")


RULE, THIN = "repeat('=', 65)", "repeat('-', 65)"

NIGHTLY_TEXT = "\nUNION ALL\n".join([
    _fixed(0, RULE, "'  TRAFFIC REPORT — 2024-01-15'", "'  Generated by: nightly traffic report'",
           RULE, "''", "'PEAK TRAFFIC HOURS PER JUNCTION'", THIN),
    _fixed(1, "'  No data available for today.'", when="NOT EXISTS (SELECT 1 FROM stored)"),
    _items(1, "stored", f"list_concat({PEAK_TEXTS}, [''])"),
    _fixed(2, "''", "'POLICE INTERVENTION RECOMMENDED TOMORROW'", THIN),
    _fixed(3, "'  ✓ No junctions require police intervention tomorrow.'",
           when="NOT EXISTS (SELECT 1 FROM stored WHERE needs_police)"),
    _items(3, "stored WHERE needs_police", f"list_concat({INTERVENTION_TEXTS}, [''])"),
    _fixed(4, RULE, "'  END OF REPORT'", RULE),
])
STORED = f"stored AS (SELECT {DAILY_COLUMNS} FROM flagged)"
NIGHTLY_STEPS = (READING, CW, HR_DAY, PK, FLAGGED, STORED)

SUMMARY_TEXT = "\nUNION ALL\n".join([
    _fixed(0, RULE, "'  TRAFFIC CONGESTION SUMMARY — 2024-01-15'", RULE, "''",
           "'PEAK HOURS (highest vehicle count per junction):'", THIN),
    _items(1, "volume_peak", f"list_concat({VOLUME_PEAK_TEXTS}, [''])"),
    _fixed(2, "'CRITICAL ALERTS (avg_speed < 10 km/h):'", THIN),
    _items(3, f"reading WHERE is_critical AND CAST(event_time AS DATE) = {REPORT_DAY}",
           f"[{_alert_text()}]", "event_time"),
    _fixed(4, "''", "'POLICE INTERVENTION REQUIRED TOMORROW:'", THIN),
    _items(5, "flagged WHERE reason IS NOT NULL", f"[{INTERVENTION_SUMMARY_TEXT}]"),
    _fixed(6, "''", RULE, "'  END OF REPORT'", RULE),
])

VOLUME_SQL = _with(READING, CW, HR, VOLUME, select=f"SELECT {VOLUME_COLUMNS} FROM volume")
STORED_ALERTS_SQL = _with(
    READING, select=f"SELECT {STORED_ALERT_COLUMNS} FROM reading WHERE is_critical"
)

ORACLE: dict[str, str] = {
    "decode_readings": _with(READING, select="""
SELECT sensor_id, junction_name, event_time, vehicle_count, avg_speed, is_critical,
       TIMESTAMP '2024-02-01 00:00:00' AS kafka_ts
FROM reading"""),
    "decode_bad_json": _with(READING, DECODED, select="SELECT * FROM decoded"),
    "bad_records": _with(READING, BAD, select="SELECT * FROM bad"),
    "encode_readings": _with(READING, select="""
SELECT sensor_id AS key, sensor_id, junction_name,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
       vehicle_count, avg_speed, is_critical
FROM reading"""),
    "critical_flag": _with(READING, select="SELECT event_id, avg_speed, is_critical FROM reading"),
    "time_of_day_factor": _with(READING, """
factored AS (
  SELECT event_id, vehicle_count, CAST(hour(event_time) AS INTEGER) AS hour,
         CAST(CASE WHEN hour(event_time) BETWEEN 7 AND 9 THEN 2.0
                   WHEN hour(event_time) BETWEEN 17 AND 19 THEN 1.8
                   WHEN hour(event_time) BETWEEN 12 AND 13 THEN 1.3
                   WHEN hour(event_time) BETWEEN 0 AND 5 THEN 0.3
                   ELSE 1.0 END AS DOUBLE) AS factor
  FROM reading
)""", select=f"""
SELECT event_id, hour, factor, {_six('vehicle_count / factor')} AS normal_count FROM factored"""),
    "critical_alerts": _with(READING, select="""
SELECT sensor_id, junction_name, avg_speed, vehicle_count, event_time AS alert_time
FROM reading WHERE avg_speed < 10"""),
    "alerts_stored": STORED_ALERTS_SQL,
    "alert_payload": _with(READING, select="""
SELECT sensor_id AS key, sensor_id, junction_name,
       strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS alert_time,
       avg_speed, vehicle_count, 'CRITICAL' AS severity
FROM reading WHERE avg_speed < 10"""),
    "alert_lines": _with(
        READING, select=f"SELECT event_id, {_alert_text()} AS line FROM reading WHERE is_critical"),
    "alert_lines_local": _with(
        READING,
        select=f"SELECT event_id, {_alert_text(LOCAL_SHIFT)} AS line FROM reading WHERE is_critical"),
    "congestion_windows": _with(READING, CW, select=f"""
SELECT sensor_id, junction_name, window_start, window_end,
       {_six('mean_speed_kmph')} AS mean_speed_kmph, total_vehicles,
       {_six('congestion_index')} AS congestion_index, congestion_level
FROM cw"""),
    "congestion_stored": _with(READING, CW, CS, select="SELECT * FROM cs"),
    "hourly_rollup": _with(
        READING, CW, HR, select=f"SELECT {HOURLY_COLUMNS} FROM hr ORDER BY sensor_id, hour_slot"),
    "hourly_rollup_local": _with(
        READING, CW, _hr(LOCAL_SHIFT),
        select=f"SELECT {HOURLY_COLUMNS} FROM hr ORDER BY sensor_id, hour_slot"),
    "hourly_rollup_day": _with(
        READING, CW, HR_DAY, select=f"SELECT {HOURLY_COLUMNS} FROM hr ORDER BY sensor_id, hour_slot"),
    "rollup_stats": _with(READING, CW, HR, PK, FLAGGED, select="""
SELECT counted.day, hourly_records, junctions, interventions
FROM (SELECT CAST(hour_slot AS DATE) AS day, count(*) AS hourly_records,
             count(DISTINCT sensor_id) AS junctions FROM hr GROUP BY 1) AS counted
JOIN (SELECT day, count(reason) AS interventions FROM flagged GROUP BY 1) AS acted
  ON counted.day = acted.day"""),
    "peak_hours": _with(READING, CW, HR, PK, select=f"SELECT {PEAK_COLUMNS} FROM pk"),
    "peak_hours_local": _with(
        READING, CW, _hr(LOCAL_SHIFT), PK, select=f"SELECT {PEAK_COLUMNS} FROM pk"),
    "interventions": _with(READING, CW, HR, PK, FLAGGED, select=f"""
SELECT {PEAK_COLUMNS}, reason FROM flagged WHERE reason IS NOT NULL"""),
    "daily_peak_report": _with(
        READING, CW, HR, PK, FLAGGED, select=f"SELECT {DAILY_COLUMNS} FROM flagged"),
    "volume_table": VOLUME_SQL,
    "peak_volume": _with(READING, CW, HR, VOLUME, VOLUME_PEAK, select=f"""
SELECT {VOLUME_COLUMNS} FROM volume_peak ORDER BY day, sensor_id"""),
    "chart_series": _with(READING, CW, HR, VOLUME, select=f"""
SELECT sensor_id || ' – ' || junction_name AS label, printf('%02d:00', axis.hour) AS hour_label,
       total_vehicles AS vehicles, {_six('avg_speed_kmph')} AS speed,
       {_six('congestion_index')} AS ci
FROM (SELECT DISTINCT day, sensor_id, junction_name FROM volume WHERE hour BETWEEN 6 AND 20)
CROSS JOIN (SELECT CAST(unnest(range(6, 21)) AS INTEGER) AS hour) AS axis
LEFT JOIN volume USING (day, sensor_id, junction_name, hour)"""),
    "peak_lines": _with(READING, CW, HR, PK, select=_lines("pk", PEAK_TEXTS)),
    "intervention_lines": _with(
        READING, CW, HR, PK, FLAGGED,
        select=_lines("flagged WHERE reason IS NOT NULL", INTERVENTION_TEXTS)),
    "intervention_summary": _with(READING, CW, HR, PK, FLAGGED, select=f"""
SELECT day, sensor_id, {INTERVENTION_SUMMARY_TEXT} AS line FROM flagged WHERE reason IS NOT NULL"""),
    "nightly_text_report": _with(*NIGHTLY_STEPS, select=f"""
SELECT section, sensor_id, line_no, line FROM ({NIGHTLY_TEXT})"""),
    "summary_text_report": _with(
        READING, CW, HR_DAY, PK, FLAGGED, VOLUME, VOLUME_PEAK, select=SUMMARY_TEXT),
    "csv_roundtrip": VOLUME_SQL,
    "text_roundtrip": _with(READING, CW, HR, PK, select=f"""
SELECT line, count(*) AS copies FROM ({_lines('pk', PEAK_TEXTS)}) GROUP BY line"""),
    "nightly_tables": _with(
        READING, CW, CS,
        _hr(LOCAL_SHIFT, f"CAST(window_start + {LOCAL_SHIFT} AS DATE) = {REPORT_DAY}", "cs"),
        PK, FLAGGED, select=f"SELECT {DAILY_COLUMNS} FROM flagged"),
    # The watermark ends two minutes before the latest event; later windows are still open.
    "stream_congestion": _with(READING, CW, CS, select="""
SELECT * FROM cs
WHERE window_end <= date_trunc('millisecond', (SELECT max(event_time) FROM reading))
                    - INTERVAL 2 MINUTE"""),
    "stream_live": _with(READING, CW, CS, select="SELECT * FROM cs"),
    "backfill_after_stream": _with(READING, CW, CS, select="SELECT * FROM cs"),
    "stream_open": _with(READING, CW, CS, select="SELECT * FROM cs"),
    "batch_counts": _with(READING, CW, CS, select=f"""
SELECT 'congestion' AS query, 'congestion_rows' AS metric, count(*) AS rows FROM cs WHERE window_end <= {_closed()}
UNION ALL SELECT 'critical', 'alert_rows', count(*) FROM reading WHERE avg_speed < 10"""),
    "backfill_messages": _with(READING, CW, CS, select=f"""
SELECT * FROM cs WHERE window_end <= {_closed()} OR window_start >= DATE '2024-01-29'"""),
    "stream_late": _with(READING, ARRIVALS, select="""
SELECT sensor_id, junction_name, event_time, vehicle_count, avg_speed, is_critical, watermark FROM told WHERE late"""),
    "stream_parts": _with(READING.replace("reading AS (", "every AS (", 1), ARRIVALS.replace("FROM reading", "FROM every", 1), """
reading AS (SELECT * FROM told WHERE NOT late)""", CW, CS, select="SELECT * FROM cs"),
    "late_balance": _with(READING, ARRIVALS, select="""
SELECT sensor_id, count(*) FILTER (NOT late) AS counted, count(*) FILTER (late) AS late, count(*) AS readings,
       coalesce(sum(vehicle_count) FILTER (NOT late), 0)::BIGINT AS counted_vehicles,
       coalesce(sum(vehicle_count) FILTER (late), 0)::BIGINT AS late_vehicles, sum(vehicle_count)::BIGINT AS vehicles
FROM told GROUP BY sensor_id"""),
    "late_amended": _with(READING, CW, CS, select="SELECT * FROM cs"),
    # An hour or a day is out when its last instant is behind the watermark.
    "stream_hourly": _with(READING, CW, HR, select=f"""
SELECT {HOURLY_COLUMNS} FROM hr WHERE hour_slot + INTERVAL 1 HOUR <= {_closed()}"""),
    "stream_hourly_local": _with(READING, CW, _hr(LOCAL_SHIFT), select=f"""
SELECT {HOURLY_COLUMNS} FROM hr WHERE hour_slot + INTERVAL 1 HOUR <= {_closed()} + {LOCAL_SHIFT}"""),
    "report_from_hours": _with(READING, CW, _hr(where=f"date_trunc('hour', window_start) + INTERVAL 1 HOUR <= {_closed()}"), PK, FLAGGED,
                               select=f"SELECT {DAILY_COLUMNS} FROM flagged"),
    "stream_daily_peaks": _with(READING, CW, _hr(LOCAL_SHIFT), PK, FLAGGED, select=f"""
SELECT {DAILY_COLUMNS} FROM flagged WHERE day + INTERVAL 1 DAY <= {_closed()} + {LOCAL_SHIFT}"""),
    "stream_alerts": STORED_ALERTS_SQL,
    "replay_decode": _with(READING, DECODED, select=f"""
SELECT sensor_id, junction_name, event_time, vehicle_count, avg_speed,
       coalesce(is_critical, false) AS is_critical, CAST(event_time AS DATE) AS event_date
FROM decoded WHERE sensor_id IS NOT NULL AND event_time IS NOT NULL"""),
    "replay_quarantine": _with(
        READING, BAD, select="SELECT json_str, sensor_id, \"timestamp\" FROM bad"),
}
