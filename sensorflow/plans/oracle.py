"""DuckDB SQL for the oracle check: the same fixture mapping and query as the
Spark side, written independently in plain SQL over the registered views.
"""

from __future__ import annotations

# Fixture CTEs (FIXTURES.md §3.1, §3.2).
READINGS_CTE = """
readings AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS room,
    CASE event_type WHEN 'view' THEN 'co2' WHEN 'click' THEN 'light'
      WHEN 'signup' THEN 'temperature' WHEN 'purchase' THEN 'humidity'
      WHEN 'error' THEN 'pir' END AS sensor,
    CAST(floor(epoch(ts) / 172800) AS BIGINT) * 172800 AS ts_min_bignt,
    CASE WHEN event_type = 'error' AND value <= 25 THEN CAST(0.0 AS DOUBLE) ELSE value END
      AS sensor_value
  FROM events)"""

RAW_CTE = READINGS_CTE + """,
raw_readings AS (
  SELECT event_id, room, sensor,
    CASE WHEN event_id % 67 = 0 THEN '253402300800'
         WHEN event_id % 61 = 0 THEN ' -9223372036854775808 '
         WHEN event_id % 59 = 0 THEN '9223372036854775807'
         ELSE ' ' || CAST(ts_min_bignt AS VARCHAR) || ' ' END AS ts_raw,
    CASE WHEN event_id % 23 = 0 THEN 'bad'
         WHEN event_id % 17 = 0 THEN NULL
         WHEN event_id % 53 = 0 THEN '-inf'
         WHEN event_id % 47 = 0 THEN '1e30'
         WHEN event_id % 43 = 0 THEN ' Infinity'
         WHEN event_id % 41 = 0 THEN 'NaN'
         ELSE ' ' || CAST(sensor_value AS VARCHAR) END AS value_raw
  FROM readings),
typed AS (
  SELECT event_id, room, sensor,
    TRY_CAST(trim(ts_raw) AS BIGINT) AS seconds,
    TRY_CAST(trim(value_raw) AS DOUBLE) AS reading
  FROM raw_readings),
clean AS (
  SELECT event_id, room, sensor,
    CASE WHEN seconds >= epoch(TIMESTAMP '0001-01-01') AND seconds < epoch(TIMESTAMP '10000-01-01')
      THEN seconds END AS ts_min_bignt,
    CASE WHEN isfinite(reading) AND reading > -1e12 AND reading < 1e12 THEN reading END
      AS sensor_value
  FROM typed)"""


def text_time(col: str) -> str:
    return f"strftime(make_timestamp(CAST({col} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


def wide_select(src: str, rounded: bool = True) -> str:
    """SQL for the five-way inner join over long readings in ``src``."""
    def r(x):
        return f"round({x}, 6)" if rounded else x
    return f"""
SELECT {text_time('c.ts_min_bignt')} AS event_ts_min, c.ts_min_bignt, c.room,
  {r('c.co2')} AS co2, {r('l.light')} AS light, {r('t.temp')} AS temp,
  {r('h.humidity')} AS humidity, {r('p.pir')} AS pir
FROM (SELECT room, ts_min_bignt, sensor_value AS co2 FROM {src} WHERE sensor = 'co2') c
JOIN (SELECT room, ts_min_bignt, sensor_value AS humidity FROM {src} WHERE sensor = 'humidity') h
  USING (room, ts_min_bignt)
JOIN (SELECT room, ts_min_bignt, sensor_value AS light FROM {src} WHERE sensor = 'light') l
  USING (room, ts_min_bignt)
JOIN (SELECT room, ts_min_bignt, sensor_value AS pir FROM {src} WHERE sensor = 'pir') p
  USING (room, ts_min_bignt)
JOIN (SELECT room, ts_min_bignt, sensor_value AS temp FROM {src} WHERE sensor = 'temperature') t
  USING (room, ts_min_bignt)"""


COMPLETE = ("co2 IS NOT NULL AND light IS NOT NULL AND temp IS NOT NULL "
            "AND humidity IS NOT NULL AND pir IS NOT NULL AND isfinite(co2) AND isfinite(light) "
            "AND isfinite(temp) AND isfinite(humidity) AND isfinite(pir)")


def wide_cte(src: str = "readings", rounded: bool = True, complete: bool = True,
             name: str = "wide") -> str:
    body = wide_select(src, rounded)
    if complete:
        body = f"SELECT * FROM ({body}) j WHERE {COMPLETE}"
    return f"{name} AS ({body})"
