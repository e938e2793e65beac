"""Registered queries: each maps (spark, sf_dir) -> DataFrame over the test
tables, with the DuckDB SQL that must give the same rows (or ``None`` where
only the row count can be compared).

Every query reads whole tables; nothing is capped or sampled except where the
cap is the feature (the preview).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions import payload as PL
from sensorflow.functions.cleaning import clean_readings
from sensorflow.functions.features import movement_flag, movement_label, search_document, \
    with_movement
from sensorflow.functions.time import epoch_to_timestamp, text_to_epoch_ms
from sensorflow.operators import analytics as A
from sensorflow.operators import quality as Q
from sensorflow.operators.model import LinearModel, accuracy, score, with_label
from sensorflow.operators.wide import union_frames, wide_readings
from sensorflow.plans import oracle as O
from sensorflow.plans.publish import publish_frame
from sensorflow.plans.views import register_views
from sensorflow.schema import PREDICTION_FIELDS
from sensorflow.sources import events as ev

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the registered queries.
FIXED_MODEL = LinearModel(intercept=0.3, weights=(0.004, -0.003, 0.002, -0.005))
FIXED_NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
FILTER_FROM = dt.datetime(2024, 1, 9, tzinfo=dt.timezone.utc)
FILTER_TO = dt.datetime(2024, 1, 21, tzinfo=dt.timezone.utc)
WINDOW_SECONDS = 4 * 86400
HOLDOUT_FROM = dt.datetime(2024, 1, 23, tzinfo=dt.timezone.utc)
WATERMARK_SECONDS = 2 * 86400


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---- shared inputs --------------------------------------------------------

def _readings(spark, sf_dir, by_type=False):
    return ev.readings(spark, sf_dir, by_type)


def _clean(spark, sf_dir, keep_raw=False, by_type=False):
    return clean_readings(ev.raw_readings(spark, sf_dir, by_type), keep_raw=keep_raw)


# The join inputs are read per event type, so each join side's scan filters
# on its type; queries over all readings read them in one pass.

def _wide(spark, sf_dir, **kw):
    by_type = kw.get("how", "join") == "join"
    return wide_readings(_readings(spark, sf_dir, by_type), **kw)


def _wide_v2(spark, sf_dir):
    """Version-2 wide rows from raw text: no rounding, incomplete rows kept."""
    return wide_readings(_clean(spark, sf_dir, by_type=True), round_digits=None,
                         drop_incomplete=False)


def _scored(spark, sf_dir):
    return score(with_label(_wide(spark, sf_dir)), FIXED_MODEL)


def _avg(column: str) -> str:
    """The mean to six places, half away from zero, in whole millionths."""
    whole = f"CAST(sum(CAST({column} AS DECIMAL(28,6))) * 1000000 AS HUGEINT)"
    mean = f"(2 * abs({whole}) + count({column})) // (2 * count({column}))"
    return f"CAST(sign({whole}) * {mean} AS DOUBLE) / 1e6::DOUBLE"


WIDE = f"WITH {O.READINGS_CTE}, {O.wide_cte()}"
WIDE_V2 = f"WITH {O.RAW_CTE}, {O.wide_cte('clean', rounded=False, complete=False, name='wide2')}"
_MARGIN = " + ".join([repr(FIXED_MODEL.intercept)] +
                     [f"({w!r}) * {c}" for c, w in zip(FIXED_MODEL.features, FIXED_MODEL.weights)])
SCORED = WIDE + f""",
scored AS (
  SELECT *, CASE WHEN pir > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
    1.0 / (1.0 + exp(-({_MARGIN}))) AS probability
  FROM wide),
pred AS (
  SELECT *, CASE WHEN probability > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM scored)"""
FLAG = "CASE WHEN {p} > 0 THEN 'movement' ELSE 'no_movement' END"


def _sql_text(col):
    return O.text_time(col)


# ---- J1 / J2: the wide reading ------------------------------------------

@register("wide_join", f"{WIDE} SELECT * FROM wide")
def q_wide_join(spark, sf_dir):
    """Five-way inner join, version-1 output."""
    return _wide(spark, sf_dir)


@register("wide_using", f"{WIDE_V2} SELECT * FROM wide2")
def q_wide_using(spark, sf_dir):
    """Version-2 output (no rounding, no completeness filter) from raw text."""
    return _wide_v2(spark, sf_dir)


@register("wide_raw", f"WITH {O.RAW_CTE}, {O.wide_cte('clean')} SELECT * FROM wide")
def q_wide_raw(spark, sf_dir):
    """P1, P3, J1, F1 on text with spaces, nulls and bad numbers."""
    return wide_readings(_clean(spark, sf_dir, by_type=True))


@register("wide_latest", f"""WITH {O.READINGS_CTE},
latest AS (SELECT room, sensor, ts_min_bignt, arg_max(sensor_value, event_id) AS sensor_value
           FROM readings GROUP BY room, sensor, ts_min_bignt),
{O.wide_cte('latest')} SELECT * FROM wide""")
def q_wide_latest(spark, sf_dir):
    """Q4 keep-latest + conditional aggregate: one shuffle, skew-safe."""
    return _wide(spark, sf_dir, how="latest", order_col="event_id")


@register("wide_salted", f"{WIDE} SELECT * FROM wide")
def q_wide_salted(spark, sf_dir):
    """J1 with hot (room, instant) keys spread over salt buckets; the threshold
    is low, so that most keys of the test tables really get split."""
    return _wide(spark, sf_dir, row_id="event_id", hot_key_rows=2)


# ---- P1-P3, P5-P7: cleaning and time ------------------------------------

@register("clean_readings", f"WITH {O.RAW_CTE} SELECT * FROM clean")
def q_clean_readings(spark, sf_dir):
    return _clean(spark, sf_dir)


@register("time_columns", f"""{WIDE}
SELECT ts_min_bignt, event_ts_min, ts_min_bignt * 1000 AS event_ms,
  ts_min_bignt * 1000 AS parsed_ms, CAST(1706745600000 AS BIGINT) AS bad_text_ms FROM wide""")
def q_time_columns(spark, sf_dir):
    """P5 text, P6 timestamp (as epoch ms), P7 parse with a fixed fallback."""
    w = _wide(spark, sf_dir)
    return w.select(
        "ts_min_bignt", "event_ts_min",
        F.unix_millis(epoch_to_timestamp("ts_min_bignt")).alias("event_ms"),
        text_to_epoch_ms("event_ts_min", FIXED_NOW).alias("parsed_ms"),
        text_to_epoch_ms(F.concat(F.lit("x"), F.col("event_ts_min")), FIXED_NOW)
        .alias("bad_text_ms"))


# ---- payloads -----------------------------------------------------------

_CSV_VALUE = ("concat_ws(',', {p}event_ts_min, CAST({p}ts_min_bignt AS VARCHAR), {p}room, "
              "CAST({p}co2 AS VARCHAR), CAST({p}light AS VARCHAR), CAST({p}temp AS VARCHAR), "
              "CAST({p}humidity AS VARCHAR), CAST({p}pir AS VARCHAR))")


@register("csv_messages", f"""{WIDE}
SELECT room || '-' || CAST(ts_min_bignt AS VARCHAR) AS key, {_CSV_VALUE.format(p='')} AS value
FROM wide""")
def q_csv_messages(spark, sf_dir):
    """P17, P18, P9, K4 payload: key and delimited value."""
    return PL.to_messages(_wide(spark, sf_dir))


@register("index_documents", f"""{WIDE_V2}
SELECT ts_min_bignt * 1000 AS event_ts_min, coalesce(co2, 0.0) AS co2,
  coalesce(humidity, 0.0) AS humidity, coalesce(light, 0.0) AS light,
  coalesce(temp, 0.0) AS temperature, room, coalesce(pir, 0.0) AS pir,
  {FLAG.format(p='pir')} AS if_movement
FROM wide2""")
def q_index_documents(spark, sf_dir):
    """Index stream in batch form: delimited payload -> P13 parse -> P7 ->
    P19 flag -> P14 document (nulls -> 0.0)."""
    msgs = PL.to_messages(_wide_v2(spark, sf_dir), with_key=False)
    parsed = PL.time_to_epoch_ms(PL.parse_payload(msgs, "csv"), FIXED_NOW)
    return search_document(with_movement(parsed))


@register("json_fields", f"{WIDE_V2} SELECT * FROM wide2")
def q_json_fields(spark, sf_dir):
    """P16 build + P15 parse: JSON text is not compared, parsed fields are."""
    msgs = PL.to_messages(_wide_v2(spark, sf_dir), "json", with_key=False)
    return PL.parse_payload(msgs, "json")


@register("payload_drift", f"""{WIDE_V2}
SELECT room, ts_min_bignt, light, CASE WHEN ts_min_bignt % 345600 = 0 THEN NULL ELSE co2 END AS co2,
  CASE WHEN ts_min_bignt % 345600 = 0 AND co2 IS NOT NULL THEN co2 END AS late_co2,
  'fw-' || room AS firmware, CAST(length(room) AS BIGINT) AS battery,
  CAST(CASE WHEN ts_min_bignt % 345600 = 0 AND co2 IS NOT NULL THEN 3 ELSE 2 END AS INTEGER) AS n_extra
FROM wide2""")
def q_payload_drift(spark, sf_dir):
    """P15, Q3 on payloads that drift: two new fields, one nested, and co2 as text
    in every second instant; all are kept as VARIANT, stored, and read back."""
    from sensorflow.session import scratch_path
    moved = F.col("ts_min_bignt") % 345600 == 0
    wide = _wide_v2(spark, sf_dir).withColumns({
        "text_co2": F.when(moved, F.col("co2").cast("string")),
        "number_co2": F.when(~moved, F.col("co2"))})
    cols = [c for c in wide.columns if c not in ("co2", "text_co2", "number_co2")]
    device = [F.concat(F.lit("fw-"), "room").alias("firmware"),
              F.struct(F.length("room").alias("level")).alias("battery")]
    with_co2 = F.when(moved, F.to_json(F.struct(*cols, F.col("text_co2").alias("co2"), *device))) \
        .otherwise(F.to_json(F.struct(*cols, F.col("number_co2").alias("co2"), *device)))
    path = scratch_path(spark, "payload-drift")
    PL.parse_json_open(wide.select(with_co2.alias("value"))).write.parquet(path)
    out = spark.read.parquet(path)
    return out.select(
        "room", "ts_min_bignt", "light", "co2",
        F.try_variant_get(F.col("extra")["co2"], "$", "double").alias("late_co2"),
        F.variant_get(F.col("extra")["firmware"], "$", "string").alias("firmware"),
        F.variant_get(F.col("extra")["battery"], "$.level", "bigint").alias("battery"),
        F.size("extra").alias("n_extra"))


@register("payload_quarantine", f"""{WIDE_V2}
SELECT * FROM (
  SELECT room, ts_min_bignt,
    nullif(concat_ws(',', CASE WHEN co2 IS NULL THEN 'co2' END,
      CASE WHEN light IS NULL THEN 'light' END, CASE WHEN temp IS NULL THEN 'temp' END,
      CASE WHEN humidity IS NULL THEN 'humidity' END, CASE WHEN pir IS NULL THEN 'pir' END), '')
      AS reason
  FROM wide2) q WHERE reason IS NOT NULL""")
def q_payload_quarantine(spark, sf_dir):
    """Q3: parsed messages with a missing or unparsable field, with reason."""
    msgs = PL.to_messages(_wide_v2(spark, sf_dir), with_key=False)
    _, bad = PL.quarantine(PL.parse_payload(msgs, "csv"))
    return bad.select("room", "ts_min_bignt", "reason")


@register("movement_flags", f"""{WIDE_V2}
SELECT room, ts_min_bignt, pir, {FLAG.format(p='pir')} AS if_movement,
  CASE WHEN pir > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM wide2""")
def q_movement_flags(spark, sf_dir):
    """P19, P20 with null motion readings (null -> no movement, 0.0)."""
    return _wide_v2(spark, sf_dir).select(
        "room", "ts_min_bignt", "pir", movement_flag("pir").alias("if_movement"),
        movement_label("pir").alias("label"))


@register("publish_messages", f"""{WIDE}
SELECT room AS key, concat_ws(';', event_ts_min, CAST(ts_min_bignt AS VARCHAR), room,
  CAST(co2 AS VARCHAR), CAST(light AS VARCHAR), CAST(temp AS VARCHAR),
  CAST(humidity AS VARCHAR)) AS value
FROM wide, (SELECT unnest(range(1, 3)) AS replay) r""")
def q_publish_messages(spark, sf_dir):
    """Exclude columns (absent names ignored), key column, separator,
    repeat twice (U2), repeatable shuffle (O3)."""
    return publish_frame(_wide(spark, sf_dir), sep=";", exclude=("pir", "not_a_column"),
                         key_col="room", repeat=2, shuffle_seed=7)


# ---- model: closed form with fixed coefficients --------------------------

@register("scored", f"""{SCORED}
SELECT event_ts_min, ts_min_bignt, room, co2, light, temp, humidity, label, prediction,
  round(probability, 6) AS confidence FROM pred""")
def q_scored(spark, sf_dir):
    """Probability of movement and predicted class."""
    s = _scored(spark, sf_dir)
    return s.select("event_ts_min", "ts_min_bignt", "room", "co2", "light", "temp", "humidity",
                    "label", "prediction", F.round("confidence", 6).alias("confidence"))


@register("accuracy", f"""{SCORED}
SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
  round(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS accuracy_pct
FROM pred""")
def q_accuracy(spark, sf_dir):
    """In-sample accuracy."""
    a = accuracy(_scored(spark, sf_dir))
    return a.withColumn("accuracy_pct", F.round("accuracy_pct", 6))


@register("class_counts", f"""{SCORED}
SELECT prediction, CAST(count(*) AS BIGINT) AS n FROM pred GROUP BY prediction""")
def q_class_counts(spark, sf_dir):
    """A3."""
    return A.class_counts(_scored(spark, sf_dir))


_PREDICTED = "room, ts_min_bignt, label, prediction, round(probability, 6) AS confidence FROM pred"


def _predicted(scored):
    return scored.select("room", "ts_min_bignt", "label", "prediction",
                         F.round("confidence", 6).alias("confidence"))


@register("class_rows", f"{SCORED} SELECT {_PREDICTED} WHERE prediction = 1.0")
def q_class_rows(spark, sf_dir):
    """rows predicted as movement."""
    return _predicted(A.by_class(_scored(spark, sf_dir), 1.0))


@register("correct_rows", f"{SCORED} SELECT {_PREDICTED} WHERE prediction = label")
def q_correct_rows(spark, sf_dir):
    """rows whose prediction equals the label."""
    return _predicted(A.correct_predictions(_scored(spark, sf_dir)))


@register("fit_and_score", f"""{WIDE_V2},
w AS (SELECT *, co2 IS NOT NULL AND light IS NOT NULL AND temp IS NOT NULL
             AND humidity IS NOT NULL AS usable FROM wide2)
SELECT CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE NOT usable) AS BIGINT) AS n_skipped,
  CAST(count(*) FILTER (WHERE usable AND pir > 0) AS BIGINT) AS n_movement,
  CAST(count(*) FILTER (WHERE usable) AS BIGINT) AS n_scored,
  CAST(count(*) FILTER (WHERE usable) AS BIGINT) AS n_agree FROM w""")
def q_fit_and_score(spark, sf_dir):
    """Fit on the stored wide rows, save, load, score. Compared
    are the numbers that don't depend on the coefficients: rows, skipped rows,
    movement labels, scored rows, and rows on which the loaded model's
    ``transform`` and its closed form agree."""
    from sensorflow.operators import model as M
    from sensorflow.session import scratch_path
    path = scratch_path(spark, "fit-and-score")
    _wide_v2(spark, sf_dir).write.parquet(f"{path}/wide")
    wide = spark.read.parquet(f"{path}/wide")
    report = M.fit(wide)
    M.save(report.model, f"{path}/model")
    model = M.load(f"{path}/model")
    both = M.score(M.score(wide, model, method="transform")
                   .withColumnRenamed("confidence", "by_transform")
                   .drop("probability", "prediction"), model)
    agree = F.abs(F.col("by_transform") - F.col("confidence")) < 1e-9
    return both.agg(F.lit(report.rows).cast("bigint").alias("n_rows"),
                    F.lit(report.skipped_rows).cast("bigint").alias("n_skipped"),
                    F.lit(report.positives).cast("bigint").alias("n_movement"),
                    F.count(F.lit(1)).alias("n_scored"),
                    F.count(F.when(agree, F.lit(1))).alias("n_agree"))


@register("routed_predictions", f"""{SCORED}
SELECT CASE WHEN prediction = 1.0 THEN 'activity' ELSE 'no_activity' END AS route,
  event_ts_min, room, co2, light, temp, humidity, prediction,
  round(probability, 6) AS confidence FROM pred""")
def q_routed_predictions(spark, sf_dir):
    """K5 batch form: prediction message fields (P9, P10) with their route."""
    from sensorflow.streaming.routing import with_route
    s = with_route(_scored(spark, sf_dir))
    return s.select("route", *[F.round(c, 6).alias(c) if c == "confidence" else F.col(c)
                               for c in PREDICTION_FIELDS])


@register("windowed_accuracy", f"""{SCORED}
SELECT CAST(floor(ts_min_bignt / {WINDOW_SECONDS}) * {WINDOW_SECONDS} AS BIGINT) AS window_start,
  CAST(count(*) AS BIGINT) AS total,
  CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
  round(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS accuracy_pct
FROM pred GROUP BY 1""")
def q_windowed_accuracy(spark, sf_dir):
    """A9 batch form."""
    return A.windowed_accuracy(_scored(spark, sf_dir), WINDOW_SECONDS)


# ---- analytics ----------------------------------------------------------

@register("motion_distribution", f"""{WIDE},
c AS (SELECT {FLAG.format(p='pir')} AS if_movement, CAST(count(*) AS BIGINT) AS n
      FROM wide GROUP BY 1)
SELECT if_movement, n, round(n / sum(n) OVER (), 6) AS share FROM c""")
def q_motion_distribution(spark, sf_dir):
    """A5."""
    return A.motion_distribution(with_movement(_wide(spark, sf_dir)))


@register("sensor_hourly", f"""WITH {O.READINGS_CTE}
SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, sensor,
  CAST(count(*) AS BIGINT) AS n, {_avg('sensor_value')} AS avg_value,
  min(sensor_value) AS min_value, max(sensor_value) AS max_value
FROM readings GROUP BY 1, 2""")
def q_sensor_hourly(spark, sf_dir):
    """A6 on long readings: hourly event-time windows per sensor."""
    return A.sensor_windows(_readings(spark, sf_dir), "1 hour")


@register("env_windows", f"""{WIDE}
SELECT CAST(floor(ts_min_bignt / {WINDOW_SECONDS}) * {WINDOW_SECONDS} AS BIGINT) AS window_start,
  {_sql_text(f'floor(ts_min_bignt / {WINDOW_SECONDS}) * {WINDOW_SECONDS}')} AS window_start_text,
  CAST(count(*) AS BIGINT) AS n,
  {_avg('co2')} AS avg_co2, min(co2) AS min_co2, max(co2) AS max_co2,
  {_avg('temp')} AS avg_temp, min(temp) AS min_temp, max(temp) AS max_temp,
  {_avg('humidity')} AS avg_humidity, min(humidity) AS min_humidity,
  max(humidity) AS max_humidity
FROM wide GROUP BY 1, 2""")
def q_env_windows(spark, sf_dir):
    """A6 on wide rows: 4-day tumbling windows."""
    return A.env_windows(_wide(spark, sf_dir), WINDOW_SECONDS)


@register("room_stats", f"""{WIDE}
SELECT room, CAST(count(*) AS BIGINT) AS n, {_avg('co2')} AS avg_co2,
  {_avg('light')} AS avg_light, {_avg('temp')} AS avg_temp,
  {_avg('humidity')} AS avg_humidity,
  round(avg(CASE WHEN pir > 0 THEN 1.0 ELSE 0.0 END), 6) AS movement_rate
FROM wide GROUP BY room""")
def q_room_stats(spark, sf_dir):
    """A7."""
    return A.room_stats(_wide(spark, sf_dir))


@register("movement_by_hour", f"""WITH {O.READINGS_CTE}
SELECT room, CAST(hour(ts) AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(CASE WHEN sensor_value > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_movement,
  round(avg(CASE WHEN sensor_value > 0 THEN 1.0 ELSE 0.0 END), 6) AS movement_rate
FROM readings WHERE sensor = 'pir' GROUP BY 1, 2""")
def q_movement_by_hour(spark, sf_dir):
    """Motion readings by room and hour of day."""
    r = _readings(spark, sf_dir)
    return A.movement_by_hour(r.filter(F.col("sensor") == "pir"))


@register("movement_episodes", f"""WITH {O.READINGS_CTE},
m AS (SELECT room, ts, event_id, sensor_value > 0 AS moving FROM readings WHERE sensor = 'pir'),
d AS (SELECT *, lag(moving) OVER w AS before, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS pause
      FROM m WINDOW w AS (PARTITION BY room ORDER BY ts, event_id)),
r AS (SELECT *, sum(CASE WHEN moving AND (before IS NULL OR NOT before OR pause > 864000000000)
        THEN 1 ELSE 0 END) OVER (PARTITION BY room ORDER BY ts, event_id) AS run FROM d)
SELECT room, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us,
  CAST(count(*) AS BIGINT) AS n_readings
FROM r WHERE moving GROUP BY room, run""")
def q_movement_episodes(spark, sf_dir):
    """Runs of movement per room, ended by a still reading or ten days' pause."""
    from sensorflow.operators.ordered import movement_episodes
    pir = _readings(spark, sf_dir).filter(F.col("sensor") == "pir")
    found = movement_episodes(pir, max_gap_seconds=10 * 86400)

    def micros(c):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(c))
    return found.select("room", micros("episode_start").alias("start_us"),
                        micros("episode_end").alias("end_us"), "n_readings")


@register("cadence_gaps", f"""WITH {O.READINGS_CTE},
i AS (SELECT DISTINCT room, sensor, ts_min_bignt AS t FROM readings),
d AS (SELECT room, sensor, t AS gap_after, lead(t) OVER (PARTITION BY room, sensor ORDER BY t) AS gap_before
      FROM i),
c AS (SELECT sensor, gap_before - gap_after AS apart, count(*) AS n FROM d
      WHERE gap_before IS NOT NULL GROUP BY 1, 2),
s AS (SELECT sensor, apart AS step FROM c
      QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY n DESC, apart) = 1)
SELECT room, sensor, gap_after, gap_before, step,
  CAST(ceil((gap_before - gap_after) / step) - 1 AS BIGINT) AS n_missing
FROM d JOIN s USING (sensor) WHERE gap_before - gap_after > step""")
def q_cadence_gaps(spark, sf_dir):
    """Q1, Q2: silent spans per room and sensor against the sensor's usual step."""
    from sensorflow.operators.ordered import cadence_gaps
    return cadence_gaps(_readings(spark, sf_dir))


@register("rank_accuracy", f"""{SCORED},
h AS (SELECT round(probability, 2) AS s, label FROM pred WHERE ts_min_bignt >= {int(HOLDOUT_FROM.timestamp())}),
r AS (SELECT label, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS place FROM h),
t AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n,
        sum(place) FILTER (WHERE label = 1) AS places FROM r)
SELECT CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives,
  round((places - p * (p + 1) / 2.0) / (p * n), 9) AS auc FROM t""")
def q_rank_accuracy(spark, sf_dir):
    """M3 without a threshold: area under the ROC curve of the held-out rows, with
    ties, from counts per score."""
    from sensorflow.operators.model import time_split
    from sensorflow.operators.ordered import rank_accuracy
    _, test = time_split(with_label(_wide(spark, sf_dir)), int(HOLDOUT_FROM.timestamp()))
    scored = score(test, FIXED_MODEL).withColumn("confidence", F.round("confidence", 2))
    return rank_accuracy(scored).withColumn("auc", F.round("auc", 9))


@register("calibration", f"""{SCORED}
SELECT CAST(least(floor(probability * 10), 9) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(label) AS BIGINT) AS n_positive, round(sum(label) / count(*), 6) AS rate
FROM pred GROUP BY 1""")
def q_calibration(spark, sf_dir):
    """M3: observed rate of movement per tenth of the predicted probability."""
    from sensorflow.operators.ordered import calibration
    return calibration(_scored(spark, sf_dir))


ROLLUP_FROM, ROLLUP_TO = 1704250800, 1706032800  # 2024-01-03 03:00 to 2024-01-23 18:00


@register("rollup_range", f"""WITH {O.READINGS_CTE}
SELECT room, sensor, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(sensor_value) AS BIGINT) AS n,
  {_avg('sensor_value')} AS avg_value, min(sensor_value) AS min_value, max(sensor_value) AS max_value
FROM readings WHERE epoch(ts) >= {ROLLUP_FROM} AND epoch(ts) < {ROLLUP_TO} GROUP BY 1, 2""")
def q_rollup_range(spark, sf_dir):
    """A6, A7 from partial aggregates: readings arrive as a stream in several
    batches, then a range with ragged ends is answered from days and hours."""
    from sensorflow.functions.time import epoch_seconds_of_ntz
    from sensorflow.operators.rollup import Rollup
    from sensorflow.session import scratch_path
    from sensorflow.streaming.sinks import run_available, start
    base = scratch_path(spark, "rollup")
    long = _readings(spark, sf_dir).select(
        "room", "sensor", F.floor(epoch_seconds_of_ntz("ts")).cast("bigint").alias("ts_min_bignt"), "sensor_value")
    for half in (0, 1):  # deliveries that overlap in time
        long.filter(F.pmod(F.xxhash64("room", "ts_min_bignt"), F.lit(2)) == half).repartition(2) \
            .write.mode("append").parquet(f"{base}/inbox")
    source = spark.readStream.schema(long.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/inbox")
    rollup = Rollup(f"{base}/rollup")
    run_available(start(source, rollup, f"{base}/checkpoint", trigger={"availableNow": True}))
    return rollup.statistics(spark, ROLLUP_FROM, ROLLUP_TO, quantiles=())


@register("stage_counts", f"""WITH {O.RAW_CTE}, {O.wide_cte()}
SELECT 'readings' AS stage, CAST(count(*) AS BIGINT) AS n FROM readings
UNION ALL SELECT 'parsed', CAST(count(*) AS BIGINT) FROM clean
  WHERE ts_min_bignt IS NOT NULL AND sensor_value IS NOT NULL
UNION ALL SELECT 'wide', CAST(count(*) AS BIGINT) FROM wide""")
def q_stage_counts(spark, sf_dir):
    """A1: rows read, parsed and merged; read and parsed in one pass."""
    c = _clean(spark, sf_dir)
    parsed_ok = (F.col("ts_min_bignt").isNotNull() & F.col("sensor_value").isNotNull())
    counts = c.agg(F.count(F.lit(1)).alias("readings"),
                   F.count(F.when(parsed_ok, F.lit(1))).alias("parsed"))
    long_form = counts.select(F.explode(F.array(
        F.struct(F.lit("readings").alias("stage"), F.col("readings").alias("n")),
        F.struct(F.lit("parsed").alias("stage"), F.col("parsed").alias("n")))).alias("s"))
    w = _wide(spark, sf_dir)
    return union_frames([long_form.select("s.stage", "s.n"),
                         A.row_count(w, "n").select(F.lit("wide").alias("stage"), "n")])


# ---- filters, order, sets ------------------------------------------------

@register("time_filter", f"""{WIDE}
SELECT * FROM wide
WHERE ts_min_bignt >= {int(FILTER_FROM.timestamp())} AND ts_min_bignt < {int(FILTER_TO.timestamp())}""")
def q_time_filter(spark, sf_dir):
    """half-open time range."""
    return A.room_time_filter(_wide(spark, sf_dir), start=FILTER_FROM, end=FILTER_TO)


@register("clustered_filter", f"""{WIDE}
SELECT * FROM wide WHERE room IN ('1', '2', '3', '5', '8')
  AND ts_min_bignt >= {int(FILTER_FROM.timestamp())} AND ts_min_bignt < {int(FILTER_TO.timestamp())}""")
def q_clustered_filter(spark, sf_dir):
    """F4 on a table clustered by room and time at once."""
    from sensorflow.plans.ingest import write_clustered_table
    from sensorflow.session import scratch_path
    base = scratch_path(spark, "clustered")
    _wide(spark, sf_dir).write.parquet(f"{base}/wide")
    write_clustered_table(spark.read.parquet(f"{base}/wide"), f"{base}/clustered")
    return A.room_time_filter(spark.read.parquet(f"{base}/clustered"), rooms=("1", "2", "3", "5", "8"),
                              start=FILTER_FROM, end=FILTER_TO).drop("room_hash")


@register("room_filter", f"{WIDE} SELECT * FROM wide WHERE room IN ('1', '2', '3', '5', '8')")
def q_room_filter(spark, sf_dir):
    """rooms in a set."""
    return A.room_time_filter(_wide(spark, sf_dir), rooms=("1", "2", "3", "5", "8"))


@register("series_sorted", f"{WIDE} SELECT * FROM wide")
def q_series_sorted(spark, sf_dir):
    """O1: rooms kept together and in time order: a global sort of the stored
    rows, whose sampling pass reads the table and not the join again."""
    from sensorflow.session import scratch_path
    path = scratch_path(spark, "series")
    _wide(spark, sf_dir).write.parquet(path)
    return A.sorted_series(spark.read.parquet(path))


@register("preview", f"""{WIDE}
SELECT * FROM wide ORDER BY room, ts_min_bignt, event_ts_min, co2, light, temp, humidity, pir
LIMIT 5""")
def q_preview(spark, sf_dir):
    """O2: five-row preview in a fixed order."""
    return A.preview(_wide(spark, sf_dir), 5)


@register("replayed", f"""{WIDE}
SELECT wide.*, r.replay FROM wide, (SELECT CAST(unnest(range(1, 4)) AS INTEGER) AS replay) r""")
def q_replayed(spark, sf_dir):
    """The data set three times, numbered."""
    from sensorflow.operators.wide import repeat_rows
    return repeat_rows(_wide(spark, sf_dir), 3)


@register("union_sources", f"""WITH {O.RAW_CTE},
{O.wide_cte('readings', name='w1')}, {O.wide_cte('clean', name='w2')}
SELECT 'events' AS source, * FROM w1 UNION ALL SELECT 'raw_text' AS source, * FROM w2""")
def q_union_sources(spark, sf_dir):
    """Union by name of wide rows from two sources, duplicates kept."""
    a = _wide(spark, sf_dir).select(F.lit("events").alias("source"), "*")
    b = wide_readings(_clean(spark, sf_dir, by_type=True)) \
        .select(F.lit("raw_text").alias("source"), "*")
    return union_frames([a, b])


# ---- data quality -------------------------------------------------------

@register("completeness", f"""WITH {O.RAW_CTE}
SELECT r.room, r.sensor, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(sum(CASE WHEN r.ts_raw IS NULL OR trim(r.ts_raw) = '' THEN 1 ELSE 0 END) AS BIGINT)
    AS n_missing_ts,
  CAST(sum(CASE WHEN NOT (r.ts_raw IS NULL OR trim(r.ts_raw) = '') AND c.ts_min_bignt IS NULL
    THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_ts,
  CAST(sum(CASE WHEN r.value_raw IS NULL OR trim(r.value_raw) = '' THEN 1 ELSE 0 END) AS BIGINT)
    AS n_missing_value,
  CAST(sum(CASE WHEN NOT (r.value_raw IS NULL OR trim(r.value_raw) = '')
    AND c.sensor_value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_value
FROM raw_readings r JOIN clean c USING (event_id) GROUP BY r.room, r.sensor""")
def q_completeness(spark, sf_dir):
    """Q1: missing and unparsable values per room and sensor."""
    return Q.completeness(_clean(spark, sf_dir, keep_raw=True))


@register("missing_sensors", f"""WITH {O.READINGS_CTE},
grid AS (SELECT DISTINCT room, ts_min_bignt FROM readings),
s AS (SELECT unnest(['co2', 'humidity', 'light', 'pir', 'temperature']) AS missing_sensor)
SELECT g.room, g.ts_min_bignt, s.missing_sensor FROM grid g, s
WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.room = g.room
  AND r.ts_min_bignt = g.ts_min_bignt AND r.sensor = s.missing_sensor)""")
def q_missing_sensors(spark, sf_dir):
    """Q2: (room, instant) cells lacking a sensor."""
    return Q.missing_sensors(_readings(spark, sf_dir))


@register("duplicate_keys", f"""WITH {O.READINGS_CTE}
SELECT room, ts_min_bignt, sensor, CAST(count(*) AS BIGINT) AS n FROM readings
GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    """Q4: keys with more than one reading."""
    return Q.duplicate_keys(_readings(spark, sf_dir))


@register("latest_readings", f"""WITH {O.READINGS_CTE}
SELECT room, ts_min_bignt, sensor, max(event_id) AS event_id,
  arg_max(sensor_value, event_id) AS sensor_value FROM readings GROUP BY 1, 2, 3""")
def q_latest_readings(spark, sf_dir):
    """Q4 keep-latest: one reading per (room, instant, sensor)."""
    return Q.keep_latest(_readings(spark, sf_dir), "event_id")


# ---- SQL surface --------------------------------------------------------

@register("views_sql", f"""{WIDE},
l AS (SELECT room, count(*) AS n_readings, max(ts_min_bignt) AS last_instant
      FROM readings GROUP BY room),
m AS (SELECT room, count(*) AS n_wide, count(*) FILTER (WHERE pir > 0) AS n_moving
      FROM wide GROUP BY room)
SELECT l.room, CAST(n_readings AS BIGINT) AS n_readings, last_instant,
  CAST(coalesce(n_wide, 0) AS BIGINT) AS n_wide, CAST(coalesce(n_moving, 0) AS BIGINT) AS n_moving
FROM l LEFT JOIN m ON l.room = m.room""")
def q_views_sql(spark, sf_dir):
    """Movement per room beside the room's readings, in SQL over the views."""
    register_views(spark, _readings(spark, sf_dir, by_type=True))
    return spark.sql("""
        WITH moving AS (
          SELECT room, count(*) AS n_wide, count_if(if_movement = 'movement') AS n_moving
          FROM sensor_flagged GROUP BY room)
        SELECT r.room, count(*) AS n_readings, max(r.ts_min_bignt) AS last_instant,
               coalesce(first(m.n_wide), 0L) AS n_wide, coalesce(first(m.n_moving), 0L) AS n_moving
        FROM sensor_readings r LEFT JOIN moving m ON r.room = m.room
        GROUP BY r.room""")


# ---- through files and streams (written under the shared checkpoint folder)

@register("file_tree_wide", f"WITH {O.RAW_CTE}, {O.wide_cte('clean')} SELECT * FROM wide")
def q_file_tree_wide(spark, sf_dir):
    """P1, P3, J1, F1 through real files: the raw text readings are written as
    CSV files partitioned by sensor, then read back. (The reference's layout,
    a folder per room, is compared in pytest on small trees.)"""
    from sensorflow.plans.ingest import build_wide
    from sensorflow.session import scratch_path
    from sensorflow.sources.sensor_files import write_raw_hive_tree
    root = scratch_path(spark, "sensor-tree")
    write_raw_hive_tree(ev.raw_readings(spark, sf_dir), root)
    return build_wide(spark, root, layout="hive")


@register("wide_incremental", f"WITH {O.RAW_CTE}, {O.wide_cte('clean')} SELECT * FROM wide")
def q_wide_incremental(spark, sf_dir):
    """K2, J1 kept up to date: a first build, then files are appended and others
    deleted; each refresh joins the touched days only."""
    from sensorflow.plans.maintain import list_files, refresh
    from sensorflow.session import remove_path, scratch_path
    from sensorflow.sources.sensor_files import write_raw_hive_tree
    base = scratch_path(spark, "incremental")
    root, table = f"{base}/tree", f"{base}/wide"
    raw = ev.raw_readings(spark, sf_dir)
    older = raw.filter(F.col("event_id") % 3 != 0)
    write_raw_hive_tree(older, root)
    refresh(spark, root, table, layout="hive")
    known = {r["path"] for r in list_files(spark, root, "hive").collect()}
    # a wrong delivery, then its removal together with the missing readings
    write_raw_hive_tree(raw.filter(F.col("event_id") % 5 == 0), root, "append")
    refresh(spark, root, table, layout="hive")
    for r in list_files(spark, root, "hive").collect():
        if r["path"] not in known:
            remove_path(spark, r["path"])
    write_raw_hive_tree(raw.filter(F.col("event_id") % 3 == 0), root, "append")
    refresh(spark, root, table, layout="hive")
    return spark.read.parquet(table).drop("event_date")


@register("file_tree_salted", f"WITH {O.RAW_CTE}, {O.wide_cte('clean')} SELECT * FROM wide")
def q_file_tree_salted(spark, sf_dir):
    """The same with hot keys split: each side still reads its own files only."""
    from sensorflow.plans.ingest import build_wide
    from sensorflow.session import scratch_path
    from sensorflow.sources.sensor_files import write_raw_hive_tree
    root = scratch_path(spark, "sensor-tree")
    write_raw_hive_tree(ev.raw_readings(spark, sf_dir), root)
    return build_wide(spark, root, layout="hive", hot_key_rows=4)


@register("long_table_wide", f"{WIDE} SELECT * FROM wide")
def q_long_table_wide(spark, sf_dir):
    """D3 layout: long readings stored partitioned by sensor; each join side
    reads only its sensor's folder."""
    from sensorflow.plans.ingest import read_long_table, write_long_table
    from sensorflow.session import scratch_path
    path = scratch_path(spark, "long-table")
    write_long_table(_readings(spark, sf_dir).drop("ts"), path)
    return wide_readings(read_long_table(spark, path))


@register("stream_wide", f"{WIDE} SELECT * FROM wide")
def q_stream_wide(spark, sf_dir):
    """J1 on a stream (W5): the readings arrive sensor by sensor, in several
    batches, and are aligned by chained stream-stream joins."""
    from sensorflow.schema import SENSORS
    from sensorflow.session import scratch_path
    from sensorflow.streaming.align import start_align_stream
    from sensorflow.streaming.sinks import read_batches, run_available
    base = scratch_path(spark, "align-stream")
    long = _readings(spark, sf_dir).select("room", "sensor", "ts_min_bignt", "sensor_value")
    for sensor in SENSORS:  # one delivery after another
        long.filter(F.col("sensor") == sensor).write.mode("append").parquet(f"{base}/inbox")
    files = len(spark.read.parquet(f"{base}/inbox").inputFiles())
    source = spark.readStream.schema(long.schema).option("maxFilesPerTrigger", max(1, files // 3)) \
        .parquet(f"{base}/inbox")
    q, _ = start_align_stream(source, f"{base}/wide", f"{base}/checkpoint",
                              trigger={"availableNow": True})
    run_available(q)
    return read_batches(spark, f"{base}/wide").drop("batch_id")


@register("stream_index_documents", ORACLE["index_documents"])
def q_stream_index_documents(spark, sf_dir):
    """Entry point B on a drained file stream: equals the batch form."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.streams import read_messages
    from sensorflow.streaming.index_stream import start_index_stream
    from sensorflow.streaming.sinks import read_batches, run_available
    base = scratch_path(spark, "index-stream")
    PL.to_messages(_wide_v2(spark, sf_dir), with_key=False).write.text(f"{base}/inbox")
    q, _ = start_index_stream(read_messages(spark, "text", f"{base}/inbox"), f"{base}/docs",
                              f"{base}/checkpoint", trigger={"availableNow": True}, now=FIXED_NOW)
    run_available(q)
    return read_batches(spark, f"{base}/docs").drop("batch_id")


@register("stream_index_documents_json", f"""{WIDE_V2}
SELECT ts_min_bignt AS event_ts_min, co2, humidity, light,
  temp AS temperature, room, pir, {FLAG.format(p='pir')} AS if_movement
FROM wide2""")
def q_stream_index_documents_json(spark, sf_dir):
    """The second version's index stream: JSON messages, a typed time (null when
    unparsable), null readings kept."""
    from sensorflow.plans.jobs import run_index_stream
    from sensorflow.session import scratch_path
    from sensorflow.streaming.sinks import read_batches, run_available
    base = scratch_path(spark, "index-json")
    PL.to_messages(_wide_v2(spark, sf_dir), "json", with_key=False).write.json(f"{base}/inbox")
    q, _ = run_index_stream(spark, "json", f"{base}/inbox", f"{base}/docs", "json",
                            trigger={"availableNow": True}, time_as="timestamp", fill_value=None)
    run_available(q)
    out = read_batches(spark, f"{base}/docs").drop("batch_id")
    return out.withColumn("event_ts_min", F.unix_seconds("event_ts_min"))


@register("stream_dedupe", f"""{WIDE_V2}
SELECT DISTINCT ts_min_bignt * 1000 AS event_ts_min, coalesce(co2, 0.0) AS co2,
  coalesce(humidity, 0.0) AS humidity, coalesce(light, 0.0) AS light,
  coalesce(temp, 0.0) AS temperature, room, coalesce(pir, 0.0) AS pir,
  {FLAG.format(p='pir')} AS if_movement
FROM wide2""")
def q_stream_dedupe(spark, sf_dir):
    """Every message is written twice, rooms one after another, and read in
    several batches; each document arrives once and none is lost."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.streams import read_messages
    from sensorflow.streaming.index_stream import start_index_stream
    from sensorflow.streaming.sinks import read_batches, run_available
    base = scratch_path(spark, "dedupe-stream")
    wide = _wide_v2(spark, sf_dir).repartitionByRange(3, "room")
    msgs = PL.to_messages(wide, with_key=False)
    for _ in range(2):
        msgs.write.mode("append").text(f"{base}/inbox")
    source = read_messages(spark, "text", f"{base}/inbox", max_per_trigger=2)
    q, _ = start_index_stream(source, f"{base}/docs", f"{base}/checkpoint", now=FIXED_NOW,
                              trigger={"availableNow": True}, distinct=True)
    run_available(q)
    return read_batches(spark, f"{base}/docs").drop("batch_id", "event_date", "content_id")


@register("stream_upserts", f"""WITH {O.READINGS_CTE},
latest AS (SELECT room, sensor, ts_min_bignt, arg_max(sensor_value, event_id) AS sensor_value
           FROM readings GROUP BY room, sensor, ts_min_bignt),
{O.wide_cte('latest')}
SELECT ts_min_bignt * 1000 AS event_ts_min, humidity, light, temp AS temperature, room, pir,
  CASE WHEN CAST(room AS BIGINT) % 3 = 0 THEN co2 ELSE 1.0::DOUBLE END AS co2,
  {FLAG.format(p='pir')} AS if_movement
FROM wide""")
def q_stream_upserts(spark, sf_dir):
    """K6: documents by key. Every document arrives with a wrong reading, then a
    third of the rooms again with the right one, which replaces it."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.streams import read_messages
    from sensorflow.streaming.index_stream import start_document_upserts
    from sensorflow.streaming.sinks import run_available
    base = scratch_path(spark, "upserts")
    wide = _wide(spark, sf_dir, how="latest", order_col="event_id")
    wrong = wide.withColumn("co2", F.lit(1.0))
    right = wide.filter(F.col("room").cast("bigint") % 3 == 0)
    for delivery in (wrong, right):
        PL.to_messages(delivery.repartition(2), with_key=False).write.mode("append").text(f"{base}/inbox")
    q, table = start_document_upserts(
        read_messages(spark, "text", f"{base}/inbox", max_per_trigger=2), f"{base}/docs",
        f"{base}/checkpoint", trigger={"availableNow": True}, now=FIXED_NOW)
    run_available(q)
    return table.read(spark).drop("event_date")


@register("stream_index_quarantine", f"""{WIDE_V2}
SELECT * FROM (
  SELECT ts_min_bignt * 1000 AS event_ts_min, room, coalesce(co2, 0.0) AS co2,
    coalesce(pir, 0.0) AS pir, {FLAG.format(p='pir')} AS if_movement,
    nullif(concat_ws(',', CASE WHEN co2 IS NULL THEN 'co2' END,
      CASE WHEN light IS NULL THEN 'light' END, CASE WHEN temp IS NULL THEN 'temp' END,
      CASE WHEN humidity IS NULL THEN 'humidity' END, CASE WHEN pir IS NULL THEN 'pir' END), '')
      AS reason
  FROM wide2) q WHERE reason IS NOT NULL""")
def q_stream_index_quarantine(spark, sf_dir):
    """Q3 on the index stream: documents with missing or unparsable fields
    land under ``status=quarantine`` of the same per-batch write."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.streams import read_messages
    from sensorflow.streaming.index_stream import start_index_stream
    from sensorflow.streaming.sinks import read_batches, run_available
    base = scratch_path(spark, "index-quarantine")
    PL.to_messages(_wide_v2(spark, sf_dir), with_key=False).write.text(f"{base}/inbox")
    q, _ = start_index_stream(read_messages(spark, "text", f"{base}/inbox"), f"{base}/docs",
                              f"{base}/checkpoint", trigger={"availableNow": True},
                              now=FIXED_NOW, quarantine=True)
    run_available(q)
    out = read_batches(spark, f"{base}/docs")
    return out.filter(F.col("status") == "quarantine").select(
        "event_ts_min", "room", "co2", "pir", "if_movement", "reason")


@register("stream_routed_predictions", ORACLE["routed_predictions"])
def q_stream_routed_predictions(spark, sf_dir):
    """Entry point C on a drained stream of JSON messages, routed by class."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.streams import read_messages
    from sensorflow.streaming.scoring import start_scoring_stream
    from sensorflow.streaming.sinks import read_batches, run_available
    base = scratch_path(spark, "scoring-stream")
    PL.to_messages(_wide(spark, sf_dir), "json").write.json(f"{base}/inbox")
    q, _ = start_scoring_stream(read_messages(spark, "json", f"{base}/inbox"), FIXED_MODEL,
                                f"{base}/routes", f"{base}/checkpoint", payload_format="json",
                                trigger={"availableNow": True})
    run_available(q)
    out = read_batches(spark, f"{base}/routes")
    return out.select("route", *[F.round(c, 6).alias(c) if c == "confidence" else F.col(c)
                                 for c in PREDICTION_FIELDS])


@register("stream_prediction_messages", f"""{SCORED}
SELECT CASE WHEN prediction = 1.0 THEN 'moving' ELSE 'no_activity' END AS topic,
  event_ts_min, room, co2, light, temp, humidity, prediction,
  round(probability, 6) AS confidence FROM pred""")
def q_stream_prediction_messages(spark, sf_dir):
    """Predictions sent as JSON messages to their route's topic;
    the parsed fields are compared."""
    from sensorflow.schema import PREDICTION_SCHEMA
    from sensorflow.session import scratch_path
    from sensorflow.sources.streams import read_messages
    from sensorflow.streaming.scoring import start_prediction_messages
    from sensorflow.streaming.sinks import read_batches, run_available
    base = scratch_path(spark, "prediction-messages")
    # the text time is spoilt on purpose: the sent time comes from the seconds
    late = _wide(spark, sf_dir).withColumn("event_ts_min", F.lit("late"))
    PL.to_messages(late, "json").write.json(f"{base}/inbox")
    q, _ = start_prediction_messages(
        read_messages(spark, "json", f"{base}/inbox"), FIXED_MODEL, f"{base}/checkpoint", "json",
        f"{base}/topics", payload_format="json", trigger={"availableNow": True},
        topics={"activity": "moving"})
    run_available(q)
    parsed = F.from_json("value", PREDICTION_SCHEMA)
    out = read_batches(spark, f"{base}/topics", "json").select("topic", parsed.alias("p"))
    return out.select("topic", "p.*").withColumn("confidence", F.round("confidence", 6))


@register("holdout_accuracy", f"""{SCORED}
SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
  round(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS accuracy_pct
FROM pred WHERE ts_min_bignt >= {int(HOLDOUT_FROM.timestamp())}""")
def q_holdout_accuracy(spark, sf_dir):
    """M3 with a time-based hold-out (rows from the cutoff on)."""
    from sensorflow.operators.model import time_split
    _, test = time_split(with_label(_wide(spark, sf_dir)), int(HOLDOUT_FROM.timestamp()))
    a = accuracy(score(test, FIXED_MODEL))
    return a.withColumn("accuracy_pct", F.round("accuracy_pct", 6))


@register("room_windows", f"""{WIDE}
SELECT CAST(floor(ts_min_bignt / {WINDOW_SECONDS}) * {WINDOW_SECONDS} AS BIGINT) AS window_start,
  room, CAST(count(*) AS BIGINT) AS n, {_avg('co2')} AS avg_co2,
  {_avg('temp')} AS avg_temp, {_avg('humidity')} AS avg_humidity
FROM wide GROUP BY 1, 2""")
def q_room_windows(spark, sf_dir):
    """E2 in batch form: per room and 4-day window."""
    from sensorflow.streaming.event_time import windowed_metrics, with_event_time
    return windowed_metrics(with_event_time(_wide(spark, sf_dir)), "4 days", "2 days")


@register("stream_room_windows", f"""{WIDE},
w AS (
  SELECT CAST(floor(ts_min_bignt / {WINDOW_SECONDS}) * {WINDOW_SECONDS} AS BIGINT) AS window_start,
    room, CAST(count(*) AS BIGINT) AS n, {_avg('co2')} AS avg_co2,
    {_avg('temp')} AS avg_temp, {_avg('humidity')} AS avg_humidity
  FROM wide GROUP BY 1, 2)
SELECT * FROM w
WHERE window_start + {WINDOW_SECONDS} <= (SELECT max(ts_min_bignt) FROM wide) - {WATERMARK_SECONDS}""")
def q_stream_room_windows(spark, sf_dir):
    """E2 on a drained stream: a window is emitted once the watermark
    (latest event time minus the delay) has reached its end."""
    from sensorflow.session import scratch_path
    from sensorflow.streaming.event_time import windowed_metrics, with_event_time
    from sensorflow.streaming.sinks import run_available, start
    base = scratch_path(spark, "window-stream")
    wide = _wide(spark, sf_dir)
    wide.write.parquet(f"{base}/inbox")
    stream = spark.readStream.schema(wide.schema).parquet(f"{base}/inbox")
    agg = windowed_metrics(with_event_time(stream), "4 days", f"{WATERMARK_SECONDS} seconds")
    q = start(agg, "parquet", f"{base}/checkpoint", trigger={"availableNow": True},
              options={"path": f"{base}/out"})
    run_available(q)
    return spark.read.parquet(f"{base}/out")


@register("stream_windowed_accuracy", f"""{SCORED}
SELECT * FROM (
  SELECT CAST(floor(ts_min_bignt / {WINDOW_SECONDS}) * {WINDOW_SECONDS} AS BIGINT) AS window_start,
    CAST(count(*) AS BIGINT) AS total,
    CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
    round(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) * 100.0 / count(*), 6)
      AS accuracy_pct
  FROM pred GROUP BY 1) a
WHERE window_start + {WINDOW_SECONDS} <= (SELECT max(ts_min_bignt) FROM wide) - {WATERMARK_SECONDS}""")
def q_stream_windowed_accuracy(spark, sf_dir):
    """A9 on a drained stream of JSON messages: score, then accuracy per
    closed event-time window."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.streams import read_messages
    from sensorflow.streaming.event_time import windowed_accuracy, with_event_time
    from sensorflow.streaming.scoring import score_messages
    from sensorflow.streaming.sinks import run_available, start
    base = scratch_path(spark, "accuracy-stream")
    PL.to_messages(_wide(spark, sf_dir), "json").write.json(f"{base}/inbox")
    scored = with_label(score_messages(read_messages(spark, "json", f"{base}/inbox"),
                                       FIXED_MODEL, "json"))
    acc = windowed_accuracy(with_event_time(scored), "4 days", f"{WATERMARK_SECONDS} seconds")
    q = start(acc, "parquet", f"{base}/checkpoint", trigger={"availableNow": True},
              options={"path": f"{base}/out"})
    run_available(q)
    return spark.read.parquet(f"{base}/out")


@register("stream_running_accuracy", ORACLE["windowed_accuracy"])
def q_stream_running_accuracy(spark, sf_dir):
    """A9 as it runs: update mode into a keyed table, so every window counts,
    also those still open; each batch refines them."""
    from sensorflow.session import scratch_path
    from sensorflow.sources.streams import read_messages
    from sensorflow.streaming.event_time import with_event_time
    from sensorflow.streaming.scoring import score_messages, start_running_accuracy
    from sensorflow.streaming.sinks import run_available
    base = scratch_path(spark, "running-accuracy")
    for part in _wide(spark, sf_dir).randomSplit([0.5, 0.5], 3):
        PL.to_messages(part.repartition(2), "json").write.mode("append").json(f"{base}/inbox")
    scored = with_label(score_messages(
        read_messages(spark, "json", f"{base}/inbox", max_per_trigger=2), FIXED_MODEL, "json"))
    q, table = start_running_accuracy(with_event_time(scored), f"{base}/accuracy", f"{base}/checkpoint",
                                      "4 days", f"{30 * WATERMARK_SECONDS} seconds",
                                      trigger={"availableNow": True})
    run_available(q)
    return table.read(spark).drop("event_date")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> long readings -> five-way join -> movement flag."""
    return with_movement(_wide(spark, sf_dir))
