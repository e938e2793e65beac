"""Messages: delimited and JSON build/parse, message key, quarantine
(P9, P12, P13, P15, P16, P17, P18, Q3).

One parser serves batch frames and streams; ``payload_format`` picks the
layout, so the scoring stream can read what the ingest publishes in either
format (the reference's second version could not).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.cleaning import valid_reading
from sensorflow.functions.time import text_to_epoch_ms, valid_epoch
from sensorflow.schema import JSON_PAYLOAD_SCHEMA, READING_COLUMNS, WIDE_COLUMNS

_TYPES = {f.name: f.dataType for f in JSON_PAYLOAD_SCHEMA.fields}


def as_text(c: str) -> Column:
    """Value as text for a delimited message; null -> empty field, so the
    positions never shift (``concat_ws`` alone would skip nulls)."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def csv_payload(cols=WIDE_COLUMNS, sep: str = ",") -> Column:
    """The listed columns as one delimited string."""
    return F.concat_ws(sep, *[as_text(c) for c in cols])


def json_payload(cols=WIDE_COLUMNS) -> Column:
    """``to_json(struct(cols))``; Spark omits null fields."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def message_key(key_col: str | None = None, business_key=("room", "ts_min_bignt")) -> Column:
    """The chosen column as text. Spark rows have no index, so the
    default is a stable business key rather than a row number."""
    if key_col:
        return F.col(key_col).cast("string")
    return F.concat_ws("-", *[F.col(c).cast("string") for c in business_key])


def to_messages(df: DataFrame, payload_format: str = "csv", cols=WIDE_COLUMNS,
                sep: str = ",", key_col: str | None = None, with_key: bool = True) -> DataFrame:
    """Rows -> ``key, value`` messages (K3, K4)."""
    value = csv_payload(cols, sep) if payload_format == "csv" else json_payload(cols)
    out = [value.alias("value")]
    if with_key:
        out.insert(0, message_key(key_col).alias("key"))
    return df.select(*out)


def value_as_string(df: DataFrame, col: str = "value") -> DataFrame:
    """Binary payload -> string (no-op for text)."""
    return df.withColumn(col, F.col(col).cast("string"))


def parse_csv(df: DataFrame, value_col: str = "value", sep: str = ",",
              fields=WIDE_COLUMNS, keep_value: bool = False) -> DataFrame:
    """Split once, take each position with ``get`` (null when missing)
    and ``try_cast`` it to its type (null when unparsable)."""
    parts = F.split(F.col(value_col), _regex_escape(sep))
    cols = []
    for i, name in enumerate(fields):
        raw = F.get(parts, i)
        t = _TYPES.get(name)
        cols.append((raw if t is None or t.simpleString() == "string"
                     else F.trim(raw).try_cast(t)).alias(name))
    keep = [c for c in df.columns if c != value_col or keep_value]
    return df.select(*keep, *cols)


def parse_json(df: DataFrame, value_col: str = "value", schema=JSON_PAYLOAD_SCHEMA,
               keep_value: bool = False) -> DataFrame:
    """``from_json`` with a fixed schema, expanded. Unparsable text gives
    an all-null row, which ``quarantine`` then separates."""
    keep = [c for c in df.columns if c != value_col or keep_value]
    parsed = df.select(*keep, F.from_json(F.col(value_col), schema).alias("_data"))
    return parsed.select(*keep, *[F.col(f"_data.{f.name}").alias(f.name) for f in schema.fields])


def parse_json_open(df: DataFrame, value_col: str = "value", schema=JSON_PAYLOAD_SCHEMA,
                    keep_value: bool = False) -> DataFrame:
    """P15 for payloads that drift: the known fields as ``parse_json`` gives them,
    and ``extra``, a map of VARIANT values, with what the schema could not hold:
    fields it does not know, and known ones that came with another type (their
    column is null then). Messages without such fields have an empty map, text
    that is no JSON object a null one. ``variant_get(extra['field'], path, type)``
    reads them; VARIANT columns are stored in Parquet as they are."""
    keep = [c for c in df.columns if c != value_col or keep_value]
    typed = {f.name: f.dataType for f in schema.fields}
    parsed = df.select(*keep, F.from_json(F.col(value_col), schema).alias("_data"),
                       F.from_json(F.col(value_col), "map<string,variant>").alias("_all"))
    def unheld(k, v):
        known = F.lit(False)
        for name in typed:
            known = known | ((k == name) & F.col(f"_data.{name}").isNotNull())
        return ~known & v.isNotNull() & ~F.is_variant_null(v)

    return parsed.select(*keep, *[F.col(f"_data.{n}").alias(n) for n in typed],
                         F.map_filter("_all", unheld).alias("extra"))


def parse_payload(df: DataFrame, payload_format: str = "csv", value_col: str = "value",
                  sep: str = ",", keep_value: bool = False) -> DataFrame:
    """Messages in either format -> the eight fields. An instant or a reading
    out of range is null like an unparsable one, so quarantine (Q3) sees it."""
    df = value_as_string(df, value_col)
    if payload_format == "csv":
        parsed = parse_csv(df, value_col, sep, keep_value=keep_value)
    elif payload_format == "json":
        parsed = parse_json(df, value_col, keep_value=keep_value)
    else:
        raise ValueError(f"unknown payload format {payload_format!r}")
    return parsed.withColumns({"ts_min_bignt": valid_epoch("ts_min_bignt"),
                               **{c: valid_reading(c) for c in READING_COLUMNS}})


def time_to_epoch_ms(df: DataFrame, now: _dt.datetime | None = None,
                     col: str = "event_ts_min") -> DataFrame:
    """P7 on a parsed frame: text time -> epoch ms, fallback ``now``."""
    return df.withColumn(col, text_to_epoch_ms(col, now))


def null_reason(cols, floating=()) -> Column:
    """Comma-separated names of the null fields (NaN too for the
    ``floating`` ones); null when none is."""
    def bad(c):
        t = F.col(c).isNull()
        return (t | F.isnan(F.col(c))) if c in floating else t
    names = F.concat_ws(",", *[F.when(bad(c), F.lit(c)) for c in cols])
    return F.when(names == "", F.lit(None).cast("string")).otherwise(names)


def invalid_reason(df: DataFrame, cols=WIDE_COLUMNS) -> Column:
    """``null_reason`` with NaN counted as missing for the float columns of
    ``df`` (as F1 does)."""
    types = dict(df.dtypes)
    return null_reason(cols, floating={c for c in cols if types.get(c) in ("double", "float")})


def quarantine(df: DataFrame, required=WIDE_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Q3: split into (good rows, bad rows with ``reason``). One expression,
    evaluated in both branches; persist the input if both are written."""
    reason = invalid_reason(df, required)
    tagged = df.withColumn("reason", reason)
    good = tagged.filter(F.col("reason").isNull()).drop("reason")
    bad = tagged.filter(F.col("reason").isNotNull())
    return good, bad


def _regex_escape(sep: str) -> str:
    specials = set(".^$*+?{}[]\\|()")
    return "".join("\\" + ch if ch in specials else ch for ch in sep)
