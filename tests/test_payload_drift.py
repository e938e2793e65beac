"""JSON payloads with fields that the schema does not hold."""

from pyspark.sql import functions as F

from sensorflow.functions import payload as PL

GOOD = ('{"event_ts_min":"2024-01-02 00:00:00","ts_min_bignt":1704153600,"room":"1","co2":400.5,'
        '"light":1.0,"temp":20.0,"humidity":40.0,"pir":0.0}')


def parse(spark, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return PL.parse_json_open(df)


def test_known_fields_parse_as_before(spark):
    values = [GOOD, GOOD.replace("400.5", '"x"'), GOOD.replace("400.5", "null"), "{}", "garbage", None, "[1]",
              GOOD[:-1] + ',"unit":"ppm"}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    known = PL.parse_json(df)
    assert sorted(map(str, PL.parse_json_open(df).select(*known.columns).collect())) == sorted(map(str, known.collect()))


def test_extra_and_retyped_fields_survive(spark, tmp_path):
    drifted = GOOD.replace("400.5", '"400.5"')[:-1] + ',"unit":"ppm","device":{"id":7,"tags":["a",null]},"none":null}'
    parse(spark, GOOD, drifted, "garbage", "{}").write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    rows = {r["i"]: r for r in back.select("i", "co2", F.map_keys("extra").alias("k"),
                                           F.to_json("extra").alias("j")).collect()}
    assert rows[0]["k"] == [] and rows[0]["co2"] == 400.5
    assert rows[2]["k"] is None and rows[3]["k"] == []
    assert rows[1]["co2"] is None and sorted(rows[1]["k"]) == ["co2", "device", "unit"]
    one = back.filter("i = 1").select(
        F.variant_get(F.col("extra")["device"], "$.id", "int"),
        F.variant_get(F.col("extra")["device"], "$.tags[0]", "string"),
        F.try_variant_get(F.col("extra")["co2"], "$", "double"),
        F.try_variant_get(F.col("extra")["unit"], "$", "double")).first()
    assert tuple(one) == (7, "a", 400.5, None)


def test_a_new_field_can_be_counted(spark):
    values = [GOOD[:-1] + f',"fw":"{v}"}}' for v in ("a", "a", "b")] + [GOOD]
    found = parse(spark, *values).groupBy(F.variant_get(F.col("extra")["fw"], "$", "string").alias("fw")).count()
    assert {r["fw"]: r["count"] for r in found.collect()} == {"a": 2, "b": 1, None: 1}
