"""Clear errors for invalid arguments."""

import pytest

from sensorflow.functions import payload as PL
from sensorflow.operators.model import LinearModel, score
from sensorflow.operators.wide import hot_keys, repeat_rows, union_frames, wide_readings
from sensorflow.plans.ingest import write_long_table
from sensorflow.streaming.index_stream import index_documents
from sensorflow.streaming.scoring import start_scoring_stream


def test_invalid_arguments(spark, tmp_path):
    df = spark.createDataFrame([("v",)], "value string")
    long = spark.createDataFrame([("r", "co2", 1, 1.0)],
                                 "room string, sensor string, ts_min_bignt long, sensor_value double")
    with pytest.raises(ValueError):
        union_frames([])
    with pytest.raises(ValueError):
        repeat_rows(df, 0)
    with pytest.raises(ValueError):
        PL.parse_payload(df, "xml")
    with pytest.raises(ValueError):
        wide_readings(long, how="pivot")
    with pytest.raises(ValueError):
        wide_readings(long, how="latest")  # needs order_col
    with pytest.raises(ValueError):
        hot_keys(long, 0)
    with pytest.raises(ValueError):
        index_documents(df, time_as="date")
    with pytest.raises(ValueError):
        write_long_table(long, str(tmp_path / "x"), buckets=4)  # bucketing needs a table
    with pytest.raises(TypeError):
        score(long, LinearModel(0.0, (0.0,) * 4), method="transform")
    with pytest.raises(ValueError):
        start_scoring_stream(df, LinearModel(0.0, (0.0,) * 4), str(tmp_path / "t"),
                             str(tmp_path / "c"), invalid="keep")
