import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sensorflow.session import build_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", "sensorflow-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true"})
    yield s
    s.stop()
