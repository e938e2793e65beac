"""Incremental maintenance of the wide table against full rebuilds."""

import os
import random

import pytest

from sensorflow.plans.ingest import build_wide
from sensorflow.plans.maintain import list_files, refresh
from sensorflow.schema import SENSORS

DAY = 86400


def write(root, room, sensor, rows):
    folder = root / room
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{sensor}.csv").write_text("".join(f"{t},{v}\n" for t, v in rows))


def room_files(root, room, days, seed=0):
    rng = random.Random(seed)
    for sensor in SENSORS:
        write(root, room, sensor, [(d * DAY + k * 3600, rng.randint(0, 50)) for d in days for k in range(4)])


def table_rows(spark, table):
    return sorted(map(tuple, spark.read.parquet(str(table)).drop("event_date").collect()))


def rebuilt(spark, root):
    return sorted(map(tuple, build_wide(spark, str(root)).collect()))


def files_of(table):
    return {os.path.join(d, f) for d, _, names in os.walk(table) for f in names
            if f.endswith(".parquet") and "_manifest" not in d}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree"
    room_files(root, "a", [0, 1, 2], 1)
    room_files(root, "room b{1}[x] +%", [2, 3], 2)
    return root


def test_refresh_equals_a_rebuild(spark, tree, tmp_path):
    table = tmp_path / "wide"

    def run():
        before = files_of(table)
        done = refresh(spark, str(tree), str(table))
        assert table_rows(spark, table) == rebuilt(spark, tree)
        return done, before

    first, _ = run()
    assert first.files_changed == 10 and len(first.days) == 4
    again, before = run()
    assert again.days == () and files_of(table) == before

    room_files(tree, "c", [3], 3)  # appended: one day
    done, before = run()
    assert [str(d) for d in done.days] == ["1970-01-04"] and done.files_read == 10
    kept = {f for f in before if "1970-01-04" not in f}
    assert kept <= files_of(table) and not (files_of(table) & before - kept)

    write(tree, "a", "co2", [(t * 3600, 7) for t in range(24)] + [("x", 1), (2**63 - 1, 2)])  # changed
    done, before = run()
    assert done.files_changed == 1 and len(done.days) == 3
    assert {f for f in before if "1970-01-04" in f} <= files_of(table)

    (tree / "a" / "pir.csv").unlink()  # gone: days 0 and 1 have no rows left
    done, _ = run()
    assert done.files_gone == 1 and not any("1970-01-01" in f for f in files_of(table))
    for room in list(tree.iterdir()):
        for f in list(room.iterdir()):
            f.unlink()
    done = refresh(spark, str(tree), str(table))
    assert done.files_gone == 14 and files_of(table) == set()


def test_a_failed_refresh_is_repeated(spark, tree, tmp_path, monkeypatch):
    from sensorflow.plans import maintain

    table = tmp_path / "wide"
    refresh(spark, str(tree), str(table))
    room_files(tree, "c", [1, 5], 4)

    def stop(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(maintain, "_publish", stop)
        with pytest.raises(OSError):
            refresh(spark, str(tree), str(table))
    done = refresh(spark, str(tree), str(table))
    assert done.files_changed == 5 and table_rows(spark, table) == rebuilt(spark, tree)


def test_a_listing_reads_no_content(spark, tree):
    plan = list_files(spark, str(tree))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
