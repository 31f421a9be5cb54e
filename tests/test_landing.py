"""Retention by whole days: what is kept, and which files stay as they were."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from scholaris.sources import landing

DAY = datetime(2024, 3, 10, 12)


def frame(spark, rows, kind="timestamp_ntz"):
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz").withColumn("ts", landing.F.col("ts").cast(kind))


def files_of(path):
    return {f.relative_to(path): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def drawn(n):
    rng = random.Random(4)
    return [(i, None if i % 50 == 0 else DAY - timedelta(hours=rng.randint(0, 30 * 24))) for i in range(n)]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_rows_and_files_that_stay(spark, tmp_path, kind):
    path, rows = str(tmp_path / "zone"), drawn(3000)
    df = frame(spark, rows, kind)
    landing.land(df, path, "ts")
    assert landing.read(spark, path, df.schema).count() == 3000 and len(landing.days(spark, path)) == 31
    before = files_of(path)
    done = landing.purge(spark, path, df.schema, "ts", DAY, 7)
    limit = DAY - timedelta(days=7)
    kept = [i for i, ts in rows if ts is None or ts >= limit]
    assert sorted(r.id for r in landing.read(spark, path, df.schema).collect()) == kept
    assert done == {"dropped": 23, "rewritten": 1}
    after, boundary = files_of(path), f"landed_on={limit.date()}"
    assert all(before.get(f) == t for f, t in after.items() if boundary not in str(f))
    assert landing.purge(spark, path, df.schema, "ts", DAY, 7) == {"dropped": 0, "rewritten": 0} and files_of(path) == after


def test_a_limit_at_midnight_rewrites_nothing(spark, tmp_path):
    path = str(tmp_path / "zone")
    df = frame(spark, [(1, datetime(2024, 3, 3)), (2, datetime(2024, 3, 2, 23, 59)), (3, None)])
    landing.land(df, path, "ts")
    assert landing.purge(spark, path, df.schema, "ts", datetime(2024, 3, 10), 7) == {"dropped": 1, "rewritten": 0}
    assert sorted(r.id for r in landing.read(spark, path, df.schema).collect()) == [1, 3]


def test_landings_add_up(spark, tmp_path):
    path = str(tmp_path / "zone")
    df = frame(spark, drawn(100))
    for _ in range(2):
        landing.land(df, path, "ts")
    assert landing.read(spark, path, df.schema).count() == 200
    assert landing.read(spark, str(tmp_path / "none"), df.schema).count() == 0
    assert landing.days(spark, str(tmp_path / "none")) == []


@pytest.mark.parametrize("broken", ["replace_folder", "finish"])
def test_a_purge_that_breaks_off_is_finished_later(spark, tmp_path, monkeypatch, broken):
    path, rows = str(tmp_path / "zone"), drawn(1000)
    df = frame(spark, rows)
    landing.land(df, path, "ts")
    act, calls = getattr(landing, broken), []

    def stops(*args):
        calls.append(args)
        if broken == "replace_folder" or len(calls) == 2:
            raise OSError("gone")
        return act(*args)

    monkeypatch.setattr(landing, broken, stops)
    with pytest.raises(OSError, match="gone"):
        landing.purge(spark, path, df.schema, "ts", DAY, 7)
    monkeypatch.undo()
    assert landing.purge(spark, path, df.schema, "ts", DAY, 7) == {"dropped": 0, "rewritten": 0}
    kept = [i for i, ts in rows if ts is None or ts >= DAY - timedelta(days=7)]
    assert sorted(r.id for r in landing.read(spark, path, df.schema).collect()) == kept


def test_a_hot_day_has_more_than_one_file(spark, tmp_path, partitions):
    partitions(8)
    path = str(tmp_path / "zone")
    rows = [(i, DAY + timedelta(seconds=i) if i % 3 else DAY - timedelta(days=i % 30)) for i in range(6000)]
    landing.land(frame(spark, rows), path, "ts")
    assert len(list(Path(path, f"landed_on={DAY.date()}").glob("*.parquet"))) >= 3
