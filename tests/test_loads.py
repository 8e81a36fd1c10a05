"""Load modes: what they must never lose or keep."""

import datetime as dt

import pytest

from meridian.plans import pipeline as pl
from meridian.session import apply_defaults, path_exists, scratch_dir
from meridian.sources import versions
from meridian.sources.sinks import write_parquet
from tests.conftest import rows

DAYS = "k string, v int, day date"


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_truncate_load_drops_old_partitions(spark, mode):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, mode)
    try:
        p = scratch_dir(spark, "t-truncate")
        df = spark.createDataFrame([("a", 1, dt.date(2020, 1, 1)), ("b", 2, dt.date(2020, 1, 2))], DAYS)
        write_parquet(df, p, partition_by=["day"])
        write_parquet(df.where("k = 'a'"), p, partition_by=["day"])
        assert rows(spark.read.parquet(p), "k") == [("a",)]
    finally:
        spark.conf.unset(key)


def day_table(spark, rows_):
    p = scratch_dir(spark, "t-version")
    versions.create_table(spark.createDataFrame(rows_, DAYS), p, "day", ["k"])
    return p


def test_upsert_keeps_rows_without_a_day(spark):
    p = day_table(spark, [("a", 1, None), ("b", 2, dt.date(2020, 1, 2)), ("c", 3, dt.date(2020, 1, 3))])
    new = spark.createDataFrame([("x", 9, None), ("b", 5, dt.date(2020, 1, 2))], DAYS)
    versions.upsert(spark, p, new, ["k"], ["v"])
    assert rows(versions.read_table(spark, p), "k", "v") == [("a", 1), ("b", 5), ("c", 3), ("x", 9)]


def test_empty_landing_changes_nothing(spark):
    p = day_table(spark, [("a", 1, dt.date(2020, 1, 1))])
    versions.upsert(spark, p, spark.createDataFrame([], DAYS), ["k"], ["v"])
    assert rows(versions.read_table(spark, p), "k", "v") == [("a", 1)]
    assert versions.current(spark, p).number == 1


def test_a_job_that_stops_before_publishing_leaves_the_old_table(spark, monkeypatch):
    p = day_table(spark, [("a", 1, dt.date(2020, 1, 1)), ("b", 2, dt.date(2020, 1, 2))])
    new = spark.createDataFrame([("a", 7, dt.date(2020, 1, 1)), ("n", 8, dt.date(2020, 1, 3))], DAYS)

    def stopped(*_):
        raise OSError("driver lost")
    monkeypatch.setattr(versions, "_publish", stopped)      # the data folder is written, the pointer is not
    with pytest.raises(OSError):
        versions.upsert(spark, p, new, ["k"], ["v"])
    assert rows(versions.read_table(spark, p), "k", "v") == [("a", 1), ("b", 2)]
    monkeypatch.undo()
    monkeypatch.setattr(versions, "_create", lambda s, path, text, f=versions._create: stopped() if path.endswith("02") else f(s, path, text))
    with pytest.raises(OSError):                             # the manifest is there too
        versions.upsert(spark, p, new, ["k"], ["v"])
    assert rows(versions.read_table(spark, p), "k", "v") == [("a", 1), ("b", 2)]
    monkeypatch.undo()
    versions._create(spark, f"{p}/_versions/000000000002", "")   # a pointer whose writer stopped before filling it in
    assert rows(versions.read_table(spark, p), "k", "v") == [("a", 1), ("b", 2)]
    for _ in range(2):
        versions.upsert(spark, p, new, ["k"], ["v"])
    assert rows(versions.read_table(spark, p), "k", "v") == [("a", 7), ("b", 2), ("n", 8)]
    assert rows(versions.read_table(spark, p, version=1), "k", "v") == [("a", 1), ("b", 2)]


def test_only_one_of_two_writers_publishes(spark):
    p = day_table(spark, [("a", 1, dt.date(2020, 1, 1))])
    v = versions.current(spark, p)
    versions._publish(spark, p, v.number, v)
    with pytest.raises(versions.ConcurrentWrite):
        versions._publish(spark, p, v.number, v)


def test_many_upserts_are_folded_into_one_folder(spark, monkeypatch):
    monkeypatch.setattr(versions, "MAX_FOLDERS", 2)
    p = day_table(spark, [(f"k{i}", i, dt.date(2020, 1, i)) for i in range(1, 6)])
    for i in range(1, 4):
        versions.upsert(spark, p, spark.createDataFrame([(f"k{i}", 10 * i, dt.date(2020, 1, i))], DAYS), ["k"], ["v"])
    assert len(versions.current(spark, p).folders) <= 2
    assert rows(versions.read_table(spark, p), "k", "v") == [("k1", 10), ("k2", 20), ("k3", 30), ("k4", 4), ("k5", 5)]


def test_versions_of_an_empty_table(spark):
    p = day_table(spark, [])
    assert rows(versions.read_table(spark, p)) == []
    versions.upsert(spark, p, spark.createDataFrame([("a", 1, None)], DAYS), ["k"], ["v"])
    assert rows(versions.read_table(spark, p), "k") == [("a",)]
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, scratch_dir(spark, "t-none"))


REVIEWS = "review_id string, business_id string, user_id string, date string, stars double, useful long, cool long, funny long, text string"


def test_failing_existence_test_leaves_the_fact(spark, monkeypatch):
    wh = pl.Warehouse(scratch_dir(spark, "t-wh"))
    review = spark.createDataFrame([(f"r{i}", "B1", "U1", f"2020-01-0{i}", 3.0, 1, 1, 1, "t") for i in range(1, 6)], REVIEWS)
    checkin = spark.createDataFrame([("B1", dt.datetime(2020, 1, 1))], "business_id string, date timestamp_ntz")
    assert not path_exists(spark, wh.path("fact_reviews"))
    pl.load_fact_window(spark, wh, review, checkin, dt.date(2020, 1, 1), dt.date(2020, 1, 5))

    def broken(*_):
        raise OSError("store not reachable")
    monkeypatch.setattr(pl, "path_exists", broken)
    with pytest.raises(OSError):
        pl.load_fact_window(spark, wh, review, checkin, dt.date(2020, 1, 2), dt.date(2020, 1, 3))
    monkeypatch.undo()
    assert spark.read.parquet(wh.path("fact_reviews")).count() == 5
    pl.load_fact_window(spark, wh, review, checkin, dt.date(2020, 1, 2), dt.date(2020, 1, 3))
    assert spark.read.parquet(wh.path("fact_reviews")).count() == 5


def test_defaults_leave_the_callers_settings(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "7m")
    apply_defaults(spark)
    assert spark.conf.get(key) == "7m"
    spark.conf.set(key, before)
