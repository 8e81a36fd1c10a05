"""Change-driven reload, repeatable appends, and checks measured inside writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meridian.plans import pipeline as pl
from meridian.plans import quality as dq
from meridian.plans import star
from meridian.plans.reload import reload_changed
from meridian.session import scratch_dir
from meridian.sources import ledger, versions
from meridian.sources.sinks import write_observed, write_parquet
from tests.conftest import rows

REVIEWS = "review_id string, business_id string, user_id string, date string, stars double, useful long, cool long, funny long, text string"
CHECKINS = "business_id string, date timestamp_ntz"


def review(i, day, stars=3.0, business="B1"):
    return (f"r{i}", business, "U1", day, stars, 1, 1, 1, "t")


def test_reload_rebuilds_changed_days_only(spark):
    fact, marks = scratch_dir(spark, "t-fact"), scratch_dir(spark, "t-marks")
    old = [review(i, f"2020-01-{i:02d}") for i in range(1, 11)] + [review(50, None)]
    seen = [("B1", dt.datetime(2020, 1, 4)), ("B1", None)]
    load = lambda r, c: reload_changed(spark, fact, marks, spark.createDataFrame(r, REVIEWS), spark.createDataFrame(c, CHECKINS))
    assert load(old, seen) is None
    first = set(versions.current(spark, fact).folders)
    assert load(old[::-1], seen) == [] and versions.current(spark, fact).number == 1       # another order is no change
    # an edit, a late row, a day gone, a check-in more, a second row without a day
    new = [review(1, "2020-01-01", 5.0), *old[1:5], *old[6:], review(20, "2020-01-03"), review(51, None)]
    seen2 = [*seen, ("B1", dt.datetime(2020, 1, 8)), ("B1", dt.datetime(2020, 1, 8, 5))]
    day = lambda n: dt.date(2020, 1, n)
    assert set(load(new, seen2)) == {day(1), day(3), day(6), day(8), None}
    want = star.fact_reviews(spark.createDataFrame(new, REVIEWS), spark.createDataFrame(seen2, CHECKINS))
    got = versions.read_table(spark, fact).select(*want.columns)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(want)
    v = versions.current(spark, fact)
    assert first < set(v.folders) and v.folders[min(first)] == {day(n) for n in (2, 4, 5, 7, 9, 10)}
    # rows that repeat count; a table that becomes empty
    assert load([*new, new[1]], seen2) == [day(2)]
    assert versions.read_table(spark, fact).where(F.col("date") == day(2)).count() == 2
    load([], [])
    assert versions.read_table(spark, fact).count() == 0


def test_reload_that_stops_before_its_marks_is_repeated(spark, monkeypatch):
    fact, marks = scratch_dir(spark, "t-fact"), scratch_dir(spark, "t-marks")
    c = spark.createDataFrame([], CHECKINS)
    reload_changed(spark, fact, marks, spark.createDataFrame([review(1, "2020-01-01")], REVIEWS), c)
    new = spark.createDataFrame([review(1, "2020-01-01", 4.0)], REVIEWS)
    with monkeypatch.context() as m:
        m.setattr(versions, "create_table", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            reload_changed(spark, fact, marks, new, c)
    assert reload_changed(spark, fact, marks, new, c) == [dt.date(2020, 1, 1)]
    assert rows(versions.read_table(spark, fact), "review_id", "stars") == [("r1", 4.0)]
    assert reload_changed(spark, fact, marks, new, c) == []


def test_batches_are_loaded_once(spark, monkeypatch):
    p = scratch_dir(spark, "t-ledger")
    schema = "k string, v int"
    df = spark.createDataFrame([("a", 1), ("b", None), ("b", None)], schema)
    assert rows(ledger.read_batches(spark, p, df.schema)) == []
    first = ledger.append_batch(df, p, "day/1")
    assert first.rows == 3
    again = ledger.append_batch(df.orderBy(F.desc("k")).repartition(3).select("v", "k"), p, "day/1")
    assert again == first
    with monkeypatch.context() as m:                     # rows are written, the entry is not
        m.setattr(ledger, "_create", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            ledger.append_batch(df, p, "day/2")
    assert len(rows(ledger.read_batches(spark, p, df.schema))) == 3
    ledger._create(spark, f"{p}/_ledger/day%2F2.json", "")            # an entry whose writer stopped before filling it
    ledger.append_batch(df.where("k = 'a'"), p, "day/2")
    ledger.append_batch(df.limit(0), p, "none")
    got = ledger.read_batches(spark, p, df.schema)
    assert sorted(map(str, rows(got.select("k", "batch")))) == ["('a', 'day/1')", "('a', 'day/2')", "('b', 'day/1')", "('b', 'day/1')"]
    assert rows(ledger.read_batches(spark, p, df.schema, {"day/2"}), "k") == [("a",)]
    for other in ([("a", 1), ("b", None)], [("a", None), ("b", 1), ("b", None)]):
        with pytest.raises(ledger.BatchChanged):
            ledger.append_batch(spark.createDataFrame(other, schema), p, "day/1")


def test_metrics_of_a_write_need_no_other_scan(spark, monkeypatch):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.current_timestamp()).alias("t"), (F.col("id") % 3).alias("day"))
    for by in (None, ["day"]):
        seen = write_observed(df, scratch_dir(spark, "t-seen"), {"n": dq.observed_nonempty(), "nulls": dq.observed_nulls("t")}, partition_by=by)
        assert seen == {"n": 1000 / 1000.001, "nulls": 100.0}
    empty = write_observed(df.limit(0), scratch_dir(spark, "t-seen"), {"n": dq.observed_nonempty()})
    assert empty["n"] == 0.0
    # load_dimensions: its checks come from the writes, no table it wrote is read
    wh = pl.Warehouse(scratch_dir(spark, "t-wh"))
    weather = spark.createDataFrame([("2020-01-01T00:00:00", "L", "c", 1.0, "S", 0.0, 0.0, 0.0)],
                                    "date string, location_id string, city_name string, average_temp double, station string, long double, lat double, prcp double")
    monkeypatch.setattr(pl.stg, "read_weather_table", lambda *_: weather)
    monkeypatch.setattr(dq, "nonempty_measure", lambda *_: pytest.fail("a table was read again"))
    business = spark.createDataFrame([("B", "n", "a", 0.0, 0.0, "c", "1", 1, 3.0)],
                                     "business_id string, name string, address string, latitude double, longitude double, categories string, "
                                     "restaurants_price_range string, review_count long, stars double")
    users = spark.createDataFrame([("U", 3.0, 1, 1, dt.datetime(2020, 1, 1)), ("V", 3.0, 1, 1, None)],
                                  "user_id string, average_stars double, review_count long, useful long, yelping_since timestamp_ntz")
    friends = spark.createDataFrame([("U", "V")], "user_id string, friend_id string")
    res = {r.check: (r.value, r.passed) for r in pl.load_dimensions(spark, wh, business, users, friends, raise_on_failure=False).collect()}
    assert res["dim_users_no_null_time"] == (1.0, False)
    assert all(res[f"{t}_nonempty"][1] for t in ("dim_users", "dim_business", "dim_weather"))
    assert res["dim_users_nonempty"][0] == 2 / 2.001
