import datetime as dt


from meridian.operators import anti_join
from meridian.plans import staging as stg
from meridian.session import scratch_dir
from meridian.sources import versions
from meridian.sources.sinks import replace_date_range, write_parquet
from tests.conftest import rows

W = "date string, location_id string, city_name string, average_temp double, station string, " \
    "long double, lat double, prcp double"


def test_upsert_update_insert_untouched_and_duplicate_key(spark):
    path = scratch_dir(spark, "t-upsert")
    stg.create_weather_table(path, spark.createDataFrame([
        ("2021-01-01T00:00:00", "L", "old", 1.0, "S1", 1.0, 1.0, 0.0),   # updated
        ("2021-01-01T00:00:00", "L", "keep", 2.0, "S2", 1.0, 1.0, 0.0),  # untouched
    ], W))
    landing = spark.createDataFrame([
        ("2021-01-01T00:00:00", "L", "new", 5.0, "S1", 1.0, 1.0, 0.0),
        ("2021-01-01T00:00:00", "L", "new", 6.0, "S1", 1.0, 1.0, 0.0),   # duplicate key
        ("2021-01-02T00:00:00", "L", "ins", 7.0, "S1", 1.0, 1.0, 0.0),   # inserted
    ], W)
    for _ in range(2):                                                    # twice: same result
        stg.upsert_weather(spark, path, landing)
        assert rows(stg.read_weather_table(spark, path), "date", "station", "city_name", "average_temp") == [
            ("2021-01-01T00:00:00", "S1", "new", 6.0),
            ("2021-01-01T00:00:00", "S2", "keep", 2.0),
            ("2021-01-02T00:00:00", "S1", "ins", 7.0),
        ]


def test_anti_join(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "z")], "k int, v string")
    assert rows(anti_join(a, b, ["k"])) == [(1, "x")]


def test_upsert_rewrites_only_touched_days(spark):
    path = scratch_dir(spark, "t-upsert")
    stg.create_weather_table(path, spark.createDataFrame([
        ("2021-01-01T00:00:00", "L", "a", 1.0, "S1", 1.0, 1.0, 0.0),
        ("2021-01-02T00:00:00", "L", "b", 2.0, "S1", 1.0, 1.0, 0.0),
    ], W))
    (first,) = versions.current(spark, path).folders
    landing = spark.createDataFrame([("2021-01-02T00:00:00", "L", "B", 3.0, "S1", 1.0, 1.0, 0.0)], W)
    stg.upsert_weather(spark, path, landing)
    stg.upsert_weather(spark, path, landing)
    out = stg.read_weather_table(spark, path)
    assert rows(out, "date", "city_name", "average_temp") == [
        ("2021-01-01T00:00:00", "a", 1.0), ("2021-01-02T00:00:00", "B", 3.0)]
    assert versions.current(spark, path).folders[first] == {dt.date(2021, 1, 1)}


def test_replace_date_range_empties_days_without_new_rows(spark):
    path = scratch_dir(spark, "t-range")
    old = spark.createDataFrame([(dt.date(2021, 1, d), f"r{d}", 1.0) for d in (1, 2, 3, 4)],
                                "date date, review_id string, checkin_count double")
    write_parquet(old, path, partition_by=["date"])
    new = spark.createDataFrame([(dt.date(2021, 1, 2), "r2-new", 2.0)],
                                "date date, review_id string, checkin_count double")
    for _ in range(2):                      # reloading the same window is idempotent
        emptied = replace_date_range(spark, path, new, "date", dt.date(2021, 1, 2), dt.date(2021, 1, 3))
        assert emptied == [dt.date(2021, 1, 3)]
        got = rows(spark.read.parquet(path), "date", "review_id")
        assert got == [(dt.date(2021, 1, 1), "r1"), (dt.date(2021, 1, 2), "r2-new"),
                       (dt.date(2021, 1, 4), "r4")]


def test_anti_join_within_drops_other_days_only(spark):
    a = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 1), (None, 1), ("d3", None)], "day string, k int")
    b = spark.createDataFrame([("d1", 1), ("d4", 2), (None, 1), ("d3", None), ("d1", 1)], "day string, k int")
    want = rows_of(anti_join(a, b, ["day", "k"]))
    assert rows_of(anti_join(a, b, ["day", "k"], within=["day"])) == want and len(want) == 4


def rows_of(df):
    return sorted(map(str, df.collect()))
