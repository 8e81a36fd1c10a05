import datetime as dt


from meridian.functions import cast_date_of_text, date_of_text, haversine_km, parse_timestamp, split_list


def test_split_list_trims_and_drops_blanks(spark):
    df = spark.createDataFrame([("a, b,c",), (None,), ("",), (" x ,, y",)], "s string")
    out = [r[0] for r in df.select(split_list("s").alias("l")).collect()]
    assert out == [["a", "b", "c"], None, [], ["x", "y"]]


def test_parse_timestamp_never_raises(spark):
    df = spark.createDataFrame([(" 2016-04-26 19:49:16",), ("x",), (None,)], "s string")
    out = [r[0] for r in df.select(parse_timestamp("s").alias("t")).collect()]
    assert out == [dt.datetime(2016, 4, 26, 19, 49, 16), None, None]


def test_date_of_text_both_separators(spark):
    df = spark.createDataFrame([("2020-12-27T05:06:07",), ("2020-12-27 17:00:00",), ("bad",)],
                               "s string")
    out = [r[0] for r in df.select(date_of_text("s")).collect()]
    assert out == [dt.date(2020, 12, 27), dt.date(2020, 12, 27), None]


def test_haversine_known_distance(spark):
    # one degree of longitude on the equator = 2*pi*R/360 km
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (10.0, 20.0, 10.0, 20.0)],
                               "a double, b double, c double, d double")
    out = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert abs(out[0] - 111.19508) < 1e-3
    assert out[1] == 0.0


def test_haversine_null_is_null(spark):
    df = spark.createDataFrame([(None, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    assert df.select(haversine_km("a", "b", "c", "d")).collect()[0][0] is None


def test_cast_date_of_text_reads_whole_dates_only_and_needs_no_formatter(spark):
    good = ["2020-02-29", " 2020-02-29T01", "0001-01-01", "9999-12-31 x", "2020-02-290"]
    bad = ["2021-02-29", "2021-1-5", "2021-01-5", "2021-01-5 10:00", "2021-01-1T", "2021", "2021-01", "+2021-01-0", "-001-01-01",
           "12021-01-0", "2021- 1-05", "2021-00-01", "2021/01/05", "", "today", "\t2021-01-05", "2021-01-0٥", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "s string").coalesce(1)
    out = [r[0] for r in df.select(cast_date_of_text("s")).collect()]
    assert out == [r[0] for r in df.select(date_of_text("s")).collect()] == [dt.date(2020, 2, 29), dt.date(2020, 2, 29), dt.date(1, 1, 1), dt.date(9999, 12, 31), dt.date(2020, 2, 29)] + [None] * len(bad)
    plan = df.select(cast_date_of_text("s"))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "gettimestamp" not in plan and "to_date" not in plan
