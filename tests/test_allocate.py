import datetime as dt

from pyspark.sql import functions as F

from meridian.plans.star import fact_reviews
from tests.conftest import rows


def _reviews(spark, data):
    return spark.createDataFrame(
        [(f"r{i}", b, f"u{i}", 4.0, 1, 0, 0, "t", d) for i, (b, d) in enumerate(data)],
        "review_id string, business_id string, user_id string, stars double, useful long, "
        "cool long, funny long, text string, date string")


def _checkins(spark, data):
    return spark.createDataFrame([(b, t) for b, t in data], "business_id string, date timestamp_ntz")


def test_seven_reviews_four_checkins(spark):
    r = _reviews(spark, [("B1", "2021-01-01 10:00:00")] * 7)
    c = _checkins(spark, [("B1", dt.datetime(2021, 1, 1, h)) for h in range(4)])
    f = fact_reviews(r, c)
    shares = [x[0] for x in f.select("checkin_count").collect()]
    assert len(shares) == 7
    assert all(abs(s - 4 / 7) < 1e-12 for s in shares)
    assert abs(sum(shares) - 4) < 0.001   # exact equality is not guaranteed (G2)


def test_review_without_checkin_gets_zero(spark):
    r = _reviews(spark, [("B1", "2021-01-01 10:00:00"), ("B2", "2021-01-02 10:00:00")])
    c = _checkins(spark, [("B1", dt.datetime(2021, 1, 1, 9)), ("B9", dt.datetime(2021, 1, 2, 9))])
    f = fact_reviews(r, c)
    assert rows(f, "business_id", "checkin_count") == [("B1", 1.0), ("B2", 0.0)]


def test_unparsable_dates_form_one_group(spark):
    r = _reviews(spark, [("B1", "garbage"), ("B1", "also bad"), ("B1", "2021-01-01 00:00:00")])
    c = _checkins(spark, [("B1", dt.datetime(2021, 1, 1))])
    f = fact_reviews(r, c)
    assert f.count() == 3           # NULL-date reviews are kept, not dropped
    assert rows(f.where(F.col("date").isNull()), "checkin_count") == [(0.0,), (0.0,)]


def test_date_window_filters_both_sides(spark):
    r = _reviews(spark, [("B1", "2021-01-01 00:00:00"), ("B1", "2021-01-05 00:00:00")])
    c = _checkins(spark, [("B1", dt.datetime(2021, 1, 1)), ("B1", dt.datetime(2021, 1, 5))])
    f = fact_reviews(r, c, dt.date(2021, 1, 1), dt.date(2021, 1, 2))
    assert rows(f, "date", "checkin_count") == [(dt.date(2021, 1, 1), 1.0)]
