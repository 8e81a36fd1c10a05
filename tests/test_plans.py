"""Plan-shape tests: the scale properties the design relies on."""

import contextlib
import datetime as dt
import io
import os

import pytest
from pyspark.sql import functions as F

from meridian.plans import staging as stg
from meridian.plans import star
from meridian.sources import versions
from meridian.plans.registry import QUERIES, round_doubles
from meridian.session import scratch_dir
from meridian.sources import standins as si
from tests.conftest import SF_SMALL, rows


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_top_k_is_limited_before_the_shuffle(static_plans):
    p = plan(QUERIES["nearest_stations"](static_plans, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p
    # the partial limit sits below the exchange on business_id
    part = p.index("Partial")
    assert p.rfind("Exchange hashpartitioning(business_id", 0, part) != -1
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fact_shuffles_review_rows_once(static_plans):
    p = plan(QUERIES["fact_reviews_alloc"](static_plans, SF_SMALL))
    lines = p.splitlines()
    row_shuffles = []
    for i, l in enumerate(lines):
        if "Exchange hashpartitioning" in l:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            if "partial_" not in below:          # not a map-side-combined aggregate
                row_shuffles.append(l)
    assert len(row_shuffles) == 1, row_shuffles  # the reviews, keyed on (date, business)
    assert "date" in row_shuffles[0] and "business_id" in row_shuffles[0]
    assert "Window" not in p                     # no per-key window gathering a hot key


def test_star_query_day_filter_reaches_scans(static_plans):
    p = plan(QUERIES["star_query"](static_plans, SF_SMALL))
    # every review scan (the lineitem scans that read ship dates) filters by the day
    review_scans = [l for l in p.splitlines()
                    if "FileScan parquet" in l and "lineitem" in l and "l_shipdate#" in l]
    # (scan lines truncate long filter lists, so match the filter's start)
    assert review_scans and all("DataFilters: [(gettimestamp(substring(trim(cast(l_shipdate" in l
                                for l in review_scans)
    filters = [l for l in p.splitlines() if "Filter" in l and "1996-01-15" in l]
    assert len(filters) >= 2      # review side and weather side both filtered by the day


def test_lookback_read_prunes_partitions(spark):
    p_days = scratch_dir(spark, "t-plan-days")
    stg.write_day_files(si.weather(spark, SF_SMALL), p_days)
    p = plan(stg.read_day(spark, p_days, dt.date(1996, 1, 5)))
    assert "PartitionFilters: [isnotnull(year" in p


def test_upsert_reads_and_writes_only_touched_days(spark):
    """Folders without a touched day are not read; the new folder holds the touched day alone."""
    path = scratch_dir(spark, "t-plan-upsert")
    w = si.weather(spark, SF_SMALL).where("substring(date, 1, 4) = '1996'")
    stg.create_weather_table(path, w)
    day = dt.date.fromisoformat(w.agg(F.min(F.substring("date", 1, 10))).first()[0])
    later = w.agg(F.max(F.substring("date", 1, 10))).first()[0]
    landing = w.where(F.substring("date", 1, 10) == str(day)).withColumn("average_temp", F.lit(99.0))
    before = versions.current(spark, path)
    stg.upsert_weather(spark, path, landing)
    after = versions.current(spark, path)
    (old,), (new,) = before.folders, set(after.folders) - set(before.folders)
    assert after.folders == {old: before.folders[old] - {day}, new: frozenset([day])}
    assert sorted(os.listdir(os.path.join(path, old))) and spark.read.parquet(f"{path}/{new}").count() == landing.count()
    p = plan(versions.read_table(spark, path, only=[dt.date.fromisoformat(later)]))
    assert p.count("FileScan parquet") == 1 and f"PushedFilters: [IsNotNull(day_part), EqualTo(day_part,{later})]" in p
    got = stg.read_weather_table(spark, path).where(F.substring("date", 1, 10) == str(day))
    assert {r.average_temp for r in got.collect()} == {99.0}
    assert stg.read_weather_table(spark, path).count() == w.count()



def test_weather_is_the_same_dealt_by_month_and_no_join_broadcasts_it(spark, tmp_path):
    """Readings are joined to what they need where they are made: with repeated and missing keys and days."""
    d = str(tmp_path)
    spark.createDataFrame([(0,), (1,), (1,), (None,), (98,)], "p_partkey long").write.parquet(f"{d}/part.parquet")
    spark.sql("SELECT CAST(d AS timestamp_ntz) AS o_orderdate FROM VALUES ('1996-01-15 01:00:00'), ('1996-01-15'), ('1996-02-01'), (null) AS t(d)") \
         .write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(k, f"s{k}", 1) for k in range(4)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{d}/supplier.parquet")
    plain, by_month = si.weather(spark, d), si.weather(spark, d, by_month=True)
    assert plain.columns == by_month.columns and plain.count() == 5 * 3
    assert sorted(map(str, plain.collect())) == sorted(map(str, by_month.collect()))
    size = lambda df: df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert size(plain) > 1000 * size(si.station(spark, d))      # what the planner takes it for: no side to broadcast
    # a date reaches the days: no reading of another day is made
    one = plain.where(F.substring("date", 1, 10) == "1996-01-15")._jdf.queryExecution().optimizedPlan().toString()
    assert one.index("Join Cross") < one.index("= 1996-01-15")


def test_dim_weather_is_the_same_when_matched_stations_are_too_many_to_broadcast(spark, monkeypatch):
    b, w = si.business(spark, SF_SMALL).limit(20), si.weather(spark, SF_SMALL).where("date < '1995-01-05'")
    want = rows(round_doubles(star.dim_weather(b, w)))
    for limit in (30, 0):          # stations only; neither
        monkeypatch.setattr(star, "BROADCAST_ROWS", limit)
        assert rows(round_doubles(star.dim_weather(b, w))) == want and want


def test_a_task_holds_few_stations_and_their_texts_are_made_before_the_join(spark):
    """Groups of (day, station) of a task fit its memory, and a text of a station isn't made again for each day."""
    d = scratch_dir(spark, "t-stations")
    spark.range(8_000).select(F.col("id").alias("p_partkey")).write.parquet(f"{d}/part.parquet")
    spark.sql("SELECT timestamp_ntz'1996-01-01 00:00:00' AS o_orderdate").write.parquet(f"{d}/orders.parquet")
    assert si.spread_stations(spark, d).rdd.getNumPartitions() >= 20
    for by_month in (False, True):
        plan = si.weather(spark, d, by_month=by_month)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index("CITY:")
