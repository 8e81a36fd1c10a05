"""Star schema: business, user and weather dimensions and the review fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions import date_of_text
from meridian.operators import allocate_evenly, nearest_k
from meridian.schemas import (DIM_BUSINESS_COLS, DIM_USER_COLS, DIM_WEATHER_COLS,
                              FACT_REVIEW_COLS)
from meridian.sources.sinks import materialize

INFLUENCER_MIN_FRIENDS = 50   # strictly more than this many distinct friends
NEAREST_STATIONS = 3
STATION_MAX_KM = 50
#: Rows (of about 100 bytes) that a join may broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS = 300_000


def dim_business(stg_business: DataFrame) -> DataFrame:
    """Business dimension: a column subset (pruned at the scan)."""
    return stg_business.select(*DIM_BUSINESS_COLS)


def friend_counts(stg_friend: DataFrame) -> DataFrame:
    """Distinct friends per user. Spark plans countDistinct as a two-level
    aggregate whose first shuffle is keyed on (user, friend), so a user with a
    huge list is spread over many tasks."""
    return stg_friend.groupBy("user_id").agg(F.countDistinct("friend_id").alias("friend_cnt"))


def dim_users(stg_user: DataFrame, stg_friend: DataFrame) -> DataFrame:
    fc = friend_counts(stg_friend)
    j = stg_user.join(fc, on="user_id", how="left")
    n = F.coalesce(F.col("friend_cnt"), F.lit(0)).cast("bigint")
    return j.select(
        "user_id", "average_stars",
        F.when(n > INFLUENCER_MIN_FRIENDS, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("is_influencer"),
        n.alias("friends_count"), "review_count", "useful", "yelping_since",
    ).select(*DIM_USER_COLS)


def weather_stations(stg_weather: DataFrame) -> DataFrame:
    """Distinct (station, long, lat) of the weather table."""
    return stg_weather.select("station", "long", "lat").distinct()


def nearest_stations(stg_business: DataFrame, stg_weather: DataFrame, *,
                     k: int = NEAREST_STATIONS, max_km: float = STATION_MAX_KM) -> DataFrame:
    """For each business, up to ``k`` stations under ``max_km`` (rounded km),
    ranked by (rounded distance, station id).

    Output: business_id, longitude, latitude, station, dist, rid.
    """
    b = stg_business.select("business_id", F.col("longitude").cast("double").alias("longitude"),
                            F.col("latitude").cast("double").alias("latitude"))
    s = weather_stations(stg_weather).select(
        "station", F.col("long").cast("double").alias("s_long"),
        F.col("lat").cast("double").alias("s_lat"))
    return nearest_k(b, s, k=k, max_km=max_km, point_key=["business_id"], site_key="station",
                     point_lat="latitude", point_lon="longitude", site_lat="s_lat",
                     site_lon="s_long", dist_col="dist", rank_col="rid")


def dim_weather(stg_business: DataFrame, stg_weather: DataFrame, *,
                matched: DataFrame | None = None) -> DataFrame:
    """Per business and day: averages of the readings of its nearest stations.

    Readings join matched stations on the station id alone, so a station
    listed under several locations counts once per listing (as in the
    source's model). The matched set (at most k rows per business) is written and
    counted: it is broadcast while small, so that readings without a business are
    dropped where they are read.
    """
    m = nearest_stations(stg_business, stg_weather) if matched is None else matched
    m = materialize(stg_weather.sparkSession, m.select("business_id", "station", "dist"), "matched-stations")
    j = _matched_readings(stg_weather.select("date", "station", "average_temp", "prcp", "long", "lat"), m)
    # a reading's text is parsed after the join, when most readings are gone
    return (j.withColumn("date", date_of_text("date")).groupBy("date", "business_id")
             .agg(F.avg("average_temp").alias("average_temp"), F.avg("prcp").alias("prcp"),
                  F.avg(F.col("long").cast("double")).alias("avglong"),
                  F.avg(F.col("lat").cast("double")).alias("avglat"),
                  F.avg("dist").alias("avgdist"))
             .select(*DIM_WEATHER_COLS))


def _matched_readings(readings: DataFrame, matched: DataFrame) -> DataFrame:
    """``readings`` joined to ``matched`` (a written table) on the station."""
    if matched.count() <= BROADCAST_ROWS:
        return readings.join(F.broadcast(matched), on="station", how="inner")
    wanted = matched.select("station").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        readings = readings.join(F.broadcast(wanted), on="station", how="left_semi")
    return readings.join(matched.hint("merge"), on="station", how="inner")


def daily_checkins(stg_checkin: DataFrame) -> DataFrame:
    """Check-ins per (day, business): a partial aggregate (map-side combine)."""
    return (stg_checkin.groupBy(F.col("date").cast("date").alias("date"), "business_id")
                       .agg(F.count(F.lit(1)).alias("checkin_count")))


def fact_reviews(stg_review: DataFrame, stg_checkin: DataFrame,
                 lo=None, hi=None) -> DataFrame:
    """Review fact: each review gets its day's check-ins divided evenly over
    that day's reviews of the same business (0 when the day had none).

    With ``lo``/``hi`` only that inclusive day window is built; the filter is
    applied to both inputs before any shuffle.
    """
    r = stg_review.withColumn("date", date_of_text("date"))
    c = daily_checkins(stg_checkin)
    if lo is not None:
        r = r.where(F.col("date").between(F.lit(lo), F.lit(hi)))
        c = c.where(F.col("date").between(F.lit(lo), F.lit(hi)))
    out = allocate_evenly(r, c, ["date", "business_id"], "checkin_count", "checkin_count")
    return out.select(*FACT_REVIEW_COLS)
