"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query takes (spark, sf_dir), reads the driver's tables through the
stand-ins and returns a DataFrame. Floating results are rounded to 6 places
on both sides so order-insensitive value hashes are stable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.sources import standins as si
from meridian.sources.standin_sql import with_standins
from meridian.plans import star

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# Shared SQL fragments -------------------------------------------------------
SQL_HAVERSINE = ("2 * 6371.0088 * asin(sqrt(least(1.0, "
                 "pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
                 "cos(radians({lat1})) * cos(radians({lat2})) * "
                 "pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))")

# The oracles are written from the definitions, by other means than the plans:
# ranks by counting what is closer, shares by dividing counts per key.
SQL_MATCHED = [
    ("sites", "SELECT station, long, lat FROM v_weather GROUP BY ALL"),
    ("near", "SELECT DISTINCT p.business_id, p.longitude, p.latitude, q.station, round("
             + SQL_HAVERSINE.format(lat1="p.latitude", lon1="p.longitude", lat2="q.lat", lon2="q.long")
             + ") AS dist FROM v_business p, sites q WHERE abs(p.latitude - q.lat) < 1 AND dist < 50"),
    ("matched", """
SELECT n.business_id, n.longitude, n.latitude, n.station, n.dist, 1 + count(closer.station) AS rid
FROM near n LEFT JOIN near closer
  ON closer.business_id = n.business_id AND (closer.dist, closer.station) < (n.dist, n.station)
GROUP BY n.business_id, n.longitude, n.latitude, n.station, n.dist
HAVING count(closer.station) < 3"""),
]

SQL_FACT_CTES = [
    ("visits", "SELECT CAST(date AS DATE) AS day, business_id, count(*) AS visits FROM v_checkin GROUP BY ALL"),
    ("written", "SELECT CAST(left(date, 10) AS DATE) AS day, business_id, count(*) AS reviews FROM v_review GROUP BY ALL"),
    ("shares", "SELECT day, business_id, CAST(visits AS DOUBLE) / reviews AS share "
               "FROM visits JOIN written USING (day, business_id)"),
    ("fact", """
SELECT r.day AS date, r.business_id, user_id, review_id, stars, useful, cool, funny, text,
       ifnull(share, 0.0) AS checkin_count
FROM (SELECT *, CAST(left(date, 10) AS DATE) AS day FROM v_review) r
LEFT JOIN shares ON shares.day = r.day AND shares.business_id = r.business_id"""),
]

SQL_DIM_USERS = """
SELECT u.user_id, u.average_stars, CAST(friends_count > 50 AS INTEGER) AS is_influencer, friends_count,
       u.review_count, u.useful, CAST(u.yelping_since AS TIMESTAMP) AS yelping_since
FROM (SELECT *, (SELECT count(*) FROM v_friend f WHERE f.user_id = v_user.user_id) AS friends_count
      FROM v_user) u"""

SQL_DIM_WEATHER = """
SELECT CAST(left(w.date, 10) AS DATE) AS date, matched.business_id,
       sum(w.average_temp) / count(w.average_temp) AS average_temp, sum(w.prcp) / count(w.prcp) AS prcp,
       sum(w.long) / count(w.long) AS avglong, sum(w.lat) / count(w.lat) AS avglat,
       sum(matched.dist) / count(*) AS avgdist
FROM matched JOIN v_weather w USING (station)
GROUP BY 1, 2"""


# Star schema -----------------------------------------------------------------
def _fact(spark, d, lo=None, hi=None):
    return star.fact_reviews(si.review(spark, d), si.staged_checkin(spark, d), lo, hi)


@register("fact_reviews_alloc", with_standins(
    "SELECT date, business_id, user_id, review_id, stars, useful, cool, funny, text, "
    "round(checkin_count, 6) AS checkin_count FROM fact", SQL_FACT_CTES))
def q_fact_reviews_alloc(spark, d):
    return round_doubles(_fact(spark, d))


@register("dim_users", with_standins(SQL_DIM_USERS))
def q_dim_users(spark, d):
    return star.dim_users(si.staged_user(spark, d), si.friend(spark, d))


@register("dim_business", with_standins(
    "SELECT business_id, name, address, latitude, longitude, categories, restaurants_price_range, "
    "review_count, stars FROM v_business"))
def q_dim_business(spark, d):
    return star.dim_business(si.business(spark, d))


@register("nearest_stations", with_standins(
    "SELECT business_id, longitude, latitude, station, dist, CAST(rid AS INTEGER) AS rid FROM matched",
    SQL_MATCHED))
def q_nearest_stations(spark, d):
    return star.nearest_stations(si.business(spark, d), si.weather(spark, d))


@register("dim_weather", with_standins(
    "SELECT date, business_id, round(average_temp, 6) AS average_temp, round(prcp, 6) AS prcp, "
    "round(avglong, 6) AS avglong, round(avglat, 6) AS avglat, round(avgdist, 6) AS avgdist "
    "FROM (" + SQL_DIM_WEATHER + ") q", SQL_MATCHED))
def q_dim_weather(spark, d):
    return round_doubles(star.dim_weather(si.business(spark, d), si.weather(spark, d)))


# Registered in their own modules (imported last: they use ``register``).
from meridian.plans import queries_staging  # noqa: E402,F401
from meridian.plans import queries_reports  # noqa: E402,F401
