"""Registered checks, star query, reports and stated-question analyses."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from meridian.functions import date_of_text
from meridian.plans import analyses as an
from meridian.plans import quality as dq
from meridian.plans import star
from meridian.plans.profiles import merge_profiles, read_profiles, store_profiles
from meridian.plans.registry import (SQL_DIM_USERS, SQL_DIM_WEATHER, SQL_FACT_CTES, SQL_HAVERSINE,
                                     SQL_MATCHED, register, round_doubles)
from meridian.session import scratch_dir
from meridian.sources import standins as si
from meridian.sources.readers import read_json
from meridian.sources.sinks import materialize
from meridian.sources.sorted_table import order_report, read_sorted, write_sorted
from meridian.sources.standin_sql import with_standins


def _fact(spark, d):
    return star.fact_reviews(si.review(spark, d), si.staged_checkin(spark, d))


def _dim_weather(spark, d):
    return star.dim_weather(si.business(spark, d), si.weather(spark, d))


def _dim_users(spark, d):
    return star.dim_users(si.staged_user(spark, d), si.friend(spark, d))


# --- quality checks ----------------------------------------------------------------------

@register("dq_unique_key", with_standins("""
SELECT 'stg_weather' AS check_table, CAST(count(DISTINCT date) AS DOUBLE) AS value
FROM (SELECT date, location_id, station FROM v_weather GROUP BY 1, 2, 3 HAVING count(*) > 1) q
UNION ALL
SELECT 'stg_review' AS check_table, CAST(count(DISTINCT review_id) AS DOUBLE) AS value
FROM (SELECT review_id FROM v_review GROUP BY 1 HAVING count(*) > 1) q"""))
def q_dq_unique_key(spark, d):
    return dq.labelled([
        ("stg_weather", dq.duplicate_key_measure(si.weather(spark, d),
                                                 ["date", "location_id", "station"], "date")),
        ("stg_review", dq.duplicate_key_measure(si.review(spark, d), ["review_id"], "review_id")),
    ])


@register("dq_missing_dates", with_standins("""
SELECT 'stg_weather' AS check_table,
       CAST(datediff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS DOUBLE) AS value
FROM (SELECT cast(substr(date, 1, 10) AS date) AS d FROM v_weather) q
UNION ALL
SELECT 'stg_checkin' AS check_table,
       CAST(datediff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS DOUBLE) AS value
FROM (SELECT cast(date AS date) AS d FROM v_checkin) q"""))
def q_dq_missing_dates(spark, d):
    return dq.labelled([
        # texts of the dates are made distinct before they are parsed
        ("stg_weather", dq.missing_days_measure(si.weather(spark, d).select("date").distinct(), date_of_text("date"))),
        ("stg_checkin", dq.missing_days_measure(si.staged_checkin(spark, d),
                                                F.col("date").cast("date"))),
    ])


_RATIO = "round(CAST(count(*) AS DOUBLE) / (CAST(count(*) AS DOUBLE) + 0.001), 6)"


@register("dq_nonempty", with_standins(f"""
SELECT 'dim_users' AS check_table, {_RATIO} AS value FROM v_user
UNION ALL SELECT 'dim_business' AS check_table, {_RATIO} AS value FROM v_business
UNION ALL SELECT 'dim_weather' AS check_table, {_RATIO} AS value FROM ({SQL_DIM_WEATHER}) q""",
                                      SQL_MATCHED))
def q_dq_nonempty(spark, d):
    return round_doubles(dq.labelled([
        ("dim_users", dq.nonempty_measure(_dim_users(spark, d))),
        ("dim_business", dq.nonempty_measure(star.dim_business(si.business(spark, d)))),
        ("dim_weather", dq.nonempty_measure(_dim_weather(spark, d))),
    ]))


@register("dq_reconcile", with_standins("""
SELECT count(*) FILTER (WHERE abs(allocated - staged) > 0.001) AS mismatched,
       CAST(coalesce(sum(staged) FILTER (WHERE allocated IS NULL), 0) AS BIGINT) AS unallocated_checkins
FROM (SELECT sum(a) AS allocated, sum(s) AS staged
      FROM (SELECT date, business_id, checkin_count AS a, NULL AS s FROM fact
            UNION ALL SELECT CAST(date AS DATE), business_id, NULL, 1 FROM v_checkin)
      GROUP BY date, business_id)""", SQL_FACT_CTES))
def q_dq_reconcile(spark, d):
    """Checks the written fact: its sums per (day, business) are partial on the
    scan, so a hot pair is not summed behind a join."""
    fact = materialize(spark, _fact(spark, d).select("date", "business_id", "checkin_count"), "fact-checked")
    return dq.checkin_reconciliation(fact, si.staged_checkin(spark, d))


# --- star query and reports -------------------------------------------------------------
STAR_DAY = "1996-01-15"

SQL_DIM_W_CTE = [*SQL_MATCHED, ("dimw", SQL_DIM_WEATHER), ("dimu", SQL_DIM_USERS),
                 *SQL_FACT_CTES]


@register("star_query", with_standins(f"""
SELECT date, business_id, user_id, review_id, f.useful, cool, funny, left(text, 30) AS text,
       v_business.name AS business_name, restaurants_price_range, average_temp, prcp, is_influencer, yelping_since
FROM (FROM fact WHERE date = DATE '{STAR_DAY}') f
JOIN dimu USING (user_id) JOIN v_business USING (business_id) JOIN dimw USING (date, business_id)
ORDER BY ALL LIMIT 5""", SQL_DIM_W_CTE))
def q_star_query(spark, d):
    return an.star_query(_fact(spark, d), star.dim_business(si.business(spark, d)),
                         _dim_weather(spark, d), _dim_users(spark, d), STAR_DAY)


@register("volume_report", with_standins("""
SELECT 'stg_review' AS table_name, count(*) AS row_count,
       min(cast(substr(date, 1, 10) AS date)) AS min_date, max(cast(substr(date, 1, 10) AS date)) AS max_date
FROM v_review
UNION ALL
SELECT 'stg_user' AS table_name, count(*) AS row_count,
       min(cast(cast(yelping_since AS timestamp) AS date)) AS min_date,
       max(cast(cast(yelping_since AS timestamp) AS date)) AS max_date
FROM v_user"""))
def q_volume_report(spark, d):
    return an.volume_report(si.review(spark, d), si.staged_user(spark, d))


@register("star_histogram", with_standins(
    "SELECT average_stars, count(*) AS n FROM v_user GROUP BY average_stars"))
def q_star_histogram(spark, d):
    """Profiling as SQL text over a temp view (the notebook style)."""
    si.user(spark, d).createOrReplaceTempView("users")
    return spark.sql("SELECT average_stars, count(*) AS n FROM users GROUP BY average_stars")


@register("category_share", with_standins("""
SELECT round(avg(CASE WHEN lower(categories) LIKE '%restaurant%' THEN 1.0 ELSE 0.0 END), 6) AS share,
       count(*) AS n_business FROM v_business"""))
def q_category_share(spark, d):
    return round_doubles(an.category_share(si.business(spark, d)))


_PROFILE_COLS = ["user_id", "name", "average_stars", "review_count", "useful", "yelping_since"]


@register("schema_profile", with_standins(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values "
    f"FROM v_user" for c in _PROFILE_COLS)))
def q_schema_profile(spark, d):
    return an.column_profile(si.staged_user(spark, d), _PROFILE_COLS)


# --- stated questions ------------------------------------------------------------------

@register("hot_day_reviews", with_standins("""
SELECT CASE WHEN round(W.average_temp, 6) > 35 THEN 'above' ELSE 'other' END AS temp_band,
       count(*) AS business_days, CAST(sum(P.n) AS BIGINT) AS reviews,
       round(CAST(sum(P.n) AS DOUBLE) / count(*), 6) AS reviews_per_business_day
FROM (SELECT date, business_id, count(*) AS n FROM fact GROUP BY 1, 2) P
JOIN dimw W ON P.date = W.date AND P.business_id = W.business_id
GROUP BY 1""", SQL_DIM_W_CTE))
def q_hot_day_reviews(spark, d):
    return round_doubles(an.hot_day_reviews(_fact(spark, d), _dim_weather(spark, d)))


@register("influencer_top", with_standins("""
SELECT A.business_id, count(DISTINCT A.user_id) AS influencer_reviewers, count(*) AS influencer_reviews
FROM fact A WHERE A.user_id IN (SELECT user_id FROM dimu WHERE is_influencer = 1)
GROUP BY A.business_id ORDER BY influencer_reviewers DESC, business_id LIMIT 10""", SQL_DIM_W_CTE))
def q_influencer_top(spark, d):
    return an.influencer_top(_fact(spark, d), _dim_users(spark, d))


@register("popular_cells", with_standins("""
SELECT CAST(floor(B.latitude) AS BIGINT) AS cell_lat, CAST(floor(B.longitude) AS BIGINT) AS cell_lon,
       count(*) AS n_business, CAST(coalesce(sum(R.r), 0) AS BIGINT) AS n_reviews,
       CAST(coalesce(sum(C.c), 0) AS BIGINT) AS n_checkins
FROM v_business B
LEFT JOIN (SELECT business_id, count(*) AS r FROM fact GROUP BY 1) R ON B.business_id = R.business_id
LEFT JOIN (SELECT business_id, count(*) AS c FROM v_checkin GROUP BY 1) C ON B.business_id = C.business_id
GROUP BY 1, 2""", SQL_FACT_CTES))
def q_popular_cells(spark, d):
    return an.popular_cells(si.business(spark, d), _fact(spark, d), si.staged_checkin(spark, d))


@register("weather_footfall", with_standins("""
SELECT CAST(floor(round(W.average_temp, 6) / 5.0) * 5.0 AS DOUBLE) AS temp_band, W.prcp > 0 AS rainy,
       count(*) AS business_days, CAST(coalesce(sum(N.n), 0) AS BIGINT) AS checkins,
       round(avg(coalesce(N.n, 0)), 6) AS avg_checkins
FROM dimw W LEFT JOIN (SELECT cast(date AS date) AS date, business_id, count(*) AS n
                       FROM v_checkin GROUP BY 1, 2) N
  ON W.date = N.date AND W.business_id = N.business_id
GROUP BY 1, 2""", SQL_DIM_W_CTE))
def q_weather_footfall(spark, d):
    return round_doubles(an.weather_footfall(_dim_weather(spark, d), si.staged_checkin(spark, d)))


@register("footfall_corr", with_standins("""
SELECT count(*) AS business_days, round(corr(average_temp, coalesce(n, 0)), 6) AS corr_temp,
       round(corr(prcp, coalesce(n, 0)), 6) AS corr_prcp
FROM dimw LEFT JOIN (SELECT CAST(date AS DATE) AS date, business_id, count(*) AS n FROM v_checkin GROUP BY ALL)
  USING (date, business_id)""", SQL_DIM_W_CTE))
def q_footfall_corr(spark, d):
    return round_doubles(an.footfall_corr(_dim_weather(spark, d), si.staged_checkin(spark, d)))


@register("weather_sorted_head", with_standins(
    "SELECT * FROM v_weather ORDER BY station, date, location_id LIMIT 20"))
def q_weather_sorted_head(spark, d):
    """First rows of the readings in (station, date) order (a top-k report)."""
    return an.sorted_head(si.weather(spark, d), ["station", "date", "location_id"], 20)


def _sums_by_station(batches):
    """A row per station and batch. The least of a text can't be kept in a hash aggregate of Spark, which would sort
    the readings again."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by("station").aggregate([([], "count_all"), ("date", "min"), ("date", "max"), ("prcp", "sum")])
        yield from t.select(["station", "count_all", "date_min", "date_max", "prcp_sum"]).to_batches()


@register("weather_sorted", with_standins("""
SELECT station, count(*) AS readings, min(date) AS first_date, max(date) AS last_date, sum(prcp) AS prcp,
       CAST(0 AS BIGINT) AS overlaps, CAST(0 AS BIGINT) AS breaks
FROM v_weather GROUP BY station"""))
def q_weather_sorted(spark, d):
    """The readings as a table in (station, date) order, and what breaks that order: files that
    overlap, rows that are smaller than the one in front."""
    path = scratch_dir(spark, "weather-sorted")
    write_sorted(si.weather(spark, d), path, ["station", "date", "location_id"], rows_per_file=500_000)
    report = materialize(spark, order_report(spark, path), "order")
    parts = (read_sorted(spark, path).select("station", "date", "prcp")
             .mapInArrow(_sums_by_station, "station string, readings bigint, first_date string, last_date string, prcp double"))
    return (parts.groupBy("station")
            .agg(F.sum("readings").alias("readings"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.sum("prcp").alias("prcp"))
            .select("*", report.select("overlaps").scalar().alias("overlaps"), report.select("breaks").scalar().alias("breaks")))


_REVIEW = ["review_id", "business_id", "user_id", "date", "stars", "useful", "cool", "funny", "text"]


@register("profile_merged", with_standins(" UNION ALL ".join(f"""
SELECT '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS nulls, min(cast({c} AS varchar)) AS lowest, max(cast({c} AS varchar)) AS highest,
       CASE WHEN count(DISTINCT {c}) < 256 THEN count(DISTINCT {c}) END AS few_values,
       CASE WHEN count(DISTINCT {c}) < 256 THEN (SELECT cast({c} AS varchar) FROM v_review GROUP BY {c} ORDER BY count(*) DESC, 1 LIMIT 1) END AS most_frequent,
       CASE WHEN count(DISTINCT {c}) < 256 THEN (SELECT count(*) FROM v_review GROUP BY {c} ORDER BY 1 DESC LIMIT 1) END AS times
FROM v_review""" for c in _REVIEW)))
def q_profile_merged(spark, d):
    """Profiles of the reviews, stored by month of the review and merged. Distinct and frequent values are
    given where a column has few, as the sketches are exact there."""
    path = scratch_dir(spark, "profiles")
    store_profiles(si.review(spark, d), path, F.substring("date", 1, 7))
    few, first = F.col("distinct") < 256, F.col("frequent").getItem(0)
    return (merge_profiles(read_profiles(spark, path))
            .select(F.col("column").alias("name"), F.col("rows").alias("n_rows"), "nulls", "lowest", "highest", F.when(few, F.col("distinct")).alias("few_values"),
                    F.when(few, first["value"]).alias("most_frequent"), F.when(few, first["count"]).alias("times")))


@register("user_head", with_standins(
    "SELECT user_id, name, average_stars, review_count, useful, yelping_since FROM v_user ORDER BY user_id LIMIT 5"))
def q_user_head(spark, d):
    return an.sorted_head(si.user(spark, d), ["user_id"], 5)


@register("dq_null_timestamps", with_standins("""
SELECT 'stg_checkin' AS check_table, CAST(count(*) FILTER (WHERE o_orderkey % 97 = 0) AS DOUBLE) AS value FROM orders"""))
def q_dq_null_timestamps(spark, d):
    """Unparsable check-in times are kept as NULL and counted: every 97th order's
    time arrives as text that is no time."""
    from meridian.plans import staging as stg
    o = si.table(spark, d, "orders")
    raw = o.select(F.concat(F.lit("B"), F.col("o_custkey").cast("string")).alias("business_id"),
                   F.when(F.col("o_orderkey") % 97 == 0, F.lit("not a time"))
                    .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("date"))
    return dq.labelled([("stg_checkin", dq.null_count_measure(stg.stage_checkins(raw), "date"))])


@register("dq_sql_text", with_standins("""
SELECT 'review_key_unique' AS "check", CAST(count(*) AS DOUBLE) AS value, 0.0::DOUBLE AS expected, count(*) = 0 AS passed
FROM (SELECT review_id FROM v_review GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'reviews_of_known_business', CAST(count(*) AS DOUBLE), 0.0::DOUBLE, count(*) = 0
FROM v_review WHERE business_id NOT IN (SELECT business_id FROM v_business)
UNION ALL
SELECT 'five_star_reviews', CAST(count(*) AS DOUBLE), 0.0::DOUBLE, count(*) = 0 FROM v_review WHERE stars = 5"""))
def q_dq_sql_text(spark, d):
    """Checks given as SQL text over temp views; the last one fails on purpose."""
    si.review(spark, d).createOrReplaceTempView("stg_review")
    si.business(spark, d).createOrReplaceTempView("stg_business")
    return dq.run_checks(spark, [
        dq.Check("review_key_unique", "SELECT count(*) FROM (SELECT review_id FROM stg_review GROUP BY 1 HAVING count(*) > 1)", 0),
        dq.Check("reviews_of_known_business", "SELECT count(*) FROM stg_review r LEFT ANTI JOIN stg_business b "
                 "ON r.business_id = b.business_id", 0),
        dq.Check("five_star_reviews", "SELECT count(*) FROM stg_review WHERE stars = 5", 0),
    ]).select("check", "value", "expected", "passed")


@register("local_competition", with_standins(f"""
SELECT B.business_id, trim(split_part(B.categories, ',', 1)) AS category,
       CAST(count(O.business_id) AS BIGINT) AS competitors
FROM v_business B LEFT JOIN v_business O
  ON trim(split_part(B.categories, ',', 1)) = trim(split_part(O.categories, ',', 1))
 AND B.business_id <> O.business_id
 AND {SQL_HAVERSINE.format(lat1='B.latitude', lon1='B.longitude', lat2='O.latitude', lon2='O.longitude')} <= 100
GROUP BY 1, 2"""))
def q_local_competition(spark, d):
    return an.local_competition(si.business(spark, d))


@register("city_reviews", with_standins("""
SELECT B.city, CAST(count(*) AS BIGINT) AS n_reviews, round(avg(A.stars), 6) AS avg_stars
FROM fact A JOIN v_business B ON A.business_id = B.business_id GROUP BY B.city""", SQL_FACT_CTES))
def q_city_reviews(spark, d):
    return round_doubles(an.city_reviews(_fact(spark, d), si.business(spark, d)))


_INFERRED = [("average_stars", "double"), ("name", "string"), ("review_count", "bigint"),
             ("useful", "bigint"), ("user_id", "string"), ("yelping_since", "string")]


@register("json_inferred", with_standins(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS inferred_type, count({c}) AS non_null, "
    f"count(DISTINCT {c}) AS distinct_values FROM v_user" for c, t in _INFERRED)))
def q_json_inferred(spark, d):
    """Raw user JSON read with a schema inferred from every record
    (samplingRatio = 1.0), then profiled; reports the inferred types."""
    from meridian.plans.queries_staging import _raw_user_path
    raw = read_json(spark, _raw_user_path(spark, d), None, sampling_ratio=1.0)
    cols = [c for c, _ in _INFERRED]
    types = dict((f.name, f.dataType.simpleString()) for f in raw.schema.fields)
    prof = an.column_profile(raw, cols)
    mapping = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return prof.select("column_name", mapping[F.col("column_name")].alias("inferred_type"),
                       "non_null", "distinct_values")


# --- the daily jobs end to end, reporting every check ---------------------------------
PIPE_DS = "1996-02-02"          # look-back covers 1996-01-29 … 1996-01-31
PIPE_FACT = ("1996-01-14", "1996-01-15")


@register("daily_pipeline", with_standins(f"""
SELECT 'weather_key_unique' AS "check", CAST(count(DISTINCT date) AS DOUBLE) AS value,
       CAST(0 AS DOUBLE) AS expected, count(DISTINCT date) = 0 AS passed
FROM (SELECT date, location_id, station FROM v_weather GROUP BY 1, 2, 3 HAVING count(*) > 1) q
UNION ALL
SELECT 'weather_no_missing_day', CAST(datediff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS DOUBLE),
       CAST(0 AS DOUBLE), datediff('day', min(d), max(d)) + 1 - count(DISTINCT d) = 0
FROM (SELECT cast(substr(date, 1, 10) AS date) AS d FROM v_weather) q
UNION ALL
SELECT t || '_nonempty', round(CAST(n AS DOUBLE) / (CAST(n AS DOUBLE) + 0.001), 6), CAST(1 AS DOUBLE),
       abs(1.0 - CAST(n AS DOUBLE) / (CAST(n AS DOUBLE) + 0.001)) <= 0.001
FROM (SELECT 'dim_users' AS t, count(*) AS n FROM v_user
      UNION ALL SELECT 'dim_business', count(*) FROM v_business
      UNION ALL SELECT 'dim_weather', count(*) FROM dimw) c
UNION ALL
SELECT 'dim_users_no_null_time', CAST(count(*) AS DOUBLE), CAST(0 AS DOUBLE), count(*) = 0
FROM v_user WHERE yelping_since IS NULL
UNION ALL
SELECT 'fact_checkins_reconcile', CAST(count(*) AS DOUBLE), CAST(0 AS DOUBLE), count(*) = 0
FROM (SELECT date, business_id, sum(checkin_count) AS f FROM fact
      WHERE date BETWEEN DATE '{PIPE_FACT[0]}' AND DATE '{PIPE_FACT[1]}' GROUP BY 1, 2) a
JOIN (SELECT cast(date AS date) AS date, business_id, count(*) AS s FROM v_checkin
      WHERE cast(date AS date) BETWEEN DATE '{PIPE_FACT[0]}' AND DATE '{PIPE_FACT[1]}' GROUP BY 1, 2) b
  ON a.date = b.date AND a.business_id = b.business_id
WHERE abs(a.f - b.s) > 0.001""", SQL_DIM_W_CTE))
def q_daily_pipeline(spark, d):
    """Weather look-back + upsert, dimensions, fact window, each with checks."""
    import datetime as _dt
    from meridian.plans import pipeline as pl
    from meridian.plans import staging as stg
    from meridian.session import scratch_dir
    wh = pl.Warehouse(scratch_dir(spark, "warehouse"))
    w = si.weather(spark, d, by_month=True)
    stg.create_weather_table(wh.path("stg_weather"), w.where(~F.substring("date", 1, 10).between("1996-01-29", "1996-01-31")), dealt=True)
    days = wh.path("day_files")
    stg.write_day_files(w, days, dealt=True)
    ds = _dt.date.fromisoformat(PIPE_DS)
    lo, hi = (_dt.date.fromisoformat(x) for x in PIPE_FACT)
    results = [
        pl.weather_daily(spark, wh, days, ds, raise_on_failure=False),
        pl.load_dimensions(spark, wh, si.business(spark, d), si.staged_user(spark, d),
                           si.friend(spark, d), raise_on_failure=False),
        pl.load_fact_window(spark, wh, si.review(spark, d), si.staged_checkin(spark, d), lo, hi,
                            raise_on_failure=False),
    ]
    out = results[0].unionByName(results[1]).unionByName(results[2])
    return round_doubles(out.select("check", "value", "expected", "passed"))
