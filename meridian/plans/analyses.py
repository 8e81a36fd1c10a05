"""Star queries, volume / profile reports and the report's stated questions.

Large-side aggregates are computed before joining to dimensions (reviews per
business first, then per city), so the join sees one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions import date_of_text
from meridian.operators import count_within_radius

HOT_DAY_CELSIUS = 35.0
TEXT_PREVIEW = 30


def star_query(fact: DataFrame, dim_business: DataFrame, dim_weather: DataFrame,
               dim_users: DataFrame, day, limit: int = 5) -> DataFrame:
    """Reviews of one day with business name, weather and reviewer attributes.

    The day predicate sits on the join keys, so Catalyst pushes it into the
    fact and weather inputs (and to the scan of a day-partitioned table).
    """
    f = fact.where(F.col("date") == F.lit(day).cast("date"))
    w = dim_weather.where(F.col("date") == F.lit(day).cast("date"))
    j = (f.join(dim_business.select("business_id", F.col("name").alias("business_name"),
                                    "restaurants_price_range"), "business_id")
          .join(w.select("date", "business_id", "average_temp", "prcp"), ["date", "business_id"])
          .join(dim_users.select("user_id", "is_influencer", "yelping_since"), "user_id"))
    cols = ["date", "business_id", "user_id", "review_id", "useful", "cool", "funny"]
    out = j.select(*cols, F.substring("text", 1, TEXT_PREVIEW).alias("text"), "business_name",
                   "restaurants_price_range", "average_temp", "prcp", "is_influencer",
                   "yelping_since")
    # total order so the sample is stable; the limit is the report's feature
    return out.orderBy(*[F.col(c).asc_nulls_first() for c in out.columns]).limit(limit)


def volume_report(stg_review: DataFrame, stg_user: DataFrame) -> DataFrame:
    """Row count and first / last day of the review and user staging tables."""
    r = stg_review.select(date_of_text("date").alias("d"))
    u = stg_user.select(F.col("yelping_since").cast("date").alias("d"))

    def one(df, name):
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                      F.min("d").alias("min_date"), F.max("d").alias("max_date"))
    return one(r, "stg_review").unionByName(one(u, "stg_user"))


def value_histogram(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def category_share(stg_business: DataFrame, pattern: str = "%restaurant%") -> DataFrame:
    """Share of businesses whose lower-cased categories match ``pattern``;
    the denominator is the table's own row count."""
    hit = F.when(F.lower(F.col("categories")).like(pattern), 1.0).otherwise(0.0)
    return stg_business.agg(F.avg(hit).alias("share"), F.count(F.lit(1)).alias("n_business"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, non_null, distinct_values) for each column, one pass."""
    columns = list(columns or df.columns)
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"nn__{c}"), F.countDistinct(c).alias(f"nd__{c}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"),
                              F.col(f"nn__{c}").cast("bigint").alias("non_null"),
                              F.col(f"nd__{c}").cast("bigint").alias("distinct_values"))
                     for c in columns])
    return wide.select(F.explode(rows).alias("p")).select("p.*")


# --- stated questions -----------------------------------------------------------------


def hot_day_reviews(fact: DataFrame, dim_weather: DataFrame,
                    threshold: float = HOT_DAY_CELSIUS) -> DataFrame:
    """Reviews per business-day on days above ``threshold`` °C vs other days
    (business-days with weather and at least one review)."""
    per_day = fact.groupBy("date", "business_id").agg(F.count(F.lit(1)).alias("n"))
    j = per_day.join(dim_weather.select("date", "business_id", "average_temp"),
                     ["date", "business_id"])
    # compare the average rounded to 6 places: float sums differ in the last
    # bit with summation order, which must not move a day across the line
    t = F.round(F.col("average_temp"), 6)
    band = F.when(t > threshold, F.lit("above")).otherwise(F.lit("other"))
    return (j.groupBy(band.alias("temp_band"))
             .agg(F.count(F.lit(1)).alias("business_days"), F.sum("n").alias("reviews"))
             .withColumn("reviews_per_business_day",
                         F.col("reviews").cast("double") / F.col("business_days")))


def influencer_top(fact: DataFrame, dim_users: DataFrame, k: int = 10) -> DataFrame:
    """Businesses with the most distinct influencer reviewers (top ``k``)."""
    infl = dim_users.where(F.col("is_influencer") == 1).select("user_id")
    j = fact.select("business_id", "user_id").join(infl, "user_id", "left_semi")
    agg = j.groupBy("business_id").agg(F.countDistinct("user_id").alias("influencer_reviewers"),
                                       F.count(F.lit(1)).alias("influencer_reviews"))
    return agg.orderBy(F.col("influencer_reviewers").desc(), F.col("business_id")).limit(k)


def popular_cells(stg_business: DataFrame, fact: DataFrame, stg_checkin: DataFrame,
                  cell_deg: float = 1.0) -> DataFrame:
    """Reviews and check-ins per 1°×1° location cell (business counts too)."""
    rv = fact.groupBy("business_id").agg(F.count(F.lit(1)).alias("r"))
    ck = stg_checkin.groupBy("business_id").agg(F.count(F.lit(1)).alias("c"))
    b = stg_business.select(
        "business_id",
        F.floor(F.col("latitude").cast("double") / cell_deg).cast("bigint").alias("cell_lat"),
        F.floor(F.col("longitude").cast("double") / cell_deg).cast("bigint").alias("cell_lon"))
    j = b.join(rv, "business_id", "left").join(ck, "business_id", "left")
    return (j.groupBy("cell_lat", "cell_lon")
             .agg(F.count(F.lit(1)).alias("n_business"),
                  F.coalesce(F.sum("r"), F.lit(0)).cast("bigint").alias("n_reviews"),
                  F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_checkins")))


def weather_footfall(dim_weather: DataFrame, stg_checkin: DataFrame,
                     band_width: float = 5.0) -> DataFrame:
    """Check-ins per business-day by temperature band and rain (0 when none)."""
    daily = (stg_checkin.groupBy(F.col("date").cast("date").alias("date"), "business_id")
                        .agg(F.count(F.lit(1)).alias("n")))
    j = dim_weather.select("date", "business_id", "average_temp", "prcp").join(
        daily, ["date", "business_id"], "left")
    band = (F.floor(F.round(F.col("average_temp"), 6) / band_width) * band_width).cast("double")
    return (j.groupBy(band.alias("temp_band"), (F.col("prcp") > 0).alias("rainy"))
             .agg(F.count(F.lit(1)).alias("business_days"),
                  F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("checkins"),
                  F.avg(F.coalesce(F.col("n"), F.lit(0))).alias("avg_checkins")))


def footfall_corr(dim_weather: DataFrame, stg_checkin: DataFrame) -> DataFrame:
    """Correlation of temperature and of rain with check-ins per business-day (0 when none)."""
    daily = (stg_checkin.groupBy(F.col("date").cast("date").alias("date"), "business_id")
                        .agg(F.count(F.lit(1)).alias("n")))
    j = dim_weather.select("date", "business_id", "average_temp", "prcp").join(
        daily, ["date", "business_id"], "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    return j.agg(F.count(F.lit(1)).alias("business_days"), F.corr("average_temp", n).alias("corr_temp"),
                 F.corr("prcp", n).alias("corr_prcp"))


def sorted_head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in a global order (a partial top-n in every task)."""
    return df.orderBy(*order).limit(n).select(*[c for c in df.columns if c != "p_partkey"])


def primary_category(c) -> F.Column:
    return F.trim(F.split(F.col(c), ",").getItem(0))


def local_competition(stg_business: DataFrame, radius_km: float = 100.0) -> DataFrame:
    """Per business, other businesses of the same primary category within
    ``radius_km``. Counted with :func:`count_within_radius` (per-cell counts for
    cells wholly inside the circle, exact tests only on its edge), minus the
    business itself."""
    b = stg_business.select("business_id", primary_category("categories").alias("cat"),
                            F.col("latitude").cast("double").alias("lat"),
                            F.col("longitude").cast("double").alias("lon"))
    o = b.select(F.col("cat").alias("o_cat"), F.col("lat").alias("o_lat"),
                 F.col("lon").alias("o_lon"))
    n = count_within_radius(b, o, radius_km, left_key="business_id", left_lat="lat",
                            left_lon="lon", right_lat="o_lat", right_lon="o_lon",
                            extra_keys=[("cat", "o_cat")], out_col="__n")
    has_point = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("cat").isNotNull()
    return (b.join(n, "business_id")
             .select("business_id", F.col("cat").alias("category"),
                     (F.col("__n") - F.when(has_point, 1).otherwise(0)).cast("bigint")
                      .alias("competitors")))


def city_reviews(fact: DataFrame, stg_business: DataFrame) -> DataFrame:
    """Review count and average stars per business city (pre-aggregated per
    business before the join)."""
    per_b = fact.groupBy("business_id").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum("stars").alias("s"))
    j = per_b.join(stg_business.select("business_id", "city"), "business_id")
    return (j.groupBy("city").agg(F.sum("n").cast("bigint").alias("n_reviews"),
                                  (F.sum("s") / F.sum("n")).alias("avg_stars")))
