"""Change-driven reload of the review fact.

Beside the fact stands a table of marks: per day, the number of its reviews and check-ins and
an order-free hash of each. A reload takes the marks of the staged tables (partial aggregates, one row a day after the
shuffle), rebuilds the days whose marks differ, however old, and publishes them as one version of
the fact. Days without a change stay in the files they are in. The marks are published after the fact, so a job
that stops in between rebuilds the same days again, with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions import date_of_text
from meridian.plans import star
from meridian.sources import versions
from meridian.sources.ledger import content_hash
from meridian.sources.sinks import materialize

_MARKS = ["reviews", "review_hash", "checkins", "checkin_hash"]


def day_marks(stg_review: DataFrame, stg_checkin: DataFrame) -> DataFrame:
    """Per day (rows without one are a day of their own): rows and content hash of both staged tables."""
    def marks(df, day, n, h):
        rows = df.withColumn("date", day)
        return rows.groupBy("date").agg(F.count(F.lit(1)).alias(n), content_hash(df).alias(h))
    r = marks(stg_review, date_of_text("date"), "reviews", "review_hash")
    c = marks(stg_checkin, F.col("date").cast("date"), "checkins", "checkin_hash")
    both = r.unionByName(c, allowMissingColumns=True).groupBy("date")
    return both.agg(*[F.max(m).alias(m) for m in _MARKS])        # one row of each table a day


def changed_days(marks: DataFrame, old: DataFrame) -> list:
    """Days whose marks differ, are new or are gone (a list of calendar days)."""
    was = old.select(F.col("date").alias("old_date"), F.lit(True).alias("was"), *[F.col(m).alias(f"old_{m}") for m in _MARKS])
    j = marks.withColumn("now", F.lit(True)).join(was, F.col("date").eqNullSafe(F.col("old_date")), "full_outer")
    differs = F.col("was").isNull() | F.col("now").isNull()
    for m in _MARKS:
        differs = differs | ~F.col(m).eqNullSafe(F.col(f"old_{m}"))
    day = F.when(F.col("now"), F.col("date")).otherwise(F.col("old_date"))
    return [r[0] for r in j.where(differs).select(day).collect()]


def reload_changed(spark: SparkSession, fact_root: str, marks_root: str, stg_review: DataFrame,
                   stg_checkin: DataFrame) -> list | None:
    """Brings the fact up to date with its inputs; returns the days it rebuilt (None: all, the first load)."""
    marks = materialize(spark, day_marks(stg_review, stg_checkin), "day-marks")
    first = versions.current(spark, fact_root) is None or versions.current(spark, marks_root) is None
    days = None if first else changed_days(marks, versions.read_table(spark, marks_root))
    if first:
        versions.create_table(star.fact_reviews(stg_review, stg_checkin), fact_root, "date", ["business_id"])
    elif days:
        # the day filter reaches both inputs before any shuffle
        review = stg_review.where(versions.is_one_of(date_of_text("date"), days))
        checkin = stg_checkin.where(versions.is_one_of(F.col("date").cast("date"), days))
        versions.replace(spark, fact_root, star.fact_reviews(review, checkin), days)
    if first or days:
        versions.create_table(marks, marks_root, "date")
    return days
