"""Mergeable column profiles: sketches per load day, stored beside a table and merged on demand.

A profile has one row per (load day, column): rows, nulls, lowest and highest text, and three
sketches (distinct values, quantiles, frequent values). A load profiles only its own day, in one
aggregation without expanding rows; days merge without reading the table again, and loading a day
again replaces its rows.

Errors of a merged profile: distinct values within 5 % (three standard errors at ``LG_K``; exact to the
unit for some hundred values), quantiles within 2 % of the rank (lowest and highest number exact), counts
of frequent values exact while a column has up to ``TRACKED`` / 2 values, else off by at most rows / ``TRACKED`` * 3.

Numbers, dates (days since 1970) and times (seconds) have quantiles; NaN has no rank. Every column has the
rest, by its value as text (binary: hex); a text longer than 256 characters counts under its SHA-256.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.sources.sinks import overwrite_partitions

LG_K = 12
TRACKED = 1000
#: Frequent values that a merge looks at before it orders ties by value.
CANDIDATES = 256


def _text(c: Column, kind: T.DataType) -> Column:
    return F.hex(c) if isinstance(kind, T.BinaryType) else c.cast("string")


def _number(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c) / 1e6
    if isinstance(kind, T.NumericType):
        x = c.cast("double")
        return F.when(~F.isnan(x), x)
    return F.lit(None).cast("double")


def profile_days(df: DataFrame, day: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """(load_day, column, type, rows, nulls, lowest, highest, distinct, quantiles, frequent)."""
    made = []
    for i, f in enumerate(f for f in df.schema.fields if columns is None or f.name in columns):
        c = F.col("`" + f.name.replace("`", "``") + "`")
        text = _text(c, f.dataType)
        label = F.when(F.length(text) > 256, F.concat(F.lit("sha256:"), F.sha2(text, 256))).otherwise(text)
        made.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.count("*").alias("rows"),
            F.count_if(c.isNull()).alias("nulls"), F.min(text).alias("lowest"), F.max(text).alias("highest"),
            F.hll_sketch_agg(text, F.lit(LG_K)).alias("distinct"), F.kll_sketch_agg_double(_number(c, f.dataType)).alias("quantiles"),
            F.call_function("approx_top_k_accumulate", label, F.lit(TRACKED)).alias("frequent")).alias(f"c{i}"))
    wide = df.groupBy(day.alias("load_day")).agg(*made)
    return wide.select("load_day", F.inline(F.array(*(f"c{i}" for i in range(len(made))))))


def store_profiles(df: DataFrame, path: str, day: Column, columns: Sequence[str] | None = None) -> None:
    """Profile the days that ``df`` holds; days stored before are replaced, others stay."""
    overwrite_partitions(profile_days(df, day, columns), path, ["load_day"])


def merge_profiles(profiles: DataFrame, ranks: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), top: int = 10) -> DataFrame:
    """One row per column (and type, where days differ) over all days of ``profiles``.

    ``frequent`` lists up to ``top`` (value, count), most frequent first, ties by value.
    """
    m = profiles.groupBy("column", "type").agg(
        F.count("*").alias("days"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"), F.kll_merge_agg_double("quantiles").alias("q"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {TRACKED}), {CANDIDATES})").alias("f"))
    known = F.filter("f", lambda x: x["item"].isNotNull())
    ordered = F.slice(F.array_sort(F.transform(known, lambda x: F.struct((-x["count"]).alias("c"), x["item"].alias("v")))), 1, top)
    return m.select("column", "type", "days", "rows", "nulls", "lowest", "highest", "distinct",
                    F.when(F.kll_sketch_get_n_double("q") > 0,
                           F.kll_sketch_get_quantile_double("q", F.array(*(F.lit(float(r)) for r in ranks)))).alias("quantiles"),
                    F.transform(ordered, lambda x: F.struct(x["v"].alias("value"), (-x["c"]).alias("count"))).alias("frequent"))


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
