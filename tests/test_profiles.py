"""Mergeable profiles against exact figures."""

import pytest
from pyspark.sql import functions as F

from meridian.plans.profiles import merge_profiles, profile_days, read_profiles, store_profiles
from meridian.session import scratch_dir


@pytest.fixture(scope="module")
def wide(spark):
    i = F.col("id")
    cols = [(i % 5).alias("day"), F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), i % 90)).alias("name"),
            F.when(i % 4 != 0, F.sqrt(i)).alias("root"), F.date_add(F.lit("2020-01-01").cast("date"), (i % 700).cast("int")).alias("on"),
            F.lit(None).cast("double").alias("none"), F.when(i % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(1.5)).alias("nan"),
            F.repeat(F.lit("long "), 100 + (i % 2).cast("int")).alias("Long`text"), F.array(i % 2).alias("list"),
            F.xxhash64(i).alias("hash"), F.encode((i % 6).cast("string"), "utf-8").alias("bin")]
    cols += [((i * (j + 3)) % (20 + 40 * j)).alias(f"n{j}") for j in range(12)]
    return spark.range(20_000).select(*cols)


def test_merged_sketches_are_within_their_error(spark, wide):
    path = scratch_dir(spark, "t-profiles")
    store_profiles(wide, path, F.col("day"))
    store_profiles(wide.filter("day = 2"), path, F.col("day"))          # a day loaded again counts once
    got = {r["column"]: r for r in merge_profiles(read_profiles(spark, path)).collect()}
    assert set(got) == set(wide.columns)
    for f in wide.schema.fields:
        c, r = F.col("`" + f.name.replace("`", "``") + "`"), got[f.name]
        text = F.hex(c) if f.dataType.simpleString() == "binary" else c.cast("string")
        exact = wide.agg(F.count("*"), F.count_if(c.isNull()), F.countDistinct(text), F.min(text), F.max(text)).first()
        assert (r["days"], r["rows"], r["nulls"], r["lowest"], r["highest"]) == (5, exact[0], exact[1], exact[3], exact[4]), f.name
        assert abs(r["distinct"] - exact[2]) <= 0.05 * exact[2], f.name
    n = wide.filter("root is not null").count()
    for rank, q in zip((0.0, 0.25, 0.5, 0.75, 1.0), got["root"]["quantiles"]):
        assert abs(wide.filter(F.col("root") <= q).count() / n - rank) <= 0.02
    assert got["none"]["quantiles"] is None and got["none"]["frequent"] == [] and got["nan"]["quantiles"] == [1.5] * 5
    assert got["on"]["quantiles"][0] == 18262.0
    name = wide.groupBy("name").count().orderBy(F.desc("count"), "name").limit(10).collect()
    assert [tuple(x) for x in got["name"]["frequent"]] == [tuple(x) for x in name]
    assert all(x["value"].startswith("sha256:") for x in got["Long`text"]["frequent"])


def test_one_pass_without_expanding_rows(spark, wide):
    plan = profile_days(wide, F.col("day"))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_empty_table(spark, wide):
    assert merge_profiles(profile_days(wide.limit(0), F.col("day"))).count() == 0
