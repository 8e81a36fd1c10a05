"""Property tests (hypothesis): operators against straightforward models."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meridian.operators import allocate_evenly, within_radius
from tests.brute import within_radius_brute
from tests.conftest import rows

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.tuples(st.sampled_from(["B1", "B2", "B3", None]),
                 st.sampled_from([dt.date(2021, 1, d) for d in (1, 2, 3)] + [None]))


@SETTINGS
@given(reviews=st.lists(keys, min_size=1, max_size=25), totals=st.lists(
    st.tuples(st.sampled_from(["B1", "B2", "B4"]), st.sampled_from([dt.date(2021, 1, d) for d in (1, 2)]),
              st.integers(0, 9)), max_size=6, unique_by=lambda t: (t[0], t[1])))
def test_allocation_matches_window_model(spark, reviews, totals):
    r = spark.createDataFrame([(i, b, d) for i, (b, d) in enumerate(reviews)],
                              "rid int, business_id string, date date")
    t = spark.createDataFrame(totals, "business_id string, date date, total long")
    got = rows(allocate_evenly(r, t, ["date", "business_id"], "total", "share"), "rid", "share")
    # model: left join, then coalesce(total, 0) / count(*) over (partition by key)
    pr = pd.DataFrame([(i, b, d) for i, (b, d) in enumerate(reviews)], columns=["rid", "b", "d"])
    tot = {(b, d): n for b, d, n in totals}
    n = pr.groupby(["b", "d"], dropna=False)["rid"].transform("count")
    want = sorted((int(i), (tot.get((b, d), 0) if b is not None and d is not None else 0) / c)
                  for i, b, d, c in zip(pr.rid, pr.b, pr.d, n))
    assert [(a, round(b, 12)) for a, b in got] == [(a, round(b, 12)) for a, b in want]


coords = st.tuples(st.floats(-89.9, 89.9), st.floats(-180, 180))


@SETTINGS
@given(left=st.lists(coords, min_size=1, max_size=30), right=st.lists(coords, min_size=1, max_size=60),
       radius=st.sampled_from([5.0, 120.0, 900.0, 3000.0]))
def test_grid_join_equals_brute_force(spark, left, right, radius):
    l = spark.createDataFrame([(f"l{i}", a, b) for i, (a, b) in enumerate(left)],
                              "lid string, la double, lo double")
    r = spark.createDataFrame([(f"r{i}", a, b) for i, (a, b) in enumerate(right)],
                              "rid string, ra double, ro double")
    kw = dict(left_lat="la", left_lon="lo", right_lat="ra", right_lon="ro")
    assert (rows(within_radius(l, r, radius, **kw), "lid", "rid")
            == rows(within_radius_brute(l, r, radius, **kw), "lid", "rid"))
