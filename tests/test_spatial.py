import random

from pyspark.sql import functions as F

from meridian.operators import nearest_k, within_radius
from meridian.plans.star import dim_weather, nearest_stations
from tests.brute import nearest_stations_brute, within_radius_brute
from tests.conftest import rows


def _points(spark, n, seed, name):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        if i % 10 == 0:     # near the poles
            lat = rnd.uniform(85, 90) * rnd.choice([-1, 1])
        else:
            lat = rnd.uniform(-60, 60)
        lon = rnd.uniform(-180, 180) if i % 7 else rnd.choice([-179.9, 179.9]) + rnd.uniform(-0.1, 0.1)
        data.append((f"{name}{i}", lat, min(max(lon, -180.0), 180.0)))
    return spark.createDataFrame(data, f"{name}_id string, {name}_lat double, {name}_lon double")


def test_grid_equals_brute_force_everywhere(spark):
    # dense enough that many pairs fall inside 300 km, incl. poles and antimeridian
    left = _points(spark, 400, 1, "a")
    right = _points(spark, 1500, 2, "b")
    kw = dict(left_lat="a_lat", left_lon="a_lon", right_lat="b_lat", right_lon="b_lon")
    g = within_radius(left, right, 300.0, **kw).select("a_id", "b_id")
    b = within_radius_brute(left, right, 300.0, **kw).select("a_id", "b_id")
    assert g.count() > 50
    assert g.exceptAll(b).count() == 0
    assert b.exceptAll(g).count() == 0


def _business(spark, data):
    return spark.createDataFrame(data, "business_id string, latitude double, longitude double")


def _weather(spark, data):
    return spark.createDataFrame(
        data, "date string, location_id string, city_name string, average_temp double, "
              "station string, long double, lat double, prcp double")


KM = 1 / 111.19508   # degrees of latitude per km on the mean sphere


def test_rank_ties_broken_by_station_id(spark):
    b = _business(spark, [("B1", 0.0, 0.0)])
    w = _weather(spark, [("2021-01-01T00:00:00", "L", "c", 1.0, s, 0.0, d * KM, 0.0)
                         for s, d in [("S1", 1), ("S2", 2), ("S4", 3), ("S3", 3)]])
    m = nearest_stations(b, w)
    assert rows(m, "station", "rid") == [("S1", 1), ("S2", 2), ("S3", 3)]


def test_distance_threshold_on_rounded_km(spark):
    b = _business(spark, [("B1", 0.0, 0.0)])
    w = _weather(spark, [("2021-01-01T00:00:00", "L", "c", 1.0, "S49", 0.0, 49.4 * KM, 0.0),
                         ("2021-01-01T00:00:00", "L", "c", 1.0, "S50", 0.0, 49.6 * KM, 0.0)])
    assert rows(nearest_stations(b, w), "station", "dist") == [("S49", 49.0)]


def test_grid_and_brute_nearest_agree(spark):
    rnd = random.Random(7)
    b = _business(spark, [(f"B{i}", 30 + rnd.random() * 3, -100 + rnd.random() * 3) for i in range(60)])
    w = _weather(spark, [("2021-01-01T00:00:00", "L", "c", 1.0, f"S{i}", -100 + rnd.random() * 3,
                          30 + rnd.random() * 3, 0.0) for i in range(300)])
    cols = ("business_id", "latitude", "longitude", "station", "dist", "rid")
    assert rows(nearest_stations(b, w), *cols) == rows(nearest_stations_brute(b, w), *cols)


def test_station_under_two_locations_weighs_double(spark):
    b = _business(spark, [("B1", 0.0, 0.0)])
    d = "2021-01-01T00:00:00"
    w = _weather(spark, [(d, "L1", "c", 10.0, "S1", 0.0, 1 * KM, 0.0),
                         (d, "L2", "c", 10.0, "S1", 0.0, 1 * KM, 0.0),
                         (d, "L1", "c", 40.0, "S2", 0.0, 2 * KM, 0.0)])
    out = dim_weather(b, w).collect()[0]
    assert out.average_temp == 20.0        # (10 + 10 + 40) / 3


def test_station_without_coordinates_never_matches(spark):
    b = _business(spark, [("B1", 0.0, 0.0)])
    w = _weather(spark, [("2021-01-01T00:00:00", "L", "c", 1.0, "S1", None, None, 0.0)])
    assert nearest_stations(b, w).count() == 0
    assert dim_weather(b, w).count() == 0


def test_top_k_after_dense_rank_dedupes(spark):
    pts = spark.createDataFrame([("P", 0.0, 0.0)], "pid string, plat double, plon double")
    # the same site twice with identical coordinates: one row, one rank
    sites = spark.createDataFrame([("S1", 0.0, 0.01), ("S1", 0.0, 0.01), ("S2", 0.0, 0.02)],
                                  "sid string, slat double, slon double")
    out = nearest_k(pts, sites, k=3, max_km=50, point_key=["pid"], site_key="sid",
                    point_lat="plat", point_lon="plon", site_lat="slat", site_lon="slon")
    assert rows(out, "sid", "rid") == [("S1", 1), ("S2", 2)]


def test_count_within_radius_equals_brute_force(spark):
    from meridian.operators import count_within_radius
    rnd = random.Random(11)
    # a dense cluster (many whole cells), a sparse spread, points near a pole
    data = ([(f"a{i}", 40 + rnd.gauss(0, 0.3), -74 + rnd.gauss(0, 0.3), rnd.choice("xy"))
             for i in range(600)]
            + [(f"b{i}", rnd.uniform(-60, 60), rnd.uniform(-180, 180), rnd.choice("xy"))
               for i in range(200)]
            + [(f"c{i}", 89.5 + rnd.random() * 0.5, rnd.uniform(-180, 180), "x") for i in range(30)])
    left = spark.createDataFrame(data, "id string, lat double, lon double, cat string")
    right = left.select(F.col("cat").alias("rcat"), F.col("lat").alias("rlat"),
                        F.col("lon").alias("rlon"))
    got = count_within_radius(left, right, 60.0, left_key="id", left_lat="lat", left_lon="lon",
                              right_lat="rlat", right_lon="rlon", extra_keys=[("cat", "rcat")])
    pairs = within_radius_brute(left, right, 60.0, left_lat="lat", left_lon="lon",
                                right_lat="rlat", right_lon="rlon").where(F.col("cat") == F.col("rcat"))
    want = left.select("id").join(pairs.groupBy("id").count(), "id", "left").fillna(0)
    assert rows(got) == rows(want)
    assert max(r[1] for r in rows(got)) > 100      # the dense cluster was exercised


COLS = ("pid", "plat", "plon", "sid", "dist", "rid")


def _brute(pts, sites):
    b = pts.select(F.col("pid").alias("business_id"), F.col("plat").alias("latitude"), F.col("plon").alias("longitude"))
    w = sites.select(F.col("sid").alias("station"), F.col("slat").alias("lat"), F.col("slon").alias("long"))
    return rows(nearest_stations_brute(b, w))


def test_far_crowd_and_repeated_point_keep_true_neighbours(spark):
    # a point listed three times, three stations near it, 400 in one cell far off
    pts = spark.createDataFrame([("B", 40.0, -74.0)] * 3, "pid string, plat double, plon double")
    st = [(f"N{i}", 40.0, -74.0 + 0.05 * i) for i in range(1, 4)] + [(f"F{i}", 40.3, -74.3 + i * 1e-6) for i in range(400)]
    sites = spark.createDataFrame(st, "sid string, slat double, slon double")
    got = nearest_k(pts, sites, k=3, max_km=50, point_key=["pid"], site_key="sid", point_lat="plat",
                    point_lon="plon", site_lat="slat", site_lon="slon")
    assert rows(got, "sid", "rid") == [("N1", 1), ("N2", 2), ("N3", 3)]


def test_nearest_with_crowded_cells_equals_brute_force(spark):
    rnd = random.Random(21)
    # a crowded cluster (split into sub-cells at a low threshold), sparse
    # stations around it, businesses inside and around the cluster
    st = ([(f"S{i}", 0.0, 0.0) for i in range(0)]
          + [(f"C{i}", 40 + rnd.gauss(0, 0.05), -74 + rnd.gauss(0, 0.05)) for i in range(400)]
          + [(f"R{i}", 40 + rnd.uniform(-1, 1), -74 + rnd.uniform(-1.3, 1.3)) for i in range(120)]
          + [("C7", 40.3, -74.3)])                                  # one station, two places
    sites = spark.createDataFrame(st, "sid string, slat double, slon double")
    pts = spark.createDataFrame(
        [(f"P{i}", 40 + rnd.gauss(0, 0.3), -74 + rnd.gauss(0, 0.3)) for i in range(150)]
        + [("Pnull", None, None), ("Pfar", 10.0, 10.0)], "pid string, plat double, plon double")
    kw = dict(k=3, max_km=50, point_key=["pid"], site_key="sid", point_lat="plat",
              point_lon="plon", site_lat="slat", site_lon="slon")
    fast = nearest_k(pts, sites, crowded_cell_sites=16, split=8, **kw)
    assert rows(fast, *COLS) == _brute(pts, sites)
    assert rows(nearest_k(pts, sites, **kw), *COLS) == _brute(pts, sites)   # default threshold too
    # repeated points and one key at two places, on both sides of the threshold
    more = pts.unionByName(pts.limit(40)).unionByName(
        spark.createDataFrame([("P1", 40.1, -74.1), ("P1", 40.1, -74.1), ("P2", None, 1.0)], pts.schema))
    for limit in (16, 256):
        got = nearest_k(more, sites, crowded_cell_sites=limit, **kw)
        assert rows(got, *COLS) == _brute(more, sites)
        assert got.groupBy("pid").count().where("count > 3").count() == 0


def test_nearest_with_very_dense_point_cluster_uses_deeper_levels(spark):
    rnd = random.Random(5)
    st = ([(f"D{i}", 40 + rnd.gauss(0, 0.0008), -74 + rnd.gauss(0, 0.0008)) for i in range(300)]
          + [(f"R{i}", 40 + rnd.uniform(-0.6, 0.6), -74 + rnd.uniform(-0.8, 0.8)) for i in range(80)])
    sites = spark.createDataFrame(st, "sid string, slat double, slon double")
    pts = spark.createDataFrame([(f"P{i}", 40 + rnd.gauss(0, 0.1), -74 + rnd.gauss(0, 0.1))
                                 for i in range(80)], "pid string, plat double, plon double")
    kw = dict(k=3, max_km=50, point_key=["pid"], site_key="sid", point_lat="plat",
              point_lon="plon", site_lat="slat", site_lon="slon")
    assert rows(nearest_k(pts, sites, crowded_cell_sites=8, split=4, **kw), *COLS) == _brute(pts, sites)


KW = dict(k=3, max_km=50, point_key=["pid"], site_key="sid", point_lat="plat",
          point_lon="plon", site_lat="slat", site_lon="slon")


def test_cluster_inside_fifty_metres_is_split_as_deep_as_it_needs(spark):
    rnd = random.Random(9)
    at = lambda m: rnd.uniform(-m, m) * KM / 1000
    st = ([(f"D{i}", 40 + at(25), -74 + at(25)) for i in range(500)]                     # all within 50 m
          + [(f"E{i}", 40.1, -74.1) for i in range(300)]                                 # all on one place
          + [(f"R{i}", 40 + rnd.uniform(-0.4, 0.4), -74 + rnd.uniform(-0.5, 0.5)) for i in range(40)])
    sites = spark.createDataFrame(st, "sid string, slat double, slon double")
    pts = spark.createDataFrame([(f"P{i}", 40 + at(8000), -74 + at(8000)) for i in range(60)]
                                + [("Pin", 40.0, -74.0), ("Pon", 40.1, -74.1)], "pid string, plat double, plon double")
    assert rows(nearest_k(pts, sites, crowded_cell_sites=16, **KW), *COLS) == _brute(pts, sites)


def test_tree_splits_crowded_units_only_and_keeps_every_place_once(spark):
    from meridian.operators.spatial import _cell_tree, _indexed
    rnd = random.Random(3)
    data = ([(i, 40.1 + rnd.random() * 1e-5, -74.1 + rnd.random() * 1e-5) for i in range(200)]
            + [(1000 + i, rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for i in range(100)])
    places = _indexed(spark.createDataFrame(data, "id int, la double, lo double"), "la", "lo", 0.25, 8)
    kw = dict(cell_deg=0.25, split=8, crowded=20, name="t")
    tree = _cell_tree(places, [], [], **kw)
    assert len(tree.counts) > 4
    held = [c.agg(F.sum("__tot")).first()[0] for c in tree.counts]
    assert held[:2] == [300, 200] and held == sorted(held, reverse=True)
    assert rows(tree.leaves, "id") == sorted((d[0],) for d in data)
    assert tree.leaves.groupBy("__lv", "__uy", "__ux").count().where("count > 20").count() == 0
    assert len(_cell_tree(places.where("id >= 1000"), [], [], **kw).counts) == 1
    assert _cell_tree(places.limit(0), [], [], **kw).leaves.count() == 0


def test_counting_defined_cases(spark):
    from meridian.operators import count_within_radius
    schema = "id int, lat double, lon double, cat string"
    left = spark.createDataFrame([(1, 10.0, 10.0, "x"), (2, 10.0, 10.0, "x"), (3, None, 1.0, "x"), (4, 10.0, 10.0, None),
                                  (5, 89.9, 0.0, "x"), (6, 0.0, 179.99, "x")], schema)
    right = spark.createDataFrame([(0, 10.0, 10.0, "x")] * 100 + [(0, 10.0, None, "x"), (0, 10.0, 10.0, None),
                                  (0, 89.9, 180.0, "x"), (0, 90.0, 5.0, "x"), (0, 0.0, -179.99, "x")], schema)
    right = right.select(*(F.col(c).alias("r" + c) for c in right.columns))
    kw = dict(left_key="id", left_lat="lat", left_lon="lon", right_lat="rlat", right_lon="rlon", extra_keys=[("cat", "rcat")])
    assert rows(count_within_radius(left, right, 50.0, **kw)) == [(1, 100), (2, 100), (3, 0), (4, 0), (5, 2), (6, 1)]
    assert rows(count_within_radius(left, right.limit(0), 50.0, **kw), "n") == [(0,)] * 6
    assert count_within_radius(left.limit(0), right, 50.0, **kw).count() == 0


def test_comparisons_of_one_circle_grow_slower_than_the_crowd(spark):
    from meridian.operators.spatial import _pyramid_parts, grid_for_radius
    rnd = random.Random(4)
    compared = []
    for n in (2000, 20000):
        right = spark.createDataFrame([(rnd.uniform(39, 41), rnd.uniform(-75, -73)) for _ in range(n)], "__ra double, __ro double")
        spots = spark.createDataFrame([(40.0, -74.0)], "__la double, __lo double")
        sums, edge = _pyramid_parts(spots, right, 60.0, [], grid_for_radius(60.0, 4), 4, 32)
        compared.append(edge.count())
    assert compared[1] < 4 * compared[0]          # ten times the places at equal area
