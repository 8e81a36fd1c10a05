"""Cross-join forms of the spatial operators: oracles for small inputs only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.functions import haversine_km


def within_radius_brute(left, right, radius_km, *, left_lat, left_lon, right_lat, right_lon,
                        dist_col="dist_km"):
    d = haversine_km(F.col(left_lat), F.col(left_lon), F.col(right_lat), F.col(right_lon))
    return left.crossJoin(right).withColumn(dist_col, d).where(F.col(dist_col) <= F.lit(radius_km))


def nearest_stations_brute(business, weather, k=3, max_km=50):
    b = business.select("business_id", F.col("longitude").cast("double").alias("longitude"),
                        F.col("latitude").cast("double").alias("latitude"))
    s = weather.select("station", F.col("long").cast("double").alias("s_long"),
                       F.col("lat").cast("double").alias("s_lat"))
    pairs = within_radius_brute(b, s, float(max_km), left_lat="latitude", left_lon="longitude",
                                right_lat="s_lat", right_lon="s_long", dist_col="d")
    rows = (pairs.select("business_id", "longitude", "latitude", "station", F.round("d", 0).alias("dist"))
                 .distinct().where(F.col("dist") < max_km))
    w = Window.partitionBy("business_id").orderBy("dist", "station", "latitude", "longitude")
    return (rows.withColumn("rid", F.row_number().over(w)).where(F.col("rid") <= k)
                .select("business_id", "latitude", "longitude", "station", "dist", "rid"))
