"""Explicit StructTypes for raw inputs, staging and the star schema.

Reading with a declared schema skips inference (a full pass over JSON) and
pins types so results do not drift with the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()
TS = T.TimestampNTZType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- raw inputs -------------------------------------------------------------
RAW_CHECKIN = _st(("business_id", S), ("date", S))
# The compliments a user can get, as the user table names them.
COMPLIMENTS = ["cool", "cute", "funny", "hot", "list", "more", "note", "photos", "plain", "profile", "writer"]
USER_COLUMNS = [("user_id", S), ("name", S), ("average_stars", D), ("review_count", L), ("useful", L), ("funny", L),
                ("cool", L), ("fans", L), ("elite", S), *[(f"compliment_{c}", L) for c in COMPLIMENTS]]
RAW_USER = _st(*USER_COLUMNS, ("yelping_since", S), ("friends", S))
RAW_REVIEW = _st(("review_id", S), ("business_id", S), ("user_id", S), ("stars", D),
                 ("useful", L), ("cool", L), ("funny", L), ("text", S), ("date", S),
                 ("_corrupt_record", S))
# The attributes of the business table, in its column order.
BUSINESS_ATTRIBUTES = [
    "AcceptsInsurance", "AgesAllowed", "Alcohol", "Ambience", "BYOB", "BYOBCorkage", "BestNights", "BikeParking",
    "BusinessAcceptsBitcoin", "BusinessAcceptsCreditCards", "BusinessParking", "ByAppointmentOnly", "Caters", "CoatCheck",
    "Corkage", "DietaryRestrictions", "DogsAllowed", "DriveThru", "GoodForDancing", "GoodForKids", "GoodForMeal",
    "HairSpecializesIn", "HappyHour", "HasTV", "Music", "NoiseLevel", "Open24Hours", "OutdoorSeating", "RestaurantsAttire",
    "RestaurantsCounterService", "RestaurantsDelivery", "RestaurantsGoodForGroups", "RestaurantsPriceRange2",
    "RestaurantsReservations", "RestaurantsTableService", "RestaurantsTakeOut", "Smoking", "WheelchairAccessible", "WiFi",
]
LAT, LON = T.DecimalType(8, 6), T.DecimalType(9, 6)

# Landed API responses of the weather service (one JSON document per line).
RAW_TEMPERATURE_PAGE = _st(("location_id", S)).add("results", T.ArrayType(_st(
    ("date", S), ("station", S), ("datatype", S), ("attributes", S), ("value", D))))
RAW_PRECIP_PAGE = _st(("station_id", S)).add("results", T.ArrayType(_st(
    ("date", S), ("station", S), ("datatype", S), ("attributes", S), ("value", D))))
RAW_STATION = _st(("id", S), ("longitude", D), ("latitude", D))
RAW_CITY_PAGE = _st().add("results", T.ArrayType(_st(("id", S), ("name", S))))

# --- staging ----------------------------------------------------------------
STG_CHECKIN = _st(("business_id", S), ("date", TS))
STG_BUSINESS = _st(("address", S), *[(a, S) for a in BUSINESS_ATTRIBUTES], ("business_id", S), ("categories", S),
                   ("city", S), ("hours", S), ("is_open", I), ("latitude", LAT), ("longitude", LON), ("name", S),
                   ("postal_code", S), ("review_count", L), ("stars", D), ("state", S))
STG_USER = _st(*USER_COLUMNS, ("yelping_since", TS))
STG_FRIEND = _st(("user_id", S), ("friend_id", S))
STG_WEATHER = _st(("date", S), ("location_id", S), ("city_name", S), ("average_temp", D),
                  ("station", S), ("long", D), ("lat", D), ("prcp", D))
WEATHER_KEYS = ["date", "location_id", "station"]
WEATHER_ATTRS = ["city_name", "average_temp", "long", "lat", "prcp"]

# --- star schema ------------------------------------------------------------
DIM_BUSINESS_COLS = ["business_id", "name", "address", "latitude", "longitude",
                     "categories", "restaurants_price_range", "review_count", "stars"]
DIM_USER_COLS = ["user_id", "average_stars", "is_influencer", "friends_count",
                 "review_count", "useful", "yelping_since"]
DIM_WEATHER_COLS = ["date", "business_id", "average_temp", "prcp", "avglong", "avglat",
                    "avgdist"]
FACT_REVIEW_COLS = ["date", "business_id", "user_id", "review_id", "stars", "useful",
                    "cool", "funny", "text", "checkin_count"]
