"""Column expressions (all JVM-side, code-generated; no Python UDFs)."""

from meridian.functions.columns import (  # noqa: F401
    EARTH_RADIUS_KM,
    KM_PER_DEGREE,
    cast_date_of_text,
    date_of_text,
    haversine_km,
    nonempty_ratio,
    parse_timestamp,
    split_list,
    strip_commas,
)
