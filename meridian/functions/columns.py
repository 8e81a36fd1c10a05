"""Scalar building blocks used by the jobs.

Dates arrive as text in two shapes ('2016-04-26 19:49:16' and
'2016-04-26T00:00:00'); only the calendar day matters downstream, so
``date_of_text`` parses the first ten characters. Parsing never raises
(ANSI mode is on): unparsable text becomes NULL and is counted by checks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius (IUGG) used for sphere distances, and the
# length of one degree of arc on that sphere.
EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE = EARTH_RADIUS_KM * math.pi / 180.0

DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_of_text(c) -> Column:
    """Calendar day of a 'yyyy-MM-dd…' text (space or 'T' separated)."""
    return F.try_to_date(F.substring(F.trim(_c(c)), 1, 10), "yyyy-MM-dd")


def cast_date_of_text(c) -> Column:
    """The same day as :func:`date_of_text`, read by a cast: for columns of readings, where the formatter takes longer than the rest.

    A cast reads shorter and longer texts too, so the dashes and the last digit must stand where the pattern has them.
    """
    s = F.substring(F.trim(_c(c)), 1, 10)
    whole = ((F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
             & F.substring(s, 10, 1).between("0", "9"))
    return F.when(whole, s.try_cast("date"))


def parse_timestamp(c, fmt: str | None = DEFAULT_TS_FORMAT) -> Column:
    """Text → TIMESTAMP_NTZ, NULL when it does not parse (surrounding blanks ignored)."""
    s = F.trim(_c(c))
    ts = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return ts.cast("timestamp_ntz")


def split_list(c, sep_regex: str = r"\s*,\s*") -> Column:
    """'a, b,c' → ['a','b','c']: separator-tolerant, blanks and empty tokens dropped.

    NULL stays NULL (so a later ``explode`` emits no row for it).
    """
    parts = F.split(F.trim(_c(c)), sep_regex)
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != F.lit(""))


def strip_commas(c) -> Column:
    return F.regexp_replace(_c(c), ",", "")


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km on a sphere (NULL if any coordinate is NULL)."""
    la1, lo1 = F.radians(_c(lat1).cast("double")), F.radians(_c(lon1).cast("double"))
    la2, lo2 = F.radians(_c(lat2).cast("double")), F.radians(_c(lon2).cast("double"))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    # a rounding overshoot past 1 (antipodal points) makes asin NaN: nanvl
    # maps it to pi/2, i.e. half the circumference. NULL stays NULL (unlike a
    # least() clamp, which skips NULLs), and `a` appears once, keeping the
    # generated code small enough to be JIT-compiled.
    return F.lit(2.0 * radius_km) * F.nanvl(F.asin(F.sqrt(a)), F.lit(math.pi / 2))


def nonempty_ratio(n: Column) -> Column:
    """count / (count + 0.001): ~1 for a non-empty table, 0 for an empty one."""
    return n.cast("double") / (n.cast("double") + F.lit(0.001))
