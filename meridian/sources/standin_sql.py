"""The same stand-in tables as SQL CTE text, for the DuckDB oracle.

Valid in both engines; the oracle queries are written against these names.
"""

from meridian.schemas import COMPLIMENTS

STANDIN_CTES = {
    "v_business": """
SELECT concat('B', cast(s_suppkey AS string)) AS business_id, s_name AS name,
       concat('addr ', cast(s_nationkey AS string)) AS address,
       30 + cast((s_suppkey * 6007) % 10000 AS double) / 1000 AS latitude,
       -100 + cast((s_suppkey * 3001) % 10000 AS double) / 1000 AS longitude,
       CASE WHEN s_suppkey % 3 = 0 THEN 'Restaurants, Pizza' ELSE 'Shopping' END AS categories,
       cast(s_suppkey % 4 + 1 AS string) AS restaurants_price_range,
       concat('city ', cast(s_nationkey AS string)) AS city,
       cast(s_suppkey * 7 AS bigint) AS review_count, cast(s_suppkey % 9 AS double) / 2 + 1 AS stars
FROM supplier""",
    "v_station": """
SELECT concat('S', cast(p_partkey AS string)) AS station, p_partkey,
       30 + cast((p_partkey * 7919) % 10000 AS double) / 1000 AS lat,
       -100 + cast((p_partkey * 104729) % 10000 AS double) / 1000 AS long
FROM part""",
    "v_weather": """
SELECT concat(cast(d.dt AS string), 'T00:00:00') AS date,
       concat('CITY:', cast(s.p_partkey % 50 AS string)) AS location_id,
       concat('City ', cast(s.p_partkey % 50 AS string), ' US') AS city_name,
       cast((s.p_partkey * 31 + d.dom * 17) % 450 AS double) / 10 AS average_temp,
       s.station, s.long, s.lat, cast((s.p_partkey + d.dom) % 5 AS double) AS prcp
FROM v_station s CROSS JOIN
     (SELECT DISTINCT cast(o_orderdate AS date) AS dt, day(cast(o_orderdate AS date)) AS dom FROM orders) d""",
    "v_review": """
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS review_id,
       concat('B', cast(l_suppkey AS string)) AS business_id, concat('U', cast(o_custkey AS string)) AS user_id,
       cast(l_shipdate AS string) AS date, cast(cast(l_quantity AS bigint) % 5 + 1 AS double) AS stars,
       cast(l_quantity AS bigint) AS useful, cast(l_linenumber AS bigint) AS cool, cast(l_partkey % 7 AS bigint) AS funny,
       concat(l_returnflag, ' ', l_linestatus, ' a sample review text that is longer than thirty characters') AS text
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_checkin": """
SELECT concat('B', cast(o_custkey % (SELECT count(*) FROM supplier) AS string)) AS business_id, o_orderdate AS date
FROM orders""",
    "v_user": """
SELECT concat('U', cast(c_custkey AS string)) AS user_id, c_name AS name,
       cast(c_custkey % 9 AS double) / 2 + 1 AS average_stars, cast(c_custkey % 100 AS bigint) AS review_count,
       cast(c_custkey % 13 AS bigint) AS useful,
       concat('20', CASE WHEN c_custkey % 2 = 0 THEN '08' ELSE '14' END, '-03-05 10:20:30') AS yelping_since
FROM customer""",
    "v_user_full": """
SELECT *, k % 17 AS funny, k % 19 AS cool, k % 7 AS fans, CASE WHEN k % 3 = 0 THEN '2010,2012' ELSE '' END AS elite,
       """ + ", ".join(f"(k * {i + 2}) % 23 AS compliment_{c}" for i, c in enumerate(COMPLIMENTS)) + """
FROM (SELECT *, cast(substr(user_id, 2) AS bigint) AS k FROM v_user) u""",
    "v_friend": """
SELECT DISTINCT concat('U', cast(o_custkey AS string)) AS user_id, concat('F', cast(l_partkey AS string)) AS friend_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
}

_ORDER = ["v_business", "v_station", "v_weather", "v_review", "v_checkin", "v_user", "v_user_full", "v_friend"]


def with_standins(body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with every stand-in view as a CTE (plus ``extra_ctes``)."""
    parts = [f"{n} AS ({STANDIN_CTES[n].strip()})" for n in _ORDER]
    for n, q in extra_ctes or []:
        parts.append(f"{n} AS ({q.strip()})")
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
