"""Load modes: overwrite, append, date-range replace (keyed upserts are in ``versions``).

Tables are Parquet directories. A job never overwrites a path it is still
reading: rows that depend on the target are first written to a fresh
directory under the shared checkpoint folder, then copied in.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meridian.session import scratch_dir


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, dealt: bool = False) -> None:
    """Truncate-and-load (``overwrite``) or ``append``.

    ``overwrite`` always replaces the whole table, whatever overwrite mode
    the session has set for partitioned tables.

    Partitioned writes go through a ``rebalance`` on the partition columns:
    AQE then packs small partitions together and splits a crowded one, so
    each task writes few files and no task holds a hot day alone. Rows that are
    ``dealt`` that way already (few values a task) are written where they are.
    """
    if partition_by and not dealt:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.parquet(path)


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], mode: str = "overwrite",
                   partition_by: Sequence[str] | None = None) -> dict:
    """:func:`write_parquet` that also returns ``metrics`` (aggregates) of the rows it wrote, without
    another scan. They are taken in the writing stage, whose tasks Spark counts once each, retried or not."""
    if not metrics:
        write_parquet(df, path, mode, partition_by)
        return {}
    seen = Observation()
    named = [c.alias(n) for n, c in metrics.items()]
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.observe(seen, *named).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.parquet(path)
    return seen.get


def write_delimited(df: DataFrame, path: str, *, sep: str = ",", header: bool = True,
                    mode: str = "overwrite", quote_all: bool = False,
                    partition_by: Sequence[str] | None = None, compression: str | None = None) -> None:
    w = (df.write.mode(mode).option("header", header).option("sep", sep)
           .option("quoteAll", quote_all))
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    df.write.mode(mode).json(path, compression=compression)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it
    back: cuts lineage and survives executor loss (unlike a local checkpoint)."""
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    (df.hint("rebalance", *partition_by)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def _days(lo: _dt.date, hi: _dt.date) -> list[_dt.date]:
    return [lo + _dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def replace_date_range(spark: SparkSession, path: str, new_rows: DataFrame, date_col: str,
                       lo: _dt.date, hi: _dt.date) -> list[_dt.date]:
    """Delete every ``date_col`` partition in [lo, hi] and insert ``new_rows``
    (restricted to the window), like delete-range-then-insert.

    Days with new rows are replaced by one dynamic partition overwrite. A day
    of the window with no new rows must end up empty (a dynamic overwrite
    alone would keep its old rows): each such day gets a static-partition
    ``INSERT OVERWRITE`` of nothing. The loops run over days of the window,
    not over data. Returns the emptied days.
    """
    window = new_rows.where(F.col(date_col).between(F.lit(lo), F.lit(hi)))
    staged = materialize(spark, window, "range")
    present = {r[0] for r in staged.select(date_col).distinct().collect()}  # <= window days
    if present:
        overwrite_partitions(staged, path, [date_col])
    emptied = [d for d in _days(lo, hi) if d not in present]
    if emptied:
        _empty_partitions(spark, path, date_col, emptied, staged.columns)
    return emptied


def _empty_partitions(spark: SparkSession, path: str, date_col: str,
                      days: Sequence[_dt.date], columns: Sequence[str]) -> None:
    # every partition column is given, so this replaces just that partition
    # in either overwrite mode
    table = f"__target_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    schema = spark.table(table).schema
    data = [f for f in schema.fields if f.name != date_col]
    sel = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in data)
    try:
        for d in days:
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{date_col}` = DATE'{d}') "
                      f"SELECT {sel} WHERE false")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
