"""Normalising list-valued text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions import split_list


def explode_list(df: DataFrame, list_col: str, out_col: str, keep: Sequence[str],
                 sep_regex: str = r"\s*,\s*") -> DataFrame:
    """One row per element of a comma-joined text column.

    A narrow operator (no shuffle): NULL or empty lists yield no row, blanks
    around separators are trimmed.
    """
    return df.select(*keep, F.explode(split_list(list_col, sep_regex)).alias(out_col))

