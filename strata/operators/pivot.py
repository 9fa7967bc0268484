"""Pivot by conditional max over a fixed code list (one pass, partial aggregation)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_max(df: DataFrame, keys: Sequence, code: str, value: str, columns: Mapping[str, str]) -> DataFrame:
    """``MAX(CASE WHEN code = c THEN value END) AS name`` for each ``c -> name``.

    The code list is fixed by the caller, so no pass is spent discovering it.
    """
    aggs = [F.max(F.when(F.col(code) == F.lit(c), F.col(value))).alias(name)
            for c, name in columns.items()]
    return df.groupBy(*keys).agg(*aggs)
