"""Declarative clean step: filter on the raw columns, then project.

The filter runs on the raw input before any cast in the projection, so a raw
value that is present but unparsable survives the not-null test and becomes
NULL in the output (it still counts rows; it adds nothing to averages).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.clean import as_column, safe_long


def not_null(*cols) -> list[Column]:
    return [as_column(c).isNotNull() for c in cols]


def non_empty(*cols) -> list[Column]:
    """Not NULL and not the empty string (no trimming: ' ' is kept)."""
    return [as_column(c).isNotNull() & (as_column(c) != F.lit("")) for c in cols]


def at_least(df: DataFrame, col: str, bound, parse: bool = False) -> Column:
    """``col >= bound``; with ``parse`` the raw value is safe-cast to an integer first."""
    c = F.col(col)
    if parse:
        c = safe_long(c, df.schema[col].dataType)
    return F.coalesce(c >= F.lit(bound), F.lit(False))


def stage(df: DataFrame, select: Mapping[str, Column] | Sequence, where: Iterable[Column] = ()) -> DataFrame:
    """``SELECT <select> FROM df WHERE <all of where>``.

    ``select`` maps output names to Columns (or is a list of Columns/names).
    """
    conds = list(where)
    if conds:
        df = df.filter(reduce(lambda a, b: a & b, conds))
    if isinstance(select, Mapping):
        cols = [as_column(c).alias(name) for name, c in select.items()]
    else:
        cols = [as_column(c) for c in select]
    return df.select(*cols)


def nan_as_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Map NaN to NULL in every double/float column (or the given ones)."""
    names = cols or [f.name for f in df.schema.fields
                     if f.dataType.typeName() in ("double", "float")]
    out = [F.when(F.isnan(F.col(f.name)), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
           if f.name in names else F.col(f.name) for f in df.schema.fields]
    return df.select(*out)
