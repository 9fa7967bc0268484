"""Key building: dotted code levels, surrogate keys, precedence, prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.clean import as_column


def dotted(c, levels: int) -> Column:
    """First ``levels`` dot-separated parts of a code, re-joined ('1.2.1', 2 -> '1.2')."""
    return F.substring_index(as_column(c), ".", levels)


def surrogate_key(*cols, sep: str = "_") -> Column:
    """CONCAT(a, '_', b, ...): NULL when any part is NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(as_column(c).cast("string"))
    return F.concat(*parts)


def first_present(*cols, default=None) -> Column:
    """COALESCE(a, b, ..., default)."""
    parts = [as_column(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def prefix(c, n: int) -> Column:
    """First ``n`` characters (label truncation)."""
    return F.substring(as_column(c), 1, n)
