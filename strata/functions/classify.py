"""Categorisation helpers: IN-list groups, half-open bands, flags, thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.clean import as_column


def in_groups(c, groups: Mapping[str, Sequence], other: str | None = "Other") -> Column:
    """CASE WHEN c IN (...) THEN label ... ELSE other END, first group wins."""
    c = as_column(c)
    out = None
    for label, members in groups.items():
        cond = c.isin(list(members))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(other)
    return out.otherwise(F.lit(other))


def band(c, edges: Sequence[float], labels: Sequence[str], right_closed: bool = True) -> Column:
    """Label by interval: (e0, e1], (e1, e2], ... when ``right_closed``.

    Values outside every interval (including the lowest edge itself when
    right-closed) get NULL, the same as an out-of-range ``pandas.cut``.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    c = as_column(c)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = ((c > lo) & (c <= hi)) if right_closed else ((c >= lo) & (c < hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def flag(c, value) -> Column:
    """CASE WHEN c = value THEN TRUE ELSE FALSE END (NULL gives FALSE)."""
    return F.coalesce(as_column(c) == F.lit(value), F.lit(False))


def threshold(c, cut, strict: bool = False) -> Column:
    """0/1 integer flag: ``c >= cut`` (or ``c > cut`` when strict)."""
    c = as_column(c)
    cut = cut if isinstance(cut, Column) else F.lit(cut)
    return ((c > cut) if strict else (c >= cut)).cast("int")
