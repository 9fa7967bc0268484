"""The k-th smallest value of a column, for any k, by counting digits.

Values are whole numbers of ``bits`` bits. A pass counts the values by their leading
``digit`` bits (a map-side combine: at most 2**digit rows a task, whatever the input),
which tells the group that holds the k-th; the next pass looks at that group alone. A
group of few values is read and sorted at once, so two passes do for most columns. No
value is shuffled and no task holds more than one digit's counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kth_smallest(df: DataFrame, column: str, k: int | Callable[[int], int], bits: int = 60, digit: int = 15,
                 few: int = 10_000) -> tuple[int, int, int]:
    """(the k-th smallest value from 1 on, how many are smaller, how many are equal); NULLs are left out.

    ``k`` may be a function of the number of values, which the first pass counts anyway.
    Raises ValueError when fewer than k values exist. Values lie in 0 .. 2**bits - 1.
    """
    value = F.col(column).cast("long")
    prefix, left, below, group = 0, bits, 0, None
    while True:
        within = df.filter(F.shiftright(value, left) == F.lit(prefix)) if left < bits else df.filter(value.isNotNull())
        if left == 0:
            return prefix, below, group
        if group is not None and group <= few:
            values = sorted(r.v for r in within.select(value.alias("v")).collect())     # at most ``few`` numbers
            found = values[k - below - 1]
            smaller = sum(v < found for v in values)
            return found, below + smaller, sum(v == found for v in values)
        step = min(digit, left)
        counts = within.groupBy(F.shiftright(value, left - step).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
        left -= step
        if callable(k):
            k = k(sum(r.n for r in counts))
        for r in sorted(counts, key=lambda r: r.d):
            if below + r.n >= k:
                prefix, group = r.d, r.n
                break
            below += r.n
        else:
            raise ValueError(f"{column} has {below} values, fewer than {k}")
