"""Per-entity feature profiles, latest values, exact medians and fills.

The median is exact and distributed: counted values are range-partitioned,
one count per partition places the middle ranks, and only the partitions that
hold them are ordered. No step holds a column in one task, unlike
``median()``/``percentile()``, whose final merge keeps every distinct value of
the group in one place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, IntegerType, LongType, ShortType, StringType,
                               TimestampNTZType, TimestampType)

from strata.functions.clean import as_column
from strata.session import ensure_checkpoint_dir


def _order_number(df: DataFrame, name: str) -> tuple[Column, int, int] | None:
    """An order column as a whole number with its least value and bits by type; None for other types."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, BooleanType):
        return c.cast("long"), 0, 1
    if isinstance(kind, (ByteType, ShortType, IntegerType)):
        return c.cast("long"), -(1 << 31), 32
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("long"), -(1 << 31), 32
    if isinstance(kind, LongType):
        return c, -(1 << 63), 64
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        # years 1 to 9999 lie well within 2**59 microseconds of 1970
        seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60
        micros = (F.unix_micros(c) if isinstance(kind, TimestampType)  # a local time needs no time zone
                  else seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long"))
        return (F.when(F.abs(micros) >= 1 << 59, F.raise_error(F.lit(f"{name} is out of range")).cast("long"))
                .otherwise(micros)), -(1 << 59), 60
    return None


def packed_order(df: DataFrame, order: Sequence[str], measure: bool = True) -> Column | None:
    """The order columns as one number that compares as they do, one after the other (NULL least).

    A maximum over a struct keeps a struct in the aggregation buffer, which makes Spark
    sort all rows; a number is of fixed size and aggregates by hash. With ``measure`` the
    columns' least and greatest values are read first (one aggregate over these columns):
    the bits they take mostly fit into one long. Else, and where they don't, the number is
    a decimal. None if a column's type has no such number (text, floating point) or the
    columns need more than 126 bits.
    """
    parts = [_order_number(df, o) for o in order]
    if any(p is None for p in parts):
        return None
    lows, bits = [low for _, low, _ in parts], [bits + 1 for _, _, bits in parts]
    if measure:
        row = df.agg(*[f(number).alias(f"{name}{i}") for i, (number, _, _) in enumerate(parts)
                       for f, name in ((F.min, "low"), (F.max, "high"))]).first()
        spans = [(row[f"low{i}"] or 0, row[f"high{i}"] or 0) for i in range(len(parts))]
        narrow = [max(1, (high - low + 1).bit_length()) for low, high in spans]
        if sum(narrow) <= 62:
            packed = None
            for (number, _, _), (low, _), width in zip(parts, spans, narrow):
                place = F.coalesce(number - F.lit(low - 1).cast("long"), F.lit(0).cast("long")) if low > -(1 << 63) else (
                    F.coalesce(number - F.lit(low).cast("long") + 1, F.lit(0).cast("long")))
                packed = place if packed is None else F.shiftleft(packed, width).bitwiseOR(place)
            return packed
    if sum(bits) > 126:
        return None
    packed = None
    for (number, _, _), low, width in zip(parts, lows, bits):
        place = F.coalesce(number.cast("decimal(20,0)") + F.lit(Decimal(1 - low)), F.lit(Decimal(0))).cast("decimal(38,0)")
        packed = place if packed is None else ((packed * F.lit(Decimal(1 << width))).cast("decimal(38,0)") + place).cast("decimal(38,0)")
    return packed


def order_key(df: DataFrame, order: Sequence[str]) -> Column:
    """One column to order by: the single order column itself, the packed number, else a struct."""
    if len(order) == 1:
        return F.col(order[0])
    packed = packed_order(df, order)
    return F.struct(*[F.col(o) for o in order]) if packed is None else packed


def latest_value(value, ordering: Column) -> Column:
    """Last non-null ``value`` by ``ordering`` (see ``order_key``): max_by with NULL values skipped.

    ``max_by`` ignores rows whose ordering is NULL, so masking the ordering
    where the value is NULL gives ``FILTER (WHERE value IS NOT NULL)``.
    """
    value = as_column(value)
    return F.max_by(value, F.when(value.isNotNull(), ordering))


def entity_profile(df: DataFrame, keys: Sequence[str], measure: str, order: Sequence[str],
                   change: str | None = None, period: str | None = None,
                   extra_mean: Mapping[str, str] | None = None,
                   carry: Sequence[str] = (), carry_order: Sequence[str] | None = None) -> DataFrame:
    """One grouped pass computing the per-entity profile of a measure.

    value_mean, value_std (sample, 0 when undefined), value_min, value_max,
    value_latest (last non-null by ``order``); with ``change``: avg_yoy_change
    and total_change (0 when no change is known); with ``period``: data_points
    (rows with a period) and latest_year; ``extra_mean`` adds named means.
    ``carry`` adds, per column, its latest non-null value in the group by
    ``carry_order`` and that ordering (``<col>__at``), so a coarser entity's
    latest values can be rolled up from this result (:func:`roll_latest`)
    without a second pass over the rows.
    """
    m = F.col(measure)
    aggs = [
        F.avg(m).alias("value_mean"),
        F.coalesce(F.stddev_samp(m), F.lit(0.0)).alias("value_std"),
        F.min(m).alias("value_min"),
        F.max(m).alias("value_max"),
        latest_value(m, order_key(df, order)).alias("value_latest"),
    ]
    if change:
        aggs += [F.coalesce(F.avg(change), F.lit(0.0)).alias("avg_yoy_change"),
                 F.coalesce(F.sum(change), F.lit(0.0)).alias("total_change")]
    if period:
        aggs += [F.count(period).alias("data_points"), F.max(period).alias("latest_year")]
    for name, c in (extra_mean or {}).items():
        aggs.append(F.avg(c).alias(name))
    if carry:
        at = order_key(df, carry_order or order)
        for c in carry:
            present = F.when(F.col(c).isNotNull(), at)
            aggs += [F.max_by(F.col(c), present).alias(c), F.max(present).alias(f"{c}__at")]
    keep = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(keep).groupBy(*keys).agg(*aggs)


def roll_latest(profile: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per ``key``, each carried column's value with the greatest ``<col>__at``
    (see ``entity_profile(carry=...)``): the latest non-null value over all the
    key's groups, identical to :func:`latest_non_null` on the original rows."""
    return (profile.filter(F.col(key).isNotNull())
            .groupBy(key).agg(*[F.max_by(F.col(c), F.col(f"{c}__at")).alias(c) for c in cols]))


def latest_non_null(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per key, each column's latest non-null value, independently per column.

    Text columns are aggregated as two 64-bit hashes (which a row's maximum takes together) and
    read back from the column's distinct texts, so that the rows aggregate by hash.
    """
    rows, at = df.filter(F.col(key).isNotNull()), order_key(df, order)
    texts = [c for c in cols if isinstance(df.schema[c].dataType, StringType)]
    hashes = lambda c: [F.xxhash64(c), F.xxhash64(F.lit("second"), c)]
    aggs = []
    for c in cols:
        present = F.when(F.col(c).isNotNull(), at)
        aggs += ([F.max_by(h, present).alias(f"_{i}_{c}") for i, h in enumerate(hashes(c))] if c in texts
                 else [F.max_by(c, present).alias(c)])
    out = rows.groupBy(key).agg(*aggs)
    for c in texts:
        named = rows.filter(F.col(c).isNotNull()).select(c).distinct().select(c, *[h.alias(f"_{i}_{c}") for i, h in enumerate(hashes(c))])
        out = out.join(named, [f"_0_{c}", f"_1_{c}"], "left")
    return out.select(key, *cols)


def _midpoint(v_lo: float, v_hi: float) -> float:
    """Interpolated median of the two middle values, ``lo + (hi - lo) / 2``
    (the same arithmetic as DuckDB's); equal values are returned as they are,
    which keeps an infinite median infinite."""
    return float(v_lo) if v_lo == v_hi else float(v_lo + (v_hi - v_lo) * 0.5)


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact median (mean of the two middle values for an even count) of each
    column, NULL and NaN skipped; None for a column without values.

    All columns are ranked together, in the same way at any size: (column,
    value) pairs are counted with a map-side combine, so a value that a third
    of the rows share is one row; the distinct pairs are range-partitioned and
    written once (checkpoint); the driver reads one count per partition and
    column, which tells the partition and place of the middle ranks; only the
    range partitions that hold them are then ordered.
    """
    if not cols:
        return {}
    found, totals = _middle_values(_measured(df, cols))
    return {c: _midpoint(*found[i]) if i in totals else None for i, c in enumerate(cols)}


def _measured(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c, x): every value that is a number, with its column's place among ``cols``."""
    return (df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x"))
                                          for i, c in enumerate(cols)])).alias("s")).select("s.c", "s.x")
            .filter(F.col("x").isNotNull() & ~F.isnan("x")))


def _middle_values(pairs: DataFrame, totals: dict[int, int] | None = None) -> tuple[dict[int, list[float | None]], dict[int, int]]:
    """The two middle values of each column, and the columns' sizes (counted here if not given).

    A NULL value counts as smaller than all others. Where ``totals`` counts more rows than
    there are, a middle rank past the last row is left out.
    """
    ensure_checkpoint_dir(pairs.sparkSession)
    ranked = (pairs.groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))
              .repartitionByRange(F.col("c").asc(), F.col("x").asc())
              .withColumn("part", F.spark_partition_id()).checkpoint(eager=True))
    sizes = ranked.groupBy("c", "part").agg(F.sum("n").alias("n")).collect()
    if totals is None:
        totals = {}
        for r in sizes:
            totals[r.c] = totals.get(r.c, 0) + r.n
    wanted: dict[tuple[int, int], tuple[int, set[int]]] = {}    # (column, partition) -> rows before it, middle ranks
    before: dict[int, int] = {}
    for r in sorted(sizes, key=lambda r: (r.c, r.part)):
        start = before.get(r.c, 0)
        middle = {k for k in ((totals[r.c] - 1) // 2, totals[r.c] // 2) if start <= k < start + r.n}
        if middle:
            wanted[r.c, r.part] = (start, middle)
        before[r.c] = start + r.n
    found: dict[tuple[int, int], float] = {}
    if wanted:
        held = reduce(lambda a, b: a | b, [(F.col("c") == c) & (F.col("part") == p) for c, p in wanted])
        upto = Window.partitionBy("c", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = ranked.filter(held).withColumn("end", F.sum("n").over(upto))
        hit = reduce(lambda a, b: a | b, [
            (F.col("c") == c) & (F.col("part") == p) & (F.col("end") > k - start) & (F.col("end") - F.col("n") <= k - start)
            for (c, p), (start, middle) in wanted.items() for k in middle])
        for r in running.filter(hit).collect():              # at most two rows per column
            start, middle = wanted[r.c, r.part]
            for k in middle:
                if r.end - r.n <= k - start < r.end:
                    found[r.c, k] = r.x
    return {c: [found[c, k] for k in ((n - 1) // 2, n // 2) if (c, k) in found] for c, n in totals.items()}, totals


def bracketed_medians(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000) -> dict[str, float | None]:
    """The values of ``exact_medians``, with only the values near the middle shuffled.

    Pass 1 aggregates one mergeable quantile sketch per column, whose ranks are wrong by a
    share of 1 / ``accuracy`` at most, to a bracket of two such shares on either side of the
    middle, and counts the column. Pass 2 ranks the values inside the brackets (about 6 of
    ``accuracy`` rows, and those equal to a bound); smaller ones go as one counted row a task,
    greater ones not at all. A middle rank outside its bracket opens the bracket and ranks
    the column again, so the result never rests on the sketch.
    """
    if not cols:
        return {}
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    shares = [max(0.0, 0.5 - 2 / accuracy), min(1.0, 0.5 + 2 / accuracy)]
    row = df.agg(*[F.struct(F.count(number(c)).alias("n"), F.percentile_approx(number(c), shares, accuracy).alias("at")).alias(f"_{i}")
                   for i, c in enumerate(cols)]).first()
    totals = {i: row[i].n for i in range(len(cols)) if row[i].n}
    bounds, out = {i: tuple(row[i].at) for i in totals}, {}
    while len(out) < len(totals):
        left = [i for i in totals if i not in out]
        low, high = (F.create_map(*[F.lit(v) for i in left for v in (i, float(bounds[i][side]))])[F.col("c")] for side in (0, 1))
        pairs = _measured(df, [cols[i] for i in left]).withColumn("c", F.array(*map(F.lit, left))[F.col("c")])
        near = pairs.filter(F.col("x") <= high).withColumn("x", F.when(F.col("x") >= low, F.col("x")))
        found, _ = _middle_values(near, {i: totals[i] for i in left})
        for i in left:
            if len(found[i]) == 2 and None not in found[i]:
                out[i] = _midpoint(*found[i])
            else:
                bounds[i] = (float("-inf"), float("inf"))
    return {c: out.get(i) for i, c in enumerate(cols)}


def approx_medians(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000) -> dict[str, float | None]:
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in cols]).first()
    return {c: (None if row[c] is None else float(row[c])) for c in cols}


def median_fill(df: DataFrame, cols: Sequence[str], approx: bool = False,
                medians: Mapping[str, float | None] | None = None) -> DataFrame:
    """Fill NULLs of each column with that column's median (as double).

    A column with no values at all keeps its NULLs (its median is missing too).
    """
    meds = dict(medians) if medians is not None else (approx_medians(df, cols) if approx else exact_medians(df, cols))
    out = df
    for c in cols:
        filled = F.col(c).cast("double")
        if meds.get(c) is not None:
            filled = F.coalesce(filled, F.lit(float(meds[c])))
        out = out.withColumn(c, filled)
    return out


def above_median_flag(df: DataFrame, col: str, name: str, approx: bool = False,
                      median: float | None = None, materialize: bool = False) -> DataFrame:
    """``name = (col > median(col))`` as 0/1 (strict; a NULL median gives 0).
    ``median`` may be passed when it was computed together with others.
    ``materialize`` checkpoints ``df`` (shared checkpoint folder) first, so the
    median passes and the flagged result read it instead of recomputing it."""
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    med = median if median is not None else (
        approx_medians(df, [col]) if approx else exact_medians(df, [col]))[col]
    if med is None:
        return df.withColumn(name, F.lit(0))
    return df.withColumn(name, F.coalesce((F.col(col) > F.lit(med)).cast("int"), F.lit(0)))
