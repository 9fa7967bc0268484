"""Group-level measures: exact distinct count with avg/min/max, distinct counts that merge, distinct rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_measures(df: DataFrame, keys: Sequence, distinct: str, measure: str,
                    names: Sequence[str] = ("indicators_measured", "avg_indicator_value",
                                            "min_indicator_value", "max_indicator_value"),
                    partition_by: Sequence[str] | None = None, nan_extremes: bool = False) -> DataFrame:
    """GROUP BY keys: COUNT(DISTINCT distinct), AVG, MIN, MAX of measure.

    Default: one ``groupBy().agg``; Spark plans the distinct count as an
    aggregation on (keys, distinct) followed by one on keys, each with
    map-side partial aggregation, so a hot key is combined inside each map
    task before it is shuffled.

    ``partition_by`` (a subset of ``keys``) spells the same two levels out and
    hash-partitions the first level's output by those columns only. Later
    operators keyed by a superset of them (the second level, a join on them, a
    window partitioned by them) then need no further exchange. The first level
    has already combined every (key, distinct value) pair, so even a key
    holding a third of all rows arrives as a bounded number of rows.
    """
    n_distinct, n_avg, n_min, n_max = names
    m = F.col(measure)
    nan = F.lit(float("nan"))
    if not partition_by:
        out = df.groupBy(*keys).agg(
            F.count_distinct(distinct).alias(n_distinct),
            F.avg(measure).alias(n_avg),
            F.min(measure).alias(n_min),
            F.max(measure).alias(n_max),
            *([F.max(F.isnan(m).cast("int")).alias("_nan")] if nan_extremes else []),
        )
    else:
        level1 = (df.groupBy(*keys, distinct)
                  .agg(F.sum(m).alias("_s"), F.count(m).alias("_n"), F.min(m).alias("_mn"), F.max(m).alias("_mx"),
                       *([F.max(F.isnan(m).cast("int")).alias("_nan1")] if nan_extremes else []))
                  .repartition(*partition_by))
        out = level1.groupBy(*keys).agg(
            F.count(F.col(distinct)).alias(n_distinct),
            F.try_divide(F.sum("_s"), F.sum("_n")).alias(n_avg),
            F.min("_mn").alias(n_min),
            F.max("_mx").alias(n_max),
            *([F.max("_nan1").alias("_nan")] if nan_extremes else []),
        )
    if not nan_extremes:
        return out
    # warehouse semantics: any NaN in the group makes MIN and MAX NaN (Spark's
    # MIN skips NaN because it orders NaN above every number)
    return (out.withColumn(n_min, F.when(F.col("_nan") == 1, nan).otherwise(F.col(n_min)))
            .withColumn(n_max, F.when(F.col("_nan") == 1, nan).otherwise(F.col(n_max))).drop("_nan"))


def distinct_rows(df: DataFrame, cols: Sequence[str], where=None) -> DataFrame:
    out = df.select(*cols)
    if where is not None:
        out = out.filter(where)
    return out.distinct()


def distinct_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, bucket, bits): the exact set of the integer ``value`` per group, as bitmaps of 32,768 values.

    A stored state answers distinct counts at any coarser grain (``distinct_counts``) and
    takes later loads (``merge_states``) without the rows it came from. Bitmaps are built in
    each map task, so a hot group sends one bitmap per bucket and task, and a group's set is
    spread over its buckets. A bitmap has 4 KB: the state is for dense integers (surrogate
    keys, the ordinals of ``ordinal.encode_labels``) and groups with many of them; for
    groups of a few values ``count_distinct`` is smaller. NULL is no value; a group with
    none but NULLs keeps an empty bitmap (bucket 0).
    """
    v = F.col(value).cast("long")
    bucket = F.coalesce(F.bitmap_bucket_number(v), F.lit(0).cast("long"))
    return (df.select(*keys, bucket.alias("bucket"), F.bitmap_bit_position(v).alias("bit"))
            .groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))


def merge_states(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One state of several loads' states (values that they share count once)."""
    out = states[0]
    for other in states[1:]:
        out = out.unionByName(other)
    return out.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, grains: Mapping[str, Sequence[str]], name: str) -> DataFrame:
    """(grain, every key of the state or NULL, count): exact distinct counts at several grains of one state."""
    keys = [c for c in state.columns if c not in ("bucket", "bits")]
    types = dict(state.dtypes)
    parts = []
    for grain, cols in grains.items():
        merged = state.groupBy(*cols, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        counted = merged.groupBy(*cols).agg(F.sum(F.bitmap_count("bits")).alias(name))
        parts.append(counted.select(F.lit(grain).alias("grain"), *[
            F.col(k) if k in cols else F.lit(None).cast(types[k]).alias(k) for k in keys],
            F.coalesce(name, F.lit(0).cast("long")).alias(name)))
    return reduce(DataFrame.unionByName, parts)
