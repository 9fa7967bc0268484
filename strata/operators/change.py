"""Period-over-period change: previous present row and the difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir


def lag_delta(df: DataFrame, partition: Sequence[str], order: Sequence[str], measure: str,
              prev_name: str = "prev_value", delta_name: str = "change",
              tie: Sequence[str] = ()) -> DataFrame:
    """LAG(measure) over (partition, order) and ``measure - LAG(measure)``.

    Steps to the previous present row, not the previous calendar period. Both
    columns share one window, so Spark sorts once. ``tie`` adds secondary order
    columns to make the result deterministic when ``order`` has duplicates.
    The window only sees one partition key group per task; callers aggregate to
    one row per period first, so a group holds at most one row per period;
    ``lag_delta_ranged`` takes series of any length.
    """
    w = Window.partitionBy(*partition).orderBy(*order, *tie)
    prev = F.lag(F.col(measure)).over(w)
    return df.withColumn(prev_name, prev).withColumn(delta_name, F.col(measure) - F.col(prev_name))


def lag_delta_ranged(df: DataFrame, partition: Sequence[str], order: Sequence[str], measure: str,
                     prev_name: str = "prev_value", delta_name: str = "change",
                     tie: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``lag_delta`` for series at row grain, where one key may hold a large part of all rows.

    Rows are range-partitioned by (partition, order), so a long series is cut into several
    ranges, and written once (checkpoint: the ranges must not change between the steps). LAG
    runs within each range; a series' last value in a range is handed to the first row of
    its next range by a window over one row per (range, key). Rows that agree in key, order
    and tie lie in one range. NULL keys form a series, as in a window. ``ranges`` fixes the number of ranges
    (default: the shuffle partitions, which AQE coalesces by size).
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(*([ranges] if ranges else []), *[F.col(c).asc() for c in [*partition, *order, *tie]])
              .withColumn("_range", F.spark_partition_id()).checkpoint(eager=True))
    inside = Window.partitionBy("_range", *partition).orderBy(*order, *tie)
    local = (ranged.withColumn("_place", F.row_number().over(inside)).withColumn("_prev", F.lag(measure).over(inside))
             .withColumn("_last", F.lead(F.lit(True)).over(inside).isNull()))
    along = Window.partitionBy(*partition).orderBy("_range")
    handed = (local.filter("_last").select(F.col("_range").alias("_at"), *[F.col(c).alias(f"_key_{c}") for c in partition],
                                           F.lag(measure).over(along).alias("_handed"), F.row_number().over(along).alias("_nth"))
              .filter("_nth > 1"))
    same = (F.col("_place") == 1) & (F.col("_range") == F.col("_at"))
    for c in partition:
        same = same & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    prev = F.when(F.col("_place") == 1, F.col("_handed")).otherwise(F.col("_prev"))
    return (local.join(handed, same, "left").select(*df.columns, prev.alias(prev_name))
            .withColumn(delta_name, F.col(measure) - F.col(prev_name)))
