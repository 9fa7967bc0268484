"""Dense 0-based ordinals of distinct values, computed without a global window.

``dense_rank()`` over an unpartitioned window moves every row to one task. Here
the distinct values are range-partitioned and sorted inside each partition,
materialised once through a reliable checkpoint (so the range boundaries do not
change between the jobs that read them), counted per partition, and numbered
as ``offset(partition) + position inside the partition``. The only data that
crosses to one place is one count per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir


def global_ordinal(df: DataFrame, col: str, name: str = "ordinal") -> DataFrame:
    """Distinct values of ``col`` with their 0-based rank in ascending order."""
    ensure_checkpoint_dir(df.sparkSession)
    ranked = (df.select(col).distinct()
              .repartitionByRange(F.col(col).asc())
              .sortWithinPartitions(F.col(col).asc())
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id() - (F.col("_part").cast("long") * F.lit(1 << 33))))
    ranked = ranked.checkpoint(eager=True)
    sizes = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, not by the data
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (ranked.join(F.broadcast(offsets.select("_part", "_off")), "_part")
            .select(col, (F.col("_off") + F.col("_pos")).cast("int").alias(name)))


def global_ordinals(df: DataFrame, cols: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Dense 0-based ranks of the distinct values of several string columns in
    one pass: rows ``(column index, value, ordinal)``.

    The columns are stacked as (index, value), de-duplicated, range-partitioned
    and sorted by (index, value), and materialised once; each value's ordinal
    is the count of its column's values in earlier partitions plus its place
    among its column's values in its own partition. Only one row per
    (partition, column) meets in one place.
    """
    ensure_checkpoint_dir(df.sparkSession)
    stacked = (df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("string").alias("_v"))
                                             for i, c in enumerate(cols)])).alias("s"))
               .select("s._c", "s._v").distinct())
    ranked = (stacked.repartitionByRange(F.col("_c").asc(), F.col("_v").asc())
              .sortWithinPartitions(F.col("_c").asc(), F.col("_v").asc())
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id() - (F.col("_part").cast("long") * F.lit(1 << 33))))
    ranked = ranked.checkpoint(eager=True)
    sizes = ranked.groupBy("_part", "_c").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    # at most (partitions x columns) rows
    before = Window.partitionBy("_c").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (ranked.join(F.broadcast(offsets.select("_part", "_c", "_off", "_first")), ["_part", "_c"])
            .select("_c", "_v", (F.col("_off") + F.col("_pos") - F.col("_first")).cast("int").alias(name)))


def encode_labels(df: DataFrame, cols: Sequence[str], suffix: str = "_encoded",
                  missing: str = "Unknown") -> DataFrame:
    """Ordinal label encoding with sorted labels; NULL is encoded as ``missing``.

    Equivalent to fitting a label encoder on the filled column: code i is the
    i-th label in ascending order. All columns are ranked in one pass
    (:func:`global_ordinals`); each code table is joined back with a plain
    join: its size is the label count, so Catalyst/AQE decide on broadcasting.
    """
    labels = [f"_{c}_label" for c in cols]
    out = df.select("*", *[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(lab)
                           for c, lab in zip(cols, labels)])
    codes = global_ordinals(out, labels)
    for i, (c, lab) in enumerate(zip(cols, labels)):
        table = codes.filter(F.col("_c") == F.lit(i)).select(F.col("_v").alias(lab), F.col("ordinal").alias(c + suffix))
        out = out.join(table, lab, "left").drop(lab)
    return out
