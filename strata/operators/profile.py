"""Data-quality profiles: row counts, coverage, counts by key, null counts,
ordered samples, category shares and best/worst groups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.functions.clean import as_column
from strata.operators.joins import inline_table

COUNT_SCHEMA = StructType([
    StructField("layer", StringType()),
    StructField("table_name", StringType()),
    StructField("row_count", LongType()),
    StructField("error", StringType()),
])


def table_counts(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]],
                 layer: str = "raw") -> DataFrame:
    """One row per table: (layer, table_name, row_count, error).

    ``tables`` maps names to zero-argument loaders. A table that cannot be
    resolved is reported with its error text and a NULL count; the others
    still run. All counts execute as one job (a union of global aggregates).
    """
    parts = []
    failed = []
    for name, load in tables.items():
        try:
            df = load()
            parts.append(df.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                                   F.count(F.lit(1)).alias("row_count"),
                                   F.lit(None).cast("string").alias("error")))
        except Exception as exc:  # reported, not raised: one bad table must not stop the report
            failed.append((layer, name, None, str(exc)))
    if failed:
        parts.append(spark.createDataFrame(failed, COUNT_SCHEMA))
    if not parts:
        return spark.createDataFrame([], COUNT_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), parts)


def coverage(df: DataFrame, distinct: Mapping[str, str], range_col: str,
             range_names: tuple[str, str] = ("min_year", "max_year"), approx: bool = False) -> DataFrame:
    """COUNT(DISTINCT c) for each named column plus MIN/MAX of ``range_col``."""
    count = F.approx_count_distinct if approx else F.count_distinct
    aggs = [count(F.col(c)).alias(name) for name, c in distinct.items()]
    aggs += [F.min(range_col).alias(range_names[0]), F.max(range_col).alias(range_names[1])]
    return df.agg(*aggs)


def count_by(df: DataFrame, key, name: str, default=None, count_name: str = "data_points") -> DataFrame:
    """Rows per key; with ``default`` the group key is the coalesced expression,
    so NULL and the default land in one group."""
    k = as_column(key)
    if default is not None:
        k = F.coalesce(k, F.lit(default))
    return df.groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias(count_name))


def null_profile(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """SUM(CASE WHEN c IS NULL THEN 1 ELSE 0 END) per column (NULL on empty input)."""
    return df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(name)
                    for name, c in cols.items()])


def top_n(df: DataFrame, by: str, n: int, tie: Sequence[str] = (), ascending: bool = False,
          nan_last: bool = True) -> DataFrame:
    """Ordered sample: ORDER BY by (DESC by default), tie... LIMIT n.

    NULLs sort last; with ``nan_last`` a NaN sorts after every number and
    before NULL (Spark alone orders NaN above +inf, i.e. first in a
    descending sort). Plans as TakeOrderedAndProject: each task
    keeps n rows, no full sort.
    """
    keys: list[Column] = []
    if nan_last and df.schema[by].dataType.typeName() in ("double", "float"):
        # numbers first, then NaN, then NULL
        keys.append(F.when(F.col(by).isNull(), F.lit(2)).when(F.isnan(F.col(by)), F.lit(1)).otherwise(F.lit(0)).asc())
    keys.append(F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last())
    keys += [F.col(t).asc_nulls_last() for t in tie]
    return df.orderBy(*keys).limit(n)


def category_share(df: DataFrame, col: str, labels: Sequence[str], name: str = "category",
                   count_name: str = "count", share_name: str = "share_pct") -> DataFrame:
    """Count per category over the full label list (0 for absent labels), with
    the share of ALL rows, uncategorised ones included, in percent."""
    spark = df.sparkSession
    label_df = inline_table(spark, [(lab, i) for i, lab in enumerate(labels)],
                            f"{name} string, position int")
    # one pass over df: the counted categories (a few rows, NULL among them) carry the total of
    # all rows as a window sum over them, and the labels join that
    counted = df.groupBy(F.col(col).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    hit = F.col("_label") == F.col(name)
    out = label_df.join(counted, hit, "full_outer")
    total = F.max("_all").over(Window.partitionBy())
    return (out.withColumn("_total", total).filter(F.col(name).isNotNull())
            .select(name, "position", F.coalesce("_n", F.lit(0)).cast("long").alias(count_name),
                    (F.coalesce("_n", F.lit(0)) * F.lit(100.0) / F.col("_total")).alias(share_name)))


def best_worst(df: DataFrame, key: str, score: str, n: int = 10, mean_name: str = "mean_score") -> DataFrame:
    """Mean score per key, then the n highest and the n lowest (ties by key)."""
    means = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(score).alias(mean_name))
    best = means.orderBy(F.col(mean_name).desc_nulls_last(), F.col(key).asc()).limit(n)
    worst = means.orderBy(F.col(mean_name).asc_nulls_last(), F.col(key).asc()).limit(n)
    w_best = Window.orderBy(F.col(mean_name).desc_nulls_last(), F.col(key).asc())
    w_worst = Window.orderBy(F.col(mean_name).asc_nulls_last(), F.col(key).asc())
    # the windows below run over at most n rows each (after the limit)
    return (best.withColumn("side", F.lit("best")).withColumn("position", F.row_number().over(w_best))
            .unionByName(worst.withColumn("side", F.lit("worst")).withColumn("position", F.row_number().over(w_worst))))


def fanout(joined: DataFrame, left_keys: Sequence[str], name: str = "fanout_rows") -> DataFrame:
    """Rows a join added beyond one per left row: ``count(*) - count(distinct left keys)``.
    Zero means the join kept the left side's grain. A NULL in a key is a value like any other."""
    return joined.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*left_keys))).alias(name))


def duplicate_keys(df: DataFrame, key: str, count_name: str = "copies") -> DataFrame:
    """Keys that occur more than once (e.g. a surrogate id built from fewer
    columns than the grain), with their number of copies."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
            .filter(F.col(count_name) > F.lit(1)))


def footer_profile(spark: SparkSession, path: str, ranges: Sequence[str] = ()) -> DataFrame:
    """One row from the footers of parquet files alone: ``row_count``, ``<c>_min`` and ``<c>_max`` of the columns.

    The files are read by Spark's V2 source, which answers counts, minima and maxima of
    numbers, dates and booleans from row-group statistics: no data page is read, so the
    cost grows with the number of files. The reader's settings are a session's, so the
    frame belongs to one of its own.
    """
    own = spark.newSession()
    v1 = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in v1 if x != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in ranges:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return own.read.parquet(path).agg(*aggs)
