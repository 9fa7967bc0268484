"""Sinks: replace-all table loads, CSV extracts and a multi-table export report.

Writers run on the executors; nothing is pulled to the driver. A single CSV
file is produced only on request (``single_file=True``), which funnels the
extract through one task and is meant for small extracts.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

EXPORT_STATUS = StructType([StructField("table_name", StringType()), StructField("path", StringType()),
                            StructField("status", StringType()), StructField("error", StringType())])

# Fixed value: the 11 prediction columns of the extract, in order.
PREDICTION_COLUMNS = ("country_code", "country_name", "goal_code", "region", "income_level",
                      "value_latest", "avg_yoy_change", "data_points",
                      "prediction_2030_probability", "prediction_2030_on_track", "prediction_category")


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _remove(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def _take_place(spark: SparkSession, staged: str, path: str) -> None:
    """Put a written folder in the place of another: two renames, undone if the second fails."""
    fs, new = _file_system(spark, staged)
    _, target = _file_system(spark, path)
    old = f"{path.rstrip('/')}__old_{uuid.uuid4().hex}"
    _, aside = _file_system(spark, old)
    existed = fs.exists(target)
    fs.mkdirs(target.getParent())
    if existed and not fs.rename(target, aside):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(new, target):
        if existed:
            fs.rename(aside, target)
        raise OSError(f"cannot put the new load in the place of {path}")
    if existed:
        _remove(spark, old)


def table_description(spark: SparkSession, table: str) -> str | None:
    """The description a catalogue table was written with."""
    return spark.catalog.getTable(table).description


def write_table(df: DataFrame, path: str | None = None, table: str | None = None,
                partition_by: Sequence[str] = (), comment: str | None = None, fmt: str = "parquet",
                bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Replace-all load (WRITE_TRUNCATE) of a path or a catalogue table.

    The load is written beside the target and takes its place only when it is complete: a
    folder by renames, a managed table by renaming the staged table, an external one by its
    folder. A load that fails half-way leaves the rows of the one before and nothing else,
    and a frame that reads the target may replace it. Between the two renames of a swap a
    reader finds no target (a rename per step, no copying).

    ``bucket_by=(n, cols)`` (catalogue tables only) hash-buckets and sorts the
    rows by ``cols`` into ``n`` buckets: later joins and aggregations on those
    columns between tables bucketed the same way (same columns, same count)
    read co-located data and skip the shuffle, e.g. the progress and economic
    facts bucketed by (country_code, year) for their two-key join.
    """
    if not path and not table:
        raise ValueError("need a path or a table name")
    if bucket_by and not table:
        raise ValueError("bucketing needs a catalogue table")
    spark, load = df.sparkSession, uuid.uuid4().hex
    rows = df
    if bucket_by:
        n, cols = bucket_by
        rows = df.repartition(n, *cols)          # one task per bucket: at most n files, not tasks times n
    w = rows.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(n, *cols).sortBy(*cols)
    staged = f"{path.rstrip('/')}__load_{load}" if path else None
    if not table:
        try:
            w.save(staged)
        except Exception:
            _remove(spark, staged)
            raise
        _take_place(spark, staged, path)
        return
    staging = f"{table}__load_{load}"
    try:
        (w.option("path", staged) if path else w).saveAsTable(staging)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        if path:
            _remove(spark, staged)
        raise
    if path:
        _take_place(spark, staged, path)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} LIKE {staging} LOCATION '{path}'")
        spark.sql(f"DROP TABLE {staging}")
        if partition_by:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        spark.catalog.refreshTable(table)
    else:
        old = f"{table}__old_{load}"
        existed = spark.catalog.tableExists(table)
        if existed:
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
        if existed:
            spark.sql(f"DROP TABLE {old}")
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS '{comment.replace(chr(39), chr(39) * 2)}'")


def csv_ready(df: DataFrame, python_booleans: bool = False) -> DataFrame:
    """Render booleans as ``True``/``False`` text when asked (pandas-style CSV)."""
    if not python_booleans:
        return df
    cols = [F.when(F.col(f.name), F.lit("True")).when(~F.col(f.name), F.lit("False")).alias(f.name)
            if isinstance(f.dataType, BooleanType) else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


CSV_OPTIONS = {"header": "true", "emptyValue": "", "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, single_file: bool = False, python_booleans: bool = False) -> None:
    """CSV with a header row and no index column; NULL is an empty field. Blanks at the
    ends of a value stay, and a quote inside a value is doubled. ``single_file`` sends the
    extract through one task (small extracts only)."""
    out = csv_ready(df, python_booleans)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """An extract as ``write_csv`` wrote it."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def export_all(spark: SparkSession, items: Mapping[str, tuple[DataFrame, str]], fmt: str = "csv") -> DataFrame:
    """Write every (frame, path); a failing item is reported, the rest continue."""
    rows = []
    for name, (df, path) in items.items():
        try:
            if fmt == "csv":
                write_csv(df, path)
            else:
                write_table(df, path=path, fmt=fmt)
            rows.append((name, path, "ok", None))
        except Exception as exc:  # reported per item
            rows.append((name, path, "error", str(exc)))
    return spark.createDataFrame(rows, EXPORT_STATUS)


def prediction_extract(scored: DataFrame, for_table: bool, predicted_at=None,
                       missing_category: str = "nan") -> DataFrame:
    """The 11 prediction columns; the table form adds ``predicted_at`` and
    renders a missing category as text, the CSV form leaves it empty."""
    out = scored.select(*PREDICTION_COLUMNS)
    if for_table:
        stamp = F.localtimestamp() if predicted_at is None else F.lit(
            predicted_at.isoformat(sep=" ") if hasattr(predicted_at, "isoformat") else str(predicted_at)
        ).cast("timestamp_ntz")
        out = (out.withColumn("prediction_category", F.coalesce(F.col("prediction_category"), F.lit(missing_category)))
               .withColumn("predicted_at", stamp))
    return out
