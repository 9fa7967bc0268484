"""Steps that several operators share: written tables, joins by id, summed counters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.session import scratch_path

BROADCAST_IDS = 500_000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def by_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi- or anti-join on doc_id: the counted ids are broadcast up to BROADCAST_IDS, else both sides are dealt out."""
    ids = written(ids.distinct(), "ids")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
    return docs.join(side, "doc_id", how).select(*docs.columns)


def flagged(docs: DataFrame, ids: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The columns, and ``flag``: whether doc_id is among the ids (sent as in ``by_ids``)."""
    ids = written(ids.select(F.col("doc_id").alias("id of a flagged row")).distinct(), "ids")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
    joined = docs.join(side, F.col("doc_id") == F.col("id of a flagged row"), "left")
    return joined.select(*[c.alias(n) for n, c in columns.items()], F.col("id of a flagged row").isNotNull().alias("flag"))


PIECES = 16


def counter_rows(counters: list[np.ndarray]) -> tuple[list[int], list[int], list[bytes]]:
    """One task's counters as rows (counter, piece, counts), every counter in PIECES pieces."""
    rows = [(c, k, part.astype("<u4").tobytes()) for c, whole in enumerate(counters)
            for k, part in enumerate(np.split(whole, PIECES))]
    return tuple(map(list, zip(*rows)))


def summed(parts: DataFrame, counter: int, size: int) -> np.ndarray:
    """The sum of one counter of ``size`` numbers over all tasks' ``counter_rows``.

    Pieces are added up in two steps, so that no task holds the rows of all tasks, and
    the driver gets each piece once (``size`` numbers in all).
    """

    def add(table: pa.Table, kind: str) -> pa.Table:
        total = np.zeros(size // PIECES, np.int64)
        for x in table.column("counts"):
            total += np.frombuffer(x.as_buffer(), kind)
        return pa.table({"piece": table.column("piece").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    step = parts.where(F.col("counter") == counter).select("piece", "counts")
    step = (step.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(32)))
            .groupBy("piece", "part").applyInArrow(lambda t: add(t, "<u4"), "piece int, counts binary"))
    rows = step.groupBy("piece").applyInArrow(lambda t: add(t, "<i8"), "piece int, counts binary").collect()
    out = np.zeros((PIECES, size // PIECES), np.int64)
    for r in rows:
        out[r["piece"]] = np.frombuffer(r["counts"], "<i8")
    return out.ravel()
