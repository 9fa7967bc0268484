"""Model stage: stable hold-out split, feature vector, random forest, scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.classify import band, threshold
from strata.operators.select import kth_smallest

# The prediction bands and their labels, right-closed:
# (0, 0.3] Off Track, (0.3, 0.5] At Risk, (0.5, 0.7] Moderate Progress, (0.7, 1.0] On Track.
CATEGORY_EDGES = (0.0, 0.3, 0.5, 0.7, 1.0)
CATEGORY_LABELS = ("Off Track", "At Risk", "Moderate Progress", "On Track")


def hold_out(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42,
             name: str = "is_test") -> DataFrame:
    """Row-exact split: ``ceil(test_fraction * n)`` rows are test rows, those whose keys hash lowest.

    The hash is the first 60 bits of an MD5 over the keys and the seed, so the split is the
    same under repartitioning, after the loss of an executor (unlike ``randomSplit``, which
    depends on row order) and in any engine with MD5. The last test row's hash is found by
    counting digits (``kth_smallest``); no sort of all rows. Rows with that very hash (equal
    keys) are ordered among themselves by all their columns. ``df`` is read about three
    times; pass a written or checkpointed frame if it is costly.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    hashed = df.withColumn("_hash", F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"))
    # the hash is not NULL (concat_ws skips NULL keys): every row counts
    if test_fraction <= 0 or df.isEmpty():
        return df.withColumn(name, F.lit(False))
    size = []
    last, below, equal = kth_smallest(hashed, "_hash", lambda n: size.append(math.ceil(test_fraction * n)) or size[0])
    wanted = size[0]
    if below + equal == wanted:
        return hashed.withColumn(name, F.col("_hash") <= F.lit(last)).drop("_hash")
    order = Window.partitionBy("_hash").orderBy(*[F.col(c) for c in df.columns])
    tied = (hashed.filter(F.col("_hash") == F.lit(last)).withColumn("_place", F.row_number().over(order))
            .withColumn(name, F.col("_place") <= F.lit(wanted - below)).drop("_hash", "_place"))
    rest = hashed.filter(F.col("_hash") != F.lit(last)).withColumn(name, F.col("_hash") < F.lit(last)).drop("_hash")
    return rest.unionByName(tied)


def assemble(df: DataFrame, features: Sequence[str], name: str = "features") -> DataFrame:
    """NULL/NaN features become 0, then one vector column."""
    filled = df
    for c in features:
        v = F.col(c).cast("double")
        filled = filled.withColumn(c, F.when(v.isNull() | F.isnan(v), F.lit(0.0)).otherwise(v))
    return VectorAssembler(inputCols=list(features), outputCol=name).transform(filled)


TASK_ROWS = 50_000


def dealt_out(train: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows, in partitions of ``task_rows`` at most; they stay where they are if no partition holds more.

    A forest keeps every row with its tree counts cached (over a kilobyte a row for 100 trees)
    and reads it in each pass. The feature table's last exchange is far smaller than that and
    is coalesced to a few partitions at any size, so the rows are dealt out by their number.
    """
    held = train.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    held = held.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    return train if (held["most"] or 0) <= task_rows else train.repartition(math.ceil(held["rows"] / task_rows))


def fit_forest(train: DataFrame, label: str, trees: int = 100, depth: int = 10, seed: int = 42,
               features: str = "features", max_memory_mb: int = 1024, cache_node_ids: bool = True):
    """MLlib random forest (bootstrap, sqrt feature subsets per split).

    ``max_memory_mb`` lets one pass over the data grow more nodes at once and
    ``cache_node_ids`` keeps each row's node between passes (checkpointed in
    the shared folder every 10 iterations), both cutting the passes a deep
    forest needs; neither changes the model's parameters. Many rows are dealt
    out first (``dealt_out``).
    """
    rf = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees,
                                maxDepth=depth, seed=seed, maxMemoryInMB=max_memory_mb,
                                cacheNodeIds=cache_node_ids)
    return rf.fit(dealt_out(train.select(label, features)))


def score(model, df: DataFrame, prob_name: str = "prediction_2030_probability",
          flag_name: str = "prediction_2030_on_track",
          category_name: str = "prediction_category") -> DataFrame:
    """Positive-class probability, 0/1 flag (p >= 0.5) and the band label."""
    scored = model.transform(df)
    p = vector_to_array(F.col(model.getProbabilityCol()))
    prob = F.when(F.size(p) > 1, p[1]).otherwise(F.lit(0.0))
    return (scored.withColumn(prob_name, prob)
            .withColumn(flag_name, threshold(F.col(prob_name), 0.5))
            .withColumn(category_name, band(F.col(prob_name), CATEGORY_EDGES, CATEGORY_LABELS)))


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of right predictions, and the rows it is taken over."""
    return scored.agg(F.avg((F.col(prediction) == F.col(label).cast("double")).cast("double")).alias("accuracy"),
                      F.count(F.lit(1)).alias("test_rows"))


def importances(model, features: Sequence[str], top: int | None = None) -> DataFrame:
    """Feature importance table (one row per feature: driver-sized by nature)."""
    spark = SparkSession.getActiveSession()
    values = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)], "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), F.col("feature").asc())
    return df.limit(top) if top else df
