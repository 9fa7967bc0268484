"""Replace-all loads: the old rows stay until the new ones are complete."""

import os

import pytest
from pyspark.sql import functions as F

from strata.session import local_path, scratch_path
from strata.sources import sinks


def broken(spark, n=1000):
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken load")).cast("long")).otherwise(F.col("id"))
    return spark.range(n).repartition(4).select(bad.alias("id"))


@pytest.mark.parametrize("kind", ["path", "managed", "external", "bucketed", "partitioned"])
def test_a_failed_load_leaves_the_old_rows(spark, kind):
    path = scratch_path(spark, "load")
    name = "load_" + path.rsplit("-", 1)[-1]
    target = {"path": {"path": path}, "managed": {"table": name}, "external": {"table": name, "path": path},
              "bucketed": {"table": name, "bucket_by": (3, ["id"])},
              "partitioned": {"table": name, "path": path, "partition_by": ["p"]}}[kind]
    shaped = (lambda df: df.withColumn("p", F.col("id") % 3)) if kind == "partitioned" else (lambda df: df)
    read = lambda: spark.table(name) if "table" in target else spark.read.parquet(path)
    sinks.write_table(shaped(spark.range(5)), **target)
    for _ in range(2):
        with pytest.raises(Exception, match="broken load"):
            sinks.write_table(shaped(broken(spark)), **target)
        assert sorted(r.id for r in read().collect()) == list(range(5))
    sinks.write_table(shaped(spark.range(3, 9)), **target, **({"comment": "it's new"} if "table" in target else {}))
    assert sorted(r.id for r in read().collect()) == list(range(3, 9))
    if "path" in target:                                    # nothing is left beside the folder
        parent, own = os.path.split(local_path(path))
        assert [x for x in os.listdir(parent) if x.startswith(own)] == [own]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == ([name] if "table" in target else [])
    if "table" in target:
        info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        assert info["Comment"] == "it's new"
        assert ("Bucket Columns" in info) == (kind == "bucketed")


def test_a_failed_first_load_leaves_nothing(spark):
    path = scratch_path(spark, "first")
    name = "first_" + path.rsplit("-", 1)[-1]
    for target in ({"path": path}, {"table": name}, {"table": name, "path": path}):
        with pytest.raises(Exception, match="broken load"):
            sinks.write_table(broken(spark), **target)
        assert not os.path.exists(local_path(path)) and not spark.catalog.tableExists(name)


def test_a_table_may_be_replaced_from_itself(spark):
    path = scratch_path(spark, "self")
    sinks.write_table(spark.range(10), path=path)
    sinks.write_table(spark.read.parquet(path).filter("id < 4"), path=path)
    assert spark.read.parquet(path).count() == 4
