import json
import os

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import landing
from strata.streaming import land_incrementally


def _flatten(payloads):
    code = F.regexp_extract("source_file", r"([^/]+)\.json$", 1)
    return landing.flatten_observations(payloads.withColumn("indicator_code", code))


def test_incremental_landing_exactly_once(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")

    def drop(name, n):
        doc = {"totalElements": n, "data": [{"geoAreaCode": i, "timePeriodStart": 2000 + i, "value": i}
                                            for i in range(n)]}
        (src / f"{name}.json").write_text(json.dumps(doc))

    drop("1.1.1", 3)
    land_incrementally(spark, str(src), out, _flatten, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    drop("2.1.1", 4)
    land_incrementally(spark, str(src), out, _flatten, checkpoint=ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 7
    assert sorted(r.indicator_code for r in got.select("indicator_code").distinct().collect()) == ["1.1.1", "2.1.1"]
    assert os.path.isdir(src)


def test_second_run_without_a_named_checkpoint_lands_new_files(spark, tmp_path):
    src, out = tmp_path / "landing", scratch_path(spark, "stream-default")
    src.mkdir()
    for name in ("a", "b"):
        doc = {"data": [{"geoAreaCode": 1, "timePeriodStart": 2000, "value": 1}]}
        (src / f"{name}.json").write_text(json.dumps(doc))
        land_incrementally(spark, str(src), out, _flatten).awaitTermination()
    assert sorted(r.indicator_code for r in spark.read.parquet(out).collect()) == ["a", "b"]
