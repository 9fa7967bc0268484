"""Plan-shape guards: partial aggregation before shuffles, exchange counts, pushdown."""

import re

from pyspark.sql import functions as F

from conftest import SF01
from strata.operators.rollup import rollup_measures
from strata.plans import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(df) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", _plan(df)))


def test_hot_key_is_combined_before_any_shuffle(spark):
    # one key holds a third of the rows
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 5).alias("ind"), (F.col("id") % 7).cast("double").alias("v"))
    for out in (rollup_measures(df, ["k"], "ind", "v"), rollup_measures(df, ["k"], "ind", "v", partition_by=["k"])):
        plan = _plan(out)
        first_exchange = plan.rfind("Exchange")           # deepest exchange in the printed tree
        assert "partial_" in plan[first_exchange:], plan
        got = {r.k: (r.indicators_measured, r.avg_indicator_value) for r in out.filter("k = 0").collect()}
        assert got[0][0] == 5


def test_flagship_exchange_count(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = registry.q_progress_fact(spark, SF01)
        # two on the fact side (full-key partial aggregate, then by country),
        # at most one more for the dimension side of a sort-merge join
        assert _shuffles(df) <= 3
        assert "Window" in _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_projection_and_filter_reach_the_scan(spark):
    df = registry.q_union_series(spark, SF01)
    plan = _plan(df)
    assert "In(event_type, [click,error,purchase,signup,view])" in plan and plan.count("FileScan") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    scan = _plan(registry.q_stage_catalogue(spark, SF01))
    assert "o_totalprice" not in scan.split("ReadSchema")[1].split("\n")[0]


def test_bucketed_tables_join_without_shuffle(spark):
    from strata.sources import sinks
    sinks.ensure_namespace(spark, "marts")
    facts = spark.range(20_000).select((F.col("id") % 997).alias("country_code"), (F.col("id") % 25).alias("year"),
                                       F.col("id").cast("double").alias("v"))
    econ = spark.range(5_000).select((F.col("id") % 997).alias("country_code"), (F.col("id") % 25).alias("year"),
                                     (F.col("id") * 2).cast("double").alias("gdp"))
    # bucketed by the full join key of the fact-to-fact join
    sinks.write_table(facts, table="marts.fact_b", bucket_by=(8, ["country_code", "year"]))
    sinks.write_table(econ, table="marts.econ_b", bucket_by=(8, ["country_code", "year"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("marts.fact_b").join(spark.table("marts.econ_b"), ["country_code", "year"], "left")
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and _shuffles(joined) == 0, plan
        assert joined.count() == facts.join(econ, ["country_code", "year"], "left").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shares_and_any_match_read_each_input_once(spark):
    share = _plan(registry.q_category_share(spark, SF01))
    assert share.count("FileScan") == 1, share
    match = _plan(registry.q_any_match_join(spark, SF01))
    # equi-joins alone: no row is gathered with others in a window, whatever it shares with them
    assert "Window" not in match and "NestedLoop" not in match and "Cartesian" not in match


def test_latest_value_by_one_number_aggregates_by_hash(spark):
    from strata.operators.features import entity_profile
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("year"), F.col("id").cast("double").alias("v"))
    plan = _plan(entity_profile(df, ["k"], "v", ["year"]))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_latest_values_by_several_order_columns_aggregate_by_hash(spark):
    for query in (registry.q_entity_profile, registry.q_latest_attributes):
        plan = _plan(query(spark, SF01))
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan, plan


def test_footer_counts_read_no_data_page(spark):
    plan = _plan(registry.q_footer_counts(spark, SF01))
    assert plan.count("PushedAggregation: [COUNT(*), MIN(") == 5, plan


def test_buckets_write_one_file_each(spark):
    from strata.session import local_path, scratch_path
    from strata.sources import sinks
    import os
    path = scratch_path(spark, "few-files")
    sinks.write_table(spark.range(10_000).repartition(16).withColumn("k", F.col("id") % 50), path=path,
                      table="few_files", bucket_by=(8, ["k"]))
    assert len([f for f in os.listdir(local_path(path)) if f.endswith(".parquet")]) <= 8


def test_filtered_time_dimension_prunes_the_facts(spark):
    df = registry.q_era_facts(spark, SF01)
    assert "dynamicpruning" in _plan(df)
    facts, times = registry.partitioned_facts(spark, SF01)
    joined = facts.join(times.where("development_era = 'SDG Era'"), "year")
    joined.collect()

    def scans(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(node.plan())
        if name == "FileSourceScanExec":
            return [node]
        children = node.children()
        return [x for i in range(children.size()) for x in scans(children.apply(i))]

    read = {int(x.metrics().apply("numFiles").value()) for x in scans(joined._jdf.queryExecution().executedPlan())
            if "dynamicpruning" in x.toString()}
    wanted = len(facts.where("year between 1998 and 2000").inputFiles())
    named = facts.select("year", F.input_file_name().alias("f")).distinct().groupBy().agg(
        F.count_distinct("f").alias("every"), F.count_distinct(F.when(F.col("year").between(1998, 2000), F.col("f"))).alias("era")).first()
    assert named.era < named.every <= wanted and read == {named.era}


def test_distinct_state_is_built_before_the_shuffle(spark):
    from strata.operators.rollup import distinct_state

    df = spark.range(100_000).select((F.col("id") % 3).alias("k"), "id")
    plan = _plan(distinct_state(df, ["k"], "id"))
    assert "partial_bitmap_construct_agg" in plan[plan.rfind("Exchange"):]
