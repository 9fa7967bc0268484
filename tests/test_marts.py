import datetime as dt
import os

from pyspark.sql import functions as F

from strata.operators.predict import CATEGORY_LABELS
from strata.plans import marts
from strata.session import local_path, scratch_path
from strata.sources import sinks

TS = dt.datetime(2024, 1, 1, 10, 0, 0, 123456)

# The shipped time dimension (year, decade, era, baseline flag, target flag).
GOLDEN_TIME = [
    (2000, 2000, "MDG Era", False, False), (2001, 2000, "MDG Era", False, False),
    (2002, 2000, "MDG Era", False, False), (2003, 2000, "MDG Era", False, False),
    (2004, 2000, "MDG Era", False, False), (2005, 2000, "MDG Era", False, False),
    (2006, 2000, "MDG Era", False, False), (2007, 2000, "MDG Era", False, False),
    (2008, 2000, "MDG Era", False, False), (2009, 2000, "MDG Era", False, False),
    (2010, 2010, "MDG Era", False, False), (2011, 2010, "MDG Era", False, False),
    (2012, 2010, "MDG Era", False, False), (2013, 2010, "MDG Era", False, False),
    (2014, 2010, "MDG Era", False, False), (2015, 2010, "SDG Era", True, False),
    (2016, 2010, "SDG Era", False, False), (2017, 2010, "SDG Era", False, False),
    (2018, 2010, "SDG Era", False, False), (2019, 2010, "SDG Era", False, False),
    (2020, 2020, "SDG Era", False, False), (2021, 2020, "SDG Era", False, False),
    (2022, 2020, "SDG Era", False, False), (2023, 2020, "SDG Era", False, False),
    (2024, 2020, "SDG Era", False, False),
]
# The shipped goal dimension, goal code -> category.
GOLDEN_GOAL_CATEGORY = {
    "1": "People", "2": "People", "3": "People", "4": "People", "5": "People", "6": "People",
    "7": "Prosperity", "8": "Prosperity", "9": "Prosperity", "10": "Prosperity", "11": "Prosperity",
    "12": "Prosperity", "13": "Planet", "14": "Planet", "15": "Planet",
    "16": "Peace & Partnership", "17": "Peace & Partnership",
}


def _raw_obs(spark):
    rows = []
    for area, name in (("4", "Afghanistan"), ("36", "Australia"), ("840", "United States of America")):
        for year in range(2000, 2025):
            for ind in ("1.1.1", "1.2.1", "3.1.1"):
                v = str((int(area) % 7 + 1) * (year - 1990) + len(ind))
                rows.append((ind, area, name, str(year), v, "Float", "%", "src", TS))
    rows.append(("1.1.1", "4", "Afghanistan", "1999", "1", "Float", "%", "src", TS))
    rows.append(("1.1.1", "4", "Afghanistan", "2001", "<0.1", "Float", "%", "src", TS))
    return spark.createDataFrame(rows, marts_raw_obs_schema())


def marts_raw_obs_schema():
    from strata import schemas
    return schemas.RAW_OBSERVATIONS


def test_dim_time_golden(spark):
    obs = marts.stg_observations(_raw_obs(spark))
    got = sorted(tuple(r) for r in marts.dim_time(obs).collect())
    assert got == GOLDEN_TIME


def test_dim_goals_golden(spark):
    goals = spark.createDataFrame([(c, f"Goal {c}", "", TS) for c in GOLDEN_GOAL_CATEGORY], "goal_code string, goal_title string, goal_description string, extracted_at timestamp_ntz")
    got = {r.goal_code: r.goal_category for r in marts.dim_goals(marts.stg_goals(goals)).collect()}
    assert got == GOLDEN_GOAL_CATEGORY


def _countries(spark):
    raw = spark.createDataFrame([
        ("AFG", "Afghanistan", "AF", "South Asia", "Low income", "Kabul", "69.17", "34.52", TS),
        ("AUS", "Australia", "AU", "East Asia & Pacific ", "High income", "Canberra", "149.1", "-35.3", TS),
        ("840", "Somewhere", "SW", "Europe & Central Asia", "High income", "X", "", "n/a", TS),
        ("WLD", "World", "1W", "", "", "", "", "", TS)], marts_countries_schema())
    return marts.stg_countries(raw)


def marts_countries_schema():
    from strata import schemas
    return schemas.RAW_COUNTRIES


def test_dim_countries_precedence_and_fanout(spark):
    areas = spark.createDataFrame([("4", "Afghanistan", TS), ("4", "Afghanistan", TS), ("36", "Australia", TS),
                                   ("840", "United States of America", TS), ("76", "Brazil", TS),
                                   ("999", "Nowhere", TS)], "geo_area_code string, geo_area_name string, extracted_at timestamp_ntz")
    dim = {r.country_code: r for r in marts.dim_countries(areas, _countries(spark)).collect()}
    assert dim["4"].region == "South Asia" and dim["4"].longitude == 69.17
    assert dim["36"].region == "East Asia & Pacific "          # untrimmed, matched source wins
    assert dim["840"].region == "Europe & Central Asia"         # matched by code beats the default
    assert dim["76"].region == "Latin America & Caribbean"      # inline default by name
    assert dim["999"].region == "Unknown" and dim["999"].income_level == "Unknown"
    assert marts.dim_countries(areas, _countries(spark), trim_region=True).filter(
        F.col("country_code") == "36").first().region == "East Asia & Pacific"


def test_end_to_end_models_and_predictions(spark):
    obs = marts.stg_observations(_raw_obs(spark))
    areas = obs.select("geo_area_code", "geo_area_name").distinct()
    dim = marts.dim_countries(areas, _countries(spark))
    progress = marts.fact_progress(obs, dim)
    assert progress.count() == 3 * 25 * 2
    p = {r.progress_id: r for r in progress.collect()}
    assert p["4_1_2001"].indicators_measured == 2 and p["4_1_2000"].prev_year_avg is None
    assert p["4_1_2001"].yoy_change == p["4_1_2001"].avg_indicator_value - p["4_1_2000"].avg_indicator_value
    series = spark.createDataFrame(
        [(code, name, cc, cname, y, float(y - 1990) * (i + 1), TS)
         for i, (code, name) in enumerate(marts.ECONOMIC_SERIES.items())
         for cc, cname in (("4", "Afghanistan"), ("36", "Australia")) for y in range(1998, 2025)],
        "indicator_code string, indicator_name string, country_code string, country_name string, year long, value double, extracted_at timestamp_ntz")
    econ = marts.fact_economic(marts.stg_series(series), dim)
    assert econ.count() == 2 * 25
    goals = spark.createDataFrame([(c, f"Goal {c}", "", TS) for c in ("1", "3")], "goal_code string, goal_title string, goal_description string, extracted_at timestamp_ntz")
    combined = marts.combined_extract(progress, marts.dim_goals(goals), marts.dim_time(obs), econ)
    assert len(combined.columns) == 17 and combined.count() == progress.count()
    feats = marts.features(marts.training_set(progress, econ))
    assert feats.count() == 6
    r = {(x.country_code, x.goal_code): x for x in feats.collect()}
    assert r[("840", "1")].gdp_per_capita is not None       # median fill for the country without economics
    model, scored, acc, imp = marts.train_and_score(feats, trees=10, depth=3, test_fraction=0.5)
    probs = [x.prediction_2030_probability for x in scored.collect()]
    assert len(probs) == 6 and all(0.0 <= v <= 1.0 for v in probs)
    assert imp.count() == 15 and 0.0 <= acc.first().accuracy <= 1.0
    summary = marts.prediction_summary(scored)
    assert sorted(x.prediction_category for x in summary.collect()) == sorted(CATEGORY_LABELS)
    table = sinks.prediction_extract(scored, for_table=True, predicted_at=TS)
    assert table.columns[-1] == "predicted_at" and len(table.columns) == 12
    assert table.filter(F.col("prediction_category").isNull()).count() == 0
    report = marts.quality_report(spark, {"obs": lambda: obs}, {"fact": lambda: progress}, progress,
                                  marts.dim_goals(goals))
    assert report["coverage"].first().years == 25
    assert report["sample"].count() == 10


def test_csv_sink_booleans_and_nulls(spark):
    df = spark.createDataFrame([(1, True, None), (2, False, "x")], "k int, b boolean, s string")
    path = scratch_path(spark, "csv-test")
    sinks.write_csv(df, path, single_file=True, python_booleans=True)
    files = [f for f in os.listdir(local_path(path)) if f.endswith(".csv")]
    text = open(os.path.join(local_path(path), files[0])).read().splitlines()
    assert text[0] == "k,b,s" and sorted(text[1:]) == ["1,True,", "2,False,x"]
    status = sinks.export_all(spark, {"ok": (df, scratch_path(spark, "e")), "bad": (df, "/proc/forbidden/x")})
    assert {r.table_name: r.status for r in status.collect()} == {"ok": "ok", "bad": "error"}


def test_table_sink_overwrite_namespace_and_comment(spark):
    from strata.schemas import RAW_DESCRIPTIONS
    path = scratch_path(spark, "table")
    sinks.write_table(spark.range(5), path=path)
    sinks.write_table(spark.range(3), path=path)              # replace-all, not append
    assert spark.read.parquet(path).count() == 3
    sinks.ensure_namespace(spark, "raw")
    sinks.ensure_namespace(spark, "raw")                      # idempotent
    sinks.write_table(spark.range(2), table="raw.sdg_goals", comment=RAW_DESCRIPTIONS["sdg_goals"])
    assert spark.table("raw.sdg_goals").count() == 2
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED raw.sdg_goals").collect()}
    assert info.get("Comment") == RAW_DESCRIPTIONS["sdg_goals"]


def test_model_feature_lists():
    assert len(marts.model_features()) == 15
    reduced = marts.model_features(exclude_label_source=True)
    assert "avg_yoy_change" not in reduced and "total_change" not in reduced and len(reduced) == 13


def test_register_views_names_every_table(spark):
    from conftest import SF001
    from strata.sources.catalog import TEST_TABLES, register_views
    register_views(spark, SF001)
    assert spark.sql("SELECT COUNT(*) AS n FROM orders").first().n > 0
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} >= set(TEST_TABLES)
