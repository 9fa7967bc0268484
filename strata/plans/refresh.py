"""End to end: landing folder -> raw tables -> staging -> marts -> extract,
features, model and predictions -> tables, CSV extracts and a quality report.

Every step is one of the library's builders; the only driver-side values are
the model, its accuracy and importances, and the status rows of the writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.predict import accuracy
from strata.plans import marts
from strata.schemas import RAW_DESCRIPTIONS
from strata.sources import landing, sinks

# The names of the raw tables, marts and staging views.
RAW_NAMES = ("sdg_goals", "sdg_targets", "sdg_indicators", "sdg_geo_areas", "sdg_indicator_data",
             "wb_countries", "wb_indicators")
STAGING_NAMES = ("stg_sdg_goals", "stg_sdg_indicator_data", "stg_wb_countries", "stg_wb_indicators")
MART_NAMES = ("dim_countries", "dim_goals", "dim_time", "fact_sdg_progress", "fact_economic_indicators")


def build_models(raw: dict[str, DataFrame], nan_policy: str = "null") -> dict[str, DataFrame]:
    """Staging views and marts from the raw tables."""
    stg_goals = marts.stg_goals(raw["sdg_goals"])
    stg_obs = marts.stg_observations(raw["sdg_indicator_data"], nan_policy=nan_policy)
    stg_countries = marts.stg_countries(raw["wb_countries"])
    stg_series = marts.stg_series(raw["wb_indicators"])
    dim_countries = marts.dim_countries(raw["sdg_geo_areas"], stg_countries)
    return {
        "stg_sdg_goals": stg_goals,
        "stg_sdg_indicator_data": stg_obs,
        "stg_wb_countries": stg_countries,
        "stg_wb_indicators": stg_series,
        "dim_countries": dim_countries,
        "dim_goals": marts.dim_goals(stg_goals),
        "dim_time": marts.dim_time(stg_obs),
        "fact_sdg_progress": marts.fact_progress(stg_obs, dim_countries,
                                                 nan_extremes=(nan_policy == "propagate")),
        "fact_economic_indicators": marts.fact_economic(stg_series, dim_countries),
    }


FACT_BUCKET_KEYS = ["country_code", "year"]


def refresh(spark: SparkSession, landing_root: str, out_root: str, max_indicators: int | None = None,
            trees: int = 100, depth: int = 10, seed: int = 42, predicted_at=None,
            database: str | None = None, fact_buckets: int = 64,
            year_range: tuple[int, int] | None = None) -> dict:
    """Run everything; returns the frames written and a status frame of the writes.

    Every table is written once and read back by the steps after it: raw
    tables, marts, features and predictions. The four staging models are
    registered as temporary views. With ``database`` the raw tables (with
    their descriptions as comments) and the marts are catalogue tables in that
    database, and the two facts are bucketed by (country_code, year) into
    ``fact_buckets`` buckets, so the extract's and the training set's
    fact-to-fact join reads co-located data instead of shuffling both facts.
    """
    out = out_root.rstrip("/")
    if database:
        sinks.ensure_namespace(spark, database)

    def stored(df: DataFrame, folder: str, name: str, **options) -> DataFrame:
        table = f"{database}.{name}" if database and folder != "model" else None
        sinks.write_table(df, path=f"{out}/{folder}/{name}", table=table, **(options if table else {}))
        return spark.table(table) if table else spark.read.parquet(f"{out}/{folder}/{name}")

    landed = landing.land_raw(spark, landing_root, max_indicators=max_indicators,
                              series_names=marts.ECONOMIC_SERIES_NAMES, year_range=year_range)
    raw = {name: stored(landed[name], "raw", name, comment=RAW_DESCRIPTIONS[name]) for name in RAW_NAMES}
    rejects = {name: stored(landed[name], "rejects", name) for name in ("rejects", "rejects_series")}
    models = build_models(raw)
    for name in STAGING_NAMES:
        models[name].createOrReplaceTempView(name)
    m = {name: stored(models[name], "marts", name, **(
        {"bucket_by": (fact_buckets, FACT_BUCKET_KEYS)} if name.startswith("fact_") else {})) for name in MART_NAMES}
    combined = marts.combined_extract(m["fact_sdg_progress"], m["dim_goals"], m["dim_time"],
                                      m["fact_economic_indicators"])
    feats = stored(marts.features(marts.training_set(m["fact_sdg_progress"], m["fact_economic_indicators"])),
                   "model", "features")
    model, scored, _, imp = marts.train_and_score(feats, trees=trees, depth=depth, seed=seed)
    scored = stored(scored.drop("features", "rawPrediction", "probability"), "model", "scored")
    sinks.write_table(sinks.prediction_extract(scored, for_table=True, predicted_at=predicted_at),
                      path=f"{out}/marts/ml_sdg_predictions")
    status = sinks.export_all(spark, {
        **{name: (m[name], f"{out}/exports/{name}") for name in MART_NAMES},
        "sdg_analysis_combined": (combined, f"{out}/exports/sdg_analysis_combined"),
        "ml_sdg_predictions": (sinks.prediction_extract(scored, for_table=False), f"{out}/exports/ml_sdg_predictions"),
    })
    report = marts.quality_report(
        spark, {n: (lambda n=n: raw[n]) for n in raw}, {n: (lambda n=n: m[n]) for n in MART_NAMES},
        m["fact_sdg_progress"], m["dim_goals"])
    return {"raw": raw, "rejects": rejects, "marts": m, "combined": combined, "features": feats, "model": model,
            "scored": scored, "accuracy": accuracy(scored.filter("is_test")), "importances": imp, "exports": status,
            "quality": report, "summary": marts.prediction_summary(scored), "best_worst": marts.best_worst_countries(scored)}
