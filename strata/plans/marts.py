"""The reference's models, composed from strata operators.

staging  : stg_goals, stg_observations, stg_countries, stg_series
marts    : dim_countries, dim_goals, dim_time, fact_progress, fact_economic
derived  : combined_extract, training_set, features, train_and_score, quality_report

Each builder is a plain function of DataFrames; nothing runs until an action.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.classify import flag, in_groups
from strata.functions.clean import safe_double, safe_year, text_timestamp
from strata.functions.keys import dotted, first_present, prefix, surrogate_key
from strata.operators.change import lag_delta
from strata.operators.features import (above_median_flag, entity_profile, exact_medians, median_fill,
                                       roll_latest)
from strata.operators.joins import inline_table, left_any_match, lookup, star
from strata.operators.ordinal import encode_labels
from strata.operators.pivot import pivot_max
from strata.operators.predict import accuracy, assemble, fit_forest, hold_out, importances, score
from strata.operators.profile import (best_worst, category_share, count_by, coverage, null_profile,
                                      table_counts, top_n)
from strata.operators.rollup import distinct_rows, rollup_measures
from strata.operators.stage import at_least, nan_as_null, non_empty, not_null, stage
from strata.session import ensure_checkpoint_dir

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Goal categories by goal code (anything else is 'Other').
GOAL_CATEGORIES = {
    "People": ["1", "2", "3", "4", "5", "6"],
    "Prosperity": ["7", "8", "9", "10", "11", "12"],
    "Planet": ["13", "14", "15"],
    "Peace & Partnership": ["16", "17"],
}
# Development eras: before the baseline year, baseline..target year, after.
SDG_BASELINE_YEAR = 2015
SDG_TARGET_YEAR = 2030
ERA_LABELS = ("MDG Era", "SDG Era", "Post-SDG")
# Economic series codes pivoted into columns.
ECONOMIC_SERIES = {
    "NY.GDP.PCAP.CD": "gdp_per_capita",
    "SP.POP.TOTL": "population",
    "SP.DYN.LE00.IN": "life_expectancy",
    "SE.ADT.LITR.ZS": "adult_literacy_rate",
}
# Economic series code -> series name (the name is carried into the raw table).
ECONOMIC_SERIES_NAMES = {
    "NY.GDP.PCAP.CD": "GDP per capita",
    "SP.POP.TOTL": "Population",
    "SP.DYN.LE00.IN": "Life expectancy",
    "SE.ADT.LITR.ZS": "Adult literacy rate",
}
# Fallback region and income level for major countries, by country name.
MAJOR_COUNTRY_DEFAULTS = [
    ("United States of America", "North America", "High income"),
    ("United States", "North America", "High income"),
    ("Canada", "North America", "High income"),
    ("Australia", "East Asia & Pacific", "High income"),
    ("New Zealand", "East Asia & Pacific", "High income"),
    ("Japan", "East Asia & Pacific", "High income"),
    ("Germany", "Europe & Central Asia", "High income"),
    ("France", "Europe & Central Asia", "High income"),
    ("United Kingdom", "Europe & Central Asia", "High income"),
    ("United Kingdom of Great Britain and Northern Ireland", "Europe & Central Asia", "High income"),
    ("Italy", "Europe & Central Asia", "High income"),
    ("Spain", "Europe & Central Asia", "High income"),
    ("China", "East Asia & Pacific", "Upper middle income"),
    ("India", "South Asia", "Lower middle income"),
    ("Brazil", "Latin America & Caribbean", "Upper middle income"),
    ("Mexico", "Latin America & Caribbean", "Upper middle income"),
    ("South Africa", "Sub-Saharan Africa", "Upper middle income"),
    ("Nigeria", "Sub-Saharan Africa", "Lower middle income"),
    ("Russian Federation", "Europe & Central Asia", "Upper middle income"),
    ("Indonesia", "East Asia & Pacific", "Upper middle income"),
    ("Philippines", "East Asia & Pacific", "Lower middle income"),
    ("Vietnam", "East Asia & Pacific", "Lower middle income"),
    ("Thailand", "East Asia & Pacific", "Upper middle income"),
    ("Korea, Republic of", "East Asia & Pacific", "High income"),
    ("Republic of Korea", "East Asia & Pacific", "High income"),
]
DEFAULTS_SCHEMA = "d_country_name string, d_region string, d_income_level string"
# Model features, in order.
FEATURE_COLUMNS = ["value_mean", "value_std", "value_min", "value_max", "value_latest",
                   "avg_yoy_change", "total_change", "data_points", "avg_indicators_measured",
                   "gdp_per_capita", "population", "life_expectancy", "adult_literacy_rate",
                   "region_encoded", "income_encoded"]
ECONOMIC_COLUMNS = list(ECONOMIC_SERIES.values())
UNKNOWN = "Unknown"


# --------------------------------------------------------------------------- staging

def stg_goals(raw_goals: DataFrame) -> DataFrame:
    return raw_goals.select(F.col("goal_code").cast("string").alias("goal_code"), "goal_title",
                            "goal_description", text_timestamp(F.col("extracted_at")).alias("extracted_at"))


def stg_observations(raw: DataFrame, min_year: int = 2000, nan_policy: str = "null") -> DataFrame:
    """Raw value and period must be present and the period must parse to a year
    >= ``min_year``; the value is then safe-cast (unparsable text -> NULL)."""
    tp_type = raw.schema["time_period"].dataType
    return stage(raw, {
        "indicator_code": F.col("indicator_code"),
        "geo_area_code": F.col("geo_area_code"),
        "geo_area_name": F.col("geo_area_name"),
        "year": safe_year(F.col("time_period"), tp_type),
        "value": safe_double(F.col("value"), raw.schema["value"].dataType, nan_policy),
        "value_type": F.col("value_type"),
        "unit": F.col("unit"),
        "data_source": F.col("source"),
        "extracted_at": F.col("extracted_at"),
    }, where=not_null("value", "time_period") + [at_least(raw, "time_period", min_year, parse=True)])


def stg_countries(raw: DataFrame) -> DataFrame:
    """Countries with a non-empty region and a code; coordinates safe-cast."""
    keep = [c for c in raw.columns if c not in ("longitude", "latitude")]
    select = {c: F.col(c) for c in keep}
    select["longitude"] = safe_double(F.col("longitude"), raw.schema["longitude"].dataType)
    select["latitude"] = safe_double(F.col("latitude"), raw.schema["latitude"].dataType)
    return stage(raw, select, where=non_empty("region") + not_null("country_code"))


def stg_series(raw: DataFrame, min_year: int = 2000) -> DataFrame:
    return raw.filter(F.col("value").isNotNull() & (F.col("year") >= F.lit(min_year)))


# --------------------------------------------------------------------------- dimensions

def dim_countries(areas: DataFrame, countries: DataFrame, defaults: DataFrame | None = None,
                  trim_region: bool = False) -> DataFrame:
    """Areas matched to country metadata by name OR code, then by name to the
    inline defaults; region/income fall back to the defaults, then 'Unknown'.

    ``areas``: geo_area_code, geo_area_name; ``countries``: staged countries;
    ``defaults``: d_country_name, d_region, d_income_level (broadcast inline).
    """
    s = distinct_rows(areas, ["geo_area_code", "geo_area_name"])
    w = countries.select(F.col("country_code").alias("w_code"), F.col("country_name").alias("w_name"),
                         F.col("region").alias("w_region"), F.col("income_level").alias("w_income"),
                         F.col("capital_city").alias("w_capital"), F.col("longitude").alias("w_lon"),
                         F.col("latitude").alias("w_lat"))
    matched = left_any_match(s, w, [("geo_area_name", "w_name"), ("geo_area_code", "w_code")])
    if defaults is None:
        defaults = default_countries(areas.sparkSession)
    joined = matched.join(defaults, matched["geo_area_name"] == defaults["d_country_name"], "left")
    region = first_present("w_region", "d_region", default=UNKNOWN)
    if trim_region:
        region = F.trim(region)
    return (joined.select(first_present("geo_area_code", "w_code").alias("country_code"),
                          first_present("geo_area_name", "w_name").alias("country_name"),
                          region.alias("region"),
                          first_present("w_income", "d_income_level", default=UNKNOWN).alias("income_level"),
                          F.col("w_capital").alias("capital_city"), F.col("w_lon").alias("longitude"),
                          F.col("w_lat").alias("latitude"))
            .filter(F.col("country_code").isNotNull()))


def default_countries(spark: SparkSession) -> DataFrame:
    """The fixed list of major countries as a table."""
    return inline_table(spark, MAJOR_COUNTRY_DEFAULTS, DEFAULTS_SCHEMA)


def dim_goals(goals: DataFrame) -> DataFrame:
    return goals.select("goal_code", "goal_title", "goal_description",
                        in_groups(F.col("goal_code"), GOAL_CATEGORIES, "Other").alias("goal_category"))


def era(year, baseline: int = SDG_BASELINE_YEAR, target: int = SDG_TARGET_YEAR):
    y = F.col(year) if isinstance(year, str) else year
    return (F.when(y < F.lit(baseline), F.lit(ERA_LABELS[0]))
            .when((y >= F.lit(baseline)) & (y <= F.lit(target)), F.lit(ERA_LABELS[1]))
            .otherwise(F.lit(ERA_LABELS[2])))


def dim_time(observations: DataFrame, year: str = "year", baseline: int = SDG_BASELINE_YEAR,
             target: int = SDG_TARGET_YEAR) -> DataFrame:
    years = distinct_rows(observations, [year], where=F.col(year).isNotNull()).withColumnRenamed(year, "year")
    return years.select("year",
                        (F.floor(F.col("year") / 10) * 10).cast("long").alias("decade"),
                        era("year", baseline, target).alias("development_era"),
                        flag(F.col("year"), baseline).alias("is_sdg_baseline"),
                        flag(F.col("year"), target).alias("is_sdg_target_year"))


# --------------------------------------------------------------------------- facts

def fact_progress(observations: DataFrame, countries: DataFrame, with_name: bool = True,
                  name_from_dimension: bool = False, nan_extremes: bool = False) -> DataFrame:
    """Per (country, goal, year): distinct indicators, avg/min/max value, the
    previous present year's average and the change, region and income level.

    ``observations``: indicator_code, geo_area_code, [geo_area_name], year, value.
    ``countries``: country_code, region, income_level (and country_name when
    ``name_from_dimension``: for observations that carry no area name).
    ``nan_extremes`` gives the warehouse's NaN semantics for min/max (use it with
    ``stg_observations(nan_policy="propagate")``).
    """
    keys = ["country_code"] + (["country_name"] if with_name else []) + ["goal_code", "year"]
    g = observations.select(
        F.col("geo_area_code").alias("country_code"),
        *([F.col("geo_area_name").alias("country_name")] if with_name else []),
        dotted(F.col("indicator_code"), 1).alias("goal_code"),
        F.col("year"), F.col("indicator_code"), F.col("value"))
    # partitioned by country once after the first aggregation level: the
    # distinct-count level, the country join and the (country, goal) window reuse it
    rolled = rollup_measures(g, keys, "indicator_code", "value", partition_by=["country_code"],
                             nan_extremes=nan_extremes).filter(F.col("year").isNotNull())
    take = ["region", "income_level"] + (["country_name"] if name_from_dimension and not with_name else [])
    joined = lookup(rolled, countries, "country_code", take)
    changed = lag_delta(joined, ["country_code", "goal_code"], ["year"], "avg_indicator_value",
                        prev_name="prev_year_avg", delta_name="yoy_change",
                        tie=["country_name"] if with_name else [])
    named = with_name or name_from_dimension
    return changed.select(
        surrogate_key("country_code", "goal_code", "year").alias("progress_id"),
        "country_code", *(["country_name"] if named else []), "goal_code", "year", "region", "income_level",
        "indicators_measured", "avg_indicator_value", "min_indicator_value", "max_indicator_value",
        "prev_year_avg", "yoy_change")


def fact_economic(series: DataFrame, countries: DataFrame,
                  codes: Mapping[str, str] = ECONOMIC_SERIES) -> DataFrame:
    pivoted = pivot_max(series, ["country_code", "country_name", "year"], "indicator_code", "value", codes)
    joined = lookup(pivoted.filter(F.col("year").isNotNull()), countries, "country_code", ["region", "income_level"])
    return joined.select(surrogate_key("country_code", "year").alias("economic_id"), "country_code",
                         "country_name", "year", "region", "income_level", *codes.values())


# --------------------------------------------------------------------------- derived

def combined_extract(progress: DataFrame, goals: DataFrame, time: DataFrame, economic: DataFrame) -> DataFrame:
    """The denormalised analysis extract: progress fact with goal, era and economics."""
    joined = star(progress, [
        (goals, "goal_code", ["goal_title", "goal_category"]),
        (time, "year", ["development_era"]),
        (economic.drop("country_name", "region", "income_level", "economic_id"), ["country_code", "year"],
         ECONOMIC_COLUMNS),
    ])
    return joined.select("progress_id", "country_code", "country_name", "goal_code", "goal_title", "goal_category",
                         "year", "development_era", "region", "income_level", "indicators_measured",
                         "avg_indicator_value", "yoy_change", *ECONOMIC_COLUMNS)


def training_set(progress: DataFrame, economic: DataFrame, min_year: int = 2000) -> DataFrame:
    econ = economic.select("country_code", "year", *ECONOMIC_COLUMNS)
    base = progress.filter((F.col("year") >= F.lit(min_year)) & F.col("avg_indicator_value").isNotNull())
    return base.join(econ, ["country_code", "year"], "left").select(
        "country_code", "country_name", "goal_code", "year", "region", "income_level", "indicators_measured",
        "avg_indicator_value", "yoy_change", *ECONOMIC_COLUMNS)


def features(training: DataFrame) -> DataFrame:
    """Per (country, goal) profile + the country's latest attributes, fills,
    the above-median target and encoded region/income.

    NaN is treated as missing (as the reference's dataframe library does).
    The target is derived from ``avg_yoy_change``, which is also a feature;
    ``model_features(exclude_label_source=True)`` leaves it out of the model.
    """
    t = nan_as_null(training)
    attr_cols = ["country_name", "region", "income_level", *ECONOMIC_COLUMNS]
    # one pass over the training rows: the (country, goal) profile also carries
    # each attribute's latest non-null value by (year, goal); materialised once
    # in the shared checkpoint folder (it survives executor loss), so the
    # country roll-up, medians and label passes below read it, not the facts
    ensure_checkpoint_dir(training.sparkSession)
    prof = entity_profile(t, ["country_code", "goal_code"], "avg_indicator_value", ["year"],
                          change="yoy_change", period="year",
                          extra_mean={"avg_indicators_measured": "indicators_measured"},
                          carry=attr_cols, carry_order=["year", "goal_code"]).checkpoint(eager=True)
    attrs = roll_latest(prof, "country_code", attr_cols)
    feats = prof.drop(*attr_cols, *[f"{c}__at" for c in attr_cols]).join(attrs, "country_code", "left")
    # the target's median is taken before the fills, which do not touch it
    meds = exact_medians(feats, [*ECONOMIC_COLUMNS, "avg_yoy_change"])
    feats = median_fill(feats, ECONOMIC_COLUMNS, medians=meds)
    feats = above_median_flag(feats, "avg_yoy_change", "on_track_2030", median=meds["avg_yoy_change"])
    feats = encode_labels(feats, ["region", "income_level"], missing=UNKNOWN)
    return feats.withColumnRenamed("income_level_encoded", "income_encoded")


def model_features(exclude_label_source: bool = False) -> list[str]:
    cols = list(FEATURE_COLUMNS)
    if exclude_label_source:
        cols = [c for c in cols if c not in ("avg_yoy_change", "total_change")]
    return cols


def train_and_score(feats: DataFrame, feature_cols: Sequence[str] | None = None, trees: int = 100,
                    depth: int = 10, seed: int = 42, test_fraction: float = 0.2):
    """Fit on the hold-out complement, score every row.

    Returns (model, scored rows, accuracy frame, importance frame).
    """
    cols = list(feature_cols or FEATURE_COLUMNS)
    data = assemble(hold_out(feats, ["country_code", "goal_code"], test_fraction, seed), cols)
    data = data.withColumn("label", F.col("on_track_2030").cast("double"))
    model = fit_forest(data.filter(~F.col("is_test")), "label", trees, depth, seed)
    scored = score(model, data)
    return model, scored, accuracy(scored.filter(F.col("is_test"))), importances(model, cols)


def prediction_summary(scored: DataFrame) -> DataFrame:
    from strata.operators.predict import CATEGORY_LABELS
    return category_share(scored, "prediction_category", CATEGORY_LABELS, name="prediction_category")


def best_worst_countries(scored: DataFrame, n: int = 10) -> DataFrame:
    return best_worst(scored, "country_name", "prediction_2030_probability", n)


def quality_report(spark: SparkSession, raw: Mapping[str, callable], marts: Mapping[str, callable],
                   progress: DataFrame, goals: DataFrame) -> dict[str, DataFrame]:
    """Q1-Q7 as frames (nothing printed, nothing collected)."""
    counts = table_counts(spark, raw, "raw").unionByName(table_counts(spark, marts, "marts"))
    listing = goals.select("goal_code", prefix("goal_title", 45).alias("goal_title"), "goal_category",
                           F.col("goal_code").try_cast("long").alias("position"))
    # report frames are small (one row per table, goal or region); they are
    # ordered for reading: codes numerically, regions by count
    return {
        "table_counts": counts,
        "goal_listing": listing.orderBy(F.col("position").asc_nulls_last(), "goal_code"),
        "coverage": coverage(progress, {"countries": "country_code", "goals": "goal_code", "years": "year"}, "year"),
        "by_goal": count_by(progress, "goal_code", "goal_code").withColumn(
            "position", F.col("goal_code").try_cast("long")).orderBy(F.col("position").asc_nulls_last(), "goal_code"),
        "by_region": count_by(progress, "region", "region", default=UNKNOWN).orderBy(
            F.col("data_points").desc(), "region"),
        "nulls": null_profile(progress, {"null_country": "country_code", "null_goal": "goal_code",
                                         "null_year": "year", "null_value": "avg_indicator_value"}),
        "sample": top_n(progress.filter(F.col("country_name").isNotNull()), "avg_indicator_value", 10,
                        tie=["progress_id"]).select(
            "country_name", "goal_code", "year", "region", "income_level",
            F.round("avg_indicator_value", 2).alias("avg_value")),
    }
