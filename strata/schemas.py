"""Declared schemas: landed payload elements and the raw tables built from them."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType, VariantType)


def _struct(*fields) -> StructType:
    return StructType([StructField(n, t) for n, t in fields])


S = StringType()

# --- payload elements -----------------------------------------------------
GOAL_ELEMENT = _struct(("code", S), ("title", S), ("description", S))
TARGET_ELEMENT = _struct(("code", S), ("title", S), ("description", S))
INDICATOR_ELEMENT = _struct(("code", S), ("description", S))
AREA_ELEMENT = _struct(("geoAreaCode", S), ("geoAreaName", S))
# timePeriodStart is kept as a variant so a JSON number and a JSON string can be told apart
OBSERVATION_ELEMENT = _struct(("geoAreaCode", S), ("geoAreaName", S), ("timePeriodStart", VariantType()),
                              ("value", S), ("valueType", S), ("units", S), ("source", S))
OBSERVATION_PAYLOAD = _struct(("totalElements", LongType()), ("data", ArrayType(OBSERVATION_ELEMENT)))
VALUE_FIELD = _struct(("value", S))
ID_VALUE_FIELD = _struct(("id", S), ("value", S))
COUNTRY_ELEMENT = _struct(("id", S), ("name", S), ("iso2Code", S), ("region", VALUE_FIELD),
                          ("incomeLevel", VALUE_FIELD), ("capitalCity", S), ("longitude", S), ("latitude", S))
PAGE_HEADER = _struct(("page", LongType()), ("pages", LongType()), ("per_page", LongType()), ("total", LongType()))
SERIES_ELEMENT = _struct(("country", ID_VALUE_FIELD), ("date", S), ("value", S))

# --- raw tables (all carry extracted_at) ------------------------------------
TS = TimestampNTZType()
RAW_GOALS = _struct(("goal_code", S), ("goal_title", S), ("goal_description", S), ("extracted_at", TS))
RAW_TARGETS = _struct(("target_code", S), ("goal_code", S), ("target_title", S), ("target_description", S),
                      ("extracted_at", TS))
RAW_INDICATORS = _struct(("indicator_code", S), ("goal_code", S), ("target_code", S),
                         ("indicator_description", S), ("extracted_at", TS))
RAW_AREAS = _struct(("geo_area_code", S), ("geo_area_name", S), ("extracted_at", TS))
RAW_OBSERVATIONS = _struct(("indicator_code", S), ("geo_area_code", S), ("geo_area_name", S), ("time_period", S),
                           ("value", S), ("value_type", S), ("unit", S), ("source", S), ("extracted_at", TS))
RAW_COUNTRIES = _struct(("country_code", S), ("country_name", S), ("country_code_iso3", S), ("region", S),
                        ("income_level", S), ("capital_city", S), ("longitude", S), ("latitude", S),
                        ("extracted_at", TS))
RAW_SERIES = _struct(("indicator_code", S), ("indicator_name", S), ("country_code", S), ("country_name", S),
                     ("year", LongType()), ("value", DoubleType()), ("extracted_at", TS))

# Table descriptions of the raw sources (kept as table comments on write).
RAW_DESCRIPTIONS = {
    "sdg_goals": "Goal catalogue: one row per goal.",
    "sdg_targets": "Target catalogue: one row per target, with its goal.",
    "sdg_indicators": "Indicator catalogue: one row per indicator, with goal and target.",
    "sdg_geo_areas": "Geographic areas as listed by the source (not de-duplicated).",
    "sdg_indicator_data": "Observations: indicator value per area and period.",
    "wb_countries": "Country metadata: region, income level, capital, coordinates.",
    "wb_indicators": "Economic series: value per indicator, country and year.",
}
