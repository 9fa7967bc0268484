"""Landed JSON payloads -> raw tables.

Payload files are read whole (``wholetext``) so a file is one row whose
``payload`` column holds the document; every flattening step is then a column
expression (``from_json`` / ``get_json_object`` + ``explode``), so the work is
spread over files and rows without any driver-side parsing. Documents that do
not parse, or lack the expected array, are not fatal: they come back in a
separate reject frame with a reason.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from strata import schemas
from strata.functions.clean import default_missing, safe_double
from strata.functions.keys import dotted
from strata.sources.ranges import cut_off_documents, read_records


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``payload`` (the whole document) and ``source_file``."""
    return (spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
            .select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source_file")))


def _stamp(extracted_at) -> Column:
    if extracted_at is None:
        return F.localtimestamp()
    if isinstance(extracted_at, Column):
        return extracted_at
    # through its text, so the value does not depend on the session or process time zone
    text = extracted_at.isoformat(sep=" ") if isinstance(extracted_at, _dt.datetime) else str(extracted_at)
    return F.lit(text).cast("timestamp_ntz")


def _explode_array(payloads: DataFrame, array_json: Column, element: StructType, keep: Sequence[str]) -> DataFrame:
    parsed = F.from_json(array_json, ArrayType(element))
    return payloads.select(*keep, F.explode(parsed).alias("r"))


def reject_reason(payload: Column, expected: Column | None = None) -> Column:
    """NULL for a usable document, else why not: not JSON at all, or the
    expected part (``expected`` parsed to NULL) is missing."""
    out = F.when(F.try_parse_json(payload).isNull(), F.lit("not json"))
    if expected is not None:
        out = out.when(expected.isNull(), F.lit("no record array"))
    return out


def is_json_array(text: Column) -> Column:
    """True when the text is a JSON array (``from_json`` alone would also
    accept a single object as a one-element array)."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("ARRAY"), F.lit(False))


def split_rejects(payloads: DataFrame, array_json: Column | None = None, element: StructType | None = None,
                  payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(good payloads, rejects with a ``reason``)."""
    expected = None
    if array_json is not None:
        parsed = F.from_json(array_json, ArrayType(element))
        expected = F.when(is_json_array(array_json), parsed)
    tagged = payloads.withColumn("_reason", reject_reason(F.col(payload_col), expected))
    good = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    rejects = tagged.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, rejects


# --- catalogues: top-level arrays -------------------------------------------------

def flatten_goals(payloads: DataFrame, extracted_at=None) -> DataFrame:
    r = _explode_array(payloads, F.col("payload"), schemas.GOAL_ELEMENT, [])
    return r.select(F.col("r.code").cast("string").alias("goal_code"), F.col("r.title").alias("goal_title"),
                    default_missing(F.col("r.description")).alias("goal_description"),
                    _stamp(extracted_at).alias("extracted_at"))


def flatten_targets(payloads: DataFrame, extracted_at=None) -> DataFrame:
    r = _explode_array(payloads, F.col("payload"), schemas.TARGET_ELEMENT, [])
    return r.select(F.col("r.code").alias("target_code"), dotted(F.col("r.code"), 1).alias("goal_code"),
                    F.col("r.title").alias("target_title"),
                    default_missing(F.col("r.description")).alias("target_description"),
                    _stamp(extracted_at).alias("extracted_at"))


def flatten_indicators(payloads: DataFrame, extracted_at=None) -> DataFrame:
    r = _explode_array(payloads, F.col("payload"), schemas.INDICATOR_ELEMENT, [])
    return r.select(F.col("r.code").alias("indicator_code"), dotted(F.col("r.code"), 1).alias("goal_code"),
                    dotted(F.col("r.code"), 2).alias("target_code"),
                    default_missing(F.col("r.description")).alias("indicator_description"),
                    _stamp(extracted_at).alias("extracted_at"))


def flatten_areas(payloads: DataFrame, extracted_at=None) -> DataFrame:
    r = _explode_array(payloads, F.col("payload"), schemas.AREA_ELEMENT, [])
    return r.select(F.col("r.geoAreaCode").cast("string").alias("geo_area_code"),
                    F.col("r.geoAreaName").alias("geo_area_name"), _stamp(extracted_at).alias("extracted_at"))


# --- observations: {data: [...]} per indicator ---------------------------------------

def landed_period(v: Column) -> Column:
    """timePeriodStart as text: a JSON number is rounded half away from zero to
    an integer text ('2000.5' -> '2001'); a JSON string is kept verbatim."""
    is_text = F.schema_of_variant(v) == F.lit("STRING")
    as_text = F.try_variant_get(v, "$", "string")
    as_number = F.try_variant_get(v, "$", "double")
    rounded = F.when(~F.isnan(as_number), F.round(as_number, 0)).try_cast("long").cast("string")
    return F.when(v.isNull(), F.lit(None).cast("string")).when(is_text, as_text).otherwise(rounded)


def flatten_observations(payloads: DataFrame, code: Column | str = "indicator_code", extracted_at=None) -> DataFrame:
    """Each payload ``{data: [...]}`` tagged with its indicator code (a column
    of ``payloads``: from the file path, a partition folder or the caller)."""
    code = F.col(code) if isinstance(code, str) else code
    parsed = F.from_json(F.col("payload"), schemas.OBSERVATION_PAYLOAD)
    r = payloads.select(code.alias("indicator_code"), F.explode(parsed["data"]).alias("r"))
    return r.select(
        "indicator_code",
        default_missing(F.col("r.geoAreaCode")).alias("geo_area_code"),
        default_missing(F.col("r.geoAreaName")).alias("geo_area_name"),
        landed_period(F.col("r.timePeriodStart")).alias("time_period"),
        F.col("r.value").alias("value"),
        default_missing(F.col("r.valueType")).alias("value_type"),
        default_missing(F.col("r.units")).alias("unit"),
        default_missing(F.col("r.source")).alias("source"),
        _stamp(extracted_at).alias("extracted_at"),
    )


def first_n_codes(catalogue: DataFrame, code: str, order: str, n: int) -> DataFrame:
    """First ``n`` codes in catalogue order (the order is an explicit column)."""
    return catalogue.orderBy(F.col(order).asc(), F.col(code).asc()).limit(n).select(code)


def restrict(df: DataFrame, codes: DataFrame, on: str, code: str | None = None) -> DataFrame:
    """Keep rows of ``df`` whose ``on`` is among ``codes`` (left semi join, chosen by measured size)."""
    return df.join(codes.select(F.col(code or on).alias(on)), on, "left_semi")


# --- two-element arrays [header, [records]] ---------------------------------------------

def page_header(payload: Column) -> Column:
    return F.from_json(F.get_json_object(payload, "$[0]"), schemas.PAGE_HEADER)


def flatten_countries(payloads: DataFrame, extracted_at=None) -> DataFrame:
    """``[header, [countries]]``; only countries with a non-empty region are
    kept; no second element gives no rows."""
    r = _explode_array(payloads, F.get_json_object(F.col("payload"), "$[1]"), schemas.COUNTRY_ELEMENT, [])
    region = F.col("r.region.value")
    return (r.filter(F.coalesce(region, F.lit("")) != F.lit(""))
            .select(default_missing(F.col("r.id")).alias("country_code"),
                    default_missing(F.col("r.name")).alias("country_name"),
                    default_missing(F.col("r.iso2Code")).alias("country_code_iso3"),
                    region.alias("region"),
                    default_missing(F.col("r.incomeLevel.value")).alias("income_level"),
                    default_missing(F.col("r.capitalCity")).alias("capital_city"),
                    default_missing(F.col("r.longitude")).alias("longitude"),
                    default_missing(F.col("r.latitude")).alias("latitude"),
                    _stamp(extracted_at).alias("extracted_at")))


def flatten_series(payloads: DataFrame, code: Column | str, name: Column | str, extracted_at=None,
                   zero_as_null: bool = False, year_range: tuple[int, int] | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Paged series ``[header, [{country, date, value}]]`` -> (rows, rejects).

    Records without a value are skipped; a date that is not an integer or a
    value that is not a number goes to the rejects instead of aborting the run. ``zero_as_null`` reproduces the
    truthiness test that turns a true zero into NULL. ``year_range`` is the
    requested period (inclusive; None: every year).
    """
    code = F.col(code) if isinstance(code, str) else code
    name = F.col(name) if isinstance(name, str) else name
    r = payloads.select(code.alias("indicator_code"), name.alias("indicator_name"),
                        F.explode(F.from_json(F.get_json_object(F.col("payload"), "$[1]"),
                                              ArrayType(schemas.SERIES_ELEMENT))).alias("r"))
    r = r.filter(F.col("r.value").isNotNull())
    year = F.col("r.date").try_cast("long")
    value = safe_double("r.value")
    if zero_as_null:
        value = F.when(value == F.lit(0.0), F.lit(None).cast("double")).otherwise(value)
    rows = r.select("indicator_code", "indicator_name",
                    default_missing(F.col("r.country.id")).alias("country_code"),
                    default_missing(F.col("r.country.value")).alias("country_name"),
                    year.alias("year"), value.alias("value"), _stamp(extracted_at).alias("extracted_at"),
                    F.col("r.date").alias("_date"), F.col("r.value").alias("_value"),
                    F.when(year.isNull(), F.lit("date not an integer"))
                    .when(safe_double("r.value").isNull(), F.lit("value not a number")).alias("_reason"))
    rejects = rows.filter(F.col("_reason").isNotNull()).select(
        "indicator_code", "country_code", F.col("_date").alias("date"), F.col("_value").alias("value"),
        F.col("_reason").alias("reason"))
    good = rows.filter(F.col("_reason").isNull()).drop("_date", "_value", "_reason")
    if year_range is not None:
        good = good.filter(F.col("year").between(year_range[0], year_range[1]))
    return good, rejects


def page_report(payloads: DataFrame, series: str) -> DataFrame:
    """Per series: declared pages, landed pages and missing page count."""
    h = payloads.select(F.col(series).alias("series"), page_header(F.col("payload")).alias("h"))
    return h.groupBy("series").agg(
        F.max("h.pages").alias("declared_pages"),
        F.count_distinct("h.page").alias("landed_pages"),
    ).withColumn("missing_pages", F.col("declared_pages") - F.col("landed_pages"))


def missing_pages(payloads: DataFrame, series: str, block: int = 65_536) -> DataFrame:
    """One row per (series, page) declared by a header but not landed.

    Pages are dealt out in blocks of ``block`` pages, each with a marker before its first page
    that carries its last one. Ordered within a block, marker and landed pages leave gaps, which
    are expanded where they lie: only landed pages and one marker a block are shuffled, never a
    missing page, of which a series may have far more than landed. A series with millions of
    pages is spread over its blocks, and no expansion holds more than one block.
    """
    h = payloads.select(F.col(series).alias("series"), page_header(F.col("payload")).alias("h"))
    b = F.lit(block).cast("long")
    page = F.col("h.page")
    # the pages of a series without a name are all missing: no landed page equals a NULL
    landed = (h.filter((page >= 1) & F.col("series").isNotNull())
              .select("series", F.floor((page - 1) / b).alias("blk"), page.alias("page"), F.lit(None).cast("long").alias("upto")))
    blk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("pages") - 1) / b)))
    markers = (h.groupBy("series").agg(F.max("h.pages").alias("pages")).filter(F.col("pages") >= 1)
               .select("series", "pages", blk.alias("blk"))
               .select("series", "blk", (F.col("blk") * b).alias("page"),
                       F.least((F.col("blk") + 1) * b, F.col("pages")).alias("upto")))
    at = Window.partitionBy("series", "blk").orderBy("page")
    gaps = (landed.unionByName(markers)
            .select("series", "page", F.first("upto").over(at).alias("upto"), F.lead("page").over(at).alias("next"))
            .filter(F.col("upto").isNotNull())  # else the whole block lies past the last page declared
            .select("series", (F.col("page") + 1).alias("low"), F.least(F.col("next") - 1, F.col("upto")).alias("high"))
            .filter(F.col("high") >= F.col("low")))
    return gaps.select("series", F.explode(F.sequence("low", "high")).alias("page"))


def payload_sizes(payloads: DataFrame, series: str, records: StructType = schemas.SERIES_ELEMENT) -> DataFrame:
    """Per series: the total the headers declare and the records actually landed."""
    recs = F.from_json(F.get_json_object(F.col("payload"), "$[1]"), ArrayType(records))
    return (payloads.select(F.col(series).alias("series"), page_header(F.col("payload")).alias("h"),
                            F.coalesce(F.size(recs), F.lit(0)).alias("n"))
            .groupBy("series").agg(F.max("h.total").alias("declared_total"),
                                   F.sum(F.greatest(F.col("n"), F.lit(0))).cast("long").alias("landed_rows")))


def catalogue_positions(payloads: DataFrame, code_field: str = "code") -> DataFrame:
    """(code, position) in catalogue order: file, then place in the file's array."""
    arr = F.from_json(F.col("payload"), ArrayType(schemas.INDICATOR_ELEMENT))
    place = [c for c in ("range", "ordinal") if c in payloads.columns]      # documents read in ranges: a record's place
    return (payloads.select("source_file", *place, F.posexplode(arr).alias("pos", "r"))
            .select(F.col(f"r.{code_field}").alias("code"),
                    F.struct("source_file", *place, "pos").alias("position")))


def observation_code(source_file: Column) -> Column:
    """The indicator of an observation page: its folder under ``observations/``, or the
    file's own name where it lies there directly."""
    return F.regexp_extract(source_file, r"/observations/([^/]+?)(?:\.json)?(?:/[^/]+)?$", 1)


def payload_rejects(payloads: DataFrame, kind: str) -> DataFrame:
    """(kind, source_file, reason) of the documents of one payload kind that cannot be read."""
    array, element = {
        "goals": (F.col("payload"), schemas.GOAL_ELEMENT),
        "targets": (F.col("payload"), schemas.TARGET_ELEMENT),
        "indicators": (F.col("payload"), schemas.INDICATOR_ELEMENT),
        "areas": (F.col("payload"), schemas.AREA_ELEMENT),
        "observations": (F.get_json_object("payload", "$.data"), schemas.OBSERVATION_ELEMENT),
        "countries": (F.get_json_object("payload", "$[1]"), schemas.COUNTRY_ELEMENT),
        "series": (F.get_json_object("payload", "$[1]"), schemas.SERIES_ELEMENT),
    }[kind]
    return split_rejects(payloads, array, element)[1].select(F.lit(kind).alias("kind"), "source_file", "reason")


def land_raw(spark: SparkSession, root: str, extracted_at=None, max_indicators: int | None = None,
             series_names: dict | None = None, zero_as_null: bool = False,
             year_range: tuple[int, int] | None = None, range_bytes: int | None = None) -> dict[str, DataFrame]:
    """Landing folder -> the seven raw tables (and reject reports).

    Layout under ``root``: ``goals/``, ``targets/``, ``indicators/``,
    ``areas/`` (catalogue arrays), ``observations/<indicator>/<page>.json``
    (``{data: [...]}`` pages), ``countries/*.json`` and ``series/<code>/*.json``
    (``[header, records]`` pages). ``max_indicators`` keeps the observations
    of the first N indicators in catalogue order (default: all), ``year_range``
    the series of a period (default: all). ``rejects`` has a row for every
    document of any kind that cannot be read, ``rejects_series`` one for every
    unreadable record of a readable page. With ``range_bytes`` no document is read
    whole: its records come from byte ranges of that size (see ``ranges``), and
    ``rejects`` names unreadable records and documents that are cut off.
    """
    kinds = {"goals": "array", "targets": "array", "indicators": "array", "areas": "array", "observations": "data",
             "countries": "paged", "series": "paged"}
    folder = lambda k: f"{root.rstrip('/')}/{k}"
    if range_bytes:
        landed = {k: read_records(spark, folder(k), shape, range_bytes) for k, shape in kinds.items()}
        cut_off = [cut_off_documents(spark, folder(k), range_bytes).select(F.lit(k).alias("kind"), "source_file", "reason") for k in kinds]
    else:
        landed, cut_off = {k: read_payload_files(spark, folder(k)) for k in kinds}, []
    pages = landed["observations"].withColumn("indicator_code", observation_code(F.col("source_file")))
    observations = flatten_observations(pages, "indicator_code", extracted_at)
    if max_indicators is not None:
        positions = catalogue_positions(landed["indicators"])
        codes = first_n_codes(positions, "code", "position", max_indicators)
        observations = restrict(observations, codes, "indicator_code", "code")
    series_pages = landed["series"].withColumn(
        "indicator_code", F.regexp_extract("source_file", r"/series/([^/]+)/[^/]+$", 1))
    names = series_names or {}
    name_col = (F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("indicator_code")]
                if names else F.col("indicator_code"))
    series, series_rejects = flatten_series(series_pages.withColumn("indicator_name", name_col),
                                            "indicator_code", "indicator_name", extracted_at,
                                            zero_as_null=zero_as_null, year_range=year_range)
    return {
        "sdg_goals": flatten_goals(landed["goals"], extracted_at),
        "sdg_targets": flatten_targets(landed["targets"], extracted_at),
        "sdg_indicators": flatten_indicators(landed["indicators"], extracted_at),
        "sdg_geo_areas": flatten_areas(landed["areas"], extracted_at),
        "sdg_indicator_data": observations,
        "wb_countries": flatten_countries(landed["countries"], extracted_at),
        "wb_indicators": series,
        "rejects": reduce(DataFrame.unionByName, [*[payload_rejects(landed[k], k) for k in kinds], *cut_off]),
        "rejects_series": series_rejects,
        "page_report": page_report(series_pages, "indicator_code"),
    }
