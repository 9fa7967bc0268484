import datetime as dt
import math

from pyspark.sql import functions as F

from strata.functions.classify import band, flag, in_groups, threshold
from strata.functions.clean import safe_double, safe_long, text_timestamp
from strata.functions.keys import dotted, first_present, prefix, surrogate_key
from strata.operators.predict import CATEGORY_EDGES, CATEGORY_LABELS
from strata.plans.marts import GOAL_CATEGORIES, era


def test_safe_year_numeric_rounds_half_away(spark):
    df = spark.createDataFrame([(2000.5,), (2001.4,), (-2.5,), (None,)], "t double")
    got = [r[0] for r in df.select(safe_long("t", df.schema["t"].dataType)).collect()]
    assert got == [2001, 2001, -3, None]


def test_safe_year_text(spark):
    df = spark.createDataFrame([("2001",), ("2001.0",), ("abc",), (None,), ("1999",)], "t string")
    got = [r[0] for r in df.select(safe_long("t", df.schema["t"].dataType)).collect()]
    assert got == [2001, None, None, None, 1999]


def test_safe_double_guards_suffixes_and_nan(spark):
    df = spark.createDataFrame([("<0.1",), ("1d",), ("NaN",), ("",), (None,), ("5",), ("1,000",), (" 2.5e1 ",)],
                               "v string")
    null_policy = [r[0] for r in df.select(safe_double("v", df.schema["v"].dataType)).collect()]
    assert null_policy == [None, None, None, None, None, 5.0, None, 25.0]
    keep = [r[0] for r in df.select(safe_double("v", df.schema["v"].dataType, "propagate")).collect()]
    assert math.isnan(keep[2])


def test_text_timestamp_keeps_fraction(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00.123456",), ("2024-01-01 10:00:00",)], "t string")
    got = [r[0] for r in df.select(text_timestamp("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 0, 0, 123456), dt.datetime(2024, 1, 1, 10, 0, 0)]


def test_dotted_levels(spark):
    df = spark.createDataFrame([("1.2.1",), ("17",), ("",), (None,)], "c string")
    got = df.select(dotted("c", 1).alias("g"), dotted("c", 2).alias("t")).collect()
    assert [(r.g, r.t) for r in got] == [("1", "1.2"), ("17", "17"), ("", ""), (None, None)]


def test_surrogate_key_null_propagates(spark):
    df = spark.createDataFrame([("A", "1", 2000), (None, "1", 2000)], "a string, b string, y long")
    got = [r[0] for r in df.select(surrogate_key("a", "b", "y")).collect()]
    assert got == ["A_1_2000", None]


def test_first_present_and_prefix(spark):
    df = spark.createDataFrame([(None, None), (None, "b"), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(first_present("x", "y", default="Unknown")).collect()] == ["Unknown", "b", "a"]
    assert spark.range(1).select(prefix(F.lit("abcdef"), 3)).first()[0] == "abc"


def test_bands_are_right_closed(spark):
    ps = [0.0, 0.3, 0.3001, 0.5, 0.7, 1.0]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = df.select(band("p", CATEGORY_EDGES, CATEGORY_LABELS).alias("c"), threshold("p", 0.5).alias("f")).collect()
    assert [r.c for r in got] == [None, "Off Track", "At Risk", "At Risk", "Moderate Progress", "On Track"]
    assert [r.f for r in got] == [0, 0, 0, 1, 1, 1]


def test_goal_categories_and_flags(spark):
    df = spark.createDataFrame([(str(i),) for i in range(1, 19)] + [(None,)], "g string")
    got = {r.g: r.c for r in df.select("g", in_groups("g", GOAL_CATEGORIES).alias("c")).collect()}
    assert got["6"] == "People" and got["12"] == "Prosperity" and got["15"] == "Planet"
    assert got["17"] == "Peace & Partnership" and got["18"] == "Other" and got[None] == "Other"
    y = spark.createDataFrame([(2014,), (2015,), (2030,), (2031,), (None,)], "y long")
    r = y.select(era("y").alias("e"), flag("y", 2015).alias("b")).collect()
    assert [x.e for x in r] == ["MDG Era", "SDG Era", "SDG Era", "Post-SDG", "Post-SDG"]
    assert [x.b for x in r] == [False, True, False, False, False]
