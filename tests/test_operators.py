import math
import random

import pytest

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.change import lag_delta
from strata.operators.features import (entity_profile, exact_medians, latest_non_null, median_fill)
from strata.operators.joins import left_any_match
from strata.operators.ordinal import encode_labels, global_ordinal
from strata.operators.pivot import pivot_max
from strata.operators.profile import (best_worst, category_share, count_by, coverage, null_profile, table_counts,
                                      top_n)
from strata.operators.rollup import rollup_measures


def _or_join(left, right, pairs):
    cond = None
    for lc, rc in pairs:
        c = left[lc] == right[rc]
        cond = c if cond is None else (cond | c)
    return left.join(right, cond, "left")


def test_left_any_match_equals_or_join_random(spark):
    rnd = random.Random(7)
    left = [(i, rnd.choice([None, *range(8)]), rnd.choice([None, "a", "b", "c", "d"])) for i in range(300)]
    right = [(j, rnd.choice([None, *range(8)]), rnd.choice([None, "a", "b", "c", "e"])) for j in range(40)]
    L = spark.createDataFrame(left, "lid int, lcode int, lname string")
    R = spark.createDataFrame(right, "rid int, rcode int, rname string")
    pairs = [("lname", "rname"), ("lcode", "rcode")]
    got = left_any_match(L, R, pairs)
    want = _or_join(L, R, pairs)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_left_any_match_fanout_and_unmatched(spark):
    L = spark.createDataFrame([("X", "N"), (None, None)], "code string, name string")
    R = spark.createDataFrame([("X", "M"), ("Y", "N")], "rcode string, rname string")
    out = left_any_match(L, R, [("name", "rname"), ("code", "rcode")])
    assert rows(out) == sorted([("X", "N", "X", "M"), ("X", "N", "Y", "N"), (None, None, None, None)], key=repr)


def test_left_any_match_with_hot_keys_equals_or_join(spark, monkeypatch):
    from strata.operators import joins

    rnd = random.Random(17)
    # a third of the rows share one name, another third have none
    left = [(i, rnd.choice([None, 1, 1, *range(8)]), rnd.choice(["hot", None, rnd.choice("abcd")])) for i in range(600)]
    right = [(j, rnd.choice([None, *range(6)]), rnd.choice([None, "hot", "a", "b", "z"])) for j in range(40)]
    L = spark.createDataFrame(left, "lid int, lcode int, lname string")
    R = spark.createDataFrame(right, "rid int, rcode int, rname string")
    pairs = [("lname", "rname"), ("lcode", "rcode")]
    assert set(joins.hot_keys(L, "lname", 0.2)) == {"hot", None}
    want = _or_join(L, R, pairs)
    for limit in (joins.HOT_ROWS, 0):                       # by broadcast, and beyond the size check
        monkeypatch.setattr(joins, "HOT_ROWS", limit)
        got = left_any_match(L, R, pairs, hot_share=0.2)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_left_any_match_of_repeated_rows_and_three_alternatives(spark):
    L = spark.createDataFrame([("N", 1, 5), ("N", 1, 5), ("Q", 9, 5), ("Q", 9, 7), (None, None, None)], "name string, code int, k int")
    R = spark.createDataFrame([("N", 1, 5), ("N", 2, 5), ("M", 1, 6)], "rname string, rcode int, rk int")
    pairs = [("name", "rname"), ("code", "rcode"), ("k", "rk")]
    assert rows(left_any_match(L, R, pairs)) == rows(_or_join(L, R, pairs))


def test_kth_smallest_of_any_k(spark):
    from strata.operators.select import kth_smallest

    rnd = random.Random(3)
    values = [rnd.choice([rnd.randrange(1 << 60), rnd.randrange(50), 7]) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v long").repartition(5)
    order = sorted(values)
    for k in (1, 2, 133, 200, 399, 400):
        want = (order[k - 1], sum(v < order[k - 1] for v in order), sum(v == order[k - 1] for v in order))
        assert kth_smallest(df, "v", k, few=5) == want and kth_smallest(df, "v", k) == want
    with pytest.raises(ValueError):
        kth_smallest(df, "v", 401)
    with pytest.raises(ValueError):
        kth_smallest(df.limit(0), "v", 1)


def test_hold_out_is_exact(spark):
    import math

    from strata.operators.predict import hold_out

    for n in (0, 1, 4, 5, 35, 101):
        df = spark.createDataFrame([(i, f"g{i % 3}", i // 2) for i in range(n)], "a long, b string, twin long")
        got = {r.a for r in hold_out(df.repartition(4), ["a", "b"]).filter("is_test").collect()}
        assert len(got) == math.ceil(0.2 * n)
        assert got == {r.a for r in hold_out(df.coalesce(1), ["a", "b"]).filter("is_test").collect()}
        # equal keys: still as many rows, and the same ones
        pairs = hold_out(df.repartition(3), ["twin"])
        assert pairs.filter("is_test").count() == math.ceil(0.2 * n) and pairs.count() == n
    assert hold_out(spark.range(9), ["id"], 0.0).filter("is_test").count() == 0
    assert hold_out(spark.range(9), ["id"], 1.0).filter("is_test").count() == 9


def test_packed_order_compares_as_the_columns(spark):
    import datetime as dt
    import itertools

    from strata.operators.features import packed_order

    parts = {"d date": [None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(2020, 1, 1), dt.date(9999, 12, 31)],
             "t timestamp": [None, dt.datetime(1900, 1, 1), dt.datetime(2020, 1, 1, 0, 0, 0, 1), dt.datetime(9999, 12, 30)],
             "z timestamp_ntz": [None, dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2020, 3, 4, 5, 6, 7, 8)],
             "l long": [None, -(1 << 63), -1, 0, (1 << 63) - 1], "i int": [None, -(1 << 31), 3], "b boolean": [None, False, True]}
    for one, two in itertools.permutations(parts, 2):
        names = [one.split()[0], two.split()[0]]
        values = list(itertools.product(parts[one], parts[two]))
        df = spark.createDataFrame(values, f"{one}, {two}").repartition(4)
        plain = [r[:2] for r in df.orderBy(*[F.asc_nulls_first(n) for n in names]).collect()]
        for measure in (True, False):
            packed = [r[:2] for r in df.select(*names, packed_order(df, names, measure).alias("p")).orderBy("p").collect()]
            assert packed == plain, (one, two)
    near = spark.createDataFrame([(a, b) for a in (None, -5, 0, 3) for b in (None, 10 ** 12, 10 ** 12 + 7)], "a long, b long").repartition(3)
    ordered = near.withColumn("p", packed_order(near, ["a", "b"]))
    assert ordered.schema["p"].dataType.typeName() == "long"
    assert [r[:2] for r in ordered.orderBy("p").collect()] == [r[:2] for r in near.orderBy(F.asc_nulls_first("a"), F.asc_nulls_first("b")).collect()]
    assert packed_order(spark.createDataFrame([("a", 1)], "s string, n int"), ["s", "n"]) is None
    wide = spark.createDataFrame([(1, -(1 << 63)), ((1 << 63) - 1, 2)], "a long, b long")
    assert packed_order(wide, ["a", "b"]) is None           # 130 bits
    latest = latest_non_null(spark.createDataFrame([("A", 1, 2, "x", None), ("A", 1, 3, None, 4.0), ("A", 1, 1, "w", 1.0), ("B", 0, 0, None, None)],
                                                   "k string, y int, m int, s string, v double"), "k", ["y", "m"], ["s", "v"])
    assert rows(latest) == [("A", "x", 4.0), ("B", None, None)]


def test_left_any_match_plan_has_no_nested_loop(spark):
    L = spark.range(100).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    R = spark.range(50).select(F.col("id").alias("c"), (F.col("id") % 5).alias("d"))
    plan = left_any_match(L, R, [("a", "c"), ("b", "d")])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rollup_counts_unparsable_but_not_in_measures(spark):
    df = spark.createDataFrame([("A", "1.1", 2000, None), ("A", "1.2", 2000, 4.0), ("B", "2.1", 2000, None)],
                               "c string, ind string, year long, value double")
    out = rollup_measures(df, ["c", "year"], "ind", "value")
    got = {r.c: (r.indicators_measured, r.avg_indicator_value) for r in out.collect()}
    assert got == {"A": (2, 4.0), "B": (1, None)}


def test_lag_over_ranges_equals_one_window(spark):
    from strata.operators.change import lag_delta_ranged

    rnd = random.Random(5)
    data = [(rnd.choice(["hot", "hot", None, "a", "b"]), i // 2, i, rnd.choice([None, float(i % 11)])) for i in range(500)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "k string, t long, id long, v double")
    spread = lag_delta_ranged(df, ["k"], ["t"], "v", tie=["id"], ranges=8)
    assert rows(spread) == rows(lag_delta(df, ["k"], ["t"], "v", tie=["id"]))
    assert lag_delta_ranged(df.limit(0), ["k"], ["t"], "v").count() == 0
    # the hot series lies in several ranges: no task holds all of it
    parts = df.repartitionByRange(8, "k", "t", "id").withColumn("p", F.spark_partition_id()).filter("k = 'hot'").select("p").distinct().count()
    assert parts > 1


def test_lag_steps_to_previous_present_row(spark):
    df = spark.createDataFrame([("A", 2000, 1.0), ("A", 2001, 3.0), ("A", 2005, 10.0), ("B", 2001, 5.0)],
                               "c string, year long, v double")
    out = lag_delta(df, ["c"], ["year"], "v", "prev", "chg")
    got = {(r.c, r.year): (r.prev, r.chg) for r in out.collect()}
    assert got[("A", 2005)] == (3.0, 7.0) and got[("A", 2000)] == (None, None) and got[("B", 2001)] == (None, None)


def test_pivot_max(spark):
    df = spark.createDataFrame([("A", 1, "x", 1.0), ("A", 1, "x", 3.0), ("A", 1, "y", 2.0), ("B", 1, "z", 9.0)],
                               "k string, y int, code string, v double")
    out = pivot_max(df, ["k", "y"], "code", "v", {"x": "x_max", "y": "y_max"})
    assert rows(out) == [("A", 1, 3.0, 2.0), ("B", 1, None, None)]


def test_count_by_coalesced_key_single_unknown_group(spark):
    df = spark.createDataFrame([(None,), ("Unknown",), ("A",), ("A ",)], "region string")
    got = dict((r.region, r.n) for r in count_by(df, "region", "region", "Unknown", "n").collect())
    assert got == {"Unknown": 2, "A": 1, "A ": 1}


def test_null_profile_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    r = null_profile(df, {"na": "a", "nb": "b"}).first()
    assert (r.na, r.nb) == (1, 2)
    assert null_profile(df.filter("false"), {"na": "a"}).first().na is None


def test_top_n_nan_and_null_last(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 5.0), (3, None), (4, 7.0), (5, 5.0)], "k int, v double")
    assert [r.k for r in top_n(df, "v", 4, tie=["k"]).collect()] == [4, 2, 5, 1]


def test_table_counts_reports_failures(spark):
    out = table_counts(spark, {"ok": lambda: spark.range(3), "bad": lambda: spark.read.parquet("/nonexistent/x")})
    got = {r.table_name: (r.row_count, r.error is not None) for r in out.collect()}
    assert got == {"ok": (3, False), "bad": (None, True)}


def test_coverage(spark):
    df = spark.createDataFrame([("a", "1", 2000), ("a", "2", 2003), ("b", "1", 2003)], "c string, g string, y long")
    r = coverage(df, {"countries": "c", "goals": "g", "years": "y"}, "y").first()
    assert (r.countries, r.goals, r.years, r.min_year, r.max_year) == (2, 2, 2, 2000, 2003)


def test_category_share_lists_empty_categories(spark):
    df = spark.createDataFrame([("A",), ("A",), (None,), ("C",)], "cat string")
    out = {r.category: (r["count"], r.share_pct) for r in category_share(df, "cat", ["A", "B", "C"]).collect()}
    assert out == {"A": (2, 50.0), "B": (0, 0.0), "C": (1, 25.0)}


def test_best_worst(spark):
    df = spark.createDataFrame([(f"c{i}", float(i)) for i in range(30)], "name string, s double")
    out = best_worst(df, "name", "s", 3)
    got = sorted((r.side, r.position, r.name) for r in out.collect())
    assert got[:3] == [("best", 1, "c29"), ("best", 2, "c28"), ("best", 3, "c27")]
    assert got[3:] == [("worst", 1, "c0"), ("worst", 2, "c1"), ("worst", 3, "c2")]


def test_exact_medians_match_numpy(spark):
    rnd = np.random.default_rng(3)
    for n in (1, 2, 7, 10, 1001, 4000):
        vals = rnd.integers(0, 50, n).astype(float) if n % 2 else rnd.normal(0, 1e6, n)
        df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "x double")
        got = exact_medians(df, ["x"])["x"]
        assert math.isclose(got, float(np.median(vals)), rel_tol=0, abs_tol=1e-9), (n, got)
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_medians(empty, ["x"])["x"] is None


def test_median_fill_keeps_all_missing_column(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (10.0, None)], "a double, b double")
    out = median_fill(df, ["a", "b"]).collect()
    assert [r.a for r in out] == [1.0, 3.0, 3.0, 10.0] and all(r.b is None for r in out)


def test_global_ordinal_and_encode_labels(spark):
    labels = [f"L{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(lab,) for lab in labels * 2], "lab string").repartition(7)
    got = {r.lab: r.ordinal for r in global_ordinal(df, "lab").collect()}
    assert got == {lab: i for i, lab in enumerate(sorted(labels))}
    d = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, region string")
    enc = {r.id: r.region_encoded for r in encode_labels(d, ["region"]).collect()}
    assert enc == {1: 2, 2: 0, 3: 1, 4: 2}   # sorted: 'Unknown' < 'a' < 'b'


def test_entity_profile_single_observation_and_nan_free(spark):
    df = spark.createDataFrame([("A", "1", 2000, 1.0, None), ("B", "1", 2000, 1.0, None), ("B", "1", 2001, 3.0, 2.0),
                                ("B", "1", 2002, None, None)], "c string, g string, year long, v double, chg double")
    out = {r.c: r for r in entity_profile(df, ["c", "g"], "v", ["year"], change="chg", period="year").collect()}
    a, b = out["A"], out["B"]
    assert (a.value_std, a.avg_yoy_change, a.total_change, a.data_points) == (0.0, 0.0, 0.0, 1)
    assert (b.value_mean, b.value_latest, b.data_points, b.latest_year) == (2.0, 3.0, 3, 2002)


def test_latest_non_null_per_column(spark):
    df = spark.createDataFrame([("A", 2000, "x", 1.0), ("A", 2001, None, 2.0), ("A", 2002, "z", None)],
                               "k string, year long, s string, v double")
    r = latest_non_null(df, "k", ["year"], ["s", "v"]).first()
    assert (r.s, r.v) == ("z", 2.0)


def test_fanout_duplicates_and_recode(spark):
    from strata.operators.joins import recode
    from strata.operators.profile import duplicate_keys, fanout
    L = spark.createDataFrame([("X", "N"), ("Z", "Q")], "code string, name string")
    R = spark.createDataFrame([("X", "M"), ("Y", "N")], "rcode string, rname string")
    j = left_any_match(L, R, [("name", "rname"), ("code", "rcode")])
    assert fanout(j, ["code", "name"]).first().fanout_rows == 1
    d = spark.createDataFrame([("A_1_2000",), ("A_1_2000",), ("B_1_2000",)], "progress_id string")
    assert [(r.progress_id, r.copies) for r in duplicate_keys(d, "progress_id").collect()] == [("A_1_2000", 2)]
    facts = spark.createDataFrame([("AFG", 1.0), ("BRA", 2.0), ("XXX", 3.0)], "country_code string, v double")
    cw = spark.createDataFrame([("AFG", "4"), ("BRA", "76")], "source_code string, target_code string")
    assert sorted(r.country_code for r in recode(facts, cw, "country_code").collect()) == ["4", "76", "XXX"]


def test_roll_latest_equals_latest_non_null(spark):
    from strata.operators.features import roll_latest
    rows = [("A", g, y, (None if (y + int(g)) % 3 == 0 else f"r{y}{g}"), (None if y % 2 else float(y * 10 + int(g))))
            for g in ("1", "2", "3") for y in range(2000, 2006)]
    df = spark.createDataFrame(rows + [("B", "1", 2000, None, None)], "c string, g string, y long, r string, v double")
    prof = entity_profile(df, ["c", "g"], "v", ["y"], carry=["r", "v"], carry_order=["y", "g"])
    got = {x.c: (x.r, x.v) for x in roll_latest(prof, "c", ["r", "v"]).collect()}
    want = {x.c: (x.r, x.v) for x in latest_non_null(df, "c", ["y", "g"], ["r", "v"]).collect()}
    assert got == want and got["B"] == (None, None)


def test_approximate_options(spark):
    from strata.operators.features import approx_medians
    df = spark.createDataFrame([(float(i), f"k{i % 10}") for i in range(1001)], "x double, k string")
    assert abs(approx_medians(df, ["x"])["x"] - 500.0) <= 1.0
    r = coverage(df, {"keys": "k"}, "x", approx=True).first()
    assert r.keys == 10 and (r.min_year, r.max_year) == (0.0, 1000.0)
    filled = median_fill(df.withColumn("y", F.when(F.col("x") > 10, F.col("x"))), ["y"], approx=True)
    assert filled.filter(F.col("y").isNull()).count() == 0


def test_exact_median_histogram_path_default_parameters(spark):
    # above the default 250,000-value bound, so the distributed selection runs
    n = 400_000
    df = spark.range(n).select(
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double") / 7.0).alias("x"),
        F.when(F.col("id") % 2 == 0, F.lit(5.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(97)).cast("double")).alias("y"))
    got = exact_medians(df, ["x", "y"])
    pdf = df.toPandas()
    assert got["x"] == float(np.median(pdf["x"].to_numpy()))
    assert got["y"] == float(np.median(pdf["y"].to_numpy()))


def test_global_ordinals_several_columns(spark):
    from strata.operators.ordinal import global_ordinals
    a = [f"a{i:03d}" for i in range(300)]
    b = [f"b{i:03d}" for i in range(40)]
    df = spark.createDataFrame([(a[i % 300], b[i % 40]) for i in range(900)], "x string, y string").repartition(5)
    got = {(r._c, r._v): r.ordinal for r in global_ordinals(df, ["x", "y"]).collect()}
    want = {**{(0, v): i for i, v in enumerate(sorted(a))}, **{(1, v): i for i, v in enumerate(sorted(b))}}
    assert got == want


def test_exact_median_with_infinities(spark):
    inf = float("inf")
    for vals in ([-inf, 1.0, 2.0, 3.0, inf], [-inf, -inf, -inf, 1.0, 2.0], [1.0, inf, inf, inf],
                 [float(i) for i in range(50)] + [inf] * 3 + [-inf], [0.0, 5e-324], [5e-324] * 3 + [0.0] * 3, [inf, inf]):
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        got = exact_medians(df, ["x"])["x"]
        with np.errstate(invalid="ignore"):
            want = inf if vals == [inf, inf] else float(np.median(np.array(vals)))
        assert got == want, (vals, got)


def test_rollup_nan_semantics(spark):
    nan = float("nan")
    df = spark.createDataFrame([("A", "i1", 1.0), ("A", "i2", nan), ("A", "i3", 3.0), ("B", "i1", 2.0)],
                               "k string, ind string, v double")
    for part in (None, ["k"]):
        spark_default = {r.k: r for r in rollup_measures(df, ["k"], "ind", "v", partition_by=part).collect()}
        assert spark_default["A"].min_indicator_value == 1.0 and math.isnan(spark_default["A"].max_indicator_value)
        parity = {r.k: r for r in rollup_measures(df, ["k"], "ind", "v", partition_by=part, nan_extremes=True).collect()}
        assert math.isnan(parity["A"].min_indicator_value) and math.isnan(parity["A"].max_indicator_value)
        assert math.isnan(parity["A"].avg_indicator_value) and parity["B"].min_indicator_value == 2.0


def test_medians_of_several_columns_in_one_pass(spark):
    rnd = np.random.default_rng(9)
    rows = [(float(a), float(b), None) for a, b in zip(rnd.normal(size=5001), rnd.integers(0, 3, 5001))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(9)
    got = exact_medians(df, ["a", "b", "c"])
    assert got == {"a": float(np.median([r[0] for r in rows])), "b": float(np.median([r[1] for r in rows])), "c": None}


def test_fanout_counts_null_keys(spark):
    from strata.operators.profile import fanout
    df = spark.createDataFrame([("1", "a"), ("2", None), (None, "b")], "k string, n string")
    assert fanout(df, ["k", "n"]).first()[0] == 0
    assert fanout(df.unionByName(df), ["k", "n"]).first()[0] == 3


def test_any_match_keeps_repeated_and_unmatched_rows(spark):
    left = spark.createDataFrame([(1, 2), (1, 2), (9, 9), (9, 9), (None, None), (3, 1)], "l1 int, l2 int")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "r int, v string")
    right = right.withColumn("r2", F.col("r"))
    got = sorted((tuple(r) for r in left_any_match(left, right, [("l1", "r"), ("l2", "r2")]).collect()), key=repr)
    cond = (left.l1 == right.r) | (left.l2 == right.r2)
    want = sorted((tuple(r) for r in left.join(right, cond, "left").collect()), key=repr)
    assert got == want


def test_distinct_counts_of_merged_states(spark):
    import random

    from strata.operators.rollup import distinct_counts, distinct_state, merge_states

    draw = random.Random(3)
    values = [None, 0, -1, 1, 32767, 32768, 32769, -32768, 1 << 40, (1 << 62) + 5]
    rows = [(draw.choice("ab"), draw.choice([1, 2, None]), draw.choice(values)) for _ in range(120)] + [("c", 1, None)]
    frame = lambda part: spark.createDataFrame(part, "g string, y int, v long")
    keys = ["g", "y"]
    state = merge_states([distinct_state(frame(part), keys, "v") for part in (rows[:70], rows[50:])], keys)
    got = {(r.grain, r.g, r.y): r.n for r in distinct_counts(state, {"g": ["g"], "y": ["y"], "both": keys, "all": []}, "n").collect()}
    want = {}
    for g, y, v in rows:
        for key in (("g", g, None), ("y", None, y), ("both", g, y), ("all", None, None)):
            want.setdefault(key, set()).update([] if v is None else [v])
    assert got == {k: len(v) for k, v in want.items()}
    none = distinct_state(frame([]), keys, "v")
    assert [r.n for r in distinct_counts(none, {"g": ["g"], "all": []}, "n").collect()] == [0]


def test_bracketed_medians_equal_exact_ones(spark):
    from strata.operators.features import bracketed_medians

    inf, nan = float("inf"), float("nan")
    cases = [[1.0], [1.0, 2.0], [None, nan], [], [3.0, 3.0, 1.0, None], [-inf, inf], [inf, inf, 1.0], [-0.0, 0.0, 5e-324, 5e-324]]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert repr(bracketed_medians(df, ["x"])) == repr(exact_medians(df, ["x"])), values
    df = spark.range(20_001).select(
        F.pmod(F.xxhash64("id"), F.lit(10_007)).cast("double").alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") / 7).alias("hot"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("half"), F.lit(None).cast("double").alias("none"))
    cols = ["a", "hot", "half", "none"]
    want = exact_medians(df, cols)
    for accuracy in (4, 100, 10_000):       # wide and narrow brackets
        assert bracketed_medians(df, cols, accuracy) == want


def test_bracketed_medians_open_a_bracket_that_misses(spark, monkeypatch):
    from strata.operators import features

    df = spark.range(101).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"))
    far = lambda c, shares, accuracy: F.array(F.lit(90.0), F.lit(95.0))
    monkeypatch.setattr(features.F, "percentile_approx", lambda c, s, a: F.first(far(c, s, a)))
    assert features.bracketed_medians(df, ["x", "y"]) == {"x": 50.0, "y": 100.0}
