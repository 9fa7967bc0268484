import json
import os

from pyspark.sql import functions as F

from strata.sources import landing


def _write(dirpath, name, obj):
    os.makedirs(dirpath, exist_ok=True)
    path = os.path.join(dirpath, name)
    with open(path, "w") as fh:
        fh.write(obj if isinstance(obj, str) else json.dumps(obj))
    return path


def test_catalogues(spark, tmp_path):
    d = str(tmp_path / "goals")
    _write(d, "goals.json", [{"code": 1, "title": "One", "description": "d1"}, {"code": "17", "title": "Seventeen"},
                             {"code": 2, "title": "Two", "description": None}])
    goals = landing.flatten_goals(landing.read_payload_files(spark, d)).collect()
    assert sorted((r.goal_code, r.goal_description) for r in goals) == [("1", "d1"), ("17", ""), ("2", "")]
    tg = str(tmp_path / "targets")
    _write(tg, "t.json", [{"code": "1.2", "title": "T", "description": "d"}, {"code": "17.19", "title": "U"}])
    targets = landing.flatten_targets(landing.read_payload_files(spark, tg)).collect()
    assert sorted((r.target_code, r.goal_code, r.target_description) for r in targets) == [
        ("1.2", "1", "d"), ("17.19", "17", "")]
    t = str(tmp_path / "ind")
    _write(t, "ind.json", [{"code": "1.2.1", "description": "x"}, {"code": "17.1"}])
    ind = landing.flatten_indicators(landing.read_payload_files(spark, t)).collect()
    assert sorted((r.indicator_code, r.goal_code, r.target_code) for r in ind) == [
        ("1.2.1", "1", "1.2"), ("17.1", "17", "17.1")]
    a = str(tmp_path / "areas")
    _write(a, "a.json", [{"geoAreaCode": 4, "geoAreaName": "Afghanistan"}, {"geoAreaCode": 4, "geoAreaName": "Afghanistan"}])
    assert landing.flatten_areas(landing.read_payload_files(spark, a)).count() == 2   # not de-duplicated here


def test_observations_periods_and_defaults(spark, tmp_path):
    d = str(tmp_path / "obs")
    _write(d, "1.1.1.json", {"totalElements": 6, "data": [
        {"geoAreaCode": 4, "geoAreaName": "A", "timePeriodStart": 2000.5, "value": "<0.1"},
        {"geoAreaCode": 4, "timePeriodStart": "2001", "value": 5},
        {"geoAreaCode": 4, "timePeriodStart": "2001.0", "value": "1d", "units": None},
        {"geoAreaCode": 4, "timePeriodStart": "abc", "value": "NaN"},
        {"geoAreaCode": 4, "value": ""},
        {"geoAreaCode": 4, "timePeriodStart": 1999}]})
    payloads = landing.read_payload_files(spark, d).withColumn(
        "indicator_code", F.regexp_extract("source_file", r"([^/]+)\.json$", 1))
    raw = landing.flatten_observations(payloads)
    got = [(r.indicator_code, r.geo_area_name, r.time_period, r.value, r.unit) for r in raw.collect()]
    assert got == [("1.1.1", "A", "2001", "<0.1", ""), ("1.1.1", "", "2001", "5", ""),
                   ("1.1.1", "", "2001.0", "1d", ""), ("1.1.1", "", "abc", "NaN", ""),
                   ("1.1.1", "", None, "", ""), ("1.1.1", "", "1999", None, "")]
    from strata.plans.marts import stg_observations
    staged = stg_observations(raw).collect()
    assert [(r.year, r.value) for r in staged] == [(2001, None), (2001, 5.0)]


def test_rejects_do_not_abort(spark, tmp_path):
    d = str(tmp_path / "bad")
    _write(d, "good.json", [{"code": 1, "title": "x"}])
    _write(d, "broken.json", "[{\"code\": 1,")
    _write(d, "object.json", {"code": 1})
    good, rejects = landing.split_rejects(landing.read_payload_files(spark, d), F.col("payload"),
                                          landing.schemas.GOAL_ELEMENT)
    assert good.count() == 1
    assert sorted(r.reason for r in rejects.collect()) == ["no record array", "not json"]


def test_countries_two_element_payload(spark, tmp_path):
    d = str(tmp_path / "c")
    _write(d, "p1.json", [{"page": 1, "pages": 1}, [
        {"id": "AFG", "name": "Afghanistan", "iso2Code": "AF", "region": {"value": "South Asia"},
         "incomeLevel": {"value": "Low income"}, "capitalCity": "Kabul", "longitude": "69.1", "latitude": "34.5"},
        {"id": "WLD", "name": "World", "region": {"value": ""}},
        {"id": "XXX", "name": "Null region", "region": None}]])
    _write(d, "p2.json", [{"page": 2, "pages": 2}])
    _write(d, "p3.json", [{"page": 3, "pages": 3}, None])
    out = landing.flatten_countries(landing.read_payload_files(spark, d)).collect()
    assert [(r.country_code, r.region, r.country_code_iso3) for r in out] == [("AFG", "South Asia", "AF")]


def test_series_pages_rejects_and_gaps(spark, tmp_path):
    d = str(tmp_path / "s")
    rec = lambda c, y, v: {"country": {"id": c, "value": c + " name"}, "date": y, "value": v}
    _write(d, "p1.json", [{"page": 1, "pages": 3, "per_page": 2, "total": 5}, [rec("AF", "2001", 1.5), rec("AF", "2002", 0)]])
    _write(d, "p3.json", [{"page": 3, "pages": 3, "per_page": 2, "total": 5}, [rec("BR", "2001Q1", 2), rec("BR", "1990", 3)]])
    payloads = landing.read_payload_files(spark, d).withColumn("series", F.lit("NY.GDP.PCAP.CD"))
    good, rejects = landing.flatten_series(payloads, "series", F.lit("GDP"), year_range=(2000, 2024))
    assert sorted((r.country_code, r.year, r.value) for r in good.collect()) == [("AF", 2001, 1.5), ("AF", 2002, 0.0)]
    assert landing.flatten_series(payloads, "series", F.lit("GDP"))[0].count() == 3      # no period: 1990 stays
    zero_null, _ = landing.flatten_series(payloads, "series", F.lit("GDP"), zero_as_null=True)
    assert sorted(r.value for r in zero_null.collect() if r.year == 2002) == [None]
    assert [r.date for r in rejects.collect()] == ["2001Q1"]
    rep = landing.page_report(payloads, "series").first()
    assert (rep.declared_pages, rep.landed_pages, rep.missing_pages) == (3, 2, 1)
    assert [r.page for r in landing.missing_pages(payloads, "series").collect()] == [2]
    sizes = landing.payload_sizes(payloads, "series").first()
    assert (sizes.declared_total, sizes.landed_rows) == (5, 4)


def test_first_n_codes_and_restrict(spark):
    cat = spark.createDataFrame([(f"c{i}", i) for i in range(50)], "code string, pos int")
    data = spark.createDataFrame([(f"c{i % 60}", i) for i in range(600)], "code string, v int")
    codes = landing.first_n_codes(cat, "code", "pos", 5)
    assert sorted(r.code for r in codes.collect()) == ["c0", "c1", "c2", "c3", "c4"]
    assert landing.restrict(data, codes, "code").count() == 50


def test_missing_pages_blocks(spark):
    # one series declares 5000 pages and lands all but 3; another lands none of 3
    import json as _json
    rows = [("S", _json.dumps([{"page": p, "pages": 5000}, []])) for p in range(1, 5001) if p not in (7, 2048, 5000)]
    rows.append(("T", _json.dumps([{"page": 0, "pages": 3}, []])))
    payloads = spark.createDataFrame(rows, "series string, payload string")
    got = sorted((r.series, r.page) for r in landing.missing_pages(payloads, "series", block=1024).collect())
    assert got == [("S", 7), ("S", 2048), ("S", 5000), ("T", 1), ("T", 2), ("T", 3)]


def test_missing_pages_shuffle_no_missing_page(spark, capsys):
    # two blocks and a page past the last declared one, twice landed pages, a series without a name
    pages = [("S", 9, p) for p in (2, 2, 4, 5, 9, 12, 40)] + [(None, 3, 2), ("T", 4, 0), ("U", 8, 8)]
    rows = [(s, json.dumps([{"page": p, "pages": n}, []])) for s, n, p in pages]
    payloads = spark.createDataFrame(rows, "series string, payload string")
    missing = landing.missing_pages(payloads, "series", block=4)
    want = [("S", p) for p in (1, 3, 6, 7, 8)] + [(None, p) for p in (1, 2, 3)] + [("T", p) for p in (1, 2, 3, 4)] + [
        ("U", p) for p in range(1, 8)]
    assert sorted(((r.series, r.page) for r in missing.collect()), key=repr) == sorted(want, key=repr)
    # missing pages may be a thousand times the landed ones: they are made after the last exchange
    missing.explain("simple")
    plan = capsys.readouterr().out
    assert "Join" not in plan and plan.index("sequence(low") < plan.index("Exchange")


def test_land_raw_reports_every_unreadable_document(spark, tmp_path):
    root = str(tmp_path / "landing")
    good = {"goals": [{"code": 1}], "targets": [{"code": "1.1"}], "indicators": [{"code": "1.1.1"}],
            "areas": [{"geoAreaCode": 4, "geoAreaName": "A"}], "countries": [{"page": 1}, [{"id": "AFG", "region": {"value": "R"}}]]}
    for kind, doc in good.items():
        _write(f"{root}/{kind}", "good.json", doc)
        _write(f"{root}/{kind}", "cut.json", json.dumps(doc)[:-4])
    obs = lambda v: {"data": [{"geoAreaCode": 4, "timePeriodStart": 2001, "value": v}]}
    _write(f"{root}/observations/1.1.1", "1.json", obs("1"))
    _write(f"{root}/observations/1.1.1", "2.json", obs("2"))
    _write(f"{root}/observations", "1.2.1.json", obs("3"))
    _write(f"{root}/observations/1.1.1", "3.json", "{\"data\": [")
    rec = lambda v, y="2025": {"country": {"id": "A", "value": "A"}, "date": y, "value": v}
    _write(f"{root}/series/X", "1.json", [{"page": 1, "pages": 2}, [rec("1.5"), rec("1d"), rec("<0.1"), rec("7", "2025Q1")]])
    _write(f"{root}/series/X", "2.json", "[{\"page\": 2}, [")
    raw = landing.land_raw(spark, root)
    assert sorted((r.indicator_code, r.value) for r in raw["sdg_indicator_data"].collect()) == [
        ("1.1.1", "1"), ("1.1.1", "2"), ("1.2.1", "3")]
    kinds = sorted((r.kind, r.reason, r.source_file.rsplit("/", 1)[1]) for r in raw["rejects"].collect())
    assert kinds == [("areas", "not json", "cut.json"), ("countries", "not json", "cut.json"), ("goals", "not json", "cut.json"),
                     ("indicators", "not json", "cut.json"), ("observations", "not json", "3.json"),
                     ("series", "not json", "2.json"), ("targets", "not json", "cut.json")]
    assert [(r.year, r.value) for r in raw["wb_indicators"].collect()] == [(2025, 1.5)]     # no period by default
    assert sorted((r.value, r.reason) for r in raw["rejects_series"].collect()) == [
        ("1d", "value not a number"), ("7", "date not an integer"), ("<0.1", "value not a number")]
    assert landing.land_raw(spark, root, year_range=(2000, 2024))["wb_indicators"].count() == 0


def test_csv_keeps_blanks_and_quotes(spark, tmp_path):
    from strata.sources import sinks
    rows = [("Sub-Saharan Africa ", 1), (" lead", 2), ('say "hi", you', 3), ("two\nlines", 4), ("back\\slash", 5), (None, 6)]
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame(rows, "v string, k int"), path)
    got = [tuple(r) for r in sinks.read_csv(spark, path, "v string, k int").collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)
