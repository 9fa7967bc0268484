"""Large documents read in byte ranges: equal to whole documents, wherever a range is cut."""

import json
import random

import pytest
from conftest import rows
from strata.sources import landing
from strata.sources.ranges import cut_off_documents, read_records


def odd_text(draw):
    return "".join(draw.choice(['}', '{', '[', ']', '"', '\\', ',', 'é', '日', ' ', '\n', 'x', '"data": [{', '\\"']) for _ in range(draw.randrange(0, 30)))


def documents(draw, n):
    record = lambda: {"geoAreaCode": odd_text(draw), "geoAreaName": odd_text(draw), "timePeriodStart": draw.randrange(1990, 2030),
                      "value": str(draw.random()), "source": odd_text(draw)}
    other = lambda: [{"code": odd_text(draw), "deep": {"a": [1, {"b": odd_text(draw)}]}} for _ in range(draw.randrange(0, 3))]
    for _ in range(n):
        doc = {"size": 3, "note": odd_text(draw), "attributes": other(), "data": [record() for _ in range(draw.randrange(0, 40))],
               "dimensions": other(), "list": [1, 2]}
        keys = list(doc)
        draw.shuffle(keys)
        yield {k: doc[k] for k in keys}


@pytest.mark.parametrize("range_bytes", [64, 700, 1 << 20])
def test_observations_equal_whole_documents(spark, tmp_path, range_bytes):
    draw = random.Random(range_bytes)
    folder = tmp_path / "observations"
    for i, doc in enumerate(documents(draw, 6)):
        (folder / f"1.{i}").mkdir(parents=True)
        (folder / f"1.{i}" / "1.json").write_text(json.dumps(doc, ensure_ascii=i % 2 == 0, indent=draw.choice([None, 1])), encoding="utf-8")
    tag = lambda df: df.withColumn("indicator_code", landing.observation_code(df["source_file"]))
    flat = lambda df: rows(landing.flatten_observations(tag(df), "indicator_code", "2024-01-01"))
    records = read_records(spark, str(folder), "data", range_bytes)
    assert flat(records) == flat(landing.read_payload_files(spark, str(folder)))
    if range_bytes < 1000:
        assert records.select("range").distinct().count() > (20 if range_bytes < 100 else 5)          # no task reads a document whole
    assert cut_off_documents(spark, str(folder), range_bytes).count() == 0


@pytest.mark.parametrize("range_bytes", [50, 4000])
def test_series_and_catalogues(spark, tmp_path, range_bytes):
    draw = random.Random(9)
    for page in (1, 2, 3):
        records = [{"country": {"id": f"C{k}", "value": odd_text(draw)}, "date": str(2000 + k % 20), "value": k / 7} for k in range(40 if page < 3 else 0)]
        (tmp_path / f"series{page}.json").write_text(json.dumps([{"page": page, "pages": 3, "total": 80}, records]))
    read = read_records(spark, str(tmp_path), "paged", range_bytes)
    whole = landing.read_payload_files(spark, str(tmp_path))
    flat = lambda df: rows(landing.flatten_series(df.withColumn("c", df["source_file"]), "c", "c", "2024-01-01")[0])
    assert flat(read) == flat(whole) and len(flat(whole)) == 80
    report = lambda df: rows(landing.page_report(df.withColumn("s", df["source_file"]), "s"))
    assert report(read) == report(whole)
    goals = tmp_path / "goals"
    goals.mkdir()
    (goals / "g.json").write_text(json.dumps([{"code": k, "title": odd_text(draw)} for k in range(60)]))
    read = read_records(spark, str(goals), "array", range_bytes)
    flat = lambda df: rows(landing.flatten_goals(df, "2024-01-01"))
    assert flat(read) == flat(landing.read_payload_files(spark, str(goals)))
    places = [json.loads(r.payload)[0]["code"] for r in read.orderBy("range", "ordinal").collect()]
    assert places == list(range(60))                                     # catalogue order


def test_a_record_longer_than_many_ranges_and_cut_documents(spark, tmp_path):
    long = {"data": [{"geoAreaCode": "1", "source": "}{" * 3000}, {"geoAreaCode": "2"}]}
    (tmp_path / "long.json").write_text(json.dumps(long))
    got = landing.flatten_observations(read_records(spark, str(tmp_path), "data", 500).withColumn("c", landing.F.lit("x")), "c", "2024-01-01")
    assert sorted((r.geo_area_code, len(r.source)) for r in got.collect()) == [("1", 6000), ("2", 0)]
    whole = json.dumps({"data": [{"geoAreaCode": "1"}, {"geoAreaCode": "2"}, {"geoAreaCode": "3"}]})
    cut = tmp_path / "cut"
    cut.mkdir()
    for at in (whole.index('"2"') + 2, whole.index('"3"') + 3, len(whole) - 1):
        (cut / f"{at}.json").write_text(whole[:at])
    (cut / "whole.json").write_text(whole)
    got = landing.flatten_observations(read_records(spark, str(cut), "data", 16).withColumn("c", landing.F.col("source_file")), "c", "2024-01-01")
    counts = {}
    for r in got.collect():
        counts.setdefault(r.indicator_code.split("/")[-1], []).append(r.geo_area_code)
    assert sorted(map(len, counts.values())) == [1, 2, 3, 3]
    reasons = {r.source_file.split("/")[-1]: r.reason for r in cut_off_documents(spark, str(cut), 16).collect()}
    assert sorted(reasons.values()) == ["open bracket", "open bracket", "open string"] and "whole.json" not in reasons


def test_land_raw_in_ranges_equals_whole_documents(spark, tmp_path):
    from test_refresh import _landing

    root = str(tmp_path / "landing")
    _landing(root)
    whole, ranged = (landing.land_raw(spark, root, extracted_at="2024-01-01", max_indicators=1, range_bytes=b) for b in (None, 90))
    for name in ("sdg_goals", "sdg_targets", "sdg_indicators", "sdg_geo_areas", "sdg_indicator_data", "wb_countries", "wb_indicators", "page_report"):
        assert rows(ranged[name]) == rows(whole[name]), name
    assert {r.source_file for r in ranged["rejects"].collect()} == {r.source_file for r in whole["rejects"].collect()}
