"""End to end on a hand-made landing folder: payloads -> raw -> marts -> model -> exports."""

import json
import os

from pyspark.sql import functions as F

from strata.plans.refresh import refresh
from strata.session import scratch_path


def _put(root, rel, obj):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(obj, fh)


def _landing(root):
    _put(root, "goals/goals.json", [{"code": 1, "title": "One", "description": "g1"},
                                    {"code": 3, "title": "Three"}, {"code": 17, "title": "Seventeen"}])
    _put(root, "targets/targets.json", [{"code": "1.1", "title": "t"}, {"code": "3.1", "title": "t"}])
    codes = ["1.1.1", "1.2.1", "3.1.1", "17.1.1"]
    _put(root, "indicators/indicators.json", [{"code": c, "description": c} for c in codes])
    areas = [(4, "Afghanistan"), (36, "Australia"), (76, "Brazil")]
    _put(root, "areas/areas.json", [{"geoAreaCode": a, "geoAreaName": n} for a, n in areas + areas[:1]])
    for k, code in enumerate(codes):
        data = [{"geoAreaCode": a, "geoAreaName": n, "timePeriodStart": y, "value": str(a % 7 + (y - 2000) * (k + 1)),
                 "units": "%"} for a, n in areas for y in range(1998, 2011)]
        data.append({"geoAreaCode": 4, "geoAreaName": "Afghanistan", "timePeriodStart": 2005, "value": "<0.5"})
        _put(root, f"observations/{code}.json", {"totalElements": len(data), "data": data})
    countries = [{"id": i, "name": n, "iso2Code": i[:2], "region": {"value": r}, "incomeLevel": {"value": inc},
                  "capitalCity": "c", "longitude": "1.5", "latitude": "2.5"}
                 for i, n, r, inc in (("AFG", "Afghanistan", "South Asia", "Low income"),
                                      ("AUS", "Australia", "East Asia & Pacific", "High income"),
                                      ("WLD", "World", "", ""))]
    _put(root, "countries/page-1.json", [{"page": 1, "pages": 1}, countries])
    for code in ("NY.GDP.PCAP.CD", "SP.POP.TOTL", "SP.DYN.LE00.IN", "SE.ADT.LITR.ZS"):
        recs = [{"country": {"id": i, "value": n}, "date": str(y), "value": float(y - 1990)}
                for i, n in (("AFG", "Afghanistan"), ("AUS", "Australia")) for y in range(2000, 2011)]
        _put(root, f"series/{code}/page-1.json", [{"page": 1, "pages": 2, "per_page": 22, "total": 44}, recs])


def test_refresh_end_to_end(spark, tmp_path):
    root = str(tmp_path / "landing")
    _landing(root)
    out = scratch_path(spark, "refresh")
    res = refresh(spark, root, out, max_indicators=3, trees=5, depth=3)
    raw = res["raw"]
    assert raw["sdg_goals"].count() == 3 and raw["sdg_geo_areas"].count() == 4
    # first three indicators only (catalogue order), 3 areas x 13 years each + one unparsable value
    assert sorted(r[0] for r in raw["sdg_indicator_data"].select("indicator_code").distinct().collect()) == [
        "1.1.1", "1.2.1", "3.1.1"]
    assert raw["wb_countries"].count() == 2
    assert raw["wb_indicators"].select("indicator_name").distinct().count() == 4
    m = res["marts"]
    assert m["dim_countries"].count() == 3 and m["dim_time"].count() == 11
    assert {r.goal_category for r in m["dim_goals"].collect()} == {"People", "Peace & Partnership"}
    assert m["fact_sdg_progress"].count() == 3 * 2 * 11
    assert m["fact_economic_indicators"].count() == 2 * 11
    assert res["combined"].count() == m["fact_sdg_progress"].count()
    assert {r.status for r in res["exports"].collect()} == {"ok"}
    preds = spark.read.parquet(f"{out}/marts/ml_sdg_predictions")
    assert preds.count() == 3 * 2 and "predicted_at" in preds.columns
    assert res["quality"]["coverage"].first().years == 11
    assert res["importances"].count() == 15
    assert res["summary"].count() == 4
    # the area codes and the economic codes come from different code systems: no match, all zero
    assert res["features"].filter(F.col("gdp_per_capita").isNotNull()).count() == 0
    csv = spark.read.option("header", True).csv(f"{out}/exports/ml_sdg_predictions")
    assert csv.count() == 6 and len(csv.columns) == 11


def test_refresh_with_bucketed_facts(spark, tmp_path):
    root = str(tmp_path / "landing")
    _landing(root)
    out = scratch_path(spark, "refresh-bucketed")
    res = refresh(spark, root, out, max_indicators=3, trees=3, depth=2, database="indicators_b", fact_buckets=4)
    assert res["marts"]["fact_sdg_progress"].count() == 3 * 2 * 11
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED indicators_b.fact_sdg_progress").collect()}
    assert info.get("Num Buckets") == "4"
    assert res["combined"].count() == 3 * 2 * 11
    assert {r.status for r in res["exports"].collect()} == {"ok"}
