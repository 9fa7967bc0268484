"""The forest queries: the production model, and its real results."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF01
from strata.functions.classify import band
from strata.operators.predict import CATEGORY_EDGES, CATEGORY_LABELS
from strata.plans import marts, registry


@pytest.fixture(scope="module")
def trained(spark):
    model, scored, acc, imp = registry._scored(spark, SF01)
    return model, scored.cache(), acc, imp


@pytest.fixture(scope="module")
def run(spark, trained):
    """The registered queries over the one trained model."""
    saved, registry._scored = registry._scored, lambda spark, sf: trained
    yield lambda name: entry.queries()[name](spark, SF01)
    registry._scored = saved


def test_production_parameters(trained):
    model = trained[0]
    assert model.getNumTrees == 100 and model.getMaxDepth() == 10 and model.getSeed() == 42


def test_predictions_are_the_mean_of_the_trees(run, trained):
    model, scored, _, _ = trained
    rows = run("forest_predictions").withColumn(
        "band", F.coalesce(band("prediction_2030_probability", CATEGORY_EDGES, CATEGORY_LABELS), F.lit("nan"))).collect()
    assert len(rows) == scored.count()
    got = {(str(r.country_code), r.goal_code): r for r in rows}
    for r in scored.select("country_code", "goal_code", "features").limit(25).collect():
        mean = sum(t.predictProbability(r.features)[1] for t in model.trees) / 100
        out = got[str(r.country_code), r.goal_code]
        assert abs(out.prediction_2030_probability - mean) < 1e-4
        if abs(mean - 0.5) > 1e-4:
            assert out.prediction_2030_on_track == int(mean >= 0.5)
    edges = [r for r in rows if min(abs(r.prediction_2030_probability - e) for e in CATEGORY_EDGES) > 1e-4]
    assert edges and all(r.prediction_category == r.band for r in edges)
    assert len({r.prediction_2030_probability for r in rows}) > 10


def test_accuracy_is_that_of_the_held_out_rows(run, trained):
    held = trained[1].where("is_test").select("label", "prediction").collect()
    want = sum(r.label == r.prediction for r in held) / len(held)
    got = run("forest_accuracy_share").first()
    assert got.test_rows == len(held) and abs(got.accuracy - want) < 1e-4


def test_importances(run):
    rows = run("forest_importances").collect()
    values = [r.importance for r in rows]
    assert {r.feature for r in rows} == set(marts.model_features()) and len(rows) == len(marts.model_features())
    assert values == sorted(values, reverse=True) and abs(sum(values) - 1) < 0.01 and values[0] > 0


def test_training_rows_are_dealt_out_by_their_number(spark, monkeypatch):
    from strata.operators import predict
    seen = []

    class Forest:
        def __init__(self, **_):
            pass

        def fit(self, train):
            seen.append(train)

    monkeypatch.setattr(predict, "RandomForestClassifier", Forest)
    few, many = (spark.range(0, n, 1, 1).selectExpr("id AS features", "id % 2 AS label", "'x' AS name")
                 for n in (50, predict.TASK_ROWS * 3 - 5))
    predict.fit_forest(few, "label")
    predict.fit_forest(many, "label")
    assert [train.rdd.getNumPartitions() for train in seen] == [1, 3]
    assert seen[1].selectExpr("sum(features)", "count(*)").first() == many.selectExpr("sum(features)", "count(*)").first()
