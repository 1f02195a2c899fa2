"""Model steps: exact where they can be, sane ranges where fitting is involved."""

import math

import pytest
from conftest import DATA
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tallymart import schemas
from tallymart.operators import propensity
from tallymart.plans.catalog import QUERIES, lake_for
from tallymart.plans.lakehouse import Lakehouse
from tallymart.session import materialise


@pytest.fixture(scope="module")
def feats(spark):
    return materialise(spark, Lakehouse(spark, str(DATA)).behaviour, "features")


def test_impute_fills_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (math.nan,), (2.0,)], "x double")
    assert [r.x for r in propensity.impute(df, ["x"]).collect()] == [0.0, 0.0, 2.0]


def test_split_is_stable_and_complete(feats):
    train, test = propensity.split(feats)
    again, _ = propensity.split(feats.repartition(13))
    keys = lambda df: {tuple(r) for r in df.select(*propensity.KEYS).collect()}
    assert keys(train) == keys(again) and not keys(train) & keys(test)
    assert train.count() + test.count() == feats.count()
    assert 0.7 < train.count() / feats.count() < 0.9


def test_scaler_is_fitted_on_training_rows_only(feats):
    train, test = propensity.split(feats)
    _, scaler = propensity.prepare(train)
    _, everything = propensity.prepare(feats)
    assert list(scaler.stages[1].mean) != list(everything.stages[1].mean)
    reused, same = propensity.prepare(test, scaler)
    assert same is scaler and reused.columns == [*propensity.KEYS, "features", schemas.LABEL]


def test_training_scoring_and_metrics(spark, feats):
    train, test = propensity.split(feats)
    vectors, scaler = propensity.prepare(train)
    model = propensity.train(vectors)
    scored = materialise(spark, propensity.score(test, scaler, model), "scored")
    assert scored.filter("purchase_probability not between 0 and 1").count() == 0
    row = propensity.evaluate(scored).first()
    assert all(0 <= v <= 1 for v in row)
    counts = propensity.confusion(scored).first()
    assert sum(counts) == scored.count()
    for ours, metric in [("f1", "f1"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall"), ("accuracy", "accuracy")]:
        spark_value = MulticlassClassificationEvaluator(
            labelCol=schemas.LABEL, metricName=metric).evaluate(scored)
        assert row[ours] == pytest.approx(spark_value, abs=6e-5)
    weights = [abs(r.coefficient) for r in propensity.importance(spark, model).collect()]
    assert len(weights) == 12 and weights == sorted(weights, reverse=True)


def test_saved_models_score_alike(spark):
    row = QUERIES["ml_model_roundtrip"](lake_for(spark, str(DATA))).first()
    assert row.scored_rows == row.same_rows > 0


def test_batch_score_covers_the_last_day(spark, feats):
    out = QUERIES["ml_batch_score"](lake_for(spark, str(DATA)))
    last = feats.agg(F.max("prediction_date")).first()[0]
    assert {r[0] for r in out.select("campaign_date").distinct().collect()} == {last}
    assert out.count() == feats.filter(F.col("prediction_date") == F.lit(last)).count()
