import math
import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.linalg import Vectors

from revlens.operators.extremes import key_extremes, key_list
from revlens.operators.metrics import auroc, rmse


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auroc_matches_brute_force_and_evaluator(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 30)), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = auroc(df, "score", "label").first()
    assert math.isclose(got["auroc"], _brute_auc(rows), abs_tol=1e-12)
    assert got["n_pos"] + got["n_neg"] == 400
    vec = spark.createDataFrame([(Vectors.dense([-s, s]), float(y)) for s, y in rows],
                                ["rawPrediction", "label"])
    lib = BinaryClassificationEvaluator(numBins=0).evaluate(vec)
    assert math.isclose(got["auroc"], lib, abs_tol=1e-9)


def test_auroc_hot_score_value(spark):
    rows = [(1.0, i % 2) for i in range(300)] + [(2.0, 1), (0.5, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert math.isclose(auroc(df, "score", "label").first()["auroc"], _brute_auc(rows))


def test_rmse_matches_evaluator_and_empty_is_null(spark):
    rows = [(1.0, 1.5), (2.0, 1.0), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "rating double, prediction double")
    got = rmse(df).first()
    lib = RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(df)
    assert math.isclose(got["rmse"], lib) and got["n"] == 3
    assert rmse(df.limit(0)).first()["rmse"] is None


def test_t9_t10_extremes_ties_and_overlap(spark):
    w = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 5.0)], "term string, weight double")
    ext = key_extremes(w, 2).orderBy("position").collect()
    assert [(r["side"], r["position"], r["term"]) for r in ext] == [
        ("low", 0, "a"), ("low", 1, "b"), ("high", 2, "b"), ("high", 3, "c")]
    assert key_list(key_extremes(w, 1)) == ["a", "c"]
    # fewer terms than n: every term on both sides
    assert key_list(key_extremes(w, 5)) == ["a", "b", "c", "a", "b", "c"]
