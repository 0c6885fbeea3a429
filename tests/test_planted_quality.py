"""Model quality on planted structure (the INV queries prove structure only)."""

from pyspark.sql import functions as F

from revlens.operators.metrics import rmse_value
from revlens.operators.persona import ITEM, USER
from revlens.plans.recommend import prepare
from revlens.plans.sentiment import sentiment
from revlens.plans.tune import als_grid_search, split_ratings
from tests.test_recommend import _planted as planted_ratings
from tests.test_sentiment import _planted as planted_reviews


def test_t15_held_out_rmse_beats_global_mean(spark):
    b, r = planted_ratings(spark, n_users=60, n_items=40)
    prep = prepare(b, r)
    res = als_grid_search(prep.ratings, [2, 4], [0.05], 10)
    train, _, test = split_ratings(prep.ratings)
    mean = train.agg(F.avg("rating")).scalar()
    base, _ = rmse_value(test.withColumn("prediction", mean))
    assert res.test_rmse < 0.5 * base


def test_t16_gluing_raises_auroc(spark):
    docs = planted_reviews(spark)
    glued = sentiment(docs, key_max_iter=30, max_iter=30, per_side=3, reg_grid=(0.1,))
    plain = sentiment(docs, key_max_iter=30, max_iter=30, per_side=0, reg_grid=(0.1,))
    assert plain.keys.keys == []
    assert glued.auroc > plain.auroc + 0.2
