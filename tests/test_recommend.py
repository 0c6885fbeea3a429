import random

import pytest
from pyspark.sql import functions as F

from revlens.operators.persona import ITEM, USER
from revlens.plans.recommend import (Prepared, als_estimator, fit, prepare, recommend,
                                     top_n, top_n_per_group)
from revlens.plans.tune import als_grid_search
from revlens.sources import tables


def _planted(spark, n_users=40, n_items=30, seed=5):
    """Two user blocks: block A loves items 0-14, block B loves 15-29."""
    rnd = random.Random(seed)
    biz, revs = [], []
    for i in range(n_items):
        biz.append((f"B{i:02d}", ("sugar bowl" if i in (0, 1) else f"item {i}"), "a", "p", "c"))
    for u in range(n_users):
        block = u < n_users // 2
        for i in range(n_items):
            if rnd.random() < 0.7:
                likes = (i < n_items // 2) == block
                revs.append((f"U{u:02d}", f"B{i:02d}", 5.0 if likes else 1.0))
    b = spark.createDataFrame(biz, "business_id string, name string, address string, "
                                   "postal_code string, city string")
    r = spark.createDataFrame(revs, "user_id string, business_id string, stars double")
    return b, r


def test_t15_planted_blocks_and_no_favourites(spark):
    b, r = _planted(spark)
    prep = prepare(b, r)
    rec = recommend(prep, "sugar bowl", n=5, rank=4, max_iter=10, reg_param=0.05)
    top = rec.top.orderBy("rank").collect()
    fav = {r[ITEM] for r in rec.favourites.collect()}
    assert len(top) == 5
    assert not fav & {r[ITEM] for r in top}
    # favourites (items 0, 1) are in block A: recommendations come from items 2-14
    assert all(r[ITEM] < 15 for r in top)
    preds = [r["prediction"] for r in top]
    assert preds == sorted(preds, reverse=True)
    rep = rec.report.orderBy("position").collect()
    assert [r[ITEM] for r in rep] == [r[ITEM] for r in top]


def test_t17_calls_do_not_affect_each_other(spark):
    b, r = _planted(spark)
    prep = prepare(b, r)
    before = prep.ratings.count()
    a1 = recommend(prep, "item 20", n=3, rank=3, max_iter=5).top.collect()
    assert prep.ratings.count() == before
    b_after = [tuple(x) for x in recommend(prep, "sugar bowl", n=3, rank=3, max_iter=5).top.collect()]
    b_alone = [tuple(x) for x in recommend(prepare(b, r), "sugar bowl", n=3, rank=3, max_iter=5).top.collect()]
    assert a1 and b_after == b_alone


def test_t11_cold_start_drops_unseen(spark):
    b, r = _planted(spark, n_users=10, n_items=10)
    prep = prepare(b, r)
    model = fit(als_estimator(rank=2, max_iter=3), prep.ratings)
    pairs = spark.createDataFrame([(0, 0), (999, 0), (0, 999)], f"{USER} int, {ITEM} int")
    out = [(r[USER], r[ITEM]) for r in model.transform(pairs).collect()]
    assert out == [(0, 0)]


def test_t12_empty_validation_gives_null_rmse(spark):
    # one rating per user: validation users never appear in train, so every
    # validation row is cold and no cell gets an RMSE
    rows = [(u, u % 5, 3.0) for u in range(300)]
    ratings = spark.createDataFrame(rows, f"{USER} int, {ITEM} int, rating double")
    with pytest.raises(ValueError, match="no grid cell"):
        als_grid_search(ratings, [2], [0.1], 2)


def test_grid_search_picks_lowest(spark):
    b, r = _planted(spark)
    prep = prepare(b, r)
    res = als_grid_search(prep.ratings, [2, 4], [0.05, 1.0], 5)
    rows = res.results.orderBy("grid_pos").collect()
    assert len(rows) == 4 and sum(x["is_best"] for x in rows) == 1
    best = min((x["rmse"], x["grid_pos"]) for x in rows if x["rmse"] is not None)
    assert [x["grid_pos"] for x in rows if x["is_best"]] == [best[1]]
    assert res.test_rmse is not None and res.n_test > 0


def test_top_n_ties_by_item(spark):
    s = spark.createDataFrame([(5, 1.0), (3, 1.0), (4, 2.0)], f"{ITEM} int, prediction float")
    assert [r[ITEM] for r in top_n(s, 2).orderBy("rank").collect()] == [4, 3]


def test_top_n_per_group_hot_group(spark):
    rows = [(0, i, float(i % 97)) for i in range(2000)] + [(1, i, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "u int, i int, s double")
    got = top_n_per_group(df, "u", [F.col("s").desc(), F.col("i").asc()], 3).collect()
    by_u = {}
    for r in sorted(got, key=lambda r: (r["u"], r["rank"])):
        by_u.setdefault(r["u"], []).append(r["i"])
    assert by_u[1] == [4, 3, 2]
    assert by_u[0] == [96, 193, 290]


def test_prepare_on_tables(spark, sf001):
    prep = prepare(tables.catalog(spark, sf001), tables.reviews(spark, sf001))
    assert prep.ratings.count() == 6000
    assert prep.catalog.count() == 200
    assert prep.ratings.schema[USER].dataType.simpleString() == "int"


def test_score_user_equals_transform_and_avoids_nested_loop(spark):
    from revlens.plans.recommend import score_user
    b, r = _planted(spark, n_users=12, n_items=12)
    prep = prepare(b, r)
    model = fit(als_estimator(rank=3, max_iter=4), prep.ratings)
    pairs = prep.ratings.select(ITEM).distinct().select(F.lit(2).alias(USER), ITEM)
    ours = {x[ITEM]: x["prediction"] for x in score_user(model, 2, pairs).collect()}
    lib = {x[ITEM]: x["prediction"] for x in model.transform(pairs).collect()}
    assert ours.keys() == lib.keys()
    assert all(abs(ours[k] - lib[k]) < 1e-4 for k in ours)
    plan = score_user(model, 2, pairs)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    assert score_user(model, 999, pairs).count() == 0


def test_prepare_salts_only_hot_keys(spark):
    from revlens.operators.skew import SkewSpec
    b, r = _planted(spark, n_users=10, n_items=10)
    plain = prepare(b, r, materialize=False)
    assert "_rl_salt" not in plain.ratings._jdf.queryExecution().executedPlan().toString()
    salted = prepare(b, r, materialize=False, skew=SkewSpec(min_rows=3, rows_per_salt=3))
    assert "_rl_salt" in salted.ratings._jdf.queryExecution().executedPlan().toString()
    key = lambda df: sorted(tuple(x) for x in df.collect())
    assert key(plain.ratings) == key(salted.ratings)


def test_als_blocks_follow_the_ratings(spark, monkeypatch):
    from revlens.plans import recommend as plan

    ratings = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(20) for i in range(9)],
                                    f"{USER} int, {ITEM} int, rating double")
    est = als_estimator(rank=2, max_iter=2)
    assert plan.blocks_for(ratings) == 10 and not est.isSet(est.numUserBlocks)
    monkeypatch.setattr(plan, "BLOCK_RATINGS", 14)
    assert plan.blocks_for(ratings) == 13 and plan.blocks_for(ratings.limit(0)) == 10
    factors = lambda m: sorted((r["id"], list(r["features"])) for r in m.userFactors.collect())
    derived, given = fit(est, ratings), fit(als_estimator(rank=2, max_iter=2, num_blocks=13), ratings)
    assert factors(derived) == factors(given)
    assert not est.isSet(est.numUserBlocks)  # the caller's estimator stays as it was
    # the same model for other partitions of the same rows, up to the order of sums
    other = factors(fit(est, ratings.repartition(5, ITEM)))
    assert all(a == b and x == pytest.approx(y, abs=1e-3) for (a, x), (b, y) in zip(factors(derived), other))
