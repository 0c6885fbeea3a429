"""What the review queries move and how many tasks share it, as the tables grow."""

from pyspark.sql import functions as F

import revlens.plans.recommend as plan
from revlens.operators.persona import USER
from revlens.queries import models
from revlens.sources import tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_stay_one_wave_at_size(spark):
    """216 M ratings: a round sends a factor to 11 blocks at most, not to 22."""
    assert plan.blocks_for(spark.range(216_000_000)) == 11
    assert plan.blocks_for(spark.range(36_000_000)) == plan.ALS_BLOCKS


def test_scores_of_one_user_are_not_dealt_by_user(spark, sf001):
    prep = plan.prepare(tables.catalog(spark, sf001), tables.reviews(spark, sf001))
    rec = plan.recommend(prep, "red plate", n=5, rank=2, max_iter=1, reg_param=0.1)
    want = plan.factor_scores(rec.model, rec.candidates)
    got = plan.factor_scores(rec.model, rec.candidates, rec.persona_id)
    assert f"hashpartitioning({USER}" not in _plan(got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the candidates and the list are read by several results, made once
    assert rec.candidates.inputFiles() and rec.top.inputFiles()


def test_personas_names_and_items_in_pieces(spark, sf001, monkeypatch):
    monkeypatch.setattr(plan, "CATALOG_ROWS", 50)
    written, real = {}, plan.write_table

    def spy(df, name):
        written[name] = df.rdd.getNumPartitions() if name == "catalog" else None
        return real(df, name)

    monkeypatch.setattr(plan, "write_table", spy)
    monkeypatch.setattr(models, "ITEM_PIECE", 50)
    models.release_fits()
    try:
        out = models.recommend_personas_q(spark, sf001)
        assert written["catalog"] == 4 and {"patterns", "items"} <= set(written)
        assert "piece#" in _plan(out)
        flags = out.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_rated_item") & ~F.col("is_favourite")
                        & F.col("order_ok") & F.col("beats_rest")).alias("ok")).first()
        assert flags["n"] == flags["ok"] > 0
    finally:
        models.release_fits()


def test_grid_fits_two_cells_at_a_time(spark, sf001, monkeypatch):
    asked, real = {}, models.als_grid_search

    def spy(*args, **kwargs):
        asked.update(kwargs)
        return real(*args, **kwargs)

    monkeypatch.setattr(models, "als_grid_search", spy)
    assert models.als_grid(spark, sf001).where("best_ok AND rmse_ok").count() == 4
    assert asked["parallelism"] == 2
