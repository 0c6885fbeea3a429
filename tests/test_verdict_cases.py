"""Cases that once gave wrong answers."""

import math

import pytest

from revlens.operators.catalog import match_items, match_personas
from revlens.operators.metrics import auroc
from revlens.operators.sampling import first_n, split_bounds
from revlens.plans.recommend import ALS_BLOCKS, als_estimator, prepare_catalog


def test_personas_match_as_single_favourites_do(spark):
    cat = spark.createDataFrame([(1, "Sugar Bowl"), (2, "sugar cane"), (3, "Salt")], "id int, name string")
    for pattern in ("Sugar Bowl", "Sugar%", "%BOWL", "S_lt", "%", "sugar", "Sugar Bowl and more%"):
        personas = spark.createDataFrame([("p", pattern)], "persona string, pattern string")
        want = sorted(r["id"] for r in match_items(cat, pattern).collect())
        assert sorted(r["id"] for r in match_personas(personas, cat).collect()) == want, pattern


def test_auroc_of_one_class_null_labels_and_many_rows(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1), (0.3, None)], "s double, y int")
    assert tuple(auroc(df, "s", "y").first()) == (None, 2, 0)
    both = df.unionByName(spark.createDataFrame([(0.15, 0)], "s double, y int"))
    assert tuple(auroc(both, "s", "y").first()) == (0.5, 2, 1)


def test_first_n_paths_agree_on_null_and_nan(spark):
    rows = [(None if i % 10 == 0 else math.nan if i % 7 == 0 else float(i), i) for i in range(50)]
    df = spark.createDataFrame(rows, "v double, id int")
    for n in (0, 8, 43, 50, 60):
        a = sorted(r["id"] for r in first_n(df, n, ["v", "id"]).collect())
        b = sorted(r["id"] for r in first_n(df, n, ["v", "id"], top_k_max=0).collect())
        assert a == b and len(a) == min(n, 50)


def test_strict_catalog_refuses_a_null_id(spark):
    df = spark.createDataFrame([("b", "n", "a", "p", "c"), (None, "n", "a", "p", "c")],
                               "business_id string, name string, address string, postal_code string, city string")
    assert prepare_catalog(df, "drop")[0].count() == 1
    with pytest.raises(Exception, match="no id for business_id"):
        prepare_catalog(df)[0].collect()


def test_blocks_do_not_follow_the_cluster():
    als = als_estimator()
    assert als.getNumUserBlocks() == als.getNumItemBlocks() == ALS_BLOCKS


def test_too_small_a_split_weight_is_refused():
    with pytest.raises(ValueError):
        split_bounds([0.99999, 0.00001])


def test_catalog_queries_leave_line_items_alone(spark, sf001, monkeypatch):
    from revlens.queries import relational

    def refused(*args, **kwargs):
        raise AssertionError("line items are read")

    monkeypatch.setattr(relational.tables, "reviews", refused)
    for key in ("item_ids", "catalog_projection", "drop_columns", "describe_items", "match_items_exact",
                "match_items_pattern", "match_items_wildcard", "match_count", "persona_matches",
                "unmatched_personas"):
        relational.QUERIES[key][0](spark, sf001).collect()
