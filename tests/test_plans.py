"""Physical-plan checks: no Python evaluation, top-n planned as top-k,
pruned scans."""

from revlens.plans.recommend import prepare
from revlens.queries import registry, relational, text
from revlens.operators.catalog import match_items
from revlens.sources import tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_relational_and_text_plans(spark, sf001):
    for mod in (relational, text):
        for key, (fn, _) in mod.QUERIES.items():
            if key in ("json_roundtrip", "json_quarantine", "debug_subset_written", "debug_subset_businesses"):
                continue
            plan = _plan(fn(spark, sf001))
            assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_top_n_is_take_ordered(spark, sf001):
    from revlens.plans.recommend import top_n
    prep = prepare(tables.catalog(spark, sf001), tables.reviews(spark, sf001))
    scored = prep.ratings.withColumnRenamed("rating", "prediction")
    assert "TakeOrderedAndProject" in _plan(top_n(scored, 5).drop("rank"))


def test_scan_is_pruned_and_filter_pushed(spark, sf001):
    plan = _plan(match_items(tables.catalog(spark, sf001), "red plate"))
    assert "p_retailprice" not in plan.split("ReadSchema")[1].split("\n")[0]
    plan = _plan(tables.reviews(spark, sf001))
    assert "IsNotNull(l_orderkey)" in plan and "IsNotNull(o_orderkey)" in plan
    read = [line.split("ReadSchema: ")[1] for line in plan.split("\n") if "ReadSchema" in line]
    assert any("l_quantity" in r for r in read) and not any("l_tax" in r or "o_comment" in r for r in read)


def test_term_frequency_scans_and_tokenises_once(spark, sf001):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("4", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            df = text.QUERIES["term_frequency"][0](spark, sf001)
            df.collect()
            plan = _plan(df).split("Initial Plan")[0]
            assert plan.count("FileScan parquet") == 1 and plan.count("regexp_extract_all") <= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_persona_scoring_has_no_cartesian(spark, sf001):
    from revlens.queries import models

    plan = _plan(models.QUERIES["als_score_identity"][0](spark, sf001))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_every_query_has_an_oracle_or_is_listed(spark):
    reg = registry()
    assert len(reg) >= 45
    assert all(sql for _, sql in reg.values())


def test_no_cartesian_and_no_nested_loops(spark, sf001):
    for mod in (relational, text):
        for key, (fn, _) in mod.QUERIES.items():
            if key in ("json_roundtrip", "json_quarantine", "debug_subset_written", "debug_subset_businesses"):
                continue
            plan = _plan(fn(spark, sf001))
            assert "CartesianProduct" not in plan, key
            assert "NestedLoopJoin" not in plan, key


def test_exact_personas_use_hash_join(spark, sf001):
    from revlens.operators.catalog import match_personas
    personas = spark.createDataFrame([("a", "red plate"), ("b", "blue bolt")],
                                     "persona string, pattern string")
    cat = prepare(tables.catalog(spark, sf001), tables.reviews(spark, sf001),
                  materialize=False).catalog
    df = match_personas(personas, cat)
    plan = _plan(df)
    assert df.count() > 0
    assert "HashJoin" in plan or "SortMergeJoin" in plan
