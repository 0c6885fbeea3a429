import pytest
from pyspark.sql import functions as F

from revlens.operators.ids import _as_int_id, dense_ids, encode, key_counts, number_keys, orphans
from revlens.operators.indexing import prefix_sums, row_index
from revlens.operators.skew import SkewSpec, hot_keys, salted_join


def test_dense_ids_sorted_and_stable_under_repartition(spark):
    keys = [f"U{i}" for i in range(57)] * 3 + [None]
    df = spark.createDataFrame([(k,) for k in keys], "user_id string")
    expected = {k: i for i, k in enumerate(sorted(set(k for k in keys if k)))}
    for parts in (1, 2, 8):
        got = {r["user_id"]: r["uid"] for r in
               dense_ids(df.repartition(parts), "user_id", "uid").collect()}
        assert got == expected


def test_row_index_matches_sort(spark):
    import random
    rnd = random.Random(7)
    vals = [(rnd.randint(0, 10_000), i) for i in range(3000)]
    df = spark.createDataFrame(vals, "v int, k int").repartition(5)
    got = sorted((r["idx"], r["v"], r["k"]) for r in row_index(df, ["v", "k"], "idx", 6).collect())
    exp = [(i, v, k) for i, (v, k) in enumerate(sorted(vals))]
    assert got == exp


def test_prefix_sums_match_brute_force(spark):
    vals = [(i * 3 % 101, i % 7) for i in range(101)]
    df = spark.createDataFrame(vals, "s int, x long")
    out = {r["s"]: r["before_x"] for r in prefix_sums(df, ["s"], ["x"], num_partitions=4).collect()}
    running = 0
    for s, x in sorted(vals):
        assert out[s] == running
        running += x


def test_t7_orphan_strict_drop_and_frame(spark):
    ids = spark.createDataFrame([("B1", 0), ("B2", 1)], "business_id string, bid int")
    facts = spark.createDataFrame([("U1", "B1"), ("U1", "B9"), ("U2", None)],
                                  "user_id string, business_id string")
    with pytest.raises(Exception, match="no id for business_id"):
        encode(facts, ids, "business_id", "bid").collect()
    kept = encode(facts, ids, "business_id", "bid", on_missing="drop").collect()
    assert [(r["business_id"], r["bid"]) for r in kept] == [("B1", 0)]
    orph = sorted(str(r["business_id"]) for r in orphans(facts, ids, "business_id").collect())
    assert orph == ["B9", "None"]


def test_t8_null_user_is_not_numbered(spark):
    df = spark.createDataFrame([("U1",), (None,)], "user_id string")
    assert [r["user_id"] for r in dense_ids(df, "user_id", "uid").collect()] == ["U1"]
    with pytest.raises(Exception, match="no id for user_id"):
        encode(df, dense_ids(df, "user_id", "uid"), "user_id", "uid").collect()


def test_t13_big_id_is_a_clear_error(spark):
    df = spark.createDataFrame([(2**31,)], "i long")
    with pytest.raises(Exception, match="do not fit"):
        df.select(_as_int_id(F.col("i"), "users")).collect()


def test_salted_join_equals_plain_join(spark):
    rows = [("hot", i % 5) for i in range(400)] + [(f"k{i}", i) for i in range(50)] + [("miss", 1)]
    facts = spark.createDataFrame(rows, "key string, v int")
    table = spark.createDataFrame([("hot", 100)] + [(f"k{i}", i) for i in range(50)],
                                  "key string, id int")
    freq = key_counts(facts, "key")
    spec = SkewSpec(min_rows=100, rows_per_salt=50)
    hot = hot_keys(freq, "key", "n_rows", spec)
    hot_rows = hot.collect()
    assert [r["key"] for r in hot_rows] == ["hot"] and hot_rows[0]["_rl_salts"] == 8
    for how in ("inner", "left"):
        a = sorted(tuple(r) for r in salted_join(facts, table, "key", hot, how)
                   .select("key", "v", "id").collect())
        b = sorted(tuple(r) for r in facts.join(table, "key", how).select("key", "v", "id").collect())
        assert a == b


def test_number_keys_keeps_columns(spark):
    df = spark.createDataFrame([("b", 2), ("a", 5)], "k string, n long")
    rows = number_keys(df, "k", "id").orderBy("id").collect()
    assert [(r["k"], r["n"], r["id"]) for r in rows] == [("a", 5, 0), ("b", 2, 1)]


def test_key_frequencies_one_scan(spark):
    from revlens.operators.ids import key_frequencies
    df = spark.createDataFrame([("u1", "b1"), ("u1", "b2"), (None, "b1"), ("u2", None)],
                               "user_id string, business_id string")
    f = key_frequencies(df, ["user_id", "business_id"])
    assert sorted(tuple(r) for r in f["user_id"].collect()) == [("u1", 2), ("u2", 1)]
    assert sorted(tuple(r) for r in f["business_id"].collect()) == [("b1", 2), ("b2", 1)]
