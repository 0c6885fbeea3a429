import __spark_entry__ as entry


def test_entry_runs(spark, sf001):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["position", "business_id_numeric", "prediction", "description"]
    assert [r["position"] for r in rows] == list(range(1, 11))


def test_queries_and_oracles_share_keys():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
