import pytest

from revlens.operators.catalog import (describe, match_items, match_personas, report,
                                       require_match, unmatched_personas)

NAMES = [(0, "Sugar Bowl", "1 Main", "111", "A"),
         (1, "sugar bowl cafe", "2 Main", "222", "B"),
         (2, "SUGAR_BOWL", None, "333", "C")]
SCHEMA = "business_id_numeric int, name string, address string, postal_code string, city string"


@pytest.fixture
def cat(spark):
    return spark.createDataFrame(NAMES, SCHEMA)


def _ids(df):
    return sorted(r["business_id_numeric"] for r in df.collect())


def test_t5_like_semantics(cat):
    assert _ids(match_items(cat, "sugar bowl")) == [0]
    assert _ids(match_items(cat, "sugar bowl%")) == [0, 1]
    assert _ids(match_items(cat, "sugar_bowl")) == [0, 2]
    assert _ids(match_items(cat, "sugar_bowl", literal=True)) == [2]
    assert _ids(match_items(cat, "SUGAR BOWL")) == [0]


def test_t6_no_match_raises_and_is_listed(spark, cat):
    with pytest.raises(KeyError):
        require_match(match_items(cat, "nowhere"), "nowhere")
    personas = spark.createDataFrame(
        [("p1", "sugar%"), ("p2", "nowhere"), ("p3", "sugar bowl"), ("p4", "sugar_bowl")],
        "persona string, pattern string")
    assert [r["persona"] for r in unmatched_personas(personas, cat).collect()] == ["p2"]
    pairs = match_personas(personas, cat).select("persona", "business_id_numeric").collect()
    assert sorted((r[0], r[1]) for r in pairs) == [
        ("p1", 0), ("p1", 1), ("p1", 2), ("p3", 0), ("p4", 0), ("p4", 2)]


def test_t8_null_field_prints_none(cat):
    d = {r["business_id_numeric"]: r["description"] for r in describe(cat).collect()}
    assert d[2] == "SUGAR_BOWL, None, 333, C"


def test_report_keeps_prediction_order(spark, cat):
    top = spark.createDataFrame([(1, 2, 4.5), (2, 0, 4.0)],
                                "rank int, business_id_numeric int, prediction float")
    rows = report(top, cat).orderBy("position").collect()
    assert [r["business_id_numeric"] for r in rows] == [2, 0]
    assert rows[0]["description"].startswith("SUGAR_BOWL")
