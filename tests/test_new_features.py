"""Gram index, many personas, first n under a lookup, quarantine, counts within a time."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators import sampling
from revlens.operators.catalog import match_items, match_personas, report, unmatched_personas
from revlens.operators.joins import small_side
from revlens.operators.metrics import count_within
from revlens.operators.patterns import like_join
from revlens.operators.persona import ITEM, USER
from revlens.operators.sampling import first_n_joined
from revlens.operators.topk import top_items
from revlens.plans.recommend import prepare, recommend_personas
from revlens.sources import tables
from revlens.sources.jsonio import infer_json, scan_json

NAMES = ["Red Plate", "red plates", "RED_PLATE", "50% off", "a\\b", "", "x", "İce", "ice", "STRASSE", "straße", "red",
         "Blue Bolt", "bolt blue", "aXbXc", "a.b", "日本語 食堂", "l\nm", "plate red plate"]
PATTERNS = ["%plate", "%plate%", "red_plate", "%", "_", "__", "_%", "%_%_", "", "r%e", "%b%b%", "50\\%%", "a\\\\b", "%\\_%",
            "İ%", "%İ%", "i%", "%本%", "%zzz%", "___", "%ed%te%", "x%", "%x", "%%", "stra%e", "l_m", "%E", "Red Plate", None]


def pairs(df):
    return sorted((r["pattern"], r["name"]) for r in df.select("pattern", "name").collect())


def test_personas_match_as_like_does(spark):
    catalog = spark.createDataFrame([(i, n) for i, n in enumerate([*NAMES, None])], "id int, name string")
    personas = spark.createDataFrame([(str(i), p) for i, p in enumerate(PATTERNS)], "persona string, pattern string")
    want = sorted((p, r["name"]) for p in PATTERNS if p is not None for r in match_items(catalog, p).collect())
    assert pairs(match_personas(personas, catalog)) == want
    missed = {r["pattern"] for r in unmatched_personas(personas, catalog).collect()}
    assert missed == set(PATTERNS) - {p for p, _ in want}
    every = personas.where("pattern IS NOT NULL").join(catalog, F.expr("lower(name) LIKE lower(pattern)"))
    assert pairs(like_join(personas, catalog, "pattern", "name")) == pairs(every)


def test_lowering_that_changes_the_length(spark):
    catalog = spark.createDataFrame([(1, "ice"), (2, "İce")], "id int, name string")
    one = spark.createDataFrame([("p", "İ%")], "persona string, pattern string")
    assert [r["id"] for r in match_personas(one, catalog).collect()] == [2]


def test_random_patterns_without_a_nested_loop(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("abcx ") for _ in range(rng.randrange(0, 9))) for _ in range(200)]
    some = sorted({"".join(rng.choice("abx%_") for _ in range(rng.randrange(1, 7))) for _ in range(200)})
    catalog = spark.createDataFrame([(n,) for n in names], "name string")
    personas = spark.createDataFrame([(p,) for p in some], "pattern string")
    found = like_join(personas, catalog, "pattern", "name")
    every = personas.join(catalog, F.expr("name LIKE pattern"))
    assert pairs(found) == pairs(every)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("blocks", [(1, 1), (2, 5), (100, 100)])
def test_top_items_against_numpy(spark, blocks):
    rng = np.random.default_rng(4)
    users = {i: rng.integers(-3, 4, 5).astype(float).tolist() for i in range(7)}
    items = {i * 3: rng.integers(-3, 4, 5).astype(float).tolist() for i in range(23)}   # whole numbers: many ties
    out = {(u, i) for u in users for i in items if rng.random() < 0.3} | {(0, i) for i in items} | {(1, 3), (99, 3), (2, 1000)}
    frames = [spark.createDataFrame(list(f.items()), "id int, features array<float>") for f in (users, items)]
    excluded = spark.createDataFrame([*out, (1, 3)], "user int, item int")
    got = [tuple(r) for r in top_items(*frames, excluded, 4, *blocks).orderBy("user", "rank").collect()]
    want = []
    for u, f in users.items():
        best = sorted((-float(np.dot(f, v)), i) for i, v in items.items() if (u, i) not in out)[:4]
        want += [(u, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == want


def test_personas_of_one_fit(spark, sf001):
    prep = prepare(tables.catalog(spark, sf001), tables.reviews(spark, sf001))
    personas = spark.createDataFrame([("r", "red%"), ("r", "%plate"), ("b", "Blue%"), ("none", "zzz")],
                                     "persona string, pattern string")
    rec = recommend_personas(prep, personas, n=5, rank=4, max_iter=2, reg_param=0.1)
    users = {r["persona"]: r[USER] for r in rec.users.collect()}
    top_user = prep.ratings.agg(F.max(USER)).first()[0]
    assert users == {"b": top_user + 1, "r": top_user + 2}
    fav = {(r["persona"], r[ITEM]) for r in rec.favourites.collect()}
    by_hand = {("r", r[ITEM]) for p in ("red%", "%plate") for r in match_items(prep.catalog, p).collect()}
    assert {f for f in fav if f[0] == "r"} == by_hand
    u = {r["id"]: np.array(r["features"]) for r in rec.model.userFactors.collect()}
    v = {r["id"]: np.array(r["features"]) for r in rec.model.itemFactors.collect()}
    rated = {r[ITEM] for r in prep.ratings.select(ITEM).distinct().collect()}
    told = {(r["persona"], r["position"]): (r[ITEM], r["description"]) for r in rec.report.collect()}
    for p, k in users.items():
        best = sorted((-float(u[k] @ v[i]), i) for i in rated if (p, i) not in fav)[:5]
        got = [r for r in rec.top.where(F.col("persona") == p).orderBy("rank").collect()]
        assert [r["prediction"] for r in got] == pytest.approx([-s for s, _ in best], abs=1e-5)
        assert all(told[p, r["rank"]][0] == r[ITEM] and told[p, r["rank"]][1] for r in got)
    with pytest.raises(KeyError):
        recommend_personas(prep, personas.where("persona = 'none'"))


def test_first_n_under_a_lookup(spark):
    rng = random.Random(1)
    facts = spark.createDataFrame([(i, rng.choice([*range(40), None]), f"x{i}") for i in range(300)], "o int, k int, x string")
    for kept in (40, 3, 0):
        lookup = spark.createDataFrame([(k, f"v{k}") for k in range(kept)], "k int, v string")
        want = [tuple(r) for r in facts.join(lookup, "k").orderBy("o").limit(25).collect()]
        assert [tuple(r) for r in first_n_joined(facts, lookup, "k", 25, ["o"]).orderBy("o").collect()] == want
    assert first_n_joined(facts, lookup, "k", 0, ["o"]).count() == 0


def test_first_n_joins_only_what_it_took(spark, sf001, monkeypatch):
    """The join under the limit sees the rows taken, not the line items."""
    seen = []
    monkeypatch.setattr(sampling, "small_side", lambda df, rows: seen.append((rows, df.inputFiles())) or small_side(df, rows))
    items, orders = tables.review_parts(spark, sf001)
    assert first_n_joined(items, orders, "l_orderkey", 100, tables.REVIEW_ORDER).count() == 100
    assert [rows for rows, _ in seen] == [100] and not any("lineitem" in f for _, fs in seen for f in fs)


def test_review_view_runs_once(spark):
    """Counted over all jobs of ``prepare`` by a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def user(i):
        calls.add(1)
        return f"U{i % 9}"

    business = spark.createDataFrame([(f"B{i}", "n", "a", "p", "c") for i in range(5)],
                                     "business_id string, name string, address string, postal_code string, city string")
    reviews = spark.range(200).repartition(3).select(F.udf(user)("id").alias("user_id"),
                                                     F.concat(F.lit("B"), F.col("id") % 5).alias("business_id"),
                                                     F.lit(4.0).alias("stars"))
    prep = prepare(business, reviews)
    assert prep.ratings.count() == 200 and prep.user_ids.count() == 9
    assert calls.value == 200


def test_scan_without_a_schema(spark, tmp_path):
    lines = ['{"id": 1, "name": "a", "size": 2}', '{"id": 2, "name": "b"}', '{"id": 3, "name": ', "", "not json", "[1, 2]x",
             '{"id": 4, "size": 2.5, "late": true}', '{"name": "é\\n"}']
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(lines[:3]) + "\n")
    (folder / "b.json").write_text("\n".join(lines[3:]) + "\n")
    assert infer_json(spark, str(folder)).simpleString() == "struct<id:bigint,late:boolean,name:string,size:double>"
    read = scan_json(spark, str(folder))
    assert sorted(map(tuple, read.rows.collect()), key=repr) == sorted(
        [(1, None, "a", 2.0), (2, None, "b", None), (4, True, None, 2.5), (None, None, "é\n", None)], key=repr)
    assert sorted(r["line"] for r in read.bad.collect()) == sorted([lines[2], lines[4], lines[5]])
    typed = scan_json(spark, str(folder), infer_json(spark, str(folder / "a.json")))
    assert lines[6] in {r["line"] for r in typed.bad.collect()}      # 2.5 is no bigint
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        scan_json(spark, str(folder), strict=True).rows.collect()
    (folder / "b.json").unlink()
    (folder / "a.json").write_text(lines[0] + "\n")
    assert scan_json(spark, str(folder), strict=True).rows.count() == 1


def test_report_broadcasts_small_tops_only(spark):
    catalog = spark.range(2000).select(F.col("id").cast("int").alias(ITEM), F.lit("n").alias("name"))
    top = spark.range(5).select((F.col("id") + 1).alias("rank"), F.col("id").cast("int").alias(ITEM), F.lit(1.0).alias("prediction"))

    def hinted(rows):
        return "strategy=broadcast" in report(top, catalog, rows=rows)._jdf.queryExecution().logical().toString()

    assert hinted(10) and not hinted(10_000_000) and not hinted(None)


def test_count_within_a_time(spark):
    df = spark.range(0, 10_000, 1, 20)
    whole = count_within(df, 60_000)
    assert (whole.mean, whole.low, whole.high, whole.exact) == (10_000, 10_000, 10_000, True)
    slow = spark.range(0, 400, 1, 40).where("java_method('java.lang.Thread', 'sleep', 10L) IS NULL OR id >= 0")
    part = count_within(slow, 300, 0.9)
    assert part.low <= part.mean <= part.high and part.low <= 400 <= part.high
    assert part.exact == (part.low == part.high == 400)
    for bad in ((1, 0.0), (1, 1.0), (-1, 0.5)):
        with pytest.raises(ValueError):
            count_within(df, *bad)
