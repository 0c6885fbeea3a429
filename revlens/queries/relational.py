"""Relational queries: sources/sinks, projections, filters, joins,
aggregations, splits and subsets (survey sections 2.1-2.9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.catalog import (describe, items_in_set, match_items,
                                       match_personas, unmatched_personas)
from revlens.operators.ids import encode, key_counts, number_keys, orphans
from revlens.operators.metrics import auroc, rmse
from revlens.operators.persona import (ITEM, USER, candidates, persona_ratings,
                                       with_persona)
from revlens.operators.sampling import label_split
from revlens.plans.recommend import Prepared, prepare, prepare_catalog, top_n_per_group
from revlens.plans.sentiment import label_reviews
from revlens.plans.subset import subset_items, subset_ratings_joined, write_sample
from revlens.queries.sql import BASE, TEXT, bucket
from revlens.session import scratch_path
from revlens.sources import tables
from revlens.sources.jsonio import read_json, scan_json, write_json
from revlens.sources.schemas import BUSINESS_SCHEMA

FAVOURITE = "red plate"
SUBSET_N = 1000


def _prep(spark: SparkSession, sf: str, materialize: bool = False) -> Prepared:
    """Prepared tables; lazy by default, as most queries read them once."""
    return prepare(tables.catalog(spark, sf), tables.reviews(spark, sf),
                   materialize=materialize)


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The prepared catalog, from the part table alone."""
    return prepare_catalog(tables.catalog(spark, sf))[0]


def _r(x, digits: int = 6):
    return F.round(x, digits)


# -- sources and sinks --------------------------------------------------------

def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json-roundtrip")
    write_json(tables.catalog(spark, sf), path, mode=None)
    return read_json(spark, path, BUSINESS_SCHEMA)


def _subset_written(spark, sf):
    out = scratch_path(spark, "debug-subset")
    return write_sample(debug_subset_ratings(spark, sf), tables.catalog(spark, sf), f"{out}/ratings", f"{out}/businesses")


def json_quarantine(spark, sf):
    """Catalog rows as JSON lines, every third one cut short, read back without
    a schema: the whole lines by their inferred columns, the others as they stand."""
    path = scratch_path(spark, "json-lines")
    part = tables.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                                           F.col("p_size").alias("size"))).alias("line"))
    cut = F.when(F.pmod("id", F.lit(3)) == 0, F.substring("line", F.lit(1), F.length("line") - 1)).otherwise(F.col("line"))
    part.select(cut.alias("value")).write.text(path)
    read = scan_json(spark, path)
    return (read.rows.select("id", "name", "size", F.lit(None).cast("string").alias("line"))
            .unionByName(read.bad.select("line"), allowMissingColumns=True))


def debug_subset_written(spark, sf):
    return _subset_written(spark, sf)[0]


def debug_subset_businesses(spark, sf):
    return _subset_written(spark, sf)[1]


# -- ids, projections, lookup joins ------------------------------------------

def user_ids(spark, sf):
    keys = key_counts(tables.reviews(spark, sf), "user_id").select("user_id")
    return number_keys(keys, "user_id", USER)


def item_ids(spark, sf):
    return prepare_catalog(tables.catalog(spark, sf))[1]


def catalog_projection(spark, sf):
    return _catalog(spark, sf)


def ratings_projection(spark, sf):
    return _prep(spark, sf).ratings


def encode_ratings(spark, sf):
    p = _prep(spark, sf)
    return encode(encode(p.reviews, p.user_ids, "user_id", USER), p.item_ids, "business_id", ITEM)


def orphan_ratings(spark, sf):
    p = _prep(spark, sf)
    r = p.reviews
    by_item = orphans(r, p.item_ids, "business_id")
    by_user = r.where(F.col("user_id").isNull())
    return by_item.unionByName(by_user).distinct()


def orphan_documents(spark, sf):
    """Documents without a label: orphans of a lookup that are really there."""
    docs = tables.table(spark, sf, "documents").select("doc_id", "source")
    return orphans(docs, tables.table(spark, sf, "labels").select("doc_id"), "doc_id")


def drop_columns(spark, sf):
    # the numeric id isn't there yet: absent names are ignored
    return tables.catalog(spark, sf).drop("business_id", ITEM)


def describe_items(spark, sf):
    return describe(_catalog(spark, sf)).select(ITEM, "description")


# -- filters --------------------------------------------------------------------

def match_items_exact(spark, sf):
    return match_items(_catalog(spark, sf), FAVOURITE)


def match_items_pattern(spark, sf):
    return match_items(_catalog(spark, sf), "Red%")


def match_items_wildcard(spark, sf):
    return match_items(_catalog(spark, sf), "red_plate")


def match_count(spark, sf):
    return match_items(_catalog(spark, sf), FAVOURITE).agg(
        F.count(F.lit(1)).alias("n_matches"))


def persona_matches(spark, sf):
    return match_personas(tables.personas(spark, sf), _catalog(spark, sf)).select(
        "persona", ITEM, "name")


def unmatched_personas_q(spark, sf):
    return unmatched_personas(tables.personas(spark, sf), _catalog(spark, sf))


def persona_matches_mixed(spark, sf):
    """Patterns with capitals: exact, prefix and inner wildcard."""
    part = tables.table(spark, sf, "part").select(F.upper("p_name").alias("persona")).distinct()
    word = F.element_at(F.split("persona", " "), 1)
    mixed = part.select("persona", F.explode(F.array("persona", F.concat(word, F.lit("%")),
                                                     F.concat(F.lit("%"), F.element_at(F.split("persona", " "), -1))))
                        .alias("pattern"))
    return match_personas(mixed, _catalog(spark, sf)).select("persona", "pattern", ITEM, "name")


def items_in_set_q(spark, sf):
    p = _prep(spark, sf)
    rated_by_first = p.ratings.where(F.col(USER) == 0).select(ITEM)
    return items_in_set(p.catalog, rated_by_first)


# -- persona, union, candidates -------------------------------------------------

def persona_ratings_q(spark, sf):
    p = _prep(spark, sf)
    return persona_ratings(p.ratings, match_items(p.catalog, FAVOURITE))


def persona_union(spark, sf):
    p = _prep(spark, sf)
    return with_persona(p.ratings, persona_ratings(p.ratings, match_items(p.catalog, FAVOURITE)))


def distinct_items(spark, sf):
    return _prep(spark, sf).ratings.select(ITEM).distinct()


def als_candidates(spark, sf):
    p = _prep(spark, sf)
    return candidates(p.ratings, match_items(p.catalog, FAVOURITE))


def topn_per_user(spark, sf):
    r = _prep(spark, sf).ratings
    order = [F.col("rating").desc(), F.col(ITEM).asc()]
    return top_n_per_group(r, USER, order, 3).select(
        USER, F.col("rank").cast("long").alias("rank"), ITEM, "rating")


# -- labels, splits, subsets ---------------------------------------------------

def label_reviews_q(spark, sf):
    return label_reviews(tables.labelled_text(spark, sf)).select("doc_id", "text", "label")


def split_three_way(spark, sf):
    r = _prep(spark, sf).ratings
    return label_split(r, [0.6, 0.2, 0.2], 42, [USER, ITEM], ["train", "validation", "test"])


def split_two_way(spark, sf):
    docs = tables.labelled_text(spark, sf).select("doc_id")
    return label_split(docs, [0.8, 0.2], 42, ["doc_id"], ["train", "test"])


def debug_subset_ratings(spark, sf):
    items, orders = tables.review_parts(spark, sf)
    return subset_ratings_joined(items, orders, "l_orderkey", SUBSET_N, tables.REVIEW_ORDER, tables.as_reviews)


def debug_subset_items(spark, sf):
    sample = debug_subset_ratings(spark, sf)
    return subset_items(tables.catalog(spark, sf), sample)


# -- metrics -------------------------------------------------------------------

def rmse_item_mean(spark, sf):
    r = _prep(spark, sf).ratings
    means = r.groupBy(ITEM).agg(F.avg("rating").alias("prediction"))
    out = rmse(r.join(means, ITEM), "rating", "prediction")
    return out.select(_r(F.col("rmse"), 9).alias("rmse"), F.col("n"))


def auroc_ranksum(spark, sf):
    docs = tables.table(spark, sf, "documents").select("doc_id", "n_chars")
    labels = tables.table(spark, sf, "labels").select("doc_id", "quality")
    scored = docs.join(labels, "doc_id")
    out = auroc(scored, "n_chars", "quality")
    return out.select(_r(F.col("auroc"), 9).alias("auroc"), "n_pos", "n_neg")


# -- oracles -------------------------------------------------------------------

_CATALOG_COLS = "business_id_numeric, name, address, postal_code, city"
_PERSONAS = "(SELECT DISTINCT lower(p_type) AS persona, lower(p_type) || '%' AS pattern FROM part)"
_PERSONA_ROWS = (
    "SELECT CAST((SELECT max(user_id_numeric) FROM ratings) + 1 AS INTEGER) AS user_id_numeric, "
    "business_id_numeric, CAST(5.0 AS DOUBLE) AS rating FROM catalog "
    f"WHERE lower(name) LIKE '{FAVOURITE}'")
_SUBSET = ("SELECT user_id, business_id, stars FROM ("
           "SELECT 'U' || CAST(o.o_custkey AS VARCHAR) AS user_id, "
           "'B' || CAST(l.l_partkey AS VARCHAR) AS business_id, "
           "CAST(ceil(l.l_quantity / 10) AS DOUBLE) AS stars "
           "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
           "ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, "
           f"l.l_quantity, l.l_extendedprice, l.l_shipdate LIMIT {SUBSET_N})")

SQL = {
    "json_roundtrip": BASE + "SELECT * FROM catalog_raw",
    "json_quarantine": (
        "SELECT CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey AS BIGINT) END AS id, "
        "CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS name, "
        "CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS BIGINT) END AS size, "
        "CASE WHEN p_partkey % 3 = 0 THEN '{\"id\":' || p_partkey || ',\"name\":\"' || p_name || '\",\"size\":' || p_size "
        "END AS line FROM part"),
    "debug_subset_written": _SUBSET,
    "user_ids": BASE + "SELECT user_id, user_id_numeric FROM user_ids",
    "item_ids": BASE + "SELECT business_id, business_id_numeric FROM item_ids",
    "catalog_projection": BASE + f"SELECT {_CATALOG_COLS} FROM catalog",
    "ratings_projection": BASE + "SELECT * FROM ratings",
    "encode_ratings": BASE + (
        "SELECT r.user_id, r.business_id, r.stars, u.user_id_numeric, i.business_id_numeric "
        "FROM reviews r JOIN user_ids u ON r.user_id = u.user_id "
        "JOIN item_ids i ON r.business_id = i.business_id"),
    "orphan_ratings": BASE + (
        "SELECT DISTINCT * FROM reviews r WHERE r.user_id IS NULL OR NOT EXISTS "
        "(SELECT 1 FROM item_ids i WHERE i.business_id = r.business_id)"),
    "drop_columns": BASE + "SELECT name, address, postal_code, city FROM catalog",
    "describe_items": BASE + (
        "SELECT business_id_numeric, concat_ws(', ', coalesce(name, 'None'), "
        "coalesce(address, 'None'), coalesce(postal_code, 'None'), coalesce(city, 'None')) "
        "AS description FROM catalog"),
    "match_items_exact": BASE + f"SELECT {_CATALOG_COLS} FROM catalog WHERE lower(name) LIKE 'red plate'",
    "match_items_pattern": BASE + f"SELECT {_CATALOG_COLS} FROM catalog WHERE lower(name) LIKE 'red%'",
    "match_items_wildcard": BASE + f"SELECT {_CATALOG_COLS} FROM catalog WHERE lower(name) LIKE 'red_plate'",
    "match_count": BASE + "SELECT count(*) AS n_matches FROM catalog WHERE lower(name) LIKE 'red plate'",
    "persona_matches": BASE + (
        f"SELECT p.persona, c.business_id_numeric, c.name FROM {_PERSONAS} p "
        "JOIN catalog c ON lower(c.name) LIKE p.pattern"),
    "persona_matches_mixed": BASE + (
        ", p AS (SELECT DISTINCT upper(p_name) AS persona FROM part), "
        "q AS (SELECT persona, unnest([persona, split_part(persona, ' ', 1) || '%', "
        "'%' || list_extract(string_split(persona, ' '), -1)]) AS pattern FROM p) "
        "SELECT q.persona, q.pattern, c.business_id_numeric, c.name FROM q "
        "JOIN catalog c ON lower(c.name) LIKE lower(q.pattern)"),
    "orphan_documents": (
        "SELECT doc_id, source FROM documents d WHERE NOT EXISTS "
        "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"),
    "unmatched_personas": (
        f"SELECT persona, pattern FROM {_PERSONAS} p WHERE NOT EXISTS "
        "(SELECT 1 FROM part c WHERE lower(c.p_name) LIKE p.pattern)"),
    "items_in_set": BASE + (
        f"SELECT {_CATALOG_COLS} FROM catalog WHERE business_id_numeric IN "
        "(SELECT business_id_numeric FROM ratings WHERE user_id_numeric = 0)"),
    "persona_ratings": BASE + _PERSONA_ROWS,
    "persona_union": BASE + "SELECT * FROM ratings UNION ALL " + _PERSONA_ROWS,
    "distinct_items": BASE + "SELECT DISTINCT business_id_numeric FROM ratings",
    "als_candidates": BASE + (
        "SELECT CAST((SELECT max(user_id_numeric) FROM ratings) + 1 AS INTEGER) AS user_id_numeric, "
        "business_id_numeric FROM (SELECT DISTINCT business_id_numeric FROM ratings) d "
        "WHERE business_id_numeric NOT IN (SELECT business_id_numeric FROM catalog "
        f"WHERE lower(name) LIKE '{FAVOURITE}')"),
    "topn_per_user": BASE + (
        "SELECT user_id_numeric, rank, business_id_numeric, rating FROM ("
        "SELECT *, row_number() OVER (PARTITION BY user_id_numeric "
        "ORDER BY rating DESC, business_id_numeric) AS rank FROM ratings) WHERE rank <= 3"),
    "label_reviews": TEXT + (
        "SELECT doc_id, lower(text) AS text, CASE WHEN stars >= 4 THEN 1 ELSE 0 END AS label "
        "FROM texts"),
    "split_three_way": BASE + (
        "SELECT user_id_numeric, business_id_numeric, rating, CASE WHEN b < 6000 THEN 'train' "
        "WHEN b < 8000 THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, "
        + bucket("user_id_numeric", "business_id_numeric") + " AS b FROM ratings) s"),
    "split_two_way": TEXT + (
        "SELECT doc_id, CASE WHEN " + bucket("doc_id") + " < 8000 THEN 'train' "
        "ELSE 'test' END AS split FROM texts"),
    "debug_subset_ratings": _SUBSET,
    "debug_subset_items": (
        "SELECT 'B' || CAST(p_partkey AS VARCHAR) AS business_id, p_name AS name, "
        "p_brand AS address, CAST(p_size AS VARCHAR) AS postal_code, p_type AS city "
        "FROM part WHERE 'B' || CAST(p_partkey AS VARCHAR) IN (SELECT business_id FROM ("
        + _SUBSET + "))"),
    "rmse_item_mean": BASE + (
        "SELECT round(sqrt(avg((m.prediction - r.rating) * (m.prediction - r.rating))), 9) AS rmse, "
        "count(*) AS n FROM ratings r JOIN (SELECT business_id_numeric, avg(rating) AS prediction "
        "FROM ratings GROUP BY business_id_numeric) m ON r.business_id_numeric = m.business_id_numeric"),
    "auroc_ranksum": (
        "WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS score, "
        "CASE WHEN l.quality > 0 THEN 1 ELSE 0 END AS y FROM documents d JOIN labels l "
        "ON d.doc_id = l.doc_id), "
        "g AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM s GROUP BY score), "
        "c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS before_neg FROM g) "
        "SELECT round(sum(pos * (before_neg + neg / 2.0)) / (sum(pos) * sum(neg)), 9) AS auroc, "
        "CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c"),
}

QUERIES = {
    "json_roundtrip": (json_roundtrip, SQL["json_roundtrip"]),
    "json_quarantine": (json_quarantine, SQL["json_quarantine"]),
    "debug_subset_written": (debug_subset_written, SQL["debug_subset_written"]),
    "user_ids": (user_ids, SQL["user_ids"]),
    "item_ids": (item_ids, SQL["item_ids"]),
    "catalog_projection": (catalog_projection, SQL["catalog_projection"]),
    "ratings_projection": (ratings_projection, SQL["ratings_projection"]),
    "encode_ratings": (encode_ratings, SQL["encode_ratings"]),
    "orphan_ratings": (orphan_ratings, SQL["orphan_ratings"]),
    "drop_columns": (drop_columns, SQL["drop_columns"]),
    "describe_items": (describe_items, SQL["describe_items"]),
    "match_items_exact": (match_items_exact, SQL["match_items_exact"]),
    "match_items_pattern": (match_items_pattern, SQL["match_items_pattern"]),
    "match_items_wildcard": (match_items_wildcard, SQL["match_items_wildcard"]),
    "match_count": (match_count, SQL["match_count"]),
    "persona_matches_mixed": (persona_matches_mixed, SQL["persona_matches_mixed"]),
    "orphan_documents": (orphan_documents, SQL["orphan_documents"]),
    "debug_subset_businesses": (debug_subset_businesses, SQL["debug_subset_items"]),
    "persona_matches": (persona_matches, SQL["persona_matches"]),
    "unmatched_personas": (unmatched_personas_q, SQL["unmatched_personas"]),
    "items_in_set": (items_in_set_q, SQL["items_in_set"]),
    "persona_ratings": (persona_ratings_q, SQL["persona_ratings"]),
    "persona_union": (persona_union, SQL["persona_union"]),
    "distinct_items": (distinct_items, SQL["distinct_items"]),
    "als_candidates": (als_candidates, SQL["als_candidates"]),
    "topn_per_user": (topn_per_user, SQL["topn_per_user"]),
    "label_reviews": (label_reviews_q, SQL["label_reviews"]),
    "split_three_way": (split_three_way, SQL["split_three_way"]),
    "split_two_way": (split_two_way, SQL["split_two_way"]),
    "debug_subset_ratings": (debug_subset_ratings, SQL["debug_subset_ratings"]),
    "debug_subset_items": (debug_subset_items, SQL["debug_subset_items"]),
    "rmse_item_mean": (rmse_item_mean, SQL["rmse_item_mean"]),
    "auroc_ranksum": (auroc_ranksum, SQL["auroc_ranksum"]),
}
