"""Views of the driver's test tables in the shapes the jobs expect.

* reviews  = lineitem joined with orders: one rating per line item,
  ``user_id = 'U' || o_custkey``, ``business_id = 'B' || l_partkey``,
  ``stars = ceil(l_quantity / 10)`` (1.0 .. 5.0);
* catalog  = part: ``business_id = 'B' || p_partkey``, name, address (brand),
  postal_code (size), city (type);
* labelled text = documents joined with labels: 5.0 stars when quality = 1,
  else 1.0;
* personas = one favourite pattern per part type, ``lower(p_type) || '%'``.

Only the needed columns are selected, so the Parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Total order of line items (``l_orderkey, l_linenumber`` alone is not a key).
REVIEW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                "l_quantity", "l_extendedprice", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    """(user_id, business_id, stars) [+ the line-item order columns]."""
    items, orders = review_parts(spark, sf_dir)
    return as_reviews(items.join(orders, "l_orderkey"), with_order)


def review_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(line items, orders): the two sides of the review view, joined on l_orderkey."""
    items = table(spark, sf_dir, "lineitem").select(*REVIEW_ORDER)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return items, orders


def as_reviews(joined: DataFrame, with_order: bool = False) -> DataFrame:
    """The review columns of joined line items and orders."""
    cols = [
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat(F.lit("B"), F.col("l_partkey").cast("string")).alias("business_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("stars"),
    ]
    if with_order:
        cols += [F.col(c) for c in REVIEW_ORDER]
    return joined.select(*cols)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business rows: (business_id, name, address, postal_code, city)."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("business_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("address"),
        F.col("p_size").cast("string").alias("postal_code"),
        F.col("p_type").alias("city"),
    )


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review text with stars: (doc_id, text, stars)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id", "text",
        F.when(F.col("quality") == 1, F.lit(5.0)).otherwise(F.lit(1.0)).alias("stars"),
    )


def review_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every document: (doc_id, text)."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Favourite patterns derived from the part types: (persona, pattern)."""
    return (table(spark, sf_dir, "part")
            .select(F.lower(F.col("p_type")).alias("persona"))
            .distinct()
            .select("persona", F.concat(F.col("persona"), F.lit("%")).alias("pattern")))
