"""Consistent debug subsets: the first n ratings and only their businesses."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from revlens.operators.sampling import first_n, first_n_joined
from revlens.sources.jsonio import read_json, write_json
from revlens.sources.schemas import BUSINESS_SCHEMA, REVIEW_SCHEMA

RATING_COLS = ("user_id", "business_id", "stars")
BUSINESS_COLS = ("business_id", "name", "address", "postal_code", "city")


def subset_ratings(reviews: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first n reviews in a total order (user_id, business_id, stars)."""
    return first_n(reviews, n, order).select(*RATING_COLS)


def subset_ratings_joined(facts: DataFrame, lookup: DataFrame, key: str, n: int, order: Sequence[Column | str],
                          view: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """:func:`subset_ratings` of reviews whose users come from a lookup table:
    ordered and cut before the lookup; ``view`` names the joined columns."""
    return view(first_n_joined(facts, lookup, key, n, order)).select(*RATING_COLS)


def subset_items(business: DataFrame, sample: DataFrame) -> DataFrame:
    """Businesses rated at least once in the sample (left semi join; Spark
    picks the join from the sides' sizes)."""
    return business.join(sample.select("business_id"), "business_id", "left_semi").select(*BUSINESS_COLS)


def write_subset(reviews: DataFrame, business: DataFrame, review_path: str, business_path: str, n: int,
                 order: Sequence[Column | str], mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """Write the sample and its businesses as JSON; both as read back.

    The sample is written first and the businesses are chosen by what was
    written, so the two files agree and the ordered limit runs once.
    ``mode`` is Spark's save mode for both paths.
    """
    return write_sample(subset_ratings(reviews, n, order), business, review_path, business_path, mode)


def write_sample(sample: DataFrame, business: DataFrame, review_path: str, business_path: str,
                 mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """:func:`write_subset` of ratings already chosen."""
    spark = sample.sparkSession
    write_json(sample, review_path, mode)
    sample = read_json(spark, review_path, REVIEW_SCHEMA)
    write_json(subset_items(business, sample), business_path, mode)
    return sample, read_json(spark, business_path, BUSINESS_SCHEMA)
