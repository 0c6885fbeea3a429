"""The whole jobs from the JSON files: report, tuned report, review sentiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.catalog import describe, match_items
from revlens.plans.recommend import Prepared, Recommendation, prepare, recommend
from revlens.plans.sentiment import SentimentResult, sentiment
from revlens.plans.tune import GridResult, als_grid_search
from revlens.sources.jsonio import read_json
from revlens.sources.schemas import BUSINESS_SCHEMA, REVIEW_SCHEMA, REVIEW_TEXT_SCHEMA


def prepare_files(spark: SparkSession, business_path: str, review_path: str,
                  on_missing: str = "error") -> Prepared:
    return prepare(read_json(spark, business_path, BUSINESS_SCHEMA),
                   read_json(spark, review_path, REVIEW_SCHEMA), on_missing)


def recommend_files(spark: SparkSession, business_path: str, review_path: str, favourite: str,
                    on_missing: str = "error", **params) -> Recommendation:
    """Business and review files -> ranked report for one favourite."""
    return recommend(prepare_files(spark, business_path, review_path, on_missing), favourite, **params)


def tune_and_recommend(prep: Prepared, favourite: str, ranks: Sequence[int], reg_params: Sequence[float],
                       max_iter: int, n: int = 10, parallelism: int = 1) -> tuple[GridResult, Recommendation]:
    """Grid search, then the report with the winning rank and regParam."""
    grid = als_grid_search(prep.ratings, ranks, reg_params, max_iter, parallelism=parallelism)
    return grid, recommend(prep, favourite, n, grid.best_rank, max_iter, grid.best_reg)


def match_report(catalog: DataFrame, favourite: str, literal: bool = False) -> tuple[int, DataFrame]:
    """(number of matching businesses, their descriptions)."""
    found = describe(match_items(catalog, favourite, literal))
    return found.agg(F.count(F.lit(1))).first()[0], found.select("description")


def sentiment_files(spark: SparkSession, review_path: str, **params) -> SentimentResult:
    """Raw review file -> classifier and AUROC."""
    return sentiment(read_json(spark, review_path, REVIEW_TEXT_SCHEMA), doc_col="review_id", **params)
