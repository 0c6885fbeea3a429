"""The n lowest and n highest weighted terms, as one ordered key list.

Order is (weight, term) ascending, a total order. The list is the first n
of that order followed by the last n, each in ascending order; when fewer
than 2n terms exist the two halves overlap and shared terms appear twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIDE = "side"
POSITION = "position"


def key_extremes(weights: DataFrame, n: int, term_col: str = "term",
                 weight_col: str = "weight") -> DataFrame:
    """(side, position, term, weight): 'low' rows then 'high' rows.

    Each half is a top-n (TakeOrderedAndProject), so at most 2n rows leave
    the scan; positions come from a window over those 2n rows only.
    """
    asc = [F.col(weight_col).asc(), F.col(term_col).asc()]
    desc = [F.col(weight_col).desc(), F.col(term_col).desc()]
    low = weights.orderBy(*asc).limit(n).select(
        F.lit("low").alias(SIDE), term_col, weight_col)
    high = weights.orderBy(*desc).limit(n).select(
        F.lit("high").alias(SIDE), term_col, weight_col)
    both = low.unionByName(high)
    in_side = Window.partitionBy(SIDE).orderBy(*asc)
    n_low = Window.partitionBy(F.lit(1))
    ranked = both.select(
        SIDE, term_col, weight_col,
        (F.row_number().over(in_side) - 1).alias("_k"),
        F.sum(F.when(F.col(SIDE) == "low", 1).otherwise(0)).over(n_low).alias("_n_low"))
    pos = F.when(F.col(SIDE) == "low", F.col("_k")).otherwise(F.col("_n_low") + F.col("_k"))
    return ranked.select(SIDE, pos.cast("long").alias(POSITION), term_col, weight_col)


def key_list(extremes: DataFrame, term_col: str = "term") -> list[str]:
    """The key terms in position order (at most 2n values)."""
    return [r[term_col] for r in extremes.orderBy(POSITION).select(term_col).collect()]
