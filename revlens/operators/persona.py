"""The persona user: a new user id who gives the top rating to favourites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.fixed import PERSONA_RATING

USER = "user_id_numeric"
ITEM = "business_id_numeric"
RATING = "rating"


def next_user_id(ratings: DataFrame, user_col: str = USER) -> Column:
    """``max(user) + 1`` as a scalar-subquery column (0 for no ratings)."""
    return ratings.agg((F.coalesce(F.max(user_col), F.lit(-1)) + 1)
                       .cast("int")).scalar()


def persona_ratings(ratings: DataFrame, favourites: DataFrame,
                    user_id: Column | int | None = None,
                    rating: float = PERSONA_RATING) -> DataFrame:
    """One rating row per favourite item, columns aligned with ``ratings``."""
    uid = next_user_id(ratings) if user_id is None else (
        user_id if isinstance(user_id, Column) else F.lit(int(user_id)))
    rows = favourites.select(
        uid.cast("int").alias(USER),
        F.col(ITEM).cast("int").alias(ITEM),
        F.lit(float(rating)).alias(RATING))
    return rows.select(*ratings.columns)


def with_persona(ratings: DataFrame, persona: DataFrame) -> DataFrame:
    """Ratings plus the persona's rows (union by name, no side effects)."""
    return ratings.unionByName(persona.select(*ratings.columns))


def candidates(ratings: DataFrame, favourites: DataFrame,
               user_id: Column | int | None = None) -> DataFrame:
    """(user, item) for every rated item except the favourites."""
    uid = next_user_id(ratings) if user_id is None else (
        user_id if isinstance(user_id, Column) else F.lit(int(user_id)))
    items = ratings.select(ITEM).distinct()
    rest = items.join(favourites.select(ITEM), ITEM, "left_anti")
    return rest.select(uid.cast("int").alias(USER), F.col(ITEM))
