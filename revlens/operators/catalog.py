"""Catalog operators: name matching, descriptions, the ranked report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import join_fields, like_literal
from revlens.operators.joins import small_side
from revlens.operators.patterns import like_join

ITEM = "business_id_numeric"
DESCRIBED = ("name", "address", "postal_code", "city")


def name_pattern(favourite: str, literal: bool = False) -> str:
    """LIKE pattern of a favourite: lower-cased; wildcards active unless literal."""
    p = favourite.lower()
    return like_literal(p) if literal else p


def match_items(catalog: DataFrame, favourite: str, literal: bool = False,
                name_col: str = "name") -> DataFrame:
    """Catalog rows with ``lower(name) LIKE lower(favourite)``.

    Whole-string match unless the favourite holds ``%`` or ``_``.
    """
    return catalog.where(F.lower(F.col(name_col)).like(name_pattern(favourite, literal)))


def match_personas(personas: DataFrame, catalog: DataFrame,
                   pattern_col: str = "pattern", name_col: str = "name") -> DataFrame:
    """All (persona, item) pairs with ``lower(name) LIKE lower(pattern)``.

    A pattern without ``%``, ``_`` or ``\\`` is an equi join on the lowered
    name; one whose only wildcard is a final ``%`` an equi join on prefixes of
    the pattern lengths that occur; others go through the gram index of
    :mod:`revlens.operators.patterns`. No number of patterns is too many, and
    nothing is a nested loop. Output: persona columns then catalog columns.
    """
    pattern = F.lower(F.col(pattern_col))
    lowered = catalog.withColumn("_rl_name", F.lower(F.col(name_col)))
    exact = personas.where(~pattern.rlike(r"[%_\\]"))
    by_name = (exact.withColumn("_rl_key", pattern)
               .join(lowered, F.col("_rl_key") == F.col("_rl_name"), "inner").drop("_rl_key", "_rl_name"))
    # cut from the lowered pattern, whose length may differ
    prefix = (personas.where(pattern.rlike(r"^[^%_\\]+%$"))
              .withColumn("_rl_key", F.substring(pattern, F.lit(1), F.length(pattern) - 1)))
    sizes = [r[0] for r in prefix.select(F.length("_rl_key")).distinct().collect()]  # at most a pattern's length
    starts = F.array_distinct(F.transform(F.lit(sorted(sizes)) if sizes else F.array().cast("array<int>"),
                                          lambda n: F.when(n <= F.length("_rl_name"), F.substring(F.col("_rl_name"), F.lit(1), n))))
    by_prefix = (prefix.join(lowered.withColumn("_rl_start", F.explode(starts)),
                             F.col("_rl_key") == F.col("_rl_start"), "inner").drop("_rl_key", "_rl_name", "_rl_start"))
    found = by_name.unionByName(by_prefix)
    wild = personas.where(pattern.rlike(r"[%_\\]") & ~pattern.rlike(r"^[^%_\\]+%$"))
    return found if wild.isEmpty() else found.unionByName(like_join(wild, catalog, pattern_col, name_col))


def unmatched_personas(personas: DataFrame, catalog: DataFrame,
                       persona_col: str = "persona",
                       pattern_col: str = "pattern") -> DataFrame:
    """Personas whose pattern matches no catalog name."""
    hit = match_personas(personas, catalog, pattern_col).select(persona_col).distinct()
    return personas.join(hit, persona_col, "left_anti")


def require_match(matches: DataFrame, favourite: str) -> DataFrame:
    """Raise ``KeyError`` when nothing matched (one cheap ``limit 1`` job)."""
    if matches.isEmpty():
        raise KeyError(f"no catalog name matches {favourite!r}")
    return matches


def items_in_set(catalog: DataFrame, ids: DataFrame, item_col: str = ITEM) -> DataFrame:
    """Catalog rows whose id is in ``ids`` (a left semi join, no driver list)."""
    return catalog.join(ids.select(item_col), item_col, "left_semi")


def describe(catalog: DataFrame, drop: tuple[str, ...] = ("business_id", ITEM),
             out_col: str = "description") -> DataFrame:
    """Add one text per row: every remaining field joined with ', '."""
    fields = [c for c in catalog.drop(*drop).columns]
    return catalog.withColumn(out_col, join_fields(*fields))


def report(top: DataFrame, catalog: DataFrame, item_col: str = ITEM, rows: int | None = None) -> DataFrame:
    """(position, item, prediction, description) for ranked ids.

    The rank travels through the join, so positions follow the prediction
    order. ``rows`` bounds ``top``; it is broadcast only if that is small.
    """
    described = describe(catalog).select(item_col, "description")
    return (small_side(top, rows).join(described, item_col, "inner")
            .select(F.col("rank").alias("position"), item_col, "prediction", "description"))
