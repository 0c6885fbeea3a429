"""Recommend items for a persona who loves every item matching a name.

prepare: dense ids for users and items, strict lookup joins -> catalog and
ratings. recommend: persona rows -> union -> ALS fit -> candidates (all rated
items but the favourites) -> score -> top n -> ranked report. Pure: nothing
is appended to the prepared ratings, so calls do not affect each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.fixed import ALS_SEED, PERSONA_RATING
from revlens.operators.catalog import describe, match_items, match_personas, report, require_match
from revlens.operators.ids import (dense_ids, encode, hot_ids, key_frequencies,
                                   number_keys)
from revlens.operators.persona import (ITEM, RATING, USER, candidates,
                                       persona_ratings, with_persona)
from revlens.operators.joins import small_side
from revlens.operators.skew import SkewSpec
from revlens.operators.topk import top_items
from revlens.session import checkpoint_dir, write_table

ALS_BLOCKS = 10                # at least, as Spark has it
# Ratings of one block of users (or items): 12 bytes each, held some four times (reckoned) while it is built. A round
# moves every factor once per block that needs it, so smaller blocks move more.
BLOCK_RATINGS = 20_000_000
CATALOG_ROWS = 50_000          # catalog rows of one file when names are matched by grams
CATALOG_COLS = (ITEM, "name", "address", "postal_code", "city")


@dataclass
class Prepared:
    catalog: DataFrame   # business_id_numeric, name, address, postal_code, city
    ratings: DataFrame   # user_id_numeric, business_id_numeric, rating
    user_ids: DataFrame  # user_id, n_rows, user_id_numeric
    item_ids: DataFrame  # business_id, business_id_numeric
    reviews: DataFrame   # user_id, business_id, stars: the review view, written once


def prepare_catalog(business: DataFrame, on_missing: str = "error") -> tuple[DataFrame, DataFrame]:
    """(catalog, item ids) from the business table alone.

    A business without an id is an error, or is dropped with 'drop'.
    """
    item_ids = dense_ids(business, "business_id", ITEM)
    catalog = encode(business, item_ids, "business_id", ITEM, on_missing)
    return catalog.select(*CATALOG_COLS), item_ids


def prepare(business: DataFrame, reviews: DataFrame, on_missing: str = "error",
            skew: SkewSpec | None = SkewSpec(), materialize: bool = True) -> Prepared:
    """Number ids and encode the ratings.

    ``on_missing``: 'error' fails on a rating whose user or business has no
    id (null key, or business absent from the catalog); 'drop' removes it.
    ``skew``: hot users/items are spread over salts in the lookup joins.
    ``materialize`` (default): write the ratings once to the checkpoint
    folder (three numeric columns), so the persona id, the candidate set and
    the ALS fit read them instead of re-running both lookup joins.
    """
    catalog, item_ids = prepare_catalog(business, on_missing)
    # The view may be a join: it runs once, and frequencies and both lookups read its rows.
    facts = write_table(reviews.select("user_id", "business_id", "stars"), "reviews")
    freq = key_frequencies(facts, ["user_id", "business_id"])
    user_ids = number_keys(freq["user_id"], "user_id", USER)
    hot_u = hot_i = None
    if skew is not None:
        # Salt only when some key is hot: the check reads the pinned
        # frequency table, and without hot keys a plain join is cheaper.
        hot_u = hot_ids(freq["user_id"], "user_id", skew)
        hot_i = hot_ids(freq["business_id"], "business_id", skew)
        hot_u = None if hot_u.isEmpty() else hot_u
        hot_i = None if hot_i.isEmpty() else hot_i
    enc = encode(facts, user_ids, "user_id", USER, on_missing, hot_u)
    enc = encode(enc, item_ids, "business_id", ITEM, on_missing, hot_i)
    ratings = enc.select(USER, ITEM, F.col("stars").cast("double").alias(RATING))
    if materialize:
        ratings = write_table(ratings, "ratings")
    return Prepared(catalog, ratings, user_ids, item_ids, facts)


def als_estimator(rank: int = 30, max_iter: int = 50, reg_param: float = 0.3,
                  seed: int = ALS_SEED, num_blocks: int | None = None,
                  checkpoint_interval: int = 10) -> ALS:
    """Explicit-feedback ALS; unseen users or items give no prediction.

    ``num_blocks`` (user and item blocks) decides how the factors start and
    how many tasks a round has. None: :func:`fit` takes it from the number of
    ratings, never from the cluster, so the same data and seed give the same
    model anywhere.
    """
    als = ALS(userCol=USER, itemCol=ITEM, ratingCol=RATING,
              coldStartStrategy="drop", seed=seed, rank=rank, maxIter=max_iter,
              regParam=reg_param, checkpointInterval=checkpoint_interval)
    return als if num_blocks is None else als.setNumBlocks(num_blocks)


def blocks_for(ratings: DataFrame, most: int | None = None) -> int:
    """Blocks of at most ``most`` (``BLOCK_RATINGS``) ratings on average, ``ALS_BLOCKS`` at least."""
    return max(ALS_BLOCKS, -(-ratings.count() // (most or BLOCK_RATINGS)))


def fit(als: ALS, ratings: DataFrame) -> ALSModel:
    """Fit with the session's checkpoint folder registered (long lineages) and,
    unless the estimator says otherwise, blocks that follow the ratings."""
    checkpoint_dir(ratings.sparkSession)
    if not als.isSet(als.numUserBlocks):
        als = als.copy().setNumBlocks(blocks_for(ratings))
    return als.fit(ratings)


def top_n(scored: DataFrame, n: int) -> DataFrame:
    """(rank, item, prediction): best n by prediction, ties by lower item id.

    ``orderBy().limit()`` plans as TakeOrderedAndProject; the rank window
    then runs over those n rows only.
    """
    order = [F.col("prediction").desc(), F.col(ITEM).asc()]
    best = scored.select(ITEM, "prediction").orderBy(*order).limit(n)
    return best.select(F.row_number().over(Window.orderBy(*order)).alias("rank"),
                       ITEM, "prediction")


def top_n_per_group(df: DataFrame, group: str, order: list, n: int,
                    salts: int = 16, salt_col: str | None = None) -> DataFrame:
    """Top n rows per group, skew-safe: first per (group, salt), then per group.

    A hot group is sorted in ``salts`` pieces; the second step sees at most
    ``n * salts`` rows per group. Adds ``rank`` (1..n).
    """
    salt_src = F.col(salt_col) if salt_col else F.xxhash64(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_rl_salt", F.pmod(salt_src, F.lit(salts)))
    first = Window.partitionBy(group, "_rl_salt").orderBy(*order)
    kept = (salted.withColumn("_rl_r", F.row_number().over(first))
            .where(F.col("_rl_r") <= n).drop("_rl_r", "_rl_salt"))
    final = Window.partitionBy(group).orderBy(*order)
    return (kept.withColumn("rank", F.row_number().over(final))
            .where(F.col("rank") <= n))


@dataclass
class Recommendation:
    top: DataFrame          # rank, business_id_numeric, prediction
    report: DataFrame       # position, business_id_numeric, prediction, description
    model: ALSModel
    persona_id: int
    favourites: DataFrame   # catalog rows that matched
    candidates: DataFrame   # user_id_numeric, business_id_numeric
    training: DataFrame     # ratings plus the persona rows


def persona_id_of(ratings: DataFrame) -> int:
    """``max(user) + 1`` as a driver int (one aggregate row)."""
    top = ratings.agg(F.max(USER)).first()[0]
    return 0 if top is None else int(top) + 1


def recommend(prep: Prepared, favourite: str, n: int = 10, rank: int = 30,
              max_iter: int = 50, reg_param: float = 0.3, literal: bool = False,
              seed: int = ALS_SEED, num_blocks: int | None = None) -> Recommendation:
    """Top-n items for a new user who rated every matching item 5.0."""
    favourites = require_match(write_table(match_items(prep.catalog, favourite, literal), "favourites"), favourite)
    uid = persona_id_of(prep.ratings)
    training = with_persona(prep.ratings, persona_ratings(prep.ratings, favourites, uid))
    model = fit(als_estimator(rank, max_iter, reg_param, seed, num_blocks), training)
    # written: read several times, and the user is a column, not a constant
    cands = write_table(candidates(prep.ratings, favourites, uid), "candidates")
    best = write_table(top_n(score_user(model, uid, cands), n), "best")
    return Recommendation(best, report(best, prep.catalog, rows=n), model, uid,
                          favourites, cands, training)


@dataclass
class Recommendations:
    top: DataFrame          # persona, rank, business_id_numeric, prediction
    report: DataFrame       # persona, position, business_id_numeric, prediction, description
    model: ALSModel
    users: DataFrame        # persona, user_id_numeric
    favourites: DataFrame   # persona, user_id_numeric, business_id_numeric
    items: DataFrame        # business_id_numeric: the rated items, all candidates but a persona's favourites
    training: DataFrame     # ratings plus all personas' rows


def recommend_personas(prep: Prepared, personas: DataFrame, n: int = 10, rank: int = 30, max_iter: int = 50,
                       reg_param: float = 0.3, seed: int = ALS_SEED, num_blocks: int | None = None) -> Recommendations:
    """Top-n items for every row of ``personas`` (persona, pattern) in one fit.

    Each persona that matches anything is a new user who rated its matches
    5.0; a persona may have several patterns. Users are numbered in persona
    order above the real ones. The personas' ratings enter one training set,
    so they also move the factors of the items they name. Personas that match
    nothing get no rows (see ``unmatched_personas``); none matching at all is
    a ``KeyError``. Scoring is by blocks of users and items
    (:mod:`revlens.operators.topk`).
    """
    # both sides are read several times; the names in pieces, as each gives many grams
    personas = write_table(personas.select("persona", "pattern"), "patterns")
    pieces = max(1, -(-prep.item_ids.count() // CATALOG_ROWS))
    catalog = write_table(prep.catalog.repartition(pieces, ITEM), "catalog")
    matches = match_personas(personas, catalog)
    matches = write_table(matches.select("persona", ITEM).distinct(), "favourites")
    if matches.isEmpty():
        raise KeyError("no catalog name matches any persona")
    base = persona_id_of(prep.ratings)
    numbered = number_keys(matches.select("persona").distinct(), "persona", "_rl_k")
    users = write_table(numbered.select("persona", (F.col("_rl_k") + F.lit(base)).cast("int").alias(USER)), "personas")
    favourites = write_table(matches.join(users, "persona").select("persona", USER, F.col(ITEM).cast("int").alias(ITEM)),
                             "favourites")
    rows = favourites.select(USER, ITEM, F.lit(float(PERSONA_RATING)).alias(RATING))
    training = with_persona(prep.ratings, rows)
    model = fit(als_estimator(rank, max_iter, reg_param, seed, num_blocks), training)
    items = write_table(prep.ratings.select(ITEM).distinct(), "items")
    rated = write_table(model.itemFactors.join(items.select(F.col(ITEM).alias("id")), "id", "left_semi"), "item-factors")
    asked = write_table(model.userFactors.join(users.select(F.col(USER).alias("id")), "id", "left_semi"), "user-factors")
    excluded = favourites.select(F.col(USER).alias("user"), F.col(ITEM).alias("item"))
    best = top_items(asked, rated, excluded, n).join(users.withColumnRenamed(USER, "user"), "user")
    top = write_table(best.select("persona", "rank", F.col("item").alias(ITEM),
                                  F.col("score").cast("float").alias("prediction")), "best")
    described = describe(catalog).select(ITEM, "description")
    told = small_side(top, top.count()).join(described, ITEM).select(
        "persona", F.col("rank").alias("position"), ITEM, "prediction", "description")
    return Recommendations(top, told, model, users, favourites, items, training)


def _dot(left, right):
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def score_user(model: ALSModel, user_id: int, pairs: DataFrame) -> DataFrame:
    """(user, item, prediction) for one user's candidate items.

    Same scores as ``model.transform(pairs)`` (cold items dropped), without
    its plan for a constant user column: there the user-factor lookup
    becomes a nested-loop join that broadcasts every candidate. Here the
    user's factor vector (``rank`` floats) is fetched once and the candidates
    are hash-joined with the item factors.
    """
    row = model.userFactors.where(F.col("id") == F.lit(int(user_id))).select("features").first()
    items = model.itemFactors.select(F.col("id").alias(ITEM), F.col("features").alias("_rl_vf"))
    joined = pairs.join(items, ITEM, "inner")
    if row is None:  # unseen user: nothing to predict (cold start)
        return joined.where(F.lit(False)).select(USER, ITEM, F.lit(None).cast("float").alias("prediction"))
    vec = F.lit([float(x) for x in row["features"]]).cast("array<float>")
    return joined.select(USER, ITEM, _dot(F.col("_rl_vf"), vec).cast("float").alias("prediction"))


def factor_scores(model: ALSModel, pairs: DataFrame, user_id: int | None = None) -> DataFrame:
    """(user, item, dot) from the factor tables: the score ALS predicts.

    ``user_id``: the only user of ``pairs``, whose row is broadcast, as a
    shuffle by user would bring all pairs to one task.
    """
    uf = model.userFactors.select(F.col("id").alias(USER), F.col("features").alias("uf"))
    if user_id is not None:
        uf = F.broadcast(uf.where(F.col(USER) == F.lit(int(user_id))))
    itf = model.itemFactors.select(F.col("id").alias(ITEM), F.col("features").alias("vf"))
    return (pairs.join(uf, USER).join(itf, ITEM)
            .select(USER, ITEM, _dot(F.col("uf"), F.col("vf")).alias("dot")))
