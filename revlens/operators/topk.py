"""Best items of many users from factor tables, by blocks.

Users and items are cut into blocks of a fixed number of rows, each one row
that holds its ids and its factors as one flat array. A user block meets every
item block by an equi join on the item block's number, to which the user
blocks are copied; a task multiplies the two matrices and keeps, per user, the
best ``n`` items and as many more as the block holds excluded ones. So a block
pair gives a number of rows that follows ``n``, not the pairs, and no user or
item is a hot key. Excluded pairs leave by an anti join; what is left is
ranked by (user, salt), then by user.

Scores are sums of products in double precision of the float factors, ties go
to the lower item id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USER_BLOCK = 1 << 10
ITEM_BLOCK = 1 << 13


def _blocks(factors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """((name, ids, flat factors), number of blocks) of (id, features)."""
    n = factors.count()
    count = max(1, -(-n // rows))
    block = F.pmod(F.xxhash64("id"), F.lit(count)).cast("int").alias(name)
    entries = F.sort_array(F.collect_list(F.struct("id", "features")))
    cut = factors.select(block, "id", "features").groupBy(name).agg(entries.alias("e"))
    return cut.select(name, F.transform("e", lambda e: e["id"]).alias(f"{name}_ids"),
                      F.flatten(F.transform("e", lambda e: e["features"])).alias(f"{name}_flat")), count


def _best(n: int):
    """Top items per user and block pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                users, u, items, v, ids, more = (batch.column(c)[k].values for c in range(6))
                users, items = users.to_numpy(), items.to_numpy()
                rank = len(u) // len(users)
                score = (u.to_numpy().reshape(-1, rank).astype(np.float64)
                         @ v.to_numpy().reshape(-1, rank).astype(np.float64).T)
                take = np.full(len(users), n)
                if ids is not None and len(ids):
                    take[np.searchsorted(users, ids.to_numpy())] += more.to_numpy()
                out = []
                for i, m in enumerate(np.minimum(take, len(items)).tolist()):
                    row = score[i]
                    # all that reach the m-th best score; ids are ascending, so a stable sort breaks ties by id
                    near = np.flatnonzero(row >= np.partition(row, len(row) - m)[len(row) - m])
                    best = near[np.argsort(-row[near], kind="stable")][:m]
                    out.append((np.full(len(best), users[i]), items[best], row[best]))
                a, b, c = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(c)],
                                                 ["user", "item", "score"])
    return run


def top_items(users: DataFrame, items: DataFrame, excluded: DataFrame, n: int, user_block: int = USER_BLOCK,
              item_block: int = ITEM_BLOCK) -> DataFrame:
    """(user, rank, item, score): the ``n`` best items of every user that
    ``excluded`` (user, item) doesn't name. ``users`` and ``items`` are
    (id, features) with unique ids."""
    if n < 1:
        raise ValueError("n must be >= 1")
    ublocks, n_ublocks = _blocks(users, user_block, "ub")
    iblocks, n_iblocks = _blocks(items, item_block, "ib")
    # excluded items by user and item block, to take so many more there
    pairs = (excluded.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item")).distinct()
             .join(items.select(F.col("id").alias("item")), "item", "left_semi")
             .join(users.select(F.col("id").alias("user")), "user", "left_semi"))
    more = (pairs.groupBy(F.pmod(F.xxhash64("user"), F.lit(n_ublocks)).cast("int").alias("ub"),
                          F.pmod(F.xxhash64("item"), F.lit(n_iblocks)).cast("int").alias("ib"), "user")
            .agg(F.count(F.lit(1)).alias("k")).groupBy("ub", "ib")
            .agg(F.sort_array(F.collect_list(F.struct("user", "k"))).alias("m"))
            .select("ub", "ib", F.transform("m", lambda m: m["user"]).alias("m_ids"),
                    F.transform("m", lambda m: m["k"]).alias("m_k")))
    copies = ublocks.withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(n_iblocks - 1))))
    met = copies.join(more, ["ub", "ib"], "left").join(iblocks, "ib")
    scored = (met.select("ub_ids", "ub_flat", "ib_ids", "ib_flat", "m_ids", "m_k")
              .mapInArrow(_best(n), "user int, item int, score double"))
    left = scored.join(pairs, ["user", "item"], "left_anti")
    order = [F.col("score").desc(), F.col("item").asc()]
    # a user's rows are n per item block: first by pieces of 64 blocks' worth
    salt = F.pmod(F.xxhash64("item"), F.lit(max(1, n_iblocks // 64))).alias("_rl_salt")
    first = Window.partitionBy("user", "_rl_salt").orderBy(*order)
    kept = (left.select("*", salt).withColumn("_rl_r", F.row_number().over(first))
            .where(F.col("_rl_r") <= n).drop("_rl_r", "_rl_salt"))
    return (kept.withColumn("rank", F.row_number().over(Window.partitionBy("user").orderBy(*order)))
            .where(F.col("rank") <= n).select("user", "rank", "item", "score"))
