"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of
prime size (an offset and a step drawn from its name; a step prime to the
size visits every slot). Shards take turns claiming their next free slot, so
each gets an equal part of the table (or a part in proportion to its weight),
and taking one shard away moves little but that shard's own slots. A row goes
to slot ``md5(key) mod size``; the table is broadcast (its size is a
parameter, not a function of the data), so placement costs one hash lookup
and no shuffle.

Defined results: a null key places like the empty string; equal keys share a
shard; empty tables give no rows; extra columns pass through unchanged, and
the added columns take further underscores if a name is taken. One key that
holds a third of all rows must stay on one shard; ``write_sharded`` still
spreads such a shard over many tasks and files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import col, fresh

TABLE_SIZE = 65_537
MAX_TABLE = 10_000_000  # rows of the broadcast table, 12 bytes each


def _draw(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}|{name}".encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE,
               weights: Sequence[float] | None = None) -> np.ndarray:
    """Shard index of every slot."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need distinct names, at least one")
    if not _is_prime(size) or len(shards) > size or size > MAX_TABLE:
        raise ValueError(f"the table size must be a prime from the number of shards to {MAX_TABLE}")
    w = np.ones(len(shards)) if weights is None else np.asarray(weights, float)
    if len(w) != len(shards) or not (w > 0).all():
        raise ValueError("weights must be positive, one per shard")
    gain = w / w.max()
    at = [_draw(s, "offset") % size for s in shards]
    step = [_draw(s, "step") % (size - 1) + 1 for s in shards]
    credit = [0.0] * len(shards)
    table, left = [-1] * size, size
    while left:
        for i in range(len(shards)):
            credit[i] += gain[i]
            if credit[i] < 1.0 or not left:
                continue
            credit[i] -= 1.0
            slot = at[i]
            while table[slot] >= 0:
                slot = (slot + step[i]) % size
            table[slot] = i
            at[i] = (slot + step[i]) % size
            left -= 1
    return np.array(table, np.int32)


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size))


def assign(df: DataFrame, key_col: str, shards: Sequence[str], size: int = TABLE_SIZE,
           weights: Sequence[float] | None = None, slot_col: str = "slot",
           shard_col: str = "shard") -> DataFrame:
    """``df`` with its slot and shard name added."""
    table = fill_table(shards, size, weights)
    slot, shard = fresh(df, slot_col), fresh(df, shard_col)
    lookup = df.sparkSession.createDataFrame(
        [(i, shards[s]) for i, s in enumerate(table.tolist())], f"`{slot}` long, `{shard}` string")
    placed = df.withColumn(slot, slot_of(col(key_col), size))
    return (placed.join(F.broadcast(lookup), slot, "inner")
            .select(*[col(c) for c in df.columns], col(slot), col(shard)))


def write_sharded(df: DataFrame, path: str, key_col: str, shards: Sequence[str],
                  size: int = TABLE_SIZE, weights: Sequence[float] | None = None,
                  tasks_per_shard: int = 4, rows_per_file: int = 1_000_000) -> None:
    """Write one folder per shard, ``shard=<name>``.

    Rows of a shard are dealt over ``tasks_per_shard`` tasks by their whole
    content, so a shard with a hot key doesn't end in one task.
    """
    placed = assign(df, key_col, shards, size, weights)
    shard = placed.columns[-1]
    salt = F.pmod(F.xxhash64(*[col(c) for c in df.columns]), F.lit(tasks_per_shard))
    (placed.repartition(len(shards) * tasks_per_shard, col(shard), salt)
     .write.option("maxRecordsPerFile", rows_per_file).partitionBy(shard).parquet(path))
