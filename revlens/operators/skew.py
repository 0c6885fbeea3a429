"""Skew-safe equi join of a large fact table with a table keyed uniquely.

A single key may hold a large share of all fact rows (one user, one item).
A plain shuffle join sends all of them to one task. Here such hot keys are
found from a frequency table, their fact rows are spread over several salts,
and the matching table rows are copied once per salt. Every other key keeps
salt 0, i.e. an ordinary hash join.

A key is hot by its own number of rows, whatever share of the data that is,
so the bar doesn't rise with the input. The list of hot keys is broadcast
while it is short (counted); a longer one is joined. The table grows by the
number of salts of the hot keys only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALTS = "_rl_salts"
_SALT = "_rl_salt"


# Hot keys that are broadcast; more are joined.
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class SkewSpec:
    """When a key counts as hot and how finely its rows are spread."""
    min_rows: int = 1_000_000    # hot: at least this many rows
    rows_per_salt: int = 250_000 # target fact rows of one hot key per task


def hot_keys(freq: DataFrame, key: str, count_col: str,
             spec: SkewSpec = SkewSpec()) -> DataFrame:
    """(key, salts) for keys of ``freq`` (key, count) above the hot bar."""
    hot = freq.where(F.col(count_col) >= F.lit(spec.min_rows))
    salts = F.ceil(F.col(count_col) / F.lit(spec.rows_per_salt)).cast("int")
    return hot.select(key, F.greatest(salts, F.lit(1)).alias(_SALTS))


def salted_join(facts: DataFrame, table: DataFrame, key: str, hot: DataFrame,
                how: str = "inner") -> DataFrame:
    """``facts.join(table, key, how)`` with hot keys spread over salts.

    ``table`` must hold each key at most once. ``how`` is ``inner`` or
    ``left``. The salt of a fact row is a hash of its content, so a retried
    task puts every row in the same place again.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot_b = hot.select(key, _SALTS)
    if hot_b.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        hot_b = F.broadcast(hot_b)
    content = F.xxhash64(*[F.col(c) for c in facts.columns])
    tagged = (facts.join(hot_b, key, "left")
              .withColumn(_SALT, F.when(F.col(_SALTS).isNull(), F.lit(0))
                          .otherwise(F.pmod(content, F.col(_SALTS)).cast("int")))
              .drop(_SALTS))
    copies = F.when(F.col(_SALTS).isNull(), F.array(F.lit(0))) \
        .otherwise(F.sequence(F.lit(0), F.col(_SALTS) - 1))
    spread = (table.join(hot_b, key, "left")
              .withColumn(_SALT, F.explode(copies))
              .drop(_SALTS))
    return tagged.join(spread, [key, _SALT], how).drop(_SALT)
