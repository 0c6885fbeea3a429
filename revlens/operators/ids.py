"""String ids -> dense 0-based int ids, and the strict lookup join.

Ids follow the sort order of the key (no set-order dependence), so reruns
and repartitioned inputs give the same numbers. Null keys are never
numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.operators.indexing import row_index
from revlens.operators.skew import SkewSpec, hot_keys, salted_join
from revlens.session import pin

INT_MAX = 2**31 - 1
FREQ = "n_rows"


def _as_int_id(idx: Column, what: str) -> Column:
    """Cast a position to int; more than 2^31 keys is a clear error."""
    return F.when(idx <= F.lit(INT_MAX), idx.cast("int")).otherwise(
        F.raise_error(F.lit(f"more than {INT_MAX + 1} distinct {what}: "
                            "ids do not fit the int ids ALS needs")))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, n_rows) for every non-null key: distinct keys and their weight."""
    return (df.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias(FREQ)))


def key_frequencies(df: DataFrame, keys: list[str]) -> dict[str, DataFrame]:
    """(key, n_rows) frames for several key columns from one scan of ``df``.

    One grouping-sets aggregate (map-side partial counts, so a hot key
    collapses before the shuffle), pinned once; each frame is then a cheap
    filter of the pinned result. Null keys are dropped.
    """
    counted = (df.groupingSets([[k] for k in keys], *keys)
               .agg(F.count(F.lit(1)).alias(FREQ), F.grouping_id().alias("_rl_gid")))
    pinned = pin(counted)
    out = {}
    for i, k in enumerate(keys):
        gid = sum(1 << (len(keys) - 1 - j) for j in range(len(keys)) if j != i)
        out[k] = (pinned.where((F.col("_rl_gid") == gid) & F.col(k).isNotNull())
                  .select(k, FREQ))
    return out


def number_keys(keys: DataFrame, key: str, id_col: str) -> DataFrame:
    """Number a frame whose ``key`` is already distinct; keeps other columns."""
    indexed = row_index(keys, [F.col(key).asc()], "_rl_idx")
    return indexed.select(*keys.columns, _as_int_id(F.col("_rl_idx"), key).alias(id_col))


def dense_ids(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """(key, id_col): distinct non-null keys numbered 0..k-1 in key order."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return number_keys(keys, key, id_col)


def encode(facts: DataFrame, ids: DataFrame, key: str, id_col: str,
           on_missing: str = "error", hot: DataFrame | None = None) -> DataFrame:
    """Append ``id_col`` to every fact row by joining with ``ids``.

    ``on_missing='error'`` fails the query on the first key that has no id
    (unknown or null), inside the same pass; ``'drop'`` removes those rows.
    ``hot`` (from :func:`revlens.operators.skew.hot_keys`) spreads hot keys.
    """
    if on_missing not in ("error", "drop"):
        raise ValueError("on_missing is 'error' or 'drop'")
    how = "left" if on_missing == "error" else "inner"
    table = ids.select(key, id_col)
    joined = (salted_join(facts, table, key, hot, how) if hot is not None
              else facts.join(table, key, how))
    if on_missing == "error":
        missing = F.raise_error(F.concat(
            F.lit(f"no id for {key} "),
            F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        joined = joined.withColumn(
            id_col, F.when(F.col(id_col).isNull(), missing).otherwise(F.col(id_col)))
    return joined.select(*facts.columns, id_col)


def orphans(facts: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no id (unknown or null key)."""
    return facts.join(ids.select(key), key, "left_anti")


def hot_ids(freq: DataFrame, key: str, spec: SkewSpec) -> DataFrame:
    """Hot keys of a (key, n_rows) frame, for :func:`encode`."""
    return hot_keys(freq, key, FREQ, spec)
