"""Positions in a total order, computed without funnelling rows into one task.

``row_number()`` over a window with no partition moves every row into a
single task. Instead the rows are range-partitioned and sorted (a normal
distributed sort), pinned with a reliable checkpoint so the partition
boundaries cannot change between jobs, and numbered as
``offset of the partition + position inside it``. The offsets come from one
small job that counts rows per partition: one value per partition, the same
bounded driver trip ``RDD.zipWithIndex`` makes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import pin, write_table

_PID = "_rl_pid"
_MID = "_rl_mid"


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _sorted_and_tagged(df: DataFrame, order: Sequence[Column | str],
                       num_partitions: int | None, compact: bool = False) -> DataFrame:
    order = _cols(order)
    if num_partitions:
        ordered = df.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
    else:
        ordered = df.orderBy(*order)
    tags = ["*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID)]
    # written with their tags the rows may be read in any partitions
    return write_table(ordered.select(*tags), "ordered", "zstd") if compact else pin(ordered).select(*tags)


def _per_partition_base(tagged: DataFrame, extra: Sequence[Column] = ()) -> list:
    """Collect one small row per partition, ordered by partition index."""
    return (tagged.groupBy(_PID)
            .agg(F.count(F.lit(1)).alias("n"), F.min(_MID).alias("first"), *extra)
            .orderBy(_PID)
            .collect())


def row_index(df: DataFrame, order: Sequence[Column | str], idx_col: str = "idx",
              num_partitions: int | None = None, compact: bool = False) -> DataFrame:
    """Append the 0-based position of each row in ``order`` (a total order).

    With ties the positions of tied rows are arbitrary but distinct; callers
    that need determinism pass an order that is a key. ``compact``: the sorted
    rows are kept as a compressed table, not as a checkpoint, whose rows are
    several times as large.
    """
    tagged = _sorted_and_tagged(df, order, num_partitions, compact)
    parts = _per_partition_base(tagged)
    if not parts:
        return df.select("*", F.lit(None).cast("long").alias(idx_col)).limit(0)
    # base[pid] turns the monotonically increasing id into a global position.
    base = [0] * (parts[-1][_PID] + 1)
    running = 0
    for row in parts:
        base[row[_PID]] = running - row["first"]
        running += row["n"]
    idx = F.col(_MID) + F.element_at(F.lit(base), F.col(_PID) + 1)
    return tagged.select(*[F.col(c) for c in df.columns], idx.alias(idx_col))


def prefix_sums(df: DataFrame, order: Sequence[Column | str], values: Sequence[str],
                prefix: str = "before_", num_partitions: int | None = None) -> DataFrame:
    """Append, for each value column, the sum over all rows strictly before
    the row in ``order`` (``order`` must be a key of ``df``).

    Across partitions: offsets from one small per-partition job. Inside a
    partition: a running window over that partition only, so each window
    group is one range partition, never the whole table.
    """
    tagged = _sorted_and_tagged(df, order, num_partitions)
    parts = _per_partition_base(tagged, [F.sum(v).alias(v) for v in values])
    n_parts = (parts[-1][_PID] + 1) if parts else 1
    offsets = {v: [0] * n_parts for v in values}
    running = {v: 0 for v in values}
    for row in parts:
        for v in values:
            offsets[v][row[_PID]] = running[v]
            running[v] += row[v] or 0
    inside = Window.partitionBy(_PID).orderBy(_MID).rowsBetween(
        Window.unboundedPreceding, -1)
    out = [F.col(c) for c in df.columns]
    for v in values:
        before_here = F.coalesce(F.sum(v).over(inside), F.lit(0))
        off = F.element_at(F.lit(offsets[v]), F.col(_PID) + 1)
        out.append((before_here + off).alias(prefix + v))
    return tagged.select(*out)
