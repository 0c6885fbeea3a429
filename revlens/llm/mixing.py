"""Mixing sources to target weights under a time-varying curriculum.

Targets: the words of all sources are shared by weight; a target stops at
``cap`` times its source's size and the excess is shared again by weight
until none is above (water filling, solved in closed form over the sorted
saturation points).

Positions: inside a source the documents stand in the order of a hash of
their id; copy ``e`` of a document covers a stretch of the source's demand.
Each source's weight moves linearly over training from ``start`` to ``end``
times its base; the integral of that schedule is the cumulative demand, and
inverting it at the start of a stretch gives the copy's position in
training. Copies are range-sorted by position and numbered.

Cumulative sizes come from a range-partitioned sort with per-partition
offsets, so a source with a third of all rows is still spread over tasks.

Defined results: null text has size 0 and takes 0 words; a null source is a
source of its own that sorts last; empty tables give no rows; repeated rows
are documents of their own (equal ones are interchangeable); other columns
are ignored whatever their names; a text of any length is one row's count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import BROADCAST_BYTES, col
from revlens.operators.indexing import prefix_sums, row_index
from revlens.session import write_table

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3
SOURCE_BYTES = 256     # of a row of the source table, as broadcast
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Ramp:
    """Weight at the start and at the end of training, times the base weight."""
    start: float = 1.0
    end: float = 1.0


# By rank of the source modulo 3: falling, level, rising.
RAMPS = (Ramp(1.5, 0.5), Ramp(1.0, 1.0), Ramp(0.5, 1.5))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_table(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP,
                 ramps: Sequence[Ramp] = RAMPS) -> tuple[DataFrame, int]:
    """((source, source_size, source_before, target, ramp0, ramp1) per source,
    number of sources); ``source_before`` are the words of the sources before it.

    Everything runs over rows of sources, however many there are. A source of
    weight w stops taking at the level ``cap * size / w``; in the order of
    these, the sources before one being full, what is left over the weights
    that are open is the level, and the first source that this level does not
    fill decides it.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("n")).withColumn("one", F.lit(1).cast("long"))
    numbered = prefix_sums(write_table(sums, "sources"), [F.col("source").asc_nulls_last()], ["one", "n"])
    rank = F.col("before_one")
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]),
                                       (rank % F.lit(len(values)) + 1).cast("int"))
    rows = write_table(numbered.select(
        "source", rank.alias("rank"), "n", F.col("before_n").alias("source_before"), pick(weights).alias("w"),
        pick([r.start for r in ramps]).alias("ramp0"), pick([r.end for r in ramps]).alias("ramp1"),
        (F.lit(cap) * F.col("n")).alias("full")), "source-ranks")
    all_ = rows.agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("rows")).first()
    if not all_["rows"]:
        return rows.select("source", F.col("n").alias("source_size"), "source_before",
                           F.lit(0.0).alias("target"), "ramp0", "ramp1"), 0
    order = [F.col("full") / F.col("w"), F.col("rank")]
    filling = prefix_sums(rows, order, ["full", "w"])
    open_w = F.lit(all_["w"]) - F.col("before_w")
    level = (F.lit(all_["n"]) - F.col("before_full")).cast("double") / open_w
    first = (filling.select(level.alias("level"), "w", "full", *[o.alias(f"o{i}") for i, o in enumerate(order)])
             .where(F.col("level") * F.col("w") <= F.col("full")).orderBy("o0", "o1").limit(1).collect())
    # with a cap of one and more the last source is never filled; below it all may be
    asked = F.lit(float(first[0]["level"])) * F.col("w") if first else F.col("full").cast("double")
    return rows.select("source", F.col("n").alias("source_size"), "source_before",
                       F.when(asked > F.col("full"), F.col("full").cast("double")).otherwise(asked).alias("target"),
                       "ramp0", "ramp1"), all_["rows"]


def invert_ramp(share: Column, a: Column, b: Column) -> Column:
    """Time at which a weight going linearly from a to b has met ``share``
    (0 to 1) of its whole demand (a + b) / 2."""
    need = share * (a + b) / 2
    root = (F.sqrt(F.greatest(a * a + 2 * (b - a) * need, F.lit(0.0))) - a) / (b - a)
    return F.least(F.greatest(F.when(a == b, share).otherwise(root), F.lit(0.0)), F.lit(1.0)) + F.lit(0.0)


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """(row, doc_id, source, size), written once so that texts are read once;
    ``row`` numbers the rows, whose ids may be null or repeated."""
    return write_table(docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("doc_id"),
                                   col(source_col).cast("string").alias("source"),
                                   word_count(col(text_col)).alias("size")), "sizes")


def plan_mix(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP,
             ramps: Sequence[Ramp] = RAMPS) -> DataFrame:
    """One row per document: row, doc_id, size, source_size, target, taken, copies,
    position (that of its first copy, 0 to 1), and what :func:`copies` needs."""
    table, n_sources = source_table(sized, weights, cap, ramps)
    order = [F.col("source").asc_nulls_last(), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
             F.col("doc_id").asc_nulls_last(), F.col("size")]
    summed = prefix_sums(sized, order, ["size"])
    # many sources are joined by a shuffle, in which a hot one is split
    side = F.broadcast(table) if n_sources * SOURCE_BYTES <= BROADCAST_BYTES else table
    rows = (summed.alias("d").join(side.alias("s"), F.expr("d.source <=> s.source"))
            .select("d.row", "d.doc_id", "d.source", "d.size", "source_size", "target", "ramp0", "ramp1",
                    (F.col("before_size") - F.col("source_before")).alias("before")))
    whole = F.floor(F.col("target")).cast("long")
    at = lambda e: F.col("before") + F.lit(e) * F.col("source_size")
    part = lambda e: F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), whole - at(e)))
    parts = F.array(*[part(e) for e in range(cap)])
    spot = lambda e: invert_ramp(at(e) / F.col("target"), F.col("ramp0"), F.col("ramp1"))
    return rows.select(
        "row", "doc_id", "source", "size", "source_size", "target", parts.alias("parts"),
        F.array(*[F.when(part(e) > 0, spot(e)) for e in range(cap)]).alias("spots")).select(
        "*", F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"),
        F.size(F.filter("parts", lambda x: x > 0)).cast("long").alias("copies"),
        F.element_at("spots", 1).alias("position"))


def copies(plan: DataFrame) -> DataFrame:
    """One row per copy that the mix takes: (row, doc_id, source, size, copy,
    words, position); ``words`` is how many of the document's words it takes."""
    return (plan.select("row", "doc_id", "source", "size",
                        F.posexplode(F.arrays_zip("parts", "spots")).alias("copy", "x"))
            .where("x.parts > 0")
            .select("row", "doc_id", "source", "size", "copy", F.col("x.parts").alias("words"),
                    F.col("x.spots").alias("position")))


def curriculum(plan: DataFrame) -> DataFrame:
    """The copies with their ``place`` in training (0 on): range-sorted by
    position, then document and copy; partitions follow the places."""
    return row_index(copies(plan), ["position", F.col("doc_id").asc_nulls_last(), "copy", "size", "row"], "place")


def training_places(plan: DataFrame) -> DataFrame:
    """``plan`` with the positions and the places in training of all of a
    document's copies (arrays, empty where the mix takes none)."""
    plan = write_table(plan, "mix")
    made = curriculum(plan).select("row", "copy", "position", "place")
    told = made.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("copy", "position", "place"))).alias("c"))
    return plan.join(told, "row", "left").select(
        *plan.columns, F.coalesce(F.transform("c", lambda c: c["position"]), F.array().cast("array<double>")).alias("positions"),
        F.coalesce(F.transform("c", lambda c: c["place"]), F.array().cast("array<long>")).alias("places"))
