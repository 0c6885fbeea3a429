"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products.

Vectors are normalised in double precision; equal vectors of a label are one
row with a count. Labels with more than ``CELL_ROWS`` different vectors get
cells by spherical k-means, fitted on a bounded sample; each vector lives in
its nearest cell. Whether x can have a partner y in another cell follows from
geometry: if x.y >= s, then y lies in cell c' and not in x's cell c only if
x.(c - c') <= (sqrt(1 - s^2) / s) |(c' - c) without its part along x|. So x
visits exactly the cells that pass this bound, and no link is lost. Clustered
vectors visit few cells; vectors without clusters visit many. A cell that
still holds more than ``SPLIT_ROWS`` vectors is divided once more in the same
way, by centroids that are never broadcast.

A cell is worked off in blocks: each pair of (visiting block, resident block)
is one matrix product in one task, which returns the number of links per
vector and at most one edge per vector that keeps its block connected -
never the pairs themselves. Components come from distributed star rounds.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and rows with a null label, have no links and are components of
their own; a null id is kept as null with no links; rows that repeat a vec_id
get the same result each; vectors of different lengths are never compared;
other columns are ignored whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import byte_column, col, components, flat_ranges, mix64, tidy
from revlens.session import write_table

THRESHOLD = 0.93
CELL_ROWS = 4096        # different vectors a cell holds on average
BLOCK_ROWS = 4096       # rows of a block of a cell
FIT_ROWS = 20_000       # different vectors the k-means is fitted on, over all labels
MAX_CELLS = 4096        # centroids over all labels: the broadcast bound
SPLIT_ROWS = 1 << 16    # residents beyond which a cell gets cells of its own
INNER_CELLS = 256       # at most this many
INNER_FIT = 20_000      # residents they are fitted on
ROUNDS = 8
SLICE = 512
PLACED = ["label", "cell", "home", "rep", "mult", "vec"]
PLACED_TYPES = "label string, cell int, home boolean, rep long, mult long, vec binary"


def unit_vectors(array: pa.Array) -> pa.Array:
    """Bytes of each list's unit vector in double precision; null if it has none."""
    size = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(array.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    usable = np.zeros(len(size), bool)
    found = []
    for length in np.unique(size[size > 0]).tolist():  # nearly always one length
        rows = np.flatnonzero(size == length)
        x = flat[flat_ranges(start[rows], size[rows])].reshape(-1, length)
        top = np.abs(x).max(1)
        has = np.isfinite(x).all(1) & (top > 0)
        x = x[has] / top[has, None]  # so that squares can't over- or underflow
        usable[rows[has]] = True
        found.append((rows[has], x / np.sqrt((x * x).sum(1))[:, None] + 0.0))
    size = np.where(usable, size, 0)
    offsets = np.concatenate([[0], np.cumsum(size)])
    body = np.empty(offsets[-1], np.float64)
    for rows, x in found:
        body[flat_ranges(offsets[rows], size[rows])] = x.ravel()
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [
        pa.array(usable).buffers()[1], pa.py_buffer((offsets * 8).astype(np.int64)), pa.py_buffer(body)])
    return raw.cast(pa.binary())


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of vectors of one length."""
    raw, _ = byte_column(vectors)
    return np.frombuffer(raw.tobytes()).reshape(len(vectors), -1)


def normalised(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, vec): ``vec`` the unit vector's bytes, null if it has none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), unit_vectors(batch.column(2))],
                                             ["id", "label", "vec"])

    return (df.select(col(id_col).cast("long").alias("id"), col(label_col).cast("string").alias("label"),
                      col(vec_col).alias("vec")).mapInArrow(tidy(run), "id long, label string, vec binary"))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k unit centroids of unit rows; deterministic."""
    order = np.argsort(mix64(np.arange(len(x), dtype=np.uint64)), kind="stable")
    centre = x[order[:k]]
    for _ in range(rounds):
        near = np.concatenate([(x[i:i + SLICE] @ centre.T).argmax(1) for i in range(0, len(x), SLICE)])
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        size = np.sqrt((total ** 2).sum(1))
        centre = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], centre)
    return centre


def fit_cells(unique: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Centroids by (label, bytes of a vector) of the groups that need cells.

    The number of cells follows the group's size up to MAX_CELLS over all
    groups; beyond that cells grow and :func:`split_large_cells` divides them.
    """
    groups = (unique.groupBy("label", F.length("vec").alias("bytes")).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > CELL_ROWS).orderBy(F.desc("n"), "label", "bytes").limit(MAX_CELLS // 2).collect())
    if not groups:
        return {}
    total = sum(r["n"] for r in groups)
    scale = min(1.0, MAX_CELLS / sum(-(-r["n"] // CELL_ROWS) for r in groups))
    every = max(1, -(-total // FIT_ROWS))
    big = F.broadcast(unique.sparkSession.createDataFrame([(r["label"], r["bytes"]) for r in groups],
                                                          "label string, bytes int"))
    drawn = (unique.withColumn("bytes", F.length("vec")).join(big, ["label", "bytes"], "left_semi")
             .where(F.pmod(F.xxhash64("vec"), F.lit(every)) == 0)
             .select("label", "bytes", "vec").orderBy("label", "bytes", F.xxhash64("vec"), "vec").collect())
    sample: dict[tuple[str, int], list[bytes]] = {}
    for r in drawn:
        sample.setdefault((r["label"], r["bytes"]), []).append(bytes(r["vec"]))
    out = {}
    for r in groups:
        rows = sample.get((r["label"], r["bytes"]), [])
        k = min(len(rows), max(1, int(-(-r["n"] // CELL_ROWS) * scale)))
        if k > 1:
            out[(r["label"], r["bytes"])] = spherical_kmeans(np.frombuffer(b"".join(rows)).reshape(len(rows), -1), k)
    return out


def visits(x: np.ndarray, centre: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, whether it is the row's own) of every cell a row of ``x``
    has to be compared in."""
    reach = np.sqrt(1 - threshold ** 2) / threshold
    gram = centre @ centre.T
    norm = np.diag(gram)
    out = []
    for lo in range(0, len(x), SLICE):
        dots = x[lo:lo + SLICE] @ centre.T
        own = dots.argmax(1)
        gap = dots[np.arange(len(own)), own][:, None] - dots
        apart = norm[own][:, None] + norm[None, :] - 2 * gram[own]
        across = np.sqrt(np.maximum(apart - gap ** 2, 0.0))
        d, c = np.nonzero(gap <= reach * across + 1e-9)  # holds for its own cell, too
        out.append((d + lo, c, own[d] == c))
    return tuple(np.concatenate(part) for part in zip(*out))


def _assign(cells, threshold: float):
    """One row per cell a vector is compared in; ``home`` marks its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            names = batch.column(1).dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.diff(byte_column(batch.column(2))[1])
            rows, cell, home = [], [], []
            kinds, kind = np.unique(np.stack([code, size]), axis=1, return_inverse=True)
            for k, (c, n_bytes) in enumerate(kinds.T.tolist()):
                members = np.flatnonzero(kind.ravel() == k)
                centre = cells.value.get((names.dictionary[c].as_py(), n_bytes))
                if centre is None:
                    at, c_, own = np.arange(len(members)), np.zeros(len(members), np.int64), np.ones(len(members), bool)
                else:
                    at, c_, own = visits(matrix(batch.column(2).take(pa.array(members))), centre, threshold)
                rows.append(members[at])
                cell.append(c_)
                home.append(own)
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(take), pa.array(np.concatenate(cell).astype(np.int32)),
                 pa.array(np.concatenate(home)), *(batch.column(k).take(take) for k in (0, 3, 2))],
                ["label", "cell", "home", "rep", "mult", "vec"])

    return run


def _fit_inner(table: pa.Table) -> pa.Table:
    """Centroids of a sample of one cell's residents, as one row."""
    x = matrix(table.column("vec"))
    order = np.argsort(table.column("rep").to_numpy(), kind="stable")
    k = min(len(x), table.column("k")[0].as_py())
    centre = spherical_kmeans(x[order], k)
    return pa.table({**{c: table.column(c).slice(0, 1) for c in ("label", "cell", "bytes")},
                     "centre": pa.array([centre.tobytes()], pa.binary())})


def _assign_inner(threshold: float):
    """A block of a cell's rows and the cell's inner centroids -> inner cells."""
    def run(rows: pa.Table, fitted: pa.Table) -> pa.Table:
        rows = rows.select(PLACED)
        if not len(rows):
            return rows.append_column("inner", pa.array([], pa.int32()))
        x = matrix(rows.column("vec"))
        at, cell, own = visits(x, matrix(fitted.column("centre")).reshape(-1, x.shape[1]), threshold)
        out = rows.take(pa.array(at))
        home = out.column("home").to_numpy(zero_copy_only=False).astype(bool) & own
        out = out.set_column(PLACED.index("home"), "home", pa.array(home))
        return out.append_column("inner", pa.array(cell.astype(np.int32)))

    return run


def split_large_cells(placed: DataFrame, threshold: float) -> DataFrame:
    """``placed`` with a column ``inner``: cells of more than ``SPLIT_ROWS``
    residents get cells of their own, fitted cell by cell on a bounded sample,
    so that the number of cells goes on growing beyond what is broadcast.

    The bound holds for any centroids, so again no link is lost. Centroids of
    a cell meet its rows block by block, in tasks of at most about a block.
    """
    keys = ["label", "cell", "bytes"]
    placed = placed.withColumn("bytes", F.length("vec"))
    large = (placed.groupBy(*keys).agg(F.count_if("home").alias("residents"), F.count(F.lit(1)).alias("visitors"))
             .where(F.col("residents") > SPLIT_ROWS))
    large = write_table(large.select(*keys, F.ceil(F.col("visitors") / BLOCK_ROWS).cast("int").alias("blocks"),
                                     F.least(F.lit(INNER_CELLS), F.ceil(F.col("residents") / CELL_ROWS)).cast("int")
                                     .alias("k"), F.ceil(F.col("residents") / INNER_FIT).alias("every")), "large")
    if large.isEmpty():
        return placed.select(*PLACED, F.lit(0).alias("inner"))
    drawn = (placed.where("home").join(large, keys)
             .where(F.pmod(F.xxhash64("vec"), F.col("every")) == 0).select(*keys, "rep", "vec", "k"))
    fitted = write_table(drawn.groupBy(*keys).applyInArrow(
        _fit_inner, "label string, cell int, bytes int, centre binary"), "fitted")
    fitted = fitted.join(large, keys)
    block = F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks")).cast("int").alias("block")
    rows = placed.join(fitted.select(*keys, "blocks"), keys).select(*PLACED, "bytes", block)
    each = fitted.select(*keys, "centre", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    inner = (rows.groupBy(*keys, "block").cogroup(each.groupBy(*keys, "block"))
             .applyInArrow(_assign_inner(threshold), PLACED_TYPES + ", inner int"))
    rest = placed.join(fitted.select(*keys), keys, "left_anti").select(*PLACED, F.lit(0).alias("inner"))
    return write_table(rest.unionByName(inner), "inner")


def _roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Smallest reachable node after adding edges (a, b) to labels ``root``."""
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root == before).all():
            return root


def _compare(threshold: float):
    """Links per visiting vector and a spanning forest of a block pair."""
    def run(table: pa.Table) -> pa.Table:
        reps = table.column("rep").to_numpy()
        mult = table.column("mult").to_numpy()
        side = table.column("resident").to_numpy(zero_copy_only=False).astype(bool)
        x = matrix(table.column("vec"))
        order = np.argsort(reps, kind="stable")  # local numbers follow the ids, so roots are smallest ids
        local = np.empty(len(reps), np.int64)
        nodes = np.unique(reps)
        local[order] = np.searchsorted(nodes, reps[order])
        here, there = np.flatnonzero(side), np.flatnonzero(~side)
        root = np.arange(len(nodes))
        links = np.zeros(len(there), np.int64)
        home = np.ascontiguousarray(x[here].T)
        for lo in range(0, len(there), SLICE):
            part = there[lo:lo + SLICE]
            q, h = np.nonzero(x[part] @ home >= threshold)
            a, b = local[part[q]], local[here[h]]
            other = a != b
            links[lo:lo + SLICE] = np.bincount(q[other], mult[here[h[other]]], len(part)).astype(np.int64)
            root = _roots(len(nodes), a[other], b[other], root)
        child = np.flatnonzero(root != np.arange(len(nodes)))
        counted = there[links > 0]
        return pa.table({"a": pa.array(np.concatenate([reps[counted], nodes[child]])),
                         "b": pa.array(np.concatenate([np.full(len(counted), -1), nodes[root[child]]]),
                                       mask=np.arange(len(counted) + len(child)) < len(counted)),
                         "links": pa.array(np.concatenate([links[links > 0], np.zeros(len(child), np.int64)]))})

    return run


def dedup(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
          threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    spark = df.sparkSession
    rows = write_table(normalised(df, id_col, vec_col, label_col), "vectors")
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
    unique = write_table(rows.where(usable).groupBy("label", "vec")
                         .agg(F.min("id").alias("rep"), F.count_distinct("id").alias("mult"))
                         .select("rep", "label", "vec", "mult"), "unique")
    cells = spark.sparkContext.broadcast(fit_cells(unique))
    placed = write_table(unique.mapInArrow(tidy(_assign(cells, threshold)), PLACED_TYPES), "placed")
    placed = split_large_cells(placed, threshold)
    # Blocks: residents by resident block, visitors (residents visit, too) by visiting block.
    counts = (placed.groupBy("label", "cell", "inner", F.length("vec").alias("bytes"))
              .agg(F.count(F.lit(1)).alias("nv"), F.count_if("home").alias("nr"))
              .select("label", "cell", "inner", "bytes", F.ceil(F.col("nv") / BLOCK_ROWS).cast("int").alias("bv"),
                      F.ceil(F.col("nr") / BLOCK_ROWS).cast("int").alias("br")).where("br > 0 AND nv > 1"))
    dealt = placed.withColumn("bytes", F.length("vec")).join(counts, ["label", "cell", "inner", "bytes"])
    spread = F.xxhash64("rep")
    other = lambda n: F.sequence(F.lit(0), n - 1)
    visit = dealt.select("label", "cell", "inner", "bytes", "rep", "mult", "vec", F.lit(False).alias("resident"),
                         F.pmod(spread, F.col("bv")).cast("int").alias("vb"), F.explode(other(F.col("br"))).alias("rb"))
    live = dealt.where("home").select("label", "cell", "inner", "bytes", "rep", "mult", "vec",
                                      F.lit(True).alias("resident"),
                                      F.explode(other(F.col("bv"))).alias("vb"),
                                      F.pmod(spread, F.col("br")).cast("int").alias("rb"))
    found = write_table(visit.unionByName(live).groupBy("label", "cell", "inner", "bytes", "vb", "rb")
                        .applyInArrow(_compare(threshold), "a long, b long, links long"), "links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL")).select(F.col("node").alias("rep"), "root")
    classes = (unique.select("label", "vec", "rep", "mult").join(links, "rep", "left").join(roots, "rep", "left")
               .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                       F.coalesce("root", "rep").alias("component_id")))
    out = rows.withColumn("usable", usable).alias("r").join(
        classes.alias("c"), F.expr("r.usable AND r.label = c.label AND r.vec = c.vec"), "left")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"))
