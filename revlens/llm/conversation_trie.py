"""Prefix trie of conversations by double arrays, one per prefix shard.

Turns are named by 128 bits of the SHA-256 of role and text; a conversation is
its sequence of names. Equal sequences are one row with its number of members
and its smallest one. Those rows are range-sorted by their sequences, so a shard (a
partition, in chunks) holds whole subtrees but for the prefixes of its first
and last sequence, which its neighbours may hold as well; a prefix that very
many sequences share is spread over as many shards as its rows need.

In a shard turn names become dense ids, in the order in which a walk by
levels meets them, and the sequences are packed into a double array: the
child of node ``s`` by id ``c`` is slot ``BASE[s] + c``, and ``CHECK`` of that
slot is ``s``. Aggregates come from walking the sequences through the arrays
and summing from the deepest level up. Nodes of one shard only are final. The
shared upper nodes meet in a grouped aggregate: their members add up, their
own tokens and whether they are leaves are known then, and each shard is told
once more what to add to the nodes above.

The member ids of a sequence are joined to blocks of neighbouring ids in
parallel; a task streams the blocks through SHA-256, which has no parallel
form, so a hot sequence costs one task its blocks, not its rows.

Defined results: turns with equal numbers stand in the order of their names;
repeated rows are turns of their own; rows without a conversation id belong to
none; null role and text are empty; other columns are ignored whatever their
names; an empty table gives no rows. A conversation's turns (20 bytes each)
meet in one task, as a document's words do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import byte_column, col, runs, task_count, tasks_for, tidy
from revlens.session import write_table

SHARED = 20              # conversations from c - c % SHARED on take their first turns from that one
HEAD = 4                 # so many at most, less one
SHARD_TURNS = 1 << 18    # turns of the sequences that share a double array (more if a sequence has more)
TURN_BYTES = 24          # a shuffled turn: name and number of words
MEMBER_BYTES = 48        # a shuffled member: id and name of its sequence
MEMBER_BITS = 13         # members whose ids agree above so many bits are one block
PROBES = 64              # free slots tried for a node's children before the arrays are extended
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()


# -- conversations -----------------------------------------------------------------

def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, turns): every conversation's turns in order, each a struct of
    its name and its number of words."""
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # the role's length keeps role and text apart
    name = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256),
                               1, 32))
    rows = turns.select(col(conv_col).cast("long").alias("conv"), col(turn_col).alias("turn"),
                        name.alias("name"), F.regexp_count(text, F.lit(WORD)).alias("words")).where("conv IS NOT NULL")
    order = F.struct(F.col("turn").isNotNull().alias("given"), "turn", "name", "words")
    return (rows.groupBy("conv").agg(F.sort_array(F.collect_list(order)).alias("t"))
            .select("conv", F.transform("t", lambda t: F.struct(t["name"].alias("name"), t["words"].alias("words")))
                    .alias("turns")))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations whose first h turns are those of conversation
    ``c - c % SHARED`` (h = crc32 of the decimal id, modulo HEAD)."""
    first = F.col("conv") - F.col("conv") % F.lit(SHARED)
    heads = convs.where(F.col("conv") % F.lit(SHARED) == 0).select(
        F.col("conv").alias("first"), F.slice("turns", 1, HEAD - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEAD)).cast("int")
    both = convs.withColumn("first", first).withColumn("h", h).join(heads, "first", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return both.select("conv", F.concat(head, own).alias("turns"))


def sequences(convs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """((names, words, conv, n, seq), (seq, ends), partitions): distinct
    sequences with their smallest member and number of members; the hash of
    the members' ids; partitions for a shuffle of the sequences."""
    names = F.transform("turns", lambda t: t["name"])
    # names have one length, so their hexadecimal digits in a row tell sequences apart
    seq = F.unhex(F.sha2(F.array_join(F.transform(names, lambda n: F.hex(n)), "").cast("binary"), 256))
    rows = write_table(convs.select("conv", names.alias("names"), F.transform("turns", lambda t: t["words"]).alias("words"),
                                    seq.alias("seq")), "sequences")
    distinct = (rows.groupBy("seq").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"))
                .join(rows.select("conv", "names", "words"), "conv"))
    parts = task_count(rows, F.size("names") * TURN_BYTES + MEMBER_BYTES, 1)
    return distinct, member_hashes(rows.select("seq", "conv")), parts


def member_hashes(rows: DataFrame) -> DataFrame:
    """(seq, ends): SHA-256 of the ids of a sequence's members, ascending,
    joined by commas."""
    blocks = (rows.groupBy("seq", F.shiftright("conv", MEMBER_BITS).alias("block"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
                   .alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for seq, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if seq != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = seq, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if done:
                yield row(done)
        if digest is not None:
            yield row([(now, digest.hexdigest())])

    def row(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([s for s, _ in done], pa.binary()),
                                           pa.array([h for _, h in done])], ["seq", "ends"])

    parts = tasks_for(rows.sparkSession, rows.count() * MEMBER_BYTES)
    return (blocks.repartition(parts, "seq").sortWithinPartitions("seq", "block").select("seq", "ids")
            .mapInArrow(tidy(run), "seq binary, ends string"))


# -- double arrays -----------------------------------------------------------------

class DoubleArray:
    """Trie of sequences of dense ids 1, 2, ... in BASE and CHECK.

    ``check[slot]`` is the parent's slot, -1 where the slot is free; slot 0 is
    the root. Built level by level from sorted, distinct sequences.
    """

    def __init__(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray, symbols: int):
        self.base = np.zeros(symbols + 2, np.int64)
        self.check = np.full(symbols + 2, -1, np.int64)
        self.check[0] = 0
        self.free = 1                              # no free slot before this one
        self.used = 1                              # no taken slot from this one on
        node = np.zeros(len(begin), np.int64)
        self.levels = [np.zeros(1, np.int64)]
        depth = 0
        live = np.flatnonzero(size > 0)
        while len(live):
            parent, code = node[live], codes[begin[live] + depth]
            order = np.lexsort((code, parent))
            p, c = parent[order], code[order]
            new = np.concatenate([[True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])])
            self._add(p[new], c[new])
            node[live] = self.base[parent] + code
            self.levels.append(self.base[p[new]] + c[new])
            depth += 1
            live = live[size[live] > depth]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))

    def _add(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Children of a level's nodes (sorted by parent, code): first the
        nodes of several children, then all of one in the slots left."""
        first = runs(parents)
        count = np.diff(np.append(first, len(parents)))
        for k, n in zip(first[count > 1].tolist(), count[count > 1].tolist()):
            self._place(int(parents[k]), codes[k:k + n])
        single = first[count == 1]
        if len(single):
            self._grow(self.used + len(single) + 1)
            open_ = np.flatnonzero(self.check[self.free:self.used] < 0)[:len(single)] + self.free
            slots = np.concatenate([open_, self.used + np.arange(len(single) - len(open_))])
            self.base[parents[single]] = slots - codes[single]
            self.check[slots] = parents[single]
            self.used = max(self.used, int(slots[-1]) + 1)
            self._forward()

    def _place(self, parent: int, codes: np.ndarray) -> None:
        span = int(codes[-1] - codes[0]) + 1
        self._grow(self.used + span + 1)
        tried = np.flatnonzero(self.check[self.free:self.used] < 0)[:PROBES] + self.free
        offset = codes - codes[0]
        at = self.used
        for slot in tried.tolist():
            if slot + span <= len(self.check) and (self.check[slot + offset] < 0).all():
                at = slot
                break
        self.base[parent] = at - codes[0]
        self.check[at + offset] = parent
        self.used = max(self.used, at + span)
        self._forward()

    def _forward(self) -> None:
        while self.free < self.used and self.check[self.free] >= 0:
            step = np.flatnonzero(self.check[self.free:self.free + 4096] < 0)
            self.free += int(step[0]) if len(step) else min(4096, self.used - self.free)

    def walk(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sequences, their nodes) by depth from the root on; a step that
        CHECK refutes ends a sequence's walk."""
        live, node, depth = np.arange(len(begin)), np.zeros(len(begin), np.int64), 0
        yield live, node
        while True:
            going = size[live] > depth
            live, node = live[going], node[going]
            if not len(live):
                return
            step = self.base[node] + codes[begin[live] + depth]
            inside = (step >= 0) & (step < len(self.check))
            ok = inside.copy()
            ok[inside] = self.check[step[inside]] == node[inside]
            ok &= step > 0
            live, node = live[ok], step[ok]
            depth += 1
            if len(live):
                yield live, node


def dense_ids(names: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, int]:
    """(1-based id of every name, number of ids): numbered level by level, so
    that children of one node mostly get neighbouring ids."""
    keys, which = np.unique(names, return_inverse=True)
    which = which.ravel()
    level = np.arange(len(names)) - np.repeat(begin, size)
    met = np.full(len(keys), np.iinfo(np.int64).max)
    # of every name, its least (level, place)
    rank = level * (len(names) + 1) + np.arange(len(names))
    np.minimum.at(met, which, rank)
    ids = np.empty(len(keys), np.int64)
    ids[np.argsort(met)] = np.arange(1, len(keys) + 1)
    return ids[which], len(keys)


NODES = ("chunk long, name binary, up binary, side int, depth int, conv_id long, up_conv long, words long, n_convs long, "
         "n_children long, n_leaves long, saved long, ends binary, open boolean")


def _shard(shard_turns: int):
    """Rows sorted by their sequences -> the nodes of each chunk's trie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, number = 0, 0
        for batch in batches:
            lengths = np.diff(batch.column(0).offsets.to_numpy())
            lo = 0
            while lo < len(batch):   # cut where the chunk is full
                total = size + np.cumsum(lengths[lo:])
                hi = lo + min(int(np.searchsorted(total, shard_turns)) + 1, len(batch) - lo)
                held.append(batch.slice(lo, hi - lo))
                size = int(total[hi - lo - 1])
                if size >= shard_turns:
                    yield build(pa.Table.from_batches(held), number)
                    held, size, number = [], 0, number + 1
                lo = hi
        if held:
            yield build(pa.Table.from_batches(held), number)

    def build(table: pa.Table, number: int) -> pa.RecordBatch:
        table = table.combine_chunks()
        names, words, conv, mult, part, seq = (table.column(k).chunk(0) for k in range(6))
        size = pc.list_value_length(names).to_numpy().astype(np.int64)
        begin = np.cumsum(size) - size
        flat = np.ascontiguousarray(byte_column(names.flatten())[0]).view("S16")
        told = words.flatten().to_numpy().astype(np.int64)
        conv, mult = conv.to_numpy(), mult.to_numpy()
        codes, symbols = dense_ids(flat, begin, size)
        trie = DoubleArray(codes, begin, size, symbols)
        slots = len(trie.check)
        least = np.full(slots, np.iinfo(np.int64).max)
        members, tokens, level = np.zeros(slots, np.int64), np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        ends, seen = np.full(slots, -1, np.int64), np.zeros(slots, bool)
        for depth, (live, node) in enumerate(trie.walk(codes, begin, size)):
            np.minimum.at(least, node, conv[live])
            np.add.at(members, node, mult[live])
            level[node], seen[node] = depth, True
            if depth:
                tokens[node] = told[begin[live] + depth - 1]
            ends[node[size[live] == depth]] = live[size[live] == depth]
        # the first and the last sequence's nodes may have members in other shards
        shared = np.full(slots, -1, np.int64)     # 0: on the first's path only, 1: the last's only, 2: both
        paths = []
        for k in (0, len(size) - 1):
            row = slice(k, k + 1)
            path = np.array([n[0] for _, n in trie.walk(codes, begin[row], size[row])], np.int64)
            paths.append((k, path))
        shared[paths[0][1]] = 0
        last = paths[1][1]
        shared[last] = np.where(shared[last] == 0, 2, 1)
        closed = seen & (shared < 0)
        kids, leaves, saved = (np.zeros(slots, np.int64) for _ in range(3))
        for nodes in reversed(trie.levels):
            nodes = nodes[closed[nodes]]          # what open nodes add comes after the merge
            up = trie.check[nodes]
            leaves[nodes] += kids[nodes] == 0
            saved[nodes] += (members[nodes] - 1) * tokens[nodes]
            np.add.at(kids, up, 1)
            np.add.at(leaves, up, leaves[nodes])
            np.add.at(saved, up, saved[nodes])
        for nodes in reversed(trie.levels):       # subtree sums of closed nodes for the open ones
            nodes = nodes[shared[nodes] >= 0]
            nodes = nodes[nodes > 0]
            np.add.at(leaves, trie.check[nodes], leaves[nodes])
            np.add.at(saved, trie.check[nodes], saved[nodes])
        name: dict[int, bytes] = {0: b""}         # of open nodes: a digest of their prefix
        for k, path in paths:
            digest = hashlib.sha256()
            for depth, slot in enumerate(path[1:].tolist()):
                digest.update(bytes(flat[begin[k] + depth]).ljust(16, b"\0"))
                name[slot] = digest.digest()
        nodes = np.flatnonzero(seen)
        up = trie.check[nodes]
        is_open = shared[nodes] >= 0
        top = nodes == 0
        parent_open = (shared[up] >= 0) & ~top
        seqs = seq.to_pylist()
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(nodes), (int(part[0].as_py()) << 32) + number)),
            pa.array([name[s] if o else None for s, o in zip(nodes.tolist(), is_open.tolist())], pa.binary()),
            pa.array([name[s] if o else None for s, o in zip(up.tolist(), parent_open.tolist())], pa.binary()),
            pa.array(shared[nodes].astype(np.int32)), pa.array(level[nodes].astype(np.int32)), pa.array(least[nodes]),
            pa.array(least[up], mask=top | parent_open), pa.array(tokens[nodes]), pa.array(members[nodes]),
            pa.array(kids[nodes]), pa.array(leaves[nodes]), pa.array(saved[nodes]),
            pa.array([seqs[e] if e >= 0 else None for e in ends[nodes].tolist()], pa.binary()),
            pa.array(is_open)], [f.split()[0] for f in NODES.split(", ")])

    return run


def _above(table: pa.Table) -> pa.Table:
    """What the open nodes of a chunk that it owns add to those above them:
    (name, leaves, saved) with each node's own share included."""
    depth, side = table.column("depth").to_numpy(), table.column("side").to_numpy()
    own = np.stack([table.column("own_leaves").to_numpy(), table.column("own_saved").to_numpy()])
    total = own.copy()
    order = np.argsort(depth, kind="stable")
    down = {}                                     # running sums below, by path
    for k in order[::-1].tolist():
        if side[k] == 2:                          # both paths join here
            below = sum((down.pop(s) for s in list(down)), np.zeros(2, np.int64))
            total[:, k] += below
            down[2] = total[:, k].copy()
        else:
            total[:, k] += down.get(int(side[k]), np.zeros(2, np.int64))
            down[int(side[k])] = total[:, k].copy()
    return pa.table({"name": table.column("name"), "leaves": pa.array(total[0]), "saved": pa.array(total[1])})


def prefix_trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the prefix trie of (conv, turns)."""
    distinct, hashes, parts = sequences(convs)
    ranged = distinct.repartitionByRange(parts, "names").sortWithinPartitions("names")
    nodes = write_table(ranged.select("names", "words", "conv", "n", F.spark_partition_id().alias("part"), "seq")
                        .mapInArrow(tidy(_shard(shard_turns)), NODES), "nodes")
    # the shared upper nodes
    shared = nodes.where("open")
    merged = shared.groupBy("name").agg(
        F.min("up").alias("up"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("closed_children"),
        F.sum("n_leaves").alias("closed_leaves"), F.sum("saved").alias("closed_saved"), F.max("ends").alias("ends"),
        F.min("chunk").alias("owner"))
    kids = merged.where("up IS NOT NULL").groupBy(F.col("up").alias("name")).agg(F.count(F.lit(1)).alias("open_children"))
    merged = write_table(merged.join(kids, "name", "left").withColumn(
        "n_children", F.col("closed_children") + F.coalesce("open_children", F.lit(0))), "shared")
    own = merged.select("name", "owner", (F.col("n_children") == 0).cast("long").alias("leaf"),
                        ((F.col("n_convs") - 1) * F.col("words")).alias("tokens"))
    mine = F.col("chunk") == F.col("owner")
    told = (shared.select("chunk", "name", "depth", "side").join(own, "name")
            .select("chunk", "name", "depth", "side", F.when(mine, F.col("leaf")).otherwise(F.lit(0)).alias("own_leaves"),
                    F.when(mine, F.col("tokens")).otherwise(F.lit(0)).alias("own_saved")))
    added = (told.groupBy("chunk").applyInArrow(_above, "name binary, leaves long, saved long")
             .groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("more")))
    upper = merged.join(added, "name").select(
        "name", "up", "depth", "conv_id", "n_convs", "n_children", (F.col("closed_leaves") + F.col("leaves")).alias("n_leaves"),
        (F.col("closed_saved") + F.col("more")).alias("saved"), "ends")
    lower = nodes.where("NOT open")
    above = merged.select(F.col("name").alias("up"), F.col("conv_id").alias("above"))
    columns = ["depth", "parent_conv_id", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    every = (upper.join(above, "up", "left").withColumn("parent_conv_id", F.col("above")).select(*columns)
             .unionByName(lower.where("up IS NULL").withColumn("parent_conv_id", F.col("up_conv")).select(*columns))
             .unionByName(lower.where("up IS NOT NULL").join(above, "up").withColumn("parent_conv_id", F.col("above"))
                          .select(*columns)))
    every = write_table(every, "trie")
    out = ["conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
           F.col("saved").alias("saved_tokens")]
    # nodes where no conversation ends have nothing to look up
    ended = every.where("ends IS NOT NULL").withColumnRenamed("ends", "seq").join(hashes, "seq")
    return (ended.select(*out, F.col("ends").alias("ends_sha256"))
            .unionByName(every.where("ends IS NULL").select(*out, F.lit(EMPTY).alias("ends_sha256"))))


def trie_of(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The prefix trie of a conversations table, rebuilt as :func:`rebuilt` says."""
    return prefix_trie(rebuilt(write_table(conversations(turns), "conversations")), shard_turns)
