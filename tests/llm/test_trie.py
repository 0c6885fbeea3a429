"""Conversation trie: all nodes, against plain dictionaries."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from revlens.llm import conversation_trie as ct

TURNS = "conv_id long, turn long, role string, text string, depth string"


def name(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, name(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = own.get(first, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = ({k: 0 for k in nodes} for _ in range(3))
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] += kids[k] == 0
        if k:
            saved[k] += (len(nodes[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1]))
            kids[k[:-1]] += 1
            leaves[k[:-1]] += leaves[k]
            saved[k[:-1]] += saved[k]
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(k)).encode()).hexdigest())
                  for k, m in nodes.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def planted(seed, n):
    """Shared prefixes, whole copies, odd turns, conversations without turns of their own left."""
    rng = random.Random(seed)
    says = ["hello there", "", None, "a b  c\td", "é ü", "x", "yes please do", "no"]
    rows = []
    for k in range(n):
        c = rng.choice([k, k, k + 1000, -k])
        if rng.random() < 0.3:
            turns = [(i, "user", "the one conversation %d" % i) for i in range(5)]
        else:
            turns = [(rng.choice([i, i, i, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(says))
                     for i in range(rng.randrange(1, 9))]
            if rng.random() < 0.5:
                turns[:2] = [(0, "user", "hello there"), (1, "assistant", "hi")][:len(turns)]
        rows += [(c, *t, "d") for t in turns]
        if rng.random() < 0.1:
            rows.append((c, *turns[0], "d"))
    rng.shuffle(rows)
    return rows + [(None, 0, "user", "lost", "d")]


@pytest.mark.parametrize("shard_turns", [1, 9, 60, 1 << 18])
def test_against_dictionaries(spark, shard_turns):
    rows = planted(shard_turns, 300)
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    assert rows_of(ct.trie_of(turns, shard_turns)) == brute(rows)


def test_small_and_empty_tables(spark):
    for rows in ([], [(None, 1, "user", "x", "d")], [(7, None, None, None, None)], [(21, 0, "a", "b", "d")]):
        assert rows_of(ct.trie_of(spark.createDataFrame(rows, TURNS))) == (brute(rows) if any(r[0] is not None for r in rows) else [])


def test_long_conversations(spark):
    """Some of thousands of turns that part late, one with a text of over 1 MB."""
    rows = [(c, i, "user", f"t{i if i < 2500 else i * c}", "d") for c in (40, 41, 42, 45) for i in range(2500 + 200 * (c - 40))]
    rows += [(43, 0, "user", "word " * 300_000, "d"), (44, 0, "user", "word " * 300_000, "d")]
    turns = spark.createDataFrame(rows, TURNS)
    for shard_turns in (1000, 1 << 18):
        assert rows_of(ct.trie_of(turns, shard_turns)) == brute(rows)


def test_double_array_holds_the_sequences():
    rng = random.Random(2)
    for _ in range(40):
        seqs = sorted({tuple(rng.randrange(1, 30) for _ in range(rng.randrange(0, 7))) for _ in range(rng.randrange(1, 60))})
        size = np.array([len(s) for s in seqs])
        codes = np.array([c for s in seqs for c in s], np.int64)
        begin = np.cumsum(size) - size
        trie = ct.DoubleArray(codes, begin, size, 30)
        taken = np.flatnonzero(trie.check >= 0)
        prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
        assert len(taken) == len(prefixes) == sum(map(len, trie.levels))
        ends = {}
        for live, node in trie.walk(codes, begin, size):
            ends.update(zip(live.tolist(), node.tolist()))
        assert len(set(ends.values())) == len(seqs)
        other = np.array([31, 1, 31], np.int64)          # not in the trie: CHECK stops the walk
        assert sum(len(n) for _, n in trie.walk(other, np.array([0]), np.array([3]))) == 1


def test_member_hashes_across_blocks(spark):
    ids = [*range(-20, 30000, 3), 10**12, -10**12]
    got = ct.member_hashes(spark.createDataFrame([(b"s" * 32, c) for c in ids], "seq binary, conv long")).collect()
    assert [r["ends"] for r in got] == [hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()]
