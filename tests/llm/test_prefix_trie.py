"""Operator 12 against a plain trie."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from helpers import words_of
from shelfwise.llm import prefix_trie as pt
from shelfwise.llm import queries

ROWS = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    paths = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []

    def visit(p):  # leaves, saved
        own = (len(members[p]) - 1) * len(words_of(p[-1][1])) if p else 0
        below = [visit(c) for c in children.get(p, [])]
        leaves, saved = (sum(b[0] for b in below) or 1), own + sum(b[1] for b in below)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(paths[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if members:
        visit(())
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                          "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        for c in ("conv", "turns", "path", "k", "w", "n", "low", "chain", "s", "prefix", "place", "own", "of"):
            df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def conversations(seed, n):
    """Conversations that share first turns, whole copies, and some very short ones."""
    rng = random.Random(seed)
    made, rows = [], []
    for c in range(n):
        kind = rng.random()
        if made and kind < 0.25:
            turns = list(rng.choice(made))
        elif made and kind < 0.6:
            base = rng.choice(made)
            turns = base[:rng.randint(0, len(base))] + [(rng.choice("ab"), f"t{rng.randint(0, 4)} x  y") for _ in range(rng.randint(0, 3))]
        else:
            turns = [("system", "the same first turn")] + [("user", f"hello {rng.randint(0, 9)}")] * rng.randint(0, 4)
        turns = turns or [("user", "")]
        made.append(turns)
        rows += [(c * rng.choice([1, 1, 3]) if c % 7 else c, k, role, text) for k, (role, text) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("shard_turns", [1_000_000, 12])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_trie(spark, seed, shard_turns):
    rows = conversations(seed, 200)
    want = brute(rows)
    assert max(r[1] for r in want) > 4 and max(r[3] for r in want if r[1]) > 50
    assert got(pt.prefix_trie(frame(spark, rows, extra=True), shard_turns=shard_turns)) == want


def test_odd_rows(spark):
    rows = [(None, 1, "user", "no id"), (0, None, None, None), (0, None, "user", "null turn too"), (0, 1, "user", None),
            (0, 1, "user", "tie"), (0, 1, "user", "tie"), (1, 5, "user", "word " * 20_000), (2, 0, "user", "one"),
            (3, 0, "user", "one"), (4, 0, "user", "one"), (5, 0, "user", "one"), (6, 0, "user", "one"), (41, 0, "u", "x")]
    rows += [(7, k, "user", "a long chain") for k in range(3000)]
    assert got(pt.prefix_trie(frame(spark, rows))) == brute_iterative(rows)
    assert pt.prefix_trie(frame(spark, [])).count() == 0
    alone = [(21, 0, "user", "gone")] if zlib.crc32(b"21") % 4 else [(22, 0, "user", "gone")]
    assert got(pt.prefix_trie(frame(spark, alone))) == brute(alone)


def brute_iterative(rows):
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        return brute(rows)
    finally:
        sys.setrecursionlimit(limit)


def test_ends_of_a_group_that_spans_many_blocks(spark):
    rows = [(20 * c, 0, "user", "same") for c in range(3000)] + [(20 * c, 1, "user", "same") for c in range(3000)]
    assert got(pt.prefix_trie(frame(spark, rows), shard_turns=100)) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_double_array_holds_every_sequence(seed):
    rng = np.random.default_rng(seed)
    sequences = [rng.integers(0, 30, rng.integers(0, 12)) for _ in range(400)]
    sequences += [rng.integers(0, 10**6, rng.integers(1, 6)) for _ in range(400)]
    lengths = np.array([len(s) for s in sequences])
    starts = np.cumsum(lengths) - lengths
    trie = pt.DoubleArray(np.concatenate(sequences), starts, lengths)
    node_of = {}
    for depth, rows, nodes in trie.walk():
        for r, x in zip(rows, nodes):
            prefix = tuple(sequences[r][:depth])
            assert node_of.setdefault(prefix, x) == x
    assert len(set(node_of.values())) == len(node_of)  # one slot per prefix
    assert (trie.check >= 0).sum() == len(node_of)
    for prefix, x in node_of.items():
        assert not prefix or trie.check[x] == node_of[prefix[:-1]]
    assert len(trie.check) < 4 * len(node_of)  # packed


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_prefix_trie(spark, sf)) == brute(rows)
