"""Operator 13 against brute force over all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from helpers import LONG, ODD, frame, lower, sentences, words_of
from shelfwise.llm import queries
from shelfwise.llm import simhash_dedup as sd


def print_of(text, k=3):
    w = words_of(lower(text or ""))
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius):
    """Smallest index reachable, of each of the distinct values."""
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(parent, 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(a)] = root(b)
    return {v: root(v) for v in parent}


def brute(rows, radius=3):
    prints = [print_of(t) for _, t in rows]
    root = classes({p for p, (i, _) in zip(prints, rows) if i is not None}, radius)
    low = {}
    for p, (i, _) in zip(prints, rows):
        if i is not None:
            low[root[p]] = min(i, low.get(root[p], i))
    return sorted(((i, f"{p:016x}", None if i is None else low[root[p]]) for p, (i, _) in zip(prints, rows)), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def near_copies(seed, n):
    """Long texts and copies with a word or two changed."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for _ in range(4):
            texts.append(" ".join(words))
            words[rng.randrange(300)] = "Changed"
    return texts


@pytest.mark.parametrize("split_above", [256, 2])
def test_equals_brute_force(spark, split_above):
    rows = list(enumerate([*near_copies(5, 25), *sentences(1, 60)]))
    random.Random(2).shuffle(rows)
    want = brute(rows)
    assert len({c for _, _, c in want}) < 110
    assert got(sd.similar_documents(frame(spark, rows, extra=True), split_above=split_above)) == want


def test_odd_rows_and_a_long_text(spark):
    rows = [*ODD, LONG, (11, LONG[1] + " more")]
    assert got(sd.similar_documents(frame(spark, rows))) == brute(rows)
    assert sd.similar_documents(frame(spark, [])).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_every_set_of_radius_bits_is_left_out_by_a_mask(radius):
    masks = sd.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    picks = combinations(range(64), radius) if radius < 3 else (rng.sample(range(64), radius) for _ in range(5000))
    for bits in picks:
        change = sum(1 << b for b in bits)
        assert any(mask & change == 0 for mask in masks)


@pytest.mark.parametrize("split_above", [256, 8, 2])
def test_chains_and_balls_of_prints(spark, split_above):
    """Groups in which members reach each other only over others."""
    rng = np.random.default_rng(3)
    values = set()
    for _ in range(4):
        x = int(rng.integers(0, 2**63))
        for _ in range(120):
            values.add(x)
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(b)
    values |= {int(v) for v in rng.integers(0, 2**63, 100)}
    signed = [v - 2**64 if v >> 63 else v for v in values]
    edges = sd.linked_prints(spark.createDataFrame([(v,) for v in signed], "print long"), 3, split_above).collect()
    pairs = [(e.a % 2**64, e.b % 2**64) for e in edges]
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    mine, want = {}, {}
    for v, r in classes(values, 3).items():
        want.setdefault(r, set()).add(v)
        mine.setdefault(root(v), set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_a_bucket_gives_a_star_not_all_pairs(spark):
    values = [(v,) for v in range(200)]  # all within eight bits, most pairs linked
    assert sd.linked_prints(spark.createDataFrame(values, "print long"), 3, 1000).count() < 200 * 15


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op13_simhash_dedup(spark, sf)) == brute(rows)
