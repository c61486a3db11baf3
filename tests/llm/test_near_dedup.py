"""Operator 5 against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import LONG, ODD, frame, lower, sentences, words_of
from shelfwise.llm import near_dedup as nd


def shingles(text, k):
    w = words_of(lower(text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    usable = [n for n, (i, _) in enumerate(rows) if i is not None and sets[n]]
    for x in usable:
        for y in usable:
            if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                parent[root(y)] = root(x)
    out = []
    for n, (i, _) in enumerate(rows):
        own = min((rows[m][0] for m in usable if root(m) == root(n)), default=i) if n in usable else i
        out.append((i, len(sets[n]), own, own == i))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed,k", [(1, 2), (2, 2), (3, 5)])
def test_equals_brute_force(spark, seed, k):
    rows = list(enumerate(sentences(seed, 120, most=80)))
    random.Random(seed).shuffle(rows)
    assert got(nd.near_duplicates(frame(spark, rows, extra=True), k)) == brute(rows, k)


def test_chains_of_near_copies(spark):
    """Each text is near its neighbours only; the star's center is far from most."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(25):
        base[2 * i:2 * i + 2] = [f"x{i}", f"y{i}"]
        rows.append((100 - i, " ".join(base)))
    want = brute(rows, 2)
    assert {r[2] for r in want} == {76}
    assert got(nd.near_duplicates(frame(spark, rows), 2)) == want


def test_odd_rows_and_a_long_text(spark):
    rows = [*ODD, LONG, (11, LONG[1] + " more")]
    assert got(nd.near_duplicates(frame(spark, rows), 2)) == brute(rows, 2)
    assert nd.near_duplicates(frame(spark, [])).count() == 0


def test_stage_keeps_one_of_each_group_and_all_columns(spark):
    rows = [*ODD, (20, "a b c d e f g h i j"), (21, "a b c d e f g h i j"), (22, "A B C D E F G H I J")]
    df = frame(spark, rows, extra=True)
    out = nd.without_near_duplicates(df)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.collect()]
    assert 20 in ids and not {21, 22} & set(ids) and ids.count(None) == 2 and {3, 4, 5} <= set(ids)


@pytest.mark.parametrize("sizes", [(1, 1), (3, 4), (40, 50), (700, 800)])
def test_bands_agree_as_the_sets_do(sizes):
    """At similarity 0.8 nearly a sixth of the bands agree, whatever the size."""
    rng = np.random.default_rng(sizes[0])
    agree = []
    for _ in range(40):
        big = np.sort(rng.integers(0, 2**64, sizes[1], dtype=np.uint64))
        small = np.sort(rng.permutation(big)[:sizes[0]])
        owner = np.repeat([0, 1], [len(big), len(small)])
        keys, _ = nd.band_keys(owner, np.concatenate([big, small]), 2)
        agree.append((keys[0] == keys[1]).mean())
    similarity = sizes[0] / sizes[1]
    assert np.mean(agree) == pytest.approx(similarity ** nd.ROWS, abs=0.1)
    assert sum(a == 0 for a in agree) <= 1


def test_components_of_paths_stars_and_pairs(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 100), (300, 200)]
    out = nd.components(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 0 for e in edges[:-1] for i in e} | {200: 200, 300: 200}
    assert {r.node: r.component for r in out.collect()} == want


@pytest.mark.parametrize("size", [1, 3, 64, 256, 1000, 5000])
def test_sketches_never_rule_out_a_link(spark, size):
    """Sketches differ in no more places than sets do in elements, so pairs at
    the very threshold pass; unlike sets of usual sizes do not."""
    rng = np.random.default_rng(size)
    rows = []
    for _ in range(60):
        both = rng.integers(0, 2**64, size, dtype=np.uint64)
        own = [rng.integers(0, 2**64, n, dtype=np.uint64) for n in (size // 8, size // 4 - size // 8)]
        sets = [np.sort(np.concatenate([both, x])) for x in own]
        _, sketch = nd.band_keys(np.repeat([0, 1], [len(s) for s in sets]), np.concatenate(sets), 2)
        x, y = sketch.view(np.int64).tolist()
        assert np.unpackbits((sketch[0] ^ sketch[1]).view(np.uint8)).sum() <= len(np.setxor1d(*sets))
        assert 100 * size >= 80 * len(np.union1d(*sets))
        rows.append((len(sets[0]), len(sets[1]), *x, *y))
    names = ["na", "nb", *nd._SKETCH, *[f"b_{c}" for c in nd._SKETCH]]
    may = nd._may_reach(80, F.col("na"), F.col("nb"))
    table = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in names))
    assert table.where(may).count() == len(rows)
    if 64 <= size <= 256:
        half = F.lit(0x5A5A5A5A5A5A5A5A)  # every other parity differs, as between unrelated sets
        unlike = table.withColumns({f"b_{c}": F.col(c).bitwiseXOR(half) for c in nd._SKETCH})
        assert unlike.where(may).count() == 0


def test_stage_keeps_one_row_where_rows_and_ids_repeat(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(1, a), (1, a), (2, a), (2, b), (2, b), (3, b), (4, b), (5, None), (5, None), (6, "A B c d e f g h i j"),
            (7, "u v w x y z"), (7, "U v w x y z"), (None, a), (None, a)]
    out = nd.without_near_duplicates(frame(spark, rows, extra=True)).collect()
    assert len([r for r in out if r.doc_id == 7]) == 1
    assert sorted(((r.doc_id, r.text) for r in out if r.doc_id != 7), key=repr) == sorted(
        [(1, a), (2, b), (5, None), (None, a), (None, a)], key=repr)


def test_many_short_texts_in_a_batch_take_little_memory():
    """4,000 signatures at once took over 150 MB; a slice has at most 256 rows."""
    import tracemalloc

    import pyarrow as pa

    texts = [f"a b c d e f {i}" for i in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000), pa.int64()), pa.array(texts)], ["id", "text"])
    list(nd._signatures_of(5)([batch.slice(0, 10)]))  # the order of borrowing is made once
    tracemalloc.start()
    try:
        rows = sum(part.num_rows for part in nd._signatures_of(5)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 4000
    assert peak < 48 << 20
