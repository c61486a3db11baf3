"""Dictionaries that grow (J1) and splits of exact size."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import ids, split


def test_dictionary_grows_without_renumbering(spark):
    first = spark.createDataFrame([("b", 2), ("a", 5), ("b", 9), ("c", 2), (None, 1), ("d", None)], "k string, t int")
    one = ids.dictionary_by_appearance(first, "k", ["t"])
    assert {r.key: r.idx for r in one.collect()} == {"d": 0, "b": 1, "c": 2, "a": 3}
    more = spark.createDataFrame([("z", 1), ("a", 0), ("e", 1), (None, 0)] * 50 + [("y", 0)], "k string, t int")
    two = ids.extend_dictionary(one, more, "k", ["t"])
    assert {r.key: r.idx for r in two.collect()} == {"d": 0, "b": 1, "c": 2, "a": 3, "y": 4, "e": 5, "z": 6}
    three = ids.extend_dictionary(two, more, "k")
    assert sorted(map(tuple, three.collect())) == sorted(map(tuple, two.collect()))
    assert {r.key: r.idx for r in ids.extend_dictionary(one.where("false"), more, "k").collect()} == {
        "a": 0, "e": 1, "y": 2, "z": 3}
    assert ids.dictionary_by_appearance(first.where("false"), "k", ["t"]).count() == 0


def _expected(rows, ratios, names):
    digest = lambda r: hashlib.md5(",".join("" if v is None else str(v) for v in r).encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (digest(r), str(r)))
    sizes = [int(len(rows) * r) for r in ratios]
    out, at = Counter(), 0
    for name, size in zip(names, [*sizes, len(rows) - sum(sizes)]):
        out.update((*r, name) for r in rows[at:at + size])
        at += size
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_parts_have_exact_sizes(spark, seed):
    """Also where a third of all rows are equal and a cut falls among them."""
    rng = random.Random(seed)
    rows = [(f"u{rng.randrange(40)}", rng.choice([None, 1, 2, 3])) for _ in range(rng.randrange(100, 400))]
    rows += [("hot", 7)] * (len(rows) // 2)
    names = ("a", "b", "c")
    want = _expected(rows, (0.5, 0.2), names)
    for parts in (1, 5):
        got = split.exact_parts(spark.createDataFrame(rows, "u string, r int").repartition(parts), (0.5, 0.2), names)
        assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("rows,ratios", [(0, (0.8, 0.1)), (1, (0.8, 0.1)), (9, (1.0,)), (9, (0.0, 0.5)), (7, (0.3, 0.7))])
def test_sizes_of_small_and_one_sided_splits(spark, rows, ratios):
    names = tuple("abc"[:len(ratios) + 1])
    out = split.exact_parts(spark.range(rows), ratios, names)
    sizes = {r.part: r["count"] for r in out.groupBy("part").count().collect()}
    want = [int(rows * r) for r in ratios]
    assert [sizes.get(n, 0) for n in names] == [*want, rows - sum(want)]


def test_deeper_digits_are_looked_at_only_where_a_cut_falls(spark, monkeypatch):
    passes = []
    real = split._bucket_counts
    monkeypatch.setattr(split, "DIGITS", 1)
    monkeypatch.setattr(split, "_bucket_counts", lambda rows, d, inside: passes.append(inside) or real(rows, d, inside))
    out = split.exact_parts(spark.range(3000), (0.4, 0.3), ("a", "b", "c"))
    sizes = {r.part: r["count"] for r in out.groupBy("part").agg(F.count("*").alias("count")).collect()}
    assert sizes == {"a": 1200, "b": 900, "c": 900}
    assert len(passes) > 2 and all(len(p) <= 2 for p in passes[1:])
