"""Operator 3 against brute force over all windows, without fingerprints."""

import random
from collections import Counter

import numpy as np
import pytest

from helpers import LONG, ODD, frame, lower, words_of
from shelfwise.llm import decontamination as dc


def shingles(w):
    k = min(dc.SHINGLE, len(w))
    out = Counter()
    for i in range(len(w) - k + 1):
        g = tuple(w[i:i + k])
        out[g] += sum(len(x.encode()) for x in g)
    return out


def brute(rows, items):
    out = []
    for i, t in rows:
        w = words_of(lower(t or ""))
        for item, text in items:
            q = words_of(lower(text or ""))
            if not q:
                continue
            a, best = shingles(q), (0.0, 0)
            k = min(dc.SHINGLE, len(q))
            if not any(tuple(w[s:s + k]) in a for s in range(len(w) - k + 1)):
                continue  # no shingle in common: similarity 0 everywhere
            for s in range(len(w) - len(q) + 1):
                b = shingles(w[s:s + len(q)])
                value = sum((a & b).values()) / sum((a | b).values())
                if value >= dc.SIMILARITY and value > best[0]:
                    best = (value, s)
            if best[0]:
                out.append((i, item, best[1], len(q), round(best[0], 9)))
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    vocab = [f"v{i}" * rng.randint(1, 3) for i in range(400)] + ["the", "of", "É"]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(j, " ".join(text(rng.choice([1, 3, 5, 14, 30, 45])))) for j in range(12)]
    items += [(50, items[4][1]), (51, None), (52, ""), (53, " ")]
    rows = []
    for i in range(60):
        w = text(rng.randint(0, 80))
        if rng.random() < 0.7:
            p = words_of(rng.choice(items[:12])[1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                p[rng.randrange(len(p))] = rng.choice(vocab)
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() if rng.random() < 0.2 else x for x in p]
        rows.append((i, " ".join(w)))
    return rows, items


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows, items = case(seed)
    got = dc.contamination(frame(spark, rows, extra=True), benchmark(spark, items))
    assert sorted(((*r[:4], round(r[4], 9)) for r in got.collect()), key=repr) == brute(rows, items)


def test_a_large_benchmark_goes_in_shards(spark, monkeypatch):
    rows, items = case(4)
    monkeypatch.setattr(dc, "SHARD_BYTES", 300)
    got = dc.contamination(frame(spark, rows), benchmark(spark, items))
    assert sorted(((*r[:4], round(r[4], 9)) for r in got.collect()), key=repr) == brute(rows, items)


def test_odd_rows_and_a_long_text(spark):
    items = [(1, "when they were loaded twice by mistake"), (None, "one id, first text"), (2, None)]
    rows = [*ODD, LONG, (12, LONG[1] + " when they were loaded twice by mistake")]
    got = dc.contamination(frame(spark, rows), benchmark(spark, items))
    assert sorted([(r.doc_id, r.item_id) for r in got.collect()], key=repr) == [(12, 1), (7, 1), (7, 1), (8, None)]
    assert dc.contamination(frame(spark, []), benchmark(spark, items)).count() == 0
    assert dc.contamination(frame(spark, rows), benchmark(spark, [])).count() == 0


def test_stage_drops_contaminated_rows_only(spark):
    rows, items = case(5)
    df = frame(spark, rows, extra=True)
    out = dc.without_contaminated(df, benchmark(spark, items))
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {i for i, _ in rows} - {r[0] for r in brute(rows, items)}


def test_blocks_return_all_fingerprints_in_the_radius():
    rng = np.random.default_rng(0)
    items = dc._Items(10)
    for _ in range(30):
        items.shingles.append((rng.integers(0, 2**64, items.size, dtype=np.uint64), np.ones(items.size, np.int64)))
    items.finish()
    flips = []
    for bits in range(0, dc.RADIUS + 4):
        mask = sum(1 << int(b) for b in rng.permutation(64)[:bits])
        flips.append((items.prints ^ np.uint64(mask), bits))
    for prints, bits in flips:
        window, item = items.candidates(prints)
        own = {(w, i) for w, i in zip(window.tolist(), item.tolist())}
        assert all(((j, j) in own) == (bits <= dc.RADIUS) for j in range(30))


def pairs_of(text, item):
    return [h[1:] for h in dc.BenchmarkIndex([(1, " ".join(item))]).search([" ".join(text).encode()])[0]]


def value_of(text, item):
    a, b = shingles(item), shingles(text)
    return sum((a & b).values()) / sum((a | b).values())


def test_a_text_shorter_than_the_item_is_one_window(spark):
    rng = random.Random(7)
    item = [f"w{rng.randrange(10**6)}" for _ in range(59)]
    for lost in range(0, 15):
        for text in (item[lost:], item[:59 - lost], item[:20] + item[20 + lost:]):
            value = value_of(text, item)
            want = [(0, 59 - lost, pytest.approx(value))] if value >= dc.SIMILARITY else []
            assert pairs_of(text, item) == want
    rows = [(1, " ".join(item[1:-1])), (2, " ".join(item[30:])), (3, ""), (4, "w")]
    out = dc.without_contaminated(frame(spark, rows), benchmark(spark, [(1, " ".join(item))]))
    assert sorted(r.doc_id for r in out.collect()) == [2, 3, 4]


def test_a_heavy_word_loses_no_similar_window():
    rng = random.Random(8)
    item = [f"w{rng.randrange(10**6)}" for _ in range(59)]
    n = 0
    for letters in range(20, 351, 15):
        for at in (0, 58):
            odd = [*item[:at], "".join(rng.choices("abcdefghij/:.", k=letters)), *item[at + 1:]]
            for text, own in ((odd, item), (item, odd), (odd, [*odd[:5], "x" * 30, *odd[6:]])):
                value = value_of(text, own)
                assert pairs_of(text, own) == ([(0, 59, pytest.approx(value))] if value >= dc.SIMILARITY else [])
                n += value >= dc.SIMILARITY
    assert n > 20
