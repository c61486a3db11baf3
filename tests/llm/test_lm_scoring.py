"""Operator 4 against a direct computation of the same model."""

import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from helpers import LONG, ODD, fold, frame, lower, sentences, words_of
from shelfwise.llm import common
from shelfwise.llm import lm_scoring as lm

END, BEGIN = object(), object()


def brute(rows, order):
    trained = [t for i, t in rows if i is None or fold(i) != 1]
    seqs = lambda t: words_of(lower(t or "")) + [END]
    grams = [Counter() for _ in range(order + 1)]
    for t in trained:
        s = [BEGIN] * (order - 1) + seqs(t)
        for p in range(order - 1, len(s)):
            for k in range(1, order + 1):
                grams[k][tuple(s[p - k + 1:p + 1])] += 1
    total, types = sum(grams[1].values()), len(grams[1])

    def context(h):
        return len(trained) if all(x is BEGIN for x in h) else grams[len(h)][h]

    ratio = [((c - 1) / max(total - 1, 1) * (types + 1), c) for c in grams[1].values()]
    unigram = lm.em_weight(np.array([r for r, _ in ratio]), np.array([float(c) for _, c in ratio]))
    weights = {}

    def p(s, at, k, deleted=0):
        n = grams[1][(s[at],)]
        value = unigram * max(n - deleted, 0) / max(total - deleted, 1) + (1 - unigram) / (types + 1)
        for j in range(2, k + 1):
            h = tuple(s[at - j + 1:at])
            c = context(h)
            w = weights[j].get(int(math.log2(c)) + 1, 0.0) if c else 0.0
            value = w * max(grams[j][h + (s[at],)] - deleted, 0) / max(c - deleted, 1) + (1 - w) * value
        return value

    for k in range(2, order + 1):
        seen = defaultdict(list)
        for t in trained:
            s = [BEGIN] * (order - 1) + seqs(t)
            for at in range(order - 1, len(s)):
                h = tuple(s[at - k + 1:at])
                c = context(h)
                f = max(grams[k][h + (s[at],)] - 1, 0) / max(c - 1, 1)
                seen[int(math.log2(c)) + 1].append(f / p(s, at, k - 1, 1))
        weights[k] = {b: lm.em_weight(np.array(r), np.ones(len(r))) for b, r in seen.items()}
    out = {}
    for n, (i, t) in enumerate(rows):
        s = [BEGIN] * (order - 1) + seqs(t)
        own = range(order - 1, len(s))
        known = [grams[1][(s[a],)] for a in own]
        out[n] = (i, i is not None and fold(i) == 1, len(known), sum(c > 0 for c in known), total,
                  sum(math.log10((c + 0.5) / (total + 0.5 * (types + 1))) for c in known),
                  sum(math.log10(p(s, a, order)) for a in own))
    return out


def check(got, want, loose):
    key = lambda r: repr(r[:3]) + f"{r[5]:.6f}{r[6]:.3f}"
    got, want = sorted(map(tuple, got), key=key), sorted(want.values(), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=loose, abs=loose)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_direct_model(spark, monkeypatch, order):
    rows = list(enumerate(sentences(order, 60)))
    # small blocks and ranges, so that there are many
    monkeypatch.setattr(lm, "RANGE_REQUESTS", 300)
    check(lm.lm_scores(frame(spark, rows, extra=True, parts=5), order).collect(), brute(rows, order), 0.01)


def test_odd_rows_and_a_long_text(spark):
    rows = [*ODD, LONG]
    check(lm.lm_scores(frame(spark, rows)).collect(), brute(rows, 2), 0.01)
    assert lm.lm_scores(frame(spark, [])).count() == 0


def test_without_training_rows(spark):
    held = [i for i in range(100) if fold(i) == 1][:3]
    got = lm.lm_scores(frame(spark, [(i, "a b") for i in held])).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got] == [(0, 0, 0.0)] * 3
    assert all(math.isfinite(r.score) for r in got)


def test_em_finds_the_mixture():
    rng = np.random.default_rng(0)
    first = rng.random(20000) < 0.3
    # two components over two outcomes: 0.9 / 0.1 and 0.2 / 0.8
    x = np.where(first, rng.random(20000) < 0.9, rng.random(20000) < 0.2)
    assert lm.em_weight(np.where(x, 0.9 / 0.2, 0.1 / 0.8), np.ones(20000)) == pytest.approx(0.3, abs=0.03)


def test_messages_round_trip():
    for values in ([], [0], [1, 2**63, 2**64 - 1, 5]):
        a = np.asarray(values, np.uint64)
        assert (lm._unplanes(lm._planes(a)) == a).all()


def test_a_block_keeps_no_object_per_word():
    words = 400_000
    text = b" ".join(b"word%d" % (i % 1000) for i in range(words))
    payload = zstandard.ZstdCompressor().compress(b"\n".join([text, b"", b"word1 \xff"]))
    lm._Block(payload, [False] * 3, 1)
    tracemalloc.start()
    block = lm._Block(payload, [False, True, False], 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert block.n_tokens.tolist() == [words + 1, 1, 3]
    assert sorted(block.counts[0].tolist())[-2:] == [400, 401] and sorted(block.counts[0].tolist())[:2] == [1, 2]
    assert peak < 60 * words


def test_distinct_index_equals_unique():
    rng = np.random.default_rng(0)
    far = rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2)
    near = np.asarray([7, 5, 2**64 - 1, 5 << 40, 5, 6, 4], np.uint64)  # the same leading bits
    for values in (far, far[rng.integers(0, 500, 5000)], near, near[:1], near[:0], np.concatenate([far, near])):
        got, want = common.distinct_index(values), np.unique(values, return_inverse=True)
        assert (got[0].tolist(), got[1].tolist()) == (want[0].tolist(), want[1].tolist())
