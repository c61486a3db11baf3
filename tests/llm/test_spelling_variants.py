"""Operator 11 against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from helpers import LONG, ODD, frame, lower
from shelfwise.llm import queries
from shelfwise.llm import spelling_variants as sv

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows, least=5, often=3, damage=97):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            w = lower(run)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % damage == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def brute(rows, damage=97):
    counts = counted(rows, damage=damage)
    by_gap = {}
    for w in counts:  # one edit: equal words, or equal after a deletion in either
        for i in range(len(w)):
            by_gap.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in counts}
    for (i, gone), ws in by_gap.items():
        for a in ws:
            near[a] |= ws
            if gone in counts:
                near[a].add(gone)
                near[gone].add(a)
    form = {}
    for w, others in near.items():
        others.discard(w)
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=repr)


def texts(seed, n, letters="abcdeé"):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(400)]
    for w in vocab[:200]:
        at = rng.randrange(len(w))
        vocab.append(w[:at] + rng.choice([rng.choice(letters), ""]) + w[at + 1:])
    vocab += [w.upper() for w in vocab[:40]] + ["x1y", "…", "日本", "naïve", "NAÏVE", "straße×"]
    weights = [1 / (k + 1) for k in range(len(vocab))]
    return [" ".join(rng.choices(vocab, weights, k=rng.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("cell_words,damage", [(50_000, 97), (20, 7)])
def test_equals_brute_force(spark, cell_words, damage):
    rows = list(enumerate(texts(3, 150)))
    want = brute(rows, damage)
    assert len({r for _, _, r, *_ in want}) < len(want) and max(n for *_, n, _ in want) >= 3
    assert got(sv.spelling_variants(frame(spark, rows, extra=True), damage=damage, cell_words=cell_words)) == want


def test_odd_rows_and_a_long_text(spark):
    long_words = ("y" * 30_000 + " " + "y" * 29_999 + " ") * 3
    rows = [*ODD, LONG, (11, LONG[1] * 2), (12, long_words)]
    assert got(sv.spelling_variants(frame(spark, rows))) == brute(rows)
    assert sv.spelling_variants(frame(spark, [])).count() == 0


def test_crc_of_joined_parts():
    rng = random.Random(1)
    prefixes = [f"{rng.randrange(10**9)}:".encode() for _ in range(200)]
    tails = [rng.randbytes(rng.randrange(0, 65)) for _ in range(200)]
    mine = sv._keyed_crc(np.array([zlib.crc32(p) for p in prefixes], np.uint32),
                         np.array([zlib.crc32(t) for t in tails], np.uint32), np.array([len(t) for t in tails]))
    assert mine.tolist() == [zlib.crc32(p + t) for p, t in zip(prefixes, tails)]


@pytest.mark.parametrize("portion", [1 << 24, 1])
def test_searches_find_every_pair_once(monkeypatch, portion):
    """Also where very many words share their letters (portion 1)."""
    monkeypatch.setattr(sv, "_PORTION", portion)
    rng = random.Random(4)
    words = {w: sorted({"".join(rng.choice("aabbcé") for _ in range(w)).encode("latin-1") for _ in range(1500)}) for w in (6, 7)}
    near = lambda a, b: (sum(x != y for x, y in zip(a, b)) == 1 if len(a) == len(b)
                         else any(b[:i] + b[i + 1:] == a for i in range(len(b))))
    for q, p in ((words[6], None), (words[6], words[7])):
        pairs = [(int(a), int(b)) for x, y in sv.near_pairs(q, p) for a, b in zip(x, y)]
        assert len(pairs) == len(set(pairs))
        if p is None:
            want = {(a, b) for a in range(len(q)) for b in range(a) if near(q[a], q[b])}
            pairs = {(max(x), min(x)) for x in pairs}
        else:
            want = {(a, b) for a in range(len(q)) for b in range(len(p)) if near(q[a], p[b])}
        assert set(pairs) == want


def test_cells_of_the_top_hold_their_points():
    rng = random.Random(5)
    words = [("".join(rng.choice("abcdefghij") for _ in range(8))).encode() for _ in range(4000)]
    points = sv.points_of(words)
    top = sv.KdTree(points[::10], 5)
    q, cell = map(np.concatenate, zip(*top.leaves(points, 0, 0)))
    assert sorted(q.tolist()) == list(range(len(words)))
    assert np.bincount(cell).max() < len(words) / 12
    reach = sum(len(q) for q, _ in top.leaves(points, 1, 1))
    assert len(words) < reach < len(words) * 32


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op11_spelling_variants(spark, sf)) == brute(rows)
