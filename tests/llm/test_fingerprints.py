"""Operator 6 against a direct version, and its similarity join against all pairs."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import LONG, ODD, frame, sentences
from shelfwise.llm import fingerprints as fp


def spots(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w and w not in fp.COMMON]
    marked, anchor = [], True  # the text's start is an anchor
    for w in words:
        if w in fp.ANCHORS:
            anchor = True
        else:
            marked.append((w, anchor))
            anchor = False
    content = [w for w, _ in marked]
    return {" ".join(content[i:i + fp.CHAIN]) for i, (_, a) in enumerate(marked) if a}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, rows, **kw):
    """Distinct ids only: their order has no ties."""
    got = {r.doc_id: r for r in fp.fingerprints(frame(spark, rows, **kw)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for n, (i, t) in enumerate(order):
        t, after = t or "", order[(n + 1) % len(order)][1] or ""
        third = len(t) // 3
        edited = t[:len(t) - third] + after[:third]
        r = got[i]
        assert (r.n_chars, r.edited_text) == (len(t), edited)
        assert r.n_signatures == len(spots(t)) and len(r.fingerprint) == 8 * r.n_signatures
        assert r.near_edited == pytest.approx(jaccard(spots(t), spots(edited)))
        assert r.near_next == pytest.approx(jaccard(spots(t), spots(after)))
        assert (r.fingerprint == r.edited_fingerprint) == (spots(t) == spots(edited))


def test_equals_direct_version(spark):
    extra = ["The cat is on the mat of a dog", "LE CHAT!! EST!! un animal", "the the the", "😀 the x😀y z", "_ - _"]
    check(spark, [(i * 7 % 101, t) for i, t in enumerate(extra + sentences(5, 60))], extra=True, parts=7)


def test_odd_rows(spark):
    got = fp.fingerprints(frame(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    texts = {r.doc_id: r.fingerprint for r in got}
    assert texts[9] in [r.fingerprint for r in got if r.doc_id is None] and texts[-1] == texts[2**40]
    assert texts[3] == texts[4] == "" and by_text == {}
    assert fp.fingerprints(frame(spark, [])).count() == 0
    check(spark, [(1, None), (2, ""), (3, "the one"), LONG])
    check(spark, [(1, "a lone document is its own next one")])


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_similar_sets_equal_all_pairs(spark, threshold):
    texts = sorted(set(sentences(9, 100, vocabulary=30, most=40)))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "class long, text string")
    sets = df.select("class", fp.signatures(F.col("text")).alias("hashes"))
    got = {(r.low, r.high): r.likeness for r in fp.similar_sets(sets, threshold).collect()}
    s = [spots(t) for t in texts]
    want = {(x, y): jaccard(s[x], s[y]) for x in range(len(s)) for y in range(x + 1, len(s))
            if s[x] and s[y] and jaccard(s[x], s[y]) >= threshold}
    assert got == pytest.approx(want)


def test_pruned_likeness(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 3, 4, 5]), ([1], [1, 2, 3]), ([], [1]), ([], [])],
                               "a array<int>, b array<int>")
    rows = df.select(fp.likeness(F.col("a"), F.col("b"), 0.5), fp.length_partition(F.size("a"), 0.5)).collect()
    assert [tuple(r) for r in rows] == [(0.8, 2), (0.0, 0), (0.0, 0), (1.0, 0)]
    assert math.isclose(0.8, 0.8)


def test_native_and_text_moves_once(spark):
    df = fp.fingerprints(frame(spark, [(1, "a b c"), (2, "d e f")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


#: Texts with few or none of the fixed words.
BARE = [
    " ".join(str(i * 7919 % 10007) for i in range(90)),
    " ".join(f"слово{i}" for i in range(90)),
    "; ".join(f"int x{i} = f{i}(y{i})" for i in range(40)),
    " ".join([f"w{i}" for i in range(60)] + ["same"] * 60),
    " ".join(random.Random(3).choices(fp.COMMON, k=150)),
]


def test_cover_leaves_no_content_word_without_a_signature(spark):
    df = spark.createDataFrame([(t,) for t in [*BARE, "", "the", "_", "Cat is", *sentences(11, 60)]], "text string")
    for r in df.select("text", fp.chains(F.col("text"), cover=True).alias("c")).collect():
        words = [w for w in re.split(r"[\W_]+", r.text.lower()) if w]
        content = [w for w in words if w not in fp.ANCHORS + fp.COMMON]
        assert set(content) <= {w for c in r.c for w in c.split(" ")} and bool(r.c) == bool(words)
        assert len(r.c) >= len(content) / fp.CHAIN and all(len(c.split(" ")) <= fp.CHAIN for c in r.c)


def test_cover_tells_edited_texts_without_fixed_words_apart(spark):
    rows = list(enumerate(BARE))
    got = fp.fingerprints(frame(spark, rows), cover=True).collect()
    assert all(0.25 <= r.near_edited < 1 and r.near_next < 0.5 for r in got), [(r.near_edited, r.near_next) for r in got]
    shifted = [(1, BARE[0]), (2, "7 8 " + BARE[0])]  # chains fall into step again
    assert all(r.near_next > 0.8 for r in fp.fingerprints(frame(spark, shifted), cover=True).collect())
