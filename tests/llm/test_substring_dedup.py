"""Operator 2 against brute force over all windows."""

import random

import pytest

from conftest import SF_SMALL
from helpers import LONG, ODD, frame, sentences, words_of
from shelfwise.llm import substring_dedup as sd
from shelfwise.llm.common import read_table


def brute(rows, window=sd.WINDOW):
    first: dict[tuple, int] = {}
    for i, t in rows:
        w = words_of(t)
        for s in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[s:s + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,window,anchor,split", [(1, 13, 5, 2000), (2, 13, 5, 1), (3, 4, 2, 3), (4, 3, 3, 2), (5, 2, 1, 2)])
def test_equals_brute_force(spark, seed, window, anchor, split):
    rows = list(enumerate(sentences(seed, 80, vocabulary=6 if window < 13 else 60)))
    random.Random(seed).shuffle(rows)
    df = sd.remove_repeats(frame(spark, rows, extra=True), window, anchor, split_above=split)
    assert got(df) == brute(rows, window)


def test_odd_rows_and_a_long_text(spark):
    rows = [*ODD, LONG, (11, LONG[1][:5000])]
    assert got(sd.remove_repeats(frame(spark, rows))) == brute(rows)
    assert sd.remove_repeats(frame(spark, [])).count() == 0


def test_spans_are_maximal(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, passage), (2, "before " + passage + " after")]
    r = {x.doc_id: x for x in sd.remove_repeats(frame(spark, rows)).collect()}[2]
    assert [(s.low, s.high) for s in r.spans] == [(1, 31)] and r.kept_text == "before after"


def test_automaton_matches_brute_force():
    rng = random.Random(0)
    for _ in range(200):
        known = [[rng.choice(b"abc") for _ in range(rng.randint(0, 9))] for _ in range(rng.randint(1, 4))]
        text = [rng.choice(b"abcd") for _ in range(12)]
        automaton = sd.SuffixAutomaton()
        for k in known:
            automaton.add(k)
        runs = {tuple(k[i:j]) for k in known for i in range(len(k)) for j in range(i + 1, len(k) + 1)}
        want = [max(n for n in range(e + 1) if n == 0 or tuple(text[e - n:e]) in runs) for e in range(1, 13)]
        assert automaton.matching_statistics(text) == want


def test_texts_and_anchors_move_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = sd.remove_repeats(read_table(spark, SF_SMALL, "documents"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert final.count("ReusedExchange") == 2
