"""Operator 10 against brute force over all pairs of places."""

import random
import re

import pytest

from helpers import LONG, ODD, frame
from shelfwise.llm import line_dedup as ld


def brute(rows, least):
    """Rows with distinct (id, text); ids are not null."""
    docs = sorted({(i, t) for i, t in rows if t is not None})
    lines = {d: d[1].split("\n") for d in docs}
    places = [(d, p) for d in docs for p in range(len(lines[d]))]
    gone = set()
    for b, (d, p) in enumerate(places):
        for e, q in places[:b]:
            n = chars = 0
            while p + n < len(lines[d]) and q + n < len(lines[e]) and lines[d][p + n] == lines[e][q + n]:
                chars += len(lines[d][p + n]) + 1
                n += 1
            if n and chars >= least:
                gone.update((d, p + x) for x in range(n))
    out = []
    for i, t in rows:
        own = [] if t is None else lines[i, t]
        kept = [x for p, x in enumerate(own) if ((i, t), p) not in gone]
        out.append((i, len(own), len(own) - len(kept), None if t is None else "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,least", [(1, 1), (2, 5), (3, 9), (4, 20), (5, 60)])
def test_equals_brute_force(spark, seed, least):
    rng = random.Random(seed)
    pool = ["", "a", "bc", "def", "ghij", "a line", "a longer line", "é" * 7]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for i in range(25)]
    rows += [(100 + i, rng.choice(rows)[1]) for i in range(5)] + [(7, "a line\na longer line\n")]
    assert got(ld.remove_repeated_lines(frame(spark, rows, extra=True), least)) == brute(rows, least)


def test_odd_rows_and_a_long_text(spark):
    rows = [r for r in ODD if r[0] is not None] + [LONG, (11, LONG[1]), (12, "x\n" * 3000), (13, "y\n" + "x\n" * 3000)]
    keep = {r.doc_id: r for r in ld.remove_repeated_lines(frame(spark, rows)).collect()}
    assert keep[11].n_removed == 1 and keep[11].kept_text == "" and keep[10].n_removed == 0
    assert keep[3].kept_text is None and keep[4].kept_text == "" and keep[7].n_removed == 0
    assert keep[2**40].n_removed == 1 and keep[-1].n_removed == 0
    # the first run of lines is its own original but for its first lines; the later one goes
    assert keep[12].n_removed == 2999 and keep[13].n_removed == 3000 + 1
    nulls = [r for r in ld.remove_repeated_lines(frame(spark, ODD)).collect() if r.doc_id is None]
    assert sorted((r.n_removed, r.kept_text is None) for r in nulls) == [(0, False), (0, True)]
    assert ld.remove_repeated_lines(frame(spark, [])).count() == 0


def test_stage_keeps_rows_and_columns(spark):
    rows = [(1, "first line of this document, with enough characters to count as a run\nb"),
            (2, "own\nfirst line of this document, with enough characters to count as a run\nc"), (3, None), (None, "z")]
    df = frame(spark, rows, extra=True)
    out = ld.without_repeated_lines(df)
    assert out.schema.names == df.schema.names
    r = {x.doc_id: x for x in out.collect()}
    assert len(r) == 4 and (r[2].text, r[2].n_chars, r[2].rest) == ("own\nc", 5, "own rest") and r[1].text == rows[0][1]


def test_native(spark):
    df = ld.remove_repeated_lines(frame(spark, [(1, "a b c"), (2, "d e f")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
