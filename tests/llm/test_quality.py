"""Operator 9: held-out accuracy and the parts it is made of."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from helpers import LONG, ODD, fold, frame
from shelfwise.llm import quality as q
from shelfwise.llm.common import read_table


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, marks = read_table(spark, SF_ORACLE, "documents"), read_table(spark, SF_ORACLE, "labels")
    out = q.quality_scores(docs, marks).cache()
    assert out.count() == docs.count()
    rows = out.join(marks, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    assert len(rows) > 50
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    area = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert area > 0.95 and np.mean([r.predicted == r.quality for r in rows]) > 0.93
    for r in out.collect():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (fold(r.doc_id) == 0)


def test_held_out_labels_change_nothing(spark):
    docs, marks = read_table(spark, SF_ORACLE, "documents"), read_table(spark, SF_ORACLE, "labels")
    held = q.id_fold(F.col("doc_id")) == 0
    flipped = marks.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (dict(q.quality_scores(docs, m).select("doc_id", "score").collect()) for m in (marks, flipped))
    assert a == pytest.approx(b, abs=1e-9)


def test_odd_rows(spark):
    rows = [*ODD, LONG]
    none = q.quality_scores(frame(spark, rows, extra=True), labels(spark, [])).collect()
    assert len(none) == len(rows) and {r.score for r in none} == {0.5}
    some = [(i, j % 2, 0) for j, i in enumerate((3, 4, 6, 7, 8, 9, -1, 2**40, 10))] + [(None, 1, None), (5, None, 0), (4, 1, 1)]
    got = q.quality_scores(frame(spark, rows), labels(spark, some)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert q.quality_scores(frame(spark, []), labels(spark, some)).count() == 0


def test_stage_keeps_rows_as_they_are(spark):
    df = frame(spark, ODD, extra=True)
    out = q.accepted(df, labels(spark, []))
    assert out.columns == df.columns and sorted(map(repr, out.collect())) == sorted(map(repr, df.collect()))


def test_statistics_are_finite():
    for text in (b"", b" ", b"\n", b"a", b"\xff\xfe", b"A" * 10**5, "é à".encode()):
        values = q.statistics(text)
        assert len(values) == len(q.STATISTICS) and np.isfinite(values).all()


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    d = len(q.STATISTICS)
    x = rng.standard_normal((40, d))
    z = q.random_map(np.zeros(d), np.ones(d), features=20_000)(x)[:, :-1]
    squared = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-squared / (4 * d))).max() < 0.05


def test_pooling_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = rng.integers(1, 9)
        v, w = rng.random(n), rng.integers(1, 5, n).astype(float)
        # the fit at i is the max over a <= i of the min over b >= i of the mean of a..b
        mean = lambda a, b: np.average(v[a:b + 1], weights=w[a:b + 1])
        want = [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert q.pool_adjacent_violators(v, w) == pytest.approx(want)
