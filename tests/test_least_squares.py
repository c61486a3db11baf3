"""ALS with split keys against Spark ML's, fold-in against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import als, least_squares, placement
from shelfwise.sources import tables


def _hot(spark, n=3000):
    """A third of all rows is user 5's, another third item 3's."""
    rng = np.random.default_rng(2)
    rows = [(5, int(i), float(r)) for i, r in zip(rng.integers(0, 60, n), rng.integers(1, 6, n))]
    rows += [(int(u), 3, float(r)) for u, r in zip(rng.integers(0, 80, n), rng.integers(1, 6, n))]
    rows += [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 80, n), rng.integers(0, 60, n), rng.integers(1, 6, n))]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating float")


@pytest.mark.parametrize("cell", [None, 50])
def test_factors_equal_spark_ml(spark, cell):
    train = _hot(spark).checkpoint()
    kw = dict(rank=4, reg_param=0.1)
    start, _ = als.factors(als.fit(train, als.AlsParams(max_iter=0, **kw)))
    want = als.factors(als.fit(train, als.AlsParams(max_iter=3, **kw)))
    got = least_squares.fit(train, least_squares.SplitAlsParams(max_iter=3, partitions=6, rows_per_cell=cell, **kw), start=start)
    for mine, theirs, c in zip(got, want, ("user_id", "item_id")):
        a = {r[c]: np.array(r.features) for r in mine.collect()}
        b = {r[c]: np.array(r.features) for r in theirs.collect()}
        assert a.keys() == b.keys()
        assert max(np.abs(a[k] - b[k]).max() for k in a) < 1e-4


def test_a_hot_id_is_spread_over_all_parts(spark):
    with placement.fixed_plans(spark, 16):
        for key, other in (("user_id", "item_id"), ("item_id", "user_id")):
            placed = least_squares.place(_hot(spark), key, other, "rating", 16)
            sizes = sorted(r["count"] for r in placed.rows.groupBy("part").count().collect())
            assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]


def test_own_start_lowers_the_error(spark):
    train = tables.planted(spark, SF_SMALL).select("user_id", "item_id", "rating")
    factors = least_squares.fit(train, least_squares.SplitAlsParams(max_iter=8, rank=8, reg_param=0.02))
    pred = least_squares.predict(*factors, train)
    assert pred.count() == train.count()
    assert pred.agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0] < 0.5


@pytest.mark.parametrize("cell", [None, 10])
def test_fold_in_equals_numpy(spark, cell):
    rng = np.random.default_rng(4)
    items = rng.normal(size=(40, 3))
    factors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "item_id long, features array<double>")
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 8, 200), rng.integers(0, 50, 200), rng.normal(size=200))]
    rows += [(99, 45, 1.0), (98, 1, 2.0), (None, 1, 1.0), (98, None, 1.0)]  # 99 rated unknown items only
    got = least_squares.fold_in(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), factors, 0.2,
                                partitions=3, rows_per_cell=cell)
    got = {r.user_id: np.array(r.features) for r in got.collect()}
    assert got.keys() == {*range(8), 98}
    for u, vec in got.items():
        own = [(i, r) for w, i, r in rows if w == u and i is not None and i < 40]
        v = items[[i for i, _ in own]]
        want = np.linalg.solve(v.T @ v + 0.2 * len(own) * np.eye(3), v.T @ np.array([r for _, r in own]))
        np.testing.assert_allclose(vec, want, atol=1e-9)
    assert least_squares.fold_in(spark.createDataFrame([], "user_id long, item_id long, rating double"), factors).count() == 0
