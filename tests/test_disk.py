"""What fits, stored frames and placements leave on the disks."""

import os
import time
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import als, ncf


def _ratings(spark, n=400):
    rng = np.random.default_rng(1)
    rows = [(int(u), int(i), int(r)) for u, i, r in zip(rng.integers(0, 40, n), rng.integers(0, 30, n), rng.integers(1, 6, n))]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating int")


def _shuffle_files(spark):
    return spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    from shelfwise.plans.pipelines import stored

    stored(spark.range(1))  # what earlier tests left is released
    time.sleep(3)
    before = _shuffle_files(spark)
    kept = stored(_ratings(spark).repartition(5, "user_id").groupBy("user_id").count())
    until = time.time() + 10
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)  # Spark's cleaner is a thread of its own
    assert _shuffle_files(spark) <= before and kept.count() == 40


@pytest.mark.parametrize("implicit", [False, True])
def test_a_fitted_model_hangs_on_no_shuffle_and_no_cached_block(spark, implicit):
    cached = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = cached()
    model = als.fit(_ratings(spark), als.AlsParams(rank=3, max_iter=3, implicit_prefs=implicit))
    until = time.time() + 10
    while cached() > before and time.time() < until:
        time.sleep(0.2)
    assert cached() <= before
    for side in als.factors(model):
        assert side.inputFiles() and side.schema["features"].dataType.simpleString() == "array<float>"
    assert model.rank == 3 and als.predict(model, _ratings(spark)).where("prediction is null").count() == 0


def test_als_iterations_are_cut_before_their_shuffles_pile_up():
    # Spark ML deletes the shuffles of earlier iterations where it checkpoints
    assert als.AlsParams().checkpoint_interval <= 2 < als.AlsParams().max_iter


def test_a_joint_fit_keeps_the_checkpoints_of_one_step(spark):
    folder = urlparse(spark.sparkContext.getCheckpointDir()).path
    frames = lambda: {f for f in os.listdir(folder) if f.startswith("rdd-")}
    before = frames()
    model = ncf.fit(_ratings(spark), ncf.NcfParams(embedding_dim=4, layers=(6, 5), epochs=2, batches=2, partitions=2))
    assert len(frames() - before) <= 2  # users and items, not every step's
    assert model.users.count() == 40 and model.items.count() == 30


def test_a_groups_gradients_do_not_depend_on_the_chunk(monkeypatch):
    rng = np.random.default_rng(2)
    p = ncf.NcfParams(embedding_dim=3, layers=(5, 4), dropout=0.3)
    user, item = rng.integers(0, 9, 50), rng.integers(10, 17, 50)
    rows = pa.table({"user": user, "item": item, "label": rng.integers(0, 2, 50).astype(float)})
    ids = np.append(np.arange(9), np.arange(10, 17))
    vectors = pa.table({"side": pa.array((ids >= 10).astype(int), pa.int32()), "id": ids,
                        "vec": pa.array(list(rng.normal(size=(16, 3))), pa.list_(pa.float64()))})
    run = ncf._group_gradients(ncf.initial_dense(p), 1, p)
    whole = run(rows, vectors).to_pylist()
    sizes, plain = [], ncf.forward_backward
    monkeypatch.setattr(ncf, "_CHUNK", 7)
    monkeypatch.setattr(ncf, "forward_backward", lambda x, *rest: sizes.append(len(x)) or plain(x, *rest))
    cut = run(rows, vectors).to_pylist()
    assert max(sizes) == 7 and sum(sizes) == 50
    assert [(r["side"], r["id"]) for r in whole] == [(r["side"], r["id"]) for r in cut]
    for a, b in zip(whole, cut):
        np.testing.assert_allclose(a["grad"], b["grad"], atol=1e-12)
