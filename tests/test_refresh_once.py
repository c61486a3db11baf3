"""The refresh stream scores the catalogue once per known user."""

import os

import pytest

from shelfwise.streaming import ingest


@pytest.mark.parametrize("fold_in", [None, 0.1])
def test_a_user_who_comes_again_is_not_scored_again(spark, scratch, monkeypatch, fold_in):
    users = spark.createDataFrame([(u, [float(u), 1.0]) for u in range(5)], "user_id int, features array<float>")
    items = spark.createDataFrame([(i, [float(i % 4), float(i)]) for i in range(12)], "item_id int, features array<float>")
    seen = spark.createDataFrame([(u, i) for u in range(5) for i in range(u)] + [(3, 11)], "user_id int, item_id int")
    base = os.path.join(scratch, f"refresh-{fold_in}")
    batches = [[0, 1, 2, 9], [1, 2, 3, 9], [0, 3, 4]]  # 9 is not in the model
    for n, own in enumerate(batches):
        rows = spark.createDataFrame([(u, (u + n) % 12, 3) for u in own] * 2, "user_id int, item_id int, rating int")
        rows.coalesce(1).write.mode("append").parquet(f"{base}/landing")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/landing")
    scored, plain = [], ingest.scoring.topk_vectors
    monkeypatch.setattr(ingest.scoring, "topk_vectors", lambda wanted, *a, **named: scored.append(
        sorted(r.user_id for r in wanted.collect())) or plain(wanted, *a, **named))
    ingest.refresh_topk(stream, users, items, 4, seen, f"{base}/recs", f"{base}/ck", fold_in=fold_in).awaitTermination()
    again = [9] if fold_in else []  # its ratings grow
    assert scored == [[0, 1, 2, *again], [3, *again], [4]]
    monkeypatch.undo()
    alone = sorted(map(tuple, plain(users, items, 4, exclusions=seen).collect()))
    got = spark.read.parquet(f"{base}/recs")
    for n, own in enumerate(batches):  # every batch has the lists of all its known users
        assert sorted(map(tuple, got.where(f"batch_id = {n} and user_id < 9").drop("batch_id").collect())) == [
            r for r in alone if r[0] in own]
    assert sorted(map(tuple, ingest.latest_recommendations(spark, f"{base}/recs").where("user_id < 9").collect())) == alone
