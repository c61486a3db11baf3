"""End-to-end pipelines (P1-P4), each a composition of the operators.

Inputs are DataFrames in the reference's raw shape (string ids, epoch
seconds); outputs are DataFrames, and writers are only called when a path is
given. Frames used by several actions are stored in the shared checkpoint
folder (a lost executor costs nothing; the files go when the driver's JVM
exits) or persisted by the run object, whose ``close()`` releases them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame

from shelfwise.operators import als, ids, metrics, neural, prep, scoring, split
from shelfwise.schema import ITEM, USER
from shelfwise.session import release_unused, scratch_path
from shelfwise.sources import sinks


@dataclass
class AlsRun:
    model: ALSModel
    recommendations: DataFrame  # (user_id string, item_id string, predicted_rating float)
    report: DataFrame  # one row: rmse, mae, precision_at_k, recall_at_k, ndcg_at_k, k
    user_dictionary: DataFrame
    item_dictionary: DataFrame


def stored(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept as compressed Parquet in the shared
    checkpoint folder (a checkpoint is uncompressed rows) until the driver's JVM
    exits. The shuffles that computed it are deleted, if nobody holds ``df``."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, "stored")
    df.write.option("compression", "zstd").parquet(path)
    del df
    release_unused(spark)
    return spark.read.schema(schema).parquet(path)


def one_row(df: DataFrame) -> DataFrame:
    """A one-row result by value, free of the frames it came from."""
    return df.sparkSession.createDataFrame([df.first()], df.schema)


def run_als(raw: DataFrame, k: int = 10, params: als.AlsParams = als.AlsParams(),
            out_dir: str | None = None, mean_per_pair: bool = False,
            user_dictionary: DataFrame | None = None,
            item_dictionary: DataFrame | None = None) -> AlsRun:
    """Dictionaries -> index -> 80/20 split -> ALS -> top-k for the test
    users -> ids restored -> metric report (-> sinks).

    Dictionaries are built from the data (J1) unless given, e.g. the
    reference's JSON id maps read with ``sinks.read_json_dictionary``; rows
    whose id is missing from a given dictionary are dropped.

    ALS sees every training row, as in the reference (a repeated pair weighs
    more). ALS keeps each user's ratings in one block, so a user holding a
    large share of all rows makes one slow task; ``mean_per_pair=True``
    first collapses the training rows to one mean rating per pair (D1), which
    bounds every user by the catalogue size, and every item by the number of
    users, at the price of that weighting.
    """
    raw = stored(raw)
    user_dict = user_dictionary if user_dictionary is not None else ids.build_dictionary(raw, USER)
    item_dict = item_dictionary if item_dictionary is not None else ids.build_dictionary(raw, ITEM)
    indexed = stored(ids.index_interactions(raw, user_dict, item_dict))
    parts = split.train_test_split(indexed)
    train, test = parts["train"], parts["test"]
    if mean_per_pair:
        train = prep.user_item_matrix(train)
    model = als.fit(train, params)
    recs_idx = stored(als.recommend_for_users(model, test, k))
    predictions = als.predict(model, test)
    report = one_row(metrics.metric_report(recs_idx, test, predictions, k))
    recs = ids.decode(ids.decode(recs_idx, user_dict, USER), item_dict, ITEM)
    if out_dir is not None:
        sinks.write_parquet(recs, f"{out_dir}/recommendations")
        sinks.append_metrics(report, f"{out_dir}/metrics")
        sinks.save_model(model, f"{out_dir}/als_model", latest_path=f"{out_dir}/latest_model")
        sinks.write_dictionary(user_dict, f"{out_dir}/user_dictionary")
        sinks.write_dictionary(item_dict, f"{out_dir}/item_dictionary")
    return AlsRun(model, recs, report, user_dict, item_dict)


def run_preprocess(raw: DataFrame, out_dir: str | None = None, fmt: str = "parquet",
                   buckets: int = 64) -> tuple[DataFrame, DataFrame]:
    """Clean (B1, B2, B10) -> write by user bucket -> user-item matrix
    (D1) -> write. The cleaned rows are stored once, so the second write does
    not recompute the scan and the de-duplication."""
    clean = stored(prep.preprocess_interactions(raw))
    matrix = prep.user_item_matrix(clean)
    if out_dir is not None:
        sinks.write_table(clean, f"{out_dir}/interactions", fmt, bucket_user=USER, buckets=buckets)
        sinks.write_table(matrix, f"{out_dir}/user_item_matrix", fmt)
    return clean, matrix


@dataclass
class NeuralRun:
    model: PipelineModel
    candidates: DataFrame
    test_metrics: DataFrame
    user_factors: DataFrame
    item_factors: DataFrame
    model_path: str | None
    parts: dict[str, DataFrame]
    cached: list[DataFrame] = field(default_factory=list)

    def close(self) -> None:
        """Release what the run cached, if anything; the factors are read from the model's files."""
        for df in self.cached:
            df.unpersist()


def run_neural(matrix: DataFrame, candidates=(neural.MlpParams(),), rank: int = 32,
               model_dir: str | None = None) -> NeuralRun:
    """User-item matrix (int ids) -> 80/10/10 split -> ALS factors on
    train -> features -> MLP candidates selected on val (J6) -> test
    evaluation (J7) -> saved winner (A10)."""
    parts = split.train_val_test_split(stored(matrix))
    model_als = als.fit(parts["train"], als.AlsParams(rank=rank))
    uf, itf = als.factors(model_als)
    feats = {
        name: neural.with_label(neural.pair_features(df, uf, itf))
        for name, df in parts.items()
    }
    # The train features are placed, and kept, by the fit; test is read once.
    val = feats["val"].persist()
    best, table = neural.select_model(feats["train"], val, rank, list(candidates))
    val.unpersist()
    test_metrics = one_row(neural.evaluate(best, feats["test"]))
    path = None
    if model_dir is not None:
        path = sinks.save_model(best, f"{model_dir}/mlp", latest_path=f"{model_dir}/latest")
        model_als.write().overwrite().save(f"{model_dir}/als_factors")
    return NeuralRun(best, table, test_metrics, uf, itf, path, parts)


def run_serving(users: DataFrame, user_factors: DataFrame, item_factors: DataFrame, k: int = 10,
                exclusions: DataFrame | None = None, model: PipelineModel | None = None,
                out_path: str | None = None, fmt: str = "parquet",
                user_dictionary: DataFrame | None = None,
                item_dictionary: DataFrame | None = None) -> DataFrame:
    """Top-k for every requested user in one job (F2), excluded items
    removed first (B13); users without factors get no rows (B14). With a
    neural ``model`` the catalogue is scored by the network (J5), else by the
    factor dot product. Indexes are turned back into the original ids when
    dictionaries are given (C4). Written partitioned by user bucket (A5)."""
    wanted = user_factors.join(users.select(USER).distinct(), USER, "left_semi")
    scorer = neural.scorer_of(model) if model is not None else scoring.DotScorer()
    recs = scoring.topk_vectors(wanted, item_factors, k, scorer, exclusions)
    if user_dictionary is not None:
        recs = ids.decode(recs, user_dictionary, USER)
    if item_dictionary is not None:
        recs = ids.decode(recs, item_dictionary, ITEM)
    out = sinks.served(recs)
    if out_path is not None:
        sinks.write_table(out, out_path, fmt, bucket_user=USER)
    return out

