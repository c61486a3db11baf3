"""ALS with split keys (J2) and fold-in of new users (K3): ridge least squares
of each id's ratings against the other side's fixed vectors.

Spark ML's ALS keeps an id's ratings in one block, so an id with a third of all
rows is one task per half-iteration. Here rows are placed by (id, salt): an id
with more than ``rows_per_cell`` rows is cut into cells that go to different
parts in turn. Each part pulls every vector it needs once, sums the normal
equations of its cells, and solves those of whole ids on the spot; the sums of a
cut id (its Gram matrix and right side, a fixed width) are added by a hash
aggregate and solved after that. No task holds a whole hot id.

The equations are those of Spark ML's explicit feedback:
``(sum v v' + reg * n * I) x = sum rating * v``, n the id's rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.placement import fixed_plans
from shelfwise.schema import ITEM, RATING, USER
from shelfwise.session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CHUNK = 65_536  # rows whose outer products exist at a time


@dataclass(frozen=True)
class SplitAlsParams:
    """As :class:`shelfwise.operators.als.AlsParams`, explicit feedback.
    ``rows_per_cell`` defaults to a quarter of an even share of the rows."""

    max_iter: int = 10
    reg_param: float = 0.1
    rank: int = 10
    seed: int = 42
    partitions: int | None = None
    rows_per_cell: int | None = None


@dataclass
class Placed:
    """One side's rows by part, and which vectors of the other side go where."""

    rows: DataFrame   # (part, id, other, rating, whole)
    needs: DataFrame  # (id: of the other side, to: a part)
    partitions: int


def place(ratings: DataFrame, key: str, other: str, rating: str, partitions: int,
          rows_per_cell: int | None = None) -> Placed:
    """Rows with a null are left out. Call inside :func:`fixed_plans`."""
    rows = ratings.select(F.col(key).cast("long").alias("id"), F.col(other).cast("long").alias("other"),
                          F.col(rating).cast("double").alias("rating")).dropna().checkpoint()
    per_cell = rows_per_cell or max(1, rows.count() // (4 * partitions))
    cells = (rows.groupBy("id").agg(F.ceil(F.count(F.lit(1)) / per_cell).alias("cells"))
             .where("cells > 1").withColumnRenamed("id", "cut"))
    # fewer than 4 x partitions ids can have more than per_cell rows by default
    cells = F.broadcast(cells) if rows_per_cell is None else cells
    salted = rows.join(cells, F.col("id") == F.col("cut"), "left")
    salt = F.coalesce(F.pmod(F.xxhash64("other", "rating"), F.col("cells")), F.lit(0))
    part = F.pmod(F.xxhash64("id") + salt, F.lit(partitions)).cast("int")
    placed = (salted.select(part.alias("part"), "id", "other", "rating", F.col("cells").isNull().alias("whole"))
              .repartition(partitions, "part").checkpoint())
    needs = (placed.select(F.col("other").alias("id"), F.col("part").alias("to")).distinct()
             .repartition(partitions, "id").checkpoint())
    return Placed(placed, needs, partitions)


def _solved(gram: np.ndarray, right: np.ndarray, n: np.ndarray, reg: float) -> np.ndarray:
    ridge = gram + (reg * n)[:, None, None] * np.eye(gram.shape[1])
    # without ridge an id with few rows has many solutions: the shortest
    return (np.linalg.solve(ridge, right[:, :, None]) if reg > 0
            else np.linalg.pinv(ridge, hermitian=True) @ right[:, :, None])[:, :, 0]


def normal_sums(slot: np.ndarray, slots: int, vectors: np.ndarray, rating: np.ndarray):
    """Per slot: sum of v v', sum of rating * v, number of rows."""
    rank = vectors.shape[1]
    gram, right = np.zeros((slots, rank, rank)), np.zeros((slots, rank))
    order = np.argsort(slot, kind="stable")
    for lo in range(0, len(order), _CHUNK):
        at = order[lo:lo + _CHUNK]
        v, own = vectors[at], slot[at]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        gram[own[first]] += np.add.reduceat(v[:, :, None] * v[:, None, :], first)
        right[own[first]] += np.add.reduceat(v * rating[at][:, None], first)
    return gram, right, np.bincount(slot, minlength=slots).astype(float)


def _part_sums(reg: float):
    """Cogroup of a part's rows with the vectors they need: ``vec`` of whole
    ids, ``sums`` (Gram matrix, right side, n) of cut ones. Rows whose other id
    has no vector do not count."""
    def run(rows: pa.Table, vectors: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("vec", pa.list_(pa.float64())), ("sums", pa.list_(pa.float64()))])
        if rows.num_rows == 0 or vectors.num_rows == 0:
            return schema.empty_table()
        known, at = np.unique(vectors.column("id").to_numpy(), return_index=True)
        vecs = np.stack(vectors.column("vec").to_numpy())[at].astype(np.float64)
        other = rows.column("other").to_numpy()
        place = np.minimum(np.searchsorted(known, other), len(known) - 1)
        use = np.flatnonzero(known[place] == other)
        ids, slot = np.unique(rows.column("id").to_numpy()[use], return_inverse=True)
        gram, right, n = normal_sums(slot, len(ids), vecs[place[use]], rows.column("rating").to_numpy()[use])
        whole = np.zeros(len(ids), bool)
        whole[slot] = rows.column("whole").to_numpy()[use]
        done = iter(_solved(gram[whole], right[whole], n[whole], reg))
        partial = iter(np.concatenate([gram[~whole].reshape(-1, gram.shape[1] ** 2), right[~whole], n[~whole, None]], axis=1))
        vec = [next(done) if w else None for w in whole]
        sums = [None if w else next(partial) for w in whole]
        return pa.table([pa.array(ids), pa.array(vec, schema.field("vec").type),
                         pa.array(sums, schema.field("sums").type)], schema=schema)

    return run


def _solve_sums(reg: float, rank: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.stack(batch.column("sums").to_numpy(zero_copy_only=False))
                vec = _solved(s[:, :rank * rank].reshape(-1, rank, rank), s[:, rank * rank:-1], s[:, -1], reg)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(vec), pa.list_(pa.float64()))], ["id", "vec"])
    return run


def half_step(placed: Placed, vectors: DataFrame, reg: float, rank: int) -> DataFrame:
    """``(id, vec)`` of the placed side, from the other side's ``(id, vec)``.
    Call inside :func:`fixed_plans`."""
    pulled = placed.needs.join(vectors, "id").select("to", "id", "vec").repartition(placed.partitions, "to")
    found = (placed.rows.groupBy("part").cogroup(pulled.groupBy("to"))
             .applyInArrow(_part_sums(reg), "id long, vec array<double>, sums array<double>").checkpoint())
    size = rank * rank + rank + 1
    added = (found.where("sums is not null").groupBy("id")
             .agg(*[F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(size)])
             .select("id", F.array(*[f"s{j}" for j in range(size)]).alias("sums")))
    split = added.mapInArrow(_solve_sums(reg, rank), "id long, vec array<double>")
    return (found.where("vec is not null").select("id", "vec").unionByName(split)
            .repartition(placed.partitions, "id").checkpoint())


def _unit_vectors(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """Directions from hashes of the id: normal deviates, scaled to length one."""
    def uniform(j, which: int):
        return (F.shiftrightunsigned(F.xxhash64(F.col("id"), j, F.lit(which), F.lit(seed)), 11) + 0.5) * 2.0**-53

    raw = F.transform(F.sequence(F.lit(0), F.lit(rank - 1)),
                      lambda j: F.sqrt(F.lit(-2.0) * F.ln(uniform(j, 0))) * F.cos(F.lit(2 * np.pi) * uniform(j, 1)))
    length = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda a, x: a + x * x))
    return ids.withColumn("raw", raw).withColumn("length", length).select(
        "id", F.transform("raw", lambda x: x / F.col("length")).alias("vec"))


def fit(train: DataFrame, params: SplitAlsParams = SplitAlsParams(), user: str = USER, item: str = ITEM,
        rating: str = RATING, start: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(user_id, features)`` and ``(item_id, features)`` after ``max_iter``
    iterations (items first, as Spark ML). ``start``: user factors to begin
    with, ``(user_id, features)``; unit vectors hashed from the ids otherwise."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    partitions = params.partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with fixed_plans(spark, partitions):
        by_user = place(train, user, item, rating, partitions, params.rows_per_cell)
        by_item = place(train, item, user, rating, partitions, params.rows_per_cell)
        if start is None:
            users = _unit_vectors(by_item.needs.select("id").distinct(), params.rank, params.seed)
        else:
            users = start.select(F.col(user).cast("long").alias("id"), F.col("features").cast("array<double>").alias("vec"))
        users = users.repartition(partitions, "id").checkpoint()
        items = None
        for _ in range(params.max_iter):
            items = half_step(by_item, users, params.reg_param, params.rank)
            users = half_step(by_user, items, params.reg_param, params.rank)
        if items is None:
            items = half_step(by_item, users, params.reg_param, params.rank)
    return (users.select(F.col("id").alias(user), F.col("vec").alias("features")),
            items.select(F.col("id").alias(item), F.col("vec").alias("features")))


def fold_in(ratings: DataFrame, item_factors: DataFrame, reg_param: float = 0.1, user: str = USER, item: str = ITEM,
            rating: str = RATING, partitions: int | None = None, rows_per_cell: int | None = None) -> DataFrame:
    """K3: ``(user_id, features)`` of users a model has not seen, from their
    ratings and the model's fixed item factors. Items without factors do not
    count; a user with no other item gets no row."""
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = item_factors.select(F.col(item).cast("long").alias("id"), F.col("features").cast("array<double>").alias("vec"))
    rank = vectors.select(F.size("vec").alias("n")).first()
    if rank is None:
        return spark.createDataFrame([], f"{user} long, features array<double>")
    with fixed_plans(spark, partitions):
        placed = place(ratings, user, item, rating, partitions, rows_per_cell)
        found = half_step(placed, vectors, reg_param, rank.n)
    return found.select(F.col("id").alias(user), F.col("vec").alias("features"))


def predict(user_factors: DataFrame, item_factors: DataFrame, pairs: DataFrame, user: str = USER,
            item: str = ITEM) -> DataFrame:
    """``pairs`` + ``prediction``; pairs without both vectors are dropped."""
    u = user_factors.select(F.col(user).alias("_u"), F.col("features").alias("_uv"))
    i = item_factors.select(F.col(item).alias("_i"), F.col("features").alias("_iv"))
    dot = F.aggregate(F.zip_with("_uv", "_iv", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return (pairs.join(u, pairs[user] == u["_u"]).join(i, pairs[item] == i["_i"])
            .withColumn("prediction", dot).drop("_u", "_i", "_uv", "_iv"))
