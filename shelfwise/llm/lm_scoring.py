"""LM scoring (operator 4): n-grams with deleted interpolation.

P_k(w | h) = L * c(h w) / c(h) + (1 - L) * P_{k-1}(w | shorter h), down to a
uniform share; L depends on the order and on the bucket floor(log2 c(h)). The
weights are learned by expectation-maximisation on the training counts with
the counted occurrence itself deleted.

The counts grow with the corpus and are never gathered in one place. Documents
are cut into blocks; a block asks for its distinct n-grams (hash and count in
its training documents, one message per range of hashes), each range sums the
counts of all blocks and answers in the same order, and the block scores its
documents from the answers. Blocks are checkpointed by block, so the passes
that follow don't shuffle text.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir

from .common import binary_values, byte_slices, distinct_index, encoded_words, id_and_text, id_fold, mix, staged

BLOCK_BYTES = 8 << 20
#: n-gram requests a range of hashes gets, about.
RANGE_REQUESTS = 2 << 20
HELD_OUT_FOLD = 1
#: Expectation-maximisation sees likelihood ratios in steps of 1/32 octave.
RATIO_STEPS, RATIO_LOW, RATIO_HIGH = 32, -40, 60
EM_ROUNDS = 100
_END = np.uint64(0xA24BAED4963EE407)    # not the hash of a word but for a 2**-64 chance
_BEGIN = np.uint64(0x9FB21C651E98DF25)
_MULT = np.uint64(0x9E3779B97F4A7C15)


# -- blocks -------------------------------------------------------------------

def _make_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    pack = zstandard.ZstdCompressor(level=3).compress
    for number, part in enumerate(byte_slices(batches, limit=BLOCK_BYTES)):
        lines = [b" ".join(t.lower().split()) for t in binary_values(part.column("text"))]
        words = sum(line.count(b" ") + 1 for line in lines if line)
        one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        yield pa.RecordBatch.from_arrays(
            [pa.array([base + number], pa.int64()), pa.array([words + len(lines)], pa.int64()),
             one(part.column("id")), one(part.column("held_out")),
             pa.array([pack(b"\n".join(lines))], pa.binary())],
            ["block", "tokens", "ids", "held_out", "payload"])


class _Block:
    """Tokens of a block's documents and their distinct n-grams."""

    def __init__(self, payload: bytes, held_out: list[bool], order: int):
        docs = zstandard.ZstdDecompressor().decompress(payload).split(b"\n")
        sizes, code, distinct = encoded_words(docs)
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        is_word = np.ones(len(code) + len(docs), bool)
        is_word[self.ends] = False
        keys, at = np.unique(np.append(distinct, _END), return_inverse=True)
        index = np.full(len(is_word), at[-1])
        index[is_word] = at[:-1][code]
        tokens = keys[index]
        self.n_tokens = sizes + 1
        trained = np.repeat(~np.asarray(held_out, bool), self.n_tokens)
        self.keys, self.index, self.counts = [], [], []
        gram = tokens
        for k in range(1, order + 1):
            if k > 1:
                shorter = np.empty_like(gram)
                shorter[1:] = gram[:-1]
                shorter[self.starts] = _BEGIN
                with np.errstate(over="ignore"):
                    gram = mix(shorter * _MULT + tokens + np.uint64(k))
                keys, index = distinct_index(gram)
            self.keys.append(keys)
            self.index.append(index)
            self.counts.append(np.bincount(index, weights=trained, minlength=len(keys)).astype(np.int64))


def _planes(values: np.ndarray) -> bytes:
    """64-bit values as eight planes of bytes, so that small values compress."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


# -- counts -------------------------------------------------------------------

_MESSAGE = "range int, block long, order int, keys binary, counts binary"


def _requests(order: int, ranges: int):
    bounds = np.asarray([(i << 64) // ranges for i in range(1, ranges)], np.uint64)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch.column("payload")[i].as_py(), batch.column("held_out")[i].as_py(), order)
                number = batch.column("block")[i].as_py()
                rows: list[list] = [[], [], [], [], []]
                for k, (keys, counts) in enumerate(zip(block.keys, block.counts), 1):
                    cut = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
                    for r in range(ranges):
                        lo, hi = cut[r], cut[r + 1]
                        if lo < hi:
                            steps = np.diff(keys[lo:hi], prepend=np.uint64(0))
                            for column, v in zip(rows, (r, number, k, _planes(steps), _planes(counts[lo:hi]))):
                                column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    ["range", "block", "order", "keys", "counts"])
    return emit


def _answer(table: pa.Table) -> pa.Table:
    """Sum a range's counts over all blocks; one answer per request, and for
    order 1 a row without block: (count, types with it) pairs in octave steps."""
    out: list[list] = [[], [], [], []]
    orders = table.column("order").to_numpy()
    for k in np.unique(orders).tolist():
        part = table.filter(pa.array(orders == k))
        with np.errstate(over="ignore"):
            keys = [np.cumsum(_unplanes(x), dtype=np.uint64) for x in part.column("keys").to_pylist()]
        counts = np.concatenate([_unplanes(x) for x in part.column("counts").to_pylist()])
        distinct, index = distinct_index(np.concatenate(keys))
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, index, counts.astype(np.int64))
        answers = np.split(total[index], np.cumsum([len(x) for x in keys])[:-1])
        for block, answer in zip(part.column("block").to_pylist(), answers):
            for column, v in zip(out, (block, k, table.column("range")[0].as_py(), _planes(answer))):
                column.append(v)
        if k == 1:
            seen = total[total > 0]
            step = np.floor(np.log2(seen) * RATIO_STEPS).astype(np.int64)
            for s in np.unique(step).tolist():
                own = seen[step == s]
                stats = _planes(np.asarray([s, len(own), own.sum()]))
                for column, v in zip(out, (None, 0, table.column("range")[0].as_py(), stats)):
                    column.append(v)
    return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                     pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
                    ["block", "order", "range", "data"])


def _unpack_stats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_unplanes(x).astype(np.int64) for x in batch.column("data").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([int(r[i]) for r in rows], pa.int64()) for i in range(3)],
                                         ["step", "types", "tokens"])


# -- weights ------------------------------------------------------------------

def em_weight(ratio: np.ndarray, weight: np.ndarray, rounds: int = EM_ROUNDS) -> float:
    """Weight of the first of two components whose likelihood ratio at each
    observation is ``ratio``, by expectation-maximisation."""
    if weight.sum() <= 0:
        return 0.0
    share = 0.5
    for _ in range(rounds):
        share = float((weight * (share * ratio / (share * ratio + 1 - share))).sum() / weight.sum())
        share = min(max(share, 1e-9), 1 - 1e-9)
    return share


class Model:
    """Totals and mixture weights; bounded, whatever the corpus."""

    def __init__(self, tokens: int, types: int, order: int):
        self.tokens, self.types, self.order = tokens, types, order
        self.unigram = 0.0
        self.weights: dict[int, np.ndarray] = {}  # order -> weight by bucket of c(h)

    def base(self, counts: np.ndarray, deleted: int = 0) -> np.ndarray:
        """P_1; ``deleted``: with so many occurrences taken from the counts."""
        total = max(self.tokens - deleted, 1)
        seen = np.maximum(counts - deleted, 0) / total
        return self.unigram * seen + (1 - self.unigram) / (self.types + 1)

    def mixed(self, lower: np.ndarray, k: int, counts: np.ndarray, context: np.ndarray,
              deleted: int = 0) -> np.ndarray:
        weight = self.weights[k][bucket(context)]
        return weight * relative(counts, context, deleted) + (1 - weight) * lower


def bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0 for unseen, then 1 + floor(log2)."""
    return np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0)


def relative(counts: np.ndarray, context: np.ndarray, deleted: int = 0) -> np.ndarray:
    return np.maximum(counts - deleted, 0) / np.maximum(context - deleted, 1)


def _counts_of(block: _Block, answers: pa.Table) -> list[np.ndarray]:
    """Corpus count of every token's n-gram, by order."""
    rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("order", "range", "data"))), key=lambda r: r[:2])
    out = []
    for k, index in enumerate(block.index, 1):
        out.append(np.concatenate([_unplanes(d) for o, _, d in rows if o == k]).astype(np.int64)[index])
    return out


def _contexts(block: _Block, counts: list[np.ndarray], k: int, documents: int) -> np.ndarray:
    """c(h) of every token for order k; the context of a first token is the
    beginning, counted once per training document."""
    context = np.empty_like(counts[0])
    context[1:] = counts[k - 2][:-1]
    context[block.starts] = documents
    return context


def _documents(block: _Block, counts: list[np.ndarray]) -> int:
    return int(counts[0][block.ends[0]])  # as many ends as training documents


def _ratios(order: int, model: Model, k: int):
    """Histogram of likelihood ratios of order k against k - 1, per bucket, over
    the training tokens with the token itself deleted from the counts."""
    def emit(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in blocks.to_pylist():
            block = _Block(row["payload"], row["held_out"], order)
            counts = _counts_of(block, answers)
            documents = _documents(block, counts)
            lower = model.base(counts[0], 1)
            for j in range(2, k):
                lower = model.mixed(lower, j, counts[j - 1], _contexts(block, counts, j, documents), 1)
            context = _contexts(block, counts, k, documents)
            ratio = relative(counts[k - 1], context, 1) / lower
            step = np.clip(np.floor(np.log2(np.maximum(ratio, 1e-300)) * RATIO_STEPS),
                           RATIO_LOW * RATIO_STEPS - 1, RATIO_HIGH * RATIO_STEPS).astype(np.int64)
            trained = np.repeat(~np.asarray(row["held_out"], bool), block.n_tokens)
            code = bucket(context)[trained] << 32 | (step[trained] + (1 << 30))
            value, n = np.unique(code, return_counts=True)
            out.append((value >> 32, (value & 0xFFFFFFFF) - (1 << 30), n))
        merged = [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3
        return pa.table([pa.array(x.astype(np.int64)) for x in merged], ["bucket", "step", "n"])
    return emit


def _scores(order: int, model: Model, id_type: pa.DataType):
    def emit(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        tables = []
        for i, row in enumerate(blocks.to_pylist()):
            block = _Block(row["payload"], row["held_out"], order)
            counts = _counts_of(block, answers)
            documents = _documents(block, counts)
            p = model.base(counts[0])
            for k in range(2, order + 1):
                p = model.mixed(p, k, counts[k - 1], _contexts(block, counts, k, documents))
            flat = np.log10((counts[0] + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
            by_doc = lambda x: np.add.reduceat(x, block.starts)  # noqa: E731  every text has its end
            tables.append(pa.table(
                [pa.array(row["ids"], id_type), pa.array(row["held_out"], pa.bool_()),
                 pa.array(block.n_tokens), pa.array(by_doc((counts[0] > 0).astype(np.int64))),
                 pa.array(np.full(len(block.starts), model.tokens)),
                 pa.array(by_doc(flat)), pa.array(by_doc(np.log10(p)))],
                ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(tables)
    return emit


def lm_scores(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score),
    one row per input row.

    A model of n-grams up to ``order`` words learns from the rows whose
    crc32(id as text) mod 5 is not 1 and scores all rows. A null or empty text
    is the end token alone. A null id counts as not held out. Repeated rows
    count, and are scored, once each. Without training rows all counts are 0.
    Other columns are ignored; an empty table gives no rows. N-grams are told
    apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    slim = docs.select(
        *id_and_text(docs, id_col, text_col),
        F.coalesce(id_fold(F.col(id_col)) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"))
    kind = slim.schema["id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = (slim.mapInArrow(_make_blocks, f"block long, tokens long, ids array<{kind}>, "
                                            "held_out array<boolean>, payload binary")
              .repartition(parts, "block").checkpoint())
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    ranges = max(1, math.ceil(tokens * order / RANGE_REQUESTS))
    answers = staged(
        blocks.select("block", "held_out", "payload").mapInArrow(_requests(order, ranges), _MESSAGE)
        .groupBy("range").applyInArrow(_answer, "block long, order int, range int, data binary"), "lm-answers")
    stats = (answers.where("order = 0").select("data").mapInArrow(_unpack_stats, "step long, types long, tokens long")
             .groupBy("step").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).collect())
    model = Model(sum(r["tokens"] for r in stats), sum(r["types"] for r in stats), order)
    mean = np.asarray([r["tokens"] / r["types"] for r in stats])
    share = (mean - 1) / max(model.tokens - 1, 1) * (model.types + 1)  # against the uniform share
    model.unigram = em_weight(share, np.asarray([float(r["tokens"]) for r in stats]))

    def with_answers(function, schema: str) -> DataFrame:
        return (blocks.groupBy("block").cogroup(answers.where("order > 0").groupBy("block"))
                .applyInArrow(function, schema))

    for k in range(2, order + 1):
        found = (with_answers(_ratios(order, model, k), "bucket long, step long, n long")
                 .groupBy("bucket", "step").agg(F.sum("n").alias("n")).collect())  # buckets x steps
        learned = np.zeros(66)
        for b in {r["bucket"] for r in found if r["bucket"] > 0}:
            own = [(r["step"], r["n"]) for r in found if r["bucket"] == b]
            step, n = np.asarray(own, float).T
            ratio = np.where(step < RATIO_LOW * RATIO_STEPS, 0.0, 2.0 ** ((step + 0.5) / RATIO_STEPS))
            learned[b] = em_weight(ratio, n)
        model.weights[k] = learned
    id_type = pa.from_numpy_dtype(np.int64) if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    return with_answers(
        _scores(order, model, id_type),
        f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double").withColumnRenamed("id", id_col)
