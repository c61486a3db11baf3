"""MinHash near-dedup (operator 5): one-permutation hashing with optimal
densification, banded buckets, star-shaped candidate edges.

Each distinct shingle set is one node (equal sets are linked by definition).
One permutation spreads a set's hashes over bins and keeps each bin's minimum;
an empty bin borrows from the first non-empty one in its own random order of
the bins. ``ROWS`` bins form a band, and sets that agree on a band share a
bucket. A pair at similarity 0.8 misses all bands with probability
(1 - 0.8**8)**80 = 4e-7.

Within a bucket a center is compared with every member of another component
(a star: as many pairs as members). Links are confirmed on full sets and merge
components; then the center leaves the bucket, and the rest go on with new
centers until each bucket holds one component. So every pair in a bucket is
either compared or already connected, and groups of copies end after one star.
The bands come in two waves, 4 and the rest: most of a group of near copies is one
component after the first and makes hardly any pair in the many bands after it.
The first wave ends after two rounds; its unfinished buckets go on in the second.

Most other pairs of a bucket share a passage and little else. A sketch of 512
parities travels with the members: how many of the set's hashes fall into each
range, odd or even. Sketches that differ in d places belong to sets that differ in
at least d shingles, so a pair whose sketches differ in more places than the
threshold allows shingles is no link, and full sets are compared for the rest only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    arrow_rows,
    binary_values,
    byte_slices,
    drop_staged,
    flat_words,
    id_and_text,
    mix,
    ngram_hashes,
    run_starts,
    staged,
    word_hashes,
)

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 80, 8
BINS = BANDS * ROWS
SKETCH_BITS = 512
#: Centers per bucket in the second round (the first has one), and so many times
#: more in each round after it: a bucket of a million unlike members takes five rounds.
CENTERS = 64
#: Bands that are bucketed at a time, and the rounds each wave takes (None: until
#: its buckets hold one component each); what is left joins the next wave's buckets.
WAVES = ((4, 2), (BANDS - 4, None))
#: Text bytes per slice, and what a row counts besides its text: the bins of its
#: signature and their indexes take some 20 kB, so a slice has at most 256 rows.
SLICE_BYTES, ROW_BYTES = 1 << 20, 1 << 12
#: Texts per Arrow batch, and pairs of sets, at 8 bytes a word a set.
TEXT_ROWS, PAIR_ROWS = 1_000, 256
#: Edges, or nodes with their components, that are read as one partition (8 MB at
#: 32 bytes a row): Spark then joins and groups them without a shuffle.
FEW_ROWS = 250_000


# -- sets and signatures, inside tasks ----------------------------------------

def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the texts' distinct k-word shingles, sorted. A text of
    fewer words has its whole sequence as its one shingle."""
    words, starts = flat_words([t.lower() for t in texts])
    hashes = word_hashes(words)
    counts = np.diff(starts)
    grams = ngram_hashes(hashes, k)
    text = np.repeat(np.arange(len(texts)), counts)
    inside = text[:len(grams)] == text[k - 1:] if len(grams) else np.empty(0, bool)
    owner, value = text[:len(grams)][inside], grams[inside]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = [ngram_hashes(hashes[starts[i]:starts[i + 1]], int(counts[i]))[0] ^ np.uint64(counts[i])
                 for i in short]
        owner, value = np.append(owner, short), np.append(value, np.asarray(whole, np.uint64))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    if len(owner):
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])
        owner, value = owner[new], value[new]
    return owner, value


@lru_cache(maxsize=1)
def _borrow_order() -> np.ndarray:
    """Row j: the order in which empty bin j looks for a bin to borrow from."""
    rng = np.random.default_rng(20240611)
    return np.stack([rng.permutation(BINS) for _ in range(BINS)])


def parities(owner: np.ndarray, value: np.ndarray, n_texts: int) -> np.ndarray:
    """(texts x 8) sketches: bit i is the parity of the number of a set's hashes
    in the i-th of ``SKETCH_BITS`` ranges."""
    place = owner * SKETCH_BITS + (value >> np.uint64(32)).astype(np.int64) * SKETCH_BITS // (1 << 32)
    odd = np.bincount(place, minlength=n_texts * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n_texts, SKETCH_BITS), axis=1).view(np.uint64)


def band_keys(owner: np.ndarray, value: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts x bands) bucket keys and (texts x 8) sketches of sorted sets; rows
    of empty sets are void."""
    bins = ((value >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = run_starts(owner * BINS + bins)  # sorted values: the first of a bin is its minimum
    signature = np.zeros((n_texts, BINS), np.uint64)
    filled = np.zeros((n_texts, BINS), bool)
    signature[owner[first], bins[first]] = value[first]
    filled[owner[first], bins[first]] = True
    rows, cols = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    order = _borrow_order()
    for attempt in range(BINS):
        if len(rows) == 0:
            break
        donor = order[cols, attempt]
        found = filled[rows, donor]
        signature[rows[found], cols[found]] = signature[rows[found], donor[found]]
        rows, cols = rows[~found], cols[~found]
    acc = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (n_texts, BANDS)).copy()
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::ROWS])
    return acc, parities(owner, value, n_texts)


def _signatures_of(k: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text", SLICE_BYTES, ROW_BYTES):
            owner, value = shingle_sets(binary_values(part.column("text")), k)
            sizes = np.bincount(owner, minlength=part.num_rows)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            sig = [xxhash.xxh3_128_digest(value[a:b].tobytes()) if b > a else None
                   for a, b in zip(edges[:-1], edges[1:])]
            lists = []
            for table in band_keys(owner, value, part.num_rows):
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * table.shape[1])
                lists.append(pa.ListArray.from_arrays(offsets, pa.array(table.view(np.int64).reshape(-1))))
            more = [c for c in part.schema.names if c not in ("id", "text")]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(sizes.astype(np.int64)), pa.array(sig, pa.binary()), *lists,
                 *map(part.column, more)],
                ["id", "n_shingles", "node", "bands", "sketch", *more])
    return emit


def _sets_of(k: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text", SLICE_BYTES, ROW_BYTES):
            owner, value = shingle_sets(binary_values(part.column("text")), k)
            edges = np.searchsorted(owner, np.arange(part.num_rows + 1))
            sets = [value[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s) if s else None for s in sets], pa.binary()),
                 pa.array(sets, pa.binary())], ["node", "shingles"])
    return emit


def _confirmed(percent: int):
    """Pairs (a, b, set of a, set of b) whose sets overlap enough."""
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))  # views, no copies
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in "ab"], ["a", "b"])
    return emit


# -- components ---------------------------------------------------------------

def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame, one: bool = False) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return _in_one(moved.unionByName(low.select("a", F.col("m").alias("b"))), one).distinct()


def _in_one(df: DataFrame, one: bool) -> DataFrame:
    return df.coalesce(1) if one else df


def _packed(df: DataFrame, few: int) -> DataFrame:
    """A staged table of at most ``few`` rows as one partition, others as they are."""
    return _in_one(df, bool(few) and df.count() <= few)


def components(edges: DataFrame, few: int = 0) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node it
    can reach. Alternating large and small stars until the edges stay as they
    are; every step is an aggregation and a join, so hubs are no group of their
    own. At most ``few`` edges are kept in one partition."""
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    current = staged(edges.where("a <> b").select("a", "b"), "edges")
    seen = None
    while True:
        one = bool(few) and current.count() <= few
        # Spark loses sight of the one partition behind a join or union: it is told again
        large = _in_one(_large_star(_in_one(current, one)), one)
        before, current = current, staged(_small_star(large, one), "edges")
        drop_staged(before)
        now = mark(current)
        if now == seen or not now[0]:
            break
        seen = now
    last = _packed(current, few)
    stars = last.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = stars.unionByName(last.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    out._staged_path = current._staged_path
    return out


# -- the join -----------------------------------------------------------------

def _fits(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


_SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]


def _may_reach(percent: int, na: Column, nb: Column) -> Column:
    """Whether the sketches (s0.. and b_s0..) allow the similarity: sets that
    reach it differ in at most (na + nb) (1 - p) / (1 + p) elements."""
    apart = reduce(Column.__add__, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"b_{c}"))) for c in _SKETCH))
    return apart * (100 + percent) <= (na + nb) * (100 - percent)


def _linked(buckets: DataFrame, comps: DataFrame, sets_of, percent: int,
            rounds: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(node, component) of all nodes with a link, from those so far, and the
    buckets that are not done after so many rounds (None: all are done).
    ``buckets``: (key, node, n, sketch), staged; ``sets_of(nodes)`` gives the
    shingle sets of at least these nodes."""
    spark = buckets.sparkSession
    sets, round_ = None, 0
    while rounds is None or round_ < rounds:
        labelled = buckets.join(comps, "node", "left").select(
            "key", "node", "n", *_SKETCH, F.coalesce("component", "node").alias("c"))
        wide = labelled.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("key")
        still = staged(labelled.join(wide, "key"), "buckets")  # a plain join: a large bucket may be split
        drop_staged(buckets)
        if still.isEmpty():
            drop_staged(still)
            return comps, None
        sets = sets or sets_of(still.select("node").distinct())
        # the smallest node of each of so many parts of a bucket
        parts = CENTERS ** round_
        part = F.pmod(F.xxhash64("node"), F.lit(parts))
        centers = still.groupBy("key", part.alias("part")).agg(F.min("node").alias("node")).drop("part")
        marked = staged(still.join(centers.withColumn("center", F.lit(True)), ["key", "node"], "left"), "marked")
        drop_staged(still)
        chosen = marked.where("center")
        pairs = (marked.drop("center").join(chosen.select("key", F.col("node").alias("b"), F.col("n").alias("nb"),
                                          F.col("c").alias("cb"), *[F.col(c).alias(f"b_{c}") for c in _SKETCH]), "key")
                 .where((F.col("c") != F.col("cb")) & _fits(F.col("n"), F.col("nb"), percent)
                        & _may_reach(percent, F.col("n"), F.col("nb")))
                 .select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct())
        found = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
                 .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
                 .select("a", "b", "sa", "sb").mapInArrow(_confirmed(percent), "a binary, b binary"))
        with arrow_rows(spark, PAIR_ROWS):
            found = staged(found, "links")
        if not found.isEmpty():
            # edges between the components so far, then their nodes follow
            links, known = _packed(found, FEW_ROWS), _packed(comps, FEW_ROWS)
            name = lambda side: (links.join(known.withColumnRenamed("node", side), side, "left")
                                 .withColumn(side, F.coalesce("component", side)).drop("component"))
            links = name("a")
            links = name("b")
            merged = components(links, FEW_ROWS)
            old = known.unionByName(merged.select("node", F.col("node").alias("component"))).groupBy("node").agg(
                F.min("component").alias("component"))
            before, comps = comps, staged(
                old.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
                .select("node", F.coalesce("to", "component").alias("component")), "components")
            drop_staged(before)
            drop_staged(merged)
        drop_staged(found)
        buckets = staged(marked.where("center is null").select("key", "node", "n", *_SKETCH), "buckets")
        drop_staged(marked)
        round_ += 1
    return comps, buckets


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _named(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, keyed: bool = False) -> DataFrame:
    """(id, n_shingles, node, component_id), with ``keyed`` also the row's key."""
    slim = docs.select(*id_and_text(docs, id_col, text_col))
    kind = slim.schema["id"].dataType.simpleString()
    key = [_row_key(id_col, text_col).alias("row_key")] if keyed else []
    signed = docs.select(*id_and_text(docs, id_col, text_col), *key).mapInArrow(
        _signatures_of(shingle), f"id {kind}, n_shingles long, node binary, bands array<long>, sketch array<long>"
        + ", row_key long" * keyed)
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        signed = staged(signed, "signatures")
    usable = signed.where("id is not null and node is not null")
    nodes = staged(usable.groupBy("node").agg(F.min(F.struct("id", "n_shingles", "bands", "sketch")).alias("first"))
                   .select("node", "first.*"), "nodes")
    known = nodes.select("node", F.col("n_shingles").alias("n"), *[F.get("sketch", F.lit(i)).alias(c) for i, c in enumerate(_SKETCH)])
    kept: list[DataFrame] = []

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Sets of the wanted nodes, made for those that have none yet."""
        for had in kept:
            wanted = wanted.join(had.select("node"), "node", "left_anti")
        wanted = staged(nodes.join(wanted, "node", "left_semi").select("node", "id"), "wanted")
        with arrow_rows(docs.sparkSession, TEXT_ROWS):
            kept.append(staged(
                slim.join(wanted.select("id").distinct(), "id", "left_semi").select("text")
                .mapInArrow(_sets_of(shingle), "node binary, shingles binary")
                .join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets"))
        drop_staged(wanted)
        return reduce(DataFrame.unionByName, kept)

    comps = slim.sparkSession.createDataFrame([], "node binary, component binary")
    start, rest = 1, None
    for size, rounds in WAVES:
        keys = nodes.select(F.explode(F.slice("bands", start, size)).alias("key"), "node")
        shared = keys.groupBy("key").agg(F.count("node").alias("m")).where("m > 1").select("key")
        members = keys.join(shared, "key").join(known, "node")
        buckets = staged(members.unionByName(rest) if rest is not None else members, "members")
        if rest is not None:
            drop_staged(rest)
        comps, rest = _linked(buckets, comps, sets_of, percent, rounds)
        start += size
    for had in kept:
        drop_staged(had)
    named = nodes.select("node", "id").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    answer = named.join(lowest, "component").select("node", "component_id")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return (signed.drop("bands", "sketch").join(answer, "node", "left").withColumn("component_id", own))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Documents are linked when their sets of ``shingle``-word shingles (words
    lower-cased, A-Z) have a Jaccard similarity of at least ``percent`` / 100;
    ``component_id`` is the smallest id reachable over links. Null and empty
    texts have empty sets and are linked with nothing. A row without id is
    linked with nothing, has a null component and is kept. Repeated rows, and
    rows that share an id, get the component of their own text. Other columns
    are ignored; an empty table gives no rows.
    """
    found = _named(docs, shingle, percent, id_col, text_col)
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component (see :func:`near_duplicates`), all columns as
    they are: of its smallest id, and of that id's texts in it the one with the
    smallest hash. Rows repeated with the same id and text are one document; a
    text without words is linked with nothing, but its repeated rows go too. Rows
    without id stay."""
    found = _named(docs, shingle, percent, id_col, text_col, keyed=True).where("id is not null")
    rows = staged(found.groupBy("id", "row_key", "component_id").agg(F.count("*").alias("n"), F.first("node").alias("node")),
                  "rows")
    # of a component's smallest id, the text that stays; a text without words has no others
    first = (rows.where("id = component_id and node is not null").groupBy("component_id")
             .agg(F.min("row_key").alias("stays")))
    rows = rows.join(first, "component_id", "left")
    stays = F.col("node").isNull() | ((F.col("id") == F.col("component_id")) & (F.col("row_key") == F.col("stays")))
    rows = staged(rows.select(F.col("id").alias("_id"), F.col("row_key").alias("_row_key"), "n", stays.alias("stays"))
                  .where("n > 1 or not stays"), "rows")
    own = (docs[id_col] == rows["_id"]) & (_row_key(id_col, text_col) == rows["_row_key"])
    out = docs.join(rows, own, "left_anti")
    again = rows.where("stays")
    if not again.isEmpty():
        own = (docs[id_col] == again["_id"]) & (_row_key(id_col, text_col) == again["_row_key"])
        out = out.unionByName(docs.join(again, own, "left_semi").dropDuplicates([id_col, text_col]))
    return out.select(docs.columns)
