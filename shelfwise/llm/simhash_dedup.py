"""SimHash near-dedup (operator 13): covering locality-sensitive hashing.

A fingerprint has 64 bits: bit i is set when it is set in over half the XXH64
values of the text's shingles, repeats included. Two fingerprints link when
they differ in at most ``radius`` bits.

The buckets are structured, so that no such pair is missed: bit i carries a
vector m(i) of radius + 1 bits, never zero, and there is one table for each
vector v but zero, whose mask keeps the bits with an odd <m(i), v>. The bits in
which a pair differs give at most ``radius`` linear conditions on radius + 1
unknowns, so some v makes all of them even: its mask keeps none of those bits,
and the pair shares that table's bucket (radius 3: 15 tables, about 34 bits each).

Equal fingerprints are one node from the start, so copies never meet in a
bucket. Small buckets are compared inside tasks and give a star per component.
Buckets with more than ``split_above`` fingerprints are not collected: members
differ in free bits only, so each meets its neighbours at shared points between
them: x within ceil(radius / 2) flips of a point and y within floor(radius / 2)
flips of the same one. The smallest y at a point is the center of all x there:
an aggregation and a join, linear in the bucket's size and just as exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_values, byte_slices, id_and_text, run_starts, staged
from .near_dedup import components

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
SPLIT_ABOVE = 256
_ROWS = 1 << 15   # rows of a partition that are compared at a time
_HASHES = 1 << 16  # shingle hashes whose bits are counted at a time


# -- fingerprints, inside tasks -----------------------------------------------

def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 of each run of k words (lower-cased A-Z, joined by one space); of
    the whole sequence where there are fewer words."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)][:len(words)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    runs = (joined[a:b - 1] for a, b in zip([0, *ends], ends[k - 1:]))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, len(words) - k + 1)


def fingerprint(text: bytes, k: int) -> int:
    hashes = shingle_hashes(text, k)
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), _HASHES):
        bits = np.unpackbits(hashes[lo:lo + _HASHES].astype("<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _signed(k: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches):
            prints = np.fromiter((fingerprint(t, k) for t in binary_values(part.column("text"))),
                                 np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(prints.view(np.int64))], ["id", "print"])
    return emit


# -- covering buckets ---------------------------------------------------------

def covering_masks(radius: int) -> list[int]:
    """Masks such that any ``radius`` bits are all left out by one of them."""
    size = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(BITS) if ((1 + i % size) & v).bit_count() % 2)
            for v in range(1, size + 1)]


def _signed64(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _stars(radius: int):
    """Rows (key, print) sorted by key, to edges (a, b): within each bucket a
    star for every component of its links."""
    def of(key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        left, right = [], []
        shift = 1
        while shift < len(key):
            same = np.flatnonzero(key[shift:] == key[:-shift])
            if len(same) == 0:
                break
            near = same[np.bitwise_count(value[same] ^ value[same + shift]) <= radius]
            left.append(near)
            right.append(near + shift)
            shift += 1
        label = np.arange(len(key))
        if left:
            left, right = np.concatenate(left), np.concatenate(right)
            while True:  # the least label spreads over the links
                low = np.minimum(label[left], label[right])
                before = label.copy()
                np.minimum.at(label, left, low)
                np.minimum.at(label, right, low)
                label = label[label]
                if (label == before).all():
                    break
        member = np.flatnonzero(label != np.arange(len(key)))
        return pa.RecordBatch.from_arrays([pa.array(value[label[member]].view(np.int64)),
                                           pa.array(value[member].view(np.int64))], ["a", "b"])

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, value = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.append(key, batch.column("key").to_numpy())
            value = np.append(value, batch.column("print").to_numpy().view(np.uint64))
            if len(key) >= _ROWS:
                cut = int(run_starts(key)[-1])  # the last bucket may go on
                if cut:
                    yield of(key[:cut], value[:cut])
                    key, value = key[cut:], value[cut:]
        if len(key):
            yield of(key, value)
    return emit


def _points(radius: int):
    """Rows (mask, print), to (point, print, near): all points within
    ceil(radius / 2) flips of free bits; ``near`` within floor(radius / 2)."""
    far = (radius + 1) // 2

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            masks = batch.column("mask").to_numpy()
            prints = batch.column("print").to_numpy().view(np.uint64)
            for mask in np.unique(masks):
                if mask not in flips:
                    free = [1 << i for i in range(BITS) if not (int(mask) >> i) & 1]
                    sets = [c for size in range(far + 1) for c in combinations(free, size)]
                    flips[mask] = (np.array([sum(c) for c in sets], np.uint64),
                                   np.array([len(c) <= radius // 2 for c in sets]))
                change, near = flips[mask]
                own = prints[masks == mask]
                step = max(1, (1 << 20) // len(change))
                for lo in range(0, len(own), step):
                    some = own[lo:lo + step]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((some[:, None] ^ change).reshape(-1).view(np.int64)),
                         pa.array(np.repeat(some, len(change)).view(np.int64)),
                         pa.array(np.tile(near, len(some)))], ["point", "print", "near"])
    return emit


def linked_prints(prints: DataFrame, radius: int = RADIUS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Edges (a, b) between distinct 64-bit values (column ``print``) that
    differ in at most ``radius`` bits: not all of them, but enough to connect
    every two values that all of them would connect."""
    masks = [_signed64(m) for m in covering_masks(radius)]
    tables = prints.select("print", F.explode(F.array(*[
        F.struct(F.lit(m).alias("mask"), F.xxhash64(F.lit(m), F.col("print").bitwiseAND(F.lit(m))).alias("key"))
        for m in masks])).alias("t")).select("print", "t.mask", "t.key")
    shared = tables.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    members = staged(tables.join(shared, "key"), "buckets")
    small = members.where(F.col("m") <= split_above).select("key", "print")
    edges = (small.repartition("key").sortWithinPartitions("key", "print")
             .mapInArrow(_stars(radius), "a long, b long"))
    large = members.where(F.col("m") > split_above)
    if not large.isEmpty():
        points = staged(large.select("mask", "print").mapInArrow(_points(radius), "point long, print long, near boolean")
                        .distinct(), "points")
        centers = (points.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("print"))).alias("center"),
                                               F.min("print").alias("low"), F.max("print").alias("high"))
                   .where("center is not null and low <> high").select("point", "center"))
        edges = edges.unionByName(
            points.join(centers, "point").where("print <> center")
            .select(F.col("center").alias("a"), F.col("print").alias("b")))
    return edges.distinct()


def similar_documents(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                      id_col: str = "doc_id", text_col: str = "text",
                      split_above: int = SPLIT_ABOVE) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    ``fingerprint`` is 16 lower-case hexadecimal digits; ``component_id`` the
    smallest id reachable over links (fingerprints that differ in at most
    ``radius`` bits). Null texts and texts without words have fingerprint zero
    and are linked like any other. A row without id has a fingerprint, links
    with nothing and has a null component. Repeated rows, and rows that share an
    id, get the component of their own fingerprint. Other columns are ignored;
    an empty table gives no rows.
    """
    slim = docs.select(*id_and_text(docs, id_col, text_col))
    kind = slim.schema["id"].dataType.simpleString()
    signed = staged(slim.mapInArrow(_signed(shingle), f"id {kind}, print long"), "prints")
    nodes = staged(signed.where("id is not null").groupBy("print").agg(F.min("id").alias("first")), "nodes")
    comps = components(linked_prints(nodes.select("print"), radius, split_above))
    named = (nodes.join(comps.select(F.col("node").alias("print"), "component"), "print", "left")
             .withColumn("component", F.coalesce("component", "print")))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    answer = named.join(lowest, "component").select("print", "component_id")
    return (signed.join(answer, "print", "left")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id")))
