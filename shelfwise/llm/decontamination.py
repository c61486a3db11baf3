"""Benchmark decontamination (operator 3): SimHash over item-sized windows.

A document is contaminated by an item when one of its windows of as many words
as the item has reaches a weighted Jaccard similarity of ``SIMILARITY`` on
five-word shingles (weight: the shingle's number of letters, counted with
multiplicity). Windows are found by 64-bit SimHash: fingerprints within
``RADIUS`` bits agree up to 2 bits in at least one of eight blocks, so tables
of each block's neighbourhood return all of them; candidates are verified on
the shingles themselves. Windows in which shingles of the benchmark carry too
little weight to reach the similarity are not fingerprinted.

No radius covers the similarity where one shingle weighs more than many others.
So windows whose shingles in an item weigh enough to reach the similarity with
it are verified too, whatever the fingerprints: the result is that of comparing
all windows. A text shorter than an item is one window.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_values, byte_slices, flat_words, id_and_text, ngram_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_RADIUS = 8, 2
#: Guaranteed by the blocks: 8 * 3 - 1 differing bits leave a block with 2 at most.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Benchmarks beyond this are processed in shards of about this size.
SHARD_BYTES = 4 << 20
_BITS = np.arange(64, dtype=np.uint64)
_POP8 = np.asarray([bin(i).count("1") for i in range(256)], np.uint8)
#: Windows fingerprinted at a time.
_CHUNK = 4096


def _shingles(words: list[bytes], hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight of the shingle at each position."""
    sizes = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
    return ngram_hashes(hashes, k), (sizes[k:] - sizes[:-k]) if len(words) >= k else np.empty(0, np.int64)


def simhashes(grams: np.ndarray, weights: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of the windows of ``size`` shingles at ``starts``."""
    out = np.empty(len(starts), np.uint64)
    for lo in range(0, len(starts), _CHUNK):
        own = starts[lo:lo + _CHUNK]
        first, last = int(own[0]), int(own[-1]) + size
        if last - first > 4 * _CHUNK + size:  # far apart: one by one
            own = own[own < first + 4 * _CHUNK]
            rest = simhashes(grams, weights, size, starts[lo + len(own):])
            head = simhashes(grams, weights, size, own)
            out[lo:lo + len(own)], out[lo + len(own):] = head, rest
            return out
        signs = np.where(grams[first:last, None] >> _BITS & np.uint64(1), 1, -1) * weights[first:last, None]
        sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(signs, axis=0)])
        total = sums[own - first + size] - sums[own - first]
        out[lo:lo + len(own)] = ((total > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)
    return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets given as (hashes, weights)."""
    keys, index = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    index = index.reshape(-1)
    x = np.bincount(index[:len(a[0])], weights=a[1], minlength=len(keys))
    y = np.bincount(index[len(a[0]):], weights=b[1], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class _Items:
    """Items of one length: fingerprints and block tables."""

    def __init__(self, n_words: int):
        self.n = n_words
        self.k = min(SHINGLE, n_words)
        self.size = n_words - self.k + 1
        self.ids: list = []
        self.shingles: list[tuple[np.ndarray, np.ndarray]] = []

    def finish(self) -> None:
        self.prints = np.concatenate([simhashes(g, w, self.size, np.zeros(1, np.int64)) for g, w in self.shingles])
        near = _POP8[np.arange(256)[:, None] ^ np.arange(256)] <= BLOCK_RADIUS
        blocks = self.prints.view(np.uint8).reshape(-1, BLOCKS)
        # tables[b][value]: items whose block b is within the block radius of value
        self.tables = [near[:, blocks[:, b]] for b in range(BLOCKS)]
        # the distinct shingles, and for each the items that have it with their weight in them
        grams = np.concatenate([g for g, _ in self.shingles])
        weights = np.concatenate([w for _, w in self.shingles])
        item = np.repeat(np.arange(len(self.shingles)), self.size)
        self.weight = np.bincount(item, weights=weights, minlength=len(self.shingles))
        order = np.lexsort((item, grams))
        grams, item, weights = grams[order], item[order], weights[order]
        first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (item[1:] != item[:-1])]))
        self.owner, self.part = item[first], np.add.reduceat(weights, first)
        self.keys, edges = np.unique(grams[first], return_index=True)
        self.edges = np.append(edges, len(first))

    def sharing(self, grams: np.ndarray, similarity: float) -> np.ndarray:
        """Items of whose weight the share that a similar window needs lies in ``grams``."""
        own = np.unique(grams)
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        at = at[self.keys[at] == own]
        n = self.edges[at + 1] - self.edges[at]
        rows = np.repeat(self.edges[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        shared = np.bincount(self.owner[rows], weights=self.part[rows], minlength=len(self.weight))
        return np.flatnonzero((shared >= similarity * self.weight - 1e-9) & (shared > 0))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within RADIUS bits."""
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        found = np.zeros((len(prints), len(self.prints)), bool)
        for b in range(BLOCKS):
            found |= self.tables[b][blocks[:, b]]
        window, item = np.nonzero(found)
        differ = (prints[window] ^ self.prints[item]).view(np.uint8).reshape(-1, BLOCKS)
        near = _POP8[differ].sum(axis=1) <= RADIUS
        return window[near], item[near]


class BenchmarkIndex:
    """All items of a shard; its size follows the shard's text."""

    def __init__(self, items: list[tuple], similarity: float = SIMILARITY):
        self.similarity = similarity
        by_length: dict[int, _Items] = {}
        for item_id, text in items:
            words = (text or "").encode().lower().split()
            if not words:
                continue
            own = by_length.setdefault(len(words), _Items(len(words)))
            own.ids.append(item_id)
            own.shingles.append(_shingles(words, word_hashes(words), own.k))
        self.lengths = sorted(by_length.values(), key=lambda x: x.n)
        for own in self.lengths:
            own.finish()
        self.known = {k: np.unique(np.concatenate([g for x in self.lengths if x.k == k for g, _ in x.shingles]))
                      for k in {x.k for x in self.lengths}}

    def search(self, texts: list[bytes]) -> list[list[tuple]]:
        """For each text, (item id, start, words, similarity): the most similar
        window (the first of equals) of each item that reaches the similarity."""
        words, starts = flat_words([t.lower() for t in texts])
        hashes = word_hashes(words)
        found: list[list[tuple]] = [[] for _ in texts]
        for k, known in self.known.items():
            grams, weights = _shingles(words, hashes, k)
            if len(grams) == 0:
                continue
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            hit = known[at] == grams
            for i in np.unique(np.searchsorted(starts, np.flatnonzero(hit), "right") - 1).tolist():
                lo, hi = int(starts[i]), int(starts[i + 1]) - k + 1
                if hi > lo:
                    found[i] += self._windows(k, grams[lo:hi], weights[lo:hi], hit[lo:hi])
        return found

    def _windows(self, k: int, grams: np.ndarray, weights: np.ndarray, hit: np.ndarray) -> Iterator[tuple]:
        total = np.concatenate([[0], np.cumsum(weights)])
        known = np.concatenate([[0], np.cumsum(weights * hit)])
        # shared weight >= s/(1+s) * (both weights) is needed to reach similarity s
        least = self.similarity / (1 + self.similarity)
        for items in self.lengths:
            if items.k != k:
                continue
            size = min(items.size, len(grams))  # a shorter text is one window
            may = known[size:] - known[:-size] >= least * (total[size:] - total[:-size]) - 1e-9
            may &= known[size:] > known[:-size]
            starts = np.flatnonzero(may)
            if len(starts) == 0:
                continue
            pairs: set[tuple[int, int]] = set()
            if size == items.size:
                window, item = items.candidates(simhashes(grams, weights, size, starts))
                pairs.update(zip(starts[window].tolist(), item.tolist()))
            # what the radius misses: few heavy shingles, shorter texts
            for j in items.sharing(grams, self.similarity).tolist():
                shared = np.concatenate([[0], np.cumsum(weights * np.isin(grams, items.shingles[j][0]))])
                bound = shared[starts + size] - shared[starts]
                both = total[starts + size] - total[starts] + items.weight[j]
                pairs.update((s, j) for s in starts[bound >= least * both - 1e-9].tolist())
            best: dict[int, tuple[float, int]] = {}
            for s, j in sorted(pairs):
                value = weighted_jaccard((grams[s:s + size], weights[s:s + size]), items.shingles[j])
                if value >= self.similarity - 1e-12 and value > best.get(j, (0.0, 0))[0]:
                    best[j] = (value, s)
            for j, (value, s) in sorted(best.items()):
                yield items.ids[j], s, size + k - 1, value


def _shards(benchmark: DataFrame, id_col: str, text_col: str, similarity: float) -> Iterator:
    """Broadcast indexes of the benchmark, each over a bounded part of it."""
    items = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / SHARD_BYTES))
    shard = F.pmod(F.xxhash64("item", "text"), F.lit(shards))
    for i in range(shards):
        rows = [(r["item"], r["text"]) for r in items.where(shard == i).orderBy("item", "text").collect()]
        index = BenchmarkIndex(rows, similarity)
        if index.lengths:
            yield benchmark.sparkSession.sparkContext.broadcast(index)


def contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): the best window of each
    contaminated document for each of its items; documents without are absent.

    Words are lower-cased (A-Z). Items of fewer than five words are one shingle;
    null and empty items and documents match nothing. Documents are searched
    whole; repeated rows, equal items and null ids are reported each. Other
    columns are ignored; an empty table on either side gives no rows.
    """
    slim = docs.select(*id_and_text(docs, id_col, text_col))
    kind = slim.schema["id"].dataType.simpleString()
    item_field = benchmark.schema[item_col].dataType
    item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_field.simpleString()]
    schema = f"id {kind}, item {item_field.simpleString()}, start long, n_words long, similarity double"

    def searching(index):
        def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in byte_slices(batches):
                found = [(i, *hit) for i, hits in enumerate(index.value.search(binary_values(part.column("text"))))
                         for hit in hits]
                row, item, start, n, value = ([f[j] for f in found] for j in range(5))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row, pa.int64())), pa.array(item, item_type),
                     pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(value, pa.float64())],
                    ["id", "item", "start", "n_words", "similarity"])
        return emit

    out = docs.sparkSession.createDataFrame([], schema)
    for n, index in enumerate(_shards(benchmark, item_col, item_text_col, similarity)):
        hits = slim.mapInArrow(searching(index), schema)
        out = hits if n == 0 else out.unionByName(hits)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def without_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                         text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that no item contaminates
    (see :func:`contamination`). Nothing is shuffled."""
    def keeping(index):
        def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in byte_slices(batches, text_col):
                found = index.value.search(binary_values(part.column(text_col)))
                yield part.filter(pa.array([not hits for hits in found], pa.bool_()))
        return emit

    out = docs
    for index in _shards(benchmark, item_col, item_text_col, similarity):
        out = out.mapInArrow(keeping(index), docs.schema)
    return out
