"""Substring dedup (operator 2): suffix automata of reference shards.

A word is removed when a window of ``WINDOW`` consecutive words that covers it
also starts in a document with a smaller id. The reference is the corpus
itself, so its automata have no size bound and cannot go to every executor.
Instead the references are sharded by content, and each shard's automaton meets
only the passages that can match it:

1. Every window has an anchor, the smallest hash among its runs of ``ANCHOR``
   words; equal windows have equal anchors. Anchors that occur in one document
   only (most) are dropped.
2. Passages around the remaining anchors are routed to the anchor's shard.
   Anchors of very many passages are split further, window by window, so no
   shard grows with the size of a group of copies.
3. A shard reads its passages by ascending document. Each is streamed through
   the suffix automaton of the passages before it; where the matching
   statistic (length of the longest match that ends here) reaches ``WINDOW``,
   the window is a later copy. Then the passage joins the automaton.
4. The spans of a document are merged and cut out.

Only step 3 decides, on the words themselves; hashes just route.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_values, byte_slices, flat_words, id_and_text, ngram_hashes, word_hashes

WINDOW = 13
ANCHOR = 5
#: An anchor with more passages is split by window.
SPLIT_ABOVE = 2000


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _step(self, last: int, word: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(word)
        if known is not None and length[known] == length[last] + 1:
            return known
        new = -1
        if known is None:
            new = self._state(length[last] + 1, 0, {})
            while last != -1 and word not in nxt[last]:
                nxt[last][word] = new
                last = link[last]
            if last == -1:
                return new
            known = nxt[last][word]
            if length[known] == length[last] + 1:
                link[new] = known
                return new
        split = self._state(length[last] + 1, link[known], dict(nxt[known]))
        link[known] = split
        while last != -1 and nxt[last].get(word) == known:
            nxt[last][word] = split
            last = link[last]
        if new == -1:
            return split
        link[new] = split
        return new

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            last = self._step(last, word)

    def matching_statistics(self, words: list[bytes]) -> list[int]:
        """For each word: length of the longest known run that ends there."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for word in words:
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                matched += 1
            else:
                matched = 0
            out.append(matched)
        return out


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    if len(a) < width:
        return a[:0]
    size = 1
    while size * 2 <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return np.minimum(a[:len(a) - rest], a[rest:]) if rest else a


def anchored_runs(hashes: np.ndarray, starts: np.ndarray, window: int, anchor: int):
    """Runs of consecutive windows of one text with the same anchor:
    (text, first word in the flat list, windows, anchor)."""
    low = _sliding_min(ngram_hashes(hashes, anchor), window - anchor + 1)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    at = np.flatnonzero(text[:len(low)] == text[window - 1:]) if len(low) else np.empty(0, np.int64)
    if len(at) == 0:
        return at, at, at, np.empty(0, np.uint64)
    low, owner = low[at], text[at]
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    return owner[first], at[first], np.diff(np.append(first, len(at))), low[first]


def _anchors_of(window: int, anchor: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches):
            words, starts = flat_words(binary_values(part.column("text")))
            owner, _, _, key = anchored_runs(word_hashes(words), starts, window, anchor)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), part.column("id").take(pa.array(owner))], ["anchor", "id"])
    return emit


def _passages_of(window: int, anchor: int):
    def flat(column: pa.Array) -> np.ndarray:
        return np.unique(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches):
            words, starts = flat_words(binary_values(part.column("text")))
            hashes = word_hashes(words)
            owner, first, count, key = anchored_runs(hashes, starts, window, anchor)
            shared, wide = flat(part.column("shared")), flat(part.column("wide"))
            keep = np.isin(key, shared)
            owner, first, count, key = owner[keep], first[keep], count[keep], key[keep]
            single = np.isin(key, wide)
            if single.any():  # one row per window, keyed by the window itself
                each = np.where(single, count, 1)
                step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                owner, first, single = (np.repeat(x, each) for x in (owner, first, single))
                first = first + step
                count = np.where(single, 1, np.repeat(count, each))
                key = np.repeat(key, each)
                key[single] = ngram_hashes(hashes, window)[first[single]]
            texts = [b" ".join(words[f:f + n + window - 1]) for f, n in zip(first.tolist(), count.tolist())]
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), part.column("id").take(rows), part.column("row").take(rows),
                 pa.array(first - starts[owner]), pa.array(texts, pa.binary())],
                ["key", "id", "row", "start", "words"])
    return emit


class _Shard:
    """Passages of one key, by ascending document."""

    def __init__(self, window: int):
        self.window = window
        self.known: dict[bytes, None] = {}  # passages of earlier documents
        self.pending: list[bytes] = []      # of the current document
        self.automaton = SuffixAutomaton()
        self.added = 0

    def next_document(self) -> None:
        self.known.update(dict.fromkeys(self.pending))
        self.pending.clear()

    def spans(self, passage: bytes) -> list[tuple[int, int]]:
        """Word ranges of the passage covered by windows seen before."""
        self.pending.append(passage)
        if passage in self.known:  # the automaton would match it to its end
            return [(0, passage.count(b" ") + 1)]
        if not self.known:
            return []
        if self.added < len(self.known):
            for text in list(self.known)[self.added:]:
                self.automaton.add(text.split(b" "))
            self.added = len(self.known)
        found: list[tuple[int, int]] = []
        for end, matched in enumerate(self.automaton.matching_statistics(passage.split(b" ")), 1):
            if matched >= self.window:
                if found and found[-1][1] >= end - self.window:
                    found[-1] = (found[-1][0], end)
                else:
                    found.append((end - self.window, end))
        return found


def _matches_of(window: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = doc = None
        shard = _Shard(window)
        for batch in batches:
            rows, lows, highs = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("key", "id", "start", "words"))
            for i, (k, d, start, words) in enumerate(zip(*columns)):
                if k != key:
                    key, doc, shard = k, d, _Shard(window)
                elif d != doc:
                    doc = d
                    shard.next_document()
                for low, high in shard.spans(words):
                    rows.append(i)
                    lows.append(start + low)
                    highs.append(start + high)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("row").take(at),
                 pa.array(lows, pa.int64()), pa.array(highs, pa.int64())], ["id", "row", "low", "high"])
    return emit


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batches):
        total, removed, spans_out, kept_out = [], [], [], []
        spans = part.column("spans").to_pylist()
        for text, row, found in zip(binary_values(part.column("text")), part.column("row").to_pylist(), spans):
            words = text.split()
            merged: list[list[int]] = []
            for low, high in sorted((s["low"], s["high"]) for s in found or () if s["row"] == row):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            total.append(len(words))
            removed.append(sum(h - lo for lo, h in merged))
            for low, high in reversed(merged):
                del words[low:high]
            spans_out.append([{"low": lo, "high": h} for lo, h in merged])
            kept_out.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans_out, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
             pa.array(kept_out, pa.binary()).cast(pa.string())],
            ["id", "n_words", "n_removed", "spans", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   split_above: int = SPLIT_ABOVE, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text), one row per input row.

    ``spans`` are the removed maximal word ranges [low, high). A null or empty
    text, or one shorter than a window, keeps everything. A row with a null id
    neither removes nor loses anything. Rows with the same id are one document:
    they don't remove from one another. Repeats inside a document stay. Other
    columns are ignored; an empty table gives no rows.
    """
    slim = docs.select(*id_and_text(docs, id_col, text_col))
    kind = slim.schema["id"].dataType.simpleString()
    known = slim.where(F.col("id").isNotNull())
    # one exchange each, read twice: anchors by anchor, texts by document
    anchors = known.mapInArrow(_anchors_of(window, anchor), f"anchor long, id {kind}")
    anchors = anchors.where("anchor is not null and id is not null").repartition("anchor")
    texts = known.withColumn("row", F.xxhash64("text")).repartition("id")
    shared = (anchors.groupBy("anchor")
              .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
              .where("low < high")
              .select("anchor", (F.col("n") > split_above).alias("wide")))
    wanted = (anchors.join(shared, "anchor").groupBy("id")
              .agg(F.collect_set("anchor").alias("shared"),
                   F.collect_set(F.when(F.col("wide"), F.col("anchor"))).alias("wide")))
    passages = texts.join(wanted, "id").mapInArrow(
        _passages_of(window, anchor), f"key long, id {kind}, row long, start long, words binary")
    spans = (passages.repartition("key").sortWithinPartitions("key", "id")
             .mapInArrow(_matches_of(window), f"id {kind}, row long, low long, high long")
             .groupBy("id").agg(F.collect_list(F.struct("row", "low", "high")).alias("spans")))
    nothing = F.lit(None).cast("array<struct<row:bigint,low:bigint,high:bigint>>")
    out = (texts.join(spans, "id", "left").select("id", "text", "row", "spans")
           .unionByName(slim.where(F.col("id").isNull())
                        .select("id", "text", F.lit(0).cast("long").alias("row"), nothing.alias("spans"))))
    return out.mapInArrow(
        _cut, f"id {kind}, n_words long, n_removed long, spans array<struct<low:bigint,high:bigint>>, "
              "kept_text string").withColumnRenamed("id", id_col)
