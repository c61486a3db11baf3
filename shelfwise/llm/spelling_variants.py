"""Spelling variant grouping (operator 11): k-d trees over letter-count vectors.

Words are points of letter counts. One inserted, deleted or replaced letter
moves a point by an L1 distance of at most two: within a length, one count
rises and one falls; to the next length, one count rises. So near words are
found by range searches per pair of lengths (n, n) and (n, n + 1) in k-d trees
whose nodes keep the bounding box of their points; a box is left out as soon as
a query would have to rise or fall by more than the pair of lengths allows.
What is left is verified letter by letter.

The tree has two parts. Its top cuts a length's words into cells of about
``CELL_WORDS``; the cuts are medians of a bounded sample and only route, so
they change no result. A word is a point of its own cell and a query to every
cell its ball can reach. Inside a task each cell gets its own tree. A pair
within a length is searched from the lower to the higher cell only.

Points are kept in unary: coordinate d has one bit for each of the counts 1 to
4, set when the letter occurs at least so often, so that rises and falls are
counted bits, a box is the AND and the OR of its points, and a cut is a bit.
Letters beyond a-z share six coordinates and counts stop at 4: both only bring
points closer, so no pair is lost.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, drop_staged, id_and_text, staged

MIN_LENGTH = 5
MIN_COUNT = 3
#: A run is damaged where the crc32 of "<doc_id>:<run>" is divisible by this.
DAMAGE = 97
FORM_RATIO = 2
CELL_WORDS = 50_000
#: At most so many words choose the cuts of the tree's top, and a length has at
#: most 2**MAX_DEPTH cells.
SAMPLE_WORDS = 100_000
MAX_DEPTH = 12
LEAF = 16
DIMS, LEVELS = 32, 4
_FRONT = 1 << 16     # (query, node) pairs held at a time
_PORTION = 1 << 24   # letters compared at a time
_COUNT_BYTES = 8 << 20
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]] = True
#: Latin-1 bytes: A-Z in lower case, other letters as they are, the rest blank.
_CLEAN = bytes((b + 32 if 65 <= b <= 90 else b) if _LETTERS[b] else 32 for b in range(256))
_DIM = np.array([b - 97 if 97 <= b <= 122 else 26 + b % 6 for b in range(256)], np.int64)


# -- words and their counts, inside tasks -------------------------------------

def _crc_shifts(most: int) -> np.ndarray:
    """(most + 1) x 256 x 4 tables: what ``n`` more zero bytes make of a crc
    register, byte by byte of the register."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    # one zero byte: register r -> (r >> 8) ^ step[r & 255]
    out = np.zeros((most + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, most + 1):
        r = out[n - 1]
        out[n] = (r >> np.uint32(8)) ^ step[r & np.uint32(255)]
    return out


_SHIFT_BYTES = 64
_SHIFTS = _crc_shifts(_SHIFT_BYTES)


def _keyed_crc(prefix: np.ndarray, tail: np.ndarray, tail_bytes: np.ndarray) -> np.ndarray:
    """crc32 of prefix + tail from their crcs; tails of at most _SHIFT_BYTES."""
    r = prefix.copy()
    out = tail.copy()
    for k in range(4):
        out ^= _SHIFTS[tail_bytes, k, (r >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def latin_runs(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All letter runs of the texts (Latin-1 bytes, A-Z lower-cased), and the
    index of each one's text."""
    rows = [t.encode("latin-1", "replace").translate(_CLEAN).split() for t in texts]
    owner = np.repeat(np.arange(len(rows)), np.fromiter(map(len, rows), np.int64, len(rows)))
    return pa.array([w for row in rows for w in row], pa.binary()), owner


def word_counts(ids: list[str | None], texts: list[str], damage: int) -> tuple[list[bytes], np.ndarray]:
    """Distinct words of the texts, after the damage, and their counts."""
    runs, owner = latin_runs(texts)
    if len(runs) == 0:
        return [], np.empty(0, np.int64)
    coded = runs.dictionary_encode()
    codes = coded.indices.to_numpy()
    words = coded.dictionary.to_pylist()
    counts = np.bincount(codes, minlength=len(words))
    utf = [w.decode("latin-1").encode() for w in words]
    crc = np.fromiter(map(zlib.crc32, utf), np.uint32, len(words))
    size = np.fromiter(map(len, utf), np.int64, len(words))
    prefix = np.fromiter((zlib.crc32(f"{i}:".encode()) for i in ids), np.uint32, len(ids))
    named = np.array([i is not None for i in ids])
    hit_at, hit_h = [], []
    step = 1 << 20
    for lo in range(0, len(codes), step):
        code, own = codes[lo:lo + step], owner[lo:lo + step]
        short = size[code] <= _SHIFT_BYTES
        h = np.zeros(len(code), np.uint32)
        h[short] = _keyed_crc(prefix[own[short]], crc[code[short]], size[code[short]])
        for at in np.flatnonzero(~short):
            h[at] = zlib.crc32(utf[code[at]], int(prefix[own[at]]))
        hit = np.flatnonzero((h % np.uint32(damage) == 0) & named[own])
        hit_at.append(hit + lo)
        hit_h.append(h[hit])
    hits, hashes = np.concatenate(hit_at), np.concatenate(hit_h)
    np.subtract.at(counts, codes[hits], 1)
    made: dict[bytes, int] = defaultdict(int)
    for code, h in zip(codes[hits].tolist(), hashes.tolist()):
        w = words[code]
        at = h % len(w)
        made[w[:at] + w[at + 1:]] += 1
    return [*words, *made], np.concatenate([counts, np.fromiter(made.values(), np.int64, len(made))])


def _counted(damage: int, least: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, limit=_COUNT_BYTES):
            ids = part.column("id").to_pylist()
            texts = [t or "" for t in part.column("text").to_pylist()]
            words, counts = word_counts(ids, texts, damage)
            keep = [i for i, w in enumerate(words) if len(w) >= least and counts[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[i].decode("latin-1") for i in keep], pa.string()), pa.array(counts[keep])],
                ["word", "n"])
    return emit


# -- points, and the tree -----------------------------------------------------

def points_of(words: list[bytes]) -> np.ndarray:
    """(words x 2) letter counts in unary: bit d of the first half says that
    letter d occurs, bit 32 + d that it does twice; the second half has three
    and four times."""
    flat = np.frombuffer(b"".join(words), np.uint8)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    counts = np.bincount(owner * DIMS + _DIM[flat], minlength=len(words) * DIMS).reshape(-1, 1, DIMS)
    bits = counts > np.arange(LEVELS)[:, None]
    return np.packbits(bits.reshape(len(words), -1), axis=1, bitorder="little").view("<u8").astype(np.uint64)


def _bits(points: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(points, "<u8").view(np.uint8), axis=1, bitorder="little")


def _cut(bits: np.ndarray) -> int | None:
    """The bit that halves the points best, None if all points are equal."""
    ones = bits.sum(axis=0, dtype=np.int64)
    usable = np.flatnonzero((ones > 0) & (ones < len(bits)))
    return int(usable[np.argmin(np.abs(2 * ones[usable] - len(bits)))]) if len(usable) else None


class KdTree:
    """Nodes as arrays, so that searches go level by level for many queries at a
    time. ``low`` and ``high`` are the node's box; a leaf is a range of ``order``."""

    def __init__(self, points: np.ndarray, depth: int | None = None):
        """Down to leaves of ``LEAF`` points with the boxes of these points; with
        ``depth``, to that depth with the boxes that the cuts alone make."""
        self.order = np.arange(len(points))
        bits = _bits(points)
        everything = (np.zeros(2, np.uint64), np.full(2, ~np.uint64(0)))
        todo, spans, children, boxes = [(0, len(points), 0, everything)], [], [], []
        at = 0
        while at < len(todo):
            lo, hi, level, box = todo[at]
            own = self.order[lo:hi]
            if depth is None:
                box = (np.bitwise_and.reduce(points[own], axis=0), np.bitwise_or.reduce(points[own], axis=0))
            cut = _cut(bits[own]) if (hi - lo > LEAF if depth is None else level < depth) else None
            if cut is None:
                children.append(-1)
            else:
                has = bits[own, cut].astype(bool)
                self.order[lo:hi] = np.concatenate([own[~has], own[has]])
                middle = hi - int(has.sum())
                # at least so often: all lower bits of the letter too; less often: no higher ones
                letter, often = cut % DIMS, cut // DIMS
                at_least = _mask(letter, range(often + 1))
                less = ~_mask(letter, range(often, LEVELS))
                children.append(len(todo))
                todo += [(lo, middle, level + 1, (box[0], box[1] & less)), (middle, hi, level + 1, (box[0] | at_least, box[1]))]
            spans.append((lo, hi))
            boxes.append(box)
            at += 1
        self.spans, self.children = np.array(spans), np.array(children)
        self.low, self.high = (np.array([b[side] for b in boxes]) for side in (0, 1))

    def leaves(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, leaf) of the leaves whose box the query can reach, in portions."""
        todo = [(q, np.zeros(len(q), np.int64)) for q in _portions(np.arange(len(queries)), _FRONT // 4)]
        while todo:
            q, node = todo.pop()
            ok = within(queries[q], self.low[node], self.high[node], up, down)
            q, node = q[ok], node[ok]
            child = self.children[node]
            leaf = child < 0
            if leaf.any():
                yield q[leaf], node[leaf]
            q, child = np.repeat(q[~leaf], 2), np.repeat(child[~leaf], 2)
            child[1::2] += 1
            todo += zip(_portions(q, _FRONT), _portions(child, _FRONT))


def _mask(letter: int, levels: Iterable[int]) -> np.ndarray:
    value = sum(1 << (level * DIMS + letter) for level in levels)
    return np.array([value & (2**64 - 1), value >> 64], np.uint64)


def _portions(values: np.ndarray, size: int) -> list[np.ndarray]:
    return [values[lo:lo + size] for lo in range(0, len(values), size)]


def within(x: np.ndarray, low: np.ndarray, high: np.ndarray, up: int, down: int) -> np.ndarray:
    """Whether point x needs at most ``up`` rises and ``down`` falls to enter the box."""
    rises = np.bitwise_count(low & ~x).sum(axis=1, dtype=np.uint8)
    falls = np.bitwise_count(x & ~high).sum(axis=1, dtype=np.uint8)
    return (rises <= up) & (falls <= down)


# -- near words of a cell, inside tasks ---------------------------------------

def _expand(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, position) of every position of the ranges."""
    size = ends - starts
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + starts[which]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row i of ``b`` is one edit from row i of ``a``: one letter replaced
    (same width) or one more letter (width + 1)."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    end = np.zeros((len(a), 1), bool)
    ahead = np.concatenate([a == b[:, :-1], end], axis=1).argmin(axis=1)
    behind = np.concatenate([(a == b[:, 1:])[:, ::-1], end], axis=1).argmin(axis=1)
    return ahead + behind >= a.shape[1]


class _Words:
    """Words of one length, by distinct point."""

    def __init__(self, words: list[bytes]):
        self.letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        points = points_of(words)
        self.by_point = np.lexsort((points[:, 0], points[:, 1]))
        ordered = points[self.by_point]
        new = np.ones(len(words), bool)
        new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
        self.first = np.append(np.flatnonzero(new), len(words))
        self.points = ordered[new]

    def sizes(self, point: np.ndarray) -> np.ndarray:
        return self.first[point + 1] - self.first[point]


def near_pairs(queries: list[bytes], points: list[bytes] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) of all words one edit apart, each pair once. Queries have
    the points' length or one letter less; without ``points`` the queries are
    searched among themselves."""
    mine = _Words(queries)
    theirs = mine if points is None else _Words(points)
    up, down = 1, int(mine.letters.shape[1] == theirs.letters.shape[1])
    tree = KdTree(theirs.points)
    for q, leaf in tree.leaves(mine.points, up, down):
        which, at = _expand(tree.spans[leaf, 0], tree.spans[leaf, 1])
        q, p = q[which], tree.order[at]
        ok = within(mine.points[q], theirs.points[p], theirs.points[p], up, down)
        if points is None:
            ok &= q <= p
        yield from _verified(mine, theirs, q[ok], p[ok], points is None)


def _verified(mine: _Words, theirs: _Words, q: np.ndarray, p: np.ndarray, same: bool):
    """The words of each pair of points (q, p), verified letter by letter."""
    portion = max(1, _PORTION // theirs.letters.shape[1])
    work = mine.sizes(q) * theirs.sizes(p)
    usual = np.flatnonzero(work <= portion)
    edges = np.flatnonzero(np.diff(np.cumsum(work[usual]) // portion)) + 1
    for part in np.split(usual, edges):
        which, at = _expand(mine.first[q[part]], mine.first[q[part] + 1])
        a, pair = mine.by_point[at], part[which]
        which, at = _expand(theirs.first[p[pair]], theirs.first[p[pair] + 1])
        a, b, pair = a[which], theirs.by_point[at], pair[which]
        if same:
            once = (q[pair] < p[pair]) | (a < b)
            a, b = a[once], b[once]
        ok = one_edit(mine.letters[a], theirs.letters[b])
        yield a[ok], b[ok]
    for i in np.flatnonzero(work > portion):
        yield from _by_halves(mine, theirs, mine.by_point[mine.first[q[i]]:mine.first[q[i] + 1]],
                              theirs.by_point[theirs.first[p[i]]:theirs.first[p[i] + 1]], same and q[i] == p[i], portion)


def _by_halves(mine: _Words, theirs: _Words, a: np.ndarray, b: np.ndarray, same: bool, portion: int):
    """The same for two points with very many words: an edit leaves the first or
    the last half of a word as it is, so only words with an equal half meet."""
    half = mine.letters.shape[1] // 2
    seen = None
    for cut_a, cut_b in ((slice(0, half), slice(0, half)),
                         (slice(half, None), slice(theirs.letters.shape[1] - mine.letters.shape[1] + half, None))):
        key_a, key_b = (np.ascontiguousarray(w.letters[at][:, cut]).view(f"S{w.letters[at][:, cut].shape[1]}")[:, 0]
                        for w, at, cut in ((mine, a, cut_a), (theirs, b, cut_b)))
        order = np.argsort(key_b, kind="stable")
        lo, hi = np.searchsorted(key_b[order], key_a, "left"), np.searchsorted(key_b[order], key_a, "right")
        edges = np.flatnonzero(np.diff(np.cumsum(hi - lo) // portion)) + 1
        for part in np.split(np.arange(len(a)), edges):
            which, at = _expand(lo[part], hi[part])
            x, y = a[part][which], b[order[at]]
            ok = one_edit(mine.letters[x], theirs.letters[y])
            if same:
                ok &= x < y
            if seen is not None:  # both halves are equal: given before
                ok &= (mine.letters[x][:, seen[0]] != theirs.letters[y][:, seen[1]]).any(axis=1)
            yield x[ok], y[ok]
        seen = (cut_a, cut_b)


def _cell_near(table: pa.Table) -> pa.Table:
    """One cell: rows (word, n, step), step 0 for its points, 1 for queries of
    the same length, 2 for queries one letter shorter. Per word: how many near
    words were found here, and the best of them."""
    step = table.column("step").to_numpy()
    n = table.column("n").to_numpy()
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    better = np.empty(len(words), np.int64)  # places by n, largest first, then by word
    by_word = np.argsort(np.array(words, object), kind="stable")
    ranked = by_word[np.argsort(-n[by_word], kind="stable")]
    better[ranked] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    at = [np.flatnonzero(step == s) for s in range(3)]
    own = [words[i] for i in at[0]]
    for kind in range(3):
        if not len(own) or not len(at[kind]):
            continue
        found = near_pairs(own) if kind == 0 else near_pairs([words[i] for i in at[kind]], own)
        for a, b in found:
            a, b = at[kind][a], at[0][b]
            for x, y in ((a, b), (b, a)):
                count += np.bincount(x, minlength=len(words))
                np.minimum.at(best, x, better[y])
    hit = np.flatnonzero(count)
    form = ranked[best[hit]]
    take = table.column("word").take
    return pa.table({"word": take(pa.array(hit)), "n_near": count[hit], "less_n": -n[form], "form": take(pa.array(form))})


# -- the join -----------------------------------------------------------------

def _top_trees(words: DataFrame, cell_words: int) -> dict[int, KdTree]:
    """The top of the tree for each length that needs more than one cell."""
    sizes = {r.size: r.m for r in words.groupBy("size").agg(F.count("*").alias("m")).where(F.col("m") > cell_words).collect()}
    if not sizes:
        return {}
    share = SAMPLE_WORDS / sum(sizes.values())
    sample = words.where(F.col("size").isin(list(sizes)))
    if share < 1:
        sample = sample.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = sample.select("size", "word").limit(2 * SAMPLE_WORDS).mapInArrow(_sampled, "size int, p0 long, p1 long").toPandas()
    trees = {}
    for size, own in rows.groupby("size"):
        depth = min(MAX_DEPTH, int(np.ceil(np.log2(sizes[size] / cell_words))))
        trees[int(size)] = KdTree(own[["p0", "p1"]].to_numpy().view(np.uint64), depth)
    return trees


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = points_of([w.encode("latin-1") for w in batch.column("word").to_pylist()]).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("size"), pa.array(points[:, 0]), pa.array(points[:, 1])],
                                         ["size", "p0", "p1"])


def _dealt(trees: dict[int, KdTree]):
    """Every word to its own cell (step 0) and as a query to others (1, 2)."""
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            points = points_of([w.encode("latin-1") for w in batch.column("word").to_pylist()])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                own = np.zeros(len(at), np.int64)
                if size in trees:
                    for q, cell in trees[size].leaves(points[at], 0, 0):
                        own[q] = cell
                yield _rows(batch, at, size, own, 0)
                for more, step in ((0, 1), (1, 2)):
                    if size + more not in trees:
                        if step == 2:  # the next length is one cell
                            yield _rows(batch, at, size + 1, np.zeros(len(at), np.int64), 2)
                        continue
                    for q, cell in trees[size + more].leaves(points[at], 1, 1 - more):
                        if step == 1:
                            later = cell > own[q]
                            q, cell = q[later], cell[later]
                        yield _rows(batch, at[q], size + more, cell, step)
    return emit


def _rows(batch: pa.RecordBatch, at: np.ndarray, size: int, cell: np.ndarray, step: int) -> pa.RecordBatch:
    n = len(at)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, size, np.int32)), pa.array(cell.astype(np.int32)), pa.array(np.full(n, step, np.int32)),
         batch.column("word").take(pa.array(at)), batch.column("n").take(pa.array(at))],
        ["size", "cell", "step", "word", "n"])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, root), the first step: forms have at least twice
    the count of their word, so chains end; each round doubles the steps."""
    current = forms
    while True:
        on = current.select(F.col("word").alias("root"), F.col("root").alias("on"))
        following = staged(current.join(on, "root", "left").select(
            "word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        if following.where("moved").isEmpty():
            return following.drop("moved")
        current = following.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = DAMAGE,
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per distinct word.

    Words are the letter runs (A-Z, a-z, U+00C0 to U+00FF) of all texts, A-Z in
    lower case; where the crc32 h of "<doc_id>:<run>" is divisible by ``damage``
    the run loses its code point h % length. Those of at least ``min_length`` code
    points and ``min_count`` occurrences count. ``n_near`` words are one inserted,
    deleted or replaced code point away; ``form`` is the one of largest n (ties:
    the smallest) if its n is at least twice the word's, ``root`` the last of the
    chain of forms.

    Null and empty texts have no words. Runs of a row without id are not damaged.
    Repeated rows count each time. Very long runs are words like others. Other
    columns are ignored; an empty table gives no rows.
    """
    slim = docs.select(*id_and_text(docs, id_col, text_col))
    slim = slim.withColumn("id", F.col("id").cast("string"))
    words = staged(
        slim.mapInArrow(_counted(damage, min_length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count).withColumn("size", F.length("word")), "words")
    trees = _top_trees(words, cell_words)
    cells = sum(int((t.children < 0).sum()) for t in trees.values())
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells)
    dealt = words.mapInArrow(_dealt(trees), "size int, cell int, step int, word string, n long")
    near = (dealt.repartition(parts, "size", "cell").groupBy("size", "cell")
            .applyInArrow(_cell_near, "word string, n_near long, less_n long, form string")
            .groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less_n", "form")).alias("best")))
    found = staged(
        words.join(near, "word", "left").withColumn("form_n", -F.col("best.less_n"))
        .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                *[F.when(F.col("form_n") >= FORM_RATIO * F.col("n"), F.col(c)).alias(a)
                  for c, a in (("best.form", "form"), ("form_n", "form_n"))]), "near")
    drop_staged(words)
    roots = _roots(found.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
