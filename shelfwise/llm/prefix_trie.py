"""Conversation prefix trie (operator 12): double-array tries per prefix shard.

Equal sequences of turns become one row first (with their number, their
smallest member and the digest of their ids), so a group of copies is one path.
A path's shard is the hash of its first turn; a first turn that leads to more
than ``shard_turns`` turns is split by its first 2, 4, 8, ... turns instead. So
every node from that depth on lies in one shard.

A shard packs its paths into a double array: turns get dense ids in order of
appearance, a node's child by turn id c is the slot BASE[node] + c, and
CHECK[slot] names the parent. Walking all paths through it finds the nodes and
sums members; going back over CHECK, deepest first, sums subtrees.

Nodes above the shards (the root, and the first turns that were split) belong
to several shards: their aggregates are merged over all of them by path. A
subtree's sums there are those of the shards below it plus those of its own
upper nodes.

Turns are told apart by a hash of 64 bits (it decides between turns that follow
the same prefix). The digest of a node's ends needs its ids in order: they are
joined in blocks of 4,096 ids and hashed as a stream, never held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_staged, id_fold, run_starts, staged

HEAD_OF = 20       # conversation c starts like conversation c - c % HEAD_OF
HEAD_FOLDS = 4     # with crc32(c) % HEAD_FOLDS turns of it
SHARD_TURNS = 1_000_000
ID_BLOCK = 4096
_WORD = r"[^\x20\x09-\x0D]+"
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_TURNS = "array<struct<k:bigint,w:bigint>>"


# -- sequences ----------------------------------------------------------------

def rebuilt(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turns): each conversation as the array of its rebuilt turns, each
    the turn's hash ``k`` and the number of its words ``w``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                                role.alias("role"), text.alias("text")).where("conv is not null")
    place = F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    placed = rows.select("conv", place.alias("place"), F.xxhash64("role", "text").alias("k"),
                         F.regexp_count("text", F.lit(_WORD)).cast("long").alias("w"))
    own = placed.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "k", "w"))).alias("own"))
    own = staged(own.select("conv", F.transform("own", lambda t: F.struct(t["k"].alias("k"), t["w"].alias("w"))).alias("own")),
                 "turns")
    heads = own.where(F.col("conv") % HEAD_OF == 0).select(
        F.col("conv").alias("of"), F.slice("own", 1, HEAD_FOLDS - 1).alias("head"))
    h = id_fold(F.col("conv"), HEAD_FOLDS).cast("int")
    both = own.withColumn("of", F.col("conv") - F.col("conv") % HEAD_OF).join(heads, "of", "left")
    head = F.coalesce(F.slice("head", 1, h), F.array().cast(_TURNS))
    rest = F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))
    return both.select("conv", F.concat(head, rest).alias("turns"))


def _hash_streams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, block, ids) in order, to (path, ends): the digest of each
    path's joined ids."""
    path, digest = None, None
    for batch in batches:
        done = []
        for p, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
            if p != path:
                if digest:
                    done.append((path, digest.hexdigest()))
                path, digest = p, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.int64()),
                                          pa.array([d for _, d in done], pa.string())], ["path", "ends"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.int64()), pa.array([digest.hexdigest()])], ["path", "ends"])


def distinct_paths(sequences: DataFrame) -> DataFrame:
    """(turns, n, low, ends) of each distinct sequence: how many conversations
    are it, the smallest of them, and the digest of their ids."""
    groups = staged(sequences.groupBy("turns").agg(F.count("*").alias("n"), F.min("conv").alias("low")), "groups")
    one = F.sha2(F.col("low").cast("string"), 256)
    several = groups.where("n > 1").select("turns", F.col("low").alias("path"))
    if several.isEmpty():
        return groups.withColumn("ends", one)
    blocks = (sequences.join(several, "turns")
              .groupBy("path", F.floor(F.col("conv") / ID_BLOCK).alias("block"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")))
    ends = (blocks.repartition("path").sortWithinPartitions("path", "block")
            .mapInArrow(_hash_streams, "path long, ends string"))
    return (groups.join(ends.withColumnRenamed("path", "low"), "low", "left")
            .select("turns", "n", "low", F.coalesce("ends", one).alias("ends")))


def _prefix(depth: Column) -> Column:
    return F.xxhash64(F.slice("turns", 1, depth))


def sharded(paths: DataFrame, shard_turns: int) -> DataFrame:
    """The paths with ``s``, the depth from which their nodes lie in one shard,
    and the hash of that ``prefix``."""
    done = []
    todo = paths.withColumn("s", F.lit(1)).withColumn("prefix", _prefix(F.lit(1)))
    while True:
        hot = (todo.where(F.size("turns") > F.col("s")).groupBy("prefix").agg(F.sum(F.size("turns")).alias("size"),
                                                                              F.count("*").alias("m"))
               .where((F.col("size") > shard_turns) & (F.col("m") > 1)).select("prefix"))
        hot = staged(hot, "hot")
        if hot.isEmpty():
            break
        done.append(todo.join(hot, "prefix", "left_anti"))
        todo = staged(todo.join(hot, "prefix").withColumn("s", F.col("s") * 2)
                      .withColumn("prefix", _prefix(F.col("s"))).select(*paths.columns, "s", "prefix"), "paths")
    for other in done:
        todo = todo.unionByName(other)
    return todo


# -- a shard's trie, inside tasks ---------------------------------------------

class DoubleArray:
    """The trie of sequences of turn hashes (flat ``keys``, each sequence a
    range). Node 0 is the top; ``check`` is -1 in free slots."""

    def __init__(self, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.starts, self.lengths = starts, lengths
        known, plain = np.unique(keys, return_inverse=True)
        self.ids = np.full(len(known), -1)  # dense ids in order of appearance
        self.plain = plain
        self.base, self.check = np.zeros(16, np.int64), np.full(16, -1)
        self.check[0] = 0
        self.used = 1               # slots from here on were never touched
        self.holes = np.empty(0, np.int64)
        named = 0
        node = np.zeros(len(starts), np.int64)
        rows, depth = np.arange(len(starts)), 0
        while True:
            rows = rows[lengths[rows] > depth]
            if len(rows) == 0:
                break
            turn = plain[starts[rows] + depth]
            order = np.lexsort((turn, node[rows]))
            parent, child = node[rows][order], turn[order]
            new = np.ones(len(order), bool)
            new[1:] = (parent[1:] != parent[:-1]) | (child[1:] != child[:-1])
            parent, child = parent[new], child[new]
            fresh = child[self.ids[child] < 0]
            fresh = fresh[np.sort(np.unique(fresh, return_index=True)[1])]
            self.ids[fresh] = np.arange(named, named + len(fresh))
            named += len(fresh)
            self._place(parent, self.ids[child])
            node[rows] = self.base[node[rows]] + self.ids[turn]
            depth += 1
        self.base, self.check = self.base[:self.used], self.check[:self.used]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1))

    def _place(self, parent: np.ndarray, code: np.ndarray) -> None:
        """Slots for the children of nodes, which come in order of parent."""
        first = run_starts(parent)
        sizes = np.diff(np.append(first, len(parent)))
        for at, size in zip(first[sizes > 1], sizes[sizes > 1]):
            own = np.sort(code[at:at + size])
            gaps = own - own[0]
            # the first of some holes that fits, else the end
            some = self.holes[-64:]
            self._grow(int(max(self.used, some.max(initial=0)) + gaps[-1] + 1))
            fits = (self.check[some[:, None] + gaps] < 0).all(axis=1)
            slot = int(some[fits][0]) if fits.any() else self.used
            self.base[parent[at]] = slot - own[0]
            self.check[slot + gaps] = parent[at]
            end = slot + int(gaps[-1]) + 1
            if end > self.used:
                span = np.arange(self.used, end)
                self.holes = np.append(self.holes, span[self.check[span] < 0])
                self.used = end
            if fits.any():
                self.holes = self.holes[self.check[self.holes] < 0]
        at = first[sizes == 1]
        slots, self.holes = self.holes[:len(at)], self.holes[len(at):]
        more = len(at) - len(slots)
        self._grow(self.used + more)
        slots = np.append(slots, np.arange(self.used, self.used + more))
        self.used += more
        self.base[parent[at]] = slots - code[at]
        self.check[slots] = parent[at]

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, sequences, their nodes), one depth after the other."""
        rows, node, depth = np.arange(len(self.starts)), np.zeros(len(self.starts), np.int64), 0
        while len(rows):
            yield depth, rows, node
            go = self.lengths[rows] > depth
            rows, came = rows[go], node[go]
            node = self.base[came] + self.ids[self.plain[self.starts[rows] + depth]]
            assert (self.check[node] == came).all()
            depth += 1


def _shard_nodes(table: pa.Table) -> pa.Table:
    """One shard's nodes. Those at the depth at which the shard begins also get
    ``chain``, the turns above them; their parent is not known here."""
    table = table.combine_chunks()
    turns = table.column("turns").combine_chunks()
    offsets = turns.offsets.to_numpy()
    flat = turns.values.flatten()
    keys, words = (f.to_numpy()[offsets[0]:offsets[-1]] for f in flat)
    starts, lengths = (offsets - offsets[0])[:-1], np.diff(offsets)
    n, low, split = (table.column(c).to_numpy() for c in ("n", "low", "s"))
    ends = table.column("ends").to_pylist()
    trie = DoubleArray(keys, starts, lengths)
    size = len(trie.check)
    members, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depth_of, word_of, first = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1)
    finish = np.full(size, -1)
    levels = []
    for depth, rows, node in trie.walk():
        np.add.at(members, node, n[rows])
        np.minimum.at(least, node, low[rows])
        depth_of[node] = depth
        first[node] = rows
        if depth:
            word_of[node] = words[starts[rows] + depth - 1]
        over = lengths[rows] == depth
        finish[node[over]] = rows[over]
        levels.append(np.unique(node))
    real = np.flatnonzero((trie.check >= 0) & (members > 0))
    real = real[real != 0]
    children = np.bincount(trie.check[real], minlength=size)
    leaves = ((children == 0) & (members > 0)).astype(np.int64)
    saved = (members - 1) * word_of
    for level in reversed(levels[1:]):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    here = split[first[real]]
    real, here = real[depth_of[real] >= here], here[depth_of[real] >= here]
    top = depth_of[real] == here
    parent = least[trie.check[real]]
    chains = [[{"k": int(keys[starts[r] + i]), "w": int(words[starts[r] + i])} for i in range(s - 1)] if t else None
              for t, r, s in zip(top, first[real], here)]
    return pa.table({
        "conv_id": least[real], "depth": depth_of[real], "parent_conv_id": pa.array(parent, mask=top),
        "n_convs": members[real], "n_children": children[real], "n_leaves": leaves[real], "saved_tokens": saved[real],
        "ends_sha256": pa.array([ends[r] if r >= 0 else _NO_ENDS for r in finish[real]], pa.string()),
        "chain": pa.array(chains, pa.list_(pa.struct([("k", pa.int64()), ("w", pa.int64())]))),
    })


_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")


# -- nodes above the shards ---------------------------------------------------

def _upper_nodes(tops: DataFrame, short: DataFrame) -> DataFrame:
    """Nodes above the shards, with their ``path``. ``tops``: the shards' first
    nodes; ``short``: paths that end above their shard's depth."""
    under = tops.select("chain", F.col("n_convs").alias("n"), F.col("conv_id").alias("low"),
                        "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends")).unionByName(
        short.select(F.col("turns").alias("chain"), "n", "low", F.lit(0).cast("long").alias("n_leaves"),
                     F.lit(0).cast("long").alias("saved_tokens"), "ends"))
    # the chain's prefixes of 0, 1, ... turns are the nodes above
    paths = F.transform(F.sequence(F.lit(0), F.size("chain")), lambda d: F.xxhash64(F.slice("chain", 1, d)))
    steps = under.withColumn("paths", paths).select("*", F.posexplode("paths").alias("depth", "path"))
    last = F.col("depth") == F.size("chain")
    nodes = staged(
        steps.groupBy("path", "depth", F.slice("paths", 1, F.col("depth")).alias("above"),
                      F.when(F.col("depth") > 0, F.get("chain", F.col("depth") - 1)["w"]).alias("w"))
        .agg(F.sum("n").alias("n_convs"), F.min("low").alias("conv_id"), F.sum("n_leaves").alias("leaves"),
             F.sum("saved_tokens").alias("saved"), F.max(F.when(last, F.col("ends"))).alias("ends"),
             F.sum(F.when(last & F.col("ends").isNull(), 1).otherwise(0)).alias("n_tops")), "upper")
    parent = F.element_at("above", -1)
    inner = (nodes.where("depth > 0").groupBy(parent.alias("path")).agg(F.count("*").alias("inner")))
    nodes = nodes.join(inner, "path", "left").withColumn("n_children", F.col("n_tops") + F.coalesce("inner", F.lit(0)))
    own = nodes.select(
        F.explode(F.concat("above", F.array("path"))).alias("path"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.coalesce("w", F.lit(0))).alias("own"))
    sums = own.groupBy("path").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    lows = nodes.select(F.col("path").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    up = F.when(F.col("depth") > 0, parent)
    return (nodes.join(sums, "path").withColumn("up", up).join(lows, "up", "left")
            .select("path", "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                    (F.col("leaves") + F.col("leaf")).alias("n_leaves"), (F.col("saved") + F.col("own")).alias("saved_tokens"),
                    F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256")))


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), one row per node of the trie of all rebuilt
    conversations.

    Conversation c is rebuilt from the first h turns of conversation
    c - c % 20 (h = crc32(c) % 4) and its own turns after its first h. A node is
    a distinct sequence of first turns (role, text); its members start with it,
    ``conv_id`` is the smallest. ``saved_tokens`` sums (n_convs - 1) times the
    words of the last turn over the subtree; ``ends_sha256`` digests the members
    that end here.

    Turns are ordered by turn, nulls first, ties by role and text; null roles and
    texts are empty. Rows without a conversation id are left out; repeated rows
    are turns of their own. A conversation without turns after rebuilding is a
    member of the root. One conversation is one array: its turns are put in order
    in one task. Other columns are ignored; an empty table gives no rows.
    """
    spark = conversations.sparkSession
    sequences = staged(rebuilt(conversations, id_col, turn_col, role_col, text_col), "sequences")
    paths = staged(distinct_paths(sequences), "paths")
    drop_staged(sequences)
    dealt = sharded(paths, shard_turns)
    total = paths.agg(F.sum(F.size("turns")).alias("m")).first().m
    if total is None:
        return spark.createDataFrame([], _NODE)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // shard_turns)
    found = staged(
        dealt.where(F.size("turns") >= F.col("s")).withColumn("shard", F.pmod("prefix", F.lit(shards)))
        .repartition(shards, "shard").groupBy("shard").applyInArrow(_shard_nodes, f"{_NODE}, chain {_TURNS}"), "nodes")
    tops = found.where("chain is not null")
    upper = staged(_upper_nodes(tops, dealt.where(F.size("turns") < F.col("s"))), "upper")
    root = upper.where("depth = 0").first().conv_id
    plain = [c.split()[0] for c in _NODE.split(", ")]
    direct = tops.where(F.size("chain") == 0).withColumn("parent_conv_id", F.lit(root).cast("long"))
    split = (tops.where(F.size("chain") > 0).drop("parent_conv_id").withColumn("path", F.xxhash64("chain"))
             .join(upper.select("path", F.col("conv_id").alias("parent_conv_id")), "path"))
    out = upper.select(plain)
    for part in (found.where("chain is null"), direct, split):
        out = out.unionByName(part.select(plain))
    return out
