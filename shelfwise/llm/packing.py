"""Sequence packing (operator 7): shortest-pack-first over the length histogram.

Documents become token ids (tokenizer file, then an end id) and are cut into
pieces of at most one sequence. The histogram of piece lengths, at most
``SEQUENCE`` numbers, is packed on the driver: lengths are placed longest
first, each into the pack with the smallest fill that still has room, and equal
packs are handled together as counts. What results are runs: "pieces of length
L with ranks r..r+n go to sequences s..s+n at offset o". Pieces find their run
by their rank among the pieces of their length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BoundedCache, binary_values, byte_slices, flat_words, id_and_text, staged
from .tokenizers_io import broadcast_model, tokenizer_of

SEQUENCE = 4096
END_ID = 2
#: Pieces of one length are ranked in so many parts, since one length may hold most rows.
RANK_PARTS = 64

_PUNCTUATION = ".,"
_TOGETHER = 512  # words encoded in one call


class _WordIds:
    """Ids of a text as little-endian 32-bit bytes, word by word: the distinct
    words of a slice are encoded once (their stems are remembered over slices),
    and all ids of the slice are gathered by position.

    Valid for tokenizers whose pre-tokenizer drops white space and never joins
    across it; texts in which a special token's string may occur are encoded
    whole, because that string may be part of a word.
    """

    def __init__(self, data: bytes):
        self.tokenizer = tokenizer_of(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = "Ab, c.\n'd  e"
        enc = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.by_word = enc(probe) == sum((enc(w) for w in probe.split()), [])
        self.cut_tail = enc("ab.,") == enc("ab") + enc(".,") and enc("Ab") == enc("ab")
        # which tokens end a word, where the model marks that
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.stems = BoundedCache()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts],
                                                   add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in encoded]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """As :meth:`encode`; words of letters only are encoded many at a time
        and told apart by the tokens that end a word, one each. Where their number
        differs (a letter that is taken apart) each word is encoded alone."""
        if not self.by_word or not self.ends.any():
            return self.encode(words)
        plain = [w for w in words if w.decode("utf-8", "replace").isalpha()]
        groups = [plain[i:i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        found: dict[bytes, bytes] = {}
        for group, ids in zip(groups, self.encode([b" ".join(g) for g in groups])):
            last = np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 1
            if len(last) == len(group) and 4 * last[-1] == len(ids):
                found.update(zip(group, (ids[4 * a:4 * b] for a, b in zip([0, *last.tolist()], last.tolist()))))
        rest = [w for w in words if w not in found]
        found.update(zip(rest, self.encode(rest)))
        return [found[w] for w in words]

    def _parts(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Of distinct words: the stem in lower case, and points and commas
        behind it, which are cut off only behind an ASCII letter, where they are
        tokens of their own."""
        text = words.view(pa.string())
        if not self.cut_tail:
            return words, pa.array([b""] * len(words), pa.binary())
        stem = pc.ascii_rtrim(text, characters=_PUNCTUATION)
        data = np.frombuffer(stem.buffers()[2] or b"", np.uint8)
        ends = np.frombuffer(stem.buffers()[1], np.int32)[stem.offset:stem.offset + len(stem) + 1]
        letter = np.zeros(len(stem), bool)
        some = np.flatnonzero(np.diff(ends))
        last = data[ends[some + 1] - 1] | 32
        letter[some] = (97 <= last) & (last <= 122)
        stem = pc.if_else(pa.array(letter), stem, text)
        more = pc.subtract(pc.binary_length(text), pc.binary_length(stem)).to_numpy()
        tails = np.full(len(words), b"", object)
        cut = np.flatnonzero(more)
        tails[cut] = [w[-n:] for w, n in zip(words.take(pa.array(cut)).to_pylist(), more[cut].tolist())]
        return pc.ascii_lower(stem).view(pa.binary()), pa.array(tails, pa.binary())

    def _flat(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of each part's distinct value, ids of all distinct values, where
        each value's ids begin)."""
        coded = parts.dictionary_encode()
        values = coded.dictionary.to_pylist()
        new = [v for v in values if v and v not in self.stems]
        self.stems.update(zip(new, self._encode_words(new)))
        self.stems[b""] = b""
        ids = [self.stems[v] for v in values]
        starts = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids], dtype=np.int64)])
        return coded.indices.to_numpy(), np.frombuffer(b"".join(ids), "<u4"), starts

    def _gathered(self, texts: list[bytes]) -> list[bytes]:
        words, first = flat_words(texts)
        if not words:
            return [b""] * len(texts)
        coded = pa.array(words, pa.binary()).dictionary_encode()
        code = coded.indices.to_numpy()
        stem, tail = map(self._flat, self._parts(coded.dictionary))
        # per word the ids of its stem, then of its tail
        ids = np.concatenate([stem[1], tail[1]])
        begin, size = np.empty(2 * len(code), np.int64), np.empty(2 * len(code), np.int64)
        for at, (index, _, starts), shift in ((0, stem, 0), (1, tail, len(stem[1]))):
            own = index[code]
            begin[at::2] = starts[own] + shift
            size[at::2] = starts[own + 1] - starts[own]
        after = np.cumsum(size)
        place = np.arange(after[-1]) + np.repeat(begin - (after - size), size)
        body = ids[place].astype("<u4").tobytes()
        edge = 4 * np.concatenate([[0], after])[2 * first]
        return [body[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        self.stems.trim()
        whole = []
        for t in texts:  # words are lower-cased before they are looked up
            lower = t.lower()
            whole.append(not self.by_word or any(s in lower for s in self.special))
        rest = iter(self.encode([t for t, w in zip(texts, whole) if w]))
        found = iter(self._gathered([t for t, w in zip(texts, whole) if not w]))
        return [next(rest) if w else next(found) for w in whole]


_word_ids: dict[bytes, _WordIds] = {}


def _encoder(data: bytes) -> _WordIds:
    if data not in _word_ids:
        _word_ids.clear()
        _word_ids[data] = _WordIds(data)
    return _word_ids[data]


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document's ids, then
    ``end_id``, cut into pieces of at most ``sequence``."""
    _, model = broadcast_model(docs.sparkSession, tokenizer_path)
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        for part in byte_slices(batches):
            rows, starts, lengths, crcs, totals = [], [], [], [], []
            for i, ids in enumerate(encoder.ids(binary_values(part.column("text")))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, sequence):
                    body = ids[4 * start:4 * (start + sequence)]
                    rows.append(i)
                    starts.append(start)
                    lengths.append(len(body) // 4)
                    crcs.append(zlib.crc32(body))
                    totals.append(total)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(rows, pa.int64())),
                 *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))],
                ["id", "start", "length", "ids_crc32", "doc_tokens"])

    slim = docs.select(*id_and_text(docs, id_col, text_col))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(
        cut, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    ).withColumnRenamed("id", id_col)


def pack_histogram(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset).

    ``packs`` holds (fill, first sequence, count) of groups of equally filled
    sequences; a group that takes fewer pieces than it has sequences is split.
    Each length adds at most one new group and one split, so the number of
    groups is bounded by the number of lengths, whatever the number of pieces.
    """
    packs: list[tuple[int, int, int]] = []
    runs: list[tuple[int, int, int, int, int]] = []
    used = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if packs and packs[0][0] + length <= sequence:
                fill, first, count = heapq.heappop(packs)
                take = min(left, count)
                if take < count:
                    heapq.heappush(packs, (fill, first + take, count - take))
            else:
                room = max(1, sequence // length)
                fill, first, take = 0, used, -(-left // room)
                used += take
            runs.append((length, rank, take, first, fill))
            if fill + length < sequence:
                heapq.heappush(packs, (fill + length, first, take))
            left -= take
            rank += take
    return runs


def ranked(cut: DataFrame, order: list[str]) -> DataFrame:
    """``rank`` from 0 among the pieces of a length, without a task that holds
    them all: rows are numbered within parts of a length, and a table of at most
    lengths x parts counts gives each part's first rank."""
    part = F.pmod(F.xxhash64(*order), F.lit(RANK_PARTS)).cast("int")
    cut = cut.withColumn("_part", part)
    counts = cut.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    first = counts.select(
        "length", "_part",
        (F.sum("_n").over(W.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_first"))
    numbered = cut.withColumn("_row", F.row_number().over(
        W.partitionBy("length", "_part").orderBy(*order)))
    return (numbered.join(F.broadcast(first), ["length", "_part"])
            .withColumn("rank", F.col("_first") + F.col("_row") - 1)
            .drop("_part", "_first", "_row"))


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one
    row per piece; every id of a document (and the end id) lies in one piece.

    A null or empty text is the end id alone. Null ids are kept. Repeated rows
    are packed once each. Pieces of equal length are interchangeable; ties go
    by id, start and checksum. Long documents fill whole sequences and leave
    one shorter piece. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = staged(pieces(docs, tokenizer_path, sequence, end_id, id_col, text_col), "pieces")
    histogram = {r["length"]: r["n"] for r in  # at most `sequence` rows
                 cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.asarray(pack_histogram(histogram, sequence), np.int64).reshape(-1, 5)
    keys = runs[:, 0] << 44 | runs[:, 1]
    by_key = np.argsort(keys, kind="stable")
    table = spark.sparkContext.broadcast((keys[by_key], runs[by_key]))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, runs = table.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            run = runs[np.searchsorted(keys, length << 44 | rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (id_col, "start", "length", "ids_crc32", "doc_tokens")),
                 pa.array(run[:, 3] + rank - run[:, 1], pa.int64()), pa.array(run[:, 4], pa.int64())],
                [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    with_rank = ranked(cut, [id_col, "start", "ids_crc32"])
    return with_rank.mapInArrow(place, f"{schema}, sequence_id long, offset long")
