"""Token counts (operator 1).

Texts are encoded in batches inside an Arrow function that returns lengths
only. Batches are balanced by bytes, and texts are split where no token can
span the cut: a sentencepiece BPE piece never has the word mark after another
character (checked when the model is loaded), so each word can be encoded on
its own and equal words of a batch are encoded once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BoundedCache, binary_values, byte_slices, id_and_text
from .tokenizers_io import broadcast_model, sentencepiece_of, tokenizer_of

OVER_LIMIT = 4096
#: A word longer than this is cut further, at its line ends.
LONG_SEGMENT = 16 << 10
_MARK = "▁".encode()  # stands for a space inside the model
_CUT = re.compile(rb"(?<=[^ ]) ")
_LINE_CUT = re.compile(rb"(?<=[^\n])(?=\n)")


class _PieceCounter:
    """Token counts of whole texts by a sentencepiece model."""

    def __init__(self, data: bytes):
        self.sp = sentencepiece_of(data)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        enc = self.sp.encode
        self.splits = (
            not any("▁" in p.lstrip("▁") for p in pieces)
            and enc("a b") == enc("a") + enc("b")
            and enc("a  b") == enc("a") + enc(" b")
            and enc("a ") == enc("a") + [self.sp.piece_to_id("▁")]
            and enc("ﬁ") != enc("fi")  # no normalisation that could join characters
        )
        newline = enc("\n")
        self.line_splits = (
            self.splits and not any("\n" in p for p in pieces)
            and len(newline) == 2 and enc("a\nb") == enc("a") + enc("\nb")[1:]
        )
        self.cache = BoundedCache()

    def segments(self, text: bytes) -> list[bytes]:
        """Pieces of a non-empty text that can be encoded one by one; the space
        before each piece but the first is dropped, as the encoder adds it."""
        if not self.splits or _MARK in text:
            return [text]
        if b"  " in text or text[:1] == b" ":
            return _CUT.split(text)
        return text.split(b" ")

    def encode_lengths(self, segments: list[bytes]) -> list[int]:
        return [len(ids) for ids in self.sp.encode([s.decode("utf-8", "replace") for s in segments],
                                                   num_threads=1)]

    def long_length(self, segment: bytes) -> int:
        if not self.line_splits:
            return self.encode_lengths([segment])[0]
        parts = _LINE_CUT.split(segment)
        # each part after the first begins with a line end and is encoded with
        # the word mark in front of it, which is one token too many
        return sum(self.encode_lengths(parts)) - (len(parts) - 1)

    def counts(self, texts: list[bytes]) -> list[int]:
        cache = self.cache
        cache.trim()
        cache[b""] = 1  # a last lone space: the word mark itself
        split = [self.segments(t) if t else None for t in texts]
        missing = {s for segs in split if segs for s in segs if s not in cache}
        short = [s for s in missing if len(s) <= LONG_SEGMENT]
        cache.update(zip(short, self.encode_lengths(short)))
        own = {s: self.long_length(s) for s in missing if len(s) > LONG_SEGMENT}
        if own:
            get = lambda s: own[s] if s in own else cache[s]
        else:
            get = cache.__getitem__
        return [sum(map(get, segs)) if segs else 0 for segs in split]


class _WholeCounter:
    """Token counts of whole texts by a tokenizers file."""

    def __init__(self, data: bytes):
        self.tokenizer = tokenizer_of(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def counts(self, texts: list[bytes]) -> list[int]:
        encoded = self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts],
                                              add_special_tokens=False)
        return [len(e.ids) for e in encoded]


@lru_cache(maxsize=2)
def _counter(kind: str, data: bytes):
    return _PieceCounter(data) if kind == "model" else _WholeCounter(data)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = OVER_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row.

    Counts are those of the library on the whole text, without added special
    tokens. Null and empty texts have 0 bytes and 0 tokens; null ids and
    repeated rows are kept as they are; other columns are ignored; an empty
    table gives no rows. A text of any length is handled in one task, in
    pieces cut at safe places.
    """
    kind, model = broadcast_model(docs.sparkSession, tokenizer_path)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(kind, model.value)
        for part in byte_slices(batches):
            sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            tokens = pa.array(counter.counts(binary_values(part.column("text"))), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), sizes, tokens],
                                             ["id", "n_bytes", "n_tokens"])

    slim = docs.select(*id_and_text(docs, id_col, text_col))
    kind_of_id = slim.schema["id"].dataType.simpleString()
    counted = slim.mapInArrow(count, f"id {kind_of_id}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
