"""Public tokenizer files inside tasks.

The file is read on the driver and travels to the executors in a broadcast
whose size is checked, so executors need no copy of it.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark import Broadcast
from pyspark.sql import SparkSession

MAX_MODEL_BYTES = 64 << 20


def broadcast_model(spark: SparkSession, path: str) -> tuple[str, Broadcast]:
    """(kind, bytes): kind is "model" for sentencepiece, "json" for tokenizers."""
    kind = path.rsplit(".", 1)[-1]
    if kind not in ("model", "json"):
        raise ValueError(f"not a tokenizer file of a known kind: {path}")
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return kind, spark.sparkContext.broadcast(data)


@lru_cache(maxsize=2)
def sentencepiece_of(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


@lru_cache(maxsize=2)
def tokenizer_of(data: bytes):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
    from tokenizers import Tokenizer

    return Tokenizer.from_str(data.decode("utf-8"))
