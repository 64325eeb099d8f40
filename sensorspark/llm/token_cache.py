"""Token counts through a cache of digests.

A text is known by the SHA-256 of its normalised content (NULL becomes the empty text, the
rest is left as it is, because any further change could alter the count) and by a digest of
the tokenizer's file and library version.  Texts are looked up by digest, only distinct
misses are encoded, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark.llm.common import batches, text_or_empty

SCHEMA = "tokenizer string, digest binary, n_tokens long"


def _library(path: str) -> str:
    if path.endswith(".model"):
        return "sentencepiece"
    if path.endswith(".json"):
        return "tokenizers"
    raise ValueError(f"no tokenizer library for {path}")


def _counter(library: str, file: bytes) -> Callable[[list[str]], list[int]]:
    """Counts tokens as the library gives them: nothing added, cut or padded."""
    if library == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=file)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    import tokenizers

    model = tokenizers.Tokenizer.from_buffer(file)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


class TokenCache:
    """Counts of one tokenizer, kept as a Parquet table under ``path``.

    The table may hold counts of other tokenizers as well.  A failed run appends nothing;
    a run beside another one may append a digest twice, which is read once.
    """

    def __init__(self, spark: SparkSession, path: str, tokenizer: str):
        self.spark, self.path = spark, path
        self.library = _library(tokenizer)
        with open(tokenizer, "rb") as f:
            self.file = f.read()
        name = f"{self.library} {version(self.library)} ".encode()
        self.tokenizer = hashlib.sha256(name + self.file).hexdigest()
        spark.createDataFrame([], SCHEMA).write.mode("append").parquet(path)

    def stored(self) -> DataFrame:
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        return rows.filter(F.col("tokenizer") == self.tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def add(self, texts: DataFrame) -> None:
        """Encode the texts whose digest is not stored, each once, and append their counts.

        Copies are dropped inside the map tasks first, so that a text that fills the table
        reaches its shuffle partition once per task.
        """
        file = self.spark.sparkContext.broadcast(self.file)
        library = self.library

        def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = _counter(library, file.value)
            for whole in parts:
                for part in batches(whole, "text", 1 << 20):
                    yield pa.record_batch(
                        {
                            "digest": part.column("digest"),
                            "n_tokens": pa.array(np.array(count(part.column("text").to_pylist()), np.int64)),
                        }
                    )

        distinct = texts.select(_digest().alias("digest"), text_or_empty().alias("text")).dropDuplicates(["digest"])
        misses = distinct.join(self.stored(), "digest", "left_anti")
        counted = misses.select("digest", "text").mapInArrow(encode, "digest binary, n_tokens long")
        counted.select(F.lit(self.tokenizer).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(self.path)

    def counts(self, docs: DataFrame) -> DataFrame:
        """``(doc_id, n_bytes, n_tokens)``, one row for each row of ``docs``."""
        self.add(docs)
        rows = docs.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), _digest().alias("digest"))
        return rows.join(self.stored(), "digest").select("doc_id", "n_bytes", "n_tokens")


def _digest():
    return F.unhex(F.sha2(text_or_empty(), 256))
