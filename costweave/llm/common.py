"""Helpers that several operators of this subpackage share.

* tables are read through Spark only, so any path Spark opens will do;
* intermediates are written under the folder that ``spark.checkpoint.dir``
  names (``costweave.session.cut_lineage``), never to a local folder;
* 64-bit hashes are xxh3 of whole byte strings, mixed with fixed odd
  constants, so that a name means the same thing in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave.session import cut_lineage

__all__ = ["read_table", "fresh", "shuffle_width", "mix", "odd_constants", "words_of", "hash_words",
           "text_batches", "cut_lineage", "record_batch", "keyed"]

BATCH_BYTES = 3 << 20            # text handled at once inside a task
SEGMENT_BYTES = 4 << 20          # a longer text is hashed in segments of this size


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(columns, name: str) -> str:
    """A column name that no column of the frame has (names compare without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, under fixed names."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (in place on a copy)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(base) | np.uint64(1)


def words_of(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split`` cuts at exactly these six bytes."""
    return data.split()


def hash_words(data: bytes) -> np.ndarray:
    """xxh3 of every word; long texts go segment by segment so that the
    Python word objects stay bounded."""
    f = xxhash.xxh3_64_intdigest
    if len(data) <= SEGMENT_BYTES:
        words = data.split()
        return np.fromiter(map(f, words), np.uint64, len(words))
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT_BYTES)
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = data[at:end].split()
        out.append(np.fromiter(map(f, words), np.uint64, len(words)))
        at = end
    return np.concatenate(out)


def text_batches(batches, limit: int = BATCH_BYTES):
    """Record batches (first two columns: id, text) as ``(ids, texts)`` pieces
    of about ``limit`` bytes; ids is an object list (null: None), texts are
    bytes (null: None)."""
    ids: list = []
    texts: list = []
    size = 0
    for batch in batches:
        col_ids = batch.column(0).to_pylist()
        col_text = batch.column(1).cast(pa.binary())
        for i, doc in enumerate(col_ids):
            t = col_text[i].as_py()
            ids.append(doc)
            texts.append(t)
            size += len(t) if t else 16
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def record_batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
