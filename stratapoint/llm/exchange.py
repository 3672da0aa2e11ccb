"""Asking, for every hash in a corpus, a question about all its occurrences, in two compact exchanges.

Documents lie in buckets. A bucket sends its sorted hashes, dealt by their leading bits, to one task per range; that
task answers with a few bits for each hash it was sent, and the bucket, which can compute its hashes again, reads the
answers in the same order. So a hash costs four bytes on the way there and some bits on the way back, and no task
holds more than its range.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_U = np.uint64
LAST_ID = (1 << 63) - 1  # stands for a null id: no id is larger


@dataclass(frozen=True)
class Layout:
    """buckets of documents; 2**bits ranges of hashes."""

    buckets: int
    bits: int


def layout(docs: DataFrame, bytes_per_hash: int = 1) -> Layout:
    """Sizes from the bytes of all texts, counted in one pass: a bucket of 1 to 64 MB, and ranges of at most 32 MB."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bucket = min(max(total // 4096, 1 << 20), 1 << 26)
    ranges = max(64, total * bytes_per_hash // (32 << 20))
    return Layout(max(16, -(-total // bucket)), int(ranges - 1).bit_length())


def in_buckets(docs: DataFrame, lay: Layout, instead: str = "text") -> DataFrame:
    """docs with a bucket, dealt by a hash of doc_id; rows without an id by that of another column."""
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(instead)).otherwise(F.xxhash64("doc_id"))
    return docs.withColumn("bucket", F.pmod(key, F.lit(lay.buckets)).cast("int"))


def ranges(sorted_hashes: np.ndarray, lay: Layout) -> np.ndarray:
    """Where each range starts among sorted hashes, and the end."""
    if lay.bits == 0:
        return np.array([0, len(sorted_hashes)])
    first = np.arange(1 << lay.bits, dtype=_U) << _U(64 - lay.bits)
    return np.append(np.searchsorted(sorted_hashes, first), len(sorted_hashes))


def short(hashes: np.ndarray, lay: Layout) -> np.ndarray:
    """The 32 bits after a hash's range."""
    return ((hashes << _U(lay.bits)) >> _U(32)).astype(np.uint32)


def clip(hashes: np.ndarray, lay: Layout) -> np.ndarray:
    """The bits of a hash that the exchange keeps, in place."""
    return (hashes >> _U(32 - lay.bits)) << _U(32 - lay.bits)


def pack_bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def rows(schema: pa.Schema, columns: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)
