"""Exact dedup through an extendible-hash index kept as shared files.

The directory maps the leading bits of a 64-bit key to a bucket, and doubles until no bucket holds more distinct keys than
its capacity; it is counted from a sketch, so copies do not split a bucket. Entries and rows find their bucket by the
directory. One owner task handles the entries of a bucket: it chains those whose keys collide. Texts are compared by their
bytes where copies are combined into an entry, and by their SHA-256 where a row walks its key's chain. All steps are
DataFrame operations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stored

SLOT_BITS = 14  # of the directory, unless there are too many keys for that
MOST_BITS = 18  # of the largest, which is part of the plan
CAPACITY = 4096  # distinct keys in a bucket
MANY = 10_000  # rows of one text that a task gets
HOT = 100_000  # texts with more that are broadcast


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("text"))


def _slot(bits: int = SLOT_BITS):
    return F.shiftrightunsigned("key", 64 - bits)


def split_directory(loads: dict[int, float], capacity: float, bits: int = SLOT_BITS) -> list[int]:
    """Pointers for all 2**bits slots: the first slot of the bucket that each belongs to.

    Starts with one bucket and doubles: every overfull bucket splits on its next bit, until none is overfull
    or the bits are used up (one key is never split; its rows are aggregated before they move).
    """
    prefix = [0.0]
    for slot in range(1 << bits):
        prefix.append(prefix[-1] + loads.get(slot, 0.0))
    pointers = [0] * (1 << bits)
    work = [(0, 1 << bits)]
    while work:
        start, size = work.pop()
        if size > 1 and prefix[start + size] - prefix[start] > capacity:
            work += [(start, size // 2), (start + size // 2, size // 2)]
        else:
            pointers[start : start + size] = [start] * size
    return pointers


@dataclass(frozen=True)
class Index:
    """entries: one row per distinct text: bucket, key, chain (its place among texts of one key), text_sha256, keep_id,
    group_size; pointers: the directory."""

    entries: DataFrame
    pointers: list[int]

    def bucket(self) -> Column:
        listed = F.split(F.lit(",".join(map(str, self.pointers))), ",").cast("array<int>")  # the planner makes one constant of it
        return F.element_at(listed, (_slot(len(self.pointers).bit_length() - 1) + 1).cast("int"))


def directory(keyed: DataFrame, capacity: int) -> list[int]:
    """The pointers for keyed rows. More keys than SLOT_BITS can part at this capacity get a directory of more bits, up to MOST_BITS:
    a bucket is over its capacity only where the directory is as large as a plan can carry."""
    bits, wanted = 0, SLOT_BITS
    while bits < wanted:
        bits = wanted
        loads = {r.slot: r.n for r in keyed.groupBy(_slot(bits).alias("slot")).agg(F.approx_count_distinct("key", 0.05).alias("n")).collect()}
        wanted = min(MOST_BITS, math.ceil(math.log2(max(4 * sum(loads.values()) / max(capacity, 64), 1))))
    return split_directory(loads, capacity, bits)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> Index:
    """The index of docs. The aggregation that compares bytes combines copies before the shuffle: a hot text travels once per task."""
    keyed = _keyed(docs, id_col, text_col)
    index = Index(docs, directory(keyed, capacity))
    texts = keyed.groupBy(index.bucket().alias("bucket"), "key", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    entries = texts.select("bucket", "key", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    owned = entries.repartition("bucket").withColumn("chain", F.row_number().over(chain) - 1)
    return Index(stored(owned, "exact-dedup-index"), index.pointers)


def _hot(entries: DataFrame, many: int) -> DataFrame:
    """key, parts: of entries with more than `many` rows, into how many parts their rows are dealt. There is one for every `many`
    rows at most, and they are counted: HOT of them are broadcast, beyond that the plan joins them like others."""
    hot = entries.where(F.col("group_size") > many).groupBy("key").agg(F.max(F.ceil(F.col("group_size") / many)).cast("int").alias("parts"))
    return F.broadcast(hot) if hot.limit(HOT + 1).count() <= HOT else hot


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, many: int = MANY) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Null texts count as empty, and empty texts are copies of each other. Of equal texts the row with the largest
    id is kept; a null id is kept only where its text has no other id. Rows that repeat an id and a text are one
    document: all of them say kept. Other columns are ignored; an empty table gives an empty result.

    Rows look their key up in the bucket that the directory names, and walk its chain to the entry with their text. The rows of
    a text with more than `many` are dealt to several copies of its entry, so no task gets all of them.
    """
    index = build_index(docs, id_col, text_col, capacity)
    rows = _keyed(docs, id_col, text_col).select("doc_id", "key", F.sha2("text", 256).alias("text_sha256"), index.bucket().alias("bucket"))
    hot = _hot(index.entries, many)
    parts = F.coalesce("parts", F.lit(1))
    asking = rows.join(hot, "key", "left").withColumn("part", F.pmod(F.xxhash64("doc_id"), parts).cast("int")).drop("parts")
    entries = index.entries.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    found = asking.join(entries, ["bucket", "key", "part", "text_sha256"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "bucket", "chain")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """docs without the rows that find_copies does not keep; all columns stay, null ids too where kept.

    The kept pairs of id and text are unique in the index, so the semi join moves each row of docs once.
    """
    index = build_index(docs, id_col, text_col, capacity)
    keep = index.entries.select(F.col("keep_id").alias("_keep_id"), F.col("text_sha256").alias("_sha"))
    sha = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    return docs.join(keep, docs[id_col].eqNullSafe(keep["_keep_id"]) & (sha == keep["_sha"]), "left_semi")
