"""Substring dedup: words that repeat a passage of a document with a smaller id.

Every document's non-overlapping blocks of BLOCK words are the index; every rolling window of BLOCK words probes it.
Since any WINDOW words hold a whole block of either document, a repeated passage has a hit. A hit is extended over
neighbouring probes that occur elsewhere too; where that gives a passage of WINDOW words or more, its windows are
compared exactly (by 64-bit hash) and belong to the smallest id they occur in.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as x
from .words import Words, words

WINDOW = 13
BLOCK = 7  # 2 * BLOCK - 1 <= WINDOW: a window holds a whole aligned block

ASK = pa.schema([("range", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary()), ("many", pa.binary()), ("block", pa.binary())])
TOLD = pa.schema([("bucket", pa.int32()), ("range", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def _uniq(keys: np.ndarray):
    """Sorted distinct keys, the stable order, where each run starts, and each key's place among the distinct."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(keys) else np.zeros(0, np.int64)
    run = np.empty(len(keys), np.int64)
    run[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
    return ranked[starts], order, starts, run


class Bucket:
    """The probes of a bucket's documents in the order of the exchange."""

    def __init__(self, table: pa.Table, lay: x.Layout, block: int):
        self.lay, self.block = lay, block
        self.ids = np.array([x.LAST_ID if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
        self.bucket = table["bucket"][0].as_py() if table.num_rows else 0
        self.words: Words = words(table["text"])
        hashes, self.at = self.words.grams(block)
        self.owner = self.words.owner
        self.keys, self.order, self.starts, self.run = _uniq(x.clip(hashes, lay))
        self.parts = x.ranges(self.keys, lay)

    def ask(self) -> pa.Table:
        """For each range: the distinct probes, which are in several ids here, and which are blocks of the index."""
        ids = self.ids[self.owner[self.at[self.order]]]
        if len(self.keys):
            many = np.minimum.reduceat(ids, self.starts) != np.maximum.reduceat(ids, self.starts)
            aligned = (self.at - self.words.first[self.owner[self.at]]) % self.block == 0
            block = np.logical_or.reduceat(aligned[self.order], self.starts)
        tables = []
        for r in np.flatnonzero(np.diff(self.parts)):
            s = slice(self.parts[r], self.parts[r + 1])
            tables.append((r, self.bucket, x.short(self.keys[s], self.lay).tobytes(), None, x.pack_bits(many[s]), x.pack_bits(block[s])))
        return x.rows(ASK, list(zip(*tables, strict=True)) or [[]] * 6)

    def marks(self, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """By word: whether the probe that starts there occurs in another id; whether such a hit is a block."""
        shared, seed = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        for r, kind, a, b in zip(*(told[c].to_pylist() for c in ("range", "kind", "a", "b")), strict=True):
            if kind == 1:
                s = slice(self.parts[r], self.parts[r + 1])
                shared[s], seed[s] = x.unpack_bits(a, s.stop - s.start), x.unpack_bits(b, s.stop - s.start)
        by_word = np.zeros((2, len(self.owner)), bool)
        by_word[0, self.at], by_word[1, self.at] = shared[self.run], seed[self.run]
        return by_word[0], by_word[1]

    def candidates(self, told: pa.Table, window: int):
        """Windows within maximal runs of hits, of one document: their hashes and places."""
        shared, seed = self.marks(told)
        span = window - self.block + 1  # probes in a window
        n_shared, n_seed = np.append(0, np.cumsum(shared)), np.append(0, np.cumsum(seed))
        hashes, at = self.words.grams(window)
        inside = (n_shared[at + span] - n_shared[at] == span) & (n_seed[at + span] > n_seed[at])
        return hashes[inside], at[inside]


def _answer_probes(asked: pa.Table) -> pa.Table:
    """Which probes of a range occur in several ids, and which of those are blocks of the index."""
    sent = [np.frombuffer(h, np.uint32) for h in asked["hashes"].to_pylist()]
    sizes = [len(h) for h in sent]
    many = np.concatenate([x.unpack_bits(m, n) for m, n in zip(asked["many"].to_pylist(), sizes, strict=True)])
    block = np.concatenate([x.unpack_bits(m, n) for m, n in zip(asked["block"].to_pylist(), sizes, strict=True)])
    _, order, starts, run = _uniq(np.concatenate(sent))
    shared = (np.diff(np.append(starts, len(order))) > 1) | np.logical_or.reduceat(many[order], starts)
    seed = shared & np.logical_or.reduceat(block[order], starts)
    shared, seed = shared[run], seed[run]
    out, at = [], 0
    for bucket, r, n in zip(asked["bucket"].to_pylist(), asked["range"].to_pylist(), sizes, strict=True):
        s = slice(at, at := at + n)
        if shared[s].any():
            out.append((bucket, r, 1, x.pack_bits(shared[s]), x.pack_bits(seed[s])))
    return x.rows(TOLD, list(zip(*out, strict=True)) or [[]] * 5)


def _answer_windows(asked: pa.Table) -> pa.Table:
    """Whether each window of a range occurs in a smaller id than the bucket's own smallest."""
    sent = [np.frombuffer(h, _U64) for h in asked["hashes"].to_pylist()]
    ids = np.concatenate([np.frombuffer(i, np.int64) for i in asked["ids"].to_pylist()])
    _, order, starts, run = _uniq(np.concatenate(sent))
    earlier = np.minimum.reduceat(ids[order], starts)[run] < ids
    out, at = [], 0
    for bucket, r, h in zip(asked["bucket"].to_pylist(), asked["range"].to_pylist(), sent, strict=True):
        s = slice(at, at := at + len(h))
        if earlier[s].any():
            out.append((bucket, r, 2, x.pack_bits(earlier[s]), None))
    return x.rows(TOLD, list(zip(*out, strict=True)) or [[]] * 5)


_U64 = np.dtype(np.uint64)


def _own_windows(work: Bucket, told: pa.Table, window: int):
    hashes, at = work.candidates(told, window)
    keys, order, starts, run = _uniq(hashes)
    ids = work.ids[work.owner[at]]
    least = np.minimum.reduceat(ids[order], starts) if len(keys) else ids
    return at, ids, keys, run, least, x.ranges(keys, work.lay)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256, kept_text (the kept words, joined by a space).

    A word goes if one of its windows also starts in a document with a smaller id; all windows are judged on the input.
    A null text has no words. A null id is larger than any id. Rows that repeat an id are one document to each other:
    they take nothing from each other. Texts under `window` words lose nothing. An empty table gives an empty result.
    """
    block = (window + 1) // 2
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lay = x.layout(rows, 1)
    work = x.in_buckets(rows, lay)

    def ask_probes(table: pa.Table) -> pa.Table:
        return Bucket(table, lay, block).ask()

    def ask_windows(table: pa.Table, told: pa.Table) -> pa.Table:
        if not told.num_rows or not table.num_rows:
            return x.rows(ASK, [[]] * 6)
        b = Bucket(table, lay, block)
        _, _, keys, _, least, parts = _own_windows(b, told, window)
        out = [(r, b.bucket, keys[parts[r] : parts[r + 1]].tobytes(), least[parts[r] : parts[r + 1]].tobytes(), None, None) for r in np.flatnonzero(np.diff(parts))]
        return x.rows(ASK, list(zip(*out, strict=True)) or [[]] * 6)

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return x.rows(OUT, [[]] * 5)
        b = Bucket(table, lay, block) if told.num_rows else None
        gone = np.zeros(0, bool)
        first = None
        if b is not None:
            at, ids, keys, run, least, parts = _own_windows(b, told, window)
            earlier = np.zeros(len(keys), bool)
            for r, kind, a in zip(*(told[c].to_pylist() for c in ("range", "kind", "a")), strict=True):
                if kind == 2:
                    earlier[parts[r] : parts[r + 1]] = x.unpack_bits(a, parts[r + 1] - parts[r])
            hit = at[earlier[run] | (ids > least[run])] if len(at) else at
            cover = np.zeros(len(b.owner) + window + 1, np.int64)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + window, -1)
            gone = np.cumsum(cover)[: len(b.owner)] > 0
            first = b.words.first
        out = []
        for k, (doc_id, text) in enumerate(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)):
            kept = (text or "").encode("utf-8", "surrogatepass").split()
            n = len(kept)
            if first is not None and (own := gone[first[k] : first[k + 1]]).any():
                kept = list(compress(kept, (~own).tolist()))
            joined = b" ".join(kept)
            out.append((doc_id, n, n - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "surrogatepass") if with_text else None))
        return x.rows(OUT, list(zip(*out, strict=True)))

    asked = work.groupBy("bucket").applyInArrow(ask_probes, x.ddl(ASK))
    told_probes = asked.groupBy("range").applyInArrow(_answer_probes, x.ddl(TOLD))
    asked_windows = work.groupBy("bucket").cogroup(told_probes.groupBy("bucket")).applyInArrow(ask_windows, x.ddl(ASK))
    told_windows = asked_windows.groupBy("range").applyInArrow(_answer_windows, x.ddl(TOLD))
    told = told_probes.unionByName(told_windows)
    return work.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(finish, x.ddl(OUT))
