"""Near-duplicates: documents whose sets of word shingles have a Jaccard similarity of at least a threshold.

Shingles are ordered from rare to frequent by their exact document frequency. Two similar sets share a shingle of
their prefixes, so prefixes are joined; pairs must pass length and positional filters, are verified once each (with
a suffix filter before the sets are merged) and end as links. Shingles of one document cannot be shared and are never
sent. Links matter only between what is not yet connected: the first round compares every posting list with its first
member; later ones look only at lists whose members are still in different components, gathered by their first member,
and compare some members with all, then all pairs of different components, so that no link between those is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as x
from .components import components
from .shared import stored
from .words import mix, words

SHINGLE = 5
PERCENT = 75
BLOCK = 1024  # documents around one first member that one task compares with as many others
FEW = 64  # documents that are compared with all others at once
HUBS = 4  # documents of a block that a round compares with all others
SKETCH = 512  # bits of a set's parities
REPRESENTS = -1  # in place of a range: the bucket holds the class of this digest
HUB_ROUNDS = 3  # rounds of that kind before all pairs of different components are compared
_U = np.uint64

ASK = pa.schema([("range", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("n", pa.binary())])
TOLD = pa.schema([("bucket", pa.int32()), ("range", pa.int32()), ("levels", pa.binary())])
SET = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("part", pa.int64()), ("size", pa.int64()), ("tokens", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("shared", pa.binary()), ("sketch", pa.binary())])
PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Bucket:
    """Shingle sets of a bucket's documents, end to end: hashes, and owner."""

    def __init__(self, table: pa.Table, lay: x.Layout, n: int):
        self.lay = lay
        self.bucket = table["bucket"][0].as_py()
        w = words(table["text"], fold=True)
        hashes, at = w.grams(n)
        owner = w.owner
        sizes = np.diff(w.first)
        few = np.flatnonzero((sizes > 0) & (sizes < n))  # their whole sequence is the one shingle
        whole = [int(np.bitwise_xor.reduce(mix(w.hashes[w.first[d] : w.first[d + 1]] + np.arange(1, sizes[d] + 1, dtype=_U)))) for d in few]
        hashes = np.concatenate([hashes, mix(np.array(whole, _U) ^ _U(77))])
        owner = np.concatenate([owner[at], few])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        first = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])] if len(hashes) else np.zeros(0, bool)
        self.hashes, self.owner = hashes[first], owner[first]
        self.first = np.searchsorted(self.owner, np.arange(table.num_rows + 1))
        self.keys, self.run, self.n = np.unique(x.clip(self.hashes, lay), return_inverse=True, return_counts=True)
        self.parts = x.ranges(self.keys, lay)

    def ask(self) -> pa.Table:
        out = []
        for r in np.flatnonzero(np.diff(self.parts)):
            s = slice(self.parts[r], self.parts[r + 1])
            out.append((r, self.bucket, x.short(self.keys[s], self.lay).tobytes(), self.n[s].astype(np.uint32).tobytes()))
        return x.rows(ASK, list(zip(*out, strict=True)) or [[]] * 4)

    def levels(self, told: pa.Table) -> np.ndarray:
        """Frequency level of each shingle; 0: in no other document."""
        level = np.zeros(len(self.keys), np.uint8)
        for r, data in zip(told["range"].to_pylist(), told["levels"].to_pylist(), strict=True):
            if r == REPRESENTS:
                continue
            level[self.parts[r] : self.parts[r + 1]] = np.frombuffer(data, np.uint8)
        return level[self.run]


def _answer(asked: pa.Table) -> pa.Table:
    """Frequency levels, 4 for each doubling, of the hashes of a range."""
    sent = [np.frombuffer(h, np.uint32) for h in asked["hashes"].to_pylist()]
    n = np.concatenate([np.frombuffer(c, np.uint32) for c in asked["n"].to_pylist()])
    _, run = np.unique(np.concatenate(sent), return_inverse=True)
    total = np.bincount(run, n)[run]
    level = np.where(total <= 1, 0, 1 + np.minimum(254, 4 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
    out, at = [], 0
    for bucket, r, h in zip(asked["bucket"].to_pylist(), asked["range"].to_pylist(), sent, strict=True):
        s = slice(at, at := at + len(h))
        if level[s].any():
            out.append((bucket, r, level[s].tobytes()))
    return x.rows(TOLD, list(zip(*out, strict=True)) or [[]] * 3)


def prefix(size: int, percent: int) -> int:
    """Shingles of a set, from the rarest on, of which a similar set has one."""
    return size - -(-percent * size // 100) + 1


def index_prefix(size: int, percent: int) -> int:
    """The same for partners that are not smaller."""
    return size - -(-2 * percent * size // (100 + percent)) + 1


def _class_rows(table: pa.Table, told: pa.Table) -> tuple[pa.Table, list[str]]:
    """One row, that of the smallest id, for each class of equal texts that lies in this bucket; and the digests."""
    if not table.num_rows or not told.num_rows:  # a side without rows comes without columns
        return SET.empty_table(), []
    ours = {d for r, d in zip(told["range"].to_pylist(), told["levels"].to_pylist(), strict=True) if r == REPRESENTS}
    best: dict[bytes, tuple[int, int]] = {}
    for k, (doc_id, text) in enumerate(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)):
        digest = hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()
        key = (x.LAST_ID if doc_id is None else doc_id, k)
        if digest in ours and (digest not in best or key < best[digest]):
            best[digest] = key
    chosen = sorted((k, digest.hex()) for digest, (_, k) in best.items())
    return table.take(pa.array([k for k, _ in chosen], pa.int64())), [d for _, d in chosen]


def shingle_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """From doc_id and text (not null), a row for each class of equal texts: doc_id (the smallest), digest, part (8 bytes
    of the digest, which tell texts of one id apart), size;
    tokens and ranks of the part of its prefix that other classes have; shared: all shingles that others have."""
    lay = x.layout(docs)
    digest = F.md5("text")
    classes = docs.groupBy(digest.alias("digest")).agg(F.min("doc_id").alias("doc_id"))
    reps = x.in_buckets(classes, lay, "digest").select("bucket", F.lit(REPRESENTS).alias("range"), F.unhex("digest").alias("levels"))
    work = x.in_buckets(docs.withColumn("digest", digest), lay, "digest").select("doc_id", "text", "bucket")

    def ask(table: pa.Table, told: pa.Table) -> pa.Table:
        table, _ = _class_rows(table, told)
        return Bucket(table, lay, n).ask() if table.num_rows else x.rows(ASK, [[]] * 4)

    def choose(table: pa.Table, told: pa.Table) -> pa.Table:
        table, digests = _class_rows(table, told)
        if not table.num_rows:
            return SET.empty_table()
        b = Bucket(table, lay, n)
        level = b.levels(told)
        out = []
        for k, doc_id in enumerate(table["doc_id"].to_pylist()):
            s = slice(b.first[k], b.first[k + 1])
            size, lv = s.stop - s.start, level[s]
            part = int.from_bytes(bytes.fromhex(digests[k])[:8], "little", signed=True)
            p = prefix(size, percent) if size else 0
            alone = int((lv == 0).sum())
            if alone >= p:
                out.append((doc_id, digests[k], part, size, [], [], None, None))
                continue
            order = np.lexsort((b.hashes[s], lv))[alone:p]
            shared = b.hashes[s][lv > 0]
            out.append((doc_id, digests[k], part, size, b.hashes[s][order].view(np.int64), np.arange(alone, p), shared.tobytes(), sketch(b.hashes[s])))
        return x.rows(SET, list(zip(*out, strict=True)))

    asked = work.groupBy("bucket").cogroup(reps.groupBy("bucket")).applyInArrow(ask, x.ddl(ASK))
    told = asked.groupBy("range").applyInArrow(_answer, x.ddl(TOLD)).unionByName(reps)
    schema = "doc_id long, digest string, part long, size long, tokens array<long>, ranks array<int>, shared binary, sketch binary"
    return stored(work.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(choose, schema), "shingle-sets")


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of the counts of SKETCH slots: two sets differ in at least as many elements as their sketches in bits."""
    return np.packbits(np.bincount((hashes % _U(SKETCH)).astype(np.int64), minlength=SKETCH) & 1).tobytes()


def may_match(size_a, rank_a, size_b, rank_b, percent: int):
    """Index-prefix, length and positional filters for a shingle at these ranks of two sets; columns or arrays."""
    small = F.least(size_a, size_b)
    rank_small = F.when(size_a < size_b, rank_a).when(size_a > size_b, rank_b).otherwise(F.least(rank_a, rank_b))
    indexed = rank_small < small - F.ceil(F.lit(2.0 * percent / (100 + percent)) * small - 1e-9) + 1
    long_enough = small * 100 >= F.greatest(size_a, size_b) * percent
    most = 1 + F.least(size_a - rank_a - 1, size_b - rank_b - 1)
    return indexed & long_enough & (most * (100 + percent) >= (size_a + size_b) * percent)


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 3) -> int:
    """At least how many elements two sorted sets differ in: they are split at a pivot again and again."""
    if depth == 0 or not len(a) or not len(b):
        return abs(len(a) - len(b))
    pivot = b[len(b) // 2]
    i, j = np.searchsorted(a, pivot), len(b) // 2
    return suffix_bound(a[:i], b[:j], depth - 1) + suffix_bound(a[i:], b[j:], depth - 1)


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar; each set crosses once for each of its pairs."""
    own = sets.where("shared is not null").select("doc_id", "size", "shared")
    left = own.select(F.col("doc_id").alias("a"), F.col("size").alias("size_a"), F.col("shared").alias("shared_a"))
    right = own.select(F.col("doc_id").alias("b"), F.col("size").alias("size_b"), F.col("shared").alias("shared_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "size_a", "shared_a", "size_b", "shared_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for size_a, data_a, size_b, data_b in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                a, b = np.frombuffer(data_a, _U), np.frombuffer(data_b, _U)
                need = -(-percent * (size_a + size_b) // (100 + percent))
                at_most = (len(a) + len(b) - suffix_bound(a, b)) // 2
                keep.append(at_most >= need and len(np.intersect1d(a, b, assume_unique=True)) >= need)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], schema=PAIR)

    return both.mapInArrow(check, "a long, b long")


def _first_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Each list's members with its first member."""
    hubs = postings.groupBy("token").agg(F.min(F.struct("doc_id", "size", "rank")).alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    both = postings.join(hubs, "token").where("doc_id <> hub.doc_id")
    return both.where(may_match(F.col("hub.size"), F.col("hub.rank"), F.col("size"), F.col("rank"), percent)).select(F.col("hub.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct()


def _later_pairs(postings: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of unconnected documents of posting lists that still have some.

    Lists with the same first member, such as those of one group of copies, go together, so that a pair is made once for
    them; many documents around one first member go to many tasks, block by block.
    """
    labelled = postings.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    lists = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("doc_id").alias("hub")).where("lo <> hi").select("token", "hub")
    members = stored(labelled.join(lists, "token"), "open-lists")
    sizes = members.groupBy("hub", "doc_id").agg(F.lit(1).alias("one")).groupBy("hub").agg(F.count("one").alias("n"))
    members = members.join(sizes, "hub").join(sets.where("sketch is not null").select("doc_id", "part", "sketch"), ["doc_id", "part"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = members.withColumn("own", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "token", "doc_id", "part", "size", "rank", "component", "n", "sketch")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by([("token", "ascending")])
        token, ids, part, size, rank, comp, own = (group[c].to_numpy() for c in ("token", "doc_id", "part", "size", "rank", "component", "own"))
        bits = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint64).reshape(len(ids), -1)
        i, j, n = group["i"][0].as_py(), group["j"][0].as_py(), group["n"][0].as_py()
        by_text = np.lexsort((part, ids))  # an id may have several texts
        new = np.r_[True, (np.diff(ids[by_text]) != 0) | (np.diff(part[by_text]) != 0)]
        text = np.empty(len(ids), np.int64)
        text[by_text] = np.cumsum(new) - 1
        one, ends = by_text[new], np.r_[np.flatnonzero(new), len(ids)]  # a row of each text, and where its rows lie
        comps, count = np.unique(comp, return_counts=True)
        largest = comps[count.argmax()]
        if turn < HUB_ROUNDS and n > FEW:
            some = np.flatnonzero(own[one] == i)
            sides = [(some[np.argsort(mix(ids[one[some]].astype(_U) + _U(turn * 7919)), kind="stable")][:HUBS], j)]
        else:  # of two documents in different components, one is outside the largest
            sides = [(np.flatnonzero((own[one] == u) & (comp[one] != largest)), v) for u, v in {(i, j), (j, i)}]
        a_side, b_side = [], []
        for mine, other in sides:
            for t in mine:
                rows = by_text[ends[t] : ends[t + 1]]
                lo, hi = np.searchsorted(token, token[rows]), np.searchsorted(token, token[rows], side="right")
                k = np.repeat(rows, hi - lo)
                m = np.arange(len(k)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
                ok = (own[m] == other) & (comp[m] != comp[k])
                k, m = k[ok], m[ok]
                low, high = np.minimum(size[k], size[m]), np.maximum(size[k], size[m])
                rank_low = np.where(size[m] < size[k], rank[m], np.where(size[m] > size[k], rank[k], np.minimum(rank[k], rank[m])))
                need = -(-percent * (low + high) // (100 + percent))
                most = np.minimum(size[k] - rank[k], size[m] - rank[m])
                at = one[np.unique(text[m[(low * 100 >= high * percent) & (rank_low < low - -(-2 * percent * low // (100 + percent)) + 1) & (most >= need)]])]
                if len(at):
                    differ = np.bitwise_count(bits[at] ^ bits[rows[0]]).sum(axis=1)
                    total = size[at] + size[rows[0]]
                    at = at[differ <= total - 2 * -(-percent * total // (100 + percent))]
                a_side.append(np.minimum(ids[at], ids[rows[0]]))
                b_side.append(np.maximum(ids[at], ids[rows[0]]))
        if not a_side:
            return PAIR.empty_table()
        pairs = np.unique(np.stack([np.concatenate(a_side), np.concatenate(b_side)], axis=1), axis=0)
        return x.rows(PAIR, [pairs[:, 0], pairs[:, 1]])

    return members.groupBy("hub", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Texts are compared in lower case (A-Z). Rows with equal texts are one class, represented by the smallest id, and
    joined once. A text under n words is one shingle; without words it has none and links with nothing. Null texts
    count as empty. Rows with a null id link with nothing and have a null component. Rows that repeat an id with
    different texts are judged by their own texts; texts whose smallest id is the same link that id. Long texts are
    read whole.
    """
    return _by_row(docs, id_col, text_col, n, percent).drop("digest")


def _by_row(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """near_duplicates with the digest of each row's text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = rows.select("doc_id", F.md5("text").alias("digest"))
    sets = shingle_sets(rows, n, percent)
    sets_by_id = sets.where("doc_id is not null")
    postings = stored(sets_by_id.select("doc_id", "part", "size", F.explode(F.arrays_zip("tokens", "ranks")).alias("p")).select(F.col("p.tokens").alias("token"), "doc_id", "part", "size", F.col("p.ranks").alias("rank")), "postings")

    pairs = stored(_first_pairs(postings, percent), "pairs")
    links = stored(verify(pairs, sets_by_id, percent), "pairs-linked")
    labels = components(links)
    turn = 0
    while True:
        more = stored(_later_pairs(postings, sets_by_id, labels, percent, turn).join(pairs, ["a", "b"], "left_anti"), "pairs")
        if not more.limit(1).count():
            if turn >= HUB_ROUNDS:
                break
            turn = HUB_ROUNDS
            continue
        found = stored(verify(more, sets_by_id, percent), "pairs-linked")
        pairs = stored(pairs.unionByName(more), "pairs")
        if found.limit(1).count():
            links = stored(links.unionByName(found), "pairs-linked")
            labels = components(links)
        turn += 1
        if turn > HUB_ROUNDS:
            break  # the last round compared all that was left

    by_class = sets.select("digest", "size", F.col("doc_id").alias("rep")).join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    found = keyed.join(by_class.select("digest", "size", F.coalesce("component", "rep").alias("component")), "digest")
    component = F.when((F.col("size") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", "digest", F.col("size").alias("n_shingles"), component.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs without the rows that have a smaller id in their component; all columns stay. Null ids stay. Of rows that
    repeat an id with different texts, those go whose own text has a smaller id in its component."""
    found = _by_row(docs, id_col, text_col, n, percent)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct()
    digest = F.md5(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(gone, (docs[id_col].cast("long") == gone["gone_id"]) & (digest == gone["gone_digest"]), "left_anti")
