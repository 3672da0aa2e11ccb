"""Best-fit packing of token sequences.

Only lengths matter for a packing, so all documents are reduced to a histogram of at most `room` lengths. Over it a
configuration linear program (which mixes of lengths fill a sequence, and how often each is used) is solved by
multiplicative weights: a knapsack dynamic program prices the best mixes under the current weights, which fall
exponentially with how well their lengths are covered; the average over the rounds is rounded down, and what is left is
packed bin by bin with a bounded subset-sum program. The weights also give a bound under which no packing can go. Pieces then find their place from their rank among pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stored
from .tokens import END, encoder

ROOM = 1024
ROUNDS = 200  # of pricing; the solution is the average over them
RATE = 0.02  # of the multiplicative update in the first rounds
NEAR = 0.01  # how far under the best value a mix may lie to be used
PER_BUCKET = 50_000  # pieces ranked together

Mix = Sequence[tuple[int, int]]  # lengths and how many of each


def price(values: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over lengths 1..room (values[0] is unused): the best value of each room up to this one, and the
    length with which it is reached (0: the value of one less)."""
    best = np.zeros(room + 1)
    pick = np.zeros(room + 1, np.int64)
    for c in range(1, room + 1):
        options = best[c - 1 :: -1] + values[1 : c + 1]
        k = int(options.argmax())
        if options[k] > best[c - 1]:
            best[c], pick[c] = options[k], k + 1
        else:
            best[c] = best[c - 1]
    return best, pick


def _mix(pick: list[int], first: int, room: int) -> tuple[tuple[int, int], ...]:
    """The best mix with the length `first` in it."""
    counts = {first: 1}
    c = room - first
    while c:
        if pick[c]:
            counts[pick[c]] = counts.get(pick[c], 0) + 1
            c -= pick[c]
        else:
            c -= 1
    return tuple(sorted(counts.items(), reverse=True))


def step_weights(hist: np.ndarray, room: int = ROOM) -> np.ndarray:
    """The best of the known solutions of the dual that round lengths to multiples of a step: below half the room down, above it
    so that what is left of the room is rounded down. The length itself is one too, for the step of 1."""
    length = np.arange(room + 1)
    best, most = length / room, -1.0
    for step in range(1, room // 2 + 1):
        whole = room // step
        value = np.where(2 * length > room, 2 * (whole - (room - length) // step), np.where(2 * length == room, whole, 2 * (length // step))) / (2 * whole)
        if (total := float(value @ hist)) > most:
            best, most = value, total
    return best


def solve_lp(hist: np.ndarray, room: int = ROOM, rounds: int = ROUNDS, rate: float = RATE, near: float = NEAR) -> tuple[dict[Mix, float], float]:
    """Mixes with how often each is used, and a bound: no packing has fewer sequences.

    Every round prices mixes by weights of lengths. For each length the best mix that holds it is taken if its value is within
    `near` of the best of all, and the bound's sequences are dealt to these; weights then fall exponentially with how often
    their lengths are covered. Mixes and weights are averaged over all rounds but the first quarter; the averaged weights over
    the value of their best mix solve the dual, which gives the bound, unless the weights it starts from give a higher one.
    """
    lengths = np.flatnonzero(hist)
    if not len(lengths):
        return {}, 0.0
    start = step_weights(hist, room)
    bound, late = max(float(start @ hist), float(np.arange(room + 1) @ hist) / room), 0
    weights = np.where(hist > 0, start + 0.02 * np.arange(room + 1) / room, -1.0)
    total = np.zeros(room + 1)
    used: dict[Mix, float] = {}
    for turn in range(rounds):
        best, pick = price(weights, room)
        bound = max(bound, float((weights[lengths] * hist[lengths]).sum() / best[room]))
        value = weights[lengths] + best[room - lengths]
        steps = pick.tolist()
        chosen = [(_mix(steps, int(n), room), float(hist[n])) for n in lengths[value >= (1 - near) * best[room]]]
        unit = bound / sum(n for _, n in chosen)
        covered = np.zeros(room + 1)
        for mix, n in chosen:
            for length, count in mix:
                covered[length] += count * n * unit
        if turn * 4 >= rounds:
            late += 1
            total[lengths] += weights[lengths] / best[room]
            for mix, n in chosen:
                used[mix] = used.get(mix, 0.0) + n * unit
        ratio = np.minimum(covered[lengths] / hist[lengths], 4.0)
        weights[lengths] *= np.exp(-rate / (1 + turn / 32) ** 0.5 * (ratio - 1))
        weights[lengths] /= weights[lengths].max()
    total = np.where(hist > 0, total, -1.0)
    bound = max(bound, float((total[lengths] * hist[lengths]).sum() / price(total, room)[0][room]))
    return {mix: n / late for mix, n in used.items()}, bound


def rounded(hist: np.ndarray, used: dict[Mix, float], room: int = ROOM) -> list[tuple[Mix, int]]:
    """Whole uses of the mixes that the histogram still holds, most used first, and the rest bin by bin."""
    left = hist.astype(np.int64).copy()
    out: list[tuple[Mix, int]] = []
    for mix, times in sorted(used.items(), key=lambda m: (-m[1], m[0])):
        whole = min(int(times), *(int(left[length]) // n for length, n in mix))
        if whole > 0 and sum(length * n for length, n in mix) == room:
            for length, n in mix:
                left[length] -= n * whole
            out.append((list(mix), whole))
    return out + fill_rest(left, room)


def fill_rest(left: np.ndarray, room: int = ROOM) -> list[tuple[Mix, int]]:
    """Integral bins for what is left: the longest piece, then the subset that fills its bin best; used as often as it can be."""
    left = left.copy()
    out: list[tuple[Mix, int]] = []
    while left.any():
        first = int(np.flatnonzero(left)[-1])
        mix = {first: 1}
        space = room - first
        sums, trail = 1, []
        full = (1 << (space + 1)) - 1
        for length in map(int, np.flatnonzero(left[: space + 1])[::-1]):
            n = min(int(left[length]) - (length == first), space // length)
            before = sums
            part = 1
            while n > 0:  # n copies by parts that double
                take = min(part, n)
                trail.append((length, take, sums))
                sums |= (sums << (length * take)) & full
                n -= take
                part *= 2
            if sums >> space & 1:
                break
            if sums == before:
                continue
        at = sums.bit_length() - 1
        for length, take, before in reversed(trail):
            if not before >> at & 1:
                mix[length] = mix.get(length, 0) + take
                at -= length * take
        times = min(int(left[length]) // n for length, n in mix.items())
        for length, n in mix.items():
            left[length] -= n * times
        out.append((sorted(mix.items(), reverse=True), times))
    return out


def plan(hist: np.ndarray, room: int = ROOM) -> list[tuple[Mix, int]]:
    """Mixes and how many sequences each fills; together they hold exactly the histogram. The program's solution rounded, or bins
    filled one after the other where these are fewer (few pieces of many lengths leave little to round down to)."""
    used, _ = solve_lp(hist, room)
    return min(rounded(hist, used, room), fill_rest(hist.astype(np.int64), room), key=lambda bins: sum(times for _, times in bins))


def places(bins: list[tuple[Mix, int]], room: int = ROOM) -> dict[str, np.ndarray]:
    """For each length, the ranges of ranks that go to a mix: first rank, first sequence, pieces a sequence, offset."""
    seen = np.zeros(room + 1, np.int64)
    rows = []
    sequence = 0
    for mix, times in bins:
        offset = 0
        for length, n in mix:
            rows.append((length, seen[length], sequence, n, offset))
            seen[length] += n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 50) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "n": table[:, 3], "offset": table[:, 4]}


def cut(ids: np.ndarray, room: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: the first takes the remainder, the others are full."""
    first = (len(ids) - 1) % room + 1
    starts = [0, *range(first, len(ids), room)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document; a null text has only the end id."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    out_schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        work = encoder(tokenizer_path)
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                rows = []
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for doc_id, ids in zip(batch.column(0).to_pylist(), work.encode(texts), strict=True):
                    ids = np.append(ids, np.uint32(end)).astype("<u4")
                    for p, (a, n) in enumerate(cut(ids, room)):
                        part = ids[a : a + n]
                        rows.append((doc_id, p, a, n, zlib.crc32(part.tobytes()), *([part.astype(np.int32)] * with_ids)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out_schema, strict=True)], schema=out_schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tokenize, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Each document is tokenized once; a null or empty text gives one piece with the end id. Rows that repeat an id are
    separate documents. The driver sees only the histogram of lengths (room values) and the plan drawn from it. An
    empty table gives an empty result.
    """
    cut_up = pieces(docs, tokenizer_path, id_col, text_col, room, end, with_ids)
    spark = docs.sparkSession
    rows = stored(cut_up, "packing-pieces")
    buckets = max(256, rows.count() // PER_BUCKET)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    counts = stored(rows.groupBy("bucket", "length").count(), "packing-counts")
    hist = np.zeros(room + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect():
        hist[r.length] = r.n
    where = spark.sparkContext.broadcast(places(plan(hist, room), room))

    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("bucket", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    own = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece")
    ranked = rows.withColumn("own", F.row_number().over(own) - 1).join(base, ["bucket", "length"]).withColumn("rank", F.col("base") + F.col("own"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = where.value
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(t["key"], (length << 50) + rank, side="right") - 1
            q = rank - t["rank"][at]
            sequence = t["sequence"][at] + q // t["n"][at]
            offset = t["offset"][at] + q % t["n"][at] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*names, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids + ", sequence_id long, offset long"
    return ranked.select(*names, "rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids of the whole sequence and the documents in it, from pack(..., with_ids=True)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
