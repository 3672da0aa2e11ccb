"""Connected components of cells or voxels, and what builds on them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .raster import FOUR


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); one of our own in a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="stratapoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def cut(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: loops neither repeat their past nor lose it with an executor."""
    path = f"{work_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def label(cells: DataFrame, axes: Sequence[str] = ("row", "col"), offsets: Sequence[tuple[int, ...]] | None = None, keys: Sequence[str] = (), block: int | None = None) -> DataFrame:
    """Cells with the label of their region, its least cell as a string of its key and axes.

    Regions are found within blocks of cells first, each in one task; then only the links between cells on either side of a
    block's border remain, one for each pair of regions. Over those the least label spreads, with shortcuts that halve
    distances, until none changes.
    """
    offsets = offsets or [o for o in FOUR if any(o)]
    block = block or (256 if len(axes) == 2 else 64)
    names = [*keys, *axes]
    own = cells.select(*names).distinct().withColumns({f"b_{a}": F.floor(F.col(a) / block).cast("int") for a in axes})
    types = dict(own.dtypes)
    schema = ", ".join(f"`{n}` {types[n]}" for n in names) + ", " + ", ".join(f"l_{a} int" for a in axes)
    parts = cut(own.groupBy(*keys, *[f"b_{a}" for a in axes]).applyInArrow(_local_labels(names, axes, offsets), schema), "regions")

    named = F.concat_ws("_", *[F.col(n).cast("string") for n in [*keys, *[f"l_{a}" for a in axes]]])
    least = F.struct(*keys, *[F.col(f"l_{a}") for a in axes])
    at_border = reduce(or_, [(F.pmod(F.col(a), F.lit(block)) == e) for a in axes for e in (0, block - 1)])
    steps = F.explode(F.array(*[F.struct(*[F.lit(d).alias(a) for a, d in zip(axes, o, strict=True)]) for o in offsets]))
    border = parts.where(at_border).withColumn("label", least)
    across = border.withColumn("s", steps).select(*keys, *[(F.col(a) + F.col(f"s.{a}")).alias(a) for a in axes], F.col("label").alias("a"))
    links = cut(across.join(border.select(*names, F.col("label").alias("b")), names).where("a <> b").select("a", "b").distinct(), "region-links")
    if not links.limit(1).count():
        return parts.select(*names, named.alias("label"))
    found = _spread(links)
    merged = parts.withColumn("label", least).join(found, "label", "left").withColumn("label", F.coalesce("root", "label"))
    return merged.select(*names, F.concat_ws("_", *[F.col(f"label.{n}").cast("string") for n in [*keys, *[f"l_{a}" for a in axes]]]).alias("label"))


def _local_labels(names: Sequence[str], axes: Sequence[str], offsets: Sequence[tuple[int, ...]]):
    """A function that labels the cells of one block with their region's least cell."""
    import numpy as np
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        at = np.stack([table[a].to_numpy().astype(np.int64) for a in axes], axis=1)
        low = at.min(axis=0) - 1
        span = at.max(axis=0) - low + 2
        flat = np.zeros(len(at), np.int64)
        for k in range(len(axes)):
            flat = flat * span[k] + at[:, k] - low[k]
        order = np.argsort(flat)
        sorted_flat = flat[order]
        pairs = []
        for o in offsets:
            step = 0
            for k, d in enumerate(o):
                step = step * int(span[k]) + d
            if step > 0:
                where = np.searchsorted(sorted_flat, sorted_flat + step)
                hit = np.flatnonzero(sorted_flat[np.minimum(where, len(where) - 1)] == sorted_flat + step)
                pairs.append(np.stack([hit, where[hit]]))
        label = np.arange(len(at))
        u, v = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        while len(u):
            before = label.copy()
            m = np.minimum(label[u], label[v])
            for side in (u, v):
                np.minimum.at(label, label[side], m)
                np.minimum.at(label, side, m)
            label = label[label]
            if (label == before).all():
                break
        least = at[order][label]
        columns = {n: table[n].take(pa.array(order)) for n in names}
        columns |= {f"l_{a}": pa.array(least[:, k].astype(np.int32)) for k, a in enumerate(axes)}
        return pa.table(columns)

    return run


def _spread(links: DataFrame) -> DataFrame:
    """label, root: the least label of each component of symmetric links (a, b)."""
    state = cut(links.groupBy(F.col("a").alias("label")).agg(F.min("b").alias("b")).select("label", F.least("label", "b").alias("root")), "region-roots")
    while True:
        near = links.join(state.select(F.col("label").alias("b"), "root"), "b").groupBy(F.col("a").alias("label")).agg(F.min("root").alias("near"))
        taken = state.join(near, "label").select("label", "root", F.least("root", "near").alias("now"))
        up = state.select(F.col("label").alias("now"), F.col("root").alias("up"))
        after = cut(taken.join(up, "now", "left").select("label", "root", F.least("now", F.coalesce("up", "now")).alias("now")), "region-roots")
        changed = after.where("root <> now").limit(1).count()
        state = after.select("label", F.col("now").alias("root"))
        if not changed:
            return state


def expand_water(add: DataFrame, water: DataFrame) -> DataFrame:
    """water with the regions of add that lie both inside and outside it."""
    marked = label(add).join(water.select("row", "col").distinct().withColumn("wet", F.lit(True)), ["row", "col"], "left")
    both = marked.groupBy("label").agg(F.count("wet").alias("w"), F.count(F.lit(1)).alias("n")).where("w > 0 and w < n").select("label")
    return water.select("row", "col").union(marked.join(both, "label", "left_semi").select("row", "col")).distinct()


def outlines(regions: DataFrame, xmin: float, ymax: float, cell: float) -> DataFrame:
    """Boundary edges of labelled cells (label, x1, y1, x2, y2), with the region on their left.

    Each cell gives its four edges, directed; those whose reverse another cell of the region gives are inside.
    """
    corners = [(0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)]  # row, col of start and end, clockwise in rows and columns
    edges = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("r1", "c1", "r2", "c2"), e, strict=True)]) for e in corners]))
    e = regions.select("label", "row", "col", edges.alias("e")).select("label", *[(F.col(a) + F.col(f"e.{n}")).alias(n) for a, n in (("row", "r1"), ("col", "c1"), ("row", "r2"), ("col", "c2"))])
    forward = F.struct("r1", "c1") < F.struct("r2", "c2")
    ends = e.withColumns({"lo": F.least(F.struct("r1", "c1"), F.struct(F.col("r2").alias("r1"), F.col("c2").alias("c1"))), "hi": F.greatest(F.struct("r1", "c1"), F.struct(F.col("r2").alias("r1"), F.col("c2").alias("c1"))), "forward": forward})
    single = ends.groupBy("label", "lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.first("forward").alias("f")).where("n = 1")
    a, b = F.when(F.col("f"), F.col("lo")).otherwise(F.col("hi")), F.when(F.col("f"), F.col("hi")).otherwise(F.col("lo"))
    x = lambda p: xmin + p["c1"] * cell
    y = lambda p: ymax - p["r1"] * cell
    return single.select("label", x(a).alias("x1"), y(a).alias("y1"), x(b).alias("x2"), y(b).alias("y2"))


def region_polygons(edges: DataFrame) -> DataFrame:
    """Polygons (label, wkt, area) from outlines. A region's edges meet in one task; its area is a sum beforehand."""
    import pyarrow as pa

    schema = pa.schema([("label", pa.string()), ("wkt", pa.string()), ("area", pa.float64())])

    def chain(table: pa.Table) -> pa.Table:
        follows: dict[tuple, list[tuple]] = {}
        for x1, y1, x2, y2 in zip(*(table[c].to_pylist() for c in ("x1", "y1", "x2", "y2")), strict=True):
            follows.setdefault((x1, y1), []).append((x2, y2))
        rings, area = [], 0.0
        while follows:
            start = min(follows)
            ring, at = [start], start
            while True:
                options = follows[at]
                came = (at[0] - ring[-2][0], at[1] - ring[-2][1]) if len(ring) > 1 else None
                pick = 0
                if came and len(options) > 1:  # where two rings touch, turn off so that they stay apart
                    pick = max(range(len(options)), key=lambda k: came[0] * (options[k][1] - at[1]) - came[1] * (options[k][0] - at[0]))
                to = options.pop(pick)
                if not options:
                    del follows[at]
                ring.append(to)
                at = to
                if at == start:
                    break
            area += sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2
            straight = [p for k, p in enumerate(ring[:-1]) if (p[0] - ring[k - 1 if k else -2][0]) * (ring[k + 1][1] - p[1]) != (p[1] - ring[k - 1 if k else -2][1]) * (ring[k + 1][0] - p[0])]
            rings.append((abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False))), straight + straight[:1]))
        rings.sort(key=lambda r: -r[0])
        text = ",".join("(" + ",".join(f"{x:.2f} {y:.2f}" for x, y in r) + ")" for _, r in rings)
        return pa.Table.from_pydict({"label": [table["label"][0].as_py()], "wkt": [f"POLYGON({text})"], "area": [abs(area)]}, schema=schema)

    return edges.groupBy("label").applyInArrow(chain, "label string, wkt string, area double")
