"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import quoted, stored, width

WEIGHTS = (3, 1, 2)  # by the place of a source in code-point order, repeating
SHARE = 1.5  # of all sizes
MOST = 2.0  # times its own size, at which a target stops
BROADCAST = 20_000  # sources whose targets are sent to all tasks
RANK_BITS = 16  # ranking values are counted in 2**16 classes before the one at the edge is ordered


def word_count(text: Column) -> Column:
    """Number of runs without the bytes 0x20 and 0x09 to 0x0D; null: 0."""
    return F.coalesce(F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long"), F.lit(0).cast("long"))


def _uniform(doc_id: Column, seed: str) -> Column:
    """In (0, 1), from the md5 of seed and id: reruns agree, and SQL elsewhere can repeat it."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**12))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From one row per source (source, source_size): source, source_size, target.

    Water filling: with sources in order of the level at which they reach their cap, the capped ones are the first k,
    for the least k at which the level of the rest stays under the next source's. A row per source is all it sorts.
    """
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("w", F.element_at(F.lit([float(w) for w in weights]), place + 1)).withColumn("cap", most * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    everyone = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_w = F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    total = share * F.sum("source_size").over(everyone)
    levels = weighted.withColumn("level", (total - capped) / open_w)
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    level = F.coalesce(F.first(fits, ignorenulls=True).over(everyone), F.max(F.col("cap") / F.col("w")).over(everyone))
    return levels.select("source", "source_size", F.least(F.col("cap"), level * F.col("w")).alias("target"))


def _attach(rows: DataFrame, small: DataFrame, n: int) -> DataFrame:
    """rows with the columns of small (one row for each source, n in all) beside their source's; a left join.

    Up to BROADCAST sources small is broadcast: its size is counted, not assumed. Beyond that it is repeated under a
    salt, so that a source with a third of the rows is joined in many tasks.
    """
    if n <= BROADCAST:
        return rows.join(F.broadcast(small), rows["source"].eqNullSafe(small["_source"]), "left").drop("_source")
    salts = width(rows.sparkSession)
    many = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("_row_salt", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(salts)).cast("int"))
    return rows.join(many, rows["source"].eqNullSafe(many["_source"]) & (rows["_row_salt"] == many["_salt"]), "left").drop("_source", "_salt", "_row_salt")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = "mix") -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, copies, taken, tie (a hash of the text).

    A source wants target / source_size copies of each document: the whole ones are certain; for the rest, documents are
    ranked by u/(1-u) divided by p/(1-p), with p the missing fraction, and taken from the least on until their
    words come nearest to what is missing. The rank is counted in classes, and only the class at the edge is
    ordered, so no source gathers in one task. Documents without words have size 0 and count as taken 0 times their
    size. Null sources are a source of their own, last in order; null ids are hashed as empty; rows that repeat an
    id rank alike and are told apart by their text.
    """
    size = word_count(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), F.xxhash64(text_col).alias("tie"))
    rows = stored(rows, "mix-sizes")
    targets = stored(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.select(F.col("source").alias("_source"), "source_size", "target", F.floor(ratio).alias("whole"), (ratio - F.floor(ratio)).alias("p"))
    n_sources = targets.count()
    joined = _attach(rows, plan, n_sources)
    u = _uniform(F.col("doc_id"), seed)
    odds = F.when(F.col("p") > 0, (u / (1 - u)) / (F.col("p") / (1 - F.col("p"))))
    ranked = joined.withColumn("rank", odds).withColumn("cls", F.floor(F.col("rank") / (1 + F.col("rank")) * (1 << RANK_BITS)).cast("int"))
    return _take(ranked, n_sources)


def _take(ranked: DataFrame, n_sources: int) -> DataFrame:
    """Adds copies and taken to ranked rows."""
    missing = F.col("target") - F.col("whole") * F.col("source_size")
    classes = ranked.where("cls is not null").groupBy("source", "cls").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("whole").alias("whole"), F.first("source_size").alias("source_size"))
    upto = Window.partitionBy("source").orderBy("cls")
    run = classes.withColumn("upto", F.sum("words").over(upto)).withColumn("before", F.col("upto") - F.col("words"))
    edge = run.where((F.col("before") <= missing) & (F.col("upto") > missing)).select(F.col("source").alias("_source"), F.col("cls").alias("edge"), (missing - F.col("before")).alias("room"))
    marked = _attach(ranked, edge, n_sources)
    inner = (F.col("cls") < F.col("edge")) | F.col("edge").isNull()
    at_edge = marked.where(F.col("cls") == F.col("edge"))
    order = Window.partitionBy("source", "cls").orderBy("rank", "doc_id", "tie")
    filled = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    nearest = (filled - F.col("size") / 2.0) <= F.col("room")
    done = at_edge.withColumn("extra", nearest.cast("int")).unionByName(
        marked.where(~F.coalesce(F.col("cls") == F.col("edge"), F.lit(False))).withColumn("extra", (F.col("cls").isNotNull() & inner).cast("int"))
    )
    copies = F.col("whole") + F.col("extra")
    return done.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "tie")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of docs, each as often as mix() takes it, with their columns."""
    plan = mix(docs, id_col, text_col, **options).where("copies > 0")
    plan = plan.groupBy(F.col("doc_id").alias("plan_id"), F.col("tie").alias("plan_tie")).agg(F.max("copies").alias("copies"))
    rows = docs.select(F.struct("*").alias("kept"), quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("tie"))  # their names may be any
    found = rows.join(plan, rows["id"].eqNullSafe(plan["plan_id"]) & (rows["tie"] == plan["plan_tie"]))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("kept.*")
