"""Mix sources to target weights: repetition rates from aggregated sizes, whole copies and one seeded draw.

Nulls and odd input: a null text has size 0; a null source is a source of its own, last in order; a null doc_id draws as
empty text. Rows that repeat a doc_id of one source share its draw. A source without words gets target 0 and no copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checked_broadcast, stage
from .text import name, unit_draw, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def _ranked(by_source: DataFrame) -> DataFrame:
    """Rank from 0 in code point order, null last. Ranges are ranked apart and shifted by the counts of those before."""
    ranges = by_source.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id())
    ranges = stage(ranges, "sources")
    before, shift = 0, []
    for part, n in sorted((r["part"], r["n"]) for r in ranges.groupBy("part").agg(F.count("*").alias("n")).collect()):
        shift.append((part, before))  # one entry for each partition, not for each source
        before += n
    offsets = by_source.sparkSession.createDataFrame(shift, "part int, before long")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source")))
    return ranges.join(F.broadcast(offsets), "part").select(
        "source", "source_size", (F.col("before") + inside - 1).alias("rank")
    )


def source_targets(
    by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size) -> with target (double): ``share`` of all sizes, dealt by repeating ``weights``; a target
    stops at ``most`` times its source's size and the excess goes to the others by weight, until none is above."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stage(
        _ranked(by_source).select(
            "source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("cap")
        ),
        "weighted",
    )
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:  # sources that are full only grow in number; each round is one small aggregate
        above = F.col("cap") <= F.col("weight") * F.lit(level)
        n, capped, open_weight = table.agg(
            F.sum(above.cast("long")), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n is None or n == full or not open_weight:
            break
        full, level = n, (total - (capped or 0)) / open_weight
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def copies(rate: Column, seed: str, doc_id: Column) -> Column:
    """floor(rate) and one more with the probability of the fraction."""
    whole = F.floor(rate)
    return (whole + (unit_draw(seed, doc_id) < rate - whole).cast("long")).cast("long")


def _with_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    there = checked_broadcast(targets.withColumnRenamed("source", "of"))
    joined = rows.join(there, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return joined.withColumn("rate", rate)


def mix_sizes(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", **how
) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, rate, copies, taken."""
    sizes = stage(
        docs.select(name(id_column).alias("doc_id"), name(source).alias("source"), word_count(name(text)).alias("size")),
        "sizes",
    )
    targets = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), **how)
    return (
        _with_targets(sizes, targets)
        .withColumn("copies", copies(F.col("rate"), seed, F.col("doc_id")))
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", **how) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    sizes = docs.select(name(source).alias("source"), word_count(name(text)).alias("size"))
    targets = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), **how)
    rows = docs.select(
        F.struct(*map(name, docs.columns)).alias("row"), name(source).alias("source"), name(id_column).alias("doc_id")
    )
    n = copies(F.col("rate"), seed, F.col("doc_id")).cast("int")
    taken = _with_targets(rows, targets).withColumn("copies", n).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
