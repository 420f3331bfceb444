"""Mix sources to target weights: whole copies, and one seeded draw for the fraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daytally.llm.common import WORD, packed, text_or_empty, unit, unpacked, written

SEED = 20240601
#: A source's target ends at so many times its size.
MOST = 3
#: Weights by place of the source's name, repeating.
WEIGHTS = (1, 2, 3)


def n_words(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``place``, each row's number from 0 in the given order, by a range
    shuffle and the sizes of its parts: no task sees all rows."""
    parts = written(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranked")
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # a row for each partition
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return parts.withColumn("within", within).join(sizes, "part").withColumn("place", F.col("before") + F.col("within")).drop("part", "within", "before")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, size) with ``weight`` and ``target``.

    All targets together are the size of all sources, shared by weight; a source's target
    ends at MOST times its size, and what is over is shared among the others by weight,
    until none is over. Each round closes the sources that are over; rounds end when there
    are none, and only sums reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    weighed = written(ranked(sizes, F.col("source").asc_nulls_last()).withColumn("weight", weight.cast("long")), "sources")
    none = F.lit(0).cast("long")
    sums = [F.coalesce(F.sum(c), none) for c in ("size", "weight")]
    total, shares = weighed.agg(*sums).first()
    left, open_shares = total, shares
    while True:
        exact = lambda x: F.lit(x).cast("decimal(19,0)")
        over = F.col("size") * exact(MOST * open_shares) < exact(left) * F.col("weight")
        size_over, weight_over = weighed.filter(over).agg(*sums).first()
        found = total - MOST * size_over, shares - weight_over
        if found == (left, open_shares):
            break
        left, open_shares = found
    share = F.lit(left) * F.col("weight") / F.lit(max(1, open_shares))
    return weighed.withColumn("target", F.when(over, (F.col("size") * MOST).cast("double")).otherwise(share))


def plan(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, rate, copies and taken.

    ``size`` is the number of words, 0 for null or empty texts; rate is target by size of
    the source. A row is taken floor(rate) times, and once more if the number drawn from
    its key lies below the fraction: rows with equal keys get equal draws, and a run
    again the same ones. A null source is one source, the last by name. A text of any length
    counts whole; repeated rows and ties are rows of their own with equal draws. An empty table
    gives an empty result. Columns of the input with these names are replaced.
    """
    rows = packed(docs, source=F.col(source), key=F.col(key), size=n_words(text))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"))
    goal = written(targets(sizes).select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    drawn = (unit(F.col("key"), seed) < F.col("rate") - F.floor("rate")).cast("long")
    out = (
        rows.join(goal, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rate", rate)
        .withColumn("copies", F.floor("rate").cast("long") + drawn)
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
    return unpacked(out, "size", "source_size", "target", "rate", "copies", "taken")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The mixed rows, each as often as :func:`plan` takes it, with the input's columns.

    Null and empty texts have no words but copies as their source's rate has it; texts of any
    length stay whole; null keys share one draw, as repeated rows do; extra columns pass; an
    empty table gives an empty result.
    """
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("all"), F.col(text).alias("t"), F.col(source).alias("s"), F.col(key).alias("k"))
    taken = plan(whole, "t", "s", "k", seed).filter("copies > 0")
    return taken.select("all", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("all.*")
