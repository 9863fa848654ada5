"""Aggregates over keys, bands, trees and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.storage import cut_lineage


def weighted_mean(df: DataFrame, inner: list[str], outer: list[str], value: str) -> DataFrame:
    """The mean of ``value`` per ``outer``, rolled up from means per ``inner`` by their number of rows."""
    low = df.filter(F.col(value).isNotNull()).groupBy(*outer, *inner).agg(F.avg(value).alias("_m"), F.count("*").alias("_n"))
    return low.groupBy(*outer).agg((F.sum(F.col("_m") * F.col("_n")) / F.sum("_n")).alias("mean"), F.sum("_n").alias("n"))


def argmax(df: DataFrame, keys: list[str], value: str, score: Column, tie: Column) -> DataFrame:
    """Per key the ``value`` of the highest score, of ties the one of the smallest ``tie``; null scores don't count."""
    order = F.struct(score.alias("s"), (-tie).alias("t"))
    best = F.max(F.when(score.isNotNull(), F.struct(order.alias("o"), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.v").alias(value), F.col("_b.o.s").alias("score"))


def last_non_empty(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Per key the last value in order that isn't null or empty."""
    packed = F.when(F.col(value) != "", F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    return df.groupBy(*keys).agg(F.max(packed).alias("_l")).select(*keys, F.col("_l.v").alias(value))


def rate_per_key(df: DataFrame, keys: list[str], hit: Column, *, least: int = 5) -> DataFrame:
    """Rows, hits and, from ``least`` rows on, their ratio to four places."""
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
    return out.withColumn("rate", F.when(F.col("n") >= least, F.round(F.col("hits") / F.col("n"), 4)))


def coverage(df: DataFrame, band: str, level: str, levels: list[str], fields: list[str]) -> DataFrame:
    """Per band the number of rows of each level and of rows that have each field."""
    counts = [F.count_if(F.col(level) == v).alias(f"n_{v}") for v in levels] + [F.count_if(F.trim(F.col(f).cast("string")) != "").alias(f"has_{f}") for f in fields]
    return df.groupBy(band).agg(F.count("*").alias("n"), *counts)


def tree_closure(tree: DataFrame, *, node: str, parent: str, most_rounds: int = 32) -> DataFrame:
    """(ancestor, node) for every node and all above it, itself included. A node whose parent is missing is a root.

    Each round doubles the steps that are known, so their number is the logarithm of the tree's depth; a circle raises.
    """
    tree = tree.select(F.col(node).alias("_n"), F.col(parent).alias("_p"))
    jump = cut_lineage(tree.join(tree.select(F.col("_n").alias("_p")), "_p", "left_semi").select(F.col("_n").alias("ancestor"), F.col("_p").alias("_up")))
    nodes = closure = tree.select(F.col("_n").alias("ancestor"), F.col("_n").alias("node"))
    count = None
    for done in range(most_rounds):
        if jump.isEmpty():
            return closure
        count = nodes.count() if count is None and done > 4 else count
        if count is not None and 2**done > count:
            break
        closure = cut_lineage(closure.union(closure.join(jump, "ancestor").select(F.col("_up").alias("ancestor"), "node")))
        further = jump.select(F.col("ancestor").alias("_up"), F.col("_up").alias("_further"))
        jump = cut_lineage(jump.join(further, "_up").select("ancestor", F.col("_further").alias("_up")))
    raise ValueError("the tree goes in a circle")


def rolled_up(tree: DataFrame, values: DataFrame, *, node: str, parent: str, value: str) -> DataFrame:
    """Per node its own sum and that of itself and all below."""
    own = values.groupBy(node).agg(F.sum(value).alias("own"))
    closure = tree_closure(tree, node=node, parent=parent)
    total = closure.join(own, closure["node"] == own[node]).groupBy("ancestor").agg(F.sum("own").alias("total"))
    out = tree.select(node).join(own, node, "left").join(total.withColumnRenamed("ancestor", node), node, "left")
    return out.na.fill(0, ["own", "total"])


def trend(df: DataFrame, keys: list[str], *, day: str, amount: str) -> DataFrame:
    """Sums before and from the middle of the days that occur, in the last third of them, and late / early (omitted for early = 0).

    The days are learned from the data: the middle is the n // 2-th of n distinct days, the last third starts at the
    (n - n // 3)-th. Only the distinct days are ordered, and of these two are taken.
    """
    days = df.select(day).filter(F.col(day).isNotNull()).distinct()
    n = days.count()
    if not n:
        return df.groupBy(*keys).agg(*[F.lit(0).cast("double").alias(c) for c in ("early", "late", "recent")]).withColumn("trend", F.lit(None).cast("double"))
    ordered = [r[0] for r in days.orderBy(day).collect()]  # one per calendar day
    middle, recent = F.lit(ordered[n // 2]), F.lit(ordered[min(n - 1, max(0, n - n // 3))])
    out = df.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col(day) < middle, F.col(amount))), F.lit(0)).alias("early"),
        F.coalesce(F.sum(F.when(F.col(day) >= middle, F.col(amount))), F.lit(0)).alias("late"),
        F.coalesce(F.sum(F.when(F.col(day) >= recent, F.col(amount))), F.lit(0)).alias("recent"),
    )
    return out.withColumn("trend", F.when(F.col("early") > 0, F.col("late") / F.col("early")))


def first_last_delta(df: DataFrame, keys: list[str], *, at: str, value: str, tie: str) -> DataFrame:
    """Per key the first and last value by moment (then ``tie``), their number, and the difference of at least two."""
    point = F.struct(F.col(at).alias("a"), F.col(tie).alias("t"), F.col(value).alias("v"))
    rows = df.filter(F.col(at).isNotNull() & F.col(value).isNotNull())
    out = rows.groupBy(*keys).agg(F.min(point).alias("_f"), F.max(point).alias("_l"), F.count("*").alias("n"))
    first, last = F.col("_f.v"), F.col("_l.v")
    return out.select(*keys, "n", first.alias("first_value"), last.alias("last_value"), F.when(F.col("n") > 1, last - first).alias("delta"))


def share_of_all(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key and their percentage of all rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100.0 * F.col("n") / F.greatest(F.lit(1), F.sum("n").over(Window.partitionBy())))


def breadth(df: DataFrame, key: str, kinds: dict[str, Column]) -> DataFrame:
    """Per key how many kinds of evidence at least one row has."""
    flags = df.groupBy(key).agg(*[F.max(F.coalesce(c, F.lit(False))).alias(k) for k, c in kinds.items()])
    total = sum((F.col(k).cast("int") for k in kinds), F.lit(0))
    return flags.select(key, total.alias("breadth"))


def graded(df: DataFrame, keys: list[str], value: str, grades: dict[str, str], lowest: str) -> DataFrame:
    """Per key all its values, sorted, each once, and the best grade of them ({value: grade}, first letters of the alphabet best)."""
    table = F.create_map(*[F.lit(x) for pair in grades.items() for x in pair])
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias("values"), F.min(F.coalesce(table[F.col(value)], F.lit(lowest))).alias("grade"))
