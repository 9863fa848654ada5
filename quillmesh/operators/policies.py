"""What a write does with rows that exist: each operator returns the new table and a summary, and writes nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key by ``order``; rank filters are pushed below the shuffle by the optimizer."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).filter("_place = 1").drop("_place")


def keep_first(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of ``old``, and the first of ``new`` for each key that ``old`` lacks."""
    fresh = one_per_key(new, keys, order).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def keep_last(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first of ``new`` by ``order`` for each key, and the rows of ``old`` with other keys."""
    fresh = one_per_key(new, keys, order)
    return old.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh.select(*old.columns))


def fill(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], *, prefer: str = "old") -> DataFrame:
    """``old`` with ``columns`` taken from ``new``: only where null (prefer="old") or wherever new has one (prefer="new")."""
    values = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])

    def value(c: str) -> Column:
        return F.coalesce(c, f"_new_{c}") if prefer == "old" else F.coalesce(f"_new_{c}", c)

    joined = old.join(values, keys, "left")
    return joined.select(*[value(c).alias(c) if c in columns else F.col(c) for c in old.columns])


def rebuild_keeping(rebuilt: DataFrame, before: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """A table computed anew with the columns ``kept`` of its former rows."""
    return rebuilt.drop(*kept).join(before.select(*keys, *kept), keys, "left")


def move_links(links: DataFrame, moves: DataFrame, *, member: str, target: str, unique: list[str]) -> DataFrame:
    """Links of a member that was moved go to its target; those that the target has already stay where they were.

    ``moves`` has ``member`` and ``target``. Of two moved links that meet, the one of the smaller member moves.
    """
    others = [c for c in unique if c != member]
    marked = links.join(moves.select(member, F.col(target).alias("_to")), member, "left")
    marked = marked.withColumn("_goal", F.coalesce("_to", member))
    w = Window.partitionBy("_goal", *others).orderBy(F.col("_to").isNotNull(), member)
    placed = marked.withColumn("_place", F.row_number().over(w))
    return placed.select(*[F.when(F.col("_place") == 1, F.col("_goal")).otherwise(F.col(member)).alias(member) if c == member else F.col(c) for c in links.columns])


def summary(counts: dict[str, DataFrame]) -> DataFrame:
    """One row per named table with its number of rows."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("what"), "rows") for name, df in counts.items()]
    return reduce(DataFrame.unionByName, parts)


def ensure_columns(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with typed nulls for the columns of ``schema`` that it lacks."""
    wanted = df.sparkSession.createDataFrame([], schema).schema
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in wanted if f.name not in df.columns]
    return df.select("*", *missing)


def unpivoted(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every further column as a row (keys, field, value as string), nulls left out: nothing of a source is lost."""
    fields = [c for c in df.columns if c not in keys]
    text = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in fields])
    return text.unpivot(keys, fields, "field", "value").filter("value is not null")
