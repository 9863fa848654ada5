"""Expectations: each gives one row per violated rule, with the number of rows that violate it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows for which a rule is false or unknown, counted per rule in one pass: rule, rows."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(r) for r, c in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("rows")) for r in rules])).alias("x")).select("x.*").filter("rows > 0")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(df: DataFrame, parents: DataFrame, column: str, parent: str) -> DataFrame:
    """Rows whose non-null ``column`` isn't a ``parent``."""
    return df.filter(F.col(column).isNotNull()).join(parents.select(F.col(parent).alias(column)).distinct(), column, "left_anti")


def totals_agree(parts: DataFrame, part: str, wholes: DataFrame, whole: str, keys: list[str]) -> DataFrame:
    """Keys where the sum of the parts differs from the stated whole."""
    sums = parts.groupBy(*keys).agg(F.sum(part).alias("parts"))
    return wholes.join(sums, keys, "left").filter(F.coalesce("parts", F.lit(0)) != F.coalesce(whole, F.lit(0)))


def leaks(df: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """Rows whose text matches a pattern that mustn't be published, with the pattern's name."""
    parts = [df.filter(F.col(column).rlike(p)).withColumn("leak", F.lit(n)) for n, p in patterns.items()]
    return reduce(DataFrame.unionByName, parts)


def name_collisions(df: DataFrame, names: list[str], flag: str, name: str) -> DataFrame:
    """Negative control: named rows that mustn't carry the flag but do."""
    return df.filter(F.col(name).isin(*names) & (F.col(flag) == 1))
