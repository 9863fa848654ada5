"""Set operations on vocabularies, queues and candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bridge(topics: DataFrame, schemes: tuple[str, str], *, person: str, topic: str, scheme: str, stop: list[str], most_share: float) -> DataFrame:
    """(person, term) for the terms that both vocabularies have, compared without case.

    Terms of the stop list, and those that more than ``most_share`` of either side's people have, are left out. People of
    both sides are united. One pass over the topics: no scan per term.
    """
    rows = topics.filter(F.col(scheme).isin(*schemes)).select(F.col(person).alias("person"), F.lower(topic).alias("term"), F.col(scheme).alias("side"))
    rows = rows.filter("term is not null").distinct()
    population = {s: F.count_distinct(F.when(F.col("side") == s, F.col("person"))).alias(f"p{i}") for i, s in enumerate(schemes)}
    sizes = rows.agg(*population.values()).first()
    per = rows.groupBy("term").agg(*[F.count_if(F.col("side") == s).alias(f"n{i}") for i, s in enumerate(schemes)])
    kept = per.filter("n0 > 0 and n1 > 0 and not (" + " or ".join(f"n{i} > {most_share * (sizes[i] or 0)}" for i in (0, 1)) + ")")
    kept = kept.filter(~F.col("term").isin(*stop)) if stop else kept
    return rows.join(kept.select("term"), "term").select("person", "term").distinct()


def queue(branches: list[tuple[str, int, DataFrame]], key: str, *, highest_only: bool = False) -> DataFrame:
    """Rows of several branches (reason, tier, table) as (key, reason, tier): each reason once, or only the highest tier."""
    parts = [df.select(F.col(key), F.lit(reason).alias("reason"), F.lit(tier).alias("tier")) for reason, tier, df in branches]
    united = reduce(DataFrame.unionByName, parts).distinct()
    if not highest_only:
        return united
    w = Window.partitionBy(key).orderBy(F.desc("tier"), "reason")
    return united.withColumn("_p", F.row_number().over(w)).filter("_p = 1").drop("_p")


def merge_candidates(df: DataFrame, *, key: str, lists: list[str], scalars: list[str], order: str) -> DataFrame:
    """One row per key: lists united and sorted, scalars of the latest row by ``order``."""
    latest = F.max_by(F.struct(*scalars), F.col(order)).alias("_l")
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast(df.schema[c].dataType)))))).alias(c) for c in lists]
    return df.groupBy(key).agg(latest, *united).select(key, "_l.*", *lists)


def missing_from(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys ``done`` lacks; null keys are never done."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")
