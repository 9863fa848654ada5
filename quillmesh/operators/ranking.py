"""Ranks, percentiles, winners, quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmesh.storage import broadcast_if_small, cut_lineage


def sums_before(df: DataFrame, within: list[str], order: str, values: list[str], *, prefix: str = "before_") -> DataFrame:
    """``df`` with, for each of ``values``, its sum over the rows of the group that come before by ``order`` (unique in a group).

    Groups may be of any size: rows are put into ranges of (group, order), summed per range, and each range is run through on
    its own, starting from the sums of its group's ranges before. Writes the ranges to the checkpoint folder.
    """
    ranged = cut_lineage(df.repartitionByRange(*within, order).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy(*within, "_range").agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are ranges
    base = sums.select(*[F.col(c).alias(f"_g_{c}") for c in within], F.col("_range").alias("_g_range"), *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_b_{v}") for v in values])
    on = ranged["_range"] == base["_g_range"]
    for c in within:
        on = on & ranged[c].eqNullSafe(base[f"_g_{c}"])
    joined = ranged.join(broadcast_if_small(base), on)
    inner = Window.partitionBy(*within, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.select(*df.columns, *[(F.col(f"_b_{v}") + F.coalesce(F.sum(v).over(inner), F.lit(0))).alias(f"{prefix}{v}") for v in values])


def tie_midpoint_percentile(df: DataFrame, within: list[str], score: str, *, name: str = "percentile") -> DataFrame:
    """0 to 100 within a group; equal scores share the middle of their places, a single row has 50. Null counts as 0.

    From counts per distinct score, so that a group with many ties sends few rows; the places are running sums of
    these counts, taken in ranges, so that a group may be of any size.
    """
    value = F.coalesce(F.col(score), F.lit(0)).cast("double") + F.lit(0.0)
    scored = df.withColumn("_s", value)
    counts = scored.groupBy(*within, "_s").agg(F.count("*").alias("_ties"))
    counts = sums_before(counts, within, "_s", ["_ties"])
    counts = counts.withColumnRenamed("before__ties", "_below").withColumn("_n", F.max(F.col("_below") + F.col("_ties")).over(Window.partitionBy(*within)))
    middle = (F.col("_below") + (F.col("_ties") - 1) / 2.0) / (F.col("_n") - 1) * 100.0
    counts = counts.select(*[F.col(c).alias(f"_k_{c}") for c in within], F.col("_s").alias("_k_s"), F.when(F.col("_n") > 1, middle).otherwise(50.0).alias(name))
    on = scored["_s"] == counts["_k_s"]
    for c in within:
        on = on & scored[c].eqNullSafe(counts[f"_k_{c}"])
    return scored.join(counts, on, "left").drop("_s", "_k_s", *[f"_k_{c}" for c in within])


def values_at(df: DataFrame, score: str, places: list[float]) -> list[float | None]:
    """Of the non-null scores in order, the one at index min(n - 1, floor(p n)) for each p; None if there are none.

    Exact and distributed: scores are put into ranges, the ranges are counted, and only those that hold a wanted
    index are read in order.
    """
    scores = df.select(F.col(score).cast("double").alias("s")).filter("s is not null and not isnan(s)")
    ranged = cut_lineage(scores.repartitionByRange("s").withColumn("part", F.spark_partition_id()))
    sizes = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return [None] * len(places)
    wanted: dict[int, tuple[int, int]] = {}
    for i, p in enumerate(places):
        index = min(total - 1, int(p * total))
        for part in sorted(sizes):
            if index < sizes[part]:
                wanted[i] = (part, index)
                break
            index -= sizes[part]
    parts = sorted({part for part, _ in wanted.values()})
    placed = ranged.filter(F.col("part").isin(parts)).withColumn("i", F.row_number().over(Window.partitionBy("part").orderBy("s")) - 1)
    hit = F.lit(False)
    for part, index in set(wanted.values()):
        hit = hit | ((F.col("part") == part) & (F.col("i") == index))
    found = {(r["part"], r["i"]): r["s"] for r in placed.filter(hit).collect()}
    return [found[wanted[i]] for i in range(len(places))]


def tiers(df: DataFrame, score: str, counted: Column, levels: list[tuple[str, float, float]], lowest: str) -> DataFrame:
    """``df`` with a tier from the distribution of the scores of ``counted`` rows.

    ``levels`` are (name, place, floor) from high to low: a cut is the score at the place but not under the floor, and
    always under the cut before. Rows that aren't counted, or under all cuts, have the ``lowest`` tier.
    """
    at = values_at(df.filter(counted), score, [place for _, place, _ in levels])
    out, last = F.when(~F.coalesce(counted, F.lit(False)), lowest), None
    for (name, _, floor), value in zip(levels, at):
        cut = max(floor, value or 0.0)
        cut = cut if last is None else min(cut, last - 0.01)
        out, last = out.when(F.col(score) >= cut, name), cut
    return df.withColumn("tier", out.otherwise(lowest))


def ranked(df: DataFrame, within: list[str], order: list[Column], *, top: int, name: str = "rank") -> DataFrame:
    """Rows of dense rank up to ``top``; the optimizer limits groups before and after the shuffle."""
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(*within).orderBy(*order))).filter(F.col(name) <= top)


def winners(df: DataFrame, within: list[str], *, rank: str, score: str, gap: float = 0.08, share: float = 0.55, most: int = 3) -> DataFrame:
    """``df`` with is_winner: rank 1; and ranks up to ``most`` if the second is within ``gap`` of the first and their score at
    least ``share`` of it."""
    w = Window.partitionBy(*within).orderBy(rank).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, second = F.first_value(score).over(w), F.nth_value(score, 2).over(w)
    near = (first - second <= gap) & (F.col(score) >= share * first) & (F.col(rank) <= most)
    return df.withColumn("is_winner", F.when(F.col(rank) == 1, 1).when(F.coalesce(near, F.lit(False)), 1).otherwise(0))


def top_per_group(df: DataFrame, within: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group with their place."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).filter(F.col("place") <= k)


def stratified(df: DataFrame, band: str, bands: list[str], order: list[Column], limit: int) -> DataFrame:
    """At most ceil(limit / bands) rows of each band, bands in order, ``limit`` in all: a sampling operator."""
    each = -(-limit // len(bands))
    ordinal = F.array_position(F.array(*[F.lit(b) for b in bands]), F.col(band))
    picked = top_per_group(df.filter(ordinal > 0).withColumn("_band", ordinal), [band], order, each)
    return picked.orderBy("_band", "place").limit(limit).drop("_band")


def demote_copies(df: DataFrame, keys: list[str], order: list[Column], column: str) -> DataFrame:
    """``df`` with ``column`` 0 in all rows of a key but the first."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(column, F.when(place > 1, F.lit(0)).otherwise(F.col(column)))


def packed_in_order(df: DataFrame, within: list[str], order: list[Column], size: str, most: int) -> DataFrame:
    """``df`` with the number of the asset a row goes into: a new one starts as soon as ``most`` would be exceeded.

    Greedy in order, so exact only in sequence; the sequence is per group. A row above ``most`` has an asset of its own.
    """
    w = Window.partitionBy(*within).orderBy(*order)
    rows = df.withColumn("_i", F.row_number().over(w))
    schema = T.StructType([*rows.schema.fields, T.StructField("asset", T.IntegerType()), T.StructField("offset", T.LongType())])

    def pack(pdf):
        pdf = pdf.sort_values("_i")
        asset, used, assets, offsets = 0, 0, [], []
        for n in pdf[size]:
            if used and used + n > most:
                asset, used = asset + 1, 0
            assets.append(asset)
            offsets.append(used)
            used += n
        return pdf.assign(asset=assets, offset=offsets)

    return rows.groupBy(*within).applyInPandas(pack, schema).drop("_i")
