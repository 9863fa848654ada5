"""Items that appear together: pairs of items counted over baskets, and how far beyond chance.

Method: stripes. A task turns the baskets it holds into stripes - per item an array of neighbours with
counts, combined within the task - and the stripes of an item are merged by key. What is left is scored
by the log-likelihood ratio.

Size. An item's stripe is cut into shards by its number of baskets, so that no merge grows with an item's
popularity. A basket is cut into blocks of members, and block meets block. A pair that must stand together
``t`` times can miss at most ``t - 1`` of an item's baskets, so of the very large baskets that hold an item
the ``t - 1`` largest are left out of the stripes of this item (prefix filter) and looked up afterwards,
exactly, for the few pairs that can still reach ``t``. A basket with a third of all rows is thus never
paired with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.storage import blank_to_null, cut_lineage, pick

#: Members of a basket that meet in one step; pairs held by a task before it writes them; an item's baskets per shard.
BLOCK = 512
BUFFER = 2_000_000
BASKETS_PER_SHARD = 256
#: From this many members on a basket is left to the look-up where the prefix filter allows it.
LARGE_BASKET = 4096

STRIPES = "item long, shard long, spare int, neighbours array<long>, counts array<int>"


def _combine(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums ``n`` over equal pairs; the result is sorted by a, then b."""
    ids, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    key, where = np.unique(codes[: len(a)] * len(ids) + codes[len(a) :], return_inverse=True)
    return ids[key // len(ids)], ids[key % len(ids)], np.bincount(where, weights=n).astype(np.int64)


def _make_stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    baskets: dict[int, tuple[int, int]] = {}  # of the items held: their baskets and spare

    def write() -> Iterator[pa.RecordBatch]:
        a, b, n = _combine(*(np.concatenate(x) for x in zip(*held)))
        ids, codes = np.unique(a, return_inverse=True)
        known = np.array([baskets[x] for x in ids.tolist()], dtype=np.int64).reshape(-1, 2)
        shard = b % (1 + known[codes, 0] // BASKETS_PER_SHARD)
        order = np.lexsort((b, shard, a))
        a, b, n, shard, codes = a[order], b[order], n[order], shard[order], codes[order]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (shard[1:] != shard[:-1])])
        for at in range(0, len(first), 4096):
            rows = first[at : at + 4096]
            end = first[at + 4096] if at + 4096 < len(first) else len(a)
            offsets = pa.array(np.r_[rows, end] - rows[0], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(a[rows]),
                    pa.array(shard[rows]),
                    pa.array(known[codes[rows], 1].astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(b[rows[0] : end])),
                    pa.ListArray.from_arrays(offsets, pa.array(n[rows[0] : end].astype(np.int32))),
                ],
                names=["item", "shard", "spare", "neighbours", "counts"],
            )

    for batch in batches:
        low, high = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        members = batch.column(2)
        offsets = members.offsets.to_numpy()
        values = members.flatten()
        start = offsets[0]
        block, item, n, spare = (values.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        for r in range(batch.num_rows):
            at = slice(offsets[r] - start, offsets[r + 1] - start)
            ids, of = item[at], block[at]
            baskets.update(zip(ids.tolist(), zip(n[at].tolist(), spare[at].tolist())))
            if low[r] == high[r]:
                i, j = np.triu_indices(len(ids), 1)
                x, y = ids[i], ids[j]
            else:
                left, right = ids[of == low[r]], ids[of == high[r]]
                x, y = np.repeat(left, len(right)), np.tile(right, len(left))
            if len(x):
                held.append((np.minimum(x, y), np.maximum(x, y), np.ones(len(x), np.int64)))
                size += len(x)
            if size >= BUFFER:
                held = [_combine(*(np.concatenate(x) for x in zip(*held)))]
                size = len(held[0][0])
                if size >= BUFFER // 2:
                    yield from write()
                    held, size, baskets = [], 0, {}
    if held:
        yield from write()


def _merge_stripes(least: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, spare = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            lists = batch.column(2)
            lengths = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), lengths)
            b, n = lists.flatten().to_numpy(zero_copy_only=False), batch.column(3).flatten().to_numpy(zero_copy_only=False)
            order = np.lexsort((b, row))
            row, b, n = row[order], b[order], n[order]
            if not len(b):
                continue
            first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (b[1:] != b[:-1])])
            n = np.add.reduceat(n.astype(np.int64), first)
            row, b = row[first], b[first]
            keep = n >= least - spare[row]
            yield pa.RecordBatch.from_arrays([pa.array(item[row[keep]]), pa.array(b[keep]), pa.array(n[keep])], names=["a", "b", "n"])

    return merge


def _log_likelihood_ratio(both: Column, a: Column, b: Column, total: Column) -> Column:
    """Dunning's G2 of the two-by-two table of baskets with and without each item."""

    def part(observed: Column, row: Column, column: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed * total / (row * column))).otherwise(F.lit(0.0))

    cells = part(both, a, b) + part(a - both, a, total - b) + part(b - both, total - a, b)
    return F.lit(2.0) * (cells + part(total - a - b + both, total - a, total - b))


def items_together(
    df: DataFrame,
    *,
    basket: str,
    item: str,
    min_together: int = 6,
    min_lift: float = 4.1,
    min_llr: float = 3.84,
    large_basket: int = LARGE_BASKET,
) -> DataFrame:
    """Pairs of items that share at least ``min_together`` baskets, at least ``min_lift`` times chance.

    Columns: item_a < item_b (byte order), together, baskets_a, baskets_b, baskets, lift, llr.
    ``lift`` is together * baskets / (baskets_a * baskets_b); ``llr`` is the log-likelihood ratio, of which at
    least ``min_llr`` (3.84: five per cent) is asked.

    Rows without basket or item (null or blank) don't count. A pair of basket and item counts once, however
    often it is repeated. An empty table gives no rows. Of further columns nothing is read. Items and baskets
    are compared as they are: bring their names to one form before.

    Runs jobs: writes the distinct pairs and the items that can qualify to the checkpoint folder.
    """
    if min_together < 1 or min_lift < 0:
        raise ValueError("min_together must be at least 1 and min_lift not negative")
    rows = pick(df, basket=basket, item=item)
    rows = rows.select(blank_to_null(F.col("basket")).alias("basket"), blank_to_null(F.col("item")).alias("item"))
    # Filtered only once written: a filter before would be moved below the names, and compute them a second time.
    rows = cut_lineage(rows.distinct()).filter("basket is not null and item is not null")
    total = rows.select("basket").distinct().count()

    # An item in more than total / min_lift baskets can't reach the lift with any other.
    items = rows.groupBy("item").agg(F.count("*").alias("n")).filter((F.col("n") >= min_together) & (F.col("n") * min_lift <= total * (1 + 1e-12)))
    items = cut_lineage(items.withColumn("id", F.monotonically_increasing_id()))  # written with it: the same at every use
    members = cut_lineage(rows.join(items, "item").select("basket", "id", "n"))
    sizes = members.groupBy("basket").agg(F.count("*").alias("size"))
    large = sizes.filter(F.col("size") > BLOCK)

    skipped = None
    if min_together > 1 and sizes.filter(F.col("size") > large_basket).limit(1).count():
        of_large = members.join(sizes.filter(F.col("size") > large_basket), "basket")
        by_size = Window.partitionBy("id").orderBy(F.desc("size"), "basket")
        skipped = cut_lineage(of_large.withColumn("place", F.row_number().over(by_size)).filter(F.col("place") < min_together).select("basket", "id"))
        spare = skipped.groupBy("id").agg(F.count("*").cast("int").alias("spare"))
        members_in = members.join(skipped, ["basket", "id"], "left_anti").join(spare, "id", "left").na.fill(0, ["spare"])
    else:
        members_in = members.withColumn("spare", F.lit(0))

    blocks = members_in.join(large, "basket", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("int"))
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meets = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meets = meets.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    groups = meets.groupBy("basket", "low", "high").agg(F.collect_list(F.struct("block", "id", "n", "spare")).alias("members"))

    stripes = groups.select("low", "high", "members").mapInArrow(_make_stripes, STRIPES)
    merged = stripes.groupBy("item", "shard").agg(
        F.max("spare").alias("spare"), F.flatten(F.collect_list("neighbours")).alias("neighbours"), F.flatten(F.collect_list("counts")).alias("counts")
    )
    pairs = merged.select("item", "spare", "neighbours", "counts").mapInArrow(_merge_stripes(min_together), "a long, b long, n long")

    if skipped is not None:
        pairs = cut_lineage(pairs)
        of_a = pairs.join(skipped.withColumnRenamed("id", "a"), "a").join(members.select("basket", F.col("id").alias("b")), ["basket", "b"])
        of_b = pairs.join(skipped.withColumnRenamed("id", "b"), "b").join(members.select("basket", F.col("id").alias("a")), ["basket", "a"])
        more = of_a.select("a", "b", "basket").union(of_b.select("a", "b", "basket")).distinct().groupBy("a", "b").agg(F.count("*").alias("more"))
        pairs = pairs.join(more, ["a", "b"], "left").select("a", "b", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
        pairs = pairs.filter(F.col("n") >= min_together)

    def side(name: str) -> DataFrame:
        return items.select(F.col("id").alias(name), F.col("item").alias(f"item_{name}"), F.col("n").alias(f"baskets_{name}"))

    found = pairs.join(side("a"), "a").join(side("b"), "b")
    lift = (F.col("n") * F.lit(total)).cast("double") / (F.col("baskets_a") * F.col("baskets_b"))
    swap = F.col("item_a") > F.col("item_b")
    found = found.withColumn("lift", lift).filter(F.col("lift") >= min_lift)
    as_double = [F.col(c).cast("double") for c in ("n", "baskets_a", "baskets_b")]
    found = found.withColumn("llr", _log_likelihood_ratio(*as_double, F.lit(float(total)))).filter(F.col("llr") >= min_llr)
    return found.select(
        F.when(swap, F.col("item_b")).otherwise(F.col("item_a")).alias("item_a"),
        F.when(swap, F.col("item_a")).otherwise(F.col("item_b")).alias("item_b"),
        F.col("n").alias("together"),
        F.when(swap, F.col("baskets_b")).otherwise(F.col("baskets_a")).alias("baskets_a"),
        F.when(swap, F.col("baskets_a")).otherwise(F.col("baskets_b")).alias("baskets_b"),
        F.lit(total).cast("long").alias("baskets"),
        "lift",
        "llr",
    )
