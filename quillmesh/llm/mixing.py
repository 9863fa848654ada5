"""Mixing sources to target weights, in an order that keeps the weights at every point.

Method: the documents of a source, in a fixed random order and as often as its share asks, are a stream of
tokens that is cut into blocks of whole documents. Pfair scheduling gives each block a release time and a
deadline from its source's weight: the places in the mix at which its first token may and its last token should
have come, if the source flowed evenly. Among the released blocks the one of the earliest deadline comes next.
Blocks have their real lengths, so after every document each source is less than one block - the largest of the
mix - away from the share it reaches in the end. A block is less than ``block_tokens`` and one document long.

Size. A source may hold any part of all rows: its running sums are taken in ranges of the order and the
ranges' sums put before them. Blocks grow with the corpus, so that there are never more than ``MOST_BLOCKS``
and one per source: only their lengths, their schedule and the sums per source of the target table reach the
driver, which raises where the target has more than ``MOST_SOURCES`` sources.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm.tokens import count_tokens
from quillmesh.storage import cut_lineage, pick

MOST_BLOCKS = 1 << 16
MOST_SOURCES = 4096
LEAST_BLOCK = 1024
#: Documents of a source whose running sum is taken in one window.
RANGE_ROWS = 10_000
SEED = 20_260_630


def schedule(blocks: dict[str, list[int]]) -> list[tuple[str, int]]:
    """The (source, block) of every slot, by earliest deadline first among the released; ``blocks`` has the lengths of each
    source's blocks in order.

    With weight w = length of a source / length of all, the block that spans the tokens a to b of its source is
    released at a / w and due at b / w; the time is the number of tokens in the slots so far. In exact fractions.
    """
    sums = {s: sum(lengths) for s, lengths in blocks.items() if sum(lengths) > 0}
    total = sum(sums.values())
    waiting = [(Fraction(0), s, 0, 0) for s in sorted(sums)]  # (release, source, block, tokens before it)
    heapq.heapify(waiting)
    ready: list[tuple[Fraction, str, int, int]] = []  # (deadline, source, block, tokens before it)
    slots, now = [], 0
    while waiting or ready:
        while waiting and waiting[0][0] <= now:
            _, s, j, before = heapq.heappop(waiting)
            heapq.heappush(ready, (Fraction((before + blocks[s][j]) * total, sums[s]), s, j, before))
        _, s, j, before = heapq.heappop(ready)  # some source is behind or just on its share, so one is always released
        slots.append((s, j))
        now += blocks[s][j]
        before += blocks[s][j]
        if j + 1 < len(blocks[s]):
            heapq.heappush(waiting, (Fraction(before * total, sums[s]), s, j + 1, before))
    return slots


def plan_quotas(targets: dict[str, tuple[float, int]], available: dict[str, int], total_tokens: int | None = None) -> dict[str, int]:
    """Tokens each source gives. ``targets``: share and most repeats; ``available``: tokens of one pass.

    Without ``total_tokens`` the mix is the largest in which every source that has any tokens reaches its share.
    With it, a source that can't reach its share gives all it may.
    """
    most = {s: available.get(s, 0) * repeats for s, (share, repeats) in targets.items() if share > 0}
    if total_tokens is None:
        total = min((m / targets[s][0] for s, m in most.items() if m > 0), default=0)
    else:
        total = total_tokens
    return {s: min(m, math.floor(targets[s][0] * total + 1e-6)) for s, m in most.items()}


class Mix:
    """``rows``: what is used, in order; ``shares``: what each source gave."""

    def __init__(self, rows: DataFrame, shares: DataFrame):
        self.rows, self.shares = rows, shares


def mix_sources(
    documents: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    total_tokens: int | None = None,
    vocabulary: str | None = None,
    seed: int = SEED,
) -> Mix:
    """Documents combined so that each source of ``target`` gives its target_share of all tokens.

    ``rows`` has slot (from 0), source, doc_id, pass (from 0), tokens and at (the place in its source's stream):
    one row per use of a document, to be read in the order of slot, then at; after each row every source is less
    than the largest block away from its actual share. A document belongs to the block that its first token falls
    into and isn't cut. ``shares`` has, for every source of ``target``, source, target_share, max_repeats,
    available_tokens, documents, uses, used_tokens, actual_share and outcome by the tokens used ("met": less than
    the source's longest document below its share of what is asked; else "short"; "absent": no tokens at all).

    No document is used more than max_repeats times (null: once; below 1: the source gives nothing). The order
    within a source is by a hash of the key, then by the key, the same on every run. Documents without tokens
    (null or empty text), without source, or of sources that the target lacks are not used. Shares are taken
    relative to their sum; null, NaN and negative ones are 0; of a repeated source the row of the largest share
    counts. Empty tables give no rows. Of further columns nothing is read.

    Runs jobs: counts the tokens of all documents and writes them to the checkpoint folder.
    """
    wanted = pick(target, source="source", share="target_share", repeats="max_repeats").filter("source is not null")
    shares: dict[str, tuple[float, int]] = {}
    listed = wanted.distinct().limit(MOST_SOURCES + 1).collect()
    if len(listed) > MOST_SOURCES:
        raise ValueError(f"the target has more than {MOST_SOURCES} different rows")
    for row in listed:
        share = row["share"] if row["share"] is not None and row["share"] > 0 else 0.0
        repeats = 1 if row["repeats"] is None else max(0, row["repeats"])
        shares[row["source"]] = max(shares.get(row["source"], (0.0, 0)), (share, repeats))
    whole = sum(share for share, _ in shares.values()) or 1.0
    shares = {s: (share / whole, repeats) for s, (share, repeats) in shares.items()}

    spark = documents.sparkSession
    named = pick(documents, key=key, source=source, text=text)
    sizes = cut_lineage(count_tokens(named.filter(F.col("source").isin(*shares)), text="text", keep=("key", "source"), vocabulary=vocabulary).filter("tokens > 0"))
    sums = sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"), F.max("tokens").alias("longest"))
    per_source = {r["source"]: (r["tokens"], r["n"], r["longest"]) for r in sums.collect()}  # sources of the target only
    quotas = plan_quotas(shares, {s: t for s, (t, _, _) in per_source.items()}, total_tokens)
    block = max(LEAST_BLOCK, -(-sum(quotas.values()) // MOST_BLOCKS))
    plan = [(s, share, repeats, *per_source.get(s, (0, 1, 0)), quotas.get(s, 0)) for s, (share, repeats) in sorted(shares.items())]
    plan_df = spark.createDataFrame(plan, "source string, target_share double, max_repeats int, available long, n long, longest long, quota long")

    # Running sums: within ranges of the hash, then the sums of the ranges before.
    sizes = sizes.join(F.broadcast(plan_df.filter("quota > 0")), "source")  # at most MOST_SOURCES rows
    order = F.shiftrightunsigned(F.xxhash64("key", F.lit(seed)), 11)  # 53 bits, exact as a double
    ranges = F.ceil(F.col("n") / RANGE_ROWS)
    sizes = sizes.withColumn("order", order).withColumn("range", F.least(F.floor(F.col("order") / F.lit(2.0**53) * ranges), ranges - 1).cast("long"))
    sums = sizes.groupBy("source", "range").agg(F.sum("tokens").alias("sum"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "range").orderBy("order", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("start", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(sums, ["source", "range"])
    start = F.col("base") + F.col("start")
    whole_passes = F.floor(F.col("quota") / F.col("available"))
    rest = F.col("quota") - whole_passes * F.col("available")
    uses = (whole_passes + F.when(start + F.col("tokens") <= rest, 1).otherwise(0)).cast("int")
    used = placed.select("source", "key", "tokens", "available", start.alias("start"), uses.alias("uses")).filter("uses > 0")
    used = used.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("uses") - 1)))
    used = used.withColumn("at", F.col("pass") * F.col("available") + F.col("start")).withColumn("block", F.floor(F.col("at") / block))

    used = cut_lineage(used.select("source", "block", "key", "pass", "tokens", "at"))

    lengths = used.groupBy("source", "block").agg(F.sum("tokens").alias("length"))
    numbers: dict[str, list[int]] = {}
    blocks: dict[str, list[int]] = {}
    for row in lengths.orderBy("source", "block").collect():  # at most MOST_BLOCKS rows and one more per source
        numbers.setdefault(row["source"], []).append(row["block"])
        blocks.setdefault(row["source"], []).append(row["length"])
    slots = [(s, numbers[s][j], slot) for slot, (s, j) in enumerate(schedule(blocks))]
    slots_df = spark.createDataFrame(slots, "source string, block long, slot long")
    rows = used.join(F.broadcast(slots_df), ["source", "block"])  # as many rows as there are blocks
    rows = rows.select("slot", "source", F.col("key").alias(key), "pass", "tokens", "at")

    given = used.groupBy("source").agg(F.sum("tokens").alias("used_tokens"), F.count("*").alias("uses"), F.sum(F.when(F.col("pass") == 0, 1)).alias("documents"))
    total = Window.partitionBy()
    report = plan_df.join(given, "source", "left").na.fill(0, ["used_tokens", "uses", "documents"])
    report = report.withColumn("actual_share", F.try_divide(F.col("used_tokens").cast("double"), F.sum("used_tokens").over(total)))
    nominal = max((q / shares[s][0] for s, q in quotas.items() if q), default=0.0) if total_tokens is None else float(total_tokens)
    outcome = F.when(F.col("available") * F.col("max_repeats") <= 0, "absent").when(F.col("used_tokens") + F.col("longest") > F.floor(F.col("target_share") * F.lit(nominal)), "met").otherwise("short")
    report = report.select(
        "source", "target_share", "max_repeats", F.col("available").alias("available_tokens"), "documents", "uses", "used_tokens", "actual_share", outcome.alias("outcome")
    )
    return Mix(rows, report)
