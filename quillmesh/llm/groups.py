"""Consolidating pairwise matches into groups: one identifier for all that are linked, directly or not.

Method: the giant component is peeled first, by frontier breadth-first joins from the vertex of highest
degree, and anti-joined away; so the hub with its millions of links takes no part in the rounds that follow.
The remaining components are labelled by minimum propagation: each vertex takes the least of itself and its
neighbours, and the links are rewritten to these labels, until no link is left. "Least" is by a hash that
changes from round to round: a chain, however long and in whatever order its names run, then halves with
every round, so the rounds grow with the logarithm of the longest chain. The groups' identifiers, their
smallest vertices, are taken at the end. Only single rows and counts reach the driver, and every round is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.storage import cut_lineage, drop_table, pick

#: Breadth-first rounds before the rest of a component that is longer than wide is left to minimum propagation.
PEEL_ROUNDS = 8


def _undirected(links: DataFrame) -> DataFrame:
    """Columns low < high, each link once."""
    return links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).filter("low < high").distinct()


def _both_ways(links: DataFrame) -> DataFrame:
    there, back = F.struct(F.col("low").alias("src"), F.col("high").alias("dst")), F.struct(F.col("high").alias("src"), F.col("low").alias("dst"))
    return links.select(F.inline(F.array(there, back)))


def _peel(links: DataFrame) -> tuple[DataFrame, DataFrame, bool, Column] | None:
    """What was reached from the hub, the links that remain, whether none of them touch it, and the hub."""
    ways = _both_ways(links)
    hub = ways.groupBy("src").count().agg(F.min(F.struct((-F.col("count")).alias("n"), "src")).alias("h")).first()["h"]
    if hub is None:
        return None
    start = F.lit(hub["src"])
    frontier = cut_lineage(ways.filter(F.col("src") == start).select(F.col("dst").alias("id")))
    reached = cut_lineage(frontier.union(links.sparkSession.range(1).select(start.alias("id"))))
    closed = False
    for _ in range(PEEL_ROUNDS):
        seen = ways.join(frontier.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
        after = cut_lineage(seen.join(reached, "id", "left_anti"))
        drop_table(frontier)
        frontier = after
        if frontier.isEmpty():
            closed = True
            break
        reached = cut_lineage(reached.union(frontier))
    if closed:
        return reached, cut_lineage(links.join(reached.select(F.col("id").alias("low")), "low", "left_anti")), True, start
    # The rounds ran out: what was reached shrinks to the hub, from which the links to the rest then start.
    low = reached.select(F.col("id").alias("low"), F.lit(True).alias("low_in"))
    high = reached.select(F.col("id").alias("high"), F.lit(True).alias("high_in"))
    rest = links.join(low, "low", "left").join(high, "high", "left").filter("low_in is null or high_in is null")
    ends = [F.when(F.col(f"{x}_in"), start).otherwise(F.col(x)).alias(y) for x, y in (("low", "a"), ("high", "b"))]
    rest = cut_lineage(_undirected(rest.select(*ends)))
    # The last round may have reached the end of the component: then no link of the rest touches the hub.
    return reached, rest, rest.filter((F.col("low") == start) | (F.col("high") == start)).isEmpty(), start


def _propagate(links: DataFrame) -> DataFrame | None:
    """A representative for every vertex of ``links`` (columns vertex, label); None where there are no links."""
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        salt = F.lit(len(rounds))

        def ordered(name: str):
            return F.struct(F.xxhash64(F.col(name), salt).alias("order"), F.col(name).alias("id"))  # noqa: B023

        least = _both_ways(links).groupBy("src").agg(F.min(ordered("dst")).alias("other"))
        labels = cut_lineage(least.select(F.col("src").alias("vertex"), F.least(ordered("src"), "other")["id"].alias("label")))
        low = labels.select(F.col("vertex").alias("low"), F.col("label").alias("a"))
        high = labels.select(F.col("vertex").alias("high"), F.col("label").alias("b"))
        between = links.join(low, "low").join(high, "high").select("a", "b")
        # A label has a label of its own, which may be another: this link keeps the two together.
        chain = low.select(F.col("low").alias("x"), "a").join(labels.select(F.col("label").alias("x")).distinct(), "x").select(F.col("x").alias("b"), "a")
        after = cut_lineage(_undirected(between.unionByName(chain)))
        drop_table(links)
        links = after
        rounds.append(labels)
    final: DataFrame | None = None
    for labels in reversed(rounds):  # the labels of the later rounds, smaller each time, carried back to the earlier
        if final is not None:
            last = final.select(F.col("vertex").alias("label"), F.col("label").alias("last"))
            labels = labels.join(last, "label", "left").select("vertex", F.coalesce("last", "label").alias("label"))
        final = labels
    return final


def connected_groups(df: DataFrame, *, a: str, b: str) -> DataFrame:
    """Every vertex that is linked to another, with the smallest vertex it is linked to: vertex, group_id.

    ``df`` holds one link a row, in either order and as often as you like. Rows with a null end and links of a
    vertex to itself link nothing; an empty table gives no rows. "Smallest" is by the order of the column's
    type (byte order for strings). Of further columns nothing is read.

    Runs jobs: two tables a round, in the checkpoint folder.
    """
    links = cut_lineage(_undirected(pick(df, a=a, b=b).filter("a is not null and b is not null")))
    peeled = _peel(links)
    if peeled is None:
        return links.select(F.col("low").alias("vertex"), F.col("low").alias("group_id"))
    giant, rest, closed, hub = peeled
    final = _propagate(rest)
    if final is None:
        return _labelled(giant)
    final = cut_lineage(final)
    if not closed:  # the reached vertices have the label that the hub got among the rest
        label = giant.join(final, F.col("id") == F.col("vertex")).select("label").first()["label"]
        final = giant.select(F.col("id").alias("vertex"), F.lit(label).alias("label")).union(final.filter(F.col("vertex") != hub))
    smallest = final.groupBy("label").agg(F.min("vertex").alias("group_id"))
    groups = final.join(smallest, "label").select("vertex", "group_id")
    return _labelled(giant).union(groups) if closed else groups


def _labelled(giant: DataFrame) -> DataFrame:
    return giant.select(F.col("id").alias("vertex"), F.lit(giant.agg(F.min("id").alias("m")).first()["m"]).alias("group_id"))
