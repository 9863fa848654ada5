"""Joins beyond the built-in ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.operators.ranking import sums_before


def enrich(edges: DataFrame, source: DataFrame, keys: list[str], payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """``edges`` with the payload of ``source``, and how many edges had one. Rows of the source without edge create none;
    they are counted as unmatched."""
    values = source.select(*keys, *payload, F.lit(True).alias("_found"))
    joined = edges.join(values, keys, "left")
    counts = joined.agg(F.count("*").alias("edges"), F.count("_found").alias("matched"))
    lost = source.join(edges.select(*keys), keys, "left_anti").agg(F.count("*").alias("unmatched_source"))
    return joined.drop("_found"), counts.join(lost)


def interval_overlap(left: DataFrame, right: DataFrame, keys: list[str], *, start: str, end: str, width: float) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose intervals [start, end) overlap, columns prefixed l_ and r_.

    An interval is put into every bucket of ``width`` that it touches; rows meet in equal buckets, and a pair counts
    only in the bucket where its overlap starts. So the join is a hash or merge join on (keys, bucket), in place of
    a nested loop. Null or empty intervals overlap nothing.
    """

    def side(df: DataFrame, prefix: str) -> DataFrame:
        df = df.filter(F.col(start) < F.col(end))
        first, last = F.floor(F.col(start) / width), F.ceil(F.col(end) / width) - 1
        df = df.withColumn("_bucket", F.explode(F.sequence(first.cast("long"), F.greatest(first, last).cast("long"))))
        return df.select(*[F.col(k).alias(f"_{k}") for k in keys], "_bucket", *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != "_bucket"])

    on = [f"_{k}" for k in keys] + ["_bucket"]
    pairs = side(left, "l_").join(side(right, "r_"), on)
    begin = F.greatest(f"l_{start}", f"r_{start}")
    overlap = begin < F.least(f"l_{end}", f"r_{end}")
    return pairs.filter(overlap & (F.col("_bucket") == F.floor(begin / width))).drop(*on)


def overlap_totals(df: DataFrame, keys: list[str], *, start: str, end: str) -> DataFrame:
    """Per key how many pairs of its intervals [start, end) overlap, and how much in all: (keys, pairs, overlap).

    Counted by a sweep over starts and ends, not by making the pairs: a start meets the intervals that are open, and while n are
    open the overlaps grow by n (n - 1) / 2. Whole numbers; null or empty intervals overlap nothing. A key may have any number.
    """
    whole = "decimal(38,0)"
    spans = df.filter(F.col(start) < F.col(end))
    ends = F.explode(F.array(F.struct(F.col(start).cast("long").alias("at"), F.lit(1).alias("opened"), F.lit(0).alias("closed")), F.struct(F.col(end).cast("long").alias("at"), F.lit(0).alias("opened"), F.lit(1).alias("closed"))))
    moments = spans.select(*keys, ends.alias("e")).groupBy(*keys, F.col("e.at").alias("at")).agg(F.sum("e.opened").alias("opened"), F.sum("e.closed").alias("closed"))
    swept = sums_before(moments, keys, "at", ["opened", "closed"])
    before = F.col("before_opened") - F.col("before_closed")
    left = before - F.col("closed")  # an interval that ends here doesn't meet one that starts here
    after = left + F.col("opened")
    pairs = left.cast(whole) * F.col("opened") + (F.col("opened").cast(whole) * (F.col("opened") - 1) / 2).cast(whole)
    open_pairs = [(n.cast(whole) * (n - 1) / 2).cast(whole) for n in (before, after)]
    lengths = F.col("at").cast(whole) * (open_pairs[0] - open_pairs[1])
    out = swept.groupBy(*keys).agg(F.sum(pairs).cast("long").alias("pairs"), F.sum(lengths).cast("long").alias("overlap"))
    return out.filter("pairs > 0")


def latest_before(left: DataFrame, right: DataFrame, keys: list[str], *, at: str, values: list[str], tie: str) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` with equal keys and a moment not after its own (as-of join).

    Of right rows at one moment the greatest ``tie`` counts. One shuffle: both are united and read in order.
    """
    packed = F.struct(*values)
    l_rows = left.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), F.struct(*left.columns).alias("_left"), F.lit(None).alias("_right"))
    r_rows = right.select(*keys, F.col(at).alias("_at"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), F.lit(None).alias("_left"), packed.alias("_right"))
    w = Window.partitionBy(*keys).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    read = l_rows.unionByName(r_rows).withColumn("_seen", F.last("_right", ignorenulls=True).over(w)).filter("_side = 1")
    return read.select("_left.*", *[F.col(f"_seen.{v}").alias(f"last_{v}") for v in values])


def blocked_pairs(df: DataFrame, *, key: str, block: Column, extra: list[str]) -> DataFrame:
    """Pairs a < b of rows with one non-null block: key_a, key_b and ``extra`` of both. For selective blocks."""
    rows = df.select(F.col(key).alias("_k"), block.alias("_b"), *extra).filter("_b is not null and _b <> ''")
    a = rows.select("_b", F.col("_k").alias("a"), *[F.col(c).alias(f"{c}_a") for c in extra])
    b = rows.select("_b", F.col("_k").alias("b"), *[F.col(c).alias(f"{c}_b") for c in extra])
    return a.join(b, "_b").filter("a < b")


def within_tolerance(a: Column, b: Column, tolerance: float) -> Column:
    """True unless both are known and differ by more than ``tolerance``: what is missing contradicts nothing."""
    return a.isNull() | b.isNull() | (F.abs(a - b) <= tolerance)


def match_by_name(rows: DataFrame, people: DataFrame, *, name: str, person: str, single: float = 0.9, several: float = 0.4) -> DataFrame:
    """``rows`` with the person of their name: the only one with confidence ``single``, of several the smallest with ``several``."""
    people = people.filter(F.col(name).isNotNull()).groupBy(name).agg(F.min(person).alias("matched"), F.count_distinct(person).alias("candidates"))
    return rows.join(people, name).withColumn("confidence", F.when(F.col("candidates") == 1, single).otherwise(several))


def resolve_in_order(rows: DataFrame, lookups: list[tuple[DataFrame, str]], resolved: str) -> DataFrame:
    """``rows`` with the value of the first lookup that has its key. A lookup is (table with key column and ``resolved``, key)."""
    out = rows
    for i, (table, key) in enumerate(lookups):
        out = out.join(table.select(key, F.col(resolved).alias(f"_r{i}")), key, "left")
    names = [f"_r{i}" for i in range(len(lookups))]
    return out.withColumn(resolved, F.coalesce(*names)).drop(*names)


def collapse_by_name(df: DataFrame, *, name: str, identifier: str, order: list[Column]) -> DataFrame:
    """``df`` with ``identifier`` of the first row of its name; rows without a name keep theirs."""
    w = Window.partitionBy(name).orderBy(*order)
    return df.withColumn(identifier, F.when(F.col(name).isNull(), F.col(identifier)).otherwise(F.first_value(identifier).over(w)))


def first_of_paths(paths: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of several tables, each key from the first table that has it, with the number of its path."""
    tagged = [df.withColumn("path", F.lit(i)) for i, df in enumerate(paths)]
    united = tagged[0]
    for df in tagged[1:]:
        united = united.unionByName(df)
    w = Window.partitionBy(*keys).orderBy("path")
    return united.withColumn("_place", F.row_number().over(w)).filter("_place = 1").drop("_place")


def or_else(found: DataFrame, otherwise: DataFrame) -> DataFrame:
    """``found``, or ``otherwise`` if it has no rows. Decided by one row that is looked for, when this is called."""
    return otherwise if found.isEmpty() else found


def by_number(left: DataFrame, right: DataFrame, *, text: str, number: str) -> DataFrame:
    """Rows whose text is the number of the other side; text that isn't one meets nothing."""
    numbered = left.withColumn("_number", F.col(text).try_cast("bigint")).filter("_number is not null")
    return numbered.join(right, numbered["_number"] == right[number]).drop("_number")


def still_to_do(candidates: DataFrame, attempts: DataFrame, key: str, *, final: list[str], retry: str, most_attempts: int) -> DataFrame:
    """Candidates without an attempt that is final, or that failed ``most_attempts`` times. The attempts are cut down to those
    first, so that the anti join has a plain key."""
    closed = attempts.filter(F.col("status").isin(*final) | ((F.col("status") == retry) & (F.col("attempt_count") >= most_attempts)))
    return candidates.join(closed.select(key).distinct(), key, "left_anti")


def named_beside(entries: DataFrame, target: str, *, basket: list[str], item: str, list_column: str, least: int = 2) -> DataFrame:
    """Items filed with ``target`` in the same list and section of at least ``least`` lists, that aren't lists themselves."""
    mine = entries.filter(F.col(item) == target).select(*basket).distinct()
    beside = entries.join(mine, basket).filter(F.col(item) != target)
    beside = beside.join(entries.select(F.col(list_column).alias(item)).distinct(), item, "left_anti")
    return beside.groupBy(item).agg(F.count_distinct(list_column).alias("lists")).filter(F.col("lists") >= least)


def two_hop_edges(uses: DataFrame, owners: DataFrame, *, source: str, target: str, thing: str, person: str) -> DataFrame:
    """Edges person -> person through things: ``uses`` has (source, target) things, ``owners`` (thing, person).

    Weight is the number of rows that are evidence; nobody has an edge to themselves.
    """
    a = owners.select(F.col(thing).alias(source), F.col(person).alias("person_a"))
    b = owners.select(F.col(thing).alias(target), F.col(person).alias("person_b"))
    pairs = uses.join(a, source).join(b, target).filter("person_a <> person_b")
    return pairs.groupBy("person_a", "person_b").agg(F.count("*").alias("weight"))
