"""Files in and out: shards, registry dumps, identifier tables, front matter; exports, whole texts as files, concatenated corpora."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmesh.operators.policies import keep_first
from quillmesh.operators.ranking import sums_before
from quillmesh.storage import cut_lineage

CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "maxCharsPerColumn": -1}


def first_existing(spark: SparkSession, places: list[str]) -> tuple[str, int] | None:
    """The first place that exists, with its number from 1; None where none does."""
    for number, place in enumerate(places, 1):
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return place, number
    return None


def import_shards(spark: SparkSession, pattern: str, schema: str, existing: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON shards merged into ``existing``: what exists stays, of the rest the first per key; and how many rows were read,
    how many were new."""
    rows = spark.read.schema(schema).json(pattern).withColumn("_file", F.col("_metadata.file_name"))
    merged = keep_first(existing, rows.drop("_file"), keys, [F.col(c) for c in order])
    counts = rows.agg(F.count("*").alias("read")).join(rows.select(*keys).distinct().join(existing.select(*keys), keys, "left_anti").agg(F.count("*").alias("added")))
    return merged, counts


def read_dump(spark: SparkSession, folder: str, tables: dict[str, str]) -> dict[str, DataFrame]:
    """Tables of a registry's dump, ``folder/name.csv`` each: {name: schema}. Quoted fields may hold line ends, doubled quotes and
    any number of characters; columns are found by their header."""
    out = {}
    for name, schema in tables.items():
        df = spark.read.options(**CSV).csv(f"{folder}/{name}.csv")
        wanted = T.StructType.fromDDL(schema)
        out[name] = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])
    return out


def write_dump(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.options(header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/{name}.csv")


def read_identifiers(spark: SparkSession, paths: list[str], entity: str, platforms: dict[str, str]) -> DataFrame:
    """(entity, platform, value) of tables with a column per platform, {column: platform}; a file needn't have all of them."""
    parts = None
    for path in paths:
        df = spark.read.options(**CSV).csv(path)
        have = {c.lower(): c for c in df.columns}
        pairs = F.array(*[F.struct(F.lit(p).alias("platform"), F.trim(F.col(have[c.lower()])).alias("value")) for c, p in platforms.items() if c.lower() in have])
        rows = df.select(F.regexp_extract(F.col(have[entity.lower()]), r"([^/]+)$", 1).alias("entity"), F.explode(pairs).alias("_p")).select("entity", "_p.*")
        parts = rows if parts is None else parts.union(rows)
    return parts.filter("value <> '' and entity <> ''").distinct()


def front_matter(text: str | None) -> tuple[dict[str, str], str]:
    """The plain fields of a text's front matter and its body; lists are joined by commas. A text without it is all body.

    Reads ``key: value``, ``key: [a, b]`` and items ``- a`` below a key, which is what such headers hold; nested values are left out.
    """
    lines = (text or "").splitlines(keepends=True)
    if not lines or lines[0].strip() != "---":
        return {}, text or ""
    closing = next((i for i, line in enumerate(lines[1:], 1) if line.strip() == "---"), None)
    if closing is None:
        return {}, text or ""
    fields: dict[str, str] = {}
    key = ""
    for line in lines[1:closing]:
        name, colon, value = line.partition(":")
        value = value.strip()
        if line.lstrip().startswith("- ") and key:
            fields[key] = ",".join(filter(None, (fields[key], line.lstrip()[2:].strip().strip("\"'"))))
        elif colon and name == name.lstrip() and name.strip():
            key = name.strip()
            items = value[1:-1].split(",") if value.startswith("[") and value.endswith("]") else [value]
            fields[key] = ",".join(x.strip().strip("\"'") for x in items)
    return fields, "".join(lines[closing + 1 :])


_FRONT = T.StructType().add("fields", T.MapType(T.StringType(), T.StringType())).add("body", "string")


@F.pandas_udf(_FRONT)
def parsed_front_matter(text: pd.Series) -> pd.DataFrame:
    found = [front_matter(t) for t in text]
    return pd.DataFrame({"fields": [f for f, _ in found], "body": [b for _, b in found]})


def tiered_pages(pages: DataFrame, fields: str, body: str, *, default: float = 7.0, long_body: int = 1500) -> DataFrame:
    """``pages`` with the score that their evidence gives (links_to, contradicts, quality_notes and a long body, a half each), its tier,
    and whether the stated tier contradicts the stated score."""

    def said(name: str) -> Column:
        return F.coalesce(F.try_element_at(fields, F.lit(name)), F.lit("")) != ""

    score = F.lit(default) + sum((F.when(c, 0.5).otherwise(0.0) for c in (said("links_to"), said("contradicts"), said("quality_notes"), F.length(body) > long_body)), F.lit(0.0))
    score = F.round(F.least(score, F.lit(10.0)), 1)
    stated, tier = F.try_element_at(fields, F.lit("score")).try_cast("double"), F.try_element_at(fields, F.lit("tier"))
    out = pages.withColumn("new_score", score).withColumn("new_tier", tier_of(F.col("new_score"))).withColumn("old_score", stated).withColumn("old_tier", tier)
    return out.withColumn("contradicts", F.coalesce(F.col("old_tier").isin("A", "B", "C") & (F.col("old_tier") != tier_of(F.col("old_score"))), F.lit(False)))


def tier_of(score: Column) -> Column:
    return F.when(score >= 8.0, "A").when(score >= 5.0, "B").when(score.isNotNull(), "C")


def tier_changes(pages: DataFrame) -> DataFrame:
    """(tier, before, after): how many pages stand in each tier before and after; "none" for no tier."""
    both = pages.select(F.explode(F.array(F.struct(F.coalesce("old_tier", F.lit("none")).alias("tier"), F.lit(1).alias("before"), F.lit(0).alias("after")), F.struct(F.col("new_tier").alias("tier"), F.lit(0).alias("before"), F.lit(1).alias("after")))).alias("x"))
    return both.select("x.*").groupBy("tier").agg(F.sum("before").alias("before"), F.sum("after").alias("after"))


def export_lines(df: DataFrame, path: str) -> None:
    """JSON lines; nulls are left out."""
    df.write.json(path)


def write_texts(df: DataFrame, folder: str, *, name: str, text: str) -> DataFrame:
    """Each text as a file of its own, on any file system that pyarrow knows: (name, bytes). Written by the tasks that hold the rows."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            sizes = []
            for n, t in zip(batch["name"], batch["text"]):
                raw = (t or "").encode()
                with system.open_output_stream(f"{root}/{n}") as stream:
                    stream.write(raw)
                sizes.append(len(raw))
            yield pd.DataFrame({"name": batch["name"], "bytes": sizes})

    return cut_lineage(df.select(F.col(name).alias("name"), F.col(text).alias("text")).mapInPandas(write, "name string, bytes long"))


def corpus_index(df: DataFrame, within: list[str], *, key: str, text: str, separator: int = 2) -> DataFrame:
    """Where each text stands when those of a group are written one after the other in order of the key, ``separator`` characters
    apart: (within, key, start, chars). Groups may be of any size: the places are running sums in ranges."""
    rows = df.select(*within, F.col(key).alias("key"), F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("chars")).withColumn("step", F.col("chars") + separator)
    return sums_before(rows, within, "key", ["step"]).select(*within, "key", F.col("before_step").alias("start"), "chars")


def concatenated(df: DataFrame, within: list[str], *, key: str, text: str, separator: str = "\n\n") -> DataFrame:
    """(within, text): the texts of each group, which must fit into one value, in order of the key."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t"))))
    return df.groupBy(*within).agg(F.array_join(F.transform(parts, lambda x: x["t"]), separator).alias("text"))
