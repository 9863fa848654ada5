"""Incremental runs: new files since the last run are merged into a table, exactly once."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quillmesh.operators.policies import keep_first, keep_last

Policy = Callable[[DataFrame, DataFrame, list[str], list[Column]], DataFrame]
POLICIES: dict[str, Policy] = {"keep_first": keep_first, "keep_last": keep_last}
#: Parts a table is divided into by the hash of its keys, unless the caller says otherwise: a batch rewrites only those it touches.
PARTS = 64


def run_new_files(
    spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, *, keys: list[str], order: list[Column], policy: str = "keep_last", kind: str = "json", parts: int = PARTS
) -> StreamingQuery:
    """Merges the files that have come into ``folder`` since the last run into the table ``target``, then stops.

    The table is divided into ``parts`` by the hash of the keys. A batch writes the parts that it touches under
    ``target/version-<batch>``, and then ``target/_versions/<batch>.json``, which names the version of every part. That file comes
    into being at once, so ``current`` never sees a batch that is unfinished; one that is repeated after a failure does nothing
    if its file is there, and else writes its parts again.
    """
    merge = POLICIES[policy]

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if _exists(session, _version_file(target, number)):
            return
        versions = _versions(session, target, before=number)
        batch = batch.withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
        touched = sorted(r["_part"] for r in batch.select("_part").distinct().collect())  # at most ``parts``
        if not touched and versions:
            return
        before = _read(session, target, {p: v for p, v in versions.items() if p in touched})
        merged = merge(batch.limit(0) if before is None else before, batch, keys, order)
        merged.write.mode("overwrite").partitionBy("_part").parquet(f"{target}/version-{number}")
        _write_text(session, _version_file(target, number), json.dumps({str(p): v for p, v in {**versions, **dict.fromkeys(touched, number)}.items()}))

    stream = spark.readStream.schema(schema).format(kind).load(folder)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str, *, before: int | None = None) -> DataFrame | None:
    """The newest finished version of a table (before a batch), or None."""
    found = _read(spark, target, _versions(spark, target, before=before))
    return None if found is None else found.drop("_part")


def _read(spark: SparkSession, target: str, versions: dict[int, int]) -> DataFrame | None:
    """The parts of a table, each of its version: one scan per version, of which there are no more than parts."""
    found: DataFrame | None = None
    for version in sorted(set(versions.values())):
        base = f"{target}/version-{version}"
        paths = [p for p in (f"{base}/_part={part}" for part, v in sorted(versions.items()) if v == version) if _exists(spark, p)]
        if paths:
            rows = spark.read.option("basePath", base).parquet(*paths).withColumn("_part", F.col("_part").cast("int"))
            found = rows if found is None else found.unionByName(rows)
    return found


def _version_file(target: str, number: int) -> str:
    return f"{target}/_versions/{number}.json"


def _versions(spark: SparkSession, target: str, *, before: int | None) -> dict[int, int]:
    """The version of each part by the newest version file."""
    folder = f"{target}/_versions"
    if not _exists(spark, folder):
        return {}
    system, path = _place(spark, folder)
    numbers = [n.removesuffix(".json") for n in (s.getPath().getName() for s in system.listStatus(path)) if n.endswith(".json")]
    finished = sorted(int(n) for n in numbers if n.isdigit() and (before is None or int(n) < before))
    if not finished:
        return {}
    text = spark.read.text(_version_file(target, finished[-1]), wholetext=True).first()["value"]
    return {int(p): v for p, v in json.loads(text).items()}


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a file beside its place and then renames it, so that it is there whole or not at all."""
    system, draft = _place(spark, f"{path}.draft")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    system.rename(draft, _place(spark, path)[1])


def windowed_counts(events: DataFrame, *, at: str, kind: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts per window and kind, for streams (late rows count up to the watermark) and tables alike."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
