"""Where intermediate results go, and what may be broadcast."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast by hand only up to this many bytes, measured before the broadcast.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

_WRITTEN: dict[str, set[str]] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints, which all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset and the master is local, a
    temporary folder is used; on a cluster without the setting this raises, because a machine-local
    folder would lose rows with its machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quillmesh-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back: survives lost executors.

    A table is written once (a checkpoint computes its last stage twice), is read by column, and tells the
    optimizer its size. It stays until ``drop_table``, or ``drop_tables`` of its session.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._quillmesh_path = path
    _WRITTEN.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return written


def scratch(spark: SparkSession) -> str:
    """A name for a folder of files in the shared checkpoint folder, which ``drop_tables`` of its session deletes."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def drop_table(df: DataFrame) -> None:
    """Deletes what ``cut_lineage`` wrote for ``df``, once nothing reads it any more."""
    path = getattr(df, "_quillmesh_path", None)
    if path is not None:
        _delete(df.sparkSession, path)
        _WRITTEN.get(df.sparkSession.sparkContext.applicationId, set()).discard(path)


def drop_tables(spark: SparkSession) -> None:
    """Deletes all that ``cut_lineage`` wrote in this application."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, set()):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names: ``pick(df, key="canonical_id")``.

    Columns are found by position, so that further columns of the input, whatever their names and even
    where they differ from a wanted one only by case or not at all, can neither clash nor be read.
    Of several columns with the very same name the first counts.
    """
    names = df.columns
    missing = [source for source in columns.values() if source not in names]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    by_position = df.toDF(*[f"_{i}" for i in range(len(names))])
    return by_position.select(*[F.col(f"_{names.index(source)}").alias(internal) for internal, source in columns.items()])


def blank_to_null(column: Column) -> Column:
    """Null where a string is null, empty or only white space; otherwise the string itself."""
    return F.when(F.length(F.regexp_replace(column, r"[\s\u00a0\u200b\ufeff]+", "")) > 0, column)


def planned_partitions(df: DataFrame) -> int:
    """How many tasks the plan of ``df`` would run in its last stage, without running it."""
    return df.rdd.getNumPartitions()


def spread(df: DataFrame, *, least: int | None = None) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for work that is heavy per row.

    A scan that already yields enough tasks stays as it is, so that large inputs aren't shuffled.
    """
    least = least or df.sparkSession.sparkContext.defaultParallelism
    return df if planned_partitions(df) >= least else df.repartition(least)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df`` in bytes; huge where it doesn't know."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, *, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its estimated size is within ``limit``; otherwise ``df``, to be shuffled."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
