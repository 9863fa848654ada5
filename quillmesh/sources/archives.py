"""Archives: concatenated JSON, tar files as a data source, packs with byte ranges."""

from __future__ import annotations

import fnmatch
import gzip
import hashlib
import json
import re
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillmesh.functions.strings import number_in_file_name
from quillmesh.operators.ranking import packed_in_order


def json_values(text: str) -> Iterator[str]:
    """The JSON values of a text that are written one after the other, as compact text; what is no JSON is stepped over."""
    decoder, at = json.JSONDecoder(), 0
    while at < len(text):
        start = re.compile(r"[\[{]").search(text, at)
        if not start:
            return
        try:
            value, at = decoder.raw_decode(text, start.start())
            yield json.dumps(value, ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            at = start.end()


def read_json_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Concatenated or pretty-printed JSON values of whole files, as rows of ``schema``."""

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"value": [v for text in batch["value"] for v in json_values(text)]}, dtype="object")

    found = spark.read.text(path, wholetext=True).mapInPandas(values, "value string")
    return found.select(F.from_json("value", schema).alias("v")).filter("v is not null").select("v.*")


class TarSource(DataSource):
    """``spark.read.format("tar_texts").load(glob)``: member, doc_id, offset, bytes, text of the text files in tar archives.

    One task per archive, read as a stream from any file system that pyarrow knows; members that end in .gz are unpacked. Option "pattern" is the expression whose
    first group is the number of a document.
    """

    @classmethod
    def name(cls) -> str:
        return "tar_texts"

    def schema(self) -> str:
        return "archive string, member string, doc_id long, offset long, bytes long, text string"

    def reader(self, schema) -> TarReader:
        return TarReader(self.options)


class TarReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        system, pattern = fs.FileSystem.from_uri(self.options["path"])
        folder = pattern.rpartition("/")[0]
        found = system.get_file_info(fs.FileSelector(folder)) if folder else []
        paths = sorted(f.path for f in found if f.is_file and fnmatch.fnmatch(f.path, pattern))
        return [InputPartition(p) for p in paths]

    def read(self, partition: InputPartition):
        pattern = re.compile(self.options.get("pattern", r"(?:^|/)(?:pg)?(\d+)(?:-\d+)?\.txt(?:\.gz)?$"), re.IGNORECASE)
        system, _ = fs.FileSystem.from_uri(self.options["path"])
        with system.open_input_stream(partition.value) as stream, tarfile.open(fileobj=stream, mode="r|*") as archive:
            for member in archive:
                found = pattern.search(member.name)
                if member.isfile() and found:
                    raw = archive.extractfile(member).read()
                    raw = gzip.decompress(raw) if member.name.endswith(".gz") else raw
                    yield (partition.value, member.name, int(found.group(1)), member.offset_data, len(raw), raw.decode("utf-8", "replace"))


def read_tars(spark: SparkSession, pattern: str) -> DataFrame:
    spark.dataSource.register(TarSource)
    return spark.read.format("tar_texts").load(pattern)


def locations(texts: DataFrame, within: list[str], *, doc: str, text: str, most: int) -> DataFrame:
    """Where each document goes when its bytes, each packed on its own, are written one after the other into assets of at
    most ``most`` bytes: asset, offset, length, sha256 of the packed bytes."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [gzip.compress((t or "").encode(), mtime=0) for t in batch["_text"]]
            yield batch.drop(columns="_text").assign(length=[len(p) for p in packed], sha256=[hashlib.sha256(p).hexdigest() for p in packed])

    rows = texts.select(*within, F.col(doc).alias("doc"), F.col(text).alias("_text"))
    keys = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (*within, "doc"))
    sized = rows.mapInPandas(pack, f"{keys}, length long, sha256 string")
    return packed_in_order(sized, within, [F.col("doc")], "length", most)


def slice_of(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def intact(raw: Column, length: Column, sha256: Column) -> Column:
    """Whether bytes have the recorded length and hash."""
    return (F.octet_length(raw) == length) & (F.sha2(raw, 256) == sha256)


def receipts(spark: SparkSession, path: str) -> DataFrame:
    """Name, bytes and sha256 of files."""
    df = spark.read.format("binaryFile").load(path)
    return df.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), number_in_file_name(F.col("path")).alias("number"))
