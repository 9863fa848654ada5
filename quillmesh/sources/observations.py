"""Readers of sightings in their various files, and the projection they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.strings import first_int, squeeze
from quillmesh.functions.urls import normalized_repository_url, provisional_id

SHAPE = "url string, full_name string, stars string, description string, observed_at string"
LINK = r"https?://(?:www\.)?github\.com/[\w.-]+/[\w.-]+"


def _projected(df: DataFrame, **columns: Column) -> DataFrame:
    empty = F.lit(None).cast("string")
    return df.select(*[columns.get(c, empty).cast("string").alias(c) for c in ("url", "full_name", "stars", "description", "observed_at")])


def read_combined_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object with an array ``entries``; the address is repo, or else homepage."""
    schema = "entries array<struct<repo string, homepage string, name string, stars string, description string, observed_at string>>"
    e = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("entries").alias("e"))
    return _projected(e, url=F.coalesce("e.repo", "e.homepage"), full_name=F.col("e.name"), stars=F.col("e.stars"), description=F.col("e.description"), observed_at=F.col("e.observed_at"))


def read_broad_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; quoted fields may hold line ends and doubled quotes, of any length."""
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1).csv(path)
    have = {c.lower(): c for c in df.columns}

    def first(*names: str) -> Column:
        found = [F.col(have[n]) for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None)

    return _projected(df, url=first("url", "html_url", "repo"), full_name=first("full_name", "name"), stars=first("stars", "stargazers_count"), description=first("description"), observed_at=first("observed_at", "updated_at"))


def read_candidate_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object with an array ``rows``; the moment is taken out of the text lastCommit."""
    schema = "rows array<struct<url string, repo string, name string, stars string, description string, lastCommit string>>"
    e = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("rows").alias("e"))
    at = F.regexp_extract("e.lastCommit", r"(\d{4}-\d{2}-\d{2}(?:T[\d:.]+Z?)?)", 1)
    return _projected(e, url=F.coalesce("e.url", "e.repo"), full_name=F.col("e.name"), stars=F.col("e.stars"), description=F.col("e.description"), observed_at=F.when(at != "", at))


def read_log_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Sections that begin with ``###``: the first link, and the first line below the heading that isn't one."""
    text = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\n(?=### )")).alias("s")).filter(F.col("s").startswith("### "))
    heading = F.trim(F.regexp_extract("s", r"^### ([^\n]*)", 1))
    description = F.regexp_extract("s", r"^[^\n]*\n(?:\s*\n|[^\n]*https?://[^\n]*\n)*+([^\n]+)", 1)
    link = F.regexp_extract("s", f"({LINK})", 1)
    return _projected(text, url=F.when(link != "", link), full_name=heading, description=F.when(description != "", F.trim(description)))


def read_table_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Rows of markdown tables: every link of a row; of six cells or more the last but one is the description."""
    lines = spark.read.text(path).filter(F.trim("value").startswith("|"))
    cells = F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|")
    rows = lines.select(F.explode(F.regexp_extract_all("value", F.lit(f"({LINK})"))).alias("url"), cells.alias("c"))
    return _projected(rows, url=F.col("url"), description=F.when(F.size("c") >= 6, F.trim(F.element_at("c", -2))))


def read_harvest_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines under the usual names; lines that aren't JSON are skipped."""
    schema = "url string, repo string, html_url string, owner_name string, full_name string, stars string, stargazers_count string, description string, observed_at string, _corrupt_record string"
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path).filter("_corrupt_record is null")
    return _projected(df, url=F.coalesce("url", "html_url", "repo"), full_name=F.coalesce("full_name", "owner_name"), stars=F.coalesce("stars", "stargazers_count"), description=F.col("description"), observed_at=F.col("observed_at"))


def read_rounds(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Lines of the append-only log with their file and ordinal, and the number of malformed lines per file."""
    text = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    lines = text.select(parsed.alias("line"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("ordinal"))
    bad = lines.groupBy("file").agg(F.count("line._corrupt_record").alias("malformed"))
    good = lines.filter("line._corrupt_record is null").select("line.*", "file", "ordinal").drop("_corrupt_record")
    return good, bad


def recorded(df: DataFrame, source: str, kind: str) -> DataFrame:
    """Sightings in the shape of the log: rows whose address doesn't normalise are dropped, owner and name come from it."""
    out = df.withColumn("normalized_url", normalized_repository_url(F.col("url"))).filter("normalized_url is not null")
    return out.select(
        F.lit(source).alias("source"), F.lit(kind).alias("source_format"), provisional_id(F.col("normalized_url")).alias("canonical_id"), F.col("url").alias("observed_url"), "normalized_url",
        F.regexp_extract("normalized_url", r"([^/]+/[^/]+)$", 1).alias("observed_owner_name"), first_int(F.col("stars")).alias("stars"), squeeze(F.col("description")).alias("description"), "observed_at",
    )


def read_readmes(spark: SparkSession, path: str) -> DataFrame:
    """(full_name, text) of cached files ``owner__name.md``."""
    df = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return df.select(F.lower(F.regexp_replace(F.regexp_replace("file", r"\.md$", ""), "__", "/")).alias("full_name"), "text")


def read_catalog(spark: SparkSession, path: str, key: str, packed: dict[str, str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """A catalogue CSV, and for each packed column the edges (key, value) of its parts; {column: separator}."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    from quillmesh.functions.strings import split_values

    edges = {c: df.select(F.col(key), F.explode(split_values(F.col(c), s)).alias("value")).distinct() for c, s in packed.items()}
    return df, edges


def read_entity_lines(spark: SparkSession, path: str, properties: list[str]) -> DataFrame:
    """JSON lines of entities whose properties are a scalar, {"value": ...} or {"qid": ...}: id, and each as a string."""
    value = F.try_parse_json("value")

    def scalar(p: str) -> Column:
        return F.coalesce(*[F.try_variant_get(value, f"$.{p}{suffix}", "string") for suffix in (".value", ".qid")], F.try_variant_get(value, f"$.{p}", "string"))

    lines = spark.read.text(path).filter(value.isNotNull())
    return lines.select(F.try_variant_get(value, "$.id", "string").alias("id"), *[scalar(p).alias(p) for p in properties])
