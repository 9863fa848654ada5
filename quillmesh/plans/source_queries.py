"""Queries of the readers and writers: whole tables are written in the form that a reader knows, into the shared folder, and read back."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import strings
from quillmesh.operators import media, policies, registry
from quillmesh.plans.registry import query
from quillmesh.sources import archives, files, observations
from quillmesh.storage import cut_lineage, scratch
from quillmesh.tables import table


def _sightings(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "repo_observation").select("obs_id", "observed_url", "observed_owner_name", "stars", "description", "observed_at").distinct()
    return rows.withColumn("line", F.trim(F.regexp_replace(F.coalesce("description", F.lit("")), r"\s+", " ")))


_RECORDED = """
o AS (SELECT DISTINCT obs_id, observed_url, observed_owner_name, stars, description, observed_at FROM repo_observation),
u AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(trim(observed_url), '^<+|>+$', '', 'g'), '[).,;]+$', ''), '^git\\+', '') AS c FROM o WHERE observed_url IS NOT NULL),
h AS (SELECT *, regexp_replace(lower(regexp_extract(c, '^(?:[^:/]+://)?([^/?#]*)', 1)), '^www\\.', '') AS host, lower(regexp_extract(c, '^(?:[^:/]+://)?[^/?#]*/+([^?#]*)', 1)) AS path FROM u),
n AS (SELECT *, CASE WHEN regexp_matches(path, '^[^/]+/+[^/]') AND host <> '' AND NOT contains(c, ' ') THEN
    'https://' || host || '/' || regexp_extract(path, '^([^/]+)/+', 1) || '/' || regexp_replace(regexp_extract(path, '^[^/]+/+([^/]+)', 1), '\\.git$', '') END AS url FROM h),
r AS (SELECT *, TRY_CAST(nullif(regexp_extract(stars::VARCHAR, '[0-9]+'), '') AS BIGINT) AS n_stars, coalesce(trim(regexp_replace(description, '\\s+', ' ', 'g')), '') AS d FROM n WHERE url IS NOT NULL)
"""
_COUNTED = "url, count(*) AS n, count(n_stars) AS starred, max(n_stars)::BIGINT AS stars"


def _counted(df: DataFrame, source: str) -> DataFrame:
    """Sightings per address with what their fields add up to: enough to see that no row, number, text or address is lost."""
    rows = observations.recorded(df, source, "file")
    return rows.groupBy(F.col("normalized_url").alias("url")).agg(F.count("*").alias("n"), F.count("stars").alias("starred"), F.max("stars").alias("stars"), F.sum(F.length("description")).alias("chars"), F.count(F.when(F.trim("observed_at") != "", 1)).alias("dated"))


def _in_objects(rows: DataFrame, item: Column, field: str, path: str) -> None:
    """JSON objects with an array ``field`` of items, one object a file, of some hundred items each."""
    packed = rows.groupBy(F.floor(F.col("obs_id") / 500).alias("b")).agg(F.collect_list(item).alias(field)).drop("b")
    packed.write.option("maxRecordsPerFile", 1).json(path)


@query("combined_json", f"WITH {_RECORDED} SELECT {_COUNTED}, sum(length(d))::BIGINT AS chars, count(*) FILTER (WHERE trim(observed_at) <> '') AS dated FROM r GROUP BY 1")
def combined_json(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark)
    item = F.struct(F.col("observed_url").alias("repo"), F.col("observed_owner_name").alias("name"), F.col("stars").cast("string").alias("stars"), "description", "observed_at")
    _in_objects(_sightings(spark, folder), item, "entries", path)
    return _counted(observations.read_combined_json(spark, path), "combined")


@query("broad_csv", f"WITH {_RECORDED} SELECT {_COUNTED}, sum(length(d))::BIGINT AS chars, count(*) FILTER (WHERE trim(observed_at) <> '') AS dated FROM r GROUP BY 1")
def broad_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions with line ends, commas and quotes stay whole."""
    path = scratch(spark)
    rows = _sightings(spark, folder).select(F.col("observed_url").alias("html_url"), F.col("observed_owner_name").alias("full_name"), F.col("stars").alias("stargazers_count"), "description", F.col("observed_at").alias("updated_at"))
    files.write_dump({"part": rows}, path)
    return _counted(observations.read_broad_csv(spark, f"{path}/part.csv"), "broad")


@query("candidate_json", f"""WITH {_RECORDED} SELECT {_COUNTED}, sum(length(d))::BIGINT AS chars, count(*) FILTER (WHERE regexp_matches(observed_at, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS dated FROM r GROUP BY 1""")
def candidate_json(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark)
    commit = F.concat(F.lit("last commit "), F.coalesce("observed_at", F.lit("unknown")), F.lit(" by someone"))
    item = F.struct(F.col("observed_url").alias("url"), F.col("observed_owner_name").alias("name"), F.col("stars").cast("string").alias("stars"), "description", commit.alias("lastCommit"))
    _in_objects(_sightings(spark, folder), item, "rows", path)
    return _counted(observations.read_candidate_json(spark, path), "candidates")


_LINKED = r"""
WITH o AS (SELECT DISTINCT obs_id, observed_url, description FROM repo_observation), l AS (SELECT *, regexp_extract(observed_url, 'https?://(?:www\.)?github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+') AS link FROM o),
n AS (SELECT regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(link, '[).,;]+$', ''), '^https?://(www\.)?', 'https://'), '\.git$', '')), '\.git$', '') AS url, coalesce(trim(regexp_replace(description, '\s+', ' ', 'g')), '') AS d FROM l WHERE link <> '')
"""


@query("log_markdown", _LINKED + "SELECT url, count(*) AS n, count(*) FILTER (WHERE d <> '' AND NOT contains(d, '://')) AS described FROM n GROUP BY 1")
def log_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Sections with a link and a line of description, some hundred to a file."""
    path = scratch(spark)
    section = F.concat(F.lit("### Sighting "), F.col("obs_id").cast("string"), F.lit("\n"), F.coalesce("observed_url", F.lit("none")), F.lit("\n\n"), F.col("line"), F.lit("\n"))
    rows = _sightings(spark, folder).groupBy(F.floor(F.col("obs_id") / 500).alias("b")).agg(F.concat(F.lit("# Log\n"), F.array_join(F.collect_list(section), "")).alias("text"))
    files.write_texts(rows.withColumn("name", F.concat(F.lit("log-"), F.col("b").cast("string"), F.lit(".md"))), path, name="name", text="text")
    out = observations.recorded(observations.read_log_markdown(spark, path), "log", "markdown")
    return out.groupBy(F.col("normalized_url").alias("url")).agg(F.count("*").alias("n"), F.count_if(F.col("description") != "").alias("described"))


@query("table_markdown", _LINKED + "SELECT url, count(*) AS n, count(*) FILTER (WHERE trim(replace(d, '|', '/')) <> '') AS described FROM n GROUP BY 1")
def table_markdown(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark)
    cells = [F.col("obs_id").cast("string"), F.regexp_replace(F.coalesce("observed_url", F.lit("none")), r"\s+", " "), F.lit("x"), F.lit("y"), F.regexp_replace(F.regexp_replace("line", r"\|", "/"), "https?://", ""), F.lit("z")]
    _sightings(spark, folder).select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value")).write.text(path)
    out = observations.recorded(observations.read_table_markdown(spark, path), "table", "markdown")
    return out.groupBy(F.col("normalized_url").alias("url")).agg(F.count("*").alias("n"), F.count_if(F.col("description") != "").alias("described"))


@query("harvest_lines", f"WITH {_RECORDED} SELECT {_COUNTED}, sum(length(d))::BIGINT AS chars, count(*) FILTER (WHERE trim(observed_at) <> '') AS dated FROM r GROUP BY 1")
def harvest_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines with a broken line beside every tenth."""
    path = scratch(spark)
    line = F.to_json(F.struct(F.col("observed_url").alias("html_url"), F.col("observed_owner_name").alias("full_name"), F.col("stars").cast("string").alias("stargazers_count"), "description", "observed_at"))
    lines = F.when(F.col("obs_id") % 10 == 0, F.array(line, F.lit('{"html_url": broken'))).otherwise(F.array(line))
    _sightings(spark, folder).select(F.explode(lines).alias("value")).write.text(path)
    return _counted(observations.read_harvest_lines(spark, path), "harvest")


@query("malformed_lines", "SELECT count(DISTINCT obs_id) AS rows, count(DISTINCT obs_id) FILTER (WHERE obs_id % 10 = 0) AS malformed, sum(DISTINCT obs_id)::BIGINT AS ids FROM repo_observation")
def malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The append-only log: broken lines are counted, not lost."""
    path = scratch(spark)
    line = F.to_json(F.struct("obs_id", "description"))
    _sightings(spark, folder).select(F.explode(F.when(F.col("obs_id") % 10 == 0, F.array(line, F.lit("oops"))).otherwise(F.array(line))).alias("value")).write.text(path)
    good, bad = observations.read_rounds(spark, path, "obs_id long, description string")
    return good.agg(F.count("*").alias("rows"), F.sum("obs_id").alias("ids")).join(bad.agg(F.sum("malformed").alias("malformed"))).select("rows", "malformed", "ids")


@query("imported_shards", """
WITH o AS (SELECT DISTINCT obs_id, normalized_url, stars FROM repo_observation), old AS (SELECT * FROM o WHERE obs_id % 3 = 0),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY normalized_url ORDER BY obs_id) AS p FROM o WHERE obs_id % 3 <> 0) WHERE p = 1)
SELECT normalized_url, obs_id, stars FROM old UNION ALL SELECT normalized_url, obs_id, stars FROM f WHERE normalized_url NOT IN (SELECT normalized_url FROM old WHERE normalized_url IS NOT NULL) OR normalized_url IS NULL""")
def imported_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shards merged into what exists: first seen wins."""
    path = scratch(spark)
    rows = table(spark, folder, "repo_observation").select("normalized_url", "obs_id", "stars").distinct()
    rows.filter("obs_id % 3 <> 0").write.json(path)
    merged, _ = files.import_shards(spark, path, "normalized_url string, obs_id long, stars long", rows.filter("obs_id % 3 = 0"), ["normalized_url"], ["obs_id"])
    return merged


@query("concatenated_json", "SELECT id, name, level FROM category")
def concatenated_json(spark: SparkSession, folder: str) -> DataFrame:
    """Values written one after the other, over several lines and with junk between them."""
    path = scratch(spark)
    values = F.concat(F.lit('{\n "id": '), F.col("id").cast("string"), F.lit(',\n "level": '), F.coalesce(F.col("level").cast("string"), F.lit("null")), F.lit(', "name": '), F.coalesce(F.to_json(F.struct("name")), F.lit("{}")), F.lit("} junk "))
    text = table(spark, folder, "category").groupBy(F.floor(F.col("id") / 100).alias("b")).agg(F.array_join(F.collect_list(values), "").alias("text"))
    files.write_texts(text.withColumn("name", F.concat(F.lit("s-"), F.col("b").cast("string"))), path, name="name", text="text")
    out = archives.read_json_stream(spark, path, "id long, level int, name struct<name string>")
    return out.select("id", "name.name", "level")


@query("readme_cache", "SELECT list_repo AS full_name, length(coalesce(title, '')) + 1 AS chars FROM curated_list")
def readme_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Files named after their repository."""
    path = scratch(spark)
    rows = table(spark, folder, "curated_list").select(F.concat(F.regexp_replace("list_repo", "/", "__"), F.lit(".md")).alias("name"), F.concat(F.coalesce("title", F.lit("")), F.lit("\n")).alias("text"))
    files.write_texts(rows, path, name="name", text="text")
    return observations.read_readmes(spark, path).select("full_name", F.length("text").cast("long").alias("chars"))


@query("catalog_edges", "SELECT DISTINCT list_repo AS repo, trim(v) AS value FROM (SELECT list_repo, unnest(string_split(replace(topic, '-', ';'), ';')) AS v FROM curated_list WHERE topic IS NOT NULL) WHERE trim(v) <> ''")
def catalog_edges(spark: SparkSession, folder: str) -> DataFrame:
    """A catalogue CSV with packed values, as edges."""
    path = scratch(spark)
    rows = table(spark, folder, "curated_list").select("list_repo", "title", F.regexp_replace("topic", "-", "; ").alias("topics"))
    files.write_dump({"catalog": rows}, path)
    _, edges = observations.read_catalog(spark, f"{path}/catalog.csv", "list_repo", {"topics": ";"})
    return edges["topics"].select(F.col("list_repo").alias("repo"), "value")


@query("entity_lines", """
WITH p AS (SELECT DISTINCT person_id, birth_year, death_year, merged_into FROM person) SELECT person_id AS id, birth_year::VARCHAR AS birth, death_year::VARCHAR AS death, merged_into AS target FROM p""")
def entity_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Properties as a scalar, a value in an object, or an entity."""
    path = scratch(spark)
    people = table(spark, folder, "person").select("person_id", "birth_year", "death_year", "merged_into").distinct()
    birth, target = F.when(F.col("birth_year").isNotNull(), F.struct(F.col("birth_year").alias("value"))), F.when(F.col("merged_into").isNotNull(), F.struct(F.col("merged_into").alias("qid")))
    people.select(F.to_json(F.struct(F.col("person_id").alias("id"), birth.alias("birth"), F.col("death_year").alias("death"), target.alias("target"))).alias("value")).write.text(path)
    return observations.read_entity_lines(spark, path, ["birth", "death", "target"])


@query("identifier_tables", """
WITH p AS (SELECT DISTINCT person_id, birth_year, origin, primary_tier FROM person)
SELECT person_id AS entity, 'year' AS platform, birth_year::VARCHAR AS value FROM p WHERE birth_year IS NOT NULL UNION SELECT person_id, 'origin', origin FROM p WHERE trim(origin) <> '' UNION SELECT person_id, 'tier', primary_tier FROM p WHERE trim(primary_tier) <> ''""")
def identifier_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables of different columns, unpivoted to one."""
    path = scratch(spark)
    people = table(spark, folder, "person").select(F.concat(F.lit("http://entity/"), F.col("person_id")).alias("item"), F.col("birth_year").alias("yearLabel"), F.col("origin").alias("originLabel"), F.col("primary_tier").alias("tierLabel")).distinct()
    files.write_dump({"a": people.select("item", "yearLabel"), "b": people.select("item", "originLabel", "tierLabel")}, path)
    return files.read_identifiers(spark, [f"{path}/a.csv", f"{path}/b.csv"], "item", {"yearLabel": "year", "originLabel": "origin", "tierLabel": "tier"})


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with front matter in all its forms, from the curated lists: written as files and read back."""
    rows = table(spark, folder, "curated_list")
    tier = F.when(F.col("depth") == 1, "A").when(F.col("depth") == 2, "B").otherwise("C")
    fields = [F.lit("---"), F.concat(F.lit("id: "), F.col("list_repo")), F.concat(F.lit("tier: "), tier), F.concat(F.lit("score: "), F.coalesce(F.round(F.col("stars") % 100 / 10, 1).cast("string"), F.lit("")))]
    links = F.when(F.col("n_entries") > 20, F.lit("links_to: [a, 'b']")).when(F.col("n_entries") > 10, F.lit("links_to:\n  - a\n  - b")).otherwise("links_to:")
    text = F.concat(F.array_join(F.array(*fields, links, F.when(F.col("status") != "ok", "contradicts: yes").otherwise("contradicts:")), "\n"), F.lit("\n---\n"), F.repeat(F.lit("body "), F.coalesce(F.col("n_entries"), F.lit(0)).cast("int") * 20))
    path = scratch(spark)
    files.write_texts(rows.select(F.concat(F.regexp_replace("list_repo", "/", "__"), F.lit(".md")).alias("name"), text.alias("text")), path, name="name", text="text")
    pages = observations.read_readmes(spark, path).withColumn("front", files.parsed_front_matter("text"))
    return files.tiered_pages(pages.select("full_name", "front.fields", "front.body"), "fields", "body")


_PAGES = """
WITH c AS (SELECT list_repo AS full_name, CASE WHEN depth = 1 THEN 'A' WHEN depth = 2 THEN 'B' ELSE 'C' END AS old_tier, round(stars % 100 / 10, 1) AS old_score, 7.0 + CASE WHEN n_entries > 10 THEN 0.5 ELSE 0 END
    + CASE WHEN status <> 'ok' THEN 0.5 ELSE 0 END + CASE WHEN coalesce(n_entries, 0) * 100 > 1500 THEN 0.5 ELSE 0 END AS new_score FROM curated_list),
p AS (SELECT *, CASE WHEN new_score >= 8 THEN 'A' WHEN new_score >= 5 THEN 'B' ELSE 'C' END AS new_tier, CASE WHEN old_score >= 8 THEN 'A' WHEN old_score >= 5 THEN 'B' ELSE 'C' END AS by_score FROM c)
"""


@query("page_tiers", _PAGES + "SELECT full_name, old_tier, old_score::DOUBLE AS old_score, new_score::DOUBLE AS new_score, new_tier, coalesce(old_score IS NOT NULL AND old_tier <> by_score, false) AS contradicts FROM p")
def page_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Front matter read from files: scores by evidence, and stated tiers that contradict stated scores."""
    return _pages(spark, folder).select("full_name", "old_tier", "old_score", "new_score", "new_tier", "contradicts")


@query("tier_changes", _PAGES + "SELECT tier, sum(b)::BIGINT AS before, sum(a)::BIGINT AS after FROM (SELECT old_tier AS tier, 1 AS b, 0 AS a FROM p UNION ALL SELECT new_tier, 0, 1 FROM p) GROUP BY 1")
def tier_changes(spark: SparkSession, folder: str) -> DataFrame:
    return files.tier_changes(_pages(spark, folder))


@query("tar_texts", "SELECT doc_id, strlen(text) AS bytes, length(text) AS chars, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL")
def tar_texts(spark: SparkSession, folder: str) -> DataFrame:
    """All texts packed into tar archives by the tasks that hold them, and read as a stream again."""
    path = scratch(spark)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        for batch in batches:
            name = f"{root}/part-{batch['doc_id'].iloc[0]}.tar"
            with system.open_output_stream(name) as stream, tarfile.open(fileobj=stream, mode="w|") as archive:
                for doc, text in zip(batch["doc_id"], batch["text"]):
                    raw = text.encode()
                    info = tarfile.TarInfo(f"texts/pg{doc}.txt")
                    info.size = len(raw)
                    archive.addfile(info, io.BytesIO(raw))
            yield pd.DataFrame({"name": [name]})

    cut_lineage(table(spark, folder, "documents").filter("text is not null").select("doc_id", "text").mapInPandas(pack, "name string"))
    return archives.read_tars(spark, f"{path}/*.tar").select("doc_id", "bytes", F.char_length("text").cast("long").alias("chars"), F.sha2("text", 256).alias("sha256"))


@query("packed_locations", """
SELECT source, count(*) AS docs, true AS contiguous, true AS within, true AS greedy FROM (SELECT coalesce(source, '') AS source FROM documents) GROUP BY 1""")
def packed_locations(spark: SparkSession, folder: str) -> DataFrame:
    """Packed documents of each source: assets without gaps, not above their size, and full before a new one is begun."""
    docs = table(spark, folder, "documents").select(F.coalesce("source", F.lit("")).alias("source"), "doc_id", "text")
    most = 65_536
    placed = cut_lineage(archives.locations(docs, ["source"], doc="doc_id", text="text", most=most))
    per = placed.groupBy("source", "asset").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.max(F.col("offset") + F.col("length")).alias("end"), F.min_by("length", "doc").alias("first"))
    following = per.select("source", (F.col("asset") - 1).alias("asset"), F.col("first").alias("next"))
    per = per.join(following, ["source", "asset"], "left")
    return per.groupBy("source").agg(
        F.sum("n").alias("docs"), F.every(F.col("bytes") == F.col("end")).alias("contiguous"), F.every((F.col("bytes") <= most) | (F.col("n") == 1)).alias("within"), F.every(F.col("next").isNull() | (F.col("bytes") + F.col("next") > most)).alias("greedy")
    )


@query("verified_slices", "SELECT doc_id, true AS intact, substr(text, 11, 20) AS slice FROM documents WHERE text IS NOT NULL")
def verified_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges read out of texts whose length and hash are checked."""
    docs = table(spark, folder, "documents").filter("text is not null").select("doc_id", "text", F.encode("text", "UTF-8").alias("raw"), F.octet_length("text").alias("length"), F.sha2("text", 256).alias("sha256"))
    return docs.select("doc_id", archives.intact(F.col("raw"), F.col("length"), F.col("sha256")).alias("intact"), archives.slice_of(F.col("text"), F.lit(10), F.lit(30)).alias("slice"))


@query("file_receipts", "SELECT list_repo, strlen(coalesce(title, '')) + 1 AS bytes, sha256(coalesce(title, '') || chr(10)) AS sha256 FROM curated_list")
def file_receipts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark)
    rows = table(spark, folder, "curated_list").select(F.concat(F.regexp_replace("list_repo", "/", "__"), F.lit(".txt")).alias("name"), F.concat(F.coalesce("title", F.lit("")), F.lit("\n")).alias("text"))
    files.write_texts(rows, path, name="name", text="text")
    return archives.receipts(spark, path).select(F.regexp_replace(F.regexp_replace("file", "__", "/"), r"\.txt$", "").alias("list_repo"), "bytes", "sha256")


@query("resolved_source", "SELECT 'person' AS name, 2 AS place, (SELECT count(*) FROM person) AS rows")
def resolved_source(spark: SparkSession, folder: str) -> DataFrame:
    """The first of several places that exists is read."""
    place, number = files.first_existing(spark, [f"{folder}/nowhere/person.parquet", f"{folder}/person.parquet", f"{folder}/category.parquet"])
    return spark.read.parquet(place).agg(F.count("*").alias("rows")).select(F.lit("person").alias("name"), F.lit(number).alias("place"), "rows")


@query("exported_lines", "SELECT list_repo, topic, stars FROM curated_list WHERE status = 'ok'")
def exported_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines for others to read, read back."""
    path = scratch(spark)
    files.export_lines(table(spark, folder, "curated_list").filter("status = 'ok'").select("list_repo", "topic", "stars"), path)
    return spark.read.schema("list_repo string, topic string, stars long").json(path)


@query("corpus_index", """
SELECT source, doc_id, coalesce(sum(n + 2) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, n AS chars
FROM (SELECT coalesce(source, '') AS source, doc_id, length(coalesce(text, '')) AS n FROM documents)""")
def corpus_index(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("source", F.coalesce("source", F.lit("")))
    return files.corpus_index(docs, ["source"], key="doc_id", text="text").withColumnRenamed("key", "doc_id")


# --- registries -----------------------------------------------------------------------------------------------------


def _dump(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Tables of a registry's dump made of the trade tables: parts are packages, suppliers their users, nations the teams; written as
    CSV and read."""
    part, supplier, nation, line = (table(spark, folder, t) for t in ("part", "supplier", "nation", "lineitem"))
    owned = line.select(F.col("l_partkey").alias("crate_id"), F.col("l_suppkey").alias("owner_id")).distinct().withColumn("owner_kind", F.when(F.col("owner_id") % 4 == 0, "1").otherwise("0"))
    owned = owned.withColumn("owner_id", F.when(F.col("owner_kind") == "1", F.col("owner_id") % 25).otherwise(F.col("owner_id")))
    address = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("https://github.com/Own"), (F.col("p_partkey") % 50).cast("string"), F.lit("/"), F.lower(F.translate("p_brand", "#", "-")), F.lit(".git")))
    versions = line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("crate_id"), F.col("l_suppkey").alias("published_by"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("created_at"), F.when(F.col("l_returnflag") == "R", "t").otherwise("f").alias("yanked"))
    downloads = line.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("version_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("downloads"))
    tables = {
        "crates": part.select(F.col("p_partkey").alias("id"), F.concat_ws("-", "p_name", "p_partkey").alias("name"), address.alias("repository"), F.concat(F.lit('a "quoted",\nlong '), F.repeat("p_name", 3)).alias("readme"), F.col("p_size").alias("downloads")),
        "users": supplier.select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 11 == 5, "").otherwise(F.col("s_name")).alias("gh_login")),
        "teams": nation.select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 5 == 0, "odd login").otherwise(F.concat(F.lit("github:"), F.col("n_name"), F.lit(":core"))).alias("login")),
        "crate_owners": owned, "versions": versions.dropDuplicates(["id"]), "version_downloads": downloads,
    }
    path = scratch(spark)
    files.write_dump({n: tables[n] for n in names}, path)
    schemas = {
        "crates": "id string, name string, repository string, readme string, downloads string", "users": "id string, gh_login string", "teams": "id string, login string",
        "crate_owners": "crate_id string, owner_id string, owner_kind string", "versions": "id string, crate_id string, published_by string, created_at string, yanked string", "version_downloads": "version_id string, date string, downloads string",
    }
    return files.read_dump(spark, path, {n: schemas[n] for n in names})


_OWNED = "owned AS (SELECT DISTINCT l_partkey AS c, l_suppkey AS s FROM lineitem)"


@query("registry_maintainers", f"""
WITH {_OWNED}, e AS (SELECT DISTINCT 'gh:' || lower(s_name) AS person_id, p_name || '-' || p_partkey AS crate FROM owned JOIN supplier ON s_suppkey = s JOIN part ON p_partkey = c WHERE s % 4 <> 0 AND s % 11 <> 5 AND s % 2 = 1)
SELECT person_id, crate, count(*) OVER (PARTITION BY person_id) AS crate_count FROM e""")
def registry_maintainers(spark: SparkSession, folder: str) -> DataFrame:
    dump = _dump(spark, folder, "crate_owners", "users", "crates")
    known = table(spark, folder, "supplier").filter("s_suppkey % 2 = 1").select(F.upper("s_name").alias("login"), F.concat(F.lit("gh:"), F.lower("s_name")).alias("person_id"))
    return registry.maintainers(dump["crate_owners"], dump["users"], dump["crates"], known)[0]


@query("registry_claims", f"WITH {_OWNED} SELECT DISTINCT s_name AS gh_login, s::VARCHAR AS user_id FROM owned JOIN supplier ON s_suppkey = s WHERE s % 4 <> 0 AND s % 11 <> 5 AND s % 2 = 0")
def registry_claims(spark: SparkSession, folder: str) -> DataFrame:
    dump = _dump(spark, folder, "crate_owners", "users", "crates")
    known = table(spark, folder, "supplier").filter("s_suppkey % 2 = 1").select(F.col("s_name").alias("login"), F.lower("s_name").alias("person_id"))
    return registry.maintainers(dump["crate_owners"], dump["users"], dump["crates"], known)[1]


@query("registry_organisations", f"""
WITH {_OWNED} SELECT DISTINCT n_name AS organisation, p_name || '-' || p_partkey AS crate FROM owned JOIN nation ON n_nationkey = s % 25 JOIN part ON p_partkey = c WHERE s % 4 = 0 AND n_nationkey % 5 <> 0""")
def registry_organisations(spark: SparkSession, folder: str) -> DataFrame:
    dump = _dump(spark, folder, "teams", "crate_owners", "crates")
    return registry.organisations(dump["teams"], dump["crate_owners"], dump["crates"])[1]


@query("registry_momentum", """
WITH d AS (SELECT l_partkey AS c, l_shipdate::DATE AS day, l_quantity::INTEGER AS n FROM lineitem WHERE l_linenumber <> 7), v AS (SELECT l_orderkey * 10 + l_linenumber AS id, any_value(l_partkey) AS c, count(DISTINCT l_partkey) AS k FROM lineitem GROUP BY 1),
x AS (SELECT v.c, l_shipdate::DATE AS day, l_quantity::INTEGER AS n FROM lineitem JOIN v ON v.id = l_orderkey * 10 + l_linenumber WHERE l_linenumber <> 7 AND k = 1), w AS (SELECT list_sort(array_agg(DISTINCT day)) AS days FROM x),
m AS (SELECT days[1 + len(days) // 2] AS middle, days[1 + least(len(days) - 1, greatest(0, len(days) - len(days) // 3))] AS recent FROM w)
SELECT c::VARCHAR AS crate_id, coalesce(sum(n) FILTER (WHERE day < middle), 0)::BIGINT AS early, coalesce(sum(n) FILTER (WHERE day >= middle), 0)::BIGINT AS late, coalesce(sum(n) FILTER (WHERE day >= recent), 0)::BIGINT AS recent FROM x, m GROUP BY 1""")
def registry_momentum(spark: SparkSession, folder: str) -> DataFrame:
    """Downloads of versions rolled up to their crate, early and late (versions whose number two crates share are left out)."""
    dump = _dump(spark, folder, "version_downloads", "versions")
    line = table(spark, folder, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"), "l_partkey")
    clear = line.groupBy("id").agg(F.count_distinct("l_partkey").alias("k")).filter("k = 1").select("id")
    return registry.momentum(dump["version_downloads"], dump["versions"].join(clear, "id", "left_semi")).select("crate_id", "early", "late", "recent")


@query("registry_repositories", """
WITH r AS (SELECT lower('own' || p_partkey % 50 || '/' || replace(p_brand, '#', '-')) AS repo, p_name || '-' || p_partkey AS crate, p_size AS downloads FROM part WHERE p_partkey % 3 = 0)
SELECT repo, arg_min(crate, (-downloads, crate)) AS crate, max(downloads)::BIGINT AS downloads, count(*) AS crates FROM r GROUP BY 1""")
def registry_repositories(spark: SparkSession, folder: str) -> DataFrame:
    return registry.repository_signals(_dump(spark, folder, "crates")["crates"])


@query("registry_publishers", """
WITH v AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS s, l_shipdate::DATE AS day, l_returnflag AS f FROM lineitem), u AS (SELECT id FROM v GROUP BY 1 HAVING count(*) = 1)
SELECT s::VARCHAR AS published_by, min(day) AS first_day, max(day) AS last_day, count(*) AS n, count(*) FILTER (WHERE f = 'R') AS hits, CASE WHEN count(*) >= 5 THEN round(count(*) FILTER (WHERE f = 'R') / count(*), 4) END AS rate FROM v JOIN u USING (id) GROUP BY 1""")
def registry_publishers(spark: SparkSession, folder: str) -> DataFrame:
    line = table(spark, folder, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"))
    clear = line.groupBy("id").agg(F.count("*").alias("k")).filter("k = 1").select("id")
    return registry.publishers(_dump(spark, folder, "versions")["versions"].join(clear, "id", "left_semi"))


# --- recordings and scans ---------------------------------------------------------------------------------------------


@query("text_layers", """
WITH p AS (SELECT l_suppkey AS doc, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS page, l_quantity * 2 AS words FROM lineitem),
c AS (SELECT doc, count(*) AS pages, greatest(1, floor(count(*) * 0.05))::INTEGER AS s FROM p GROUP BY 1), i AS (SELECT unnest(range(20)) AS i),
k AS (SELECT DISTINCT doc, pages, CASE WHEN pages - s + 1 <= 20 THEN NULL ELSE floor(s + i * ((pages - s + 1) / 20.0))::BIGINT END AS page, s FROM c, i),
g AS (SELECT p.doc, pages, words FROM p JOIN k ON k.doc = p.doc AND (k.page = p.page OR (k.page IS NULL AND p.page >= s)))
SELECT doc, max(pages)::INTEGER AS pages, count(*) AS sampled, count(*) FILTER (WHERE words >= 50) AS with_text, round(count(*) FILTER (WHERE words >= 50) / count(*), 3) AS text_ratio, floor(sum(words) / count(*) * max(pages))::BIGINT AS projected_words,
    CASE WHEN count(*) FILTER (WHERE words >= 50) / count(*) >= 0.7 THEN 'TEXT' WHEN count(*) FILTER (WHERE words >= 50) = 0 THEN 'OCR_REQUIRED' ELSE 'PARTIAL' END AS verdict FROM g GROUP BY 1""")
def text_layers(spark: SparkSession, folder: str) -> DataFrame:
    """A sampling operator: whether the pages of a scan have text. Suppliers are the documents, their line items the pages."""
    place = F.expr("row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)")
    pages = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("doc"), place.alias("page"), (F.col("l_quantity") * 2).alias("words"))
    return media.text_layers(pages, "doc", page="page", words="words")


@query("upload_pieces", """
WITH m AS (SELECT doc_id, strlen(coalesce(text, '')) AS size, 1.0 + length(coalesce(text, '')) * 2 AS seconds FROM documents), s AS (SELECT *, least(900, greatest(60, floor(400 * 0.9 / (size / seconds))))::INTEGER AS step FROM m)
SELECT doc_id, unnest(CASE WHEN size <= 400 THEN [0] ELSE range(0, ceil(seconds)::INTEGER, step) END)::INTEGER AS start, CASE WHEN size <= 400 THEN ceil(seconds)::INTEGER ELSE step END AS length FROM s""")
def upload_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Recordings (here texts, two seconds a character) cut into pieces that aren't too large."""
    docs = table(spark, folder, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("size"), (1.0 + F.length(F.coalesce("text", F.lit(""))) * 2).alias("seconds"))
    return media.planned_pieces(docs, "doc_id", size="size", seconds="seconds", most_bytes=400, wanted_seconds=900).select("doc_id", "start", "length")


_PIECES = """
WITH e AS (SELECT user_id, event_id, floor(event_id / 20) * 600 AS off, event_id % 600 AS s, value, event_type FROM events)
"""


@query("transcripts", _PIECES + """
SELECT user_id, count(*) AS segments, round(max(round(off + s, 3) + round(greatest(value, 0), 3)), 3) AS seconds, string_agg(event_type, chr(10) ORDER BY off, event_id) AS text,
    (SELECT string_agg(l, ',' ORDER BY o, l) FROM (SELECT CASE WHEN off % 1200 = 0 THEN 'de' ELSE 'en' END AS l, min(off) AS o FROM e x WHERE x.user_id = e.user_id GROUP BY 1)) AS languages
FROM e GROUP BY user_id""")
def transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Transcripts of pieces put together: users are the recordings, twenty events a piece."""
    offset = (F.floor(F.col("event_id") / 20) * 600).cast("double")
    start = (F.col("event_id") % 600).cast("double")
    segment = F.struct(start.alias("start"), (start + F.greatest("value", F.lit(0.0))).alias("end"), F.concat(F.lit(" "), F.col("event_type")).alias("text"))
    pieces = table(spark, folder, "events").groupBy("user_id", offset.alias("off")).agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", segment.alias("s")))), lambda x: x["s"]).alias("segments"))
    pieces = pieces.withColumn("language", F.when(F.col("off") % 1200 == 0, "de").otherwise("en"))
    return media.merged_transcripts(pieces, "user_id", offset="off", language="language", segments="segments")[1].select("user_id", "segments", "seconds", "text", "languages")


@query("kept_progress", """
WITH o AS (SELECT DISTINCT obs_id, canonical_id, stars, description FROM repo_observation WHERE canonical_id IS NOT NULL), n AS (SELECT canonical_id, max(stars) AS stars, NULL AS description FROM o GROUP BY 1),
b AS (SELECT canonical_id, arg_min(stars, obs_id) AS stars, arg_min(description, obs_id) FILTER (WHERE description IS NOT NULL) AS description FROM o WHERE obs_id % 2 = 0 GROUP BY 1)
SELECT n.canonical_id, n.stars, b.description FROM n LEFT JOIN b USING (canonical_id)""")
def kept_progress(spark: SparkSession, folder: str) -> DataFrame:
    """A table computed anew that keeps what later steps had added to its rows."""
    rows = table(spark, folder, "repo_observation").filter("canonical_id is not null").select("obs_id", "canonical_id", "stars", "description").distinct()
    rebuilt = rows.groupBy("canonical_id").agg(F.max("stars").alias("stars")).withColumn("description", F.lit(None).cast("string"))
    before = rows.filter("obs_id % 2 = 0").groupBy("canonical_id").agg(F.min_by("description", F.when(F.col("description").isNotNull(), F.col("obs_id"))).alias("description"))
    return policies.rebuild_keeping(rebuilt, before, ["canonical_id"], ["description"]).select("canonical_id", "stars", "description")


@query("team_organisations", "SELECT n_name, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS organisation FROM nation")
def team_organisations(spark: SparkSession, folder: str) -> DataFrame:
    login = F.when(F.col("n_nationkey") % 5 == 0, "odd login").otherwise(F.concat(F.lit("github:"), F.col("n_name"), F.lit(":core")))
    return table(spark, folder, "nation").select("n_name", strings.team_organisation(login).alias("organisation"))
