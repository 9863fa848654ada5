"""Package registries: maintainers, organisations, momentum, publishers and repositories, from the tables of a registry's dump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.strings import team_organisation
from quillmesh.functions.urls import repository_from_url
from quillmesh.operators.aggregates import rate_per_key, trend


def maintainers(owners: DataFrame, users: DataFrame, crates: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (person_id, crate, crate_count) of the people that the graph knows by login, and claims (login, user_id) for the others.

    ``owners`` has (crate_id, owner_id, owner_kind), of which kind 0 is a person; ``users`` (id, gh_login); ``crates`` (id, name);
    ``known`` (login, person_id). Logins are compared without case; users without one give nothing.
    """
    people = owners.filter("trim(owner_kind) = '0' and owner_id is not null and crate_id is not null").select("crate_id", F.col("owner_id").alias("user_id")).distinct()
    logins = users.select(F.col("id").alias("user_id"), F.trim("gh_login").alias("gh_login")).filter("gh_login <> ''")
    owned = people.join(logins, "user_id").withColumn("login", F.lower("gh_login"))
    found = owned.join(known.select(F.lower("login").alias("login"), "person_id").distinct(), "login", "left")
    edges = found.filter("person_id is not null").join(crates.select(F.col("id").alias("crate_id"), "name"), "crate_id", "left")
    edges = edges.select("person_id", F.coalesce("name", "crate_id").alias("crate")).distinct()
    counts = edges.groupBy("person_id").agg(F.count("*").alias("crate_count"))
    claims = found.filter("person_id is null").select("gh_login", "user_id").distinct()
    return edges.join(counts, "person_id"), claims


def organisations(teams: DataFrame, owners: DataFrame, crates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Organisations of the team logins with the number of their teams, and their edges (organisation, crate)."""
    parsed = teams.select(F.col("id").alias("owner_id"), team_organisation(F.col("login")).alias("organisation")).filter("organisation is not null")
    owned = owners.filter("trim(owner_kind) = '1'").select("crate_id", "owner_id").distinct()
    edges = owned.join(parsed, "owner_id").join(crates.select(F.col("id").alias("crate_id"), F.col("name").alias("crate")), "crate_id").filter("crate <> ''")
    return parsed.groupBy("organisation").agg(F.count("*").alias("teams")), edges.select("organisation", "crate").distinct()


def momentum(downloads: DataFrame, versions: DataFrame) -> DataFrame:
    """Per crate its downloads before and from the middle of the days that occur, of the last third of them, and the trend."""
    rows = downloads.select("version_id", F.to_date("date").alias("day"), F.trim("downloads").try_cast("bigint").alias("n")).filter("n >= 0 and day is not null")
    return trend(rows.join(versions.select(F.col("id").alias("version_id"), "crate_id"), "version_id"), ["crate_id"], day="day", amount="n")


def repository_signals(crates: DataFrame) -> DataFrame:
    """Per repository the crate with most downloads (of equals the first by name), its downloads, and how many crates name it."""
    rows = crates.select(repository_from_url(F.col("repository")).alias("repo"), "name", F.col("downloads").try_cast("bigint").alias("downloads")).filter("repo is not null")
    order = F.struct((-F.coalesce("downloads", F.lit(-1))).alias("d"), F.col("name").alias("n"))
    return rows.groupBy("repo").agg(F.min_by("name", order).alias("crate"), F.max("downloads").alias("downloads"), F.count("*").alias("crates"))


def publishers(versions: DataFrame, *, least: int = 5) -> DataFrame:
    """Per publisher the first and last day, the number of versions and yanked ones, and the rate of these from ``least`` versions on."""
    rows = versions.filter("published_by is not null").withColumn("day", F.to_date("created_at"))
    rates = rate_per_key(rows, ["published_by"], F.lower("yanked").isin("t", "true", "1"), least=least)
    return rows.groupBy("published_by").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day")).join(rates, "published_by")
