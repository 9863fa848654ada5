"""People from several sources as one graph, and the value of owners over several axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.numbers import clamped, half_life_freshness, log_scale
from quillmesh.functions.strings import squeeze
from quillmesh.operators.joins import by_number


def folded_name(name: Column) -> Column:
    return F.lower(squeeze(name))


def built_graph(known: DataFrame, books: DataFrame, known_edges: DataFrame, book_edges: DataFrame, subjects: DataFrame) -> dict[str, DataFrame]:
    """The graph of people from a graph that exists and a catalogue of books: tables person, edge and topic.

    ``known`` has (person_id, name, origin, birth_year, death_year); ``books`` (person_key, name, birth_year, death_year, works),
    corporate authors left out; ``known_edges`` (person_id, domain, content_ref, role); ``book_edges`` (person_key, gid, role);
    ``subjects`` (gid, subject). A person of the books who has the folded name of a known one is that one, of several the
    smallest; others get the id "bk:" and the smallest key of their name. Years of life are filled where unknown, from the
    first by key. A person without any edge is "tracked", others "linked". Topics are weighted by the number of works.
    """
    names = known.filter(F.trim("name") != "").groupBy(folded_name(F.col("name")).alias("_n")).agg(F.min("person_id").alias("_known"))
    keyed = books.withColumn("_n", folded_name(F.col("name"))).filter("_n <> ''")
    first = keyed.groupBy("_n").agg(F.min("person_key").alias("_first"))
    keyed = keyed.join(names, "_n", "left").join(first, "_n").withColumn("person_id", F.coalesce("_known", F.concat(F.lit("bk:"), F.col("_first"))))
    dated = keyed.filter("birth_year is not null").groupBy("person_id").agg(F.min_by(F.struct("birth_year", "death_year"), "person_key").alias("_life"))
    new = keyed.filter("_known is null and person_key = _first").select("person_id", "name", F.lit("books").alias("origin"), "birth_year", "death_year")
    people = known.select("person_id", "name", "origin", "birth_year", "death_year").unionByName(new).join(dated, "person_id", "left")
    unknown = F.col("birth_year").isNull() & F.col("_life").isNotNull()
    people = people.withColumn("death_year", F.when(unknown, F.col("_life.death_year")).otherwise(F.col("death_year"))).withColumn("birth_year", F.coalesce("birth_year", "_life.birth_year")).drop("_life")
    of_books = book_edges.join(keyed.select("person_key", "person_id"), "person_key").select("person_id", F.lit("book").alias("domain"), F.col("gid").cast("string").alias("content_ref"), "role")
    edges = of_books.unionByName(known_edges.select("person_id", "domain", "content_ref", "role")).distinct()
    linked = edges.select("person_id").distinct().withColumn("_linked", F.lit(True))
    people = people.join(linked, "person_id", "left").withColumn("state", F.when(F.col("_linked"), "linked").otherwise("tracked")).drop("_linked")
    topics = by_number(edges.filter("domain = 'book'"), subjects, text="content_ref", number="gid").groupBy("person_id", F.col("subject").alias("topic")).agg(F.count("*").alias("weight"))
    return {"person": people, "edge": edges, "topic": topics}


def owners_from_passes(cards: DataFrame, placements: DataFrame, adoption: DataFrame) -> DataFrame:
    """Three scans folded by owner and put together: what has no card is dropped.

    ``cards`` has (owner, full_name, stars, is_clean, pushed); ``placements`` (owner, hit, value, lift, category_id); ``adoption``
    (owner, downloads, dependents). Values and lifts are 0 to 100; missing ones count as 0.
    """
    zero = F.lit(0)
    a = cards.groupBy("owner").agg(
        F.count("*").alias("n_repos"), F.max(F.coalesce("stars", zero)).alias("max_stars"), F.sum(F.coalesce("stars", zero)).alias("total_stars"),
        F.min_by("full_name", F.struct((-F.coalesce("stars", zero)).alias("s"), F.col("full_name").alias("n"))).alias("top_repo"), F.count_if("is_clean").alias("n_clean"), F.max("pushed").alias("latest_push"),
    )
    b = placements.groupBy("owner").agg(
        F.count("*").alias("n_cat"), F.sum(F.coalesce("hit", zero)).alias("hits"), F.count_if(F.col("value") >= 85).alias("v85"), F.max(F.coalesce("value", zero)).alias("max_value"),
        F.max(F.coalesce("lift", zero)).alias("max_lift"), F.count_distinct(F.when(F.col("value") >= 70, F.col("category_id"))).alias("categories"),
    )
    c = adoption.groupBy("owner").agg(F.max("downloads").alias("downloads"), F.max("dependents").alias("dependents"))
    return a.join(b, "owner", "left").join(c, "owner", "left").na.fill(0, ["n_cat", "hits", "v85", "max_value", "max_lift", "categories", "downloads", "dependents"])


#: Weights of the axes (their sum is 1), the scales of their logarithms, and what full adoption adds.
AXES = {"volume": 0.22, "peak": 0.30, "breadth": 0.13, "density": 0.18, "freshness": 0.09, "license": 0.08}
SCALES = {"volume": 52.0, "fame": 20.0, "breadth": 64.0, "density": 42.0, "downloads": 11.0, "dependents": 15.0}
ADOPTION_BONUS = 14.0


def with_value(owners: DataFrame, as_of: Column, *, weights: dict[str, float] | None = None, scales: dict[str, float] | None = None, bonus: float = ADOPTION_BONUS, floor: int = 5) -> DataFrame:
    """``owners`` with the axes volume, peak, breadth, density, freshness and license (0 to 100), adoption, and their value.

    The value is the weighted mean of the axes, and adoption adds up to ``bonus``: its absence costs nothing. Density is the
    share of hits, or their number where that says more; below ``floor`` placements it shrinks in proportion.
    """
    weights, scales = weights or AXES, scales or SCALES
    n, hits = F.col("n_cat"), F.col("hits")
    share = clamped(F.try_divide(hits, n) * 100.0)
    axes = {
        "volume": log_scale(hits + 0.4 * F.col("v85") + 0.15 * n, scales["volume"]),
        "peak": clamped(0.55 * F.greatest("max_value", "max_lift") + 0.45 * log_scale(F.col("max_stars"), scales["fame"])),
        "breadth": log_scale(F.col("categories"), scales["breadth"]),
        "density": F.when(n >= floor, F.greatest(share, log_scale(hits, scales["density"]))).when(n > 0, share * n / floor).otherwise(0.0),
        "freshness": clamped(half_life_freshness(F.col("latest_push").try_cast("date"), as_of)),
        "license": F.greatest(F.lit(30.0), clamped(F.col("n_clean") / F.col("n_repos") * 100.0)),
    }
    adoption = clamped(0.6 * log_scale(F.col("downloads"), scales["downloads"]) + 0.4 * log_scale(F.col("dependents"), scales["dependents"]))
    out = owners.select("*", *[c.alias(name) for name, c in axes.items()], adoption.alias("adoption"))
    base = sum((F.lit(w) * F.col(name) for name, w in weights.items()), F.lit(0.0))
    return out.withColumn("value", clamped(base + bonus * F.col("adoption") / 100.0))


def owner_kinds(owners: DataFrame, *, login: str, repositories: str, hints: list[str], least: int = 60) -> DataFrame:
    """``owners`` with kind "organisation" where the login has a hint in it or there are ``least`` repositories, else "human"."""
    low = F.lower(login)
    hinted = F.exists(F.array(*[F.lit(h) for h in hints]), lambda h: F.contains(low, h))
    return owners.withColumn("kind", F.when(hinted | (F.col(repositories) >= least), "organisation").otherwise("human"))


def external_ids(profiles: DataFrame, *, person: str, platforms: dict[str, float]) -> DataFrame:
    """Identifiers of profiles as rows (person, platform, value, confidence); {column: confidence}; empty ones are left out."""
    entries = F.array(*[F.struct(F.lit(p).alias("platform"), F.trim(F.col(p).cast("string")).alias("value"), F.lit(c).alias("confidence")) for p, c in platforms.items()])
    return profiles.select(F.col(person), F.explode(entries).alias("_e")).select(person, "_e.*").filter("value <> ''").distinct()


def united_people(sources: list[tuple[str, DataFrame]], *, score: Column) -> DataFrame:
    """People of several sources (name, n, lift, hits; in order of precedence) as one row per folded name: the first source's
    spelling, the sources, and a score over the sums, which the caller gives."""
    parts = [df.select(F.col("name"), F.col("n"), F.col("lift"), F.col("hits")).withColumn("source", F.lit(name)).withColumn("_order", F.lit(i)) for i, (name, df) in enumerate(sources)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    per = rows.filter(F.trim("name") != "").groupBy(folded_name(F.col("name")).alias("key")).agg(
        F.min_by("name", F.struct("_order", F.col("name").alias("t"))).alias("name"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max("lift").alias("lift")
    )
    return per.withColumn("score", score)
