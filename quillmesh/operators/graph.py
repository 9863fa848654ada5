"""Identities and edges: sightings to identities and cards, claims, merges, layers, signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions.numbers import repeated_confidence
from quillmesh.functions.strings import parts_of_plain_name, plain_name
from quillmesh.operators.joins import within_tolerance
from quillmesh.operators.policies import one_per_key
from quillmesh.storage import cut_lineage


def identities(sightings: DataFrame, *, identity: str, unique: list[str], at: str, order: list[Column]) -> DataFrame:
    """One row per identity of the sightings, each unique once: first and last seen, sightings, sources, confidence."""
    rows = one_per_key(sightings.filter(F.col(identity).isNotNull()), unique, order)
    out = rows.groupBy(identity).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("sightings"), F.count_distinct("source").alias("sources"))
    return out.withColumn("confidence", repeated_confidence(F.col("sightings")))


def best_rows(df: DataFrame, keys: list[str], weights: dict[str, int], order: list[Column]) -> DataFrame:
    """The row of each key that has most of the weighted fields, then by ``order``; with its field_score."""
    score = sum((F.when(F.trim(F.col(c).cast("string")) != "", w).otherwise(0) for c, w in weights.items()), F.lit(0))
    return one_per_key(df.withColumn("field_score", score), keys, [F.desc("field_score"), *order])


def claims(people: DataFrame, identifiers: DataFrame | None, *, person: str, name: str, birth: str, death: str, origin: str, tolerance: float = 2.0) -> DataFrame:
    """Proposed matches (person_a < person_b, method, confidence), the strongest for each pair; never a merge.

    .98 for a shared identifier; for a shared plain name .90 where years of both are known and agree, .55 where not, of
    different origins; .45 for surname (4 letters or more) and initial, of different origins, years agreeing. The pairs are
    the result, so it grows with the square of a group of equal names; equi-joins on the name, split by AQE where skewed.
    """
    rows = people.select(F.col(person).alias("p"), F.col(birth).alias("b"), F.col(death).alias("d"), F.col(origin).alias("o"), plain_name(F.col(name)).alias("n"))
    rows = rows.withColumn("_parts", parts_of_plain_name(F.col("n")))
    rows = cut_lineage(rows.select("p", "b", "d", "o", "n", F.col("_parts.surname").alias("s"), F.substring("_parts.given", 1, 1).alias("i")))
    a, c = rows.alias("a"), rows.alias("c")
    agree = within_tolerance(F.col("a.b"), F.col("c.b"), tolerance) & within_tolerance(F.col("a.d"), F.col("c.d"), tolerance)
    ordered = (F.col("a.p") < F.col("c.p")) & agree
    dated = F.coalesce("a.b", "a.d").isNotNull() & F.coalesce("c.b", "c.d").isNotNull()
    apart = F.coalesce(F.col("a.o") != F.col("c.o"), F.lit(False))
    by_name = a.join(c, (F.col("a.n") == F.col("c.n")) & (F.col("a.n") != "") & ordered & (dated | apart))
    by_name = by_name.select(F.col("a.p").alias("person_a"), F.col("c.p").alias("person_b"), F.when(dated, "name_plus_years").otherwise("exact_name").alias("method"), F.when(dated, 0.9).otherwise(0.55).alias("confidence"))
    by_initial = a.join(c, (F.col("a.s") == F.col("c.s")) & (F.col("a.i") == F.col("c.i")) & (F.length("a.s") >= 4) & ordered & apart)
    by_initial = by_initial.select(F.col("a.p").alias("person_a"), F.col("c.p").alias("person_b"), F.lit("surname_initial").alias("method"), F.lit(0.45).alias("confidence"))
    all_claims = by_name.union(by_initial)
    if identifiers is not None:
        ids = identifiers.select(F.col(person).alias("p"), "platform", F.lower("value").alias("v")).filter("v is not null").distinct()
        shared = ids.alias("a").join(ids.alias("c"), F.expr("a.platform = c.platform and a.v = c.v and a.p < c.p"))
        all_claims = all_claims.union(shared.select(F.col("a.p"), F.col("c.p"), F.lit("shared_external_id"), F.lit(0.98)).distinct())
    best = F.max(F.struct("confidence", "method")).alias("m")
    return all_claims.groupBy("person_a", "person_b").agg(best).select("person_a", "person_b", "m.method", "m.confidence")


def merged_targets(people: DataFrame, *, person: str, target: str, most_rounds: int = 32) -> DataFrame:
    """(person, final) of merged people: chains followed to their end, each round doubling the steps taken. A circle raises."""
    moves = people.filter(F.col(target).isNotNull()).select(F.col(person).alias("person"), F.col(target).alias("final")).distinct()
    out = cut_lineage(moves)
    for done in range(most_rounds):
        step = out.select(F.col("person").alias("final"), F.col("final").alias("_next"))
        if out.join(step, "final", "left_semi").isEmpty():
            return out
        if not out.filter("person = final").isEmpty() or (done > 4 and 2 ** (done - 1) > moves.count()):
            break
        out = cut_lineage(out.join(step, "final", "left").select("person", F.coalesce("_next", "final").alias("final")))
    raise ValueError("merges go in a circle, or in chains of more than 2 ** most_rounds")


def layers(people: DataFrame, edges: DataFrame, *, person: str, state: str, domain: str) -> DataFrame:
    """Per person that isn't merged the number of domains, those that begin with youtube as one, and of edges."""
    folded = F.when(F.col(domain).startswith("youtube"), "youtube").otherwise(F.col(domain))
    per = edges.groupBy(person).agg(F.count_distinct(folded).alias("domains"), F.count("*").alias("edges"))
    alive = people.filter(F.coalesce(F.col(state), F.lit("")) != "merged").select(person)
    return alive.join(per, person, "left").na.fill(0, ["domains", "edges"])


def owner_profiles(repositories: DataFrame, *, full_name: str, order: str, signals: dict[str, Column]) -> DataFrame:
    """One row per owner, compared without case: the login as first seen by ``order``, repositories, and the signals."""
    owner = F.substring_index(F.col(full_name), "/", 1)
    rows = repositories.filter(F.instr(F.col(full_name), "/") > 1).withColumn("_o", owner)
    aggregates = [e.alias(n) for n, e in signals.items()]
    return rows.groupBy(F.lower("_o").alias("owner")).agg(F.min_by("_o", F.struct(order, "_o")).alias("login"), F.count("*").alias("repositories"), *aggregates)


def directed_relations(facts: DataFrame, subject: str, properties: dict[str, tuple[str, str]]) -> DataFrame:
    """Edges (person_a, person_b, relation, direction) of properties of a subject; {property: (relation, direction)}."""
    parts = []
    for column, (relation, direction) in properties.items():
        targets = facts.select(F.col(subject).alias("person_a"), F.explode(column).alias("person_b"))
        parts.append(targets.filter("person_b is not null").select("person_a", "person_b", F.lit(relation).alias("relation"), F.lit(direction).alias("direction")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def co_appearances(appearances: DataFrame, *, host: str, guest: str) -> DataFrame:
    """Per guest the hosts they appeared with, sorted, each once, and how often."""
    return appearances.groupBy(guest).agg(F.array_sort(F.collect_set(host)).alias("hosts"), F.count("*").alias("times"))


def author_graph(works: DataFrame, *, work: str, authors: str) -> tuple[DataFrame, DataFrame]:
    """People and edges of catalogue strings with authors packed by ";".

    People are collapsed by name and years: spellings united, first known years by order of work, number of works. Edges
    are (person_key, work, role), each once.
    """
    from quillmesh.functions.authors import parsed_author
    from quillmesh.functions.strings import person_key, split_values

    one = works.select(F.col(work).alias("work"), F.posexplode(split_values(F.col(authors))).alias("place", "raw"))
    one = one.withColumn("a", parsed_author("raw")).filter("a.name is not null").select("work", "place", "raw", "a.*")
    one = one.withColumn("person_key", person_key(F.col("name"), F.col("birth"), F.col("death")))
    order = F.struct("work", "place")
    people = one.groupBy("person_key").agg(
        F.min_by("name", order).alias("name"), F.min_by("birth", F.when(F.col("birth").isNotNull(), order)).alias("birth"), F.min_by("death", F.when(F.col("death").isNotNull(), order)).alias("death"),
        F.array_sort(F.collect_set("raw")).alias("spellings"), F.count_distinct("work").alias("works"), F.max("corporate").alias("corporate"),
    )
    return people, one.select("person_key", "work", "role").distinct()


def name_index(people: DataFrame, *, person: str, name: str) -> DataFrame:
    """(token, person): words of names without accents in lower case, each once, for search by word."""
    from quillmesh.functions.fuzzy import without_accents

    words = F.split(F.lower(without_accents(F.col(name))), r"[^\p{L}\p{N}]+")
    return people.select(F.col(person).alias("person"), F.explode(F.array_distinct(words)).alias("token")).filter("token <> ''")


def cross_score(percentile: Column, domains: Column, weight: float = 0.9, most: int = 3) -> Column:
    """Percentile and breadth of domains as one score of 0 to 100."""
    return weight * percentile + (1 - weight) * F.least(domains, F.lit(most)) / float(most) * 100.0


def latest_event(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(at))
    return df.withColumn("_p", F.row_number().over(w)).filter("_p = 1").drop("_p")
