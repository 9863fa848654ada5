"""The read side: who, works, about, contemporaries, inventory; need, caps, card; lists; topics."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.fuzzy import topic_match
from quillmesh.functions.numbers import life_span
from quillmesh.functions.strings import slug, truncated
from quillmesh.operators.aggregates import rolled_up
from quillmesh.operators.joins import named_beside, or_else
from quillmesh.operators.policies import move_links
from quillmesh.operators.ranking import top_per_group


def who(people: DataFrame, edges: DataFrame, topics: DataFrame, name: str, *, limit: int = 8, most_topics: int = 6) -> DataFrame:
    """People whose name has ``name`` in it (any case), best attested first, with edges per domain and their strongest topics."""
    found = people.filter(F.col("name").ilike(f"%{name}%")).select("person_id", "name", life_span(F.col("birth_year"), F.col("death_year")).alias("lived"), "kind", "origin")
    ids = found.select("person_id").distinct()  # edges and topics of the others are dropped before anything is counted
    edges, topics = edges.join(ids, "person_id", "left_semi"), topics.join(ids, "person_id", "left_semi")
    per_domain = edges.groupBy("person_id", "domain").agg(F.count("*").alias("n"))
    produced = per_domain.groupBy("person_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("domain", "n")))).alias("produced"), F.sum("n").alias("evidence"))
    strongest = top_per_group(topics, ["person_id"], [F.desc("weight"), F.col("topic")], most_topics)
    strongest = strongest.groupBy("person_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "topic"))), lambda x: x["topic"]).alias("topics"))
    out = found.join(produced, "person_id", "left").join(strongest, "person_id", "left").na.fill(0, ["evidence"])
    return out.orderBy(F.desc("evidence"), "name", "person_id").limit(limit)


def search(people: DataFrame, index: DataFrame, text: str, *, limit: int = 8) -> DataFrame:
    """People (person_id, name) whose name has all words of ``text`` (by ``operators.graph.name_index``: any case, without
    accents), or, where there is none, has the text as a part (any case)."""
    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    words = sorted(set(re.findall(r"\w+", plain)))
    hits = index.filter(F.col("token").isin(*words)).groupBy("person").agg(F.count_distinct("token").alias("n")).filter(F.col("n") == len(words))
    by_word = people.join(hits.select(F.col("person").alias("person_id")), "person_id", "left_semi").orderBy("name", "person_id").limit(limit)
    by_part = people.filter(F.col("name").ilike(f"%{text}%")).orderBy("name", "person_id").limit(limit)
    return or_else(by_word, by_part) if words else by_part


def works(people: DataFrame, edges: DataFrame, name: str, *, limit: int = 200) -> DataFrame:
    """Edges of the best attested person of that name."""
    found = people.filter(F.col("name").ilike(f"%{name}%")).select("person_id")
    counts = edges.join(found, "person_id").groupBy("person_id").agg(F.count("*").alias("n"))
    best = counts.orderBy(F.desc("n"), "person_id").limit(1).select("person_id")
    return edges.join(best, "person_id").orderBy("domain", "content_ref").limit(limit)


def about(people: DataFrame, topics: DataFrame, topic: str, *, limit: int = 20) -> DataFrame:
    """People of a topic (any case), by weight."""
    hits = topics.filter(F.lower("topic") == topic.lower()).groupBy("person_id").agg(F.max("weight").alias("weight"))
    return hits.join(people.select("person_id", "name", "kind"), "person_id").orderBy(F.desc("weight"), "person_id").limit(limit)


def contemporaries(people: DataFrame, name: str, *, assumed_life: int = 80, limit: int = 20) -> DataFrame:
    """People whose life overlaps that of the named person, longest overlap first; a missing death is birth + ``assumed_life``."""
    dated = people.filter("birth_year is not null").select("person_id", "name", F.col("birth_year").alias("born"), F.coalesce("death_year", F.col("birth_year") + assumed_life).alias("died"))
    one = dated.filter(F.col("name").ilike(f"%{name}%")).orderBy(F.length("name"), "person_id").limit(1)
    one = one.select(F.col("person_id").alias("of"), F.col("born").alias("b"), F.col("died").alias("d"))
    overlap = F.least("died", "d") - F.greatest("born", "b")
    met = dated.join(F.broadcast(one), (F.col("born") < F.col("d")) & (F.col("b") < F.col("died")) & (F.col("person_id") != F.col("of")))  # one row
    return met.select("person_id", "name", overlap.alias("years")).orderBy(F.desc("years"), "person_id").limit(limit)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def registered_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of the catalog by name."""
    return spark.createDataFrame([(t.name, t.tableType) for t in spark.catalog.listTables(database)], "name string, kind string").orderBy("name")


def need(repositories: DataFrame, cards: DataFrame | None, capability: str, *, keyword: Column, missing_adoption: float = 45.0, limit: int = 10) -> DataFrame:
    """Repositories for a capability by liftability + adoption / 2, less a penalty of 12 for fame without adoption; cards first.

    ``repositories`` has full_name, liftability, adoption and stars; ``cards`` likewise, scored 5 higher, adoption 50 if missing.
    """
    famous = (F.coalesce("stars", F.lit(0)) > 5000) & (F.coalesce("adoption", F.lit(0.0)) < 40)
    score = F.coalesce("liftability", F.lit(0)) + 0.5 * F.coalesce("adoption", F.lit(missing_adoption)) - F.when(famous, 12.0).otherwise(0.0)
    out = repositories.filter(keyword).select("full_name", score.alias("score"), F.lit("repository").alias("kind"))
    if cards is not None:
        card_score = F.coalesce("liftability", F.lit(0)) + 0.5 * F.coalesce("adoption", F.lit(50.0)) + 5.0
        best = cards.filter(keyword).select("full_name", card_score.alias("score"), F.lit("card").alias("kind"))
        out = best.unionByName(out.join(best.select("full_name"), "full_name", "left_anti"))
    return out.withColumn("capability", F.lit(capability)).orderBy(F.desc("score"), "full_name").limit(limit)


def capabilities(rows: DataFrame, *, domain: str, tag: str, item: str) -> DataFrame:
    """What can be asked for: tags of every domain with the number of their matches."""
    return rows.groupBy(F.col(domain).alias("domain"), F.col(tag).alias("tag")).agg(F.count_distinct(item).alias("matches"))


def card(rows: DataFrame, key: str, value: str, fields: dict[str, Column]) -> DataFrame:
    """One item with its fields, which are aggregates over its rows."""
    return rows.filter(F.col(key) == value).groupBy(key).agg(*[c.alias(n) for n, c in fields.items()])


def list_top(entries: DataFrame, *, limit: int = 20) -> DataFrame:
    """Targets by the number of different lists that cite them."""
    per = entries.groupBy("target").agg(F.count_distinct("list").alias("lists"), F.count_distinct("section").alias("sections"))
    return per.orderBy(F.desc("lists"), "target").limit(limit)


def list_owners(entries: DataFrame, *, least: int = 2, limit: int = 20) -> DataFrame:
    """Owners by the number of their targets that are cited."""
    per = entries.groupBy(F.substring_index("target", "/", 1).alias("owner")).agg(F.count_distinct("target").alias("targets"), F.count_distinct("list").alias("lists"))
    return per.filter(F.col("targets") >= least).orderBy(F.desc("targets"), F.desc("lists"), "owner").limit(limit)


def alternatives(entries: DataFrame, target: str, *, limit: int = 10) -> DataFrame:
    """What is filed beside ``target``: over-fetched, then without lists."""
    beside = named_beside(entries, target, basket=["list", "section"], item="target", list_column="list")
    return beside.orderBy(F.desc("lists"), "target").limit(limit)


def list_sections(entries: DataFrame, *, limit: int = 20) -> DataFrame:
    """Headings by the number of their entries, with lists and targets."""
    per = entries.filter("section is not null").groupBy("section").agg(F.count("*").alias("entries"), F.count_distinct("list").alias("lists"), F.count_distinct("target").alias("targets"))
    return per.orderBy(F.desc("entries"), "section").limit(limit)


def cited_by(entries: DataFrame, target: str) -> DataFrame:
    """The lists and sections that cite ``target``."""
    return entries.filter(F.col("target") == target).select("list", "section").distinct()


def list_stats(entries: DataFrame, lists: DataFrame) -> DataFrame:
    """One row of totals over lists, entries and targets."""
    per = entries.groupBy("target").agg(F.count_distinct("list").alias("n"))
    targets = per.agg(F.count("*").alias("targets"), F.count_if(F.col("n") > 1).alias("multi"), F.max("n").alias("most"))
    rows = entries.agg(F.count("*").alias("entries"), F.count("section").alias("_s"), F.count_distinct("section").alias("sections"))
    ok = lists.agg(F.count_if(F.col("status") == "ok").alias("lists_ok"))

    def percent(part: str, whole: str) -> Column:
        return F.round(100.0 * F.col(part) / F.greatest(F.lit(1), F.col(whole)), 2)

    return ok.join(rows).join(targets).select("lists_ok", "entries", "targets", "multi", percent("multi", "targets").alias("pct_multi"), "most", "sections", percent("_s", "entries").alias("pct_section"))  # one row each


def catalog_stats(sightings: DataFrame, *, source: str, observation: str, identity: str) -> DataFrame:
    """Per source its sightings, identities and sightings without one."""
    unresolved = F.count_distinct(F.when(F.col(identity).isNull(), F.col(observation)))
    return sightings.groupBy(source).agg(F.count_distinct(observation).alias("observations"), F.count_distinct(identity).alias("identities"), unresolved.alias("unresolved"))


def resolved(sightings: DataFrame, key: str, value: str, text: str, most: int = 220) -> DataFrame:
    """The sightings of one identity with ``text`` shortened."""
    return sightings.filter(F.col(key) == value).withColumn(text, truncated(F.col(text), most))


def browser_stats(picks: DataFrame, tree: DataFrame) -> DataFrame:
    """One row of totals for a start page."""
    per = picks.agg(
        F.count_distinct("full_name").alias("repositories"), F.count_distinct(F.when(F.col("is_winner") == 1, F.col("full_name"))).alias("winners"), F.count_distinct(F.when(F.col("category_id").isNotNull(), F.col("full_name"))).alias("categorized")
    )
    return per.join(tree.agg(F.count("*").alias("categories"))).select("repositories", "categories", "winners", "categorized")  # one row each


def browser_tree(tree: DataFrame, picks: DataFrame) -> DataFrame:
    """The nodes of a tree with their own rows, and those of themselves and all below."""
    per = picks.filter("category_id is not null").groupBy(F.col("category_id").alias("id")).agg(F.count("*").alias("n"), F.count_if(F.col("is_winner") == 1).alias("w"))
    totals = rolled_up(tree.select("id", "parent_id"), per.select("id", F.col("n").alias("v")), node="id", parent="parent_id", value="v")
    winners = rolled_up(tree.select("id", "parent_id"), per.select("id", F.col("w").alias("v")), node="id", parent="parent_id", value="v").select("id", F.col("total").alias("winners"))
    return tree.select("id", "parent_id", "slug").join(totals, "id").join(winners, "id").select("id", "parent_id", "slug", F.col("own").alias("own_total"), "total", "winners")


def browser_repositories(tree: DataFrame, picks: DataFrame) -> DataFrame:
    """One row per winner: its best category by score, its stars, and all of its categories."""
    rows = picks.filter("is_winner = 1 and full_name is not null").join(tree.select(F.col("id").alias("category_id"), F.col("name").alias("category")), "category_id", "left")
    score = F.when(F.col("score").isNull() | F.isnan("score"), -1.0).otherwise(F.col("score"))
    order = F.struct(score.alias("s"), F.coalesce("stars", F.lit(-1)).alias("t"), (-F.col("id")).alias("i"))
    best = F.max_by(F.struct(F.coalesce("category", F.lit("")).alias("category"), F.coalesce("stars", F.lit(0)).alias("stars")), order)
    return rows.groupBy("full_name").agg(best.alias("b"), F.array_sort(F.collect_set("category_id")).alias("categories")).select("full_name", "b.category", "b.stars", "categories")


def topic_links(links: DataFrame) -> DataFrame:
    """Topics (slug) with the number of what is filed under them, and of its owners."""
    return links.groupBy("slug").agg(F.count("*").alias("links"), F.count_distinct(F.substring_index("repo", "/", 1)).alias("owners"))


def stale(lists: DataFrame, *, day: Column, as_of: Column, years: int = 2) -> DataFrame:
    """Rows whose day is more than ``years`` before ``as_of``."""
    return lists.filter(day < F.add_months(as_of, -12 * years))


def suggest(topics: DataFrame, text: str, *, limit: int = 5) -> DataFrame:
    """Topics of a registry that fit a text best: slug, title, score."""
    words = F.concat_ws(" ", "title", F.coalesce("description", F.lit("")), F.coalesce("keywords", F.lit("")))
    scored = topics.withColumn("score", topic_match(F.lit(text), F.col("title"), words))
    return scored.select("slug", "title", "score").orderBy(F.desc("score"), F.desc("slug")).limit(limit)


def add_or_match(topics: DataFrame, title: str, *, threshold: float = 0.75) -> tuple[str, bool]:
    """The slug to file a title under, and whether it exists already: the best fit from ``threshold`` on, or the same slug."""
    best = suggest(topics, title, limit=1).first()
    if best and best["score"] >= threshold:
        return best["slug"], True
    own = topics.sparkSession.range(1).select(slug(F.lit(title)).alias("s")).first()["s"]
    return own, not topics.filter(F.col("slug") == own).isEmpty()


def merge_topics(links: DataFrame, moves: DataFrame) -> DataFrame:
    """Links (slug, repo) after topics were merged (slug -> into); of two equal links one stays under the old slug."""
    return move_links(links, moves, member="slug", target="into", unique=["slug", "repo"])
