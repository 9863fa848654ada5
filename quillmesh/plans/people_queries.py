"""Queries of people, their graph and the read side, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import strings
from quillmesh.operators import aggregates, graph, joins, people, sets
from quillmesh.plans import ask, tiers
from quillmesh.plans.registry import query
from quillmesh.tables import table

AS_OF = "2026-06-30"

_FOLDED = r"lower(trim(regexp_replace(coalesce(name, ''), '\s+', ' ', 'g')))"
_GRAPH = rf"""
p AS (SELECT person_id, any_value(name) AS name, any_value(origin) AS origin, any_value(birth_year) AS b, any_value(death_year) AS d FROM (SELECT DISTINCT person_id, name, origin, birth_year, death_year FROM person) GROUP BY 1 HAVING count(*) = 1),
f AS (SELECT *, {_FOLDED} AS n FROM p), known AS (SELECT * FROM f WHERE origin <> 'books'), books AS (SELECT * FROM f WHERE origin = 'books' AND n <> ''),
byname AS (SELECT n, min(person_id) AS known FROM known WHERE n <> '' GROUP BY 1), firsts AS (SELECT n, min(person_id) AS first FROM books GROUP BY 1),
keyed AS (SELECT b.*, known, first, coalesce(known, 'bk:' || first) AS pid FROM books b LEFT JOIN byname USING (n) JOIN firsts USING (n)),
life AS (SELECT pid, min(person_id) AS k FROM keyed WHERE b IS NOT NULL GROUP BY 1), lives AS (SELECT pid, b, d FROM life JOIN keyed USING (pid) WHERE person_id = k),
people AS (SELECT person_id, name, origin, b, d FROM known UNION ALL SELECT pid, name, 'books', b, d FROM keyed WHERE known IS NULL AND person_id = first),
works AS (SELECT DISTINCT claim_id, person_a, method FROM identity_claim WHERE person_a IS NOT NULL),
edges AS (SELECT DISTINCT pid AS person_id, 'book' AS domain, claim_id::VARCHAR AS ref FROM works JOIN keyed ON keyed.person_id = person_a UNION SELECT DISTINCT person_a, 'claim', claim_id || 'x' FROM works JOIN known ON known.person_id = person_a)
"""


def _graph_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, ...]:
    rows = table(spark, folder, "person").select("person_id", "name", "origin", "birth_year", "death_year").distinct()
    single = rows.groupBy("person_id").agg(F.count("*").alias("n")).filter("n = 1").select("person_id")
    rows = rows.join(single, "person_id")
    books = rows.filter("origin = 'books'").withColumnRenamed("person_id", "person_key")
    works = table(spark, folder, "identity_claim").filter("person_a is not null").select("claim_id", "person_a", "method").distinct()
    known = rows.filter("origin <> 'books'")
    of_known = works.join(known.select(F.col("person_id").alias("person_a")), "person_a", "left_semi")
    known_edges = of_known.select(F.col("person_a").alias("person_id"), F.lit("claim").alias("domain"), F.concat(F.col("claim_id").cast("string"), F.lit("x")).alias("content_ref"), F.lit("author").alias("role"))
    book_edges = works.select(F.col("person_a").alias("person_key"), F.col("claim_id").alias("gid"), F.lit("author").alias("role"))
    subjects = works.select(F.col("claim_id").alias("gid"), F.col("method").alias("subject"))
    return known, books, known_edges, book_edges, subjects


@query("built_people", f"""
WITH {_GRAPH} SELECT p.person_id, p.name, p.origin, coalesce(p.b, l.b) AS birth_year, CASE WHEN p.b IS NULL AND l.b IS NOT NULL THEN l.d ELSE p.d END AS death_year,
    CASE WHEN p.person_id IN (SELECT person_id FROM edges) THEN 'linked' ELSE 'tracked' END AS state FROM people p LEFT JOIN lives l ON l.pid = p.person_id""")
def built_people(spark: SparkSession, folder: str) -> DataFrame:
    """The graph of people from one that exists and a catalogue: matched by name, years filled, states."""
    return people.built_graph(*_graph_inputs(spark, folder))["person"].select("person_id", "name", "origin", "birth_year", "death_year", "state")


@query("built_edges", f"WITH {_GRAPH} SELECT person_id, domain, ref AS content_ref FROM edges")
def built_edges(spark: SparkSession, folder: str) -> DataFrame:
    return people.built_graph(*_graph_inputs(spark, folder))["edge"].select("person_id", "domain", "content_ref")


@query("built_topics", f"WITH {_GRAPH} SELECT person_id, method AS topic, count(*) AS weight FROM edges JOIN works ON claim_id = TRY_CAST(ref AS BIGINT) WHERE domain = 'book' GROUP BY 1, 2")
def built_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Topics of works, joined by number, weighted by their works."""
    return people.built_graph(*_graph_inputs(spark, folder))["topic"]


_OWNERS = """
c AS (SELECT DISTINCT id, full_name, lower(split_part(full_name, '/', 1)) AS owner, stars, license, pushed, is_winner, score, liftability, category_id FROM bank_capability_pick WHERE strpos(full_name, '/') > 1),
a AS (SELECT owner, count(*) AS n_repos, max(coalesce(stars, 0)) AS max_stars, count(*) FILTER (WHERE license IN ('MIT', 'Apache-2.0')) AS n_clean, max(pushed) AS latest_push, arg_min(full_name, (-coalesce(stars, 0), full_name)) AS top_repo FROM c GROUP BY 1),
v AS (SELECT owner, coalesce(is_winner, 0) AS hit, CASE WHEN isnan(score) THEN NULL ELSE score * 100 END AS value, liftability AS lift, category_id FROM c WHERE category_id IS NOT NULL),
b AS (SELECT owner, count(*) AS n_cat, sum(hit) AS hits, count(*) FILTER (WHERE value >= 85) AS v85, max(coalesce(value, 0)) AS max_value, max(coalesce(lift, 0)) AS max_lift, count(DISTINCT category_id) FILTER (WHERE value >= 70) AS categories FROM v GROUP BY 1),
e AS (SELECT lower(split_part(target_repo, '/', 1)) AS owner, list_repo FROM entry WHERE strpos(target_repo, '/') > 1), t AS (SELECT owner, count(*) * 1000 AS downloads, count(DISTINCT list_repo) AS dependents FROM e GROUP BY 1),
o AS (SELECT a.*, coalesce(n_cat, 0) AS n_cat, coalesce(hits, 0) AS hits, coalesce(v85, 0) AS v85, coalesce(max_value, 0) AS max_value, coalesce(max_lift, 0) AS max_lift, coalesce(categories, 0) AS categories, coalesce(downloads, 0) AS downloads, coalesce(dependents, 0) AS dependents
    FROM a LEFT JOIN b USING (owner) LEFT JOIN t USING (owner))
"""


def _owners(spark: SparkSession, folder: str) -> DataFrame:
    own = F.lower(strings.owner(F.col("full_name"))).alias("owner")
    rows = table(spark, folder, "bank_capability_pick").filter("instr(full_name, '/') > 1").select("id", "full_name", "stars", "license", "pushed", "is_winner", "score", "liftability", "category_id").distinct()
    cards = rows.select(own, "full_name", "stars", F.coalesce(F.col("license").isin("MIT", "Apache-2.0"), F.lit(False)).alias("is_clean"), "pushed")
    placed = rows.filter("category_id is not null").select(own, F.col("is_winner").alias("hit"), F.when(~F.isnan("score"), F.col("score") * 100).alias("value"), F.col("liftability").alias("lift"), "category_id")
    entry = table(spark, folder, "entry").filter("instr(target_repo, '/') > 1").select(F.lower(F.substring_index("target_repo", "/", 1)).alias("owner"), "list_repo")
    adoption = entry.groupBy("owner").agg((F.count("*") * 1000).alias("downloads"), F.count_distinct("list_repo").alias("dependents"))
    return people.owners_from_passes(cards, placed, adoption)


@query("owners_of_three_passes", f"WITH {_OWNERS} SELECT owner, n_repos, max_stars, n_clean, top_repo, n_cat, hits::BIGINT AS hits, v85, categories, downloads, dependents FROM o")
def owners_of_three_passes(spark: SparkSession, folder: str) -> DataFrame:
    return _owners(spark, folder).select("owner", "n_repos", "max_stars", "n_clean", "top_repo", "n_cat", "hits", "v85", "categories", "downloads", "dependents")


@query("owner_values", f"""
WITH {_OWNERS}, x AS (SELECT owner, n_cat, CASE WHEN hits + 0.4 * v85 + 0.15 * n_cat > 0 THEN least(100, log10(hits + 0.4 * v85 + 0.15 * n_cat + 1) * 52) ELSE 0 END AS volume,
    least(100, greatest(0, 0.55 * greatest(max_value, max_lift) + 0.45 * CASE WHEN max_stars > 0 THEN least(100, log10(max_stars + 1) * 20) ELSE 0 END)) AS peak, CASE WHEN categories > 0 THEN least(100, log10(categories + 1) * 64) ELSE 0 END AS breadth,
    CASE WHEN n_cat >= 5 THEN greatest(least(100, hits / n_cat * 100), CASE WHEN hits > 0 THEN least(100, log10(hits + 1) * 42) ELSE 0 END) WHEN n_cat > 0 THEN least(100, hits / n_cat * 100) * n_cat / 5 ELSE 0 END AS density,
    least(100, 100 * pow(0.5, greatest(0.0, coalesce(date_diff('day', TRY_CAST(latest_push AS DATE), DATE '{AS_OF}') / 365.25, 99)) / 2.5)) AS freshness, greatest(30, least(100, n_clean / n_repos * 100)) AS license,
    least(100, 0.6 * CASE WHEN downloads > 0 THEN least(100, log10(downloads + 1) * 11) ELSE 0 END + 0.4 * CASE WHEN dependents > 0 THEN least(100, log10(dependents + 1) * 15) ELSE 0 END) AS adoption FROM o)
SELECT owner, round(least(100, 0.22 * volume + 0.30 * peak + 0.13 * breadth + 0.18 * density + 0.09 * freshness + 0.08 * license + 14 * adoption / 100), 6)::DOUBLE AS value, round(density, 6)::DOUBLE AS density, round(adoption, 6)::DOUBLE AS adoption FROM x""")
def owner_values(spark: SparkSession, folder: str) -> DataFrame:
    """Six weighted axes and what adoption adds."""
    out = people.with_value(_owners(spark, folder), F.lit(AS_OF).cast("date"))
    return out.select("owner", *[F.round(c, 6).alias(c) for c in ("value", "density", "adoption")])


@query("owner_kinds", f"WITH {_OWNERS} SELECT owner, CASE WHEN contains(owner, 'lab') OR contains(owner, 'org') OR n_repos >= 8 THEN 'organisation' ELSE 'human' END AS kind FROM o")
def owner_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return people.owner_kinds(_owners(spark, folder), login="owner", repositories="n_repos", hints=["lab", "org"], least=8).select("owner", "kind")


@query("external_ids", """
WITH p AS (SELECT DISTINCT person_id, origin, primary_tier, birth_year FROM person)
SELECT person_id, 'origin' AS platform, origin AS value, 1.0::DOUBLE AS confidence FROM p WHERE trim(origin) <> '' UNION SELECT person_id, 'primary_tier', primary_tier, 0.8 FROM p WHERE trim(primary_tier) <> '' UNION SELECT person_id, 'birth_year', birth_year::VARCHAR, 0.5 FROM p WHERE birth_year IS NOT NULL""")
def external_ids(spark: SparkSession, folder: str) -> DataFrame:
    return people.external_ids(table(spark, folder, "person"), person="person_id", platforms={"origin": 1.0, "primary_tier": 0.8, "birth_year": 0.5})


@query("united_people", rf"""
WITH r AS (SELECT DISTINCT person_id, name, origin, rank_score FROM person WHERE trim(name) <> '' AND origin IN ('github', 'books')), k AS (SELECT *, {_FOLDED} AS key, CASE origin WHEN 'github' THEN 0 ELSE 1 END AS o FROM r)
SELECT key, arg_min(name, (o, name)) AS name, array_to_string(list_sort(array_agg(DISTINCT origin)), ',') AS sources, count(*) AS n, count(*) FILTER (WHERE rank_score > 10) AS hits, round(count(*) + 5 * count(*) FILTER (WHERE rank_score > 10) + 0.1 * max(coalesce(rank_score, 0)), 6)::DOUBLE AS score FROM k GROUP BY 1""")
def united_people(spark: SparkSession, folder: str) -> DataFrame:
    """People of several sources as one row per name, scored by what the caller gives."""
    rows = table(spark, folder, "person").select("person_id", "name", "origin", "rank_score").distinct()
    source = {o: rows.filter(F.col("origin") == o).select("name", F.lit(1).cast("long").alias("n"), F.coalesce("rank_score", F.lit(0.0)).alias("lift"), (F.coalesce("rank_score", F.lit(0.0)) > 10).cast("long").alias("hits")) for o in ("github", "books")}
    out = people.united_people(list(source.items()), score=F.col("n") + 5 * F.col("hits") + 0.1 * F.col("lift"))
    return out.select("key", "name", "sources", "n", "hits", F.round("score", 6).alias("score"))


@query("directed_relations", """
WITH p AS (SELECT DISTINCT person_id, merged_into, origin FROM person) SELECT person_id AS person_a, merged_into AS person_b, 'merge' AS relation, 'out' AS direction FROM p WHERE merged_into IS NOT NULL UNION SELECT person_id, origin, 'place', 'in' FROM p WHERE origin IS NOT NULL""")
def directed_relations(spark: SparkSession, folder: str) -> DataFrame:
    facts = table(spark, folder, "person").select("person_id", F.array("merged_into").alias("merge"), F.array("origin").alias("place"))
    return graph.directed_relations(facts, "person_id", {"merge": ("merge", "out"), "place": ("place", "in")})


@query("co_appearances", "SELECT user_id AS guest, array_to_string(list_sort(array_agg(DISTINCT event_type)), ',') AS hosts, count(*) AS times FROM events GROUP BY 1")
def co_appearances(spark: SparkSession, folder: str) -> DataFrame:
    seen = table(spark, folder, "events").select(F.col("event_type").alias("host"), F.col("user_id").alias("guest"))
    return graph.co_appearances(seen, host="host", guest="guest").select("guest", F.array_join("hosts", ",").alias("hosts"), "times")


@query("author_people", r"""
WITH p AS (SELECT DISTINCT person_id, trim(sort_name) AS s, birth_year AS b FROM person WHERE trim(sort_name) <> '' AND NOT contains(sort_name, ';') AND NOT contains(sort_name, '[')), w AS (SELECT *, row_number() OVER (ORDER BY person_id) AS work FROM p),
n AS (SELECT *, trim(trim(s, ',')) AS name, CASE WHEN b > 99 THEN b END AS birth FROM w), k AS (SELECT *, trim(regexp_replace(trim(regexp_replace(regexp_replace(lower(name), '\s+', ' ', 'g'), '\([^)]*\)', '', 'g')), '[^a-z0-9, ]', '', 'g')) AS base FROM n WHERE name <> '')
SELECT CASE WHEN birth IS NOT NULL THEN base || '|' || birth || '-' ELSE base END AS person_key, count(*) AS works, max((lower(name) IN ('anonymous', 'unknown', 'various') OR (NOT contains(name, ',') AND birth IS NULL))::INT)::INTEGER AS corporate FROM k GROUP BY 1""")
def author_people(spark: SparkSession, folder: str) -> DataFrame:
    """People of catalogue strings, with their years in the string."""
    rows = table(spark, folder, "person").filter("trim(sort_name) <> '' and instr(sort_name, ';') = 0 and instr(sort_name, '[') = 0").select("person_id", F.trim("sort_name").alias("s"), "birth_year").distinct()
    raw = F.when(F.col("birth_year") > 99, F.concat("s", F.lit(", "), F.col("birth_year").cast("string"), F.lit("-"))).otherwise(F.col("s"))
    found, _ = graph.author_graph(rows.select(F.col("person_id").alias("work"), raw.alias("authors")), work="work", authors="authors")
    return found.select("person_key", "works", "corporate")


@query("found_by_name", """
WITH p AS (SELECT DISTINCT person_id, name FROM person WHERE name IS NOT NULL), s AS (SELECT * FROM p WHERE list_has_all(string_split_regex(strip_accents(lower(name)), '[^\\pL\\pN]+'), ['elizabeth']))
SELECT person_id, name FROM s ORDER BY name, person_id LIMIT 8""")
def found_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """A top-8 report: people by the words of their name, or by a part of it where no word is found."""
    rows = table(spark, folder, "person").select("person_id", "name").distinct().filter("name is not null")
    return ask.search(rows, graph.name_index(rows, person="person_id", name="name"), "Élizabeth")


@query("found_by_part", "SELECT person_id, name FROM (SELECT DISTINCT person_id, name FROM person WHERE name ILIKE '%lizabet%') ORDER BY name, person_id LIMIT 8")
def found_by_part(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "person").select("person_id", "name").distinct().filter("name is not null")
    return ask.search(rows, graph.name_index(rows, person="person_id", name="name"), "lizabet")


@query("resolved_in_order", """
WITH o AS (SELECT DISTINCT obs_id, lower(observed_owner_name) AS a, normalized_url AS b FROM repo_observation), x AS (SELECT lower(full_name) AS a, min(id) AS id FROM bank_capability_pick WHERE full_name IS NOT NULL GROUP BY 1), y AS (SELECT normalized_url AS b, -min(obs_id) AS id FROM repo_observation GROUP BY 1)
SELECT obs_id, coalesce(x.id, y.id) AS id FROM o LEFT JOIN x USING (a) LEFT JOIN y USING (b)""")
def resolved_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """A key looked up in one table, then in the next."""
    rows = table(spark, folder, "repo_observation").select("obs_id", F.lower("observed_owner_name").alias("a"), F.col("normalized_url").alias("b")).distinct()
    x = table(spark, folder, "bank_capability_pick").filter("full_name is not null").groupBy(F.lower("full_name").alias("a")).agg(F.min("id").alias("id"))
    y = table(spark, folder, "repo_observation").groupBy(F.col("normalized_url").alias("b")).agg((-F.min("obs_id")).alias("id"))
    return joins.resolve_in_order(rows, [(x, "a"), (y, "b")], "id").select("obs_id", "id")


@query("first_paths", """
WITH a AS (SELECT DISTINCT lower(full_name) AS repo FROM bank_capability_pick WHERE is_winner = 1 AND full_name IS NOT NULL), b AS (SELECT DISTINCT lower(target_repo) AS repo FROM entry WHERE trim(target_repo) <> '')
SELECT repo, 0 AS path FROM a UNION ALL SELECT repo, 1 FROM b WHERE repo NOT IN (SELECT repo FROM a)""")
def first_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of several lookups, each from the first that has it; a last one only where the others are empty."""
    a = table(spark, folder, "bank_capability_pick").filter("is_winner = 1 and full_name is not null").select(F.lower("full_name").alias("repo")).distinct()
    b = table(spark, folder, "entry").filter("trim(target_repo) <> ''").select(F.lower("target_repo").alias("repo")).distinct()
    return joins.or_else(joins.first_of_paths([a, b], ["repo"]), table(spark, folder, "curated_list").select(F.col("list_repo").alias("repo"), F.lit(2).alias("path")))


@query("two_hop_edges", """
SELECT 's' || l_suppkey AS person_a, 'c' || o_custkey AS person_b, count(*) AS weight FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def two_hop_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges between people through two things each of them owns."""
    def named(prefix: str, column: str):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    uses = table(spark, folder, "lineitem").select(named("s", "l_suppkey").alias("source"), named("o", "l_orderkey").alias("target"))
    suppliers = table(spark, folder, "supplier").select(named("s", "s_suppkey").alias("thing"), named("s", "s_suppkey").alias("person"))
    orders = table(spark, folder, "orders").select(named("o", "o_orderkey").alias("thing"), named("c", "o_custkey").alias("person"))
    return joins.two_hop_edges(uses, suppliers.union(orders), source="source", target="target", thing="thing", person="person")


@query("identifier_claims", """
WITH p AS (SELECT DISTINCT person_id, regexp_extract(evidence, 'github_login=(.+)', 1) AS v FROM (SELECT person_a AS person_id, evidence FROM identity_claim UNION ALL SELECT person_b, evidence FROM identity_claim) WHERE person_id IS NOT NULL AND evidence LIKE 'github_login=%')
SELECT DISTINCT x.person_id AS person_a, y.person_id AS person_b, 'shared_external_id' AS method, 0.98::DOUBLE AS confidence FROM p x JOIN p y ON x.v = y.v AND x.person_id < y.person_id""")
def identifier_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims by an identifier that two people share."""
    claims = table(spark, folder, "identity_claim").filter("evidence like 'github_login=%'")
    ids = claims.select(F.explode(F.array("person_a", "person_b")).alias("person_id"), F.lit("github").alias("platform"), F.regexp_extract("evidence", "github_login=(.+)", 1).alias("value")).filter("person_id is not null")
    nobody = table(spark, folder, "person").limit(0).select("person_id", "name", "birth_year", "death_year", "origin")
    return graph.claims(nobody, ids, person="person_id", name="name", birth="birth_year", death="death_year", origin="origin")


@query("latest_events", "SELECT user_id, event_type, max(ts) AS ts FROM events GROUP BY 1, 2")
def latest_events(spark: SparkSession, folder: str) -> DataFrame:
    return graph.latest_event(table(spark, folder, "events").select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts")


@query("evidence_grades", """
WITH c AS (SELECT DISTINCT claim_id, person_a, method, status FROM identity_claim WHERE person_a IS NOT NULL)
SELECT person_a, array_to_string(list_sort(array_agg(DISTINCT method)), ',') AS methods, CASE max(CASE method WHEN 'manual' THEN 3 WHEN 'shared_external_id' THEN 2 ELSE 1 END) WHEN 3 THEN 'A' WHEN 2 THEN 'B' ELSE 'C' END AS grade FROM c GROUP BY 1""")
def evidence_grades(spark: SparkSession, folder: str) -> DataFrame:
    """All kinds of evidence of a person, and the grade of the best."""
    claims = table(spark, folder, "identity_claim").filter("person_a is not null")
    return aggregates.graded(claims, ["person_a"], "method", {"manual": "A", "shared_external_id": "B"}, "C").select("person_a", F.array_join("values", ",").alias("methods"), "grade")


# --- read side -------------------------------------------------------------------------------------------------------


@query("need_with_cards", """
WITH r AS (SELECT full_name, max(liftability) AS lift, max(stars) AS stars, max(is_winner) AS win FROM bank_capability_pick WHERE full_name LIKE '%index%' GROUP BY 1), l AS (SELECT target_repo AS full_name, count(DISTINCT list_repo)::DOUBLE AS adoption FROM entry GROUP BY 1),
a AS (SELECT r.*, adoption FROM r LEFT JOIN l USING (full_name))
SELECT full_name, score, kind FROM (SELECT full_name, (coalesce(lift, 0) + 0.5 * coalesce(adoption, 50) + 5)::DOUBLE AS score, 'card' AS kind FROM a WHERE win = 1
    UNION ALL SELECT full_name, (coalesce(lift, 0) + 0.5 * coalesce(adoption, 45) - CASE WHEN coalesce(stars, 0) > 5000 AND coalesce(adoption, 0) < 40 THEN 12 ELSE 0 END)::DOUBLE, 'repository' FROM a WHERE win = 0) ORDER BY score DESC, full_name LIMIT 10""")
def need_with_cards(spark: SparkSession, folder: str) -> DataFrame:
    """A top-10 report: cards first, then repositories, by liftability and adoption."""
    per = table(spark, folder, "bank_capability_pick").groupBy("full_name").agg(F.max("liftability").alias("liftability"), F.max("stars").alias("stars"), F.max("is_winner").alias("win"))
    cited = table(spark, folder, "entry").groupBy(F.col("target_repo").alias("full_name")).agg(F.count_distinct("list_repo").cast("double").alias("adoption"))
    rows = per.join(cited, "full_name", "left")
    return ask.need(rows.filter("win = 0"), rows.filter("win = 1"), "indexing", keyword=F.col("full_name").contains("index")).select("full_name", "score", "kind")


@query("capabilities", "SELECT unit_class AS domain, legal_lane AS tag, count(DISTINCT full_name) AS matches FROM bank_capability_pick WHERE is_winner = 1 GROUP BY 1, 2")
def capabilities(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "bank_capability_pick").filter("is_winner = 1")
    return ask.capabilities(rows, domain="unit_class", tag="legal_lane", item="full_name")


@query("card", """
WITH f AS (SELECT min(full_name) AS full_name FROM bank_capability_pick) SELECT full_name, max(stars) AS stars, max(score) FILTER (WHERE NOT isnan(score)) AS score, count(DISTINCT category_id) AS categories FROM bank_capability_pick WHERE full_name IN (SELECT full_name FROM f) GROUP BY 1""")
def card(spark: SparkSession, folder: str) -> DataFrame:
    """All that is known of one repository."""
    rows = table(spark, folder, "bank_capability_pick")
    name = rows.agg(F.min("full_name")).first()[0]
    return ask.card(rows, "full_name", name, {"stars": F.max("stars"), "score": F.max(F.when(~F.isnan("score"), F.col("score"))), "categories": F.count_distinct("category_id")})


_ENTRIES = "e AS (SELECT DISTINCT list_repo AS list, section, target_repo AS target, description FROM entry WHERE list_repo IS NOT NULL AND trim(target_repo) <> '')"


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entry").filter("list_repo is not null and trim(target_repo) <> ''")
    return rows.select(F.col("list_repo").alias("list"), "section", F.col("target_repo").alias("target"), "description").distinct()


@query("list_sections", f"WITH {_ENTRIES} SELECT section, count(*) AS entries, count(DISTINCT list) AS lists, count(DISTINCT target) AS targets FROM e WHERE section IS NOT NULL GROUP BY 1 ORDER BY entries DESC, section LIMIT 15")
def list_sections(spark: SparkSession, folder: str) -> DataFrame:
    """A top-15 report: the headings that people file things under."""
    return ask.list_sections(_entries(spark, folder), limit=15)


@query("cited_by", f"WITH {_ENTRIES}, t AS (SELECT target FROM e GROUP BY 1 ORDER BY count(DISTINCT list) DESC, target LIMIT 1) SELECT DISTINCT list, section FROM e JOIN t USING (target)")
def cited_by(spark: SparkSession, folder: str) -> DataFrame:
    """Where the most cited repository stands."""
    entries = _entries(spark, folder)
    most = ask.list_top(entries, limit=1).first()
    return ask.cited_by(entries, most["target"] if most else "")


@query("list_stats", f"""
WITH {_ENTRIES}, p AS (SELECT target, count(DISTINCT list) AS n FROM e GROUP BY 1)
SELECT (SELECT count(*) FROM curated_list WHERE status = 'ok') AS lists_ok, (SELECT count(*) FROM e) AS entries, (SELECT count(*) FROM p) AS targets, (SELECT count(*) FROM p WHERE n > 1) AS multi, round(100.0 * (SELECT count(*) FROM p WHERE n > 1) / greatest(1, (SELECT count(*) FROM p)), 2)::DOUBLE AS pct_multi,
    (SELECT max(n) FROM p) AS most, (SELECT count(DISTINCT section) FROM e) AS sections, round(100.0 * (SELECT count(section) FROM e) / greatest(1, (SELECT count(*) FROM e)), 2)::DOUBLE AS pct_section""")
def list_stats(spark: SparkSession, folder: str) -> DataFrame:
    return ask.list_stats(_entries(spark, folder), table(spark, folder, "curated_list"))


@query("catalog_stats", """
SELECT source, count(DISTINCT obs_id) AS observations, count(DISTINCT canonical_id) AS identities, count(DISTINCT obs_id) FILTER (WHERE canonical_id IS NULL) AS unresolved FROM repo_observation GROUP BY 1""")
def catalog_stats(spark: SparkSession, folder: str) -> DataFrame:
    return ask.catalog_stats(table(spark, folder, "repo_observation"), source="source", observation="obs_id", identity="canonical_id")


@query("resolved_identity", """
WITH m AS (SELECT min(canonical_id) AS c FROM repo_observation) SELECT DISTINCT obs_id, source, CASE WHEN length(description) > 30 THEN rtrim(substr(description, 1, 29)) || '…' ELSE description END AS description FROM repo_observation, m WHERE canonical_id = c""")
def resolved_identity(spark: SparkSession, folder: str) -> DataFrame:
    """The sightings of one identity, their texts shortened."""
    rows = table(spark, folder, "repo_observation")
    one = rows.agg(F.min("canonical_id")).first()[0]
    return ask.resolved(rows, "canonical_id", one, "description", 30).select("obs_id", "source", "description").distinct()


_BOOKS = """
b AS (SELECT doc_id AS gid, title, source, lang, lower(coalesce(title, '')) AS t, upper(substr(coalesce(source, ''), 1, 2)) AS c FROM documents WHERE text <> '')
"""
_TIER_RULES = {
    "core": ("c IN ('BI', 'BO')", 1), "essays": ("t LIKE '%notes%' OR t LIKE '%letters%'", 1), "journalism": ("t LIKE '%issue%' OR t LIKE '%press%'", 1), "mythology": ("t LIKE '%legend%' OR t LIKE '%graph%'", 1),
    "biography": ("t LIKE '%biograph%'", 1), "classical": ("c = 'PA' OR lang = 'el'", 1), "criticism": ("c = 'CR'", 1), "hold": ("c IN ('GI', 'AW')", 2), "store": ("t LIKE '%video%'", 3),
}


def _books(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").filter("text <> ''")
    return rows.select(F.col("doc_id").alias("gid"), "title", "lang", F.lower(F.coalesce("title", F.lit(""))).alias("t"), F.upper(F.substring(F.coalesce("source", F.lit("")), 1, 2)).alias("c"))


@query("tier_views", f"WITH {_BOOKS} " + " UNION ALL ".join(f"SELECT '{n}' AS reason, {t} AS tier, count(*) AS books FROM b WHERE {r}" for n, (r, t) in _TIER_RULES.items()))
def tier_views(spark: SparkSession, folder: str) -> DataFrame:
    """Nine views over a catalogue, registered by name and counted through SQL."""
    views = tiers.tier_views(_books(spark, folder), {n: F.expr(r) for n, (r, _) in _TIER_RULES.items()}, ["gid", "title"])
    tiers.register(views, "v_tier_")
    parts = [f"select '{n}' as reason, {t} as tier, count(*) as books from v_tier_{n}" for n, (_, t) in _TIER_RULES.items()]
    return spark.sql(" union all ".join(parts))


@query("extraction_queue", f"WITH {_BOOKS}, q AS (" + " UNION ALL ".join(f"SELECT gid, '{n}' AS reason, {t} AS tier FROM b WHERE {r}" for n, (r, t) in _TIER_RULES.items() if t < 3) + ") SELECT gid, reason, tier FROM q")
def extraction_queue(spark: SparkSession, folder: str) -> DataFrame:
    """The tenth view: what to read next, once per reason."""
    views = tiers.tier_views(_books(spark, folder), {n: F.expr(r) for n, (r, t) in _TIER_RULES.items() if t < 3}, ["gid", "title"])
    return tiers.reading_queue(views, {n: t for n, (_, t) in _TIER_RULES.items()}, "gid")


@query("highest_tiers", f"WITH {_BOOKS}, q AS (" + " UNION ALL ".join(f"SELECT gid, '{n}' AS reason, {t} AS tier FROM b WHERE {r}" for n, (r, t) in _TIER_RULES.items()) + ") SELECT gid, reason, tier FROM (SELECT *, row_number() OVER (PARTITION BY gid ORDER BY tier DESC, reason) AS p FROM q) WHERE p = 1")
def highest_tiers(spark: SparkSession, folder: str) -> DataFrame:
    views = tiers.tier_views(_books(spark, folder), {n: F.expr(r) for n, (r, _) in _TIER_RULES.items()}, ["gid", "title"])
    return tiers.reading_queue(views, {n: t for n, (_, t) in _TIER_RULES.items()}, "gid", highest_only=True)


@query("left_join_in_on", """
SELECT DISTINCT c.list_repo FROM curated_list c LEFT JOIN entry e ON e.list_repo = c.list_repo AND e.section = 'Tools' LEFT JOIN entry x ON x.list_repo = c.list_repo WHERE c.status = 'ok' AND (e.list_repo IS NOT NULL OR x.description LIKE '%fast%')""")
def left_join_in_on(spark: SparkSession, folder: str) -> DataFrame:
    """Lists with one kind of section, or with one kind of text: a left join whose condition is in its ON."""
    lists, entry = table(spark, folder, "curated_list").filter("status = 'ok'").select("list_repo"), table(spark, folder, "entry")
    tools = entry.filter("section = 'Tools'").select("list_repo", F.lit(True).alias("has")).distinct()
    fast = entry.filter("description like '%fast%'").select("list_repo", F.lit(True).alias("fast")).distinct()
    return lists.join(tools, "list_repo", "left").join(fast, "list_repo", "left").filter("has or fast").select("list_repo").distinct()


@query("most_per_owner", f"WITH {_ENTRIES}, p AS (SELECT target, count(DISTINCT list) AS n FROM e GROUP BY 1) SELECT split_part(target, '/', 1) AS owner, max(n) AS most, sum(n)::BIGINT AS total FROM p WHERE contains(target, '/') GROUP BY 1")
def most_per_owner(spark: SparkSession, folder: str) -> DataFrame:
    """What a correlated subquery would look up per owner, as one aggregate."""
    per = _entries(spark, folder).groupBy("target").agg(F.count_distinct("list").alias("n")).filter("instr(target, '/') > 0")
    return per.groupBy(F.substring_index("target", "/", 1).alias("owner")).agg(F.max("n").alias("most"), F.sum("n").alias("total"))


@query("browser_stats", """
SELECT (SELECT count(DISTINCT full_name) FROM bank_capability_pick) AS repositories, (SELECT count(*) FROM category) AS categories, (SELECT count(DISTINCT full_name) FROM bank_capability_pick WHERE is_winner = 1) AS winners, (SELECT count(DISTINCT full_name) FROM bank_capability_pick WHERE category_id IS NOT NULL) AS categorized""")
def browser_stats(spark: SparkSession, folder: str) -> DataFrame:
    return ask.browser_stats(table(spark, folder, "bank_capability_pick"), table(spark, folder, "category"))


@query("browser_tree", """
WITH RECURSIVE up AS (SELECT id AS ancestor, id AS node FROM category UNION ALL SELECT c.parent_id, up.node FROM up JOIN category c ON c.id = up.ancestor WHERE c.parent_id IN (SELECT id FROM category)),
own AS (SELECT category_id AS id, count(*) AS n, count(*) FILTER (WHERE is_winner = 1) AS w FROM bank_capability_pick WHERE category_id IS NOT NULL GROUP BY 1), s AS (SELECT ancestor AS id, sum(n)::BIGINT AS n, sum(w)::BIGINT AS w FROM up JOIN own ON own.id = node GROUP BY 1)
SELECT c.id, c.parent_id, c.slug, coalesce(o.n, 0)::BIGINT AS own_total, coalesce(s.n, 0)::BIGINT AS total, coalesce(s.w, 0)::BIGINT AS winners FROM category c LEFT JOIN own o ON o.id = c.id LEFT JOIN s ON s.id = c.id""")
def browser_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The tree with own counts and those of all below."""
    return ask.browser_tree(table(spark, folder, "category"), table(spark, folder, "bank_capability_pick"))


@query("browser_repositories", """
WITH p AS (SELECT DISTINCT id, full_name, category_id, score, stars, description FROM (SELECT b.*, c.name AS description FROM bank_capability_pick b LEFT JOIN category c ON c.id = b.category_id) WHERE is_winner = 1 AND full_name IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY CASE WHEN score IS NULL OR isnan(score) THEN -1 ELSE score END DESC, stars DESC NULLS LAST, id) AS p FROM p)
SELECT full_name, max(CASE WHEN p = 1 THEN coalesce(description, '') END) AS category, max(CASE WHEN p = 1 THEN coalesce(stars, 0) END) AS stars, coalesce(array_to_string(list_sort(array_agg(DISTINCT category_id) FILTER (WHERE category_id IS NOT NULL)), ','), '') AS categories FROM r GROUP BY 1""")
def browser_repositories(spark: SparkSession, folder: str) -> DataFrame:
    """One row per repository with its best category and all the others."""
    found = ask.browser_repositories(table(spark, folder, "category"), table(spark, folder, "bank_capability_pick"))
    return found.select("full_name", "category", "stars", F.array_join("categories", ",").alias("categories"))


@query("topics_after_merge", """
WITH l AS (SELECT DISTINCT topic AS slug, list_repo AS repo FROM curated_list WHERE topic IS NOT NULL), m AS (SELECT slug, repo, CASE WHEN slug = 'graph-traversal' THEN 'vector-search' END AS target FROM l), g AS (SELECT *, coalesce(target, slug) AS goal FROM m)
SELECT CASE WHEN row_number() OVER (PARTITION BY goal, repo ORDER BY target IS NOT NULL, slug) = 1 THEN goal ELSE slug END AS slug, repo FROM g""")
def topics_after_merge(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "curated_list").filter("topic is not null").select(F.col("topic").alias("slug"), F.col("list_repo").alias("repo")).distinct()
    moves = spark.range(1).select(F.lit("graph-traversal").alias("slug"), F.lit("vector-search").alias("into"))
    return ask.merge_topics(links, moves)


@query("added_topics", "SELECT 'brand-new-topic-of-ours' AS slug, false AS existed UNION ALL SELECT min(slug) AS slug, true FROM category")
def added_topics(spark: SparkSession, folder: str) -> DataFrame:
    """A new title gets a slug of its own, one that exists is matched."""
    topics = table(spark, folder, "category").filter("slug <> ''").select("slug", F.col("slug").alias("title"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("keywords"))
    first = topics.agg(F.min("slug")).first()[0]
    return spark.createDataFrame([ask.add_or_match(topics, "Brand new topic of ours", threshold=0.95), ask.add_or_match(topics, first, threshold=0.95)], "slug string, existed boolean")


@query("topic_links", "SELECT topic AS slug, count(*) AS links, count(DISTINCT split_part(list_repo, '/', 1)) AS owners FROM curated_list WHERE topic IS NOT NULL GROUP BY 1")
def topic_links(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "curated_list").filter("topic is not null").select(F.col("topic").alias("slug"), F.col("list_repo").alias("repo"))
    return ask.topic_links(links)


@query("registered_views", "SELECT 'people_of_the_test' AS name, 'TEMPORARY' AS kind")
def registered_views(spark: SparkSession, folder: str) -> DataFrame:
    table(spark, folder, "person").createOrReplaceTempView("people_of_the_test")
    return ask.registered_tables(spark).filter("name = 'people_of_the_test'")


@query("queue_once", """
WITH q AS (SELECT list_repo, 'failed' AS reason, 3 AS tier FROM curated_list WHERE status <> 'ok' UNION SELECT list_repo, 'untitled', 2 FROM curated_list WHERE title IS NULL) SELECT list_repo, reason, tier FROM (SELECT *, row_number() OVER (PARTITION BY list_repo ORDER BY tier DESC, reason) AS p FROM q) WHERE p = 1""")
def queue_once(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "curated_list")
    return sets.queue([("failed", 3, rows.filter("status <> 'ok'")), ("untitled", 2, rows.filter("title is null"))], "list_repo", highest_only=True)
