"""The engine's own operators bound to the driver's tables, each over whole tables, with SQL twins for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import jsonx, numbers, strings, urls
from quillmesh.functions.authors import parsed_author
from quillmesh.functions.dates import moment
from quillmesh.functions.fuzzy import sequence_ratio
from quillmesh.operators import aggregates, graph, joins, keywords, passages, policies, quality, ranking, sets
from quillmesh.plans import ask
from quillmesh.plans.registry import query
from quillmesh.tables import table

AS_OF = "2026-06-30"
TABLES = (
    "bank_capability_pick", "category", "curated_list", "customer", "documents", "embeddings", "entry", "events", "identity_claim", "lineitem", "mix_target", "nation", "orders", "part", "person", "region", "repo_observation",
    "source_trust", "supplier",
)

# Parameters of the routing queries: families and their terms with weights.
FAMILIES = {
    "graphs": {"graph traversal": 4, "graph": 2, "stream joins": 2},
    "search": {"vector search": 4, "search": 2, "index": 1, "retrieval": 3},
    "security": {"secret rotation": 4, "access control": 4, "license checks": 2},
    "storage": {"schema migration": 4, "schema": 1, "vault": 1, "offline sync": 3},
}
SIGNALS = {"graphs": ["graph", "joins"], "search": ["search", "index", "retrieval"], "storage": ["schema", "vault", "sync"]}




# --- ranks and scores ---------------------------------------------------------------------------------------------

CROSS_RANK_SQL = """
WITH d AS (SELECT o_custkey AS c_custkey, count(DISTINCT o_orderpriority) AS domains FROM orders GROUP BY 1),
c AS (SELECT c_custkey, c_nationkey, c_acctbal, rank() OVER w AS r, count(*) OVER (PARTITION BY c_nationkey, c_acctbal) AS ties,
        count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal))
SELECT c_custkey, c_nationkey, round(CASE WHEN n > 1 THEN (r - 1 + (ties - 1) / 2.0) / (n - 1) * 100 ELSE 50 END, 6) AS percentile,
    coalesce(domains, 0)::BIGINT AS domains,
    round(0.9 * CASE WHEN n > 1 THEN (r - 1 + (ties - 1) / 2.0) / (n - 1) * 100 ELSE 50 END + 0.1 * least(coalesce(domains, 0), 3) / 3.0 * 100, 6) AS score
FROM c LEFT JOIN d USING (c_custkey)
"""


@query("cross_rank", CROSS_RANK_SQL)
def cross_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Tie-midpoint percentile within the group, joined with breadth."""
    domains = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_distinct("o_orderpriority").alias("domains"))
    ranked = ranking.tie_midpoint_percentile(table(spark, folder, "customer"), ["c_nationkey"], "c_acctbal").join(domains, "c_custkey", "left").na.fill(0, ["domains"])
    score = graph.cross_score(F.col("percentile"), F.col("domains"))
    return ranked.select("c_custkey", "c_nationkey", F.round("percentile", 6).alias("percentile"), "domains", F.round(score, 6).alias("score"))


PERSON_RANK_SQL = """
WITH p AS (SELECT DISTINCT person_id, origin, coalesce(rank_score, 0) AS s FROM person WHERE coalesce(state, '') <> 'merged'),
r AS (SELECT *, rank() OVER (PARTITION BY origin ORDER BY s) AS r, count(*) OVER (PARTITION BY origin, s) AS ties, count(*) OVER (PARTITION BY origin) AS n FROM p)
SELECT person_id, origin, round(CASE WHEN n > 1 THEN (r - 1 + (ties - 1) / 2.0) / (n - 1) * 100 ELSE 50 END, 6) AS percentile FROM r
"""


@query("person_percentile", PERSON_RANK_SQL)
def person_percentile(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "person").filter(F.coalesce("state", F.lit("")) != "merged").select("person_id", "origin", F.coalesce("rank_score", F.lit(0.0)).alias("s")).distinct()
    return ranking.tie_midpoint_percentile(people, ["origin"], "s").select("person_id", "origin", F.round("percentile", 6).alias("percentile"))


COMPOSITE_SQL = """
WITH s AS (SELECT p_brand, p_partkey, p_size, round(0.6 * p_size / 50.0 + 0.4 * p_retailprice / 2000.0, 4) AS score FROM part),
r AS (SELECT *, dense_rank() OVER (PARTITION BY p_brand ORDER BY score DESC, p_size DESC, p_partkey) AS rank FROM s WHERE score > 0),
k AS (SELECT * FROM r WHERE rank <= 3),
w AS (SELECT *, first_value(score) OVER b AS s1, nth_value(score, 2) OVER b AS s2 FROM k
    WINDOW b AS (PARTITION BY p_brand ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT p_brand, p_partkey, score, rank::INTEGER AS rank, (CASE WHEN rank = 1 THEN 1 WHEN s1 - s2 <= 0.08 AND score >= 0.55 * s1 THEN 1 ELSE 0 END)::INTEGER AS is_winner FROM w
"""


@query("composite_winners", COMPOSITE_SQL)
def composite_winners(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted composite, dense rank within the group, winners by gap and share."""
    score = F.round(0.6 * F.col("p_size") / 50.0 + 0.4 * F.col("p_retailprice") / 2000.0, 4)
    scored = table(spark, folder, "part").select("p_brand", "p_partkey", "p_size", score.alias("score")).filter("score > 0")
    top = ranking.ranked(scored, ["p_brand"], [F.desc("score"), F.desc("p_size"), F.col("p_partkey")], top=3)
    return ranking.winners(top, ["p_brand"], rank="rank", score="score").select("p_brand", "p_partkey", "score", "rank", "is_winner")


TIERS_SQL = """
WITH c AS (SELECT c_custkey, c_acctbal / 100.0 AS score, c_acctbal > 0 AS counted FROM customer),
o AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM c WHERE counted),
cuts AS (SELECT max(CASE WHEN i = least(n - 1, floor(0.995 * n)) THEN score END) AS a, max(CASE WHEN i = least(n - 1, floor(0.9 * n)) THEN score END) AS b,
    max(CASE WHEN i = least(n - 1, floor(0.7 * n)) THEN score END) AS c FROM o)
SELECT c_custkey, CASE WHEN NOT counted THEN 'none' WHEN score >= greatest(88.0, a) THEN 'top' WHEN score >= least(greatest(55.0, b), greatest(88.0, a) - 0.01) THEN 'mid'
    WHEN score >= least(greatest(35.0, cuts.c), least(greatest(55.0, b), greatest(88.0, a) - 0.01) - 0.01) THEN 'low' ELSE 'none' END AS tier
FROM c, cuts
"""


@query("distribution_tiers", TIERS_SQL)
def distribution_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Tiers cut from the distribution itself, with floors, always falling."""
    scored = table(spark, folder, "customer").select("c_custkey", (F.col("c_acctbal") / 100.0).alias("score"), (F.col("c_acctbal") > 0).alias("counted"))
    return ranking.tiers(scored, "score", F.col("counted"), [("top", 0.995, 88.0), ("mid", 0.9, 55.0), ("low", 0.7, 35.0)], "none").select("c_custkey", "tier")


@query("top_orders", """
SELECT o_orderpriority, o_orderkey, place FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS place FROM orders)
WHERE place <= 12""")
def top_orders(spark: SparkSession, folder: str) -> DataFrame:
    top = ranking.top_per_group(table(spark, folder, "orders"), ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 12)
    return top.select("o_orderpriority", "o_orderkey", "place")


@query("stratified_quota", """
WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey)::INTEGER AS place FROM customer)
SELECT c_custkey, c_mktsegment, place FROM r WHERE place <= 20 ORDER BY list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment), place LIMIT 97""")
def stratified_quota(spark: SparkSession, folder: str) -> DataFrame:
    """A sampling operator: a quota per band, in all no more than asked."""
    bands = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    picked = ranking.stratified(table(spark, folder, "customer"), "c_mktsegment", bands, [F.desc("c_acctbal"), F.col("c_custkey")], 97)
    return picked.select("c_custkey", "c_mktsegment", "place")


@query("demoted_copies", """
SELECT id, full_name, (CASE WHEN row_number() OVER (PARTITION BY full_name ORDER BY liftability DESC NULLS LAST, id) > 1 THEN 0 ELSE liftability END)::INTEGER AS liftability
FROM (SELECT DISTINCT id, full_name, liftability FROM bank_capability_pick)""")
def demoted_copies(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "bank_capability_pick").select("id", "full_name", "liftability").distinct()
    return ranking.demote_copies(rows, ["full_name"], [F.desc_nulls_last("liftability"), F.col("id")], "liftability")


@query("best_observation", """
SELECT canonical_id, obs_id, field_score FROM (
    SELECT *, row_number() OVER (PARTITION BY canonical_id ORDER BY field_score DESC, obs_id DESC) AS p FROM (
        SELECT DISTINCT canonical_id, obs_id, (CASE WHEN stars IS NOT NULL THEN 4 ELSE 0 END + CASE WHEN trim(description) <> '' THEN 4 ELSE 0 END
            + CASE WHEN trim(observed_at) <> '' THEN 2 ELSE 0 END + CASE WHEN trim(source_record_id) <> '' THEN 2 ELSE 0 END)::INTEGER AS field_score
        FROM repo_observation WHERE canonical_id IS NOT NULL)) WHERE p = 1""")
def best_observation(spark: SparkSession, folder: str) -> DataFrame:
    """The richest sighting of each repository, the latest of ties."""
    rows = table(spark, folder, "repo_observation").filter("canonical_id is not null").select("canonical_id", "obs_id", "stars", "description", "observed_at", "source_record_id").distinct()
    best = graph.best_rows(rows, ["canonical_id"], {"stars": 4, "description": 4, "observed_at": 2, "source_record_id": 2}, [F.desc("obs_id")])
    return best.select("canonical_id", "obs_id", "field_score")


@query("packed_assets", """
WITH RECURSIVE d AS (SELECT coalesce(source, '') AS source, doc_id, strlen(coalesce(text, '')) AS size, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) AS i FROM documents),
r AS (SELECT source, doc_id, i, size, 0 AS asset, 0::BIGINT AS place FROM d WHERE i = 1 UNION ALL SELECT d.source, d.doc_id, d.i, d.size, CASE WHEN r.place + r.size > 0 AND r.place + r.size + d.size > 65536 THEN r.asset + 1 ELSE r.asset END,
    CASE WHEN r.place + r.size > 0 AND r.place + r.size + d.size > 65536 THEN 0 ELSE r.place + r.size END FROM r JOIN d ON d.source = r.source AND d.i = r.i + 1)
SELECT source, doc_id, asset, place FROM r""")
def packed_assets(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of each source packed in order into assets of at most 64 KB: greedy, so sequential within a source."""
    docs = table(spark, folder, "documents").select(F.coalesce("source", F.lit("")).alias("source"), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    return ranking.packed_in_order(docs, ["source"], [F.col("doc_id")], "size", 65_536).select("source", "doc_id", "asset", F.col("offset").alias("place"))


# --- write policies -----------------------------------------------------------------------------------------------

_CARDS = "SELECT DISTINCT source, normalized_url, obs_id, stars, description FROM repo_observation"


@query("keep_first", f"""
WITH o AS ({_CARDS}), old AS (SELECT * FROM o WHERE source = 'curated/registry-sync.json'),
fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY normalized_url ORDER BY obs_id) AS p FROM o) WHERE p = 1)
SELECT obs_id, normalized_url, stars FROM old UNION ALL
SELECT obs_id, normalized_url, stars FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.normalized_url = f.normalized_url)""")
def keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """All sightings merged into those of one source: what exists stays, of the rest the first per address."""
    rows = table(spark, folder, "repo_observation").select("source", "normalized_url", "obs_id", "stars").distinct()
    merged = policies.keep_first(rows.filter("source = 'curated/registry-sync.json'"), rows, ["normalized_url"], [F.col("obs_id")])
    return merged.select("obs_id", "normalized_url", "stars")


@query("keep_last", f"""
WITH o AS ({_CARDS}), n AS (SELECT normalized_url, obs_id, stars FROM (SELECT *, row_number() OVER (PARTITION BY normalized_url ORDER BY obs_id DESC) AS p FROM o WHERE obs_id % 2 = 0) WHERE p = 1),
old AS (SELECT normalized_url, obs_id, stars FROM (SELECT *, row_number() OVER (PARTITION BY normalized_url ORDER BY obs_id DESC) AS p FROM o WHERE obs_id % 2 = 1) WHERE p = 1)
SELECT * FROM n UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.normalized_url = old.normalized_url)""")
def keep_last(spark: SparkSession, folder: str) -> DataFrame:
    """The even sightings merged into a table of the odd ones: what is new replaces, what has no successor stays."""
    rows = table(spark, folder, "repo_observation").select("source", "normalized_url", "obs_id", "stars").distinct()
    old = policies.one_per_key(rows.filter("obs_id % 2 = 1"), ["normalized_url"], [F.desc("obs_id")])
    merged = policies.keep_last(old, rows.filter("obs_id % 2 = 0"), ["normalized_url"], [F.desc("obs_id")])
    return merged.select("normalized_url", "obs_id", "stars")


@query("fill_nulls", f"""
WITH o AS ({_CARDS}), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY normalized_url ORDER BY obs_id) AS p FROM o) WHERE p = 1),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY normalized_url ORDER BY obs_id DESC) AS p FROM o) WHERE p = 1)
SELECT f.normalized_url, coalesce(f.stars, l.stars) AS stars, coalesce(f.description, l.description) AS description FROM f LEFT JOIN l ON l.normalized_url = f.normalized_url""")
def fill_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """The first sighting of each address, its nulls filled from the last."""
    rows = table(spark, folder, "repo_observation").select("source", "normalized_url", "obs_id", "stars", "description").distinct()
    first = policies.one_per_key(rows, ["normalized_url"], [F.col("obs_id")])
    last = policies.one_per_key(rows, ["normalized_url"], [F.desc("obs_id")])
    return policies.fill(first, last, ["normalized_url"], ["stars", "description"]).select("normalized_url", "stars", "description")


@query("merged_meta", """
WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE (props->>'$.k')::BIGINT END AS k, 't' || event_id % 4 AS name, event_id AS v FROM events)
SELECT user_id, arg_max(k, event_id) AS k, max(v) FILTER (WHERE name = 't0') AS t0, max(v) FILTER (WHERE name = 't3') AS t3, min(v) AS first FROM e GROUP BY 1""")
def merged_meta(spark: SparkSession, folder: str) -> DataFrame:
    """JSON objects of all events merged key by key, later values winning unless null."""
    events = table(spark, folder, "events").select("user_id", "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    name = F.concat(F.lit("t"), (F.col("event_id") % 4).cast("string"))
    entries = F.filter(F.array(F.struct(F.lit("k").alias("key"), F.when(F.col("event_id") % 3 != 0, F.col("k")).alias("value")), F.struct(name.alias("key"), F.col("event_id").alias("value"))), lambda x: x["value"].isNotNull())
    last = events.select("user_id", "event_id", F.explode(entries).alias("e")).groupBy("user_id", "e.key").agg(F.max_by("e.value", "event_id").alias("value"))
    objects = last.groupBy("user_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", "value")))).alias("new"))
    old = events.groupBy("user_id").agg(F.to_json(F.struct(F.min("event_id").alias("first"), F.lit(-1).alias("k"), F.lit("x").alias("t0"))).alias("old"))
    meta = old.join(objects, "user_id").select("user_id", jsonx.merged(F.col("old"), F.col("new")).alias("meta"))
    return meta.select("user_id", *[F.get_json_object("meta", f"$.{c}").try_cast("bigint").alias(c) for c in ("k", "t0", "t3", "first")])


@query("moved_links", """
WITH p AS (SELECT DISTINCT person_id, merged_into FROM person), l AS (SELECT DISTINCT person_id, origin AS topic FROM person),
m AS (SELECT l.person_id, topic, merged_into, coalesce(merged_into, l.person_id) AS goal FROM l LEFT JOIN p ON p.person_id = l.person_id AND merged_into IS NOT NULL)
SELECT CASE WHEN row_number() OVER (PARTITION BY goal, topic ORDER BY merged_into IS NOT NULL, person_id) = 1 THEN goal ELSE person_id END AS person_id, topic FROM m""")
def moved_links(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "person")
    links = people.select("person_id", F.col("origin").alias("topic")).distinct()
    moves = people.filter("merged_into is not null").select("person_id", "merged_into").distinct()
    return policies.move_links(links, moves, member="person_id", target="merged_into", unique=["person_id", "topic"])


@query("lossless_fields", """
SELECT list_repo, field, value FROM (UNPIVOT (SELECT list_repo, title, topic, depth::VARCHAR AS depth, stars::VARCHAR AS stars, readme_path, n_entries::VARCHAR AS n_entries, status, fetched_at FROM curated_list)
    ON title, topic, depth, stars, readme_path, n_entries, status, fetched_at INTO NAME field VALUE value)""")
def lossless_fields(spark: SparkSession, folder: str) -> DataFrame:
    return policies.unpivoted(table(spark, folder, "curated_list"), ["list_repo"])


# --- filters, functions -------------------------------------------------------------------------------------------


@query("addresses", """
WITH o AS (SELECT DISTINCT observed_url FROM repo_observation),
s AS (SELECT observed_url, regexp_replace(regexp_replace(regexp_replace(trim(observed_url), '^<+|>+$', '', 'g'), '[).,;]+$', ''), '^git\\+', '') AS u FROM o),
t AS (SELECT *, regexp_replace(lower(regexp_extract(u, '^[^:]+://([^/?#]*)', 1)), '^www\\.', '') AS host, lower(regexp_extract(u, '^[^:]+://[^/?#]*/+([^?#]*)', 1)) AS path FROM s),
n AS (SELECT observed_url, u, CASE WHEN regexp_matches(path, '^[^/]+/+[^/]') AND host <> '' THEN
    'https://' || host || '/' || regexp_extract(path, '^([^/]+)/+', 1) || '/' || regexp_replace(regexp_extract(path, '^[^/]+/+([^/]+)', 1), '\\.git$', '') END AS normalized FROM t)
SELECT observed_url, normalized, 'provisional:' || sha256(normalized) AS canonical,
    nullif(regexp_replace(regexp_extract(lower(observed_url), 'github\\.com[/:]([^/\\s]+/[^/\\s?#]+)', 1), '\\.git$', ''), '') AS repository
FROM n WHERE observed_url IS NOT NULL""")
def addresses(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses cleaned, normalised and hashed."""
    rows = table(spark, folder, "repo_observation").select("observed_url").distinct().filter("observed_url is not null")
    rows = rows.withColumn("normalized", urls.normalized_repository_url(F.col("observed_url")))
    return rows.select("observed_url", "normalized", urls.provisional_id(F.col("normalized")).alias("canonical"), urls.repository_from_url(F.col("observed_url")).alias("repository"))


@query("plain_names", """
WITH n AS (SELECT DISTINCT name FROM person WHERE name IS NOT NULL),
p AS (SELECT name, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(name), '\\([^)]*\\)', ' ', 'g'), '[^a-z\\s,]', ' ', 'g'),
    '\\b(?:sir|dame|lord|lady|baron|baroness|earl|duke|rev|dr|prof|jr|sr|saint|st|mrs|mr|ms|of|the)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS plain FROM n)
SELECT name, plain, CASE WHEN contains(plain, ',') THEN trim(split_part(plain, ',', 1)) WHEN contains(plain, ' ') THEN regexp_extract(plain, '([^ ]+)$', 1) ELSE plain END AS surname,
    CASE WHEN contains(plain, ',') THEN trim(regexp_replace(plain, '^[^,]*,', '')) WHEN contains(plain, ' ') THEN regexp_extract(plain, '^(.*) [^ ]+$', 1) ELSE '' END AS given FROM p""")
def plain_names(spark: SparkSession, folder: str) -> DataFrame:
    parts = strings.parts_of_plain_name(F.col("plain"))
    rows = table(spark, folder, "person").select("name").distinct().filter("name is not null").withColumn("plain", strings.plain_name(F.col("name")))
    return rows.select("name", "plain", parts["surname"].alias("surname"), parts["given"].alias("given"))


@query("topic_slugs", """
SELECT list_repo, regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(list_repo, '^[^/]*/', '')), '^awesome[-_]?', ''), '[-_]?awesome$', ''), '^lists?[-_]', '') AS topic_slug,
    regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS title_slug, split_part(list_repo, '/', 1) AS owner,
    contains(lower(regexp_replace(list_repo, '^[^/]*/', '')), 'awesome') AS named_list FROM curated_list""")
def topic_slugs(spark: SparkSession, folder: str) -> DataFrame:
    repo = F.col("list_repo")
    return table(spark, folder, "curated_list").select(
        repo, strings.topic_slug(repo).alias("topic_slug"), strings.slug(F.coalesce("title", F.lit(""))).alias("title_slug"), strings.owner(repo).alias("owner"), strings.named_like_a_list(repo).alias("named_list")
    )


@query("list_values", """
WITH p AS (SELECT DISTINCT person_id, topics_json FROM person), v AS (SELECT person_id, CASE WHEN json_valid(topics_json) THEN topics_json ELSE '[]' END AS j FROM p)
SELECT person_id, coalesce(array_to_string(list_transform(CAST(j AS VARCHAR[]), lambda x: lower(trim(x))), '|'), '') AS topics FROM v""")
def list_values(spark: SparkSession, folder: str) -> DataFrame:
    """JSON arrays read safely: what isn't one is empty."""
    rows = table(spark, folder, "person").select("person_id", "topics_json").distinct()
    return rows.select("person_id", F.array_join(strings.string_list(F.col("topics_json")), "|").alias("topics"))


@query("meta_presence", """
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE props->>'$.k' IS NOT NULL) AS with_k, sum((props->>'$.k')::BIGINT)::BIGINT AS total FROM events GROUP BY 1""")
def meta_presence(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(jsonx.has_key(F.col("props"), "k")).alias("with_k"), F.sum(k).alias("total"))


@query("scales", f"""
WITH p AS (SELECT DISTINCT id, stars, pushed FROM bank_capability_pick)
SELECT id, round(CASE WHEN stars > 0 THEN least(100.0, log10(stars + 1) * 20) ELSE 0 END, 6) AS fame, round(least(1.0, ln(1 + stars) / ln(301)), 4) AS weight,
    round(100 * pow(0.5, greatest(0.0, coalesce(date_diff('day', TRY_CAST(pushed AS DATE), DATE '{AS_OF}') / 365.25, 99)) / 2.5), 6) AS fresh,
    CASE WHEN TRY_CAST(pushed AS DATE) IS NULL THEN 0.0 WHEN date_diff('day', TRY_CAST(pushed AS DATE), DATE '{AS_OF}') <= 90 THEN 8.0
        WHEN date_diff('day', TRY_CAST(pushed AS DATE), DATE '{AS_OF}') <= 365 THEN 5.0 WHEN date_diff('day', TRY_CAST(pushed AS DATE), DATE '{AS_OF}') <= 1095 THEN 2.0 ELSE -4.0 END::DOUBLE AS step
FROM p""")
def scales(spark: SparkSession, folder: str) -> DataFrame:
    """Logarithmic, saturating and decaying scales against a given day."""
    day, as_of = F.col("pushed").try_cast("date"), F.lit(AS_OF).cast("date")
    rows = table(spark, folder, "bank_capability_pick").select("id", "stars", "pushed").distinct()
    return rows.select(
        "id", F.round(numbers.log_scale(F.col("stars"), 20.0), 6).alias("fame"), numbers.saturating_weight(F.col("stars")).alias("weight"), F.round(numbers.half_life_freshness(day, as_of), 6).alias("fresh"),
        numbers.stepped(F.datediff(as_of, day), [(90, 8.0), (365, 5.0), (1095, 2.0)], -4.0, 0.0).alias("step"),
    )


@query("life_spans", """
WITH p AS (SELECT DISTINCT person_id, birth_year AS b, death_year AS d FROM person)
SELECT person_id, CASE WHEN coalesce(b, d) IS NOT NULL THEN coalesce(CASE WHEN b < 0 THEN (-b)::VARCHAR || ' BCE' ELSE b::VARCHAR END, '?') || '-' || coalesce(CASE WHEN d < 0 THEN (-d)::VARCHAR || ' BCE' ELSE d::VARCHAR END, '?') END AS lived FROM p""")
def life_spans(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "person").select("person_id", "birth_year", "death_year").distinct()
    return rows.select("person_id", numbers.life_span(F.col("birth_year"), F.col("death_year")).alias("lived"))


@query("authors", r"""
WITH p AS (SELECT DISTINCT trim(sort_name) AS s, birth_year AS b, death_year AS d FROM person WHERE trim(sort_name) <> '' AND NOT contains(sort_name, '[')), n AS (SELECT *, trim(trim(s, ',')) AS name, b > 99 AND (d IS NULL OR d > 99) AS dated FROM p)
SELECT s AS raw, name, CASE WHEN dated THEN b END AS birth, CASE WHEN dated THEN d END AS death, 'editor' AS role, (lower(name) IN ('anonymous', 'unknown', 'various') OR (NOT contains(name, ',') AND NOT coalesce(dated, false)))::INTEGER AS corporate FROM n WHERE name <> ''""")
def authors(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue strings of people read into name, years, role and kind (a Python function over Arrow batches)."""
    rows = table(spark, folder, "person").filter("trim(sort_name) <> '' and instr(sort_name, '[') = 0").select(F.trim("sort_name").alias("raw"), "birth_year", "death_year").distinct()
    years = F.concat(F.col("birth_year").cast("string"), F.lit("-"), F.coalesce(F.col("death_year").cast("string"), F.lit("")))
    dated = (F.col("birth_year") > 99) & (F.col("death_year").isNull() | (F.col("death_year") > 99))
    text = F.concat(F.when(dated, F.concat_ws(", ", "raw", years)).otherwise(F.col("raw")), F.lit(" [Editor]"))
    return rows.withColumn("a", parsed_author(text)).select("raw", "a.*").filter("name is not null")


@query("name_ratios")
def name_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """How like one another both spellings of each row are."""
    rows = table(spark, folder, "person").select("person_id", "name", "sort_name").filter("name is not null and sort_name is not null").distinct()
    return rows.withColumn("ratio", F.round(sequence_ratio(F.lower("name"), F.lower("sort_name")), 6))


# --- joins --------------------------------------------------------------------------------------------------------


@query("lists_without_entries", """
SELECT list_repo FROM curated_list c WHERE NOT EXISTS (SELECT 1 FROM entry e WHERE e.list_repo = c.list_repo)""")
def lists_without_entries(spark: SparkSession, folder: str) -> DataFrame:
    return sets.missing_from(table(spark, folder, "curated_list").select("list_repo"), table(spark, folder, "entry"), ["list_repo"])


@query("customers_with_orders", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def customers_with_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, folder, "customer").join(orders, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("overlapping_spans", """
WITH s AS (SELECT c_nationkey AS n, c_custkey AS c, epoch(min(o_orderdate))::BIGINT AS a, epoch(max(o_orderdate))::BIGINT + 1 AS b FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT x.n AS nation, count(*) AS pairs, sum(least(x.b, y.b) - greatest(x.a, y.a))::BIGINT AS overlap FROM s x JOIN s y ON x.n = y.n AND x.c < y.c AND greatest(x.a, y.a) < least(x.b, y.b) GROUP BY 1""")
def overlapping_spans(spark: SparkSession, folder: str) -> DataFrame:
    """How many customers of a nation have overlapping spans of orders, and how long: counted by a sweep, without the pairs."""
    pairs = table(spark, folder, "customer").join(table(spark, folder, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    spans = pairs.groupBy(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("c")).agg(F.min(at).alias("a"), (F.max(at) + 1).alias("b"))
    return joins.overlap_totals(spans, ["nation"], start="a", end="b")


@query("latest_error", """
SELECT e.event_id, (SELECT arg_max(x.event_id, (x.ts, x.event_id)) FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'error' AND x.ts <= e.ts) AS last_event_id FROM events e""")
def latest_error(spark: SparkSession, folder: str) -> DataFrame:
    """As-of join: the last error of the user up to each event."""
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    errors = events.filter("event_type = 'error'").select("user_id", "ts", "event_id")
    return joins.latest_before(events, errors, ["user_id"], at="ts", values=["event_id"], tie="event_id").select("event_id", "last_event_id")


@query("name_claims", """
WITH n AS (SELECT DISTINCT person_id, name, birth_year AS b, death_year AS d, origin AS o FROM person WHERE coalesce(state, '') <> 'merged'),
q AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(name, '')), '\\([^)]*\\)', ' ', 'g'), '[^a-z\\s,]', ' ', 'g'),
    '\\b(?:sir|dame|lord|lady|baron|baroness|earl|duke|rev|dr|prof|jr|sr|saint|st|mrs|mr|ms|of|the)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS n FROM n),
r AS (SELECT *, CASE WHEN contains(n, ',') THEN trim(split_part(n, ',', 1)) WHEN contains(n, ' ') THEN regexp_extract(n, '([^ ]+)$', 1) ELSE n END AS s,
    substr(CASE WHEN contains(n, ',') THEN trim(regexp_replace(n, '^[^,]*,', '')) WHEN contains(n, ' ') THEN n ELSE '' END, 1, 1) AS i FROM q),
p AS (SELECT x.person_id AS person_a, y.person_id AS person_b, CASE WHEN x.n = y.n AND x.n <> '' AND coalesce(x.b, x.d) IS NOT NULL AND coalesce(y.b, y.d) IS NOT NULL THEN 3
        WHEN x.n = y.n AND x.n <> '' AND x.o <> y.o THEN 2 WHEN x.s = y.s AND x.i = y.i AND length(x.s) >= 4 AND x.o <> y.o THEN 1 ELSE 0 END AS m
    FROM r x JOIN r y ON x.person_id < y.person_id AND x.s = y.s AND coalesce(abs(x.b - y.b) <= 2, true) AND coalesce(abs(x.d - y.d) <= 2, true))
SELECT person_a, person_b, CASE m WHEN 3 THEN 'name_plus_years' WHEN 2 THEN 'exact_name' ELSE 'surname_initial' END AS method, CASE m WHEN 3 THEN 0.9 WHEN 2 THEN 0.55 ELSE 0.45 END::DOUBLE AS confidence FROM p WHERE m > 0""")
def name_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims by name and years: blocks, compatibility, the strongest per pair."""
    people = table(spark, folder, "person").filter(F.coalesce("state", F.lit("")) != "merged").select("person_id", "name", "birth_year", "death_year", "origin").distinct()
    return graph.claims(people, None, person="person_id", name="name", birth="birth_year", death="death_year", origin="origin")


@query("matched_by_name", """
WITH p AS (SELECT DISTINCT person_id, lower(name) AS n, origin FROM person WHERE name IS NOT NULL),
m AS (SELECT n, min(person_id) AS matched, count(DISTINCT person_id) AS candidates FROM p WHERE origin = 'github' GROUP BY 1)
SELECT person_id, matched, candidates, CASE WHEN candidates = 1 THEN 0.9 ELSE 0.4 END::DOUBLE AS confidence FROM p JOIN m USING (n) WHERE origin <> 'github'""")
def matched_by_name(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "person").filter("name is not null").select("person_id", F.lower("name").alias("n"), "origin").distinct()
    github = people.filter("origin = 'github'").select("n", F.col("person_id").alias("candidate"))
    return joins.match_by_name(people.filter("origin <> 'github'"), github, name="n", person="candidate").select("person_id", "matched", "candidates", "confidence")


@query("collapsed_names", """
SELECT person_id, CASE WHEN name IS NULL THEN person_id ELSE min(person_id) OVER (PARTITION BY lower(name)) END AS identifier FROM (SELECT DISTINCT person_id, name FROM person)""")
def collapsed_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "person").select("person_id", F.lower("name").alias("n"), F.col("person_id").alias("identifier")).distinct()
    return joins.collapse_by_name(rows, name="n", identifier="identifier", order=[F.col("person_id")]).select("person_id", "identifier")


@query("enriched_edges", """
WITH e AS (SELECT DISTINCT lower(full_name) AS repo, category_id FROM bank_capability_pick), s AS (SELECT lower(target_repo) AS repo, count(DISTINCT list_repo) AS lists FROM entry WHERE target_repo IS NOT NULL GROUP BY 1)
SELECT repo, category_id, lists FROM e LEFT JOIN s USING (repo)""")
def enriched_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges with a signal from another source; what matches nothing creates nothing."""
    edges = table(spark, folder, "bank_capability_pick").select(F.lower("full_name").alias("repo"), "category_id").distinct()
    cited = table(spark, folder, "entry").filter("target_repo is not null").groupBy(F.lower("target_repo").alias("repo")).agg(F.count_distinct("list_repo").alias("lists"))
    return joins.enrich(edges, cited, ["repo"], ["lists"])[0]


@query("enrichment_counts", """
WITH e AS (SELECT DISTINCT lower(full_name) AS repo, category_id FROM bank_capability_pick), s AS (SELECT DISTINCT lower(target_repo) AS repo FROM entry WHERE target_repo IS NOT NULL)
SELECT (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM e JOIN s USING (repo)) AS matched, (SELECT count(*) FROM s WHERE repo NOT IN (SELECT repo FROM e WHERE repo IS NOT NULL)) AS unmatched_source""")
def enrichment_counts(spark: SparkSession, folder: str) -> DataFrame:
    edges = table(spark, folder, "bank_capability_pick").select(F.lower("full_name").alias("repo"), "category_id").distinct()
    cited = table(spark, folder, "entry").filter("target_repo is not null").groupBy(F.lower("target_repo").alias("repo")).agg(F.count_distinct("list_repo").alias("lists"))
    return joins.enrich(edges, cited, ["repo"], ["lists"])[1]


# --- aggregates ---------------------------------------------------------------------------------------------------


@query("weighted_means", """
SELECT owner, round(sum(m * n) / sum(n), 8) AS mean, sum(n)::BIGINT AS n FROM (SELECT split_part(full_name, '/', 1) AS owner, category_id, avg(score) AS m, count(*) AS n
    FROM bank_capability_pick WHERE score IS NOT NULL AND NOT isnan(score) AND contains(full_name, '/') GROUP BY 1, 2) GROUP BY 1""")
def weighted_means(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "bank_capability_pick").filter("not isnan(score)").select(strings.owner(F.col("full_name")).alias("owner"), "category_id", "score").filter("owner is not null")
    return aggregates.weighted_mean(rows, ["category_id"], ["owner"], "score").select("owner", F.round("mean", 8).alias("mean"), "n")


@query("top_repository", """
SELECT owner, id, stars AS score FROM (SELECT split_part(full_name, '/', 1) AS owner, id, stars, row_number() OVER (PARTITION BY split_part(full_name, '/', 1) ORDER BY stars DESC, id) AS p
    FROM bank_capability_pick WHERE stars IS NOT NULL AND contains(full_name, '/')) WHERE p = 1""")
def top_repository(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "bank_capability_pick").select(strings.owner(F.col("full_name")).alias("owner"), "id", "stars").filter("owner is not null and stars is not null")
    return aggregates.argmax(rows, ["owner"], "id", F.col("stars"), F.col("id"))


@query("last_descriptions", """
SELECT canonical_id, arg_max(description, obs_id) FILTER (WHERE description <> '') AS description FROM repo_observation WHERE canonical_id IS NOT NULL GROUP BY 1""")
def last_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.last_non_empty(table(spark, folder, "repo_observation").filter("canonical_id is not null"), ["canonical_id"], "description", "obs_id")


@query("winner_rates", """
SELECT category_id, count(*) AS n, count(*) FILTER (WHERE is_winner = 1) AS hits, CASE WHEN count(*) >= 5 THEN round(count(*) FILTER (WHERE is_winner = 1) / count(*), 4) END AS rate FROM bank_capability_pick GROUP BY 1""")
def winner_rates(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.rate_per_key(table(spark, folder, "bank_capability_pick"), ["category_id"], F.col("is_winner") == 1)


@query("band_coverage", """
SELECT CASE WHEN stars IS NULL THEN 'unknown' WHEN stars < 100 THEN 'low' WHEN stars < 10000 THEN 'mid' ELSE 'high' END AS band, count(*) AS n, count(*) FILTER (WHERE source_format = 'json') AS n_json,
    count(*) FILTER (WHERE source_format = 'csv') AS n_csv, count(*) FILTER (WHERE trim(description) <> '') AS has_description, count(*) FILTER (WHERE trim(observed_at) <> '') AS has_observed_at FROM repo_observation GROUP BY 1""")
def band_coverage(spark: SparkSession, folder: str) -> DataFrame:
    band = F.when(F.col("stars").isNull(), "unknown").when(F.col("stars") < 100, "low").when(F.col("stars") < 10000, "mid").otherwise("high")
    return aggregates.coverage(table(spark, folder, "repo_observation").withColumn("band", band), "band", "source_format", ["json", "csv"], ["description", "observed_at"])


@query("class_by_lane", "SELECT unit_class, legal_lane, count(*) AS n FROM bank_capability_pick GROUP BY 1, 2")
def class_by_lane(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "bank_capability_pick").groupBy("unit_class", "legal_lane").agg(F.count("*").alias("n"))


@query("tree_rollup", """
WITH RECURSIVE up AS (SELECT id AS ancestor, id AS node FROM category UNION ALL SELECT c.parent_id, up.node FROM up JOIN category c ON c.id = up.ancestor WHERE c.parent_id IN (SELECT id FROM category)),
own AS (SELECT category_id AS id, count(*) AS own FROM bank_capability_pick WHERE category_id IS NOT NULL GROUP BY 1)
SELECT c.id, coalesce(o.own, 0)::BIGINT AS own, coalesce((SELECT sum(x.own) FROM up JOIN own x ON x.id = up.node WHERE up.ancestor = c.id), 0)::BIGINT AS total FROM category c LEFT JOIN own o ON o.id = c.id""")
def tree_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Own and inherited counts on a tree; a missing parent makes a root."""
    values = table(spark, folder, "bank_capability_pick").filter("category_id is not null").groupBy(F.col("category_id").alias("id")).agg(F.count("*").alias("v"))
    return aggregates.rolled_up(table(spark, folder, "category").select("id", "parent_id"), values, node="id", parent="parent_id", value="v")


@query("event_trend", """
WITH d AS (SELECT list_sort(array_agg(DISTINCT ts::DATE)) AS days FROM events), e AS (SELECT user_id, ts::DATE AS day, value FROM events),
c AS (SELECT days[1 + len(days) // 2] AS middle, days[1 + least(len(days) - 1, greatest(0, len(days) - len(days) // 3))] AS recent FROM d)
SELECT user_id, round(coalesce(sum(value) FILTER (WHERE day < middle), 0), 4) AS early, round(coalesce(sum(value) FILTER (WHERE day >= middle), 0), 4) AS late,
    round(coalesce(sum(value) FILTER (WHERE day >= recent), 0), 4) AS recent, round(CASE WHEN coalesce(sum(value) FILTER (WHERE day < middle), 0) > 0
        THEN coalesce(sum(value) FILTER (WHERE day >= middle), 0) / sum(value) FILTER (WHERE day < middle) END, 4) AS trend FROM e, c GROUP BY 1""")
def event_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Early, late and recent sums by a window that is learned from the data."""
    rows = table(spark, folder, "events").select("user_id", F.to_date("ts").alias("day"), "value")
    out = aggregates.trend(rows, ["user_id"], day="day", amount="value")
    return out.select("user_id", *[F.round(c, 4).alias(c) for c in ("early", "late", "recent", "trend")])


@query("event_delta", """
SELECT user_id, count(*) AS n, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value,
    round(CASE WHEN count(*) > 1 THEN arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id)) END, 6) AS delta FROM events WHERE value IS NOT NULL GROUP BY 1""")
def event_delta(spark: SparkSession, folder: str) -> DataFrame:
    out = aggregates.first_last_delta(table(spark, folder, "events"), ["user_id"], at="ts", value="value", tie="event_id")
    return out.select("user_id", "n", "first_value", "last_value", F.round("delta", 6).alias("delta"))


@query("status_shares", "SELECT status, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM curated_list), 6) AS percent FROM curated_list GROUP BY 1")
def status_shares(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.share_of_all(table(spark, folder, "curated_list"), ["status"]).select("status", "n", F.round("percent", 6).alias("percent"))


@query("evidence_breadth", """
SELECT p AS person_id, (max((method = 'manual')::INT) + max((method = 'name_plus_years')::INT) + max((method = 'shared_external_id')::INT) + max((method = 'authority_file')::INT))::INTEGER AS breadth
FROM (SELECT person_a AS p, method FROM identity_claim UNION ALL SELECT person_b, method FROM identity_claim) WHERE p IS NOT NULL GROUP BY 1""")
def evidence_breadth(spark: SparkSession, folder: str) -> DataFrame:
    claims = table(spark, folder, "identity_claim")
    rows = claims.select(F.explode(F.array("person_a", "person_b")).alias("person_id"), "method").filter("person_id is not null")
    kinds = {m: F.col("method") == m for m in ("manual", "name_plus_years", "shared_external_id", "authority_file")}
    return aggregates.breadth(rows, "person_id", kinds)


@query("owner_profiles", """
SELECT lower(split_part(full_name, '/', 1)) AS owner, arg_min(split_part(full_name, '/', 1), (id, split_part(full_name, '/', 1))) AS login, count(*) AS repositories, max(stars) AS stars, max(legal_lane) AS lane,
    count(DISTINCT category_id) AS categories FROM bank_capability_pick WHERE strpos(full_name, '/') > 1 GROUP BY 1""")
def owner_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Signals of repositories folded to their owner, whatever the case."""
    signals = {"stars": F.max("stars"), "lane": F.max("legal_lane"), "categories": F.count_distinct("category_id")}
    return graph.owner_profiles(table(spark, folder, "bank_capability_pick"), full_name="full_name", order="id", signals=signals)


@query("identities", """
WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, normalized_url ORDER BY obs_id) AS p FROM (SELECT DISTINCT obs_id, source, normalized_url, canonical_id FROM repo_observation) WHERE canonical_id IS NOT NULL) WHERE p = 1)
SELECT canonical_id, min(obs_id) AS first_seen, max(obs_id) AS last_seen, count(*) AS sightings, count(DISTINCT source) AS sources, round(least(0.95, 0.5 + (count(*) - 1) * 0.05)::DOUBLE, 6) AS confidence FROM o GROUP BY 1""")
def identities(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "repo_observation").select("obs_id", "source", "normalized_url", "canonical_id").distinct()
    out = graph.identities(rows, identity="canonical_id", unique=["source", "normalized_url"], at="obs_id", order=[F.col("obs_id")])
    return out.withColumn("confidence", F.round("confidence", 6))


@query("person_layers", """
WITH p AS (SELECT DISTINCT person_id FROM person WHERE coalesce(state, '') <> 'merged'), e AS (SELECT person_a AS person_id, split_part(person_b, ':', 1) AS domain FROM identity_claim WHERE person_a IS NOT NULL AND person_b IS NOT NULL)
SELECT person_id, count(DISTINCT domain) AS domains, count(domain) AS edges FROM p LEFT JOIN e USING (person_id) GROUP BY 1""")
def person_layers(spark: SparkSession, folder: str) -> DataFrame:
    edges = table(spark, folder, "identity_claim").filter("person_a is not null and person_b is not null").select(F.col("person_a").alias("person_id"), F.substring_index("person_b", ":", 1).alias("domain"))
    people = table(spark, folder, "person").select("person_id", "state").distinct()
    return graph.layers(people, edges, person="person_id", state="state", domain="domain")


@query("merge_chains", """
WITH RECURSIVE m AS (SELECT DISTINCT person_id, merged_into FROM person WHERE merged_into IS NOT NULL), c AS (SELECT person_id, merged_into AS final, 1 AS d FROM m UNION ALL SELECT c.person_id, m.merged_into, d + 1 FROM c JOIN m ON m.person_id = c.final)
SELECT person_id AS person, arg_max(final, d) AS final FROM c GROUP BY 1""")
def merge_chains(spark: SparkSession, folder: str) -> DataFrame:
    return graph.merged_targets(table(spark, folder, "person"), person="person_id", target="merged_into")


# --- sets ---------------------------------------------------------------------------------------------------------


@query("bridge_terms", """
WITH t AS (SELECT DISTINCT person_id AS person, lower(CAST(j AS VARCHAR)) AS term, origin FROM (SELECT person_id, origin, unnest(CAST(CASE WHEN json_valid(topics_json) THEN topics_json ELSE '[]' END AS VARCHAR[])) AS j FROM person) WHERE origin IN ('books', 'github')),
n AS (SELECT term, count(*) FILTER (WHERE origin = 'books') AS b, count(*) FILTER (WHERE origin = 'github') AS g FROM t GROUP BY 1),
p AS (SELECT count(DISTINCT person) FILTER (WHERE origin = 'books') AS b, count(DISTINCT person) FILTER (WHERE origin = 'github') AS g FROM t)
SELECT DISTINCT person, term FROM t JOIN n USING (term), p WHERE n.b > 0 AND n.g > 0 AND n.b <= 0.08 * p.b AND n.g <= 0.08 * p.g AND term <> 'feature flags'""")
def bridge_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Terms that two vocabularies share, and who has them."""
    topics = table(spark, folder, "person").select("person_id", "origin", F.explode(strings.string_list(F.col("topics_json"))).alias("topic"))
    return sets.bridge(topics, ("books", "github"), person="person_id", topic="topic", scheme="origin", stop=["feature flags"], most_share=0.08)


@query("work_queue", """
SELECT list_repo, 'failed' AS reason, 3 AS tier FROM curated_list WHERE status <> 'ok' UNION SELECT list_repo, 'untitled', 2 FROM curated_list WHERE title IS NULL UNION SELECT list_repo, 'uncounted', 1 FROM curated_list WHERE n_entries IS NULL""")
def work_queue(spark: SparkSession, folder: str) -> DataFrame:
    """A queue of several reasons: an item stands in it once per reason."""
    rows = table(spark, folder, "curated_list")
    return sets.queue([("failed", 3, rows.filter("status <> 'ok'")), ("untitled", 2, rows.filter("title is null")), ("uncounted", 1, rows.filter("n_entries is null"))], "list_repo")


@query("merged_candidates", """
SELECT full_name, arg_max(stars, id) AS stars, array_to_string(list_sort(array_agg(DISTINCT unit_class)), '|') AS classes FROM bank_capability_pick WHERE full_name IS NOT NULL AND unit_class IS NOT NULL AND stars IS NOT NULL GROUP BY 1""")
def merged_candidates(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "bank_capability_pick").filter("full_name is not null and unit_class is not null and stars is not null").select("full_name", "id", "stars", F.array("unit_class").alias("classes"))
    merged = sets.merge_candidates(rows, key="full_name", lists=["classes"], scalars=["stars"], order="id")
    return merged.select("full_name", "stars", F.array_join("classes", "|").alias("classes"))


@query("shared_words", """
SELECT lower(topic) AS term FROM (SELECT unnest(string_split(topic, '-')) AS topic FROM curated_list WHERE topic IS NOT NULL) INTERSECT SELECT lower(w) FROM (SELECT unnest(string_split(name, ' ')) AS w FROM category WHERE name IS NOT NULL)""")
def shared_words(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "curated_list").select(F.explode(F.split(F.lower("topic"), "-")).alias("term"))
    b = table(spark, folder, "category").select(F.explode(F.split(F.lower("name"), " ")).alias("term"))
    return a.intersect(b)


# --- text ---------------------------------------------------------------------------------------------------------


def _family_sql() -> str:
    parts = []
    for family, terms in sorted(FAMILIES.items()):
        score = " + ".join(f"CASE WHEN {_term_sql('h', t)} THEN {w} ELSE 0 END" for t, w in terms.items())
        parts.append(f"SELECT doc_id, '{family}' AS family, ({score})::DOUBLE AS score FROM d")
    return "WITH d AS (SELECT doc_id, lower(coalesce(text, '')) || ' ' || regexp_replace(lower(coalesce(text, '')), '[^a-z0-9+#.]+', ' ', 'g') AS h FROM documents), s AS (" + " UNION ALL ".join(parts) + ") SELECT doc_id, family, score FROM s WHERE score > 0"


def _term_sql(column: str, term: str) -> str:
    return f"contains({column}, '{term}')" if " " in term else f"regexp_matches({column}, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"


@query("family_scores", _family_sql())
def family_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted terms of families in whole texts."""
    docs = table(spark, folder, "documents")
    scored = keywords.with_family_scores(docs.select("doc_id", "text"), keywords.haystack(F.col("text")), FAMILIES)
    # explode_outer: a plain explode would have its filter on the array pushed below, where everything is computed again.
    return scored.select("doc_id", F.explode_outer("family_scores").alias("s")).filter("s is not null").select("doc_id", "s.family", "s.score")


def _route_sql() -> str:
    tags = ", ".join("CASE WHEN " + " OR ".join(f"regexp_matches(d, '(^|[^a-z0-9]){s}($|[^a-z0-9])')" for s in signals) + f" THEN '{f}' END" for f, signals in sorted(SIGNALS.items()))
    return f"""WITH t AS (SELECT id, list_filter([{tags}], lambda x: x IS NOT NULL) AS tags FROM (SELECT id, lower(coalesce(definition, '')) AS d FROM category))
        SELECT id, array_to_string(tags, '|') AS tags, CASE len(tags) WHEN 0 THEN 'dark' WHEN 1 THEN 'clean' ELSE 'ambiguous' END AS bucket FROM t"""


@query("routes", _route_sql())
def routes(spark: SparkSession, folder: str) -> DataFrame:
    routed = keywords.routed(table(spark, folder, "category"), F.array().cast("array<string>"), F.col("definition"), SIGNALS)
    return routed.select("id", F.array_join("tags", "|").alias("tags"), "bucket")


@query("document_words", """
SELECT doc_id, len(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_]{4,}'))) AS words, len(list_filter(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_]{4,}')), lambda x: x IN ('with', 'that'))) AS stops FROM documents""")
def document_words(spark: SparkSession, folder: str) -> DataFrame:
    words, kept = strings.content_words(F.col("text"), []), strings.content_words(F.col("text"), ["with", "that"])
    return table(spark, folder, "documents").select("doc_id", F.size(words).cast("long").alias("words"), (F.size(words) - F.size(kept)).cast("long").alias("stops"))


@query("passages")
def document_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Located passages of every document, with headings."""
    return passages.passages(table(spark, folder, "documents"), key="doc_id", text="text")


@query("passage_summary")
def passage_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Passages counted straight into sums: the passages themselves are never stored."""
    rows = passages.passages(table(spark, folder, "documents"), key="doc_id", text="text")
    first = F.min_by("heading", F.when(F.col("heading").isNotNull(), F.col("start")))
    return rows.groupBy(F.col("key").alias("doc_id")).agg(F.count("*").alias("passages"), F.sum("words").alias("words"), F.sum("chars").alias("chars"), first.alias("first_heading"))


@query("offsets", """
SELECT doc_id, sha256(coalesce(text, '')) AS sha256, length(coalesce(text, '')) AS chars, strlen(coalesce(text, '')) AS bytes, n_chars IS NOT DISTINCT FROM length(text) AS counted FROM documents""")
def offsets(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return table(spark, folder, "documents").select(
        "doc_id", F.sha2(text, 256).alias("sha256"), F.char_length(text).cast("long").alias("chars"), F.octet_length(text).cast("long").alias("bytes"), F.char_length("text").cast("long").eqNullSafe(F.col("n_chars")).alias("counted")
    )


# --- read side ----------------------------------------------------------------------------------------------------


def _graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    people = table(spark, folder, "person").select("person_id", "name", "birth_year", "death_year", "kind", "origin", "topics_json").distinct()
    edges = table(spark, folder, "identity_claim").filter("person_a is not null and person_b is not null")
    edges = edges.select(F.col("person_a").alias("person_id"), F.substring_index("person_b", ":", 1).alias("domain"), F.col("person_b").alias("content_ref")).distinct()
    topics = people.select("person_id", F.explode(strings.string_list(F.col("topics_json"))).alias("topic")).withColumn("weight", F.lit(1.0))
    return people.drop("topics_json"), edges, topics


@query("who", """
WITH p AS (SELECT DISTINCT person_id, name, kind FROM person WHERE name ILIKE '%soren%'), e AS (SELECT DISTINCT person_a, person_b FROM identity_claim WHERE person_a IS NOT NULL AND person_b IS NOT NULL)
SELECT person_id, name, kind, count(person_b) AS evidence FROM p LEFT JOIN e ON person_a = person_id GROUP BY 1, 2, 3 ORDER BY evidence DESC, name, person_id LIMIT 8""")
def who(spark: SparkSession, folder: str) -> DataFrame:
    """A top-8 report: people of a name, best attested first."""
    return ask.who(*_graph(spark, folder), "soren").select("person_id", "name", "kind", "evidence")


@query("works", """
WITH p AS (SELECT DISTINCT person_id FROM person WHERE name ILIKE '%soren%'), e AS (SELECT DISTINCT person_a AS person_id, split_part(person_b, ':', 1) AS domain, person_b AS content_ref FROM identity_claim WHERE person_a IS NOT NULL AND person_b IS NOT NULL),
b AS (SELECT person_id FROM e JOIN p USING (person_id) GROUP BY 1 ORDER BY count(*) DESC, person_id LIMIT 1)
SELECT person_id, domain, content_ref FROM e JOIN b USING (person_id) ORDER BY domain, content_ref LIMIT 200""")
def works(spark: SparkSession, folder: str) -> DataFrame:
    people, edges, _ = _graph(spark, folder)
    return ask.works(people, edges, "soren")


@query("about", """
WITH t AS (SELECT DISTINCT person_id, unnest(CAST(CASE WHEN json_valid(topics_json) THEN topics_json ELSE '[]' END AS VARCHAR[])) AS topic FROM person), c AS (SELECT person_id, count(*) AS n FROM (SELECT DISTINCT person_a AS person_id, person_b FROM identity_claim WHERE person_a IS NOT NULL AND person_b IS NOT NULL) GROUP BY 1)
SELECT DISTINCT person_id, (1 + coalesce(n, 0))::DOUBLE AS weight FROM t LEFT JOIN c USING (person_id) WHERE lower(topic) = 'map tiling' ORDER BY weight DESC, person_id LIMIT 20""")
def about(spark: SparkSession, folder: str) -> DataFrame:
    """People of a topic, weighted by what is linked to them."""
    people, edges, topics = _graph(spark, folder)
    counts = edges.groupBy("person_id").agg(F.count("*").alias("n"))
    weighted = topics.drop("weight").join(counts, "person_id", "left").withColumn("weight", (1 + F.coalesce("n", F.lit(0))).cast("double"))
    return ask.about(people.dropDuplicates(["person_id"]), weighted, "Map Tiling").select("person_id", "weight")


@query("contemporaries", """
WITH d AS (SELECT DISTINCT person_id, name, birth_year AS b, coalesce(death_year, birth_year + 80) AS e FROM person WHERE birth_year IS NOT NULL),
o AS (SELECT * FROM d WHERE name ILIKE '%soren%' ORDER BY length(name), person_id LIMIT 1)
SELECT d.person_id, (least(d.e, o.e) - greatest(d.b, o.b))::INTEGER AS years FROM d, o WHERE d.b < o.e AND o.b < d.e AND d.person_id <> o.person_id ORDER BY years DESC, d.person_id LIMIT 20""")
def contemporaries(spark: SparkSession, folder: str) -> DataFrame:
    return ask.contemporaries(_graph(spark, folder)[0], "soren").select("person_id", "years")


@query("inventory", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in TABLES))
def inventory(spark: SparkSession, folder: str) -> DataFrame:
    return ask.inventory({n: table(spark, folder, n) for n in TABLES})


_ENTRIES_SQL = "e AS (SELECT DISTINCT list_repo AS list, section, target_repo AS target FROM entry WHERE list_repo IS NOT NULL AND trim(target_repo) <> '')"


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entry").filter("list_repo is not null and trim(target_repo) <> ''")
    return rows.select(F.col("list_repo").alias("list"), "section", F.col("target_repo").alias("target")).distinct()


@query("list_top", f"WITH {_ENTRIES_SQL} SELECT target, count(DISTINCT list) AS lists, count(DISTINCT section) AS sections FROM e GROUP BY 1 ORDER BY lists DESC, target LIMIT 20")
def list_top(spark: SparkSession, folder: str) -> DataFrame:
    return ask.list_top(_entries(spark, folder))


@query("list_owners", f"""
WITH {_ENTRIES_SQL} SELECT split_part(target, '/', 1) AS owner, count(DISTINCT target) AS targets, count(DISTINCT list) AS lists FROM e WHERE contains(target, '/') GROUP BY 1 HAVING count(DISTINCT target) >= 2 ORDER BY targets DESC, lists DESC, owner LIMIT 20""")
def list_owners(spark: SparkSession, folder: str) -> DataFrame:
    return ask.list_owners(_entries(spark, folder).filter("instr(target, '/') > 0"))




@query("alternatives", f"""
WITH {_ENTRIES_SQL}, t AS (SELECT target FROM e GROUP BY 1 ORDER BY count(DISTINCT list) DESC, target LIMIT 1), m AS (SELECT DISTINCT list, section FROM e JOIN t USING (target))
SELECT e.target, count(DISTINCT e.list) AS lists FROM e JOIN m ON m.list = e.list AND m.section = e.section WHERE e.target NOT IN (SELECT target FROM t) AND e.target NOT IN (SELECT list FROM e)
GROUP BY 1 HAVING count(DISTINCT e.list) >= 2 ORDER BY lists DESC, e.target LIMIT 10""")
def alternatives(spark: SparkSession, folder: str) -> DataFrame:
    """What stands beside the most cited repository."""
    entries = _entries(spark, folder)
    most = ask.list_top(entries, limit=1).first()
    return ask.alternatives(entries, most["target"] if most else "")


@query("stale_lists", f"SELECT list_repo FROM curated_list WHERE fetched_at::TIMESTAMPTZ::DATE < DATE '{AS_OF}' - INTERVAL 1 YEAR")
def stale_lists(spark: SparkSession, folder: str) -> DataFrame:
    day = F.to_date(F.timestamp_micros(moment(F.col("fetched_at"))))
    return ask.stale(table(spark, folder, "curated_list"), day=day, as_of=F.lit(AS_OF).cast("date"), years=1).select("list_repo")


@query("need", """
WITH r AS (SELECT full_name, max(liftability) AS liftability, max(stars) AS stars FROM bank_capability_pick WHERE full_name LIKE '%index%' GROUP BY 1)
SELECT full_name, (coalesce(liftability, 0) + 22.5 - CASE WHEN coalesce(stars, 0) > 5000 THEN 12.0 ELSE 0 END)::DOUBLE AS score FROM r ORDER BY score DESC, full_name LIMIT 10""")
def need(spark: SparkSession, folder: str) -> DataFrame:
    repositories = table(spark, folder, "bank_capability_pick").groupBy("full_name").agg(F.max("liftability").alias("liftability"), F.max("stars").alias("stars")).withColumn("adoption", F.lit(None).cast("double"))
    return ask.need(repositories, None, "indexing", keyword=F.col("full_name").contains("index")).select("full_name", "score")


@query("topic_suggestions")
def topic_suggestions(spark: SparkSession, folder: str) -> DataFrame:
    """Registered topics that fit a text (ratio of matching blocks, in Python over Arrow batches)."""
    topics = table(spark, folder, "category").select("slug", F.col("name").alias("title"), F.col("definition").alias("description"), F.lit(None).cast("string").alias("keywords"))
    return ask.suggest(topics, "searching of vectors")


# --- quality ------------------------------------------------------------------------------------------------------


@query("violations", """
SELECT * FROM (SELECT 'has_name' AS rule, count(*) FILTER (WHERE trim(coalesce(name, '')) = '') AS rows FROM category UNION ALL SELECT 'known_status', count(*) FILTER (WHERE coalesce(status, '') NOT IN ('active', 'retired')) FROM category
    UNION ALL SELECT 'level_in_range', count(*) FILTER (WHERE NOT coalesce(level BETWEEN 1 AND 3, false)) FROM category) WHERE rows > 0""")
def violations(spark: SparkSession, folder: str) -> DataFrame:
    rules = {"has_name": F.trim("name") != "", "known_status": F.col("status").isin("active", "retired"), "level_in_range": F.col("level").between(1, 3)}
    return quality.violations(table(spark, folder, "category"), rules)


@query("repeated_rows", "SELECT person_id, count(*) AS n FROM person GROUP BY 1 HAVING count(*) > 1")
def repeated_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.repeated_keys(table(spark, folder, "person"), ["person_id"])


@query("orphan_categories", "SELECT id, parent_id FROM category WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT id FROM category)")
def orphan_categories(spark: SparkSession, folder: str) -> DataFrame:
    tree = table(spark, folder, "category").select("id", "parent_id")
    return quality.orphans(tree, tree, "parent_id", "id").select("id", "parent_id")


@query("stated_counts", """
SELECT c.list_repo, coalesce(n, 0) AS parts, coalesce(n_entries, 0) AS stated FROM curated_list c LEFT JOIN (SELECT list_repo, count(*) AS n FROM entry GROUP BY 1) e ON e.list_repo = c.list_repo WHERE coalesce(n, 0) <> coalesce(n_entries, 0)""")
def stated_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lists whose stated number of entries isn't the counted one."""
    parts = table(spark, folder, "entry").select("list_repo", F.lit(1).cast("long").alias("one"))
    wrong = quality.totals_agree(parts, "one", table(spark, folder, "curated_list").select("list_repo", "n_entries"), "n_entries", ["list_repo"])
    return wrong.select("list_repo", F.coalesce("parts", F.lit(0)).alias("parts"), F.coalesce("n_entries", F.lit(0)).alias("stated"))
