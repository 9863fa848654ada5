"""Queries of cards, answers, manifests, lists and texts, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import jsonx, strings
from quillmesh.operators import cards, joins, lists, manifests, passages, policies, quality
from quillmesh.plans.registry import query
from quillmesh.tables import table

_RAW = """
o AS (SELECT DISTINCT obs_id, canonical_id, observed_owner_name AS full_name, observed_url AS url, stars, description, raw_round, observed_at FROM repo_observation WHERE canonical_id IS NOT NULL),
c AS (SELECT *, CASE WHEN obs_id % 5 = 0 THEN 'Python' ELSE '' END AS language, CASE WHEN obs_id % 4 = 0 THEN obs_id % 100 END AS forks, CASE WHEN obs_id % 6 = 0 THEN observed_at END AS pushed_at, CASE WHEN obs_id % 9 = 0 THEN observed_at END AS created_at,
    CASE WHEN obs_id % 7 = 0 THEN 'MIT' WHEN obs_id % 7 = 1 THEN 'NOASSERTION' END AS license, CASE WHEN obs_id % 8 = 0 THEN '["a"]' WHEN obs_id % 8 = 1 THEN '[]' END AS topics, CASE WHEN obs_id % 10 = 0 THEN 'main' END AS default_branch,
    CASE WHEN obs_id % 3 = 0 THEN false END AS archived, CASE WHEN obs_id % 3 = 0 THEN true END AS fork, CASE WHEN obs_id % 3 = 0 THEN false END AS mirror FROM o),
l AS (SELECT *, CASE WHEN archived IS NOT NULL AND coalesce(created_at, '') <> '' THEN 'rich_created' WHEN archived IS NOT NULL OR license IS NOT NULL OR topics = '["a"]' OR default_branch IS NOT NULL THEN 'rich'
    WHEN language <> '' OR forks IS NOT NULL OR coalesce(pushed_at, '') <> '' THEN 'basic' ELSE 'seed' END AS schema_level FROM c),
f AS (SELECT *, ((coalesce(full_name, '') <> '')::INT + (coalesce(url, '') <> '')::INT + (stars IS NOT NULL)::INT + (language <> '')::INT + (forks IS NOT NULL)::INT + (coalesce(pushed_at, '') <> '')::INT + (coalesce(created_at, '') <> '')::INT
    + (coalesce(description, '') NOT IN ('', 'NOASSERTION'))::INT + (license = 'MIT' AND license IS NOT NULL)::INT + (topics = '["a"]' AND topics IS NOT NULL)::INT + (default_branch IS NOT NULL)::INT + 3 * (archived IS NOT NULL)::INT
    + CASE schema_level WHEN 'rich_created' THEN 4 WHEN 'rich' THEN 2 ELSE 0 END)::INTEGER AS field_score FROM l)
"""


def _raw_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Sightings with the further fields of a card, which their numbers decide."""
    i = F.col("obs_id")
    rows = table(spark, folder, "repo_observation").filter("canonical_id is not null")
    rows = rows.select("obs_id", "canonical_id", F.col("observed_owner_name").alias("full_name"), F.col("observed_url").alias("url"), "stars", "description", "raw_round", "observed_at").distinct()
    flag = F.when(i % 3 == 0, F.lit(False))
    return rows.select(
        "*", F.when(i % 5 == 0, "Python").otherwise("").alias("language"), F.when(i % 4 == 0, i % 100).alias("forks"), F.when(i % 6 == 0, F.col("observed_at")).alias("pushed_at"), F.when(i % 9 == 0, F.col("observed_at")).alias("created_at"),
        F.when(i % 7 == 0, "MIT").when(i % 7 == 1, "NOASSERTION").alias("license"), F.when(i % 8 == 0, '["a"]').when(i % 8 == 1, "[]").alias("topics"), F.when(i % 10 == 0, "main").alias("default_branch"),
        flag.alias("archived"), F.when(i % 3 == 0, F.lit(True)).alias("fork"), flag.alias("mirror"),
    )


@query("chosen_cards", f"""
WITH {_RAW}, r AS (SELECT *, row_number() OVER (PARTITION BY canonical_id ORDER BY CASE schema_level WHEN 'rich_created' THEN 3 WHEN 'rich' THEN 2 WHEN 'basic' THEN 1 ELSE 0 END DESC, field_score DESC, coalesce(observed_at, '') DESC,
    coalesce(TRY_CAST(regexp_extract(raw_round, '[^-]*$') AS INTEGER), -1) DESC, obs_id DESC) AS p FROM f) SELECT canonical_id, obs_id, schema_level, field_score FROM r WHERE p = 1""")
def chosen_cards(spark: SparkSession, folder: str) -> DataFrame:
    """The richest card of every repository by all fourteen fields and its level."""
    best = cards.chosen_cards(_raw_cards(spark, folder), "canonical_id", imported_at="observed_at", raw_round="raw_round", ordinal="obs_id")
    return best.select("canonical_id", "obs_id", "schema_level", F.col("field_score").cast("int").alias("field_score"))


@query("schema_levels", f"WITH {_RAW} SELECT schema_level, count(*) AS n, CASE schema_level WHEN 'rich_created' THEN 3 WHEN 'rich' THEN 2 WHEN 'basic' THEN 1 ELSE 0 END AS level_rank FROM f GROUP BY 1")
def schema_levels(spark: SparkSession, folder: str) -> DataFrame:
    rows = _raw_cards(spark, folder).withColumn("schema_level", cards.schema_level())
    return rows.groupBy("schema_level").agg(F.count("*").alias("n")).withColumn("level_rank", cards.level_rank(F.col("schema_level")))


@query("search_candidates", """
SELECT DISTINCT CASE WHEN source_record_id <> '' THEN source_record_id ELSE lower(coalesce(observed_owner_name, '')) END AS candidate_key, observed_url AS url, CASE WHEN description <> '' THEN description ELSE '' END AS description,
    split_part(coalesce(observed_owner_name, ''), '/', 1) AS owner_login, 'a|z' AS topics, CASE WHEN obs_id % 2 = 0 THEN 'MIT' ELSE 'NOASSERTION' END AS spdx, coalesce(stars, 0) AS stars, sha256('stars:>10') AS query_hash, 'x|y' AS tags FROM repo_observation""")
def search_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Items of a search answer as candidates."""
    rows = table(spark, folder, "repo_observation")
    none = F.lit(None).cast("string")
    owner = F.struct(F.substring_index(F.coalesce("observed_owner_name", F.lit("")), "/", 1).alias("login"))
    items = rows.select(
        F.col("source_record_id").alias("node_id"), F.col("observed_owner_name").alias("full_name"), F.col("observed_url").alias("html_url"), "description", owner.alias("owner"), none.alias("default_branch"), none.alias("language"),
        F.array(F.lit("z"), F.lit("a")).alias("topics"), F.when(F.col("obs_id") % 2 == 0, F.struct(F.lit("MIT").alias("spdx_id"))).alias("license"), F.col("stars").alias("stargazers_count"), F.lit(None).cast("boolean").alias("archived"),
    )
    found = cards.candidates(items, query="stars:>10", key="k", tags=["y", "x", "y"], observed_at=F.lit("2026-01-01"))
    return found.select("candidate_key", "url", "description", "owner_login", F.array_join("topics", "|").alias("topics"), F.col("declared_license_spdx").alias("spdx"), "stars", "query_hash", F.array_join("capability_tags", "|").alias("tags")).distinct()


@query("flattened_answers", """
SELECT DISTINCT obs_id, observed_owner_name AS full_name, CASE WHEN obs_id % 3 = 0 THEN stars END AS stars, CASE WHEN obs_id % 3 = 0 THEN 'Go' ELSE 'C' END AS language, CASE WHEN obs_id % 3 = 0 THEN 'Apache-2.0' ELSE '' END AS spdx_id,
    CASE WHEN obs_id % 3 = 0 THEN 'trunk' ELSE 'main' END AS default_branch, CASE WHEN obs_id % 3 = 0 THEN 'one|two' ELSE '' END AS topics FROM repo_observation""")
def flattened_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Nested answers made flat; broken ones leave what the item knows."""
    nodes = F.array(*[F.struct(F.struct(F.lit(t).alias("name")).alias("topic")) for t in ("one", "", "two")])
    answer = F.to_json(F.struct(F.col("observed_owner_name").alias("nameWithOwner"), F.col("stars").alias("stargazerCount"), F.struct(F.lit("Apache-2.0").alias("spdxId")).alias("licenseInfo"), F.struct(F.lit("Go").alias("name")).alias("primaryLanguage"),
                                F.struct(F.lit("trunk").alias("name")).alias("defaultBranchRef"), F.struct(nodes.alias("nodes")).alias("repositoryTopics")))
    items = table(spark, folder, "repo_observation").select("obs_id", "observed_owner_name", "stars").distinct()
    items = items.select(F.col("obs_id").alias("canonical_id"), F.col("observed_owner_name").alias("full_name"), F.lit("u").alias("url"), F.lit("C").alias("language"), F.when(F.col("obs_id") % 3 == 0, answer).when(F.col("obs_id") % 3 == 1, "{broken").alias("answer"))
    out = cards.flattened(items, "answer")
    return out.select(F.col("canonical_id").alias("obs_id"), "full_name", "stars", "language", "spdx_id", "default_branch", F.array_join("topics", "|").alias("topics"))


@query("manifest_hints", """
WITH l AS (SELECT id, CASE id % 4 WHEN 0 THEN 'Python' WHEN 1 THEN 'TypeScript' WHEN 2 THEN 'Go' ELSE 'Zig' END AS language, slug FROM category)
SELECT id, CASE id % 4 WHEN 0 THEN 'pyproject.toml,setup.cfg,requirements.txt,setup.py,package.json' WHEN 1 THEN 'package.json,pnpm-workspace.yaml,yarn.lock' WHEN 2 THEN 'go.mod,package.json' ELSE 'package.json' END AS paths,
    CASE WHEN id % 5 = 0 THEN '' ELSE array_to_string(list_sort(list_distinct(['left', slug, 'zod'])), ',') END AS hints FROM l""")
def manifest_hints(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("id")
    language = F.when(i % 4 == 0, "Python").when(i % 4 == 1, "TypeScript").when(i % 4 == 2, "Go").otherwise("Zig")
    package = F.concat(F.lit('{"dependencies": {"zod": "1", "left": "2"}, "devDependencies": {"'), F.col("slug"), F.lit('": "3", "zod": "4"}}'))
    return table(spark, folder, "category").select("id", F.array_join(cards.manifest_paths(language), ",").alias("paths"), F.array_join(cards.dependency_hints(F.when(i % 5 == 0, "{no json").otherwise(package)), ",").alias("hints"))


_MANIFESTS = """
SELECT id, slug, name, CASE id % 6 WHEN 0 THEN 'package.json' WHEN 1 THEN 'pyproject.toml' WHEN 2 THEN 'setup.py' WHEN 3 THEN 'go.mod' WHEN 4 THEN 'Cargo.toml' ELSE 'setup.cfg' END AS path FROM category
"""


@query("parsed_manifests", f"""
WITH m AS ({_MANIFESTS}) SELECT id, CASE id % 6 WHEN 0 THEN 'npm' WHEN 3 THEN 'go' WHEN 4 THEN 'rust' ELSE 'python' END AS kind, slug AS pkg_name, CASE WHEN id % 6 = 3 THEN 'github.com/x/y' ELSE 'left,right' END AS runtime,
    CASE id % 6 WHEN 0 THEN 'npm install ' WHEN 3 THEN 'go get ' WHEN 4 THEN 'cargo add ' ELSE 'pip install ' END || slug AS install, CASE WHEN id % 6 IN (0, 1, 2, 5) THEN 'run' ELSE '' END AS bin FROM m""")
def parsed_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Manifests of six kinds, read into one shape."""
    s, i = F.col("slug"), F.col("id")
    texts = [
        ("package.json", F.concat(F.lit('{"name": "'), s, F.lit('", "dependencies": {"left": "1", "right": "2"}, "bin": {"run": "x.js"}}'))),
        ("pyproject.toml", F.concat(F.lit('[project]\nname = "'), s, F.lit('"\ndependencies = ["left>=1", "right[x]; python_version>\'3\'"]\n[project.scripts]\nrun = "a:b"\n'))),
        ("setup.py", F.concat(F.lit("setup(name='"), s, F.lit("', install_requires=['left>=1', 'right'], entry_points={'console_scripts': ['run=a:b']})"))),
        ("go.mod", F.concat(F.lit("module "), s, F.lit("\ngo 1.22\nrequire (\n\tgithub.com/x/y v1.0.0\n)\n"))),
        ("Cargo.toml", F.concat(F.lit('[package]\nname = "'), s, F.lit('"\nedition = "2021"\n[dependencies]\nleft = "1"\nright = "2"\n'))),
        ("setup.cfg", F.concat(F.lit("[metadata]\nname = "), s, F.lit("\n[options]\ninstall_requires =\n    left>=1\n    right\n[options.entry_points]\nconsole_scripts =\n    run = a:b\n"))),
    ]
    path = F.element_at(F.array(*[F.lit(p) for p, _ in texts]), (i % 6 + 1).cast("int"))
    text = F.element_at(F.array(*[t for _, t in texts]), (i % 6 + 1).cast("int"))
    rows = table(spark, folder, "category").select("id", manifests.parsed_manifest(path, F.lit(None).cast("string"), text).alias("m"))
    return rows.select("id", F.col("m.surface_kind").alias("kind"), "m.pkg_name", F.array_join("m.runtime", ",").alias("runtime"), "m.install", F.array_join("m.bin", ",").alias("bin"))


@query("fetch_states", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, title, doc_id % 10 <> 0 AS resolved, CASE WHEN text IS NULL THEN 404 ELSE 200 END AS http FROM documents),
s AS (SELECT *, CASE WHEN NOT resolved THEN 'no_commit' WHEN http <> 200 AND t = '' THEN 'no_readme' WHEN strlen(t) > 1536 THEN 'digest_too_big' ELSE 'ok' END AS status FROM d)
SELECT doc_id, status, CASE WHEN status IN ('ok', 'digest_too_big') THEN sha256(encode(t) || '\\x00'::BLOB || encode(coalesce(title, ''))) END AS content_sha FROM s""")
def fetch_states(spark: SparkSession, folder: str) -> DataFrame:
    """What became of a fetch, and the fingerprint of what came."""
    http = F.when(F.col("text").isNull(), 404).otherwise(200)
    state = cards.fetch_state(resolved=F.col("doc_id") % 10 != 0, http_status=http, readme=F.col("text"), manifest=F.col("title"), digest_bytes=F.octet_length(F.coalesce("text", F.lit(""))))
    return table(spark, folder, "documents").select("doc_id", state.alias("s")).select("doc_id", "s.*")


_ATTEMPTS = "a AS (SELECT user_id, event_type AS status, event_id % 5 AS attempt_count FROM events)"


@query("attempt_numbers", f"WITH {_ATTEMPTS}, c AS (SELECT c_custkey AS user_id FROM customer) SELECT user_id, (coalesce((SELECT max(attempt_count) FROM a WHERE a.user_id = c.user_id), 0) + 1)::BIGINT AS attempt_count FROM c")
def attempt_numbers(spark: SparkSession, folder: str) -> DataFrame:
    attempts = table(spark, folder, "events").select("user_id", (F.col("event_id") % 5).alias("attempt_count"))
    return cards.next_attempts(table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id")), attempts, "user_id").select("user_id", "attempt_count")


@query("still_to_do", f"WITH {_ATTEMPTS} SELECT c_custkey AS user_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = c_custkey AND (status IN ('purchase') OR (status = 'error' AND attempt_count >= 3)))")
def still_to_do(spark: SparkSession, folder: str) -> DataFrame:
    attempts = table(spark, folder, "events").select("user_id", F.col("event_type").alias("status"), (F.col("event_id") % 5).alias("attempt_count"))
    return joins.still_to_do(table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id")), attempts, "user_id", final=["purchase"], retry="error", most_attempts=3)


@query("aligned_answers", """
WITH i AS (SELECT id, id // 20 AS batch, slug FROM category), s AS (SELECT slug, batch, max(id) FILTER (WHERE id % 5 <> 0) AS answered FROM i GROUP BY 1, 2)
SELECT i.id, i.batch, CASE WHEN i.batch % 4 <> 3 THEN answered END AS value, CASE WHEN i.batch % 4 = 3 OR (SELECT count(*) FROM i x WHERE x.batch = i.batch AND x.id % 5 <> 0) = 0 THEN 'unparsed' WHEN answered IS NULL THEN 'missing' END AS error FROM i JOIN s ON s.slug = i.slug AND s.batch = i.batch""")
def aligned_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Objects of a batch's answer brought back to the rows that were asked about."""
    inputs = table(spark, folder, "category").select("id", F.floor(F.col("id") / 20).alias("batch"), F.col("slug").alias("full_name"))
    objects = F.to_json(F.collect_list(F.struct("full_name", F.col("id").alias("value"))))
    text = F.when(F.col("batch") % 4 == 3, "I can't do that.").otherwise(F.concat(F.lit("Sure, here: "), F.col("j"), F.lit("\nDone.")))
    answers = inputs.filter("id % 5 <> 0").orderBy("id").groupBy("batch").agg(objects.alias("j")).select("batch", text.alias("text"))
    out = cards.aligned(inputs, answers, batch="batch", name="full_name", text="text")
    values = out.select("batch", "full_name", "error", F.get_json_object("object", "$.value").cast("bigint").alias("value")).distinct()
    return inputs.join(values, ["batch", "full_name"]).select("id", "batch", "value", "error")


@query("grounded_claims", """
WITH o AS (SELECT DISTINCT obs_id, coalesce(description, '') AS d FROM repo_observation), t AS (SELECT *, list_filter(regexp_extract_all(lower(d), '[a-z0-9_]{4,}'), lambda x: x NOT IN ('with', 'that')) AS known FROM o),
c AS (SELECT *, list_filter(['fast ' || trim(d), 'zzzz qqqq', 'FAST ' || upper(trim(d)), 'With That'], lambda x: len(list_intersect(list_filter(regexp_extract_all(lower(x), '[a-z0-9_]{4,}'), lambda y: y NOT IN ('with', 'that')), known)) > 0) AS held FROM t)
SELECT obs_id, len(list_distinct(list_transform(held, lambda x: lower(x)))) AS grounded, CASE WHEN len(held) > 0 THEN 'ok' ELSE 'ungrounded' END AS status, CASE WHEN len(held) > 0 THEN 1 ELSE 0 END AS wants, CASE WHEN len(held) > 0 THEN 'It stores things.' ELSE '' END AS line FROM c""")
def grounded_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claims kept only where they share a word with the text that they are about."""
    d = F.trim(F.coalesce("description", F.lit("")))
    claims = F.array(F.concat(F.lit("fast "), d), F.lit("zzzz qqqq"), F.concat(F.lit("FAST "), F.upper(d)), F.lit("With That"))
    rows = table(spark, folder, "repo_observation").select("obs_id", F.coalesce("description", F.lit("")).alias("digest")).distinct().withColumnRenamed("digest", "description")
    rows = rows.select("obs_id", F.col("description").alias("digest"), claims.alias("provides"), F.array(F.lit("disk"), F.lit(" ")).alias("requires"), F.lit('"It stores things"').alias("one_liner"))
    out = cards.grounded(rows, digest="digest", provides="provides", requires="requires", one_liner="one_liner", stop=["with", "that"])
    return out.select("obs_id", F.size("grounded").cast("long").alias("grounded"), "status", F.size("wants").alias("wants"), "line")


@query("install_lines", """
SELECT id, CASE id % 5 WHEN 0 THEN 'npm install ' || slug WHEN 1 THEN 'pip install pkg' WHEN 2 THEN 'cargo add ' || slug WHEN 3 THEN 'go get ' || slug ELSE '# clone https://github.com/own/' || slug END AS line, CASE WHEN length(coalesce(definition, '')) = 0 THEN ''
    ELSE (CASE WHEN right(t, 1) = '.' THEN t WHEN length(t) >= 39 THEN substr(t, 1, 38) || '.' ELSE t || '.' END) END AS sentence
FROM (SELECT *, CASE WHEN length(trim(coalesce(definition, ''))) > 40 THEN rtrim(substr(trim(definition), 1, 39)) ELSE trim(coalesce(definition, '')) END AS t FROM category)""")
def install_lines(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("id")
    digest = F.when(i % 5 == 0, "a Node library").when(i % 5 == 1, "Python; pkg_name: pkg").when(i % 5 == 2, "written in Rust").when(i % 5 == 3, "see go.mod").otherwise("a book")
    return table(spark, folder, "category").select("id", cards.install_line(digest, F.concat(F.lit("own/"), F.col("slug"))).alias("line"), cards.short_sentence(F.col("definition"), 40).alias("sentence"))


@query("resolved_slugs", """
WITH k AS (SELECT id, lower(slug) AS s, regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS n FROM category WHERE slug <> ''),
r AS (SELECT id, CASE id % 4 WHEN 0 THEN upper(slug) WHEN 1 THEN regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]+', '-', 'g') WHEN 2 THEN 'standalone-' || slug ELSE substr(slug, 3) END AS wanted FROM category), w AS (SELECT DISTINCT lower(trim(wanted)) AS w FROM r WHERE trim(wanted) <> ''),
e AS (SELECT w, min(id) AS id FROM w JOIN k ON s = w GROUP BY 1), m AS (SELECT w, min(id) AS id FROM w JOIN k ON n = w GROUP BY 1), f AS (SELECT w, min(id) AS id FROM w JOIN k ON contains(w, s) OR ends_with(s, w) GROUP BY 1 HAVING count(DISTINCT s) = 1)
SELECT r.id, coalesce(e.id, m.id, f.id) AS category_id FROM r LEFT JOIN e ON e.w = lower(trim(wanted)) LEFT JOIN m ON m.w = lower(trim(wanted)) LEFT JOIN f ON f.w = lower(trim(wanted)) AND NOT EXISTS (SELECT 1 FROM e WHERE e.w = f.w) AND NOT EXISTS (SELECT 1 FROM m WHERE m.w = f.w)""")
def resolved_slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs as a model writes them: exact, of a name, or part of one another."""
    registry = table(spark, folder, "category").select("id", "slug", "name")
    i = F.col("id")
    wanted = F.when(i % 4 == 0, F.upper("slug")).when(i % 4 == 1, F.regexp_replace(F.lower(F.coalesce("name", F.lit(""))), "[^a-z0-9]+", "-")).when(i % 4 == 2, F.concat(F.lit("standalone-"), F.col("slug"))).otherwise(F.substring("slug", 3, 1000))
    return cards.resolved_slugs(registry.select("id", wanted.alias("wanted")), "wanted", registry).select("id", "category_id")


@query("top_remarks", """
WITH c AS (SELECT DISTINCT claim_id, person_a, method, confidence FROM identity_claim WHERE person_a IS NOT NULL), r AS (SELECT person_a, claim_id, CASE method WHEN 'manual' THEN 'silent-noop' WHEN 'name_plus_years' THEN 'type-surprise' ELSE 'other' END AS kind, CASE WHEN confidence >= 0.9 THEN 'high' ELSE 'low' END AS sure FROM c),
o AS (SELECT *, row_number() OVER (PARTITION BY person_a ORDER BY kind = 'other', CASE WHEN kind <> 'other' THEN (sure <> 'high')::INT ELSE 0 END, claim_id) AS p, bool_or(kind <> 'other') OVER (PARTITION BY person_a) AS any_danger FROM r)
SELECT person_a, string_agg(claim_id::VARCHAR, ',' ORDER BY p) AS picked FROM o WHERE p <= 3 AND (kind <> 'other' OR NOT any_danger) GROUP BY 1""")
def top_remarks(spark: SparkSession, folder: str) -> DataFrame:
    """The most dangerous remarks, sure ones first; any where none is dangerous."""
    kind = F.when(F.col("method") == "manual", "silent-noop").when(F.col("method") == "name_plus_years", "type-surprise").otherwise("other")
    item = F.struct("claim_id", kind.alias("kind"), F.when(F.col("confidence") >= 0.9, "high").otherwise("low").alias("confidence"))
    claims = table(spark, folder, "identity_claim").filter("person_a is not null").select("claim_id", "person_a", "method", "confidence").distinct()
    per = claims.groupBy("person_a").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return per.select("person_a", F.array_join(F.transform(cards.remarks(F.col("items")), lambda x: x["claim_id"].cast("string")), ",").alias("picked"))


@query("category_examples", """
WITH p AS (SELECT category_id, full_name, max(stars) AS stars FROM bank_capability_pick WHERE category_id IS NOT NULL AND is_winner = 1 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY stars DESC NULLS LAST, full_name) AS p FROM p)
SELECT category_id, string_agg(full_name, ', ' ORDER BY p) AS examples FROM r WHERE p <= 3 GROUP BY 1""")
def category_examples(spark: SparkSession, folder: str) -> DataFrame:
    placed = table(spark, folder, "bank_capability_pick").filter("category_id is not null and is_winner = 1").groupBy("category_id", "full_name").agg(F.max("stars").alias("stars"))
    return cards.examples(placed, group="category_id", item="full_name", score="stars").select("category_id", F.array_join("examples", ", ").alias("examples"))


@query("text_blocks", "SELECT id // 20 AS batch, string_agg('--- ' || slug || ' ---' || chr(10) || coalesce(definition, ''), chr(10) ORDER BY id) AS text FROM category GROUP BY 1")
def text_blocks(spark: SparkSession, folder: str) -> DataFrame:
    block = F.concat(F.lit("--- "), F.col("slug"), F.lit(" ---\n"), F.coalesce("definition", F.lit("")))
    return cards.blocks_of_text(table(spark, folder, "category").withColumn("batch", F.floor(F.col("id") / 20)), "batch", "id", block)


@query("lane_and_band_counts", """
WITH p AS (SELECT legal_lane AS lane, CASE WHEN stars IS NULL THEN 'unknown' WHEN stars < 100 THEN 'low' ELSE 'high' END AS band FROM bank_capability_pick) SELECT 'lane' AS what, lane AS value, count(*) AS n FROM p GROUP BY 2 UNION ALL SELECT 'band', band, count(*) FROM p GROUP BY 2""")
def lane_and_band_counts(spark: SparkSession, folder: str) -> DataFrame:
    band = F.when(F.col("stars").isNull(), "unknown").when(F.col("stars") < 100, "low").otherwise("high")
    rows = table(spark, folder, "bank_capability_pick").select(F.explode(F.array(F.struct(F.lit("lane").alias("what"), F.col("legal_lane").alias("value")), F.struct(F.lit("band").alias("what"), band.alias("value")))).alias("x"))
    return rows.groupBy("x.what", "x.value").agg(F.count("*").alias("n"))


@query("filter_lists", "SELECT 'lane' AS what, array_to_string(list_sort(array_agg(DISTINCT legal_lane)), '|') AS choices FROM bank_capability_pick UNION ALL SELECT 'class', array_to_string(list_sort(array_agg(DISTINCT unit_class)), '|') FROM bank_capability_pick")
def filter_lists(spark: SparkSession, folder: str) -> DataFrame:
    """What a reader can choose from."""
    rows = table(spark, folder, "bank_capability_pick").agg(F.array_sort(F.collect_set("legal_lane")).alias("lane"), F.array_sort(F.collect_set("unit_class")).alias("class"))
    return rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.array_join(c, "|").alias("choices")) for c in ("lane", "class")])).alias("x")).select("x.*")


@query("stars_in_order", "SELECT id, stars FROM (SELECT DISTINCT id, stars FROM bank_capability_pick) WHERE stars IS NOT NULL ORDER BY stars DESC, id")
def stars_in_order(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "bank_capability_pick").select("id", "stars").distinct().filter("stars is not null").orderBy(F.desc("stars"), "id")


@query("stamped_owners", """
WITH p AS (SELECT DISTINCT person_id, primary_tier, rank_score, topics_json FROM person), s AS (SELECT person_id, 'mid' AS tier, round(rank_score, 2) AS score FROM p WHERE rank_score > 10)
SELECT p.person_id, coalesce(p.primary_tier, s.tier) AS tier, CASE WHEN s.person_id IS NOT NULL THEN 'mid' END AS in_meta, CASE WHEN length(p.person_id) > 0 THEN '1' END AS kept FROM p LEFT JOIN s USING (person_id)""")
def stamped_owners(spark: SparkSession, folder: str) -> DataFrame:
    """A score written back: the tier only where there was none, the rest into the JSON of what matched."""
    people = table(spark, folder, "person").select("person_id", "primary_tier", "rank_score", "topics_json").distinct()
    scores = people.filter("rank_score > 10").select("person_id", F.lit("mid").alias("primary_tier"))
    filled = policies.fill(people, scores, ["person_id"], ["primary_tier"])
    meta = filled.join(scores.select("person_id", F.col("primary_tier").alias("new_tier")), "person_id", "left").withColumn("meta", jsonx.merged(F.lit('{"old": 1, "tier": "x"}'), F.to_json(F.struct(F.col("new_tier").alias("tier")))))
    tier = F.get_json_object("meta", "$.tier")
    return meta.select("person_id", F.col("primary_tier").alias("tier"), F.when(tier != "x", tier).alias("in_meta"), F.get_json_object("meta", "$.old").alias("kept"))


# --- texts and lists -------------------------------------------------------------------------------------------------

_LINES = r"""
l AS (SELECT doc_id, i, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS i FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') AS x FROM documents WHERE text <> ''))),
f AS (SELECT *, (starts_with(line, '```') OR starts_with(line, '~~~')) AS fence FROM l), o AS (SELECT *, sum(fence::INT) OVER (PARTITION BY doc_id ORDER BY i) AS fences FROM f), u AS (SELECT doc_id, i, line, regexp_matches(line, '^#{1,6}\s+') AS heading FROM o WHERE NOT fence AND fences % 2 = 0),
h AS (SELECT *, last_value(CASE WHEN heading THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS last_heading FROM u),
k AS (SELECT doc_id, i, last_heading, unnest(x) AS link, unnest(range(len(x))) AS j FROM (SELECT doc_id, i, last_heading, regexp_extract_all(line, 'https?://(?:www\.)?github\.com/[A-Za-z0-9][\p{L}\p{N}_.-]*/[\p{L}\p{N}_.-]+') AS x FROM h WHERE NOT heading)),
t AS (SELECT doc_id, i, last_heading, j, regexp_extract(link, 'github\.com/([^/]+)/', 1) AS owner, regexp_replace(regexp_replace(regexp_extract(link, 'github\.com/[^/]+/(.+)$', 1), '\.+$', ''), '\.git$', '') AS name FROM k),
e AS (SELECT doc_id, i, min(j) AS j, any_value(last_heading) AS last_heading, owner || '/' || name AS target FROM t WHERE name <> '' AND lower(owner) NOT IN ('topics', 'sponsors', 'orgs', 'users', 'collections', 'events', 'explore', 'features', 'about', 'pricing', 'settings',
    'notifications', 'search', 'marketplace', 'apps', 'login', 'join', 'readme', 'trending', 'new', 'user-attachments', 'user-images', 'avatars', 'camo', 'badges', 'shields', 'raw', 'assets', 'img', 'media', 'gist') GROUP BY doc_id, i, owner || '/' || name),
s AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS position, target, CASE WHEN NOT regexp_matches(last_heading, '^#\s') THEN trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(last_heading, '^#+\s+(.*?)\s*#*$', 1),
    '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '<[^>]+>|&[a-z]+;|&#[0-9]+;', ' ', 'g'), '\s+', ' ', 'g'), ' #*_-·|') END AS section FROM e)
"""


@query("document_links", f"WITH {_LINES} SELECT doc_id, position::INTEGER AS position, target, section FROM s")
def document_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links of every document under their headings."""
    return lists.list_entries(table(spark, folder, "documents"), key="doc_id", text="text").select(F.col("key").alias("doc_id"), "position", "target", "section")


@query("document_verdicts", f"""
WITH {_LINES}, n AS (SELECT doc_id, count(*) AS links, count(DISTINCT target) AS targets, count(section) AS with_section, count(DISTINCT section) AS sections FROM s GROUP BY 1),
d AS (SELECT d.doc_id, greatest(1, len(regexp_split_to_array(regexp_replace(text, '\\r?\\n$', ''), '\\r\\n|\\n|\\r'))) AS lines, coalesce(links, 0) AS links, coalesce(targets, 0) AS targets, coalesce(with_section, 0) AS with_section, coalesce(sections, 0) AS sections,
    coalesce(regexp_matches(text, '(?im)^[ \\t\\x0B\\f]*#\\s*(?:awesome\\s+stars|my\\s+stars|starred\\s+repositories)\\b'), false) AS exported FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id)
SELECT doc_id, links, targets, sections, links >= 20 AND links / lines >= 0.05 AND with_section >= 0.5 * links AND NOT (links > 300 AND sections <= 2) AND NOT exported AS is_list FROM d""")
def document_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents are curated lists."""
    docs = table(spark, folder, "documents")
    entries = lists.list_entries(docs, key="doc_id", text="text")
    verdicts = lists.list_verdicts(docs, entries, key="doc_id", text="text", languages=["Go", "Java", "Python", "Rust"])
    return verdicts.select(F.col("key").alias("doc_id"), "links", "targets", "sections", "is_list")


@query("crawled_lists", f"""
WITH {_LINES}, a AS (SELECT DISTINCT lower(target) AS full_name FROM s WHERE doc_id % 2 = 0), x AS (SELECT content_ref, min(doc_id) AS doc_id FROM documents WHERE text <> '' AND content_ref IS NOT NULL GROUP BY 1),
r AS (SELECT lower(content_ref) AS full_name, x.doc_id FROM x JOIN a ON a.full_name = lower(content_ref)) SELECT full_name, (SELECT count(*) FROM s WHERE s.doc_id = r.doc_id) AS links FROM r""")
def crawled_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Links of half of the documents followed to the texts of what they name."""
    docs = table(spark, folder, "documents").filter("text <> ''")
    texts = docs.filter("content_ref is not null").groupBy(F.col("content_ref").alias("full_name")).agg(F.min_by("text", "doc_id").alias("text"))
    seeds = docs.filter("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("full_name"), "text")
    return lists.crawled(seeds, texts, None, languages=[])[0].select("full_name", "links")


@query("list_titles", r"""
WITH top AS (SELECT doc_id, trim(regexp_replace(regexp_replace(nullif(regexp_extract(text, '(?is)<h1[^>]*>(.*?)</h1>', 1), ''), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM documents WHERE text <> ''),
""" + _LINES.strip() + r""",
m AS (SELECT doc_id, arg_min(line, i) AS line FROM u WHERE heading AND regexp_matches(line, '^#\s') GROUP BY 1)
SELECT top.doc_id, coalesce(nullif(top.t, ''), trim(regexp_replace(regexp_replace(regexp_replace(regexp_extract(m.line, '^#+\s+(.*?)\s*#*$', 1), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '<[^>]+>|&[a-z]+;|&#[0-9]+;', ' ', 'g'), '\s+', ' ', 'g'), ' #*_-·|')) AS title FROM top LEFT JOIN m USING (doc_id)""")
def list_titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("text <> ''").select("doc_id", lists.list_title("text").alias("title"))


@query("digests", "SELECT doc_id, array_to_string(list_slice(regexp_split_to_array(trim(text, ' '), '[ \\t\\n\\x0B\\f\\r]+'), 1, 20), ' ') AS digest FROM documents WHERE text IS NOT NULL")
def digests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("text is not null").select("doc_id", lists.digest(F.col("text"), words=20, size=1 << 20).alias("digest"))


@query("passage_cover", r"""
SELECT doc_id, length(regexp_replace(text, '[\p{Z}\s\x0B\x{85}\x1c-\x1f]+', '', 'g')) AS visible, true AS ordered, true AS bounded FROM documents WHERE length(regexp_replace(text, '[\p{Z}\s\x0B\x{85}\x1c-\x1f]+', '', 'g')) > 0 AND NOT regexp_matches(text, '(?i)\*\*\*\s*(START|END) OF TH')""")
def passage_cover(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of every document cover all that is visible, in order and without overlap, none above the longest allowed."""
    docs = table(spark, folder, "documents").filter(r"not text rlike '(?i)\\*\\*\\*\\s*(START|END) OF TH'")
    rows = passages.passages(docs, key="doc_id", text="text").withColumnRenamed("key", "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    visible = F.length(F.regexp_replace(F.expr("substring(text, cast(start + 1 as int), cast(end - start as int))"), r"[\p{Z}\s\x0B\x{85}\x1c-\x1f]+", ""))
    spans = F.array_sort(F.collect_list(F.struct("start", "end")))
    per = rows.select("doc_id", "start", "end", visible.alias("v")).groupBy("doc_id").agg(F.sum("v").alias("visible"), spans.alias("spans"), F.max(F.col("end") - F.col("start")).alias("longest"))
    ordered = F.forall(F.zip_with(F.slice("spans", 1, F.size("spans") - 1), F.slice("spans", 2, F.size("spans")), lambda a, b: a["end"] <= b["start"]), lambda x: x)
    return per.select("doc_id", "visible", ordered.alias("ordered"), (F.col("longest") <= passages.LONGEST).alias("bounded"))


@query("leaks", "SELECT doc_id, 'address' AS leak FROM documents WHERE regexp_matches(text, '[a-z]+@[a-z]+\\.[a-z]+') UNION ALL SELECT doc_id, 'folder' FROM documents WHERE contains(text, '/home/')")
def leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that hold what mustn't be published."""
    return quality.leaks(table(spark, folder, "documents"), "text", {"address": r"[a-z]+@[a-z]+\.[a-z]+", "folder": "/home/"}).select("doc_id", "leak")


@query("negative_controls", "SELECT id FROM (SELECT DISTINCT id, full_name, is_winner FROM bank_capability_pick) WHERE full_name LIKE 'a%' AND is_winner = 1")
def negative_controls(spark: SparkSession, folder: str) -> DataFrame:
    """Names that mustn't have won but did: here those of the owners with an a."""
    rows = table(spark, folder, "bank_capability_pick").select("id", "full_name", "is_winner").distinct()
    return quality.name_collisions(rows.withColumn("initial", F.substring("full_name", 1, 1)), ["a"], "is_winner", "initial").select("id")


@query("classified", """
WITH d AS (SELECT doc_id, lower(coalesce(title, '')) || ' ' || regexp_replace(lower(coalesce(title, '')), '[^a-z0-9+#.]+', ' ', 'g') AS h FROM documents), s AS (SELECT doc_id, CASE WHEN regexp_matches(h, '(^|[^a-z0-9])readme($|[^a-z0-9])') THEN 3 ELSE 0 END + CASE WHEN contains(h, 'vector search') THEN 4 ELSE 0 END AS a,
    CASE WHEN regexp_matches(h, '(^|[^a-z0-9])github($|[^a-z0-9])') THEN 6 ELSE 0 END AS b FROM d)
SELECT doc_id, array_to_string(CASE WHEN a >= 5 AND b >= 5 THEN CASE WHEN a >= b THEN ['first', 'second'] ELSE ['second', 'first'] END WHEN a >= 5 THEN ['first'] WHEN b >= 5 THEN ['second'] WHEN a > 0 THEN ['first'] ELSE [] END, ',') AS families FROM s""")
def classified(spark: SparkSession, folder: str) -> DataFrame:
    """Families from a score on, else the best one."""
    from quillmesh.operators import keywords

    families = {"first": {"readme": 3.0, "vector search": 4.0}, "second": {"github": 6.0}}
    out = keywords.classified(table(spark, folder, "documents").select("doc_id", "title"), keywords.haystack(F.col("title")), families)
    return out.select("doc_id", F.array_join("families", ",").alias("families"))


@query("requirement_names", "SELECT id, slug AS name FROM category WHERE slug <> ''")
def requirement_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names out of requirements with extras, versions and markers."""
    text = F.concat(F.lit("setup(name='x', install_requires=['"), F.col("slug"), F.lit("[extra]>=1.0; python_version<\"3\"'])"))
    rows = table(spark, folder, "category").filter("slug <> ''").select("id", manifests.parsed_manifest(F.lit("setup.py"), F.lit(None).cast("string"), text).alias("m"))
    return rows.select("id", F.explode("m.runtime").alias("name"))


@query("taxonomy", "SELECT lower(slug) AS family, lower(trim(w)) AS signal FROM (SELECT slug, unnest(string_split(coalesce(name, ''), ' ')) AS w FROM category WHERE slug <> '') WHERE trim(w) <> ''")
def taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """A taxonomy's signals in lower case, as rows."""
    rows = table(spark, folder, "category").filter("slug <> ''").select(F.lower("slug").alias("family"), F.explode(strings.split_values(F.lower("name"), " ")).alias("signal"))
    return rows
