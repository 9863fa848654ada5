"""Repository cards: candidates and nested answers made flat, the richest card of a repository, answers of a model checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.jsonx import salvaged
from quillmesh.functions.strings import content_words, distinct_ignoring_case, string_list
from quillmesh.operators.policies import one_per_key

# The fields of a card, the flags among them, and the levels of a card from poor to rich.
FIELDS = "full_name url stars language forks pushed_at created_at description license topics default_branch archived fork mirror".split()
FLAGS = ("archived", "fork", "mirror")
LEVELS = {"seed": 0, "basic": 1, "rich": 2, "rich_created": 3}
# Manifests to look for by language; package.json is looked for everywhere.
MANIFESTS = {
    "JavaScript": "package.json pnpm-workspace.yaml yarn.lock", "TypeScript": "package.json pnpm-workspace.yaml yarn.lock", "Python": "pyproject.toml setup.cfg requirements.txt setup.py",
    "Go": "go.mod", "Rust": "Cargo.toml", "Ruby": "Gemfile", "PHP": "composer.json", "Java": "pom.xml build.gradle build.gradle.kts",
    "Kotlin": "build.gradle.kts build.gradle settings.gradle.kts", "C#": "*.csproj",
}
# Kinds of remark that warn of something dangerous.
DANGERS = ("silent-noop", "error-vs-null", "type-surprise")


def _given(column: Column) -> Column:
    """Whether a text says anything."""
    return F.coalesce(~column.isin("", "NOASSERTION"), F.lit(False))


def has_field(name: str) -> Column:
    """Whether a card has the field: flags and numbers if known, topics if there are any, texts if they say anything."""
    if name in (*FLAGS, "stars", "forks"):
        return F.col(name).isNotNull()
    return F.size(string_list(F.col(name))) > 0 if name == "topics" else _given(F.col(name))


def schema_level() -> Column:
    """seed, basic, rich or rich_created, by which fields of ``FIELDS`` a card has."""
    flags = F.col("archived").isNotNull() & F.col("fork").isNotNull() & F.col("mirror").isNotNull()
    rich = flags | has_field("topics") | (F.coalesce("license", F.lit("")) != "") | (F.coalesce("default_branch", F.lit("")) != "")
    basic = (F.coalesce("language", F.lit("")) != "") | F.col("forks").isNotNull() | (F.coalesce("pushed_at", F.lit("")) != "")
    return F.when(flags & (F.coalesce("created_at", F.lit("")) != ""), "rich_created").when(rich, "rich").when(basic, "basic").otherwise("seed")


def chosen_cards(rows: DataFrame, key: str, *, imported_at: str, raw_round: str, ordinal: str) -> DataFrame:
    """The richest card of each key with its schema_level and field_score: by level, fields, import, round, and the last of equals.

    The field score counts the fields, and 4 more for a card of the highest level, 2 for a rich one.
    """
    scored = rows.withColumn("schema_level", schema_level())
    extra = F.when(F.col("schema_level") == "rich_created", 4).when(F.col("schema_level") == "rich", 2).otherwise(0)
    scored = scored.withColumn("field_score", sum((has_field(f).cast("int") for f in FIELDS), F.lit(0)) + extra)
    number = F.coalesce(F.regexp_extract(raw_round, r"([^-]*)$", 1).try_cast("int"), F.lit(-1))
    order = [F.desc(level_rank(F.col("schema_level"))), F.desc("field_score"), F.desc(F.coalesce(imported_at, F.lit(""))), F.desc(number), F.desc(ordinal)]
    return one_per_key(scored.filter(F.col(key).isNotNull()), [key], order)


def level_rank(level: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair])[level], F.lit(0))


def candidates(items: DataFrame, *, query: str, key: str, tags: list[str], observed_at: Column) -> DataFrame:
    """Items of a search answer as flat candidates with the usual defaults, sorted topics and tags, and the hash of the query."""

    def text(name: str, default: str = "") -> Column:
        value = F.col(name)
        return F.when(F.coalesce(value, F.lit("")) != "", value).otherwise(default)

    return items.select(
        F.coalesce(F.when(F.col("node_id") != "", F.col("node_id")), F.lower(F.coalesce("full_name", F.lit("")))).alias("candidate_key"),
        "full_name",
        F.col("html_url").alias("url"),
        text("description").alias("description"),
        text("owner.login").alias("owner_login"),
        text("default_branch").alias("default_branch"),
        text("language").alias("language"),
        F.array_sort(F.coalesce("topics", F.array().cast("array<string>"))).alias("topics"),
        text("license.spdx_id", "NOASSERTION").alias("declared_license_spdx"),
        F.coalesce("stargazers_count", F.lit(0)).alias("stars"),
        F.coalesce("archived", F.lit(False)).alias("archived"),
        observed_at.alias("observed_at"),
        F.lit(key).alias("source_query_key"),
        F.sha2(F.lit(query), 256).alias("query_hash"),
        F.array(*[F.lit(t) for t in sorted(set(tags))]).alias("capability_tags"),
    )


#: The shape of a repository in a nested answer.
NESTED = (
    "nameWithOwner string, url string, stargazerCount long, forkCount long, pushedAt string, isArchived boolean, licenseInfo struct<spdxId string, key string>, primaryLanguage struct<name string>, "
    "defaultBranchRef struct<name string>, repositoryTopics struct<nodes array<struct<topic struct<name string>>>>"
)


def flattened(items: DataFrame, answer: str) -> DataFrame:
    """Nested answers (JSON text) as flat rows: what the answer lacks is taken from the item's own full_name, url, language."""
    g = F.from_json(answer, NESTED)
    rows = items.withColumn("_g", F.coalesce(g, F.from_json(F.lit("{}"), NESTED)))
    names = F.transform("_g.repositoryTopics.nodes", lambda n: n["topic"]["name"])
    return rows.select(
        "canonical_id",
        F.coalesce("_g.nameWithOwner", "full_name").alias("full_name"),
        F.coalesce("_g.url", "url").alias("url"),
        F.col("_g.stargazerCount").alias("stars"),
        F.col("_g.forkCount").alias("forks"),
        F.col("_g.isArchived").alias("archived"),
        F.coalesce("_g.primaryLanguage.name", "language", F.lit("")).alias("language"),
        F.coalesce("_g.licenseInfo.spdxId", F.lit("")).alias("spdx_id"),
        F.coalesce("_g.defaultBranchRef.name", F.lit("main")).alias("default_branch"),
        F.coalesce(F.filter(names, lambda x: F.coalesce(x, F.lit("")) != ""), F.array().cast("array<string>")).alias("topics"),
    )


def manifest_paths(language: Column, most: int = 5) -> Column:
    """The manifests to look for, package.json last where the language doesn't name it."""
    table = F.create_map(*[x for name, paths in MANIFESTS.items() for x in (F.lit(name), F.array(*[F.lit(p) for p in paths.split()]))])
    return F.slice(F.array_distinct(F.concat(F.coalesce(F.try_element_at(table, language), F.array().cast("array<string>")), F.array(F.lit("package.json")))), 1, most)


def dependency_hints(package_json: Column, most: int = 80) -> Column:
    """Names of all dependencies of a package.json, sorted, each once; empty for text that isn't JSON."""
    groups = [F.map_keys(F.from_json(F.get_json_object(package_json, f"$.{g}"), "map<string,string>")) for g in ("dependencies", "devDependencies", "peerDependencies")]
    empty = F.array().cast("array<string>")
    return F.slice(F.array_sort(F.array_distinct(F.concat(*[F.coalesce(g, empty) for g in groups]))), 1, most)


def fetch_state(*, resolved: Column, http_status: Column, readme: Column, manifest: Column, digest_bytes: Column, most_bytes: int = 1536) -> Column:
    """struct(status, content_sha): no_commit, no_readme, digest_too_big or ok; the hash is that of readme, a zero byte, manifest."""
    text = F.coalesce(readme, F.lit(""))
    sha = F.sha2(F.concat(F.encode(text, "UTF-8"), F.unhex(F.lit("00")), F.encode(F.coalesce(manifest, F.lit("")), "UTF-8")), 256)
    unread = (F.coalesce(http_status, F.lit(0)) != 200) & (text == "")
    status = F.when(~F.coalesce(resolved, F.lit(False)), "no_commit").when(unread, "no_readme").when(digest_bytes > most_bytes, "digest_too_big").otherwise("ok")
    return F.struct(status.alias("status"), F.when(status.isin("ok", "digest_too_big"), sha).alias("content_sha"))


def next_attempts(candidates: DataFrame, attempts: DataFrame, key: str) -> DataFrame:
    """Candidates with the number of the attempt that comes: one more than the highest so far."""
    so_far = attempts.groupBy(key).agg(F.max("attempt_count").alias("_n"))
    return candidates.join(so_far, key, "left").withColumn("attempt_count", F.coalesce("_n", F.lit(0)) + 1).drop("_n")


def aligned(inputs: DataFrame, answers: DataFrame, *, batch: str, name: str, text: str) -> DataFrame:
    """Each input with the object of its batch's answer that names it: (batch, name, object, error).

    The answer is the largest bracketed part of the text that is JSON. Without one all inputs of the batch have the error
    "unparsed"; an input that no object names has "missing"; of several objects of a name the last counts.
    """
    parsed = answers.select(batch, F.from_json(salvaged(F.col(text)), "array<string>").alias("_objects"))
    objects = parsed.select(batch, F.posexplode("_objects").alias("_place", "_object")).withColumn(name, F.get_json_object("_object", f"$.{name}")).filter(F.col(name) != "")
    objects = objects.groupBy(batch, name).agg(F.max_by("_object", "_place").alias("object"))
    usable = parsed.groupBy(batch).agg(F.max(F.size("_objects") > 0).alias("_usable"))
    out = inputs.join(objects, [batch, name], "left").join(usable, batch, "left")
    error = F.when(~F.coalesce("_usable", F.lit(False)), "unparsed").when(F.col("object").isNull(), "missing")
    return out.select(batch, name, "object", error.alias("error"))


def short_sentence(text: Column, most: int = 90) -> Column:
    """One line of at most ``most`` characters that ends with a period; empty for an empty one."""
    s = F.trim(F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r'^"+|"+$', ""))
    s = F.when(F.length(s) > most, F.rtrim(F.substring(s, 1, most - 1))).otherwise(s)
    closed = F.concat(F.when(F.length(s) >= most - 1, F.substring(s, 1, most - 2)).otherwise(s), F.lit("."))
    return F.when(s == "", "").when(s.endswith("."), s).otherwise(closed)


def grounded(cards: DataFrame, *, digest: str, provides: str, requires: str, one_liner: str, stop: list[str], most: int = 5) -> DataFrame:
    """Claims about a text checked against it: of ``provides`` those that share a content word with the digest, at most ``most``.

    Adds grounded, dropped (their number), wants (at most 4 of ``requires``), line (a short sentence, or else the digest's summary)
    and status: "ok", or "ungrounded" where no claim is left. Claims that differ only by case count once.
    """

    def clean(column: str) -> Column:
        items = F.filter(F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
        return distinct_ignoring_case(items)

    rows = cards.withColumn("_known", content_words(F.col(digest), stop)).withColumn("_claims", clean(provides))
    held = F.filter("_claims", lambda x: F.arrays_overlap(content_words(x, stop), F.col("_known")))
    rows = rows.withColumn("_held", held)
    summary = F.regexp_extract(digest, r"summary:\s*([^\n]+)", 1)
    summary = F.concat(F.upper(F.substring(summary, 1, 1)), F.lower(F.substring(summary, 2, 1 << 30)))
    line = F.when(short_sentence(F.col(one_liner)) != "", short_sentence(F.col(one_liner))).otherwise(short_sentence(summary))
    ok = F.size("_held") > 0
    out = rows.withColumn("grounded", F.slice("_held", 1, most)).withColumn("dropped", F.size("_claims") - F.size("_held")).withColumn("wants", F.when(ok, F.slice(clean(requires), 1, 4)).otherwise(F.array().cast("array<string>")))
    return out.withColumn("line", F.when(ok, line).otherwise("")).withColumn("status", F.when(ok, "ok").otherwise("ungrounded")).drop("_known", "_claims", "_held")


def install_line(digest: Column, full_name: Column) -> Column:
    """How to install what a digest describes, by the first kind of package that it names; else where to clone it."""
    low = F.lower(F.coalesce(digest, F.lit("")))
    hint = F.regexp_extract(F.coalesce(digest, F.lit("")), r"pkg[_ ]?name[:=]\s*([A-Za-z0-9._@/-]+)", 1)
    name = F.when(hint != "", hint).otherwise(F.trim(F.regexp_extract(full_name, r"^[^/]*/(.*)$", 1)))
    out = None
    for command, signs in (("npm install", ("npm", "node", "javascript", "typescript")), ("pip install", ("pip", "python", "pyproject")), ("cargo add", ("cargo", "rust")), ("go get", ("go get", "go.mod"))):
        hit = F.lit(False)
        for sign in signs:
            hit = hit | low.contains(sign)
        line = F.when(name != "", F.concat(F.lit(f"{command} "), name)).otherwise(F.concat(F.lit("# clone "), full_name))
        out = F.when(hit, line) if out is None else out.when(hit, line)
    return out.otherwise(F.concat(F.lit("# clone https://github.com/"), full_name))


def resolved_slugs(rows: DataFrame, slug: str, registry: DataFrame) -> DataFrame:
    """``rows`` with the registry's id of their slug: the slug itself, else the slug of a name, else the only slug that is part of it
    or ends with it; null where none or several fit. ``registry`` (id, slug, name) is a taxonomy of bounded size."""
    wanted = rows.select(F.lower(F.trim(slug)).alias("_w")).filter("_w <> ''").distinct()
    known = registry.filter("slug <> ''").select(F.col("id").alias("_id"), F.lower("slug").alias("_s"), F.regexp_replace(F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-"), "^-+|-+$", "").alias("_n"))
    exact = wanted.join(known, F.col("_w") == F.col("_s")).groupBy("_w").agg(F.min("_id").alias("_id"))
    named = wanted.join(known, F.col("_w") == F.col("_n")).groupBy("_w").agg(F.min("_id").alias("_id"))
    left = wanted.join(exact.select("_w"), "_w", "left_anti").join(named.select("_w"), "_w", "left_anti")
    # All parts of a slug, some hundreds at most, meet the registry by equality, not by a search in every pair.
    n = F.length("_w")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.substring(F.col("_w"), i, k))))
    inside = left.withColumn("_s", F.explode(F.array_distinct(parts))).join(known, "_s").select("_w", "_s", "_id")
    tails = known.withColumn("_w", F.explode(F.transform(F.sequence(F.lit(1), F.length("_s")), lambda i: F.substring(F.col("_s"), i, F.length("_s")))))
    longer = left.join(tails, "_w").select("_w", "_s", "_id")
    fitting = inside.union(longer).groupBy("_w").agg(F.count_distinct("_s").alias("_k"), F.min("_id").alias("_id")).filter("_k = 1").drop("_k")
    found = exact.union(named.join(exact.select("_w"), "_w", "left_anti")).union(fitting).select("_w", F.col("_id").alias("category_id"))
    return rows.withColumn("_w", F.lower(F.trim(slug))).join(found, "_w", "left").drop("_w")


def remarks(items: Column, most: int = 3) -> Column:
    """Of an array of structs (kind, text, confidence) the dangerous ones, sure ones first, or any where none is; at most ``most``."""
    danger = F.filter(items, lambda x: x["kind"].isin(*DANGERS))
    sure, unsure = F.filter(danger, lambda x: x["confidence"] == "high"), F.filter(danger, lambda x: ~F.coalesce(x["confidence"] == "high", F.lit(False)))
    return F.slice(F.when(F.size(danger) > 0, F.concat(sure, unsure)).otherwise(items), 1, most)


def examples(placements: DataFrame, *, group: str, item: str, score: str, most: int = 3) -> DataFrame:
    """The best items of every group as one array in order."""
    from quillmesh.operators.ranking import top_per_group

    top = top_per_group(placements, [group], [F.desc_nulls_last(score), F.col(item)], most)
    return top.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", item))), lambda x: x[item]).alias("examples"))


def blocks_of_text(rows: DataFrame, batch: str, order: str, block: Column) -> DataFrame:
    """One text per batch from the blocks of its rows in order. A batch has as many rows as one request may."""
    return rows.groupBy(batch).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), block.alias("b")))), lambda x: x["b"]), "\n").alias("text"))
