"""Queries of the scalar functions over real columns, with SQL twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import numbers, strings
from quillmesh.operators import joins, policies
from quillmesh.plans.registry import query
from quillmesh.storage import scratch
from quillmesh.streaming import incremental
from quillmesh.tables import table

AS_OF = "2026-06-30"


@query("cleaned_texts", r"""
WITH o AS (SELECT DISTINCT obs_id, description AS d FROM repo_observation), s AS (SELECT obs_id, d, trim(regexp_replace(coalesce(d, ''), '\s+', ' ', 'g'), ' ') AS q FROM o)
SELECT obs_id, q AS squeezed, CASE WHEN length(q) > 40 THEN rtrim(substr(q, 1, 39), ' ') || '…' ELSE q END AS short, trim('Label x ' || trim(regexp_replace(regexp_replace(q, '[*_`]+', '', 'g'), ' +', ' ', 'g'), ' '), ' ') AS plain,
    lower(trim(regexp_replace(regexp_replace(coalesce(d, ''), '[.\-–—_]', ' ', 'g'), '\s+', ' ', 'g'), ' ')) AS spaced FROM s""")
def cleaned_texts(spark: SparkSession, folder: str) -> DataFrame:
    """White space squeezed, cut to a length, without markdown, dots and dashes as blanks."""
    d = F.col("description")
    squeezed = strings.squeeze(d)
    marked = F.concat(F.lit("![pic](a.png) [Label](http://x) <b>x</b> &amp; **"), squeezed, F.lit("**"))
    rows = table(spark, folder, "repo_observation").select("obs_id", "description").distinct()
    return rows.select("obs_id", squeezed.alias("squeezed"), strings.truncated(squeezed, 40).alias("short"), strings.without_markdown(marked).alias("plain"), strings.spaced_name(d).alias("spaced"))


@query("read_numbers", """
WITH o AS (SELECT DISTINCT obs_id, abs(coalesce(stars, 0) % 10000000) AS n FROM repo_observation)
SELECT obs_id, n AS with_commas, CASE WHEN obs_id % 3 = 0 THEN n END AS whole, CASE obs_id % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE NULL END AS flag, CASE WHEN obs_id % 5 = 1 OR obs_id % 5 > 2 THEN true ELSE false END AS unset FROM o""")
def read_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """The first number of a text, a text that is one, flags in their spellings, and what isn't set."""
    i, n = F.col("obs_id"), F.abs(F.coalesce("stars", F.lit(0)) % 10_000_000)
    flag = F.when(i % 5 == 0, " Yes").when(i % 5 == 1, "0").when(i % 5 == 2, "TRUE").when(i % 5 == 3, "maybe")
    rows = table(spark, folder, "repo_observation").select("obs_id", "stars").distinct()
    return rows.select("obs_id", strings.first_int(F.concat(F.lit("about "), F.format_number(n, 0), F.lit(" stars, 7 forks"))).alias("with_commas"), strings.whole_int(F.when(i % 3 == 0, F.concat(F.lit(" "), n.cast("string"))).otherwise("12 x")).alias("whole"), strings.tri_state(flag).alias("flag"), (~F.coalesce(strings.tri_state(flag), F.lit(False))).alias("unset"))


@query("person_keys", r"""
WITH p AS (SELECT DISTINCT person_id, name, birth_year AS b, death_year AS d FROM person WHERE name IS NOT NULL), k AS (SELECT *, trim(regexp_replace(trim(regexp_replace(regexp_replace(lower(name), '\s+', ' ', 'g'), '\([^)]*\)', '', 'g'), ' '), '[^a-z0-9, ]', '', 'g'), ' ') AS base FROM p)
SELECT person_id, CASE WHEN coalesce(b, d) IS NOT NULL THEN base || '|' || coalesce(b::VARCHAR, '') || '-' || coalesce(d::VARCHAR, '') ELSE base END AS person_key FROM k""")
def person_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "person").select("person_id", "name", "birth_year", "death_year").distinct().filter("name is not null")
    return rows.select("person_id", strings.person_key(F.col("name"), F.col("birth_year"), F.col("death_year")).alias("person_key"))


@query("places", """
WITH n AS (SELECT n_nationkey, lower(n_name) AS s FROM nation), a AS (SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN NULL WHEN n_nationkey = 4 THEN 'berlin' ELSE s END AS place, s FROM n)
SELECT n_nationkey, place, CASE WHEN n_nationkey = 4 THEN 'germany' WHEN n_nationkey = 5 THEN 'germany' END AS country, CASE WHEN n_nationkey = 3 THEN NULL ELSE s END AS organisation FROM a""")
def places(spark: SparkSession, folder: str) -> DataFrame:
    """Typed places and employers: aliases, countries, noise and legal forms are parameters."""
    rows = table(spark, folder, "nation")
    names = {r["n_nationkey"]: r["n_name"].lower() for r in rows.filter("n_nationkey in (3, 4, 5)").collect()}  # three parameters
    raw, noise = F.concat(F.lit(" ("), F.upper("n_name"), F.lit(",  ")), [names[3]]
    place = strings.place(raw, {names[4]: "berlin"}, {"berlin": "germany", names[5]: "germany"}, noise)
    return rows.select("n_nationkey", place.alias("p"), strings.organisation(F.concat(F.lit("@"), F.col("n_name"), F.lit(", Inc.")), noise).alias("organisation")).select("n_nationkey", "p.place", "p.country", "organisation")


@query("subject_facets", """
WITH c AS (SELECT id, [trim(coalesce(name, '')), trim(slug), trim(status)] AS x, upper(substr(slug, 1, 2)) AS code FROM category), f AS (SELECT id, list_filter(x, lambda v: v <> '') AS x, code FROM c)
SELECT id, unnest(range(len(x)))::INTEGER AS depth, unnest(x) AS facet, CASE WHEN substr(code, 1, 1) IN ('A', 'B', 'C', 'D', 'E', 'F', 'G', 'H', 'J', 'K', 'L', 'M', 'N', 'P', 'Q', 'R', 'S', 'T', 'U', 'V', 'Z') THEN substr(code, 1, 1) END AS section FROM f""")
def subject_facets(spark: SparkSession, folder: str) -> DataFrame:
    """Headings cut into facets, and the section of a classification code."""
    heading = F.concat_ws(" -- ", F.coalesce("name", F.lit("")), "slug", "status")
    rows = table(spark, folder, "category").select("id", strings.library_class(F.substring("slug", 1, 2))["section"].alias("section"), F.explode(strings.facets(heading)).alias("f"))
    return rows.select("id", "f.depth", "f.facet", "section")


@query("file_numbers", "SELECT doc_id, CASE WHEN doc_id % 3 <> 2 THEN doc_id END AS number FROM documents")
def file_numbers(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("doc_id").cast("string")
    name = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("a/pg"), n, F.lit("-0.TXT"))).when(F.col("doc_id") % 3 == 1, F.concat(n, F.lit(".txt"))).otherwise(F.concat(F.lit("b/x"), n, F.lit(".txt")))
    return table(spark, folder, "documents").select("doc_id", strings.number_in_file_name(name).alias("number"))


@query("distinct_spellings", "SELECT person_id, any_value(first) AS first, count(*) AS n FROM (SELECT person_id, lower(t) AS k, 'x' AS first FROM (SELECT DISTINCT person_id, unnest([coalesce(name, ''), lower(coalesce(name, '')), coalesce(sort_name, ''), 'X']) AS t FROM person) GROUP BY 1, 2) GROUP BY 1")
def distinct_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Items that differ by case only count once, in their first spelling."""
    items = F.array(F.lit("x"), F.coalesce("name", F.lit("")), F.lower(F.coalesce("name", F.lit(""))), F.coalesce("sort_name", F.lit("")), F.lit("X"))
    rows = table(spark, folder, "person").select("person_id", "name", "sort_name").distinct().withColumn("kept", strings.distinct_ignoring_case(items))
    return rows.groupBy("person_id").agg(F.first("kept").alias("kept")).select("person_id", F.element_at("kept", 1).alias("first"), F.size("kept").cast("long").alias("n"))


@query("number_rules", f"""
WITH p AS (SELECT DISTINCT id, liftability::DOUBLE AS a, stars::DOUBLE AS b, TRY_CAST(pushed AS DATE) AS day FROM bank_capability_pick)
SELECT id, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN greatest(a, b) END AS top, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) END AS low, least(100.0, greatest(0.0, a - 50))::DOUBLE AS clamped, round_even(a / 8, 2)::DOUBLE AS even,
    round(1 / (1 + date_diff('day', day, DATE '{AS_OF}') / 365.0 / 2), 9)::DOUBLE AS fresh, round(log2(1 + b), 9)::DOUBLE AS tiebreak FROM p""")
def number_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Greatest and least of what is all known, clamps, rounding to even, freshness, the logarithm that breaks ties."""
    a, b, day = F.col("liftability").cast("double"), F.col("stars").cast("double"), F.col("pushed").try_cast("date")
    rows = table(spark, folder, "bank_capability_pick").select("id", "liftability", "stars", "pushed").distinct()
    return rows.select(
        "id", numbers.strict_greatest(a, b).alias("top"), numbers.strict_least(a, b).alias("low"), numbers.clamped(a - 50).alias("clamped"), numbers.half_even(a / 8, 2).alias("even"),
        F.round(numbers.hyperbolic_freshness(day, F.lit(AS_OF).cast("date")), 9).alias("fresh"), F.round(F.log2(1 + b), 9).alias("tiebreak"),
    )


@query("weighted_totals", "SELECT p_partkey, round((p_size % 6 * 2.0 + p_partkey % 6 * 3.0) / 5.0, 6)::DOUBLE AS total FROM part")
def weighted_totals(spark: SparkSession, folder: str) -> DataFrame:
    scores = F.array((F.col("p_size") % 6).cast("double"), (F.col("p_partkey") % 6).cast("double"))
    return table(spark, folder, "part").select("p_partkey", F.round(numbers.weighted_total(scores, F.array(F.lit(2.0), F.lit(3.0))), 6).alias("total"))


@query("built_json", "SELECT id, slug, level, length(coalesce(name, '')) AS chars FROM category")
def built_json(spark: SparkSession, folder: str) -> DataFrame:
    """Rows as JSON and back: types, nulls and quotes stay."""
    text = F.to_json(F.struct("id", "slug", F.struct("level", F.array(F.coalesce("name", F.lit(""))).alias("names")).alias("more")))
    rows = table(spark, folder, "category").select(F.from_json(text, "id long, slug string, more struct<level int, names array<string>>").alias("j"))
    return rows.select("j.id", "j.slug", "j.more.level", F.length(F.element_at("j.more.names", 1)).cast("long").alias("chars"))


@query("rank_window", "SELECT c_custkey, place FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) WHERE place BETWEEN 3 AND 5")
def rank_window(spark: SparkSession, folder: str) -> DataFrame:
    """A wave of a ranking: places from one to another within each group."""
    from quillmesh.operators.ranking import top_per_group

    top = top_per_group(table(spark, folder, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 5)
    return top.filter(F.col("place").between(3, 5)).select("c_custkey", F.col("place").cast("long").alias("place"))


def matching(**wanted) -> Column:
    """A predicate from what a caller asks for: a value, a list of values, a pair (least, most), or None for "any"."""
    parts = []
    for column, value in wanted.items():
        if value is None:
            continue
        c = F.col(column)
        parts.append(c.isin(*value) if isinstance(value, list) else c.between(*value) if isinstance(value, tuple) else c == value)
    return reduce(Column.__and__, parts, F.lit(True))


@query("dynamic_filter", "SELECT DISTINCT id FROM bank_capability_pick WHERE legal_lane IS NOT NULL AND is_winner = 1 AND stars BETWEEN 10 AND 100000 AND unit_class IN (SELECT min(unit_class) FROM bank_capability_pick UNION SELECT max(unit_class) FROM bank_capability_pick)")
def dynamic_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A filter put together from what was asked for; what wasn't doesn't filter."""
    rows = table(spark, folder, "bank_capability_pick")
    classes = rows.agg(F.min("unit_class").alias("a"), F.max("unit_class").alias("b")).first()
    return rows.filter(matching(is_winner=1, stars=(10, 100_000), unit_class=[classes["a"], classes["b"]], license=None)).filter("legal_lane is not null").select("id").distinct()


@query("quarter_overlaps", """
WITH s AS (SELECT c_nationkey AS n, c_custkey AS c, epoch(min(o_orderdate))::BIGINT AS a, epoch(max(o_orderdate))::BIGINT + 1 AS b FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
q AS (SELECT n_nationkey AS n, epoch(TIMESTAMP '1995-01-01' + INTERVAL 3 MONTH * i)::BIGINT AS a, epoch(TIMESTAMP '1995-01-01' + INTERVAL 3 MONTH * (i + 1))::BIGINT AS b, i FROM nation, (SELECT unnest(range(40)) AS i))
SELECT s.n AS nation, i::INTEGER AS quarter, count(*) AS customers, sum(least(s.b, q.b) - greatest(s.a, q.a))::BIGINT AS seconds FROM s JOIN q ON s.n = q.n AND greatest(s.a, q.a) < least(s.b, q.b) GROUP BY 1, 2""")
def quarter_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """Interval join: spans of customers against the quarters that they touch."""
    pairs = table(spark, folder, "customer").join(table(spark, folder, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    spans = pairs.groupBy(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("c")).agg(F.min(at).alias("a"), (F.max(at) + 1).alias("b"))
    quarters = table(spark, folder, "nation").select(F.col("n_nationkey").alias("nation"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("quarter"))

    def start(n: Column) -> Column:
        return F.unix_timestamp(F.add_months(F.lit("1995-01-01").cast("date"), n * 3).cast("timestamp"))

    quarters = quarters.select("nation", "quarter", start(F.col("quarter")).alias("a"), start(F.col("quarter") + 1).alias("b"))
    met = joins.interval_overlap(spans, quarters, ["nation"], start="a", end="b", width=86_400.0 * 182)
    return met.groupBy(F.col("l_nation").alias("nation"), F.col("r_quarter").alias("quarter")).agg(F.count("*").alias("customers"), F.sum(F.least("l_b", "r_b") - F.greatest("l_a", "r_a")).alias("seconds"))


@query("incremental_merge", """
WITH o AS (SELECT DISTINCT normalized_url, obs_id, stars FROM repo_observation WHERE normalized_url IS NOT NULL) SELECT normalized_url, arg_max(obs_id, (obs_id % 2, obs_id)) AS obs_id, arg_max(coalesce(stars, -1), (obs_id % 2, obs_id)) AS stars FROM o GROUP BY 1""")
def incremental_merge(spark: SparkSession, folder: str) -> DataFrame:
    """New files merged into a table as they come: first those of the even sightings, then those of the odd ones."""
    place = scratch(spark)
    rows = table(spark, folder, "repo_observation").filter("normalized_url is not null").select("normalized_url", "obs_id", F.coalesce("stars", F.lit(-1)).alias("stars")).distinct()
    for parity in (0, 1):
        rows.filter(F.col("obs_id") % 2 == parity).write.mode("append").json(f"{place}/in")
        incremental.run_new_files(spark, f"{place}/in", "normalized_url string, obs_id long, stars long", f"{place}/table", f"{place}/checkpoint", keys=["normalized_url"], order=[F.desc("obs_id")]).awaitTermination()
    return incremental.current(spark, f"{place}/table")


@query("windowed_counts", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per day and kind; the same plan runs on a stream."""
    events = table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return incremental.windowed_counts(events, at="ts", kind="event_type", width="1 day").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("write_summary", "SELECT 'before' AS what, count(*) AS rows FROM (SELECT DISTINCT obs_id FROM repo_observation WHERE source = 'curated/registry-sync.json') UNION ALL SELECT 'incoming', count(*) FROM (SELECT DISTINCT obs_id FROM repo_observation)")
def write_summary(spark: SparkSession, folder: str) -> DataFrame:
    """What a write would find, counted beside it."""
    rows = table(spark, folder, "repo_observation").select("obs_id", "source").distinct()
    return policies.summary({"before": rows.filter("source = 'curated/registry-sync.json'"), "incoming": rows})


@query("ensured_columns", "SELECT list_repo, NULL::DOUBLE AS score, NULL::VARCHAR AS note FROM curated_list")
def ensured_columns(spark: SparkSession, folder: str) -> DataFrame:
    return policies.ensure_columns(table(spark, folder, "curated_list").select("list_repo"), "list_repo string, score double, note string")
