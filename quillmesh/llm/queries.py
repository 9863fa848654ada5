"""The queries of the eight problems, with their SQL twins where SQL can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.urls import repository_name
from quillmesh.llm.groups import connected_groups
from quillmesh.llm.mixing import Mix, mix_sources
from quillmesh.llm.names import link_names, pairs_within
from quillmesh.llm.sentences import split_sentences
from quillmesh.llm.survivors import survivor_cards
from quillmesh.llm.together import items_together
from quillmesh.llm.tokens import encode_corpus
from quillmesh.llm.top_items import top_items
from quillmesh.storage import pick
from quillmesh.tables import table

# --- 1: items that appear together


def _together(spark: SparkSession, folder: str) -> DataFrame:
    entry = pick(table(spark, folder, "entry"), list_repo="list_repo", target_repo="target_repo")
    named = entry.select(repository_name(F.col("list_repo")).alias("list"), repository_name(F.col("target_repo")).alias("target"))
    return items_together(named, basket="list", item="target", min_together=6, min_lift=4.1)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _together(spark, folder).select(F.col("item_a").alias("target_a"), F.col("item_b").alias("target_b"))


def p1_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs with their counts, lift and log-likelihood ratio (4 places)."""
    pairs = _together(spark, folder)
    return pairs.select(
        F.col("item_a").alias("target_a"),
        F.col("item_b").alias("target_b"),
        "together",
        F.round("lift", 4).alias("lift"),
        F.round("llr", 4).alias("llr"),
    )


_NAMED = """
named AS (
    SELECT DISTINCT l, t FROM (
        SELECT regexp_extract(regexp_replace(regexp_replace(lower(trim(list_repo, ' <>()[]"'',;.')), '^(git\\+)?(https?://)?(www\\.)?github\\.com/', ''),
                   '(#.*|\\.git|[/.,;)])+$', ''), '^[^/]+/[^/]+') AS l,
               regexp_extract(regexp_replace(regexp_replace(lower(trim(target_repo, ' <>()[]"'',;.')), '^(git\\+)?(https?://)?(www\\.)?github\\.com/', ''),
                   '(#.*|\\.git|[/.,;)])+$', ''), '^[^/]+/[^/]+') AS t
        FROM entry)
    WHERE l <> '' AND t <> ''),
n AS (SELECT count(DISTINCT l) AS total FROM named),
per AS (SELECT t, count(*) AS c FROM named GROUP BY t),
pairs AS (
    SELECT x.t AS target_a, y.t AS target_b, count(*) AS together
    FROM named x JOIN named y ON x.l = y.l AND x.t < y.t GROUP BY 1, 2 HAVING count(*) >= 6),
found AS (
    SELECT target_a, target_b, together, (together * total)::DOUBLE / (a.c * b.c) AS lift, a.c AS a, b.c AS b, total
    FROM pairs JOIN per a ON a.t = target_a JOIN per b ON b.t = target_b, n
    WHERE (together * total)::DOUBLE / (a.c * b.c) >= 4.1)
"""

P1_FOUND = f"WITH {_NAMED} SELECT target_a, target_b FROM found"
P1_SCORES = f"""
WITH {_NAMED}
SELECT target_a, target_b, together, round(lift, 4) AS lift, round(2 * (
    together * ln(together * total::DOUBLE / (a * b))
    + CASE WHEN a > together THEN (a - together) * ln((a - together) * total::DOUBLE / (a * (total - b))) ELSE 0 END
    + CASE WHEN b > together THEN (b - together) * ln((b - together) * total::DOUBLE / ((total - a) * b)) ELSE 0 END
    + CASE WHEN total - a - b + together > 0
        THEN (total - a - b + together) * ln((total - a - b + together) * total::DOUBLE / ((total - a) * (total - b))) ELSE 0 END), 4) AS llr
FROM found
"""

# --- 2: variant spellings of names


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs_within(link_names(table(spark, folder, "person"))).select(F.col("a").alias("person_a"), F.col("b").alias("person_b"))


# --- 3: best representative of each duplicate group


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    cards = survivor_cards(table(spark, folder, "repo_observation"), table(spark, folder, "source_trust"))
    return cards.select("canonical_id", "stars_obs_id", "description_obs_id")


def p3_cards(spark: SparkSession, folder: str) -> DataFrame:
    """The cards themselves, with undated rows ordered by learned precedence."""
    return survivor_cards(table(spark, folder, "repo_observation"), table(spark, folder, "source_trust"), undated="learned")


P3_FOUND = r"""
WITH o AS (
    SELECT canonical_id, obs_id, coalesce(t.trust, -1) AS trust,
        CASE WHEN stars BETWEEN 0 AND 1000000 THEN stars END AS stars,
        trim(regexp_replace(description, '\s+', ' ', 'g')) AS d, regexp_extract(lower(normalized_url), '[^/]+/[^/]+$') AS own, observed_at AS raw
    FROM (SELECT DISTINCT * FROM repo_observation) o LEFT JOIN source_trust t USING (source)
    WHERE canonical_id IS NOT NULL),
p AS (
    SELECT canonical_id, obs_id, trust, stars,
        CASE WHEN regexp_matches(d, '\pL') AND lower(d) <> coalesce(own, '') AND lower(d) <> coalesce(split_part(own, '/', 2), '')
            AND lower(regexp_replace(d, '^[^\pL\pN]+|[^\pL\pN]+$', '', 'g')) NOT IN ('description', 'n/a', 'no description',
                'no description provided', 'no description, website, or topics provided', 'none', 'null', 'tbd', 'todo') THEN d END AS d,
        CASE WHEN regexp_matches(raw, '^\d{10}$') THEN make_timestamp(TRY_CAST(raw AS BIGINT) * 1000000)
            ELSE TRY_CAST(TRY_CAST(raw || CASE WHEN regexp_matches(raw, '(Z|[+-]\d\d:\d\d)$') THEN '' WHEN length(raw) = 10 THEN ' 00:00:00Z' ELSE 'Z' END
                AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) END AS moment
    FROM o),
q AS (
    SELECT * REPLACE (CASE WHEN moment < TIMESTAMP '2026-07-01' THEN moment ELSE TIMESTAMP '0001-01-01' END AS moment),
        rtrim(regexp_replace(d, '(…|\.\.+)$', '')) AS t FROM p),
q2 AS (SELECT * REPLACE (coalesce(moment, TIMESTAMP '0001-01-01') AS moment) FROM q),
texts AS (SELECT DISTINCT canonical_id, t FROM q2 WHERE t IS NOT NULL),
cut AS (
    SELECT DISTINCT x.canonical_id, x.t FROM texts x JOIN texts y
    ON x.canonical_id = y.canonical_id AND length(y.t) > length(x.t) AND starts_with(y.t, x.t))
SELECT canonical_id,
    coalesce((array_agg(obs_id ORDER BY moment DESC, trust DESC, obs_id) FILTER (WHERE stars IS NOT NULL))[1], 0)::BIGINT AS stars_obs_id,
    coalesce((array_agg(obs_id ORDER BY trust DESC, moment DESC, obs_id) FILTER (WHERE t IS NOT NULL AND cut.canonical_id IS NULL))[1], 0)::BIGINT AS description_obs_id
FROM q2 LEFT JOIN cut USING (canonical_id, t)
GROUP BY canonical_id HAVING count(DISTINCT obs_id) > 1
"""

# --- 4: pairwise matches into groups


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    claims = pick(table(spark, folder, "identity_claim"), a="person_a", b="person_b", status="status")
    accepted = claims.filter(F.lower(F.regexp_replace("status", r"^[\s\u00a0]+|[\s\u00a0]+$", "")) == "accepted")
    name = [F.when(F.trim(c) != "", F.trim(c)).alias(c) for c in ("a", "b")]
    return connected_groups(accepted.select(*name), a="a", b="b").select(F.col("vertex").alias("person_id"), "group_id")


P4_FOUND = """
WITH RECURSIVE link AS (
    SELECT DISTINCT trim(person_a) AS a, trim(person_b) AS b FROM identity_claim
    WHERE lower(trim(status)) = 'accepted' AND trim(person_a) <> trim(person_b) AND trim(person_a) <> '' AND trim(person_b) <> ''),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
    SELECT a AS person_id, least(a, min(b)) AS label FROM both_ways GROUP BY a
    UNION
    SELECT w.b, r.label FROM reach r JOIN both_ways w ON w.a = r.person_id WHERE r.label < w.b)
SELECT person_id, min(label) AS group_id FROM reach GROUP BY person_id
"""

# --- 5: top N items within every group


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    top = top_items(table(spark, folder, "bank_capability_pick"), group="category_id", item="full_name", score="score", n=5)
    return top.select(F.col("group_id").alias("category_id"), F.col("place").alias("leaf_rank"), F.col("item").alias("full_name"))


P5_FOUND = """
SELECT category_id, leaf_rank, full_name FROM (
    SELECT category_id, full_name, row_number() OVER (PARTITION BY category_id ORDER BY best DESC, full_name)::INTEGER AS leaf_rank
    FROM (SELECT category_id, full_name, max(score) AS best FROM bank_capability_pick
          WHERE category_id IS NOT NULL AND trim(full_name) <> '' AND NOT isnan(score) GROUP BY 1, 2))
WHERE leaf_rank <= 5
"""

# --- 6: encoding of the whole corpus


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"), key="doc_id", text="text").withColumnRenamed("key", "doc_id")


# --- 7: mixing sources to target weights


def _mix(spark: SparkSession, folder: str) -> Mix:
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_target"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every use of a document, with the slot of its block."""
    return _mix(spark, folder).rows


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares really reached, per source of the target."""
    return _mix(spark, folder).shares


def p7_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """Per source of the target what must hold of the mix, taken from its rows: uses beyond the cap, documents that aren't of
    the source or stand twice in a pass, and whether the report says what the rows do."""
    mix = _mix(spark, folder)
    documents = pick(table(spark, folder, "documents"), doc_id="doc_id", source="source", text="text").filter("text <> ''")
    usable = documents.groupBy("source").agg(F.count("*").alias("usable"))
    per_use = mix.rows.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.count_distinct("pass").alias("passes"), F.sum("tokens").alias("tokens"))
    per_use = per_use.join(documents.select("doc_id", F.col("source").alias("own")), "doc_id", "left")
    target = pick(table(spark, folder, "mix_target"), source="source", max_repeats="max_repeats").filter("source is not null")
    per_use = per_use.join(target, "source", "left")
    seen = per_use.groupBy("source").agg(
        F.count_if(F.col("n") > F.col("max_repeats")).alias("over_cap"),
        F.count_if(~F.col("own").eqNullSafe(F.col("source"))).alias("strangers"),
        F.count_if(F.col("n") != F.col("passes")).alias("repeated"),
        F.sum("tokens").alias("tokens"),
    )
    out = mix.shares.select("source", "target_share", "used_tokens", "actual_share", "outcome").join(target, "source").join(usable, "source", "left").join(seen, "source", "left")
    out = out.na.fill(0, ["usable", "over_cap", "strangers", "repeated", "tokens"])
    return out.select(
        "source",
        "max_repeats",
        "usable",
        "over_cap",
        "strangers",
        "repeated",
        (F.col("tokens") == F.col("used_tokens")).alias("reported"),
        (F.col("outcome") == "absent").alias("absent"),
        F.when(F.col("outcome") == "met", F.col("actual_share") >= F.col("target_share") * 0.9).otherwise(True).alias("near"),
    )


P7_INVARIANTS = """
SELECT t.source, max(t.max_repeats) AS max_repeats, coalesce(max(n), 0)::BIGINT AS usable, 0::BIGINT AS over_cap, 0::BIGINT AS strangers, 0::BIGINT AS repeated,
    true AS reported, coalesce(max(n), 0) = 0 AS absent, true AS near
FROM mix_target t LEFT JOIN (SELECT source, count(*) AS n FROM documents WHERE text <> '' GROUP BY 1) d ON d.source = t.source
WHERE t.source IS NOT NULL GROUP BY t.source
"""

# --- 8: sentence boundaries across languages and scripts


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_sentences(table(spark, folder, "documents"), key="doc_id", text="text").withColumnRenamed("key", "doc_id")


QUERIES = {
    "p1_found": p1_found, "p1_scores": p1_scores, "p2_found": p2_found, "p3_found": p3_found, "p3_cards": p3_cards, "p4_found": p4_found, "p5_found": p5_found,
    "p6_ids": p6_ids, "p7_mix": p7_mix, "p7_shares": p7_shares, "p7_invariants": p7_invariants, "p8_found": p8_found,
}
ORACLE_SQL = {"p1_found": P1_FOUND, "p1_scores": P1_SCORES, "p3_found": P3_FOUND, "p4_found": P4_FOUND, "p5_found": P5_FOUND, "p7_invariants": P7_INVARIANTS}
