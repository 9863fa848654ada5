"""Edge cases of the operators on cards, media, registries, people and files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillmesh.operators import aggregates, cards, joins, media, people, ranking, registry
from quillmesh.sources import files
from quillmesh.storage import scratch


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_running_sums_in_ranges(spark):
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", None]), i, rng.randint(-5, 9)) for i in range(400)]
    expected, sums = {}, {}
    for g, i, n in data:
        expected[i] = sums.get(g, 0)
        sums[g] = sums.get(g, 0) + n
    got = ranking.sums_before(spark.createDataFrame(data, "g string, i int, n int").repartition(7), ["g"], "i", ["n"])
    assert {r["i"]: r["before_n"] for r in got.collect()} == expected
    assert ranking.sums_before(spark.createDataFrame([], "g string, i int, n int"), ["g"], "i", ["n"]).count() == 0


def test_overlaps_against_brute_force(spark):
    rng = random.Random(3)
    spans = [(rng.choice("xy"), a, a + rng.randint(-1, 12)) for a in (rng.randint(0, 40) for _ in range(120))]
    expected = {}
    for k in "xy":
        mine = [(a, b) for g, a, b in spans if g == k and a < b]
        met = [min(b, d) - max(a, c) for i, (a, b) in enumerate(mine) for c, d in mine[:i] if max(a, c) < min(b, d)]
        expected[k] = (len(met), sum(met))
    df = spark.createDataFrame([*spans, ("z", 1, 2), ("z", 2, 3), ("z", None, 4)], "k string, a long, b long")
    assert {r["k"]: (r["pairs"], r["overlap"]) for r in joins.overlap_totals(df, ["k"], start="a", end="b").collect()} == expected
    listed = joins.interval_overlap(df.withColumn("i", F.monotonically_increasing_id()), df.withColumn("i", F.monotonically_increasing_id()), ["k"], start="a", end="b", width=5)
    assert listed.filter("l_i < r_i").count() == sum(n for n, _ in expected.values())


def test_deep_trees_and_long_merges(spark):
    from quillmesh.operators import graph

    tree = spark.createDataFrame([(i, i - 1 if i else None) for i in range(40)] + [(100, 999)], "id int, up int")
    closure = aggregates.tree_closure(tree, node="id", parent="up")
    assert closure.count() == 40 * 41 // 2 + 1 and closure.distinct().count() == closure.count()
    chain = spark.createDataFrame([(f"p{i:02}", f"p{i + 1:02}") for i in range(50)], "person string, into string")
    assert {r["final"] for r in graph.merged_targets(chain, person="person", target="into").collect()} == {"p50"}


def test_cards_of_poor_rows(spark):
    schema = ", ".join(f"{f} {'boolean' if f in cards.FLAGS else 'long' if f in ('stars', 'forks') else 'string'}" for f in cards.FIELDS) + ", id string, at string, round string, n int"
    empty = dict.fromkeys(cards.FIELDS)
    data = [{**empty, "id": "a", "n": 1, "at": None, "round": "round-0002"}, {**empty, "id": "a", "n": 2, "at": None, "round": "x"}, {**empty, "id": "b", "n": 3, "topics": "[bad", "license": "NOASSERTION", "at": "", "round": None},
            {**empty, "id": None, "n": 4, "at": None, "round": None}]
    df = spark.createDataFrame(data, schema)
    got = cards.chosen_cards(df, "id", imported_at="at", raw_round="round", ordinal="n")
    assert rows(got, "id", "n", "schema_level", "field_score") == [("a", 1, "seed", 0), ("b", 3, "rich", 2)]
    assert cards.chosen_cards(df.limit(0), "id", imported_at="at", raw_round="round", ordinal="n").count() == 0


def test_answers_that_are_broken(spark):
    inputs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")], "batch int, name string")
    answers = spark.createDataFrame([(1, 'x [{"name": "a", "v": 1}, {"name": "a", "v": 2}, {"v": 3}] y'), (2, "[broken"), (3, None)], "batch int, text string")
    got = {r["name"]: (json.loads(r["object"])["v"] if r["object"] else None, r["error"]) for r in cards.aligned(inputs, answers, batch="batch", name="name", text="text").collect()}
    assert got == {"a": (2, None), "b": (None, "missing"), "c": (None, "unparsed"), "d": (None, "unparsed"), "e": (None, "unparsed")}


def test_claims_without_ground(spark):
    df = spark.createDataFrame([("fast vector index", ["Vector search", "vector SEARCH", "cooks dinner"], ["disk"], None), ("x", ["anything"], None, "line"), (None, None, None, None), ("summary: the tool", ["tool kit"], [], " ")],
                               "digest string, provides array<string>, requires array<string>, line_in string")
    got = cards.grounded(df, digest="digest", provides="provides", requires="requires", one_liner="line_in", stop=[])
    assert [(r["grounded"], r["dropped"], r["status"], r["line"]) for r in got.collect()] == [(["Vector search"], 1, "ok", ""), ([], 1, "ungrounded", ""), ([], 0, "ungrounded", ""), (["tool kit"], 0, "ok", "The tool.")]
    long = spark.createDataFrame([("y" * 200,), ("y" * 89,), ("done.",), (None,)], "t string").select(cards.short_sentence(F.col("t")).alias("s"))
    assert [len(r["s"]) for r in long.collect()] == [89, 89, 5, 0]


def test_slugs(spark):
    registry_rows = spark.createDataFrame([(1, "agent-platform", "Agent Platform"), (2, "data", "Data & Files"), (3, "data-lake", "Lake"), (4, None, "None")], "id long, slug string, name string")
    wanted = spark.createDataFrame([("Agent-Platform",), ("data-files",), ("standalone-agent-platform",), ("big-data-lake",), ("platform",), ("nothing",), (None,), ("",)], "w string")
    got = {r["w"]: r["category_id"] for r in cards.resolved_slugs(wanted, "w", registry_rows).collect()}
    assert got == {"Agent-Platform": 1, "data-files": 2, "standalone-agent-platform": 1, "big-data-lake": None, "platform": 1, "nothing": None, None: None, "": None}


def test_pieces_and_transcripts(spark):
    df = spark.createDataFrame([("a", 100, 30.5), ("b", 10_000, 300.0)], "k string, size long, s double")
    assert rows(media.planned_pieces(df, "k", size="size", seconds="s", most_bytes=1000, wanted_seconds=120), "k", "start", "length") == sorted([("a", 0, 31), *[("b", 60 * i, 60) for i in range(5)]], key=str)
    schema = "k string, off double, lang string, seg array<struct<start:double,end:double,text:string>>"
    pieces = spark.createDataFrame([("v", 60.0, "en", [(1.0, 2.5, " b "), (None, None, "")]), ("v", 0.0, "de", [(5.0, 4.0, "a")]), ("w", 0.0, None, [])], schema)
    segments, whole = media.merged_transcripts(pieces, "k", offset="off", language="lang", segments="seg")
    assert rows(segments, "start", "duration", "text") == [(5.0, 0.0, "a"), (60.0, 0.0, ""), (61.0, 1.5, "b")]
    assert rows(whole, "k", "segments", "seconds", "text", "languages") == [("v", 3, 62.5, "a\nb", "de,en")]


def test_registry_without_rows(spark):
    owners = spark.createDataFrame([("1", "7", "0"), ("1", "8", " 0 "), ("1", "9", "1"), (None, "7", "0")], "crate_id string, owner_id string, owner_kind string")
    users = spark.createDataFrame([("7", "Ann"), ("8", "")], "id string, gh_login string")
    crates = spark.createDataFrame([("2", "other")], "id string, name string")
    known = spark.createDataFrame([("ANN", "gh:ann")], "login string, person_id string")
    edges, claims = registry.maintainers(owners, users, crates, known)
    assert rows(edges, "person_id", "crate", "crate_count") == [("gh:ann", "1", 1)] and claims.count() == 0
    assert registry.maintainers(owners.limit(0), users, crates, known)[0].count() == 0
    teams = spark.createDataFrame([("9", "github:org:team"), ("8", "odd"), ("7", None)], "id string, login string")
    organisations, edges = registry.organisations(teams, owners, crates)
    assert rows(organisations, "organisation", "teams") == [("org", 1)] and edges.count() == 0


def test_graph_of_nothing(spark):
    known = spark.createDataFrame([("p1", " Ann  Lee", "github", None, None), ("p2", None, "github", 1900, 1950)], "person_id string, name string, origin string, birth_year int, death_year int")
    books = spark.createDataFrame([("k2", "ANN LEE", 1850, 1900, 3), ("k1", "Bo", None, None, 1), ("k0", "bo", 1700, None, 1)], "person_key string, name string, birth_year int, death_year int, works int")
    edges = spark.createDataFrame([], "person_id string, domain string, content_ref string, role string")
    book_edges = spark.createDataFrame([("k1", 5, "author"), ("k0", 5, "author"), ("nobody", 6, "author")], "person_key string, gid long, role string")
    subjects = spark.createDataFrame([(5, "law"), (5, "law2")], "gid long, subject string")
    built = people.built_graph(known, books, edges, book_edges, subjects)
    assert rows(built["person"], "person_id", "birth_year", "death_year", "state") == [("bk:k0", 1700, None, "linked"), ("p1", 1850, 1900, "tracked"), ("p2", 1900, 1950, "tracked")]
    assert rows(built["edge"], "person_id", "content_ref") == [("bk:k0", "5")] and rows(built["topic"], "person_id", "topic", "weight") == [("bk:k0", "law", 1), ("bk:k0", "law2", 1)]


def test_front_matter_and_places(spark):
    assert files.front_matter("---\na: 1\nl: [x, 'y']\nm:\n  - p\n  - \"q\"\nn:\n  deep: 1\n---\nbody\n") == ({"a": "1", "l": "x,y", "m": "p,q", "n": ""}, "body\n")
    assert files.front_matter("no front") == ({}, "no front") and files.front_matter(None) == ({}, "") and files.front_matter("---\nopen") == ({}, "---\nopen")
    assert files.first_existing(spark, ["/nowhere/at/all"]) is None


@pytest.mark.parametrize("pages,expected", [(1, 1), (5, 5), (20, 20), (21, 20), (1000, 20)])
def test_sampled_pages(spark, pages, expected):
    df = spark.range(1, pages + 1).select(F.col("id").cast("int").alias("p"))
    got = [r["p"] for r in df.filter(media.sampled_page(F.col("p"), F.lit(pages), 20)).orderBy("p").collect()]
    start = max(1, int(pages * 0.05))
    span = pages - start + 1
    assert got == (list(range(start, pages + 1)) if span <= 20 else sorted({int(start + i * span / 20) for i in range(20)})) and len(got) == expected


def test_texts_as_files(spark):
    folder = scratch(spark)
    df = spark.createDataFrame([("a.txt", "é"), ("b.txt", None)], "n string, t string")
    assert rows(files.write_texts(df, folder, name="n", text="t"), "name", "bytes") == [("a.txt", 2), ("b.txt", 0)]
    joined = files.concatenated(spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), ("s", 3, None)], "s string, k int, t string"), ["s"], key="k", text="t").first()
    assert joined["text"] == "a\n\nb\n\n"
