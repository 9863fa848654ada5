import pytest
from pyspark.sql import functions as F

from quillmesh.operators import aggregates, graph, joins, keywords, policies, quality, ranking, sets
from quillmesh.storage import broadcast_if_small, cut_lineage, drop_table, pick


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_pick_finds_columns_by_position(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, A int, b int")
    assert pick(df, key="a", other="A").first().asDict() == {"key": 1, "other": 2}
    twice = df.select("b").withColumn("c", F.lit(1)).toDF("x", "x")
    assert pick(twice, y="x").first()["y"] == 3
    with pytest.raises(ValueError, match="missing"):
        pick(df, z="nope")


def test_cut_lineage_and_broadcast(spark):
    df = cut_lineage(spark.range(5))
    assert df.count() == 5 and "Hint" not in broadcast_if_small(df, limit=0)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" in broadcast_if_small(df)._jdf.queryExecution().analyzed().toString()
    drop_table(df)


def test_policies(spark):
    old = spark.createDataFrame([(1, "a", None), (2, None, 5)], "k int, s string, n int")
    new = spark.createDataFrame([(2, "b", 6), (3, "c", 7), (3, "d", 8)], "k int, s string, n int")
    assert rows(policies.keep_first(old, new, ["k"], [F.col("s")]), "k", "s") == [(1, "a"), (2, None), (3, "c")]
    assert rows(policies.keep_last(old, new, ["k"], [F.desc("s")]), "k", "s") == [(1, "a"), (2, "b"), (3, "d")]
    one = new.filter("n < 8")
    assert rows(policies.fill(old, one, ["k"], ["s", "n"]), "k", "s", "n") == [(1, "a", None), (2, "b", 5)]
    assert rows(policies.fill(old, one, ["k"], ["s", "n"], prefer="new"), "k", "s", "n") == [(1, "a", None), (2, "b", 6)]
    again = policies.keep_first(policies.keep_first(old, new, ["k"], [F.col("s")]), new, ["k"], [F.col("s")])
    assert again.count() == 3
    assert rows(policies.rebuild_keeping(new.filter("n = 6"), old, ["k"], ["s"]), "k", "n", "s") == [(2, 6, None)]
    assert policies.ensure_columns(old, "k int, extra double").columns == ["k", "s", "n", "extra"]
    assert rows(policies.summary({"old": old, "new": new}), "what", "rows") == [("new", 3), ("old", 2)]


def test_moved_links_stay_where_they_collide(spark):
    links = spark.createDataFrame([("a", "t1"), ("b", "t1"), ("a", "t2"), ("c", "t1")], "m string, t string")
    moves = spark.createDataFrame([("a", "b"), ("c", "b")], "m string, into string")
    assert rows(policies.move_links(links, moves, member="m", target="into", unique=["m", "t"]), "m", "t") == [("a", "t1"), ("b", "t1"), ("b", "t2"), ("c", "t1")]


def test_interval_overlap_against_brute_force(spark):
    import random

    rng = random.Random(4)
    spans = [(i, rng.choice("xy"), a := rng.randint(-50, 300), a + rng.randint(-2, 90)) for i in range(120)] + [(999, "x", None, 4)]
    df = spark.createDataFrame(spans, "id int, k string, a int, b int")
    got = rows(joins.interval_overlap(df, df, ["k"], start="a", end="b", width=25.0).filter("l_id < r_id"), "l_id", "r_id")
    good = [s for s in spans if s[2] is not None and s[2] < s[3]]
    assert got == sorted(((x[0], y[0]) for x in good for y in good if x[0] < y[0] and x[1] == y[1] and max(x[2], y[2]) < min(x[3], y[3])), key=str)
    plan = joins.interval_overlap(df, df, ["k"], start="a", end="b", width=25.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_latest_before(spark):
    left = spark.createDataFrame([("k", 1, "l1"), ("k", 5, "l2"), ("z", 5, "l3")], "k string, at int, name string")
    right = spark.createDataFrame([("k", 1, 10), ("k", 1, 11), ("k", 9, 12)], "k string, at int, v int")
    assert rows(joins.latest_before(left, right, ["k"], at="at", values=["v"], tie="v"), "name", "last_v") == [("l1", 11), ("l2", 11), ("l3", None)]


def test_other_joins(spark):
    people = spark.createDataFrame([("ann", "p1"), ("ann", "p2"), ("bob", "p3"), (None, "p4")], "n string, p string")
    assert rows(joins.match_by_name(people.select("n").distinct(), people, name="n", person="p"), "n", "matched", "confidence") == [("ann", "p1", 0.4), ("bob", "p3", 0.9)]
    keyed = spark.createDataFrame([("a", "x"), ("b", "y")], "h string, n string")
    by_h, by_n = spark.createDataFrame([("a", 1)], "h string, id int"), spark.createDataFrame([("x", 2), ("y", 3)], "n string, id int")
    assert rows(joins.resolve_in_order(keyed, [(by_h, "h"), (by_n, "n")], "id"), "h", "id") == [("a", 1), ("b", 3)]
    assert rows(joins.first_of_paths([by_h.withColumnRenamed("h", "n"), by_n.withColumn("n", F.lit("a"))], ["n"]), "id", "path") == [(1, 0)]
    uses = spark.createDataFrame([("c1", "c2"), ("c1", "c2"), ("c2", "c2")], "s string, t string")
    owners = spark.createDataFrame([("c1", "ann"), ("c2", "bob"), ("c2", "ann")], "thing string, person string")
    assert rows(joins.two_hop_edges(uses, owners, source="s", target="t", thing="thing", person="person"), "person_a", "person_b", "weight") == [("ann", "bob", 3), ("bob", "ann", 1)]
    pairs = joins.blocked_pairs(people, key="p", block=F.col("n"), extra=["n"])
    assert rows(pairs, "a", "b") == [("p1", "p2")]
    assert [r[0] for r in spark.createDataFrame([(1, 3), (1, 4), (None, 4)], "a int, b int").select(joins.within_tolerance(F.col("a"), F.col("b"), 2)).collect()] == [True, False, True]


def test_percentiles(spark):
    df = spark.createDataFrame([("g", 0.0), ("g", 0.0), ("g", 5.0), ("h", None), (None, 1.0)], "g string, s double")
    assert rows(ranking.tie_midpoint_percentile(df, ["g"], "s"), "g", "s", "percentile") == [("g", 0.0, 25.0), ("g", 0.0, 25.0), ("g", 5.0, 100.0), ("h", None, 50.0), (None, 1.0, 50.0)]
    numbers = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 37 % 1000).cast("double").alias("s"))
    assert ranking.values_at(numbers, "s", [0.0, 0.5, 0.995, 1.0]) == [0.0, 500.0, 995.0, 999.0]
    assert ranking.values_at(numbers.limit(0), "s", [0.5]) == [None]


def test_tiers_always_fall(spark):
    df = spark.createDataFrame([(i, float(i), i > 0) for i in range(10)], "i int, s double, c boolean")
    tiered = ranking.tiers(df, "s", F.col("c"), [("a", 0.5, 1.0), ("b", 0.9, 1.0)], "z")
    assert [r["tier"] for r in tiered.orderBy("i").collect()] == ["z"] * 5 + ["a"] * 5


def test_winners_packing_and_quota(spark):
    df = spark.createDataFrame([("g", 1, 0.9), ("g", 2, 0.85), ("g", 3, 0.4), ("h", 1, 0.9), ("h", 2, 0.5)], "g string, r int, s double")
    assert rows(ranking.winners(df, ["g"], rank="r", score="s"), "g", "r", "is_winner") == [("g", 1, 1), ("g", 2, 1), ("g", 3, 0), ("h", 1, 1), ("h", 2, 0)]
    sizes = spark.createDataFrame([(1, 6), (2, 5), (3, 4), (4, 30), (5, 1)], "i int, n long").withColumn("g", F.lit("x"))
    assert rows(ranking.packed_in_order(sizes, ["g"], [F.col("i")], "n", 10), "i", "asset", "offset") == [(1, 0, 0), (2, 1, 0), (3, 1, 5), (4, 2, 0), (5, 3, 0)]
    picked = ranking.stratified(df, "g", ["h", "g"], [F.col("r")], 3)
    assert rows(picked, "g", "r") == [("g", 1), ("h", 1), ("h", 2)]


def test_aggregates(spark):
    df = spark.createDataFrame([("o", "i", 1.0), ("o", "i", 3.0), ("o", "j", 8.0), ("p", "i", None)], "o string, i string, v double")
    assert rows(aggregates.weighted_mean(df, ["i"], ["o"], "v"), "o", "mean", "n") == [("o", 4.0, 3)]
    best = spark.createDataFrame([("o", 1, 5), ("o", 2, 5), ("o", 3, None)], "o string, id int, s int")
    assert rows(aggregates.argmax(best, ["o"], "id", F.col("s"), F.col("id")), "o", "id", "score") == [("o", 1, 5)]
    last = spark.createDataFrame([("k", 1, "a"), ("k", 2, ""), ("k", 3, None)], "k string, n int, v string")
    assert rows(aggregates.last_non_empty(last, ["k"], "v", "n"), "k", "v") == [("k", "a")]
    assert rows(aggregates.first_last_delta(best.filter("s is not null"), ["o"], at="id", value="s", tie="id"), "n", "delta") == [(2, 0)]
    assert rows(aggregates.rate_per_key(best, ["o"], F.col("s") == 5, least=4), "n", "hits", "rate") == [(3, 2, None)]


def test_trend(spark):
    days = [("a", f"2024-01-0{d}", d) for d in range(1, 7)] + [("b", "2024-01-06", 1)]
    df = spark.createDataFrame(days, "k string, day string, n int")
    assert rows(aggregates.trend(df, ["k"], day="day", amount="n"), "k", "early", "late", "recent", "trend") == [("a", 6, 15, 11, 2.5), ("b", 0, 1, 1, None)]
    assert aggregates.trend(df.filter("n > 99"), ["k"], day="day", amount="n").count() == 0
    assert rows(aggregates.trend(df.filter("n = 1 and k = 'a'"), ["k"], day="day", amount="n"), "recent") == [(1,)]


def test_tree(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 99)], "id int, up int")
    values = spark.createDataFrame([(2, 10), (3, 5), (3, 1), (4, 7)], "id int, v int")
    assert rows(aggregates.rolled_up(tree, values, node="id", parent="up", value="v"), "id", "own", "total") == [(1, 0, 16), (2, 10, 16), (3, 6, 6), (4, 7, 7)]
    with pytest.raises(ValueError, match="circle"):
        aggregates.tree_closure(spark.createDataFrame([(1, 2), (2, 1)], "id int, up int"), node="id", parent="up")


def test_keywords(spark):
    df = spark.createDataFrame([("Go web server", ["Rust"]), ("mango", []), (None, None)], "d string, t array<string>")
    families = {"web": {"web": 3.0, "server": 3.0}, "lang": {"go": 2.0}}
    got = keywords.classified(df, keywords.haystack(F.col("d")), families).collect()
    assert [r["families"] for r in got] == [["web"], [], []] and [(s["family"], s["score"]) for s in got[0]["family_scores"]] == [("web", 6.0), ("lang", 2.0)]
    routed = keywords.routed(df, F.col("t"), F.col("d"), {"rusty": ["rust"], "golang": ["go"]}).collect()
    assert [(r["tags"], r["source_of_tags"], r["bucket"]) for r in routed] == [(["golang", "rusty"], "topic", "ambiguous"), ([], "none", "dark"), ([], "none", "dark")]


def test_sets(spark):
    topics = spark.createDataFrame([("p1", "Law", "a"), ("p2", "law", "b"), ("p2", "art", "b"), ("p3", "the", "a"), ("p4", "the", "b")], "p string, t string, s string")
    assert rows(sets.bridge(topics, ("a", "b"), person="p", topic="t", scheme="s", stop=["the"], most_share=0.9), "person", "term") == [("p1", "law"), ("p2", "law")]
    assert rows(sets.bridge(topics, ("a", "b"), person="p", topic="t", scheme="s", stop=[], most_share=0.4), "person") == []
    df = spark.createDataFrame([("x",)], "k string")
    both = [("r1", 1, df), ("r2", 2, df), ("r2", 2, df)]
    assert sets.queue(both, "k").count() == 2 and rows(sets.queue(both, "k", highest_only=True), "reason") == [("r2",)]
    merged = spark.createDataFrame([("k", 1, 10, ["hooks"]), ("k", 2, 12, ["skills"])], "k string, n int, stars int, p array<string>")
    assert rows(sets.merge_candidates(merged, key="k", lists=["p"], scalars=["stars"], order="n"), "stars", "p") == [(12, ["hooks", "skills"])]


def test_graph(spark):
    people = spark.createDataFrame(
        [("a", "Doering, Jane", 1900, None, "x"), ("b", "Jane Doering", 1901, None, "y"), ("c", "Jane Doering", 1950, None, "x"), ("d", "J. Doering", None, None, "y"), ("e", "Doe, Jane", None, None, "z"),
         ("f", "", None, None, "x"), ("g", "Jane Doering", 1902, None, "y"), ("h", "Jane Doering", None, None, "z")],
        "p string, n string, b int, d int, o string",
    )
    ids = spark.createDataFrame([("e", "w", "Q1"), ("f", "w", "q1"), ("f", "w", None)], "p string, platform string, value string")
    got = rows(graph.claims(people, ids, person="p", name="n", birth="b", death="d", origin="o"), "person_a", "person_b", "method", "confidence")
    near = [("a", "b"), ("a", "d"), ("a", "g"), ("a", "h"), ("c", "d"), ("d", "h")]
    same = [("b", "h"), ("c", "h"), ("g", "h")]
    expected = [(*x, "surname_initial", 0.45) for x in near] + [(*x, "exact_name", 0.55) for x in same] + [("b", "g", "name_plus_years", 0.9), ("e", "f", "shared_external_id", 0.98)]
    assert got == sorted(expected, key=str)
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", None)], "p string, into string")
    assert rows(graph.merged_targets(chain, person="p", target="into"), "person", "final") == [("a", "c"), ("b", "c")]
    with pytest.raises(ValueError, match="circle"):
        graph.merged_targets(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "p string, into string"), person="p", target="into")
    works = spark.createDataFrame([(1, "Doe, Jane, 1820-1890; Various"), (2, "Doe, Jane, 1820-1890 [Editor]")], "w int, a string")
    authors, edges = graph.author_graph(works, work="w", authors="a")
    assert rows(authors, "name", "works", "corporate") == [("Doe, Jane", 2, 0), ("Various", 1, 1)] and edges.count() == 3
    facts = spark.createDataFrame([("a", ["b", None], ["c"])], "s string, teacher array<string>, pupil array<string>")
    assert rows(graph.directed_relations(facts, "s", {"teacher": ("taught_by", "in"), "pupil": ("taught", "out")}), "person_a", "person_b", "relation") == [("a", "b", "taught_by"), ("a", "c", "taught")]
    assert rows(graph.co_appearances(spark.createDataFrame([("h2", "g"), ("h1", "g"), ("h1", "g")], "h string, g string"), host="h", guest="g"), "g", "hosts", "times") == [("g", ["h1", "h2"], 3)]
    assert rows(graph.name_index(spark.createDataFrame([("p", "José Doe")], "p string, n string"), person="p", name="n"), "token") == [("doe",), ("jose",)]


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "sk-secret12345678")], "k int, s string")
    assert rows(quality.violations(df, {"has_s": F.col("s").isNotNull(), "fine": F.lit(True)}), "rule", "rows") == [("has_s", 1)]
    assert rows(quality.repeated_keys(df, ["k"]), "k", "n") == [(1, 2)]
    assert quality.leaks(df, "s", {"key": r"sk-[a-z0-9]{8,}", "path": r"/Users/"}).count() == 1
    assert rows(quality.orphans(df, spark.createDataFrame([(1,)], "id int"), "k", "id"), "k") == [(2,)]
