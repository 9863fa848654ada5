from quillmesh.llm.top_items import top_items

SCHEMA = "g long, item string, score double, place int, ITEM string"
NAN = float("nan")


def found(spark, rows, n=2):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in top_items(df, group="g", item="item", score="score", n=n).collect())


def test_ties_repeats_and_missing_scores(spark):
    rows = [(1, "b", 2.0), (1, "a", 2.0), (1, "a", 1.0), (1, "c", 2.0), (1, "c", 2.0), (2, "x", None), (2, "x", NAN), (2, "y", -0.0), (2, "w", 0.0),
            (None, "a", 9.0), (1, None, 9.0), (1, " ", 9.0), (3, "n", NAN), (1, "B", 2.0)]
    assert found(spark, rows) == [(1, 1, "B", 2.0), (1, 2, "a", 2.0), (2, 1, "w", 0.0), (2, 2, "y", 0.0)]


def test_fewer_and_none(spark):
    assert found(spark, [(1, "a", 1.0)], n=5) == [(1, 1, "a", 1.0)]
    assert found(spark, []) == []


def test_group_limit_is_on_both_sides_of_the_shuffle(spark):
    df = spark.createDataFrame([(i % 3, f"i{i}", float(i)) for i in range(100)], "g long, item string, score double")
    plan = top_items(df, group="g", item="item", score="score", n=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
