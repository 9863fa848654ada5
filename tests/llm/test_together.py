import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quillmesh.functions.urls import repository_name
from quillmesh.llm.together import items_together

SCHEMA = "basket string, item string"


def brute(rows, least, lift):
    of = defaultdict(set)
    for b, i in rows:
        if b and b.strip() and i and i.strip():
            of[i].add(b)
    total = len({b for bs in of.values() for b in bs})
    found = {}
    for x, y in combinations(sorted(of), 2):
        n = len(of[x] & of[y])
        if n >= least and n * total / (len(of[x]) * len(of[y])) >= lift:
            found[x, y] = (n, len(of[x]), len(of[y]), total)
    return found


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    got = items_together(df, basket="basket", item="item", min_llr=0.0, **more).collect()
    return {(r["item_a"], r["item_b"]): (r["together"], r["baskets_a"], r["baskets_b"], r["baskets"]) for r in got}


@pytest.mark.parametrize("large", [4096, 40])
def test_against_brute_force_with_large_baskets(spark, large):
    """With ``large`` at 40 the large baskets go through the prefix filter and the look-up."""
    rng = random.Random(5)
    rows = []
    for b in range(60):
        size = 700 if b < 3 else 60 if b < 12 else rng.randint(1, 8)
        rows += [(f"b{b}", f"i{rng.randint(0, 900 if size == 700 else 120)}") for _ in range(size)]
    rows += rows[:50] + [(None, "i1"), ("b1", None), ("", "i1"), ("b1", "  ")]
    assert found(spark, rows, min_together=3, min_lift=2.0, large_basket=large) == brute(rows, 3, 2.0)


def test_log_likelihood_ratio_and_threshold(spark):
    rows = [(f"b{i}", x) for i in range(6) for x in ("x", "y")] + [(f"c{i}", "z") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    row = items_together(df, basket="basket", item="item").first()
    assert (row["item_a"], row["item_b"], row["together"]) == ("x", "y", 6)
    assert row["lift"] == 6.0
    assert row["llr"] == pytest.approx(2 * (6 * 1.791759469 + 30 * 0.182321557), abs=1e-4)
    assert items_together(df, basket="basket", item="item", min_llr=1000.0).count() == 0


def test_lift_and_count_at_the_bound_are_kept(spark):
    rows = [(f"b{i}", x) for i in range(6) for x in ("x", "y")] + [(f"c{i}", "z") for i in range(6)]
    assert set(found(spark, rows, min_together=6, min_lift=2.0)) == {("x", "y")}
    assert not found(spark, rows, min_together=7, min_lift=2.0)
    assert not found(spark, rows, min_together=6, min_lift=2.01)


def test_empty_table_and_clashing_columns(spark):
    assert not found(spark, [])
    df = spark.createDataFrame([("b", "x", 1, "q")], "basket string, item string, n long, Basket string")
    assert items_together(df, basket="basket", item="item", min_together=1, min_lift=0.0).count() == 0


def test_repository_names(spark):
    forms = ["Owner/Name", " owner/name ", "https://www.github.com/Owner/Name/", "git+https://github.com/owner/name.git", "http://github.com/owner/name#readme",
             "owner/name,", "owner/name)", "owner/name.git", "owner/name.", "git@github.com:owner/name.git", "OWNER/NAME"]
    none = ["", "  ", None, "owner", "https://example.org"]
    df = spark.createDataFrame([(x,) for x in forms + none], "x string").select(repository_name(F.col("x")).alias("n"))
    got = [r["n"] for r in df.collect()]
    assert got[: len(forms)] == ["owner/name"] * len(forms)
    assert got[len(forms) :] == [None] * len(none)
