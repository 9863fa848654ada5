import random

import pytest

from quillmesh.llm import groups
from quillmesh.llm.groups import connected_groups


def brute(links):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


def found(spark, links, schema="a string, b string"):
    return {r["vertex"]: r["group_id"] for r in connected_groups(spark.createDataFrame(links, schema), a="a", b="b").collect()}


def test_random_links_stars_and_chains(spark):
    rng = random.Random(3)
    links = [(f"v{rng.randint(0, 300):04d}", f"v{rng.randint(0, 300):04d}") for _ in range(120)]
    links += [("hub", f"s{i:04d}") for i in range(400)]
    links += [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(120)]  # in order of name
    links += [(b, a) for a, b in links[:40]] + [("x", "x"), (None, "v0001"), ("v0002", None), (None, None)]
    assert found(spark, links) == brute(links)


def test_giant_that_is_longer_than_the_rounds(spark, monkeypatch):
    monkeypatch.setattr(groups, "PEEL_ROUNDS", 2)
    links = [("m050", f"s{i}") for i in range(9)] + [(f"m{i:03d}", f"m{i + 1:03d}") for i in range(100)] + [("p", "q")]
    assert found(spark, links) == brute(links)


@pytest.mark.parametrize("length", [7, 8, 9, 10, 11])
@pytest.mark.parametrize("leaves", [0, 5])
def test_giant_that_ends_with_the_last_round(spark, length, leaves):
    """The hub is v01; with 9 links behind it the last round reaches the end, with another pair still to label."""
    links = [(f"v{i:02d}", f"v{i + 1:02d}") for i in range(length + 1)] + [("v01", f"leaf{i}") for i in range(leaves)] + [("p", "q")]
    assert found(spark, links) == brute(links)


@pytest.mark.parametrize("links", [[], [(None, "a")], [("a", "a")]])
def test_nothing_linked(spark, links):
    assert found(spark, links) == {}


def test_numbers_and_further_columns(spark):
    df = spark.createDataFrame([(3, 1, "x", 9), (1, 7, "y", 9)], "a long, b long, vertex string, A long")
    assert {tuple(r) for r in connected_groups(df, a="a", b="b").collect()} == {(1, 1), (3, 1), (7, 1)}
