import math
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmesh.llm.mixing import mix_sources, plan_quotas, schedule
from quillmesh.tables import table

FOLDER = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, source string, tokens long, SOURCE string"
TARGET = "source string, target_share double, max_repeats int"


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.lists(st.integers(1, 40), max_size=30), min_size=1))
def test_schedule_is_less_than_the_largest_block_away_from_every_share(blocks):
    slots = schedule(blocks)
    assert sorted(slots) == sorted((s, j) for s, lengths in blocks.items() for j in range(len(lengths)))
    assert_bound([(s, blocks[s][j]) for s, j in slots], max((n for lengths in blocks.values() for n in lengths), default=1))


def assert_bound(steps, largest):
    """After each (source, tokens) every source is less than ``largest`` away from its share of all."""
    whole = {}
    for s, n in steps:
        whole[s] = whole.get(s, 0) + n
    total, now, given_so_far = sum(whole.values()), 0, dict.fromkeys(whole, 0)
    for s, n in steps:
        given_so_far[s] += n
        now += n
        assert all(abs(given_so_far[r] - whole[r] * now / total) < largest for r in whole)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables aren't here")
def test_rows_keep_the_bound(spark):
    mix = mix_sources(table(spark, FOLDER, "documents"), table(spark, FOLDER, "mix_target"))
    rows = mix.rows.orderBy("slot", "at").collect()
    blocks = {}
    for r in rows:
        blocks[r["slot"]] = blocks.get(r["slot"], 0) + r["tokens"]
    assert len(rows) > 20
    assert_bound([(r["source"], r["tokens"]) for r in rows], max(blocks.values()))


def test_long_documents_keep_the_bound(spark):
    docs = [(i, "word " * (3 + 400 * (i % 11 == 0)), "ab"[i % 2], 1, "x") for i in range(300)]
    target = spark.createDataFrame([("a", 0.7, 1), ("b", 0.3, 2)], TARGET)
    rows = mix_sources(spark.createDataFrame(docs, DOCS), target).rows.orderBy("slot", "at").collect()
    blocks = {}
    for r in rows:
        blocks[r["slot"]] = blocks.get(r["slot"], 0) + r["tokens"]
    assert_bound([(r["source"], r["tokens"]) for r in rows], max(blocks.values()))


def test_quotas():
    targets = {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 3)}
    assert plan_quotas(targets, {"a": 1000, "b": 300, "c": 500}) == {"a": 1000, "b": 600, "c": 400}
    assert plan_quotas(targets, {"a": 1000, "b": 300}) == {"a": 1000, "b": 600, "c": 0}
    assert plan_quotas(targets, {"a": 1000, "b": 100, "c": 500}, 2000) == {"a": 1000, "b": 200, "c": 400}
    assert plan_quotas(targets, {}) == {"a": 0, "b": 0, "c": 0}


def test_shares_repeats_and_order(spark):
    docs = [(i, "word " * (20 + i % 7), "big", 1, "x") for i in range(600)] + [(1000 + i, "note " * 30, "small", 1, "x") for i in range(20)]
    docs += [(2000, None, "big", 1, "x"), (2001, "", "small", 1, "x"), (2002, "lost", None, 1, "x"), (2003, "other", "unlisted", 1, "x"), (None, "no key at all", "big", 1, "x")]
    target = [("big", 0.8, 1), ("small", 0.2, 3), ("none", 0.1, 2), (None, 0.5, 1), ("bad", float("nan"), 1)]
    mix = mix_sources(spark.createDataFrame(docs, DOCS), spark.createDataFrame(target, TARGET))
    shares = {r["source"]: r for r in mix.shares.collect()}
    rows = mix.rows.orderBy("slot", "at").collect()
    assert {s: r["outcome"] for s, r in shares.items()} == {"big": "met", "small": "met", "none": "absent", "bad": "absent"}
    assert shares["small"]["actual_share"] == pytest.approx(0.2 / 1.0, abs=0.02)
    uses = {}
    for r in rows:
        uses.setdefault((r["source"], r["doc_id"]), []).append(r["pass"])
    assert all(sorted(p) == list(range(len(p))) for p in uses.values())
    assert max(len(p) for (s, _), p in uses.items() if s == "small") == 3 and max(len(p) for (s, _), p in uses.items() if s == "big") == 1
    assert sum(r["tokens"] for r in rows) == sum(r["used_tokens"] for r in shares.values())
    for source in ("big", "small"):  # the stream of a source has no gaps
        at = 0
        for r in sorted((r for r in rows if r["source"] == source), key=lambda r: r["at"]):
            assert r["at"] == at
            at += r["tokens"]
    again = mix_sources(spark.createDataFrame(docs[::-1], DOCS), spark.createDataFrame(target, TARGET))
    assert again.rows.orderBy("slot", "at").collect() == rows


def test_given_total_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three", "a", 1, "x")], DOCS)
    target = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1)], TARGET)
    report = {r["source"]: (r["used_tokens"], r["outcome"]) for r in mix_sources(docs, target, total_tokens=100).shares.collect()}
    assert report == {"a": (6, "short"), "b": (0, "absent")}
    assert mix_sources(docs.limit(0), target).rows.count() == 0
    assert mix_sources(docs, target.limit(0)).shares.count() == 0
    assert math.isclose(sum(r["target_share"] for r in mix_sources(docs, target).shares.collect()), 1.0)
