import datetime

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import jsonx, numbers, strings, urls
from quillmesh.functions.authors import author_parts
from quillmesh.functions.fuzzy import sequence_ratio, topic_match, without_accents


@pytest.fixture(scope="module")
def apply(spark):
    def run(expression, *values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]

    return run


def test_addresses(apply):
    assert apply(urls.clean_url, " <git+https://a.b/c> ", "x).,;", None) == ["https://a.b/c", "x", None]
    assert apply(urls.normalized_repository_url, "http://www.GitHub.com/Owner/Name.git", "github.com/a/b/tree/x?q=1", "https://github.com/only", "a b/c/d", None) == [
        "https://github.com/owner/name", "https://github.com/a/b", None, None, None,
    ]
    assert apply(urls.repository_from_url, "git@github.com:A/B.git", "see https://github.com/c/d?x", "none") == ["a/b", "c/d", None]
    assert apply(urls.provisional_id, "u") == ["provisional:0bfe935e70c321c7ca3afc75ce0d0ca2f98b5422e008bb31c00c6d7f1f1c0ad6"]


def test_numbers_in_text(apply):
    assert apply(strings.first_int, "1,234 stars", "none", None) == [1234, None, None]
    assert apply(strings.whole_int, " 12 ", "1,234", "x") == [12, None, None]
    assert apply(strings.tri_state, "Yes", "0", "", None) == [True, False, None, None]


def test_lists_in_text(apply):
    assert apply(strings.string_list, '["A", " b", "a"]', "x, Y,,x", "[broken", None) == [["a", "b"], ["x", "y"], [], []]
    assert apply(lambda c: strings.distinct_ignoring_case(F.split(c, ",")), "A,b,a,B,c") == [["A", "b", "c"]]
    assert apply(strings.split_values, " a ; ;b") == [["a", "b"]]
    assert [tuple(x) for x in apply(strings.facets, "Law -- History -- ")[0]] == [(0, "Law"), (1, "History")]
    assert [tuple(x) for x in apply(strings.library_class, "PS", "I2", "")] == [("P", "PS"), (None, None), (None, None)]


def test_names(apply):
    assert apply(strings.plain_name, "Dr. José (Joe) Núñez, Sir", None) == ["jos n ez,", ""]
    assert [tuple(x) for x in apply(strings.surname_and_given, "Doe, Jane Q.", "Jane Q. Doe", "Doe")] == [("doe", "jane q"), ("doe", "jane q"), ("doe", "")]
    assert apply(strings.spaced_name, "a.b-C ") == ["a b c"]
    assert apply(strings.slug, "  Hello, World! ") == ["hello-world"]
    assert apply(strings.topic_slug, "x/awesome-python", "x/List-of-go", "x/awesome") == ["python", "of-go", "awesome"]
    assert apply(strings.owner, "a/b", "none") == ["a", None]
    assert apply(strings.team_organisation, "github:org:team", "github:only", "x:y:z") == ["org", None, None]
    assert apply(lambda c: strings.person_key(c, F.lit(1900), F.lit(None).cast("int")), "Doe,  Jane (J.)") == ["doe, jane|1900-"]
    assert apply(without_accents, "Éö", None) == ["Eo", None]


def test_text(apply):
    assert apply(strings.squeeze, " a \n b ", None) == ["a b", ""]
    assert apply(strings.without_markdown, "**[Foo](#foo)** <b>x</b> ![i](u) &amp; `y`") == ["Foo x y"]
    assert apply(lambda c: strings.truncated(c, 5), "abcdef", "abc") == ["abcd…", "abc"]
    assert apply(lambda c: strings.has_term(c, "go"), "go lang", "mango", "a-go-b") == [True, False, True]
    assert apply(lambda c: strings.has_term(c, "c++"), "my c++11") == [True]
    assert apply(lambda c: strings.content_words(c, ["this"]), "This is a_word, and this WORD") == [["a_word", "word"]]
    assert apply(strings.number_in_file_name, "x/pg123-0.txt", "77.TXT", "a.md") == [123, 77, None]
    places = {"nyc": "new york"}, {"new york": "united states"}, ["remote"]
    assert [tuple(x) for x in apply(lambda c: strings.place(c, *places), " NYC. ", "Remote", "United States", None)] == [("new york", "united states"), (None, None), ("united states", "united states"), (None, None)]
    assert apply(lambda c: strings.organisation(c, ["none"]), "@Acme, Inc.", "none") == ["acme", None]


def test_scales(apply):
    assert apply(lambda c: numbers.log_scale(c, 20.0), 99, 0, -5, None, kind="int") == [40.0, 0.0, 0.0, 0.0]
    assert apply(numbers.saturating_weight, 0, 300, 3000, kind="int") == [0.0, 1.0, 1.0]
    assert apply(numbers.repeated_confidence, 1, 3, 50, kind="int") == pytest.approx([0.5, 0.6, 0.95])
    assert apply(lambda c: numbers.strict_greatest(c, F.lit(5)), 3, None, kind="int") == [5, None]
    assert apply(lambda c: numbers.half_even(c / 8, 2), 1.0, kind="double") == [0.12]
    day = datetime.date(2024, 1, 1)
    assert apply(lambda c: numbers.half_life_freshness(c, F.lit("2024-01-01").cast("date")), day, None, kind="date")[0] == 100.0
    assert apply(lambda c: numbers.hyperbolic_freshness(c, F.lit("2025-12-31").cast("date")), day, None, kind="date") == [0.5, None]
    assert apply(lambda c: numbers.stepped(c, [(90, 8.0), (365, 5.0)], -4.0, 0.0), 90, 91, 900, None, kind="int") == [8.0, 5.0, -4.0, 0.0]
    assert apply(lambda c: numbers.life_span(c, F.lit(-348)), -428, None, kind="int") == ["428 BCE-348 BCE", "?-348 BCE"]
    assert apply(lambda c: numbers.weighted_total(F.array(c, F.lit(5)), F.array(F.lit(10), F.lit(20))), 2, kind="int") == [24.0]


def test_json(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}', '{"b": null, "c": 2.5}'), ("bad", '{"a": true}'), (None, None)], "o string, n string")
    assert [r[0] for r in df.select(jsonx.merged(F.col("o"), F.col("n"))).collect()] == ['{"a":1,"b":"x","c":2.5}', '{"a":true}', "{}"]
    assert [r[0] for r in df.select(jsonx.has_key(F.col("n"), "b")).collect()] == [False, False, False]


@pytest.mark.parametrize(
    "raw,parts",
    [
        ("Doe, Jane, 1820-1890 [Editor]", ("Doe, Jane", 1820, 1890, "editor", 0)),
        ("Plato, 428? BCE-348? BCE", ("Plato", -428, -348, "author", 0)),
        ("Roe, R., 1900-", ("Roe, R.", 1900, None, "author", 0)),
        ("Roe, R., b. 1870", ("Roe, R.", 1870, None, "author", 0)),
        ("Roe, R., d. 1870", ("Roe, R.", None, 1870, "author", 0)),
        ("United States", ("United States", None, None, "author", 1)),
        ("Various", ("Various", None, None, "author", 1)),
    ],
)
def test_authors(raw, parts):
    assert tuple(author_parts(raw).values()) == parts


def test_author_of_nothing():
    assert author_parts(None) is None and author_parts(" [Editor] ") is None


def test_ratios(spark):
    df = spark.createDataFrame([("abcd", "bcde"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(sequence_ratio("a", "b")).collect()] == [0.75, 1.0]
    df = spark.createDataFrame([("vector search", "search", "search of vector things")], "t string, n string, w string")
    assert df.select(topic_match("t", "n", "w")).first()[0] == pytest.approx(0.5 * 12 / 19 + 0.5)


def test_authors_in_every_form():
    from quillmesh.functions.authors import author_parts

    def years(text):
        a = author_parts(text)
        return a["name"], a["birth"], a["death"], a["role"], a["corporate"]

    assert years("Twain, Mark, 1835-1910") == ("Twain, Mark", 1835, 1910, "author", 0)
    assert years("Plato, 428? BCE-348? BCE") == ("Plato", -428, -348, "author", 0)
    assert years("Plato, 428 B.C-348 B.C") == ("Plato", -428, -348, "author", 0)
    assert years("Homer, ca. 750 B.C. - [Translator]") == ("Homer", -750, None, "translator", 0)
    assert years("Aesop, 620 BCE-564") == ("Aesop", -620, -564, "author", 0)
    assert years("Doe, Jane, b. 1901") == ("Doe, Jane", 1901, None, "author", 0)
    assert years("Doe, Jane, d. 1999? [Editor]") == ("Doe, Jane", None, 1999, "editor", 0)
    assert years("Doe, Jane, ca. 1750-") == ("Doe, Jane", 1750, None, "author", 0)
    assert years("Doe, Jane, 12-15") == ("Doe, Jane, 12-15", None, None, "author", 0)
    assert years("United States") == ("United States", None, None, "author", 1)
    assert years("Various") == ("Various", None, None, "author", 1)
    assert author_parts("  ") is None and author_parts(None) is None and author_parts("[Editor]") is None
