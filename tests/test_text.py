import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmesh.operators import lists, manifests
from quillmesh.operators.passages import LONGEST, body_of, passages, passages_of


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("ab. \t", min_size=1, max_size=900), st.sampled_from(["\n\n", "\r\n\r\n", "\n \n", "\n"])), max_size=12))
def test_passages_lie_in_order_and_are_bounded(parts):
    text = "".join(a + b for a, b in parts)
    at = -1
    for row in passages_of(text):
        assert at <= row["start"] < row["end"] <= len(text) and row["chars"] <= LONGEST and row["words"] == len(text[row["start"] : row["end"]].split())
        at = row["end"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("ab. \t", max_size=900), st.sampled_from(["\n\n", "\r\n\r\n", "\n \n", "\n", ""])), max_size=8))
def test_passages_cover_all_but_white_space(parts):
    text = "".join(a + b for a, b in parts)
    got = "".join(text[row["start"] : row["end"]] for row in passages_of(text))
    assert "".join(got.split()) == "".join(text.split())


def test_passages_behind_the_last_blank_line():
    assert [(r["start"], r["end"]) for r in passages_of("No blank line at all.")] == [(0, 21)]
    long = "Sentence. " * 40
    assert [(r["start"], r["end"]) for r in passages_of(f"{long}\n\nTail\n")] == [(0, 400), (402, 407)]
    assert [(r["start"], r["end"]) for r in passages_of("Head\n\nTail")] == [(0, 10)]


def test_passages_of_a_book(spark):
    body = "CHAPTER I. One\r\n\r\n" + "A sentence. " * 40 + "\r\n\r\n" + "Short.\r\n\r\n" + "LETTER 2 to him\r\n\r\n" + "B sentence. " * 260 + "\r\n\r\n"
    text = f"licence *** START OF THIS PROJECT GUTENBERG EBOOK X ***\r\n\r\n{body}*** END OF THIS PROJECT GUTENBERG EBOOK X *** licence"
    a, b = body_of(text)
    got = list(passages_of(text))
    assert text[a:b].strip().startswith("CHAPTER I") and len(got) == 3
    assert got[0]["heading"] == "CHAPTER I. One" and got[-1]["heading"] == "LETTER 2 to him"
    df = spark.createDataFrame([(1, text), (2, None), (3, "  ")], "id long, text string")
    assert passages(df, key="id", text="text").count() == len(got)
    assert body_of("*** END OF THE PROJECT GUTENBERG *** x *** START OF THE PROJECT GUTENBERG ***") == (0, len("*** END OF THE PROJECT GUTENBERG *** x *** START OF THE PROJECT GUTENBERG ***"))


README = """# Awesome X
[top](https://github.com/a/top)
## [Tools](#tools) <kbd>2</kbd>
- [One](https://github.com/A/One) - First tool. https://github.com/a/one
### Deep &amp; down
* [Two](https://github.com/b/two.git) — Second
```
https://github.com/c/code
```
## Other
https://github.com/topics/x https://github.com/d/four.
"""


def test_entries_under_headings(spark):
    got = [tuple(e.values()) for e in lists.entries_of(README)]
    assert got == [
        (0, "a/top", None, None, None), (1, "A/One", "Tools 2", "Tools 2", "First tool. https://github.com/a/one"),
        (2, "a/one", "Tools 2", "Tools 2", "First tool. https://github.com/a/one"), (3, "b/two", "Deep down", "Tools 2 > Deep down", "Second"), (4, "d/four", "Other", "Other", None),
    ]
    assert lists.title_of(README) == "Awesome X" and lists.title_of("<h1 align=x>A <b>B</b>\n C</h1>\n# D") == "A B C" and lists.title_of("no title") is None
    assert lists.shown("[![badge](x.svg)](y) ## [Foo](#foo) &amp; <kbd>4</kbd> bar") == "Foo 4 bar"
    assert [lists.repository("o", n) for n in ("x.git.", "x.git", "x.", ".")] == ["o/x", "o/x", "o/x", None] and lists.repository("user-attachments", "assets") is None
    df = spark.createDataFrame([(1, README), (2, "# My stars\n" + README), (3, None)], "id long, text string")
    entries = lists.list_entries(df, key="id", text="text")
    verdicts = lists.list_verdicts(df, entries, key="id", text="text", languages=["Go"], min_links=3)
    assert {r["key"]: r["is_list"] for r in verdicts.collect()} == {1: True, 2: False, 3: False}
    assert df.select(lists.digest(F.col("text"), words=3, size=9)).first()[0] == "# Awesome"


def test_exported_stars_are_found_behind_a_long_preface(spark):
    text = "x " * 3000 + "\n# Awesome Stars\n## Tools\n" + "".join(f"- [r{i}](https://github.com/o/r{i}) - Tool.\n" for i in range(5))
    df = spark.createDataFrame([(1, text), (2, text.replace("Awesome Stars", "Awesome Tools"))], "id long, text string")
    verdicts = lists.list_verdicts(df, lists.list_entries(df, key="id", text="text"), key="id", text="text", languages=["Go"], min_links=3)
    assert {r["key"]: (r["exported"], r["is_list"]) for r in verdicts.collect()} == {1: (True, False), 2: (False, True)}


@pytest.mark.parametrize(
    "path,text,expected",
    [
        ("package.json", json.dumps({"name": "@s/x", "exports": {".": "a", "./async": "b", "import": "c"}, "bin": "./x.js", "peerDependencies": {"react": "*"}, "engines": {"node": ">=18"}}), {"exports": [".", "./async"], "bin": ["x"], "peer": ["react"], "engine": ">=18", "install": "npm install @s/x"}),
        ("package.json", json.dumps({"name": "m", "workspaces": ["a"]}), {"monorepo": True, "install": "pnpm install"}),
        ("pyproject.toml", '[project]\nname="My-Pkg"\ndependencies=["requests[socks]>=2; python_version>\'3\'", "x"]\nrequires-python=">=3.9"\n[project.scripts]\ncli="a:b"\n[project.entry-points."g"]\nn="a:c"', {"runtime": ["requests", "x"], "bin": ["cli"], "entry_points": ["g/n"], "public_names": ["my_pkg"], "requires_python": ">=3.9"}),
        ("pyproject.toml", '[tool.poetry]\nname="p"\n[tool.poetry.dependencies]\npython="^3.8"\nfoo="1"', {"pkg_name": "p", "runtime": ["foo"], "requires_python": "^3.8"}),
        ("setup.py", "setup(name='s', install_requires=['a>=1', 'b'], python_requires='>=3')\n__all__ = ['f', 'g']", {"pkg_name": "s", "runtime": ["a", "b"], "public_names": ["f", "g"], "requires_python": ">=3"}),
        ("setup.cfg", "[metadata]\nname = c\n[options]\ninstall_requires =\n  a\n  b>1\npython_requires = >=3.7", {"pkg_name": "c", "runtime": ["a", "b"], "requires_python": ">=3.7"}),
        ("go.mod", "module ex.org/m\ngo 1.21\nrequire (\n\ta.b/c v1.0.0\n\td.e/f v2.0.0 // indirect\n)\nrequire g.h/i v0.1.0\nreplace x => y v1.0.0\n", {"pkg_name": "ex.org/m", "runtime": ["a.b/c", "d.e/f", "g.h/i"], "engine": "1.21"}),
        ("Cargo.toml", '[package]\nname="my-c"\nedition="2021"\n[[bin]]\nname="b"\n[dependencies]\nserde="1"', {"bin": ["b"], "public_names": ["my_c"], "runtime": ["serde"], "engine": "2021", "monorepo": False}),
        ("Cargo.toml", '[workspace]\nmembers=["a"]', {"monorepo": True, "pkg_name": ""}),
        ("package.json", "{broken", {"surface_kind": "none", "errors": ["package.json: JSONDecodeError"]}),
        ("x.txt", "y", {"surface_kind": "none", "errors": ["no reader"]}),
    ],
)
def test_manifests(path, text, expected):
    got = manifests.manifest(path, None, text)
    assert {k: got[k] for k in expected} == expected and set(got) == set(manifests.EMPTY)


def test_manifests_in_a_table(spark):
    df = spark.createDataFrame([("a/go.mod", None, "module m\n"), (None, "Rust", '[package]\nname="r"'), (None, None, None)], "p string, l string, t string")
    got = [r["m"]["surface_kind"] for r in df.select(manifests.parsed_manifest("p", "l", "t").alias("m")).collect()]
    assert got == ["go", "rust", "none"]
