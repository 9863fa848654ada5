import gzip
import io
import json
import os
import tarfile

from pyspark.sql import functions as F

from quillmesh.sources import archives, observations
from quillmesh.streaming import incremental


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_readers_of_sightings(spark, tmp_path):
    combined = write(tmp_path, "c.json", json.dumps({"entries": [{"repo": "github.com/A/B", "name": "B", "stars": "1,200"}, {"homepage": "https://x.org"}]}))
    broad = write(tmp_path, "b.csv", 'html_url,stargazers_count,description\nhttps://github.com/a/c,7,"two\nlines ""q"""\n')
    candidates = write(tmp_path, "r.json", json.dumps({"rows": [{"url": "https://github.com/a/d", "lastCommit": "on 2024-05-01T10:00:00Z by x"}]}))
    log = write(tmp_path, "l.md", "# Log\n### Thing one\nhttps://github.com/a/e\nA fine thing.\n### Thing two\nno link\n")
    catalog = write(tmp_path, "t.md", "| a | b |\n| 1 | https://github.com/a/f https://github.com/a/g | x | y | The text | z |\nhttps://github.com/not/row\n")
    harvest = write(tmp_path, "h.jsonl", '{"html_url": "https://github.com/a/h", "stargazers_count": 5}\nbroken\n{"repo": "https://github.com/a/i"}\n')
    read = {
        "combined": observations.read_combined_json(spark, combined), "broad": observations.read_broad_csv(spark, broad), "candidates": observations.read_candidate_json(spark, candidates),
        "log": observations.read_log_markdown(spark, log), "catalog": observations.read_table_markdown(spark, catalog), "harvest": observations.read_harvest_lines(spark, harvest),
    }
    got = {n: sorted((r["observed_owner_name"], r["stars"], r["description"], r["observed_at"]) for r in observations.recorded(df, n, "x").collect()) for n, df in read.items()}
    assert got == {
        "combined": [("a/b", 1200, "", None)], "broad": [("a/c", 7, 'two lines "q"', None)], "candidates": [("a/d", None, "", "2024-05-01T10:00:00Z")],
        "log": [("a/e", None, "A fine thing.", None)], "catalog": [("a/f", None, "The text", None), ("a/g", None, "The text", None)], "harvest": [("a/h", 5, "", None), ("a/i", None, "", None)],
    }


def test_rounds_count_malformed_lines(spark, tmp_path):
    write(tmp_path, "round-0001.jsonl", '{"a": 1}\noops\n{"a": 2}\n')
    rows, bad = observations.read_rounds(spark, str(tmp_path / "round-*.jsonl"), "a int")
    assert sorted(r["a"] for r in rows.collect()) == [1, 2] and [tuple(r) for r in bad.collect()] == [("round-0001.jsonl", 1)]


def test_readmes_catalog_and_entities(spark, tmp_path):
    write(tmp_path, "Own__name.md", "# x\ny")
    assert [tuple(r) for r in observations.read_readmes(spark, str(tmp_path / "*.md")).collect()] == [("own/name", "# x\ny")]
    books, edges = observations.read_catalog(spark, write(tmp_path, "b.csv", "id,subjects\n1,a; b ;a\n2,\n"), "id", {"subjects": ";"})
    assert books.count() == 2 and sorted(tuple(r) for r in edges["subjects"].collect()) == [("1", "a"), ("1", "b")]
    lines = '{"id": "Q1", "viaf": {"value": "7"}, "teacher": {"qid": "Q2"}}\n{"id": "Q3", "viaf": "8"}\nbad\n'
    got = observations.read_entity_lines(spark, write(tmp_path, "e.jsonl", lines), ["viaf", "teacher"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("Q1", "7", "Q2"), ("Q3", "8", None)]


def test_json_streams(spark, tmp_path):
    path = write(tmp_path, "s.txt", '{"a": 1}\n{\n "a": 2\n}{"a": 3} junk [bad {"a": 4}')
    assert sorted(r["a"] for r in archives.read_json_stream(spark, path, "a int").collect()) == [1, 2, 3, 4]


def test_tar_source_and_ranges(spark, tmp_path):
    with tarfile.open(tmp_path / "x.tar", "w") as archive:
        for name, raw in (("d/pg12.txt", "one two".encode()), ("13-0.txt.gz", gzip.compress("drei ü".encode())), ("note.md", b"no")):
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            archive.addfile(info, io.BytesIO(raw))
    got = archives.read_tars(spark, str(tmp_path / "*.tar"))
    assert sorted((r["doc_id"], r["bytes"], r["text"]) for r in got.collect()) == [(12, 7, "one two"), (13, 7, "drei ü")]
    assert got.filter("doc_id = 13").select(archives.slice_of(F.col("text"), F.lit(5), F.lit(6)).alias("s")).first()["s"] == "ü"
    packed = archives.locations(got.withColumn("g", F.lit("all")), ["g"], doc="doc_id", text="text", most=30)
    assert [(r["doc"], r["asset"], r["offset"]) for r in packed.orderBy("doc").collect()] == [(12, 0, 0), (13, 1, 0)]
    receipt = archives.receipts(spark, str(tmp_path / "x.tar")).first()
    raw = (tmp_path / "x.tar").read_bytes()
    checked = spark.createDataFrame([(raw,)], "raw binary").select(archives.intact(F.col("raw"), F.lit(receipt["bytes"]), F.lit(receipt["sha256"])).alias("ok"))
    assert checked.first()["ok"]


def test_incremental_runs(spark, tmp_path):
    folder, target, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    folder.mkdir()

    def run():
        incremental.run_new_files(spark, str(folder), "k int, v string", target, checkpoint, keys=["k"], order=[F.desc("v")]).awaitTermination()
        return sorted(tuple(r) for r in incremental.current(spark, target).collect())

    write(folder, "a.json", '{"k": 1, "v": "a"}\n{"k": 1, "v": "b"}\n{"k": 2, "v": "c"}\n')
    assert run() == [(1, "b"), (2, "c")]
    assert run() == [(1, "b"), (2, "c")]  # nothing new
    write(folder, "b.json", '{"k": 2, "v": "d"}\n{"k": 3, "v": "e"}\n')
    assert run() == [(1, "b"), (2, "d"), (3, "e")]
    parts = {p.parent.name: p for p in (tmp_path / "table").glob("version-*/_part=*")}
    assert len(parts) == 2 and len(list((tmp_path / "table").glob("version-1/_part=*"))) <= 2  # only what it touched
    (tmp_path / "table" / "version-2").mkdir()  # a batch that isn't finished isn't seen
    assert run() == [(1, "b"), (2, "d"), (3, "e")]
    os.remove(tmp_path / "table" / "_versions" / "1.json")  # before the second batch was finished there was the first
    assert sorted(tuple(r) for r in incremental.current(spark, target).collect()) == [(1, "b"), (2, "c")]


def test_windowed_counts_of_a_stream_and_of_a_table(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    write(folder, "a.json", '{"at": "2024-01-01T00:10:00Z", "kind": "x"}\n{"at": "2024-01-01T00:50:00Z", "kind": "x"}\n{"at": "2024-01-01T01:10:00Z", "kind": "y"}\n')
    expected = [(0, "x", 2), (1, "y", 1)]
    rows = spark.read.schema("at timestamp, kind string").json(str(folder))
    assert sorted((r["start"].hour, r["kind"], r["n"]) for r in incremental.windowed_counts(rows, at="at", kind="kind").collect()) == expected
    stream = spark.readStream.schema("at timestamp, kind string").json(str(folder))
    counted = incremental.windowed_counts(stream, at="at", kind="kind")
    counted.writeStream.format("memory").queryName("windowed").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["start"].hour, r["kind"], r["n"]) for r in spark.table("windowed").collect()) == expected
