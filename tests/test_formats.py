"""Data sources: partitions by bytes, pushed filters, canonical files."""

import io
import random

import pytest
from pyspark.sql import functions as F

from lodestone.sources import formats, readers, sinks

X = "http://x/"
COLUMNS = "s string, p string, o string, o_kind string, o_type string, o_lang string"


def frame(spark, n=200):
    rows = [(f"{X}s{k}", X + "pq"[k % 2], f'line "{k}"\n\\ é', "literal", "http://www.w3.org/2001/XMLSchema#string", "") for k in range(n)]
    rows += [(f"{X}s{k}", X + "r", f"_:b{k % 7}", "iri", "", "") for k in range(n)] + [(f"_:b{k}", X + "p", f"{X}s{k}", "iri", "", "") for k in range(7)]
    return spark.createDataFrame(rows, COLUMNS)


def shape(df):
    """Triples, blank nodes by their labels' ends."""
    end = lambda c: F.regexp_replace(c, r"^_:.*?n?(b\d+)$", "_:$1")
    return sorted(map(tuple, df.select(end("s"), "p", F.when(F.col("o_kind") == "iri", end("o")).otherwise(F.col("o")), "o_kind", "o_type", "o_lang").collect()))


@pytest.mark.parametrize("seed", range(20))
def test_every_line_once(seed):
    rng = random.Random(seed)
    lines = [b"x" * rng.choice([0, 1, 3, 40]) for _ in range(rng.randrange(1, 30))]
    data = b"\n".join(lines) + (b"\n" if seed % 2 else b"")
    step, block = rng.randrange(1, 50), rng.randrange(1, 30)
    got = [line for a in range(0, len(data), step) for some in formats.line_blocks(io.BytesIO(data), a, min(len(data), a + step), block) for line in some]
    assert got == [x for x in data.split(b"\n")][: len(got)] and b"".join(got) == data.replace(b"\n", b"")


def test_partitions_by_bytes():
    files = [("a.ttl", 500), ("b.ttl", 10), ("c.nt", 250), ("d.ttl", 10), ("e.ttl", 10)]
    plan = formats.planned(files, 100)
    assert [p.files for p in plan] == [[("a.ttl", 0, 500, True)], [("b.ttl", 0, 10, True)], [("c.nt", 0, 100, False)], [("c.nt", 100, 200, False)], [("c.nt", 200, 250, False), ("d.ttl", 0, 10, True), ("e.ttl", 0, 10, True)]]
    assert formats.planned([], 100) == []


def test_lines_and_turtle_with_pushed_filters(spark, tmp_path, capsys):
    df = frame(spark)
    sinks.ntriples(df).write.text(str(tmp_path / "nt"))
    formats.write_turtle(df, str(tmp_path / "ttl"), {"x": X}, files=5)
    for at in ("nt", "ttl"):
        got = formats.read(spark, str(tmp_path / at), partition_bytes="900", graph="g")
        assert shape(got) == shape(df)
        one = got.where(F.col("p").isin(X + "p", X + "z") & (F.col("graph") == "g"))
        assert shape(one) == shape(df.where(F.col("p") == X + "p"))
        one.explain("formatted")
        assert "PushedFilters: [In(p, [http://x/p,http://x/z]), EqualTo(graph,g)]" in capsys.readouterr().out
    assert shape(readers.read_turtle(spark, str(tmp_path / "ttl"))) == shape(df)


def test_same_bytes_however_partitioned(spark, tmp_path):
    df = frame(spark)
    again = tmp_path / "b"
    formats.write_turtle(df, str(tmp_path / "a"), {"x": X}, files=5)
    formats.write_turtle(df.limit(3), str(again), {"x": X}, files=9)
    formats.write_turtle(df.union(df).repartition(7, F.rand(3)), str(again), {"x": X}, files=5)
    files = lambda d: {p.name: p.read_bytes() for p in d.iterdir() if not p.name.startswith(".")}
    assert files(tmp_path / "a") == files(again) and len(files(again)) == 5


def test_yaml(spark, tmp_path):
    (tmp_path / "a.yaml").write_text('---\nn: 1\nt: "x: y"\nl:\n  - a\n  - b\nm: {k: 2.5}\n---\nn: text\n')
    (tmp_path / "b.yaml").write_text("- 1\n")
    (tmp_path / "_c.yaml").write_text("n: 9\n")
    rows = formats.read_yaml(spark, str(tmp_path), "n int, t string, l array<string>, m map<string,double>").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, "x: y", ["a", "b"], {"k": 2.5}), (None, None, None, None), (None, None, None, None)], key=str)


def test_missing_and_empty(spark, tmp_path):
    assert formats.read(spark, str(tmp_path)).count() == 0
    formats.write_turtle(frame(spark).limit(0), str(tmp_path / "none"), {"x": X})
    assert formats.read(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        formats.read(spark, str(tmp_path / "nowhere")).count()


def test_the_shared_folder_needs_no_scheme_on_a_cluster(spark, monkeypatch):
    """Without one a path is refused there, unless it lies in spark.checkpoint.dir or the warehouse."""
    from lodestone.llm import media
    from lodestone.plans.shared import folder

    path = folder(spark, "turtle")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    for qualified in (formats.qualified, media.qualified):
        assert qualified(spark, path) == f"file:{path}"
        with pytest.raises(ValueError, match="local to each machine"):
            qualified(spark, "/nowhere/else")


def test_turtle_is_parsed_a_statement_at_a_time():
    from lodestone.sources import turtle

    rows = turtle.stream("@prefix x: <http://x/> . x:a x:p 1 , [ x:q 2 ] . x:b x:p ( 3 ) . x:c x:p nonsense")
    assert [next(rows)[0] for _ in range(3)] == ["http://x/a", "_:g1", "http://x/a"]
    with pytest.raises(ValueError):
        list(rows)
