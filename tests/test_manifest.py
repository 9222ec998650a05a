"""Outputs that are written only where they changed."""

from pathlib import Path

import pytest

from lodestone.sources import manifest


def frame(spark, **lines):
    return spark.createDataFrame([(r.replace("_", "/"), v) for r, vs in lines.items() for v in vs], "resource string, value string")


def stamps(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.txt")}


def states(df):
    return {r.resource: r.state for r in df.collect()}


def test_sync(spark, tmp_path):
    path = str(tmp_path / "out")
    assert states(manifest.sync(frame(spark, a_b=["1", "2", None], c=["3"], d=["", "x y"]), path)) == {"a/b": "new", "c": "new", "d": "new"}
    first = stamps(path)
    assert len(first) == 3
    # the same set in another order, with repetitions: nothing is written, not even a manifest
    assert set(states(manifest.sync(frame(spark, d=["x y", ""], c=["3", "3"], a_b=["2", "1"]), path)).values()) == {"same"}
    assert stamps(path) == first and manifest.last(spark, path)[0] == 1
    # one changes, one goes, one comes: the third file isn't touched
    assert states(manifest.sync(frame(spark, a_b=["1", "2"], c=["4"], e=["5"]), path)) == {"a/b": "same", "c": "changed", "d": "gone", "e": "new"}
    second = stamps(path)
    assert len(second) == 3 and [p for p in second if first.get(p) == second[p]] == [p for p in first if "a%2Fb" in str(p)]
    assert sorted(map(tuple, manifest.lines(spark, path).collect())) == [("a/b", "1"), ("a/b", "2"), ("c", "4"), ("e", "5")]
    assert [r.value for r in manifest.lines(spark, path, ["c"]).collect()] == ["4"]
    for i in range(3):
        manifest.sync(frame(spark, c=[str(i)]), path)
    assert manifest.last(spark, path)[0] == 5 and len(list((tmp_path / "out" / "manifest").glob("version=*"))) == 2
    assert states(manifest.sync(frame(spark, c=["9"]).limit(0), path)) == {"c": "gone"}
    assert not stamps(path)


def test_a_run_cut_short(spark, tmp_path):
    """Data without its manifest is written again."""
    path = str(tmp_path / "out")
    manifest.sync(frame(spark, a=["1"]), path)
    manifest.sync(frame(spark, a=["2"], b=["1"]), path)
    import shutil

    shutil.rmtree(tmp_path / "out" / "manifest" / "version=2")
    assert states(manifest.sync(frame(spark, a=["2"], b=["1"]), path)) == {"a": "changed", "b": "new"}
    assert sorted(map(tuple, manifest.lines(spark, path).collect())) == [("a", "2"), ("b", "1")]


def test_a_line_without_resource(spark, tmp_path):
    with pytest.raises(Exception, match="without resource"):
        manifest.sync(spark.createDataFrame([(None, "x")], "resource string, value string"), str(tmp_path / "out"))
