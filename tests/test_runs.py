"""Tables of runs and landed files of several spellings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adsettle.operators.projection import HeaderError, fields
from adsettle.sinks.runs import _Table, append_run, read_runs, replace_runs, run_counts
from adsettle.sources.landed import bind_landed, signatures
from tests.test_source import jobs


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("1", 2.0)], "`账户ID` string, v double")
    b = spark.createDataFrame([("2", 3)], "x string, y int")
    assert append_run(a, path, "a") and append_run(b, path, "b")
    assert not append_run(b, path, "b")
    both = read_runs(spark, path)
    before = jobs(spark)
    assert run_counts(spark, path) == {"a": 1, "b": 1} and jobs(spark) == before
    assert both.columns == ["账户ID", "v", "run"] and rows(both) == [("1", 2.0, "a"), ("2", 3.0, "b")]
    with pytest.raises(ValueError, match="2 columns"):
        append_run(a.select("v"), path, "c")
    replace_runs(b, path, "d")
    assert rows(read_runs(spark, path)) == [("2", 3, "d")]
    assert len(list((tmp_path / "t").glob("run-*"))) == 1 and len(list((tmp_path / "t").glob("_runs-*"))) == 1
    assert append_run(b, path, "a")  # a name is free again once its run is gone
    with pytest.raises(FileNotFoundError):
        read_runs(spark, str(tmp_path / "none"))


def test_a_failed_run_isnt_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.range(3)
    append_run(good, path, "a")
    with pytest.raises(Exception, match="broken"):
        append_run(spark.range(9).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path, "b")
    assert read_runs(spark, path).count() == 3 and append_run(good, path, "b")


def test_two_writers(spark, tmp_path, monkeypatch):
    """The later of two writers sees the other's list and adds to it; the same run twice counts once."""
    path = str(tmp_path / "t")
    append_run(spark.range(1), path, "a")
    write, others = _Table.write, iter(["b", "c", None])

    def meanwhile(self, df, run):
        other = next(others, None)
        if other:
            append_run(spark.range(2), path, other)
        return write(self, df, run)

    monkeypatch.setattr(_Table, "write", meanwhile)
    assert append_run(spark.range(4), path, "d")  # b, and within it c, come first
    assert sorted(r.run for r in read_runs(spark, path).select("run").distinct().collect()) == ["a", "b", "c", "d"]
    others = iter(["e"])
    assert not append_run(spark.range(8), path, "e")
    assert read_runs(spark, path).filter("run = 'e'").count() == 2


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_spellings(spark, tmp_path, kind):
    def land(name, schema, data):
        writer = spark.createDataFrame(data, schema).coalesce(1).write
        folder = str(tmp_path / name)
        writer.option("header", "true").csv(folder) if kind == "csv" else writer.parquet(folder)
        return str(next((tmp_path / name).glob(f"part-*.{kind}")))

    files = [
        land("a", "`消费` string, id string", []),
        land("b", "`花费` string, `a,b` string, id string", [("1", "x", "b")]),
        land("c b", "id string, `花费` string", [("c", "2"), ("c", "3")]),
        land("d", "`消费` string, id string", [("4", "d")]),
        land("e", "id string, `花费` string", []),
    ]
    if kind == "csv":
        (tmp_path / "f").mkdir()
        (tmp_path / "f" / "empty.csv").write_text("")
        files.append(str(tmp_path / "f" / "empty.csv"))
    mappings = {"one": fields({"v": "消费", "id": "id"}), "two": fields({"v": "花费", "id": "id"})}
    assert len(signatures(spark, files, kind)) == (4 if kind == "csv" else 3)
    mapping, bound, outcome = bind_landed(spark, files, mappings, kind)
    assert mapping == "two" and rows(bound) == [("1", "b"), ("2", "c"), ("3", "c")]
    got = [(r.status, r["rows"]) for r in outcome.orderBy("path").collect()]
    want = [("skipped", 0), ("loaded", 1), ("loaded", 2), ("skipped", 0), ("skipped", 0), ("skipped", 0)]
    # a CSV file without rows still has headers in Spark's own files only if it has a row
    assert got == want[: len(files)]
    with pytest.raises(HeaderError, match="fits no mapping"):
        bind_landed(spark, files, {"one": mappings["one"]}, kind)
    with pytest.raises(HeaderError, match="no file has rows"):
        bind_landed(spark, files[:1], mappings, kind)


def test_jobs_dont_follow_the_number_of_files(spark, tmp_path):
    took = {}
    for n in (3, 40):
        for i in range(n):
            folder = tmp_path / f"{n}" / f"f{i}"
            folder.mkdir(parents=True)
            (folder / "x.csv").write_text("id,v\n1,2\n" if i % 2 else "v,id\n2,1\n")
        files = [str(tmp_path / f"{n}" / f"f{i}" / "x.csv") for i in range(n)]
        before = jobs(spark)
        _, bound, _ = bind_landed(spark, files, {"m": fields({"v": "v", "id": "id"})}, "csv")
        took[n] = jobs(spark) - before
        assert rows(bound) == [("2", "1")] * n
    assert took[3] == took[40] <= 4
