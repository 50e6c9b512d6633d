"""Exact pages and page files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adsettle.operators.pages import sorted_files, top_rows, with_pages
from adsettle.sinks.tables import append_table, replace_table, replace_view, write_pages, write_result
from adsettle.sources.landed import read_landed


@pytest.mark.parametrize("count", [0, 1, 99, 100, 101, 1000])
def test_page_sizes_around_the_cap(spark, count):
    df = spark.range(count).repartition(7)
    for order in ([], [F.desc("id")]):
        paged = with_pages(df, 100, order)
        sizes = {r["page"]: r["count"] for r in paged.groupBy("page").count().collect()}
        full, rest = divmod(count, 100)
        assert sizes == {**{p + 1: 100 for p in range(full)}, **({full + 1: rest} if rest else {})}
        index = sorted(r["row_index"] for r in paged.select("row_index").collect())
        assert index == list(range(count))


def test_index_follows_the_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v"))
    paged = with_pages(df, 300, [F.desc("v")])
    assert paged.filter(F.col("row_index") != 4999 - F.col("v")).count() == 0


def test_ties_spread_over_partitions(spark):
    df = spark.range(0, 200_000, 1, 8).select("id", F.expr("CAST(id % 1 AS DOUBLE) AS v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = with_pages(df, 50_000, ["v"])
        path = sorted_files(df, 50_000, ["v"])
        sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 50_000
    assert index.agg(F.countDistinct("row_index"), F.max("row_index")).first() == (200_000, 199_999)


def test_cap_must_be_positive(spark):
    with pytest.raises(ValueError):
        with_pages(spark.range(1), 0)


def test_page_files(spark, tmp_path):
    df = spark.range(1050).select("id", (F.col("id") % 3).cast("string").alias("客户"))
    path = str(tmp_path / "out")
    assert write_pages(df, path, 100, [F.desc("id")], kind="csv") == 1050
    folders = sorted(p for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert len(folders) == 11
    for folder in folders:
        files = list(folder.glob("*.csv"))
        assert len(files) == 1
        lines = files[0].read_text().splitlines()
        page = int(folder.name.removeprefix("page="))
        assert lines[0] == "id,客户"
        ids = [int(line.split(",")[0]) for line in lines[1:]]
        assert ids == list(range(1049 - 100 * (page - 1), max(949 - 100 * (page - 1), -1), -1))


def test_fewer_tasks_than_pages_write_the_same_pages(spark, tmp_path):
    df = spark.range(1050).repartition(5)
    path = str(tmp_path / "out")
    assert write_pages(df, path, 100, [F.desc("id")], most_tasks=3) == 1050
    pages = spark.read.parquet(path).groupBy("page").agg(F.max("id"), F.count("id")).collect()
    wanted = {(p + 1, 1049 - 100 * p, 100 if p < 10 else 50) for p in range(11)}
    assert {tuple(r) for r in pages} == wanted


def test_results_and_tables(spark, tmp_path):
    df = spark.createDataFrame([("1", "a,b"), ("2", None)], "`账户ID` string, n string")
    for kind in ("csv", "parquet"):
        path = str(tmp_path / kind)
        write_result(df, path, kind)
        back = read_landed(spark, path, kind, lineage=True)
        assert back.columns == ["账户ID", "n", "source_file"]
        assert sorted(r["账户ID"] for r in back.collect()) == ["1", "2"]
    with pytest.raises(ValueError):
        write_result(df, str(tmp_path / "x"), "orc!")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pages_test LOCATION '{tmp_path}/db'")
    replace_table(df, "pages_test.t")
    append_table(df.select(F.col("n").alias("x"), F.col("账户ID").alias("y")), "pages_test.t")
    assert spark.table("pages_test.t").count() == 4
    replace_table(df, "pages_test.t")
    assert spark.table("pages_test.t").count() == 2
    replace_view(df, "pages_view")
    assert spark.sql("SELECT count(*) FROM pages_view").first()[0] == 2
    spark.sql("DROP DATABASE pages_test CASCADE")


def test_top_rows(spark):
    out = top_rows(spark.range(1000), 3, [F.desc("id")])
    assert [r.id for r in out.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()
