"""Projection lists, headers and mappings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adsettle.operators.projection import (
    Field,
    HeaderError,
    bind,
    bind_files,
    bind_first,
    fields,
    parse_projections,
    project,
    resolve,
    spark_expression,
)


def test_projection_list(spark):
    df = spark.createDataFrame([("a", "b.c")], "`账户ID` string, `总花费(元)` string")
    out = project(df, [('"账户ID"', "id"), ('"总花费(元)"', None), ("'x\"y'", " "), ("1", "n")])
    assert out.columns[0] == "id" and out.columns[1] == "总花费(元)" and out.columns[3] == "n"
    assert tuple(out.first())[:2] == ("a", "b.c")
    assert project(df, None).columns == df.columns == project(df, []).columns


def test_json_projections():
    text = '[["`金额` - 1", "less one"], ["min(owner)", null], ["port", "null"], ["1", ""]]'
    assert parse_projections(text) == [
        ("`金额` - 1", "less one"), ("min(owner)", None), ("port", None), ("1", ""),
    ]
    for bad in ('[["x"]]', '["x"]', "[[1, 2, 3]]", "{"):
        with pytest.raises(ValueError):
            parse_projections(bad)


def test_expressions_keep_literals():
    text = """any_value("a b") || 'any_value("x")' || "q""r" """
    assert spark_expression(text).strip() == """min(`a b`) || 'any_value("x")' || `q"r`"""


def test_alternative_headers():
    wanted = fields({"id": ("账号ID", "账户ID"), "money": "消费"})
    assert resolve(["消费", "账户ID"], wanted) == [("id", ["账户ID"]), ("money", ["消费"])]
    # Both there: the first in table order, as the two would become two columns of one name.
    assert resolve(["账户ID", "消费", "账号ID"], wanted)[0] == ("id", ["账户ID"])
    with pytest.raises(HeaderError, match="账号ID / 账户ID"):
        resolve(["消费"], wanted)


def test_coalesced_headers_need_both(spark):
    wanted = [Field("box", ("k框", "服务商简称"), "coalesce")]
    df = spark.createDataFrame([(None, "p"), ("k", "p")], "`服务商简称` string, `k框` string")
    df = df.select(F.col("服务商简称").alias("k框"), F.col("k框").alias("服务商简称"))
    assert [r.box for r in bind(df, wanted).collect()] == ["p", "k"]
    with pytest.raises(HeaderError):
        bind(df.drop("k框"), wanted)


def test_missing_headers_fail_before_any_job(spark):
    with pytest.raises(HeaderError, match="missing headers: b; present: a"):
        bind(spark.createDataFrame([("1",)], "a string"), fields({"x": "a", "y": "b"}))


def test_fallback(spark):
    mappings = {"one": fields({"v": "消费"}), "two": fields({"v": "花费"})}
    first = spark.createDataFrame([("1",)], "`花费` string")
    other = spark.createDataFrame([("2",)], "`消费` string")
    empty = first.filter("false")
    assert bind_first(first, mappings)[0] == "two"
    with pytest.raises(HeaderError):
        bind_first(empty, mappings)
    with pytest.raises(HeaderError):
        bind_first(spark.createDataFrame([("1",)], "x string"), mappings)
    name, rows, outcome = bind_files({"a": first, "b": other, "c": empty, "d": first}, mappings)
    assert name == "two" and [r.v for r in rows.collect()] == ["1", "1"]
    assert [s for _, _, s in outcome] == ["loaded", "skipped", "skipped", "loaded"]
