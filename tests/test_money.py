"""Money text, nets and the tolerance."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from adsettle.functions.money import beyond_tolerance, money, net, rejected, settlement

TEXTS = [
    "1", "1.5", " 1.5 ", "\t1\n", "1e3", "1E-3", "1e+3", ".5", "5.", "+1", "-2.25", "00012",
    "1_000", "1_000.5_5", "1e1_0", "1__000", "_1", "1_", "1_e3", "1d", "1.5F", "1e3d", "5f",
    "inf", "-inf", "+inf", "INF", "infinity", "nan", "NaN", "infd", "nand", "", "  ", "1,234",
    "12元", "１", "+ 1", "-", "--1", "1 2", "true", "1e", "0x10", "1L", ".", "0x1p3", "0X1P-2", "0x1.8p1",
]


def same(a, b) -> bool:
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_lenient_equals_the_sql_cast(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    got = {r.x: r.v for r in df.select("x", money(df, "x", lenient=True).alias("v")).collect()}
    con = duckdb.connect()
    for text in TEXTS:
        want = con.execute("SELECT TRY_CAST(? AS DOUBLE)", [text]).fetchone()[0]
        assert same(got[text], want), text


@pytest.mark.parametrize("text", ["", "1,234", "12元", "1d", "1__0", "0x1p3"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_fails_and_names_the_cell(spark, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("1",), (text,)], "`总花费(元)` string")
        with pytest.raises(Exception, match="not a number"):
            df.select(money(df, "总花费(元)").alias("v")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_strict_keeps_null_and_takes_numbers(spark):
    df = spark.createDataFrame([("7", 7.5), (None, None)], "x string, y double")
    rows = df.select(money(df, "x").alias("x"), money(df, "y").alias("y")).collect()
    assert [tuple(r) for r in rows] == [(7.0, 7.5), (None, None)]


def test_rejected_cells_can_be_counted(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("1d",)], "x string")
    assert df.filter(rejected(df, "x")).count() == 2


def test_net_is_null_with_a_null_operand_but_settlement_is_not(spark):
    df = spark.createDataFrame([("5", None, "1"), ("5", "2", "1")], "a string, b string, c string")
    out = df.select(
        net([money(df, "a")], [money(df, "b"), money(df, "c")]).alias("net"),
        net(settlement(df, ["a", "b"], ["c"])).alias("settled"),
    ).collect()
    assert [tuple(r) for r in out] == [(None, 4.0), (2.0, 6.0)]


def test_long_settlements_come_in_parts(spark):
    names = [f"c{i}" for i in range(14)]
    df = spark.createDataFrame([tuple(str(2**i) for i in range(14))], names)
    parts = settlement(df, names[:3], names[3:])
    assert len(parts) == 3 and df.select(net(parts)).first()[0] == 7 - (2**14 - 8)


def test_tolerance(spark):
    values = [0.0, 0.000005, -0.000005, 0.00001, 0.00002, -0.00002, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    kept = [r.x for r in df.filter(beyond_tolerance(F.col("x"))).collect()]
    assert kept[:2] == [0.00002, -0.00002] and math.isnan(kept[2]) and len(kept) == 3


def test_either_measure_is_enough(spark):
    df = spark.createDataFrame([(0.0, 1.0), (None, 1.0), (0.0, None)], "x double, y double")
    assert df.filter(beyond_tolerance(F.col("x"), F.col("y"))).count() == 2
