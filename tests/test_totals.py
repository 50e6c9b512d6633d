"""Totals, deduplication and counts."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adsettle.operators.totals import (
    active_accounts,
    counted,
    dedup_counts,
    describe_columns,
    first_per_key,
    totals,
    unique_keys,
)


def test_golden_sample(spark):
    """Two sheets, six rows, four keys."""
    one = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "x string, y string")
    two = spark.createDataFrame([("3", "c"), ("4", "d"), ("1", "e")], "x string, y string")
    both = one.union(two)
    out = first_per_key(both)
    assert sorted(map(tuple, out.collect())) == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")]
    assert tuple(dedup_counts(both, ["x"]).first()) == (6, 4)
    assert sorted(map(tuple, first_per_key(out).collect())) == sorted(map(tuple, out.collect()))


def test_unique_keys_orders_null_last(spark):
    df = spark.createDataFrame([(None, "n"), ("b", None), ("a", "x"), ("b", "y")], "k string, v string")
    out = unique_keys(df, [("k", None), ('any_value("v")', "v"), ("COUNT(*)", "n")])
    assert [tuple(r) for r in out.collect()] == [("a", "x", 1), ("b", "y", 2), (None, "n", 1)]


def test_unique_keys_sorts_no_raw_rows(spark):
    """Texts are grouped by first; lists that can't be put together from parts are done in one step, with equal results."""
    rows = [(f"k{i % 3}", f"v{i % 7}", i, None if i % 2 else f"w{i % 5}") for i in range(50)]
    df = spark.createDataFrame(rows, "k string, v string, n long, w string")
    listed = [("k", None), ("any_value(w)", "w"), ("max(\"v\")", None), ("sum(n)", "total"), ("COUNT(*)", "c"), ("count(w)", "cw")]
    out = unique_keys(df, listed)
    assert out.columns == ["k", "w", "max(v)", "total", "c", "cw"]
    of = lambda k: [r for r in rows if r[0] == k]
    assert [tuple(r) for r in out.collect()] == [
        (k, min(r[3] for r in of(k) if r[3]), max(r[1] for r in of(k)), sum(r[2] for r in of(k)), len(of(k)), sum(r[3] is not None for r in of(k)))
        for k in ("k0", "k1", "k2")
    ]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "HashAggregate" in [x for x in lines if "Aggregate(" in x][-1]
    for other in ("count(DISTINCT w)", "avg(n)", "max(n) - min(n)", "sum(n) / count(n)", "concat(min(v), max(v))"):
        both = unique_keys(df, [("k", None), ("min(v)", "v"), (other, "x")])
        one = spark.sql(f"SELECT k, min(v) AS v, {other} AS x FROM {{df}} GROUP BY k ORDER BY 1", df=df)
        assert both.collect() == one.collect()


def test_labels_come_from_different_rows(spark):
    df = spark.createDataFrame(
        [("k", 1.0, None, "b"), ("k", 2.0, "a", None), (None, 5.0, None, None)],
        "id string, m double, x string, y string",
    )
    out = totals(df, ["id"], {"m": F.col("m")}, ["x", "y"]).collect()
    assert {tuple(r) for r in out} == {("k", "a", "b", 3.0), (None, None, None, 5.0)}


def test_sum_of_nothing_but_null_is_null(spark):
    df = spark.createDataFrame([("k", None, "a"), ("k", None, "b")], "id string, m double, x string")
    assert tuple(totals(df, ["id"], {"m": F.col("m")}, ["x"]).first()) == ("k", "a", None)


def test_a_key_with_a_third_of_the_rows(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.concat(F.lit("n"), F.col("id") % 1000).alias("label"),
        F.lit(1.0).alias("m"),
    )
    out = totals(rows, ["k"], {"m": F.col("m")}, ["label"])
    assert tuple(out.filter("k = 'hot'").first()) == ("hot", "n0", 20_000.0)
    assert out.count() == 40_001 and out.agg(F.sum("m")).first()[0] == 60_000.0


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.sampled_from(["x", "y", None]),
            st.one_of(st.none(), st.integers(-5, 5)),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_totals_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, x string, m int")
    got = {r["k"]: (r["x"], r["m"]) for r in totals(df, ["k"], {"m": F.col("m")}, ["x"]).collect()}
    for key in {k for k, _, _ in rows}:
        labels = [x for k, x, _ in rows if k == key and x is not None]
        values = [m for k, _, m in rows if k == key and m is not None]
        assert got[key] == (min(labels, default=None), sum(values) if values else None)
    assert len(got) == len({k for k, _, _ in rows})


def test_active_accounts(spark):
    rows = [("a", 1.0, None), ("a", 2.0, 0.5), ("b", 1.0, 1.0), ("c", 0.5, 1.0), ("d", 0.00002, 0.0)]
    df = spark.createDataFrame(rows, "id string, plus double, minus double")
    assert active_accounts(df, "id", ["plus"], ["minus"]).first()[0] == 2


def test_counts_ride_along(spark):
    df, seen = counted(spark.range(100), "loaded")
    df.filter("id < 10").collect()
    assert seen.get["rows"] == 100


def test_describe(spark):
    df = spark.createDataFrame([("1", 2), ("3", 4)], "`账户ID` string, n long")
    assert [tuple(r) for r in describe_columns(df).orderBy("position").collect()] == [
        (1, "账户ID", "string", 2),
        (2, "n", "bigint", 2),
    ]


def test_order_of_rows_does_not_matter(spark):
    rows = [(str(i % 5), str(i % 3), float(i)) for i in range(60)]
    outs = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, x string, m double").repartition(seed + 1)
        outs.append(sorted(map(tuple, totals(df, ["k"], {"m": F.col("m")}, ["x"]).collect())))
    assert outs[0] == outs[1] == outs[2]
