"""How a query and its SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# The driver's tables. With a declared schema no file is opened to plan a query.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double,"
    " props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def as_export(df: DataFrame, headers: dict[str, str], typed: bool = False) -> DataFrame:
    """A platform export: ``{header: SQL expression}``, every column as text.

    ``typed`` leaves amounts that are numbers as they are, as a landed table may hold them.
    """
    if not typed:
        return df.selectExpr(*[f"CAST({e} AS STRING) AS `{h}`" for h, e in headers.items()])
    shaped = df.selectExpr(*[f"{e} AS `{h}`" for h, e in headers.items()])
    return shaped.selectExpr(
        *[f"`{h}`" if t == "double" else f"CAST(`{h}` AS STRING) AS `{h}`" for h, t in shaped.dtypes]
    )


def cents(df: DataFrame, *names: str) -> DataFrame:
    """Money rounded to two places, without negative zero, so that sums compare exactly."""
    return df.withColumns({n: F.expr(f"round(`{n}`, 2) + 0.0D") for n in names})
