"""Joins with the account dimension, the spend/recharge merge and tagged unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsettle.functions.money import beyond_tolerance, or_zero, quoted
from adsettle.operators.totals import BAD, or_bad


def enrich(
    df: DataFrame, account: DataFrame | None, key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Add dimension columns, ``{dimension column: output name}``, to rows of an account.

    Left join on the text of both ids; ``account`` must be unique on ``id``. Without a dimension
    the columns are NULL. Called after aggregation, so the left side is at most one row per account
    and label, and the dimension's strings never pass through an aggregate. No broadcast is forced:
    Spark broadcasts the dimension when its size, planned or measured at run time, is small, and
    sort-merges otherwise, where the left side keeps the partitioning of its aggregate.
    """
    if account is None:
        nothing = [f"CAST(NULL AS STRING) AS {quoted(out)}" for out in columns.values()]
        return df.selectExpr("*", *nothing)
    side = account.selectExpr(
        "CAST(id AS STRING) AS _id",
        *[f"{quoted(c)} AS {quoted(out)}" for c, out in columns.items()],
    )
    return df.join(side, F.col(quoted(key)).cast("string") == side["_id"], "left").drop("_id")


def spend_with_recharge(
    spend: DataFrame,
    recharge: DataFrame,
    key: str,
    labels: Sequence[str],
    spend_name: str,
    recharge_name: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Full outer merge of spend and recharge totals.

    Key and labels come from the spend side where it has them; a missing amount is 0; rows without
    any amount beyond the tolerance go. An account that has two recharge rows keeps both, each with
    the whole spend. NULL keys never meet. ``by`` columns are part of the key.
    """
    spent, paid = spend.alias("spent"), recharge.alias("paid")
    side = lambda name, c: F.col(f"{name}.{quoted(c)}")
    meet = reduce(lambda a, b: a & b, [side("spent", c) == side("paid", c) for c in (*by, key)])
    bad = BAD in spend.columns
    merged = spent.join(paid, meet, "full").select(
        *[F.coalesce(side("spent", c), side("paid", c)).alias(c) for c in [*by, key, *labels]],
        or_zero(side("spent", spend_name)).alias(spend_name),
        or_zero(side("paid", recharge_name)).alias(recharge_name),
        *[(F.coalesce(side("spent", c), F.lit(0)) + F.coalesce(side("paid", c), F.lit(0))).alias(c) for c in [BAD] * bad],
    )
    return merged.filter(
        or_bad(merged, beyond_tolerance)(F.col(quoted(spend_name)), F.col(quoted(recharge_name)))
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Positional union: sheets and files of one source."""
    if not parts:
        raise ValueError("nothing to unite")
    return reduce(DataFrame.union, parts)


def tagged_union(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Union by name of several sources, each marked with its name in column ``tag``."""
    tagged = [part.withColumn(tag, F.lit(name)) for name, part in parts.items()]
    if not tagged:
        raise ValueError("nothing to unite")
    return reduce(DataFrame.unionByName, tagged)
