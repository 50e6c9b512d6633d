"""Totals per account, key deduplication and counts."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adsettle.functions.money import TOLERANCE, net, quoted, settlement
from adsettle.operators.projection import Projection, select_list, spark_expression


def totals(
    rows: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    labels: Sequence[str] = (),
) -> DataFrame:
    """Sums per key, with one non-NULL value of each label (the smallest, so that runs agree).

    A text label cannot live in a hash-aggregation buffer: asking for it directly makes Spark sort
    the raw rows. So labels first serve as grouping keys, which hash, and only the far smaller
    result is reduced to one row per key. Both steps combine on the map side, so a key that owns
    a third of the rows sends one row per task.
    """
    inner = rows.groupBy(*map(quoted, [*keys, *labels])).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()]
    )
    if not labels:
        return inner
    return inner.groupBy(*map(quoted, keys)).agg(
        *[F.expr(f"min({c}) AS {c}") for c in map(quoted, labels)],
        *[F.expr(f"sum({c}) AS {c}") for c in map(quoted, sums)],
    )


#: Of a table read by a batch, how many amounts of a row are no numbers. Such a row stays in the totals, which add these
#: counts up, so that the entry it belongs to can be told.
BAD = "_bad"


def carried(raw: DataFrame, by: Sequence[str]) -> list[str]:
    """What a settlement takes along besides the mapped columns: the ``by`` columns, each value of which is settled on its
    own, and the count of bad amounts where there is one."""
    return [*by, *[c for c in raw.columns if c == BAD]]


def bad_amounts(rows: DataFrame) -> dict[str, Column]:
    return {BAD: F.col(BAD)} if BAD in rows.columns else {}


def or_bad(rows: DataFrame, test: Callable[..., Column]) -> Callable[..., Column]:
    """``test``, or that the row has a bad amount."""
    return (lambda *values: test(*values) | (F.col(BAD) > 0)) if BAD in rows.columns else test


def where_computed(
    rows: DataFrame, columns: Mapping[str, Column], test: Callable[..., Column]
) -> DataFrame:
    """Add ``columns`` and keep the rows whose new values pass ``test``.

    Spark would move such a filter below the projection and compute every column twice, once to
    test and once to keep. It moves no filter through a projection that holds a nondeterministic
    column, so one is put there: the partition id, which is never negative.
    """
    computed = rows.withColumns({**columns, "_partition": F.spark_partition_id()})
    kept = computed.filter(test(*[F.col(quoted(c)) for c in columns]) & (F.col("_partition") >= 0))
    return kept.drop("_partition")


def first_per_key(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per key; every other column takes its smallest non-NULL value on its own.

    Without ``keys`` the first column is the key. As in ``totals``, whole rows are reduced by hash
    before text columns are; the test on their count only keeps Spark from dropping that step.
    """
    keys = list(keys or df.columns[:1])
    carried = [c for c in df.columns if c not in keys]
    if not carried:
        return df.distinct()
    different = df.groupBy(*map(quoted, df.columns)).agg(F.expr("count(1) AS _copies"))
    return (
        different.filter("_copies > 0")
        .groupBy(*map(quoted, keys))
        .agg(*[F.expr(f"min({c}) AS {c}") for c in map(quoted, carried)])
        .select(*map(quoted, df.columns))
    )


_CALL = re.compile(r"\s*(\w+)\s*\((.*)\)\s*$", re.DOTALL)
#: How partial results of an aggregate are put together.
_AGAIN = {"any_value": "min", "min": "min", "max": "max", "sum": "sum", "count": "sum"}


def unique_keys(df: DataFrame, projections: Projection) -> DataFrame:
    """Group by every item of the list that is no aggregate, ordered by the first item.

    As in ``totals``, an aggregate of text would sort the raw rows. If every aggregate of the list is one whose partial results
    can be put together, texts are grouping keys first, which hash, and the small result is reduced to the keys.
    """
    if not projections:
        raise ValueError("the projection list is empty")
    items = select_list(projections)
    steps = _two_steps(df, projections)
    if steps:
        inner, outer = steps
        df = df.sparkSession.sql(f"SELECT {', '.join(inner)} FROM {{rows}} GROUP BY ALL", rows=df)
        items = outer
    return df.sparkSession.sql(
        f"SELECT {', '.join(items)} FROM {{rows}} GROUP BY ALL ORDER BY 1 ASC NULLS LAST", rows=df
    )


def _two_steps(df: DataFrame, projections: Projection) -> tuple[list[str], list[str]] | None:
    """The items of both steps; None where one step is enough or two can't do it."""
    inner, outer, texts = [], [], False
    for i, (expression, alias) in enumerate(projections):
        item = spark_expression(expression)
        one = df.selectExpr(item)
        name = quoted(alias.strip() if alias and alias.strip() else one.columns[0])
        if one._jdf.queryExecution().analyzed().nodeName() != "Aggregate":
            inner.append(f"{item} AS _{i}")
            outer.append(f"_{i} AS {name}")
            continue
        call = _CALL.match(expression)
        again = call and _AGAIN.get(call[1].lower())
        inside = call[2].strip() if call else ""
        if not again or inside.upper().startswith("DISTINCT") or _unbalanced(inside):
            return None
        # a text goes along whole; other values are aggregated at once
        text = one.dtypes[0][1] == "string"
        texts |= text
        inner.append(f"{spark_expression(inside) if text else item} AS _{i}")
        outer.append(f"{again}(_{i}) AS {name}")
    return (inner, outer) if texts else None


def _unbalanced(inside: str) -> bool:
    """Whether the brackets that a call was cut at belong to two calls, as in ``min(a) + max(b)``."""
    depth = 0
    for c in inside:
        depth += (c == "(") - (c == ")")
        if depth < 0:
            return True
    return False


def dedup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count before and after deduplication, in one pass."""
    per_key = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` with its row count taken along whatever action runs on it next."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def active_accounts(
    rows: DataFrame, key: str, plus: Sequence[str], minus: Sequence[str] = ()
) -> DataFrame:
    """How many accounts have a row whose net is above the tolerance."""
    value = net(settlement(rows, plus, minus))
    return (
        rows.filter(value > F.lit(TOLERANCE))
        .select(F.col(quoted(key)).alias("account"))
        .distinct()
        .agg(F.count(F.lit(1)).alias("accounts"))
    )


def describe_columns(df: DataFrame) -> DataFrame:
    """Column names, types and the table's row count, one row per column.

    The schema is known to the driver; only the count reads data, without any column.
    """
    items = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
        )
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.inline(F.array(*items)), "row_count")
