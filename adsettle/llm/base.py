"""What the operators of this folder share: tables, the query register, joins that withstand hot keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.session import stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: A key holds at least this share of the rows, or it isn't hot. At most 1 / HOT_SHARE keys can be hot, whatever the
#: data, so the table of hot keys may be broadcast.
HOT_SHARE = 1 / 2000
#: A table of groups of at most so many rows and bytes (as JSON) is broadcast whole; both are measured first.
FEW_ROWS, FEW_BYTES = 10_000, 8_000_000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__`` ... that ``df`` has no column for (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bytes_of(column: pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes, undecoded."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


Rows = Callable[[list[bytes | None]], dict[str, pa.Array]]


def with_text_columns(df: DataFrame, text: str, added: str, rows: Rows) -> DataFrame:
    """``df`` and the ``added`` columns (DDL) that ``rows`` makes from a batch's texts. No shuffle; memory is bounded
    by one Arrow batch. The caller sees to it that the names in ``added`` are free in ``df``."""
    names = df.columns
    place = names.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = rows(bytes_of(batch.column(place)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made.values()], names=[*names, *made.keys()]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, {added}")


def side(df: DataFrame, rows: int, name: str | None = None) -> DataFrame:
    """``df``, which has ``rows`` rows at most, as a side of a join: broadcast if they are few by count, else merged. It
    is written under ``name`` for that, or is a written table already.

    Spark's own choice goes by the size of the files below, which says little of rows that are exploded or hold the same
    few values; it would send them to the driver. Written, the side is a plain exchange, so that Spark can split the rows
    of a hot key on the other one.
    """
    if rows <= FEW_ROWS:
        return F.broadcast(df)
    return (stage(df, name) if name else df).hint("merge")


def join_by_frequency(
    rows: DataFrame, groups: DataFrame, key: Column, group_key: str, n: str, total: int, spread: Column
) -> DataFrame:
    """``rows`` left-joined with one row per key of ``groups``, which holds the number of rows of each key in ``n``.

    A small table of groups is broadcast, after its size has been measured. Of a larger one, keys that hold HOT_SHARE of
    the ``total`` rows or more are few by arithmetic and are broadcast, so that their rows
    stay where they are; the others are joined by a shuffle in which no key is hot. There, rows that the broadcast has
    served get a key of their own kind, dealt by ``spread``. A null key meets a null key.
    """
    limit = max(1.0, total * HOT_SHARE)
    values = [c for c in groups.columns if c != group_key]
    size = groups.agg(
        F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*groups.columns)))).alias("bytes")
    ).first()
    if size.n <= FEW_ROWS and (size.bytes or 0) <= FEW_BYTES:
        of = free_name(rows, "_group")
        small = groups.select(F.col(group_key).alias(of), *values)
        return rows.join(F.broadcast(small), key.eqNullSafe(F.col(of)), "left").drop(of)
    hot_key, cold_key, served, found, mine = (
        free_name(rows, x) for x in ("_hot_key", "_cold_key", "_served", "_found", "_mine")
    )
    hot = groups.filter(F.col(n) >= limit).select(
        F.col(group_key).alias(hot_key), F.struct(*values).alias(served)
    )
    cold = groups.filter(F.col(n) < limit).select(
        F.struct(F.lit(None).cast("long").alias("spread"), F.col(group_key).alias("key")).alias(cold_key),
        F.struct(*values).alias(found),
    )
    own = F.struct(
        F.when(F.col(served).isNotNull(), F.xxhash64(spread)).alias("spread"),
        F.when(F.col(served).isNull(), key).alias("key"),
    )
    first = rows.join(F.broadcast(hot), key.eqNullSafe(F.col(hot_key)), "left").drop(hot_key)
    # too many for a broadcast by the measure above, whatever Spark makes of the size of their files
    both = first.withColumn(mine, own).join(cold.hint("merge"), F.col(mine) == F.col(cold_key), "left")
    return both.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        *[F.coalesce(F.col(served)[v], F.col(found)[v]).alias(v) for v in values],
    )
