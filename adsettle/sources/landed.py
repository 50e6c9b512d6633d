"""Tables already landed as Parquet or CSV."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adsettle.functions.money import quoted
from adsettle.operators.projection import Field, HeaderError, bind, resolve
from adsettle.session import qualified
from adsettle.sources import cells
from adsettle.sources.cells import locate

# Task code travels with the job, so workers need no copy of the package.
for _module in (cells, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)


def read_landed(
    spark: SparkSession, paths: str | Sequence[str], kind: str = "parquet", lineage: bool = False
) -> DataFrame:
    """One or many files or folders of one shape, every column as text.

    CSV is read without inference. Parquet columns of other types are cast, which keeps pruning;
    ``lineage`` adds the file each row came from.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if kind == "csv":
        df = spark.read.option("header", "true").csv(paths)
    elif kind == "parquet":
        df = spark.read.parquet(*paths)
    else:
        raise ValueError(f"landed tables are parquet or csv, not {kind}")
    out = as_text(df)
    return out.withColumn("source_file", F.col("_metadata.file_path")) if lineage else out


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(
        *[
            F.col(quoted(f.name))
            if isinstance(f.dataType, T.StringType)
            else F.col(quoted(f.name)).cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )


def headers_of(path: str, kind: str) -> list[str]:
    """The column names of a file, from its footer or first line."""
    from pyarrow import parquet

    store, name = locate(path)
    with store.open_input_file(name) as file:
        if kind == "parquet":
            return parquet.read_schema(file).names
        return next(csv.reader(io.TextIOWrapper(file, "utf-8-sig", newline="")), [])


def signatures(spark: SparkSession, paths: Sequence[str], kind: str) -> dict[tuple[str, ...], list[str]]:
    """The files by their headers, in the order of their paths; read in tasks, a footer or a line of each file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(0).to_pylist()
            headers = [headers_of(p, kind) for p in files]
            yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(headers, pa.list_(pa.string()))], names=["path", "headers"])

    listed = spark.createDataFrame([(qualified(spark, p),) for p in paths], "path string")
    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    found = listed.repartition(max(1, tasks)).mapInArrow(read, "path string, headers array<string>").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(found, key=lambda r: r["path"]):
        groups.setdefault(tuple(row["headers"]), []).append(row["path"])
    return groups


def bind_landed(
    spark: SparkSession, paths: Sequence[str], mappings: Mapping[str, Sequence[Field]], kind: str = "parquet"
) -> tuple[str, DataFrame, DataFrame]:
    """Bind the files of one source, however many: its mapping, their rows and (path, mapping, status, rows) of each.

    The first file in path order that has rows settles the mapping: the first one whose headers it has. Files that don't
    fit it, or are empty, are left out. Files of the same headers are one scan, so the plan has a branch, and the
    driver's work a step, for each spelling and not for each file.
    """
    groups = signatures(spark, paths, kind)

    def scan(headers: tuple[str, ...], files: list[str]) -> DataFrame:
        if kind == "parquet":
            return spark.read.parquet(*files)
        # names that come twice are told apart as Spark would, by place
        schema = ", ".join(f"{quoted(h if headers.count(h) == 1 else f'{h}{i}')} string" for i, h in enumerate(headers))
        return spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").csv(files)

    path = F.col("_metadata.file_path")
    scans = {h: scan(h, files) for h, files in groups.items() if h}
    counted = [s.select(path.alias("path")) for s in scans.values()]
    none = spark.createDataFrame([], "path string")
    per_file = reduce(DataFrame.union, counted, none).groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    rows = {decoded(r["path"]): r["rows"] for r in per_file.collect()}  # a row for each file

    def fits(headers: Sequence[str], wanted: Sequence[Field]) -> bool:
        try:
            resolve(headers, wanted)
        except HeaderError:
            return False
        return True

    spelled = {p: h for h, files in groups.items() for p in files}
    first = next((p for p in sorted(spelled) if rows.get(p)), None)
    mapping = next((m for m, wanted in mappings.items() if first and fits(spelled[first], wanted)), None)
    if mapping is None:
        raise HeaderError("no file has rows" if first is None else f"{first} fits no mapping; its headers: {', '.join(spelled[first])}")
    fitting = {h: s for h, s in scans.items() if fits(h, mappings[mapping])}
    bound = reduce(DataFrame.union, [as_text(bind(s, mappings[mapping])) for s in fitting.values()])
    outcome = [
        (p, mapping, "loaded" if rows.get(p) and h in fitting else "skipped", rows.get(p, 0) if h in fitting else 0)
        for p, h in sorted(spelled.items())
    ]
    return mapping, bound, spark.createDataFrame(outcome, "path string, mapping string, status string, rows long")


def decoded(uri: str) -> str:
    """A file's path as Spark's metadata gives it, in the form of ``qualified``."""
    from urllib.parse import unquote

    scheme, colon, rest = uri.partition(":")
    return f"{scheme}{colon}/{unquote(rest).lstrip('/')}" if scheme == "file" else f"{scheme}{colon}{unquote(rest)}"
