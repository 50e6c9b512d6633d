"""Exact pages and top rows."""

from __future__ import annotations

import json
import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StructField, StructType

from adsettle.functions.money import quoted
from adsettle.session import stage, staging_path
from adsettle.sources import cells
from adsettle.sources.cells import locate

# Task code travels with the job, so workers need no copy of the package.
for _module in (cells, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

# Rows per output file, plain and small-page results.
PAGE_ROWS = 1_000_000
SMALL_PAGE_ROWS = 50_000

# More tasks than this cost more than they gain; a task then takes several pages in a row.
MOST_TASKS = 10_000

# Rows of a staged file that a task reads at once, at most.
GROUP_ROWS = 20_000

# Rows that a task takes of short pages, where that leaves no core idle: to start one costs more than to write a short page.
TASK_ROWS = 20_000

ADDED = ("row_index", "page", "pages")

#: A page that is told: the values of its group and its slices [file, first row, rows], both as JSON.
LISTED = "`group` string, page long, pages long, slices string"


class PageSlices(DataSource):
    """Pages as slices of sorted files: a page is read whole by one task, in order, whatever files it lies in.

    Options: ``spans`` JSON of [group, file, first row, rows] in the order of the index, ``cap`` rows of a
    page, ``most`` tasks, ``least`` tasks. With ``told`` a row is a page, as LISTED says, and no file is read.
    """

    @classmethod
    def name(cls) -> str:
        return "adsettle_pages"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PageReader(dict(self.options), schema)


class Part(InputPartition):
    """Pages of one task: [(page, pages of its group, index of its first row, [(file, first row, rows)])]."""


def cut(spans: Sequence[tuple], cap: int) -> Iterator[tuple[int, int, int, list[tuple[str, int, int]], str]]:
    """The pages of all groups of spans, one after the other."""
    for group, own in groupby(spans, key=lambda s: s[0]):
        own = list(own)
        pages = -(-sum(s[3] for s in own) // cap)
        page, room, slices = 1, cap, []
        for _, file, first, rows in own:
            while rows:
                taken = min(rows, room)
                slices.append((file, first, taken))
                first, rows, room = first + taken, rows - taken, room - taken
                if not room:
                    yield page, pages, (page - 1) * cap, slices, group
                    page, room, slices = page + 1, cap, []
        if slices:
            yield page, pages, (page - 1) * cap, slices, group


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.options, self.schema = options, to_arrow_schema(schema)
        self.columns = [c for c in schema.fieldNames() if c not in ADDED]

    def partitions(self) -> list[InputPartition]:
        cap = int(self.options["cap"])
        spans = [tuple(s) for s in json.loads(self.options["spans"])]
        rows = sum(s[3] for s in spans)
        room = max(1, rows // int(self.options["most"]), min(max(cap, TASK_ROWS), rows // int(self.options["least"])))
        parts: list[Part] = []
        held, taken = [], 0
        for page in cut(spans, cap):
            held.append(page)
            taken += sum(s[2] for s in page[3])
            if taken >= room:
                parts.append(Part(held))
                held, taken = [], 0
        return [*parts, *([Part(held)] if held else [])] or [Part([])]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        files: dict[str, object] = {}
        for page, pages, index, slices, group in part.value:
            if "told" in self.options:
                told = {"group": [group], "page": [page], "pages": [pages], "slices": [json.dumps(slices)]}
                yield pa.RecordBatch.from_arrays([pa.array(told[f.name], f.type) for f in self.schema], schema=self.schema)
                continue
            for file, first, rows in slices:
                for batch in slice_of(files, self.columns, file, first, rows):
                    n = len(batch)
                    made = {
                        "row_index": pa.array(np.arange(index, index + n)),
                        "page": pa.array(np.full(n, page)),
                        "pages": pa.array(np.full(n, pages)),
                    }
                    index += n
                    data = [
                        made[f.name] if f.name in made else batch.column(f.name).cast(f.type) for f in self.schema
                    ]
                    yield pa.RecordBatch.from_arrays(data, schema=self.schema)


def slice_of(files: dict, columns: list[str], file: str, first: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Rows of a file; of its row groups only those that hold some. ``files`` keeps the one that is open."""
    from pyarrow import parquet

    if file not in files:
        files.clear()  # pages go through the files in order
        store, name = locate(file)
        source = parquet.ParquetFile(store.open_input_file(name))
        groups = range(source.num_row_groups)
        files[file] = source, [*accumulate((source.metadata.row_group(g).num_rows for g in groups), initial=0)]
    source, starts = files[file]
    for group in range(bisect_right(starts, first) - 1, bisect_left(starts, first + rows)):
        start, end = starts[group], starts[group + 1]
        a, b = max(first, start), min(first + rows, end)
        if a < b:
            table = source.read_row_group(group, columns=columns).slice(a - start, b - a)
            yield from table.combine_chunks().to_batches(max_chunksize=10_000)


def sorted_files(df: DataFrame, cap: int, order: Sequence[Column | str] = (), by: Sequence[str] = ()) -> str:
    """``df`` written so that the files, in the order of their numbers, hold each group's rows in order.

    With ``order`` that is a range sort, the only exchange, over rows that are staged with a number each: rows
    that tie are put in order of that number, so that neither one value nor equal rows fill a partition, and
    a repeated task finds every number as it was. Only an order by something that ``df`` doesn't show can't be told
    of staged rows; its ties are numbered where they lie. Without ``order`` nothing is exchanged.
    """
    keys = [F.col(quoted(c)) for c in by]
    if order:
        numbered = df.withColumn("_tie", F.monotonically_increasing_id())
        if shows(df, order):
            numbered = stage(numbered, "numbered")
        df = numbered.orderBy(*keys, *order, F.hash("_tie"), "_tie").drop("_tie")
    elif by:
        df = df.sortWithinPartitions(*keys)
    path = staging_path(df.sparkSession, "pages")
    # a page is read from the row groups it lies in, one after the other: these are no longer than a page, and no larger
    # than a task may hold of however long a page
    df.write.option("parquet.block.row.count.limit", min(max(cap, 1_000), GROUP_ROWS)).parquet(path)
    return path


def shows(df: DataFrame, order: Sequence[Column | str]) -> bool:
    """Whether the columns of ``df`` are enough to sort it."""
    try:
        df.sparkSession.createDataFrame([], df.schema).orderBy(*order)
    except AnalysisException:
        return False
    return True


def spans_of(
    df: DataFrame, path: str, by: Sequence[str] = (), sums: Sequence[str] = ()
) -> list[dict]:
    """Where each group's rows lie, by group and file: file, first, rows, the ``by`` values and ``sums``.

    One row per group and file, counted from the narrow columns."""
    keys = [F.col(quoted(c)) for c in by]
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    found = (
        rows.select(
            F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"), *keys,
            *[F.col(quoted(c)) for c in sums],
        )
        .groupBy("_file", *keys)
        .agg(
            F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"),
            *[F.sum(quoted(c)).alias(c) for c in sums],
        )
        .collect()
    )

    def number(file: str) -> tuple[int, str]:
        name = file.rpartition("/")[2]
        return int(name.split("-")[1]), name

    spans = [r.asDict() for r in found]
    groups = lambda s: json.dumps([s[c] for c in by], ensure_ascii=False, default=str)
    return sorted(spans, key=lambda s: (groups(s), number(s["_file"]), s["_first"]))


def paged(df: DataFrame, path: str, spans: Sequence[dict], cap: int, by: Sequence[str] = (), most: int = MOST_TASKS) -> DataFrame:
    """The sorted files of ``df`` as pages: every column, ``row_index`` from 0 and ``page`` from 1 within the group, and
    ``pages``, how many the group has. No exchange: each page is read by one task."""
    schema = StructType([*df.schema.fields, *[StructField(name, LongType()) for name in ADDED]])
    return _slices(df.sparkSession, spans, cap, by, most).schema(schema).load()


def told_pages(df: DataFrame, spans: Sequence[dict], cap: int, by: Sequence[str] = ()) -> DataFrame:
    """The pages of ``paged`` themselves, dealt over as many tasks, for a task that reads their rows by ``slice_of``."""
    return _slices(df.sparkSession, spans, cap, by, MOST_TASKS).option("told", True).schema(LISTED).load()


def _slices(spark: SparkSession, spans: Sequence[dict], cap: int, by: Sequence[str], most: int) -> DataFrameReader:
    spark.dataSource.register(PageSlices)
    listed = [
        [json.dumps([s[c] for c in by], ensure_ascii=False, default=str), s["_file"], s["_first"], s["_rows"]]
        for s in spans
    ]
    return spark.read.format("adsettle_pages").options(
        spans=json.dumps(listed, ensure_ascii=False), cap=cap, most=most, least=4 * spark.sparkContext.defaultParallelism
    )


def with_pages(df: DataFrame, cap: int, order: Sequence[Column | str] = ()) -> DataFrame:
    """Add ``row_index`` (from 0) and ``page`` (from 1), ``cap`` rows to a page.

    Rows are put in order and counted as by ``counted_pages``. A page needn't lie in one task here, so its number is
    computed from a row's place in its file and the rows of the files before; columns that aren't asked for aren't read.
    """
    if cap < 1:
        raise ValueError("a page holds at least one row")
    path = sorted_files(df, PAGE_ROWS, order)
    spans = spans_of(df, path)
    # one short row per written file, of which a task writes one
    before = pa.table(
        {
            "_file": pa.array([s["_file"].rpartition("/")[2] for s in spans], pa.string()),
            "_before": pa.array(accumulate([0, *(s["_rows"] for s in spans)][: len(spans)]), pa.int64()),
        }
    )
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    index = F.col("_before") + F.col("_at")
    return (
        rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
        .join(F.broadcast(df.sparkSession.createDataFrame(before)), "_file")
        .select(*[F.col(quoted(c)) for c in df.columns], index.alias("row_index"), (F.floor(index / cap) + 1).alias("page"))
    )


def counted_pages(
    df: DataFrame, cap: int, order: Sequence[Column | str] = (), most_tasks: int = MOST_TASKS
) -> tuple[DataFrame, int, int]:
    """As ``with_pages``, each page whole in one partition and in row order; and how many rows and pages there are.

    With ``order`` the index follows the global order: a range sort, never a one-partition window. Rows are written
    in that order once, their files are counted, and a page is a slice of these files.
    """
    if cap < 1:
        raise ValueError("a page holds at least one row")
    path = sorted_files(df, cap, order)
    spans = spans_of(df, path)
    rows = sum(s["_rows"] for s in spans)
    return paged(df, path, spans, cap, most=most_tasks).drop("pages"), rows, -(-rows // cap)


def top_rows(df: DataFrame, count: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``count`` rows in order; each task keeps that many, no global sort."""
    return df.orderBy(*order).limit(count)
