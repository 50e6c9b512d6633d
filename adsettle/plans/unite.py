"""Unite the sheets of workbooks and deduplicate by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.functions.money import quoted
from adsettle.operators.projection import Projection, project
from adsettle.operators.totals import first_per_key, unique_keys
from adsettle.session import qualified
from adsettle.sources.workbook import list_sheets, read_sheets, workbooks


def unite_sheets(
    spark: SparkSession,
    path: str,
    union: Projection | None = None,
    unique: Projection | None = None,
    dedupe: bool = True,
) -> DataFrame:
    """Every sheet of the workbook, or of all workbooks a glob names, as one table.

    ``union`` projects the rows; ``unique`` is a key and aggregates to group them by. Without
    ``unique`` the first column is the key and the others keep a value each, in key order.
    """
    files = workbooks(spark, rows="files", path=qualified(spark, path)).load()
    rows = project(read_sheets(list_sheets(files)).drop("path", "sheet"), union)
    if not dedupe:
        return rows
    if unique:
        return unique_keys(rows, unique)
    return first_per_key(rows).orderBy(F.asc_nulls_last(quoted(rows.columns[0])))
