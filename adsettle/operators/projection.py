"""Projection lists and late-bound headers."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from adsettle.functions.money import quoted

Projection = Sequence[tuple[str, str | None]]


class HeaderError(ValueError):
    """A mapping asks for headers that a table does not have."""


@dataclass(frozen=True)
class Field:
    """One output column and the header or headers it is read from.

    ``rule`` says what several headers mean: ``either`` (the table has one of them; of two, the
    first in table order counts) or ``coalesce`` (all must be there; first non-NULL value).
    """

    name: str
    headers: tuple[str, ...]
    rule: str = "either"


def fields(mapping: Mapping[str, str | tuple[str, ...] | Field]) -> list[Field]:
    """``{output name: header or alternative headers}`` as a list of fields."""
    out = []
    for name, source in mapping.items():
        if isinstance(source, Field):
            out.append(source)
        else:
            headers = (source,) if isinstance(source, str) else tuple(source)
            out.append(Field(name, headers))
    return out


def resolve(headers: Sequence[str], wanted: Iterable[Field]) -> list[tuple[str, list[str]]]:
    """The headers each field reads in a table that has ``headers``; raises on missing ones."""
    found, missing = [], []
    for field in wanted:
        if field.rule == "coalesce":
            hit = [h for h in field.headers if h in headers]
            complete = len(hit) == len(field.headers)
        else:
            hit = [h for h in headers if h in field.headers][:1]
            complete = bool(hit)
        if complete:
            found.append((field.name, hit))
        else:
            missing.append(" / ".join(field.headers))
    if missing:
        raise HeaderError(f"missing headers: {', '.join(missing)}; present: {', '.join(headers)}")
    return found


def bind(df: DataFrame, wanted: Iterable[Field], keep: Sequence[str] = ()) -> DataFrame:
    """Project a table onto a mapping; ``keep`` names columns that stay as they are. Header errors surface here, before
    any job runs."""
    items = [quoted(c) for c in keep]
    for name, hit in resolve(df.columns, wanted):
        cells = ", ".join(map(quoted, hit))
        items.append(f"{cells if len(hit) == 1 else f'coalesce({cells})'} AS {quoted(name)}")
    return df.selectExpr(*items)


def bind_first(
    df: DataFrame, mappings: Mapping[str, list[Field]], need_rows: bool = True
) -> tuple[str, DataFrame]:
    """Bind the first mapping whose headers are all present, for a table that has rows.

    Raises when none fits. Whether there are rows does not depend on the mapping, so it is asked
    once.
    """
    errors = []
    for name, wanted in mappings.items():
        try:
            bound = bind(df, wanted)
        except HeaderError as error:
            errors.append(f"{name}: {error}")
            continue
        if need_rows and df.limit(1).isEmpty():
            raise HeaderError("the table has no rows")
        return name, bound
    raise HeaderError("no mapping fits; " + "; ".join(errors))


def bind_files(
    tables: Mapping[str, DataFrame], mappings: Mapping[str, list[Field]]
) -> tuple[str, DataFrame, list[tuple[str, str, str]]]:
    """Bind several tables of one source.

    The first table settles the mapping; a later one that does not fit it, or is empty, is skipped.
    Returns the mapping's name, the positional union and one (table, mapping, status) per table.
    """
    names = list(tables)
    accepted, union = bind_first(tables[names[0]], mappings)
    outcome = [(names[0], accepted, "loaded")]
    for name in names[1:]:
        try:
            _, bound = bind_first(tables[name], {accepted: mappings[accepted]})
        except HeaderError:
            outcome.append((name, accepted, "skipped"))
            continue
        union = union.union(bound)
        outcome.append((name, accepted, "loaded"))
    return accepted, union, outcome


def parse_projections(text: str) -> list[tuple[str, str | None]]:
    """A projection list from JSON ``[[expression, alias or null], ...]``."""
    try:
        items = json.loads(text)
    except json.JSONDecodeError as error:
        raise ValueError(f"projections are not valid JSON: {error}") from error
    out = []
    for item in items:
        if not isinstance(item, list) or len(item) != 2:
            raise ValueError(f"a projection is [expression, alias], not {item!r}")
        expression, alias = item
        out.append((expression, None if alias in (None, "null") else alias))
    return out


_TOKENS = re.compile(r"""'(?:[^']|'')*'|"((?:[^"]|"")*)"|\bany_value\s*\(""", re.IGNORECASE)


def spark_expression(text: str) -> str:
    """An expression with "double-quoted" headers and any_value, as Spark SQL text.

    ``any_value`` skips NULLs and may take any row; ``min`` is such a choice, and the same one in
    every run and after every task retry.
    """

    def replace(match: re.Match[str]) -> str:
        token = match.group(0)
        if token.startswith("'"):
            return token
        if token.startswith('"'):
            return quoted(match.group(1).replace('""', '"'))
        return "min("

    return _TOKENS.sub(replace, text)


def select_list(projections: Projection | None) -> list[str]:
    """A projection list as Spark SQL items; none at all means every column."""
    if not projections:
        return ["*"]
    return [
        spark_expression(e) + (f" AS {quoted(a.strip())}" if a and a.strip() else "")
        for e, a in projections
    ]


def project(df: DataFrame, projections: Projection | None) -> DataFrame:
    """Select a projection list."""
    return df.selectExpr(*select_list(projections))
