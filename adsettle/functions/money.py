"""Money cells: text to double, nets, and the tolerance test."""

from __future__ import annotations

import operator
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: amounts up to this size count as nothing.
TOLERANCE = 0.00001

# Fixed pattern: the number texts a cell may hold. Single underscores may part digits; a trailing
# type letter (1d, 5f) is not a number.
_DIGITS = r"\d+(_\d+)*"
_NUMBER = (
    rf"^\s*[+-]?(inf|infinity|nan|({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})"
    rf"(e[+-]?{_DIGITS})?)\s*$"
)
#: The same pattern where cells are read, before they are in a column.
NUMBER = re.compile(_NUMBER.replace("$", r"\Z"), re.IGNORECASE | re.ASCII)


def money(df: DataFrame, name: str, lenient: bool = False) -> Column:
    """Column ``name`` as double.

    Strict: text that is no number fails the job. Lenient: it becomes NULL. Both hold whatever
    ``spark.sql.ansi.enabled`` says.
    """
    return F.expr(money_sql(df, name, lenient))


def money_sql(df: DataFrame, name: str, lenient: bool = False) -> str:
    """``money`` as SQL text, from which longer expressions are put together in one go.

    Spark's cast would take a trailing type letter and refuse underscores. With a letter of our own
    put behind it, text that brings one along fails the cast, and only text that fails is held
    against the pattern. The expression is kept short: a net has up to fourteen of these in one
    generated method, and the JVM does not compile methods over 8,000 bytes.
    """
    cell = quoted(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return f"CAST({cell} AS DOUBLE)"
    # hexadecimal floats are refused: without its x such text is no number. They begin with a zero, a sign or a space,
    # so text from '1' on, as most amounts are, needs no copy to be told from them
    plain = f"TRY_CAST(concat(CASE WHEN {cell} >= '1' THEN {cell} ELSE translate({cell}, 'xX', '??') END, 'd') AS DOUBLE)"
    other = (
        f"TRY_CAST(CASE WHEN {cell} RLIKE r'(?i){_NUMBER}' THEN replace({cell}, '_', '') END"
        " AS DOUBLE)"
    )
    if lenient:
        return f"coalesce({plain}, {other})"
    said = name.replace("\\", "\\\\").replace("'", "\\'")
    refuse = (
        f"CASE WHEN {cell} IS NOT NULL THEN"
        f" CAST(raise_error(concat('{said}: not a number: ', {cell})) AS DOUBLE) END"
    )
    return f"coalesce({plain}, {other}, {refuse})"


def rejected(df: DataFrame, name: str) -> Column:
    """True where a cell holds text that is no number."""
    return F.col(quoted(name)).isNotNull() & money(df, name, lenient=True).isNull()


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def net(plus: Iterable[Column], minus: Iterable[Column] = ()) -> Column:
    """Sum of ``plus`` less each of ``minus``; NULL as soon as one operand is NULL."""
    return reduce(operator.sub, minus, reduce(operator.add, plus))


# A net of more text amounts than this makes a generated method that the JVM would not compile.
TERMS_PER_SUM = 6


def settlement(
    df: DataFrame, plus: Sequence[str], minus: Sequence[str] = (), lenient: bool = False
) -> list[Column]:
    """Row-level parts of a net in which a missing amount counts as 0.

    Their totals add up to the settlement: the same as summing every term and netting the sums, with
    one aggregation buffer for six terms.
    """
    signed = [("+", c) for c in plus] + [("-", c) for c in minus]
    return [
        F.expr(
            "0.0D"
            + "".join(
                f" {sign} coalesce({money_sql(df, c, lenient)}, 0.0D)"
                for sign, c in signed[at : at + TERMS_PER_SUM]
            )
        )
        for at in range(0, len(signed), TERMS_PER_SUM)
    ]


def beyond_tolerance(*measures: Column) -> Column:
    """True where any measure is larger than the tolerance; a NULL measure does not count."""
    return reduce(operator.or_, [F.abs(m) > F.lit(TOLERANCE) for m in measures])


def quoted(name: str) -> str:
    """``name`` as an identifier; headers hold brackets and dots."""
    return "`" + name.replace("`", "``") + "`"
