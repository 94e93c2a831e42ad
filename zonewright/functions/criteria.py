"""Search criteria (column, match, value) compiled to one boolean Column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewright import schema

MATCHES = ("exact", "startswith", "substring", "not")


class Criterion(NamedTuple):
    col: str
    match: str
    value: str


def check(criteria: Sequence[tuple[str, str, str]], columns: Sequence[str] | None = None) -> list[Criterion]:
    """Validated criteria; ValueError on an unknown column or match, or a bad boolean value."""
    allowed = set(schema.ALL_COLS if columns is None else columns)
    out = []
    for item in criteria:
        c = Criterion(*item)
        if c.col not in allowed:
            raise ValueError(f"unknown search column {c.col!r}")
        if c.match not in MATCHES:
            raise ValueError(f"unknown match {c.match!r}")
        out.append(c)
    return out


def _array_match(col: Column, match: str, value: str) -> Column:
    if match == "startswith":
        hit = F.exists(col, lambda x: x.startswith(value))
    elif match == "substring":
        hit = F.exists(col, lambda x: x.contains(value))
    else:
        hit = F.array_contains(col, value)
    hit = F.coalesce(hit, F.lit(False))  # a NULL list or NULL element holds nothing
    return ~hit if match == "not" else hit


def _bool_match(col: Column, match: str, value: str) -> Column:
    if value not in ("true", "false"):
        raise ValueError(f"a boolean search value is 'true' or 'false', not {value!r}")
    wanted = F.lit(value == "true")
    return col != wanted if match == "not" else col == wanted


def _scalar_match(col: Column, kind: T.DataType, match: str, value: str) -> Column:
    if match in ("exact", "not"):
        if isinstance(kind, T.StringType):
            wanted = F.lit(value)
        elif isinstance(kind, T.ArrayType):  # the month series is compared as a whole
            wanted = F.from_json(F.lit(value), kind)
        else:
            wanted = F.lit(value).try_cast(kind)
        return col != wanted if match == "not" else col == wanted
    if isinstance(kind, T.ArrayType):
        raise ValueError("a number series has no prefix or substring")
    text = col if isinstance(kind, T.StringType) else col.cast("string")
    return text.startswith(value) if match == "startswith" else text.contains(value)


def predicate_for(kind: T.DataType, criterion: Criterion) -> Column:
    col = F.col(criterion.col)
    if isinstance(kind, T.BooleanType):
        return _bool_match(col, criterion.match, criterion.value)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return _array_match(col, criterion.match, criterion.value)
    return _scalar_match(col, kind, criterion.match, criterion.value)


def search_predicate(df: DataFrame, criteria: Sequence[tuple[str, str, str]],
                     columns: Sequence[str] | None = None) -> Column:
    """AND of all criteria, typed by the frame's own schema. No criteria means every row.

    Text values are literal: `%` and `_` have no special meaning. SQL three-valued logic holds for
    NULL scalars, so neither `exact` nor `not` selects them.
    """
    checked = check(criteria, df.columns if columns is None else columns)
    parts = [predicate_for(df.schema[c.col].dataType, c) for c in checked]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def criteria_text(criteria: Column) -> Column:
    """`col match value,col match value` from an array<struct<col,match,value>> column."""
    return F.array_join(F.transform(criteria, lambda c: F.concat_ws(" ", c["col"], c["match"], c["value"])), ",")


# Starting points; what they look for is the caller's data.
def on_nameserver_domain(host: str) -> list[Criterion]:
    return [Criterion("ns_domains", "exact", host)]


def on_mail_host(host: str) -> list[Criterion]:
    return [Criterion("mx", "exact", host)]


def named_like(prefix: str) -> list[Criterion]:
    return [Criterion("domain", "startswith", prefix)]


def available() -> list[Criterion]:
    return [Criterion("registered", "exact", "false")]
