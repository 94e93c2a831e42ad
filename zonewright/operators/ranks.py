"""Rows by their rank in an order, without a task that holds the rows up to it.

The row of rank n is found by narrowing a range of rows around it: a sample drawn by hash gives two rows that the wanted one is
expected between, and one count says whether it is. Each round leaves about one row in SAMPLE / SLACK; so
three rounds do for 10^9 rows and four for 10^12, and only samples and counts reach the driver. The answer to the question is then a filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

SAMPLE = 4_096
SLACK = 256  # rows of the sample on either side
SMALL = 100_000

Order = Sequence[tuple[str, bool]]  # (column, ascending); NULLs last both ways; the last column must be unique


def _plain(df: DataFrame, col: str) -> Column:
    """A value that orders alike and that the driver can hand back exactly."""
    kind = dict(df.dtypes)[col]
    return F.unix_micros(F.col(col).cast("timestamp")) if kind.startswith("timestamp") else F.unix_date(col) if kind == "date" else F.col(col)


def _keys(df: DataFrame, order: Order) -> list[Column]:
    return [_plain(df, c) for c, _ in order]


def _after(keys: Sequence[Column], order: Order, row: Sequence) -> Column:
    """Whether a row with these keys comes after `row`."""
    parts, same = [], F.lit(True)
    for key, (_, up), v in zip(keys, order, row):
        if v is not None:
            later = (key > F.lit(v)) if up else (key < F.lit(v))
            parts.append(same & F.coalesce(later | key.isNull(), F.lit(True)))
            same = same & F.coalesce(key == F.lit(v), F.lit(False))
        else:
            same = same & key.isNull()  # nothing comes after a NULL
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def _sorted(cols: Sequence[str], order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, (_, up) in zip(cols, order)]


def row_at(df: DataFrame, order: Order, n: int, small: int = SMALL, sample: int = SAMPLE) -> Row | None:
    """The keys of the row of rank n (from 1), None if there are fewer rows."""
    names = [f"_k{i}" for i in range(len(order))]
    keys = [F.col(c) for c in names]
    lean = df.select(*[k.alias(c) for k, c in zip(_keys(df, order), names)]).persist()  # read twice a round
    try:
        return _narrowed(lean, order, keys, n, small, sample)
    finally:
        lean.unpersist()


def _narrowed(lean: DataFrame, order: Order, keys: list[Column], n: int, small: int, sample: int) -> Row | None:
    names, low, high = lean.columns, None, None
    left, total, turn = n, lean.count(), 0
    if not 1 <= n <= total:
        return None
    while total > small:
        inside = lean if low is None else lean.where(_after(keys, order, low))
        inside = inside if high is None else inside.where(~_after(keys, order, high))
        drawn = inside.where(F.pmod(F.xxhash64(F.lit(turn), *keys), F.lit(max(1, total // sample))) == 0)
        marks = drawn.orderBy(*_sorted(names, order)).limit(16 * sample).collect()
        turn += 1
        if not marks:
            continue
        at, slack = left * len(marks) // total, max(2, len(marks) * SLACK // SAMPLE)
        a, b = marks[max(0, at - slack)], marks[min(len(marks) - 1, at + slack)]
        counts = inside.agg(*[F.count(F.when(~_after(keys, order, m), 1)).alias(x) for x, m in (("a", a), ("b", b))]).first()
        before, ahead = counts["a"], counts["b"]
        was = total
        if left <= before:
            high, total = a, before
        elif left <= ahead:
            low, high, left, total = a, b, left - before, ahead - before
        else:
            low, left, total = b, left - ahead, total - ahead
        if total == was and a == b and turn > 8:
            return a  # all that is left is alike
    inside = lean if low is None else lean.where(_after(keys, order, low))
    inside = inside if high is None else inside.where(~_after(keys, order, high))
    return inside.orderBy(*_sorted(names, order)).offset(left - 1).limit(1).first()


def first_rows(df: DataFrame, order: Order, n: int, small: int = SMALL) -> DataFrame:
    """The first n rows (all, if fewer), not sorted: a filter on the order columns, so every task keeps its own share."""
    cut = row_at(df, order, n, small) if n > 0 else None
    if cut is None:
        return df.limit(0) if n <= 0 else df
    return df.where(~_after(_keys(df, order), order, cut))


def rows_between(df: DataFrame, order: Order, offset: int, limit: int, small: int = SMALL) -> DataFrame:
    """Rows offset + 1 to offset + limit, sorted. What is before them is filtered off, so the sort holds `limit` rows at most."""
    if offset > 0:
        cut = row_at(df, order, offset, small)
        if cut is None:
            return df.limit(0)
        df = df.where(_after(_keys(df, order), order, cut))
    return df.orderBy(*_sorted([c for c, _ in order], order)).limit(limit)
