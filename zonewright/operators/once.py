"""Costly expressions that many others refer to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are worked out once per row.

    A plain projection is merged into whatever reads it and its expressions are copied to every
    reference and every pushed filter; a generator is not. The values are made by a projection below
    the generator, which then only takes them apart: Spark compiles projections, but interprets what
    a generator holds.
    """
    made = df.select("*", F.struct(*[v.alias(n) for n, v in values.items()]).alias("_once"))
    return made.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array("_once")))
