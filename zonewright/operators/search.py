"""Search over the current view: snapshots, refinement, paging, tags, facets, summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright import schema
from zonewright.functions import text
from zonewright.functions.criteria import Criterion, search_predicate
from zonewright.operators import ranks

FACET_SIZE = 100
MONTHS = 12


# --- running a search ----------------------------------------------------------------------------
def search(current: DataFrame, criteria: Sequence[tuple[str, str, str]]) -> DataFrame:
    return current.where(search_predicate(current, criteria))


def snapshot(found: DataFrame, search_id: int) -> DataFrame:
    return found.withColumn("search_id", F.lit(search_id).cast("bigint"))


def write_snapshot(found: DataFrame, path: str, search_id: int) -> None:
    """Store a result under its id; the same id written twice holds the later result once."""
    (snapshot(found, search_id).write.partitionBy("search_id")
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def read_snapshot(store: DataFrame, search_id: int) -> DataFrame:
    """One stored result; the id is a partition column, so other results are not read."""
    return store.where(F.col("search_id") == search_id).drop("search_id")


def refine(store: DataFrame, parent_id: int, criteria: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Narrow a stored result: only the parent's rows are read."""
    return search(read_snapshot(store, parent_id), criteria)


def with_criterion(criteria: Sequence[Criterion], new: tuple[str, str, str]) -> list[Criterion]:
    return [*criteria, Criterion(*new)]


def without_criterion(criteria: Sequence[Criterion], index: int) -> list[Criterion]:
    """Dropped or replaced criteria widen a search: run the result over the base view, not a snapshot."""
    return [c for i, c in enumerate(criteria) if i != index]


def changed_criterion(criteria: Sequence[Criterion], index: int, new: tuple[str, str, str]) -> list[Criterion]:
    return [Criterion(*new) if i == index else c for i, c in enumerate(criteria)]


# --- paging ------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Page:
    """A sorted slice. Text form `column/direction/limit/offset`."""

    order_by: str = "visits_12m"
    order: str = "desc"
    limit: int = 100
    offset: int = 0
    rows: int | None = None

    def __post_init__(self):
        if self.order not in ("asc", "desc") or self.order_by not in schema.ALL_COLS:
            raise ValueError(f"cannot order by {self.order_by} {self.order}")
        if not isinstance(self.limit, int) or not isinstance(self.offset, int):
            raise ValueError("limit and offset are whole numbers")

    @classmethod
    def parse(cls, form: str | None) -> Page:
        if not form:
            return cls()
        order_by, order, limit, offset = form.split("/")
        return cls(order_by, order, int(limit), int(offset))

    def to_string(self) -> str:
        return f"{self.order_by}/{self.order}/{self.limit}/{self.offset}"

    def change(self, **parts) -> Page:
        return replace(self, **{k: v for k, v in parts.items() if v is not None})

    def next_page(self) -> Page:
        if self.rows is None:
            raise ValueError("the number of rows must be known")
        ahead = self.offset + self.limit
        return replace(self, offset=ahead if ahead <= self.rows else self.rows // self.limit * self.limit)

    def previous_page(self) -> Page:
        return replace(self, offset=max(0, self.offset - self.limit))


def _ordered(col: str, order: str) -> Column:
    return F.col(col).asc_nulls_last() if order == "asc" else F.col(col).desc_nulls_last()


def page(df: DataFrame, p: Page = Page(), key: str = "domain") -> DataFrame:
    """Rows of a page, NULLs last both ways, ties in key order. Plans as a top-k, not a full sort; a task holds offset + limit rows.

    For pages far down see `deep_page`.
    """
    sort = [_ordered(p.order_by, p.order)]
    if p.order_by != key:
        sort.append(F.col(key).asc())
    return df.orderBy(*sort).offset(p.offset).limit(p.limit)


def deep_page(df: DataFrame, p: Page = Page(), key: str = "domain", small: int = ranks.SMALL) -> DataFrame:
    """The same rows, however far down: the row before the page is found by rank, what precedes it is filtered off. `key` is unique."""
    order = [(p.order_by, p.order == "asc")] + ([(key, True)] if p.order_by != key else [])
    return ranks.rows_between(df, order, p.offset, p.limit, small)


def page_keyset(df: DataFrame, after: str | None, n: int, key: str = "domain") -> DataFrame:
    """The `n` rows that follow a key in key order; costs the same however deep."""
    rest = df if after is None else df.where(F.col(key) > after)
    return rest.orderBy(key).limit(n)


# --- exports -----------------------------------------------------------------------------------
def first_by_key(df: DataFrame, n: int | None, key: str = "domain", descending: bool = False,
                 small: int = ranks.SMALL) -> DataFrame:
    """The first `n` rows (None: all) in the order of a unique key, exactly, without one task seeing them all.

    The last key to keep is found by rank (`ranks.row_at`); the answer is a filter on the key. Rows without a key come
    last, in no order; of them as many are taken as are still wanted.
    """
    if n is None:
        return df
    named = df.where(F.col(key).isNotNull())
    have = named.count()
    if n > have:
        return named.unionByName(df.where(F.col(key).isNull()).limit(n - have))
    return ranks.first_rows(named, [(key, not descending)], n, small)


def export_rows(found: DataFrame, cap: int | None = None) -> DataFrame:
    """All searchable columns, names last to first, lists comma-joined; at most `cap` rows where one is given."""
    kinds = dict(found.dtypes)
    cols = [c for c in schema.ALL_COLS if c in kinds]
    flat = [(F.array_join(F.col(c).cast("array<string>"), ",") if kinds[c].startswith("array") else F.col(c)).alias(c)
            for c in cols]
    return first_by_key(found, cap, descending=True).select(*flat).orderBy(F.desc("domain"))


def export_csv(found: DataFrame, path: str, cap: int | None = None) -> None:
    """Part files in order, each with a header."""
    export_rows(found, cap).write.mode("errorifexists").csv(path, header=True)


def domain_list(found: DataFrame, cap: int | None = None) -> DataFrame:
    return first_by_key(found.select("domain"), cap).orderBy(F.asc_nulls_last("domain"))


def export_domains(found: DataFrame, path: str, cap: int | None = None) -> None:
    domain_list(found, cap).write.mode("errorifexists").text(path)


# --- tags ----------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Tag:
    id: int
    name: str
    colour: str
    icon: str
    criteria: tuple[tuple[str, str, str], ...]


def load_tags(tags: DataFrame, searches: DataFrame) -> list[Tag]:
    """Tags with the criteria of their saved search. Labels are made by hand, so they are few."""
    bound = tags.join(searches.select(F.col("id").alias("search_id"), "criteria"), "search_id").orderBy("id")
    return [Tag(r["id"], r["name"], r["colour"], r["icon"], tuple((c["col"], c["match"], c["value"]) for c in r["criteria"]))
            for r in bound.select("id", "name", "colour", "icon", "criteria").collect()]


def tag_by_id(tags: DataFrame, tag_id: int) -> DataFrame:
    """The label with this id, none or one row."""
    return tags.where(F.col("id") == tag_id)


def tag_of_search(tags: DataFrame, search_id: int) -> DataFrame:
    """The label of a saved search, the first by id where there are several."""
    return tags.where(F.col("search_id") == search_id).orderBy("id").limit(1)


def tag_rows(df: DataFrame, tags: Sequence[Tag], out: str = "tags") -> DataFrame:
    """Add the list of tags whose criteria a row meets, all in one pass over the rows."""
    marks = [F.when(search_predicate(df, t.criteria), F.struct(
        F.lit(t.id).alias("id"), F.lit(t.name).alias("name"), F.lit(t.colour).alias("colour"),
        F.lit(t.icon).alias("icon"))) for t in tags]
    none = F.array().cast("array<struct<id:int,name:string,colour:string,icon:string>>")
    return df.withColumn(out, F.array_compact(F.array(*marks)) if marks else none)


# --- facets and summary --------------------------------------------------------------------------
def facet_values(df: DataFrame, col: str, criteria: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Values `v` that a facet counts: list elements one by one, scalars unless NULL.

    For servers of a search on a nameserver domain only hosts under that domain count.
    """
    kind = dict(df.dtypes)[col]
    if kind == "array<string>":
        values = df.select(F.explode(col).alias("v"))
    else:
        values = df.select(F.col(col).alias("v"))
    values = values.where(F.col("v").isNotNull())
    under = [c[2] for c in criteria if c[0] == "ns_domains"] if col == "ns" else []
    return values.where(F.col("v").endswith("." + under[0])) if under else values


def facet(df: DataFrame, col: str, criteria: Sequence[tuple[str, str, str]] = (), size: int = FACET_SIZE) -> DataFrame:
    """Most frequent values `(label, count)` of `facet_values`. See `heavy.facet` for columns with very many values."""
    kind = dict(df.dtypes)[col]
    counts = facet_values(df, col, criteria).groupBy("v").agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), "v").limit(size)
    label = text.empty_label(F.col("v")) if kind in ("string", "array<string>") else F.col("v")
    return top.select(label.alias("label"), "count")


def top_n(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Most frequent values `(val, count)` of the current view, lists taken whole, NULL counted too."""
    counts = df.groupBy(F.col(col).alias("val")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.col("val").asc_nulls_last()).limit(n)


def summary(df: DataFrame, months: str = "visits_arr_12m") -> DataFrame:
    """One row: count, counts by registered state, the 12 monthly sums and their total.

    The rows are read once: partial sums per state, then those at most three lines into one.
    """
    sums = [F.coalesce(F.sum(F.coalesce(F.get(months, i), F.lit(0))), F.lit(0)).alias(f"m{i}") for i in range(MONTHS)]
    by_state = df.groupBy("registered").agg(F.count(F.lit(1)).alias("n"), *sums)
    monthly = F.array(*[F.coalesce(F.sum(f"m{i}"), F.lit(0)) for i in range(MONTHS)])
    state = F.sort_array(F.collect_list(F.struct(
        F.when(F.col("registered").isNull(), 2).when(F.col("registered"), 1).otherwise(0).alias("rank"),
        F.col("registered"), F.col("n").alias("count"))))
    out = by_state.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), state.alias("_s"), monthly.alias("visits_arr_12m"))
    return out.select("count", F.transform("_s", lambda s: F.struct(s["registered"], s["count"])).alias("registered"),
                      "visits_arr_12m",
                      F.aggregate("visits_arr_12m", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("visits_12m"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))
