"""Exact top-k by inner product with vector-approximation files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from zonewright.llm import storage

CELLS = 256
DATA_ROWS = 4096
QUERY_ROWS = 256
SLOT_BLOCKS = 64
LEAST_SLOTS = 24
LONG = float(1 << 63)
BOUND_ROWS = 1 << 20
_BLOCK = "dims int, ids binary, cells binary"
_NEAR = pa.schema([("query", pa.int64()), ("cls", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, of vectors that take part; see search()."""
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))

    def whole(x: Column) -> Column:
        y = F.lit(scale) * x.cast("double")
        return F.when(F.abs(y) < LONG, F.floor(y).cast("long")).otherwise(F.raise_error(F.lit("a component does not fit a long")).cast("long"))

    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fits)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v")))


def _edges(bounds: np.ndarray) -> np.ndarray:
    """Least value of each cell, by cell and dimension, in whole numbers of any size."""
    low, width = bounds[0].astype(object), bounds[1].astype(object) - bounds[0].astype(object) + 1
    return np.array([[lo + -(-c * w // CELLS) for lo, w in zip(low, width)] for c in range(CELLS)], np.int64).reshape(CELLS, bounds.shape[1])


def _reach(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each cell, by cell and dimension; empty cells of narrow dimensions hold their neighbour's."""
    start = _edges(bounds)
    return start.astype(float), np.concatenate([start[1:] - 1, bounds[1:2]]).astype(float)


def _held(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, ids, vectors) in blocks of up to `rows` vectors of one length."""
    held: dict[int, tuple[list[int], list[list[int]]]] = {}
    for batch in batches:
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids, vectors = held.setdefault(len(v), ([], []))
            ids.append(i)
            vectors.append(v)
            if len(ids) == rows:
                ids, vectors = held.pop(len(v))
                yield len(v), np.array(ids, np.int64), np.array(vectors, np.int64)
    for n, (ids, vectors) in held.items():
        yield n, np.array(ids, np.int64), np.array(vectors, np.int64).reshape(len(ids), n)


def approximate(classes: DataFrame, bounds: dict[int, np.ndarray]) -> DataFrame:
    """Blocks of the approximation file: for each vector one byte per dimension, the cell its value is in."""
    shared = classes.sparkSession.sparkContext.broadcast(bounds)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = {n: _edges(b) for n, b in shared.value.items()}
        for n, ids, v in _held(batches, DATA_ROWS):
            cells = np.empty((len(ids), n), np.uint8)
            for d in range(n):
                cells[:, d] = np.searchsorted(edges[n][:, d], v[:, d], "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([cells.tobytes()], pa.binary())],
                                             names=["dims", "ids", "cells"])

    return classes.select("cls", "v").mapInArrow(pack, _BLOCK)


def _distances(cells: np.ndarray, q: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of queries with vectors of which the cells are known."""
    low, high = (t[cells, np.arange(cells.shape[1])] for t in table)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
    slack = 1e-9 * (np.abs(q) @ np.maximum(np.abs(high), np.abs(low)).T) + 1e-6  # rounding of the sums and of large integers
    return least - slack, most + slack


class _Best:
    """Candidates of one block of queries over the blocks of vectors seen so far, pruned by the kth lower bound of each query."""

    def __init__(self, queries: np.ndarray, k: int) -> None:
        self.queries, self.k = queries, k
        self.sure = np.full((len(queries), k), -np.inf)
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, ids: np.ndarray, least: np.ndarray, most: np.ndarray) -> None:
        both = np.concatenate([self.sure, least], axis=1)
        self.sure = -np.partition(-both, self.k - 1, axis=1)[:, : self.k]
        kth = self.sure.min(axis=1)
        at, of = np.nonzero(most >= kth[:, None])
        kept = [(p[0][ok], p[1][ok], p[2][ok], p[3][ok]) for p in self.parts if (ok := p[3] >= kth[p[0]]).any()]
        self.parts = [tuple(np.concatenate(c) for c in zip(*kept, (at, ids[of], least[at, of], most[at, of])))]

    def take(self) -> pa.RecordBatch:
        at, ids, least, most = self.parts[0]
        return pa.RecordBatch.from_arrays([pa.array(self.queries[at]), pa.array(ids), pa.array(least), pa.array(most)], schema=_NEAR)


def candidates(blocks: DataFrame, queries: DataFrame, bounds: dict[int, np.ndarray], k: int, slots: int) -> DataFrame:
    """(query, cls, low, high): for each query and slot of blocks the vectors whose upper bound reaches the slot's kth lower bound.

    Blocks of queries are laid beside the blocks of cells by an equi-join on the slot; only the queries are repeated. A task meets the
    blocks of a slot one by one for each block of queries, and carries the kth bound from one to the next.
    """
    shared = queries.sparkSession.sparkContext.broadcast(bounds)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, ids, v in _held(batches, QUERY_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())],
                                             names=["dims", "q_ids", "q"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {n: _reach(b) for n, b in shared.value.items()}
        key, best, q = None, None, None
        for batch in batches:
            for r in range(batch.num_rows):
                n, ids, cells, q_ids, raw = (c[r].as_py() for c in batch.columns)
                if key != (n, q_ids):
                    if best is not None:
                        yield best.take()
                    queries = np.frombuffer(q_ids, np.int64)
                    key, best, q = (n, q_ids), _Best(queries, k), np.frombuffer(raw, np.int64).reshape(len(queries), n).astype(float)
                of = np.frombuffer(ids, np.int64)
                best.add(of, *_distances(np.frombuffer(cells, np.uint8).reshape(len(of), n), q, tables[n]))
        if best is not None:
            yield best.take()

    sent = queries.select("cls", "v").mapInArrow(pack, "dims int, q_ids binary, q binary").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    # the blocks of queries on the left: a sort-merge join gives all blocks of a slot for one of them, then for the next
    laid = sent.join(blocks.withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int")).hint("merge"), ["dims", "slot"])
    return laid.select("dims", "ids", "cells", "q_ids", "q").mapInArrow(scan, "query bigint, cls bigint, low double, high double")


def _product() -> Column:
    """Inner product of v and q as a decimal: in longs, and where a step does not fit one, in decimals."""
    quick = F.expr("aggregate(zip_with(v, q, (a, b) -> try_multiply(a, b)), 0L, (s, x) -> try_add(s, x))")
    wide = F.expr("aggregate(zip_with(v, q, (a, b) -> cast(a as decimal(19,0)) * cast(b as decimal(19,0))), cast(0 as decimal(38,0)), "
                  "(s, x) -> cast(s + x as decimal(38,0)))")
    return F.coalesce(quick.cast("decimal(38,0)"), wide)


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """The k greatest integer inner products of each query with all other rows: (query_id, rank, vec_id, score).

    Components become floor(scale * x). Queries are the rows whose vec_id is divisible by `every`. Bounds from the cells
    of all vectors are scanned first; then exact vectors are read by falling upper bound, k first, then those whose
    bound still reaches the kth exact score, so the result is certain. Equal vectors are searched for and found once and
    stand for their k + 1 least ids. Ties go to the smaller vec_id; a query with fewer others has all of them.
    Vectors that are NULL or hold NULL, NaN or infinite components take no part, nor rows without vec_id. Finite components of any
    size count; one that does not fit a long after scaling, or such a score in the result, fails the job. Vectors of unlike
    length are not compared. Rows that repeat a vec_id all count, as vectors found and as queries; a query leaves out one row, its
    own. Empty tables give empty results. Other columns are ignored, whatever their names.
    """
    spark, path = vectors.sparkSession, storage.run_dir(vectors.sparkSession, "vafile")
    rows = storage.kept(integers(vectors, scale), f"{path}/vectors")
    wide = Window.partitionBy("v").orderBy("vec_id")
    members = rows.withColumn("n", F.row_number().over(wide)).where(F.col("n") <= k + 1)
    classes = storage.kept(members.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                           .withColumn("cls", F.monotonically_increasing_id()), f"{path}/classes")  # numbered once, as it is written
    ends = (classes.select(F.size("v").alias("n"), F.posexplode("v")).groupBy("n", "pos").agg(F.min("col").alias("lo"), F.max("col").alias("hi"))
            .orderBy("n", "pos").take(BOUND_ROWS + 1))
    if len(ends) > BOUND_ROWS:
        raise ValueError("too many dimensions for bounds that every executor holds")
    bounds: dict[int, list] = {}
    for r in ends:
        bounds.setdefault(r["n"], []).append((r["lo"], r["hi"]))
    arrays = {n: np.array(b, np.int64).T for n, b in bounds.items()}
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    queries = storage.kept(asked.join(classes.select("v", "cls"), "v").select("vec_id", "cls"), f"{path}/queries")
    distinct = queries.select("cls").distinct().join(classes.select("cls", "v"), "cls")
    file = storage.kept(approximate(classes.where(F.size("v") > 0), arrays), f"{path}/cells")
    blocks = file.count()
    slots = max(1, min(blocks, LEAST_SLOTS), -(-blocks // SLOT_BLOCKS))
    near = candidates(file, distinct.where(F.size("v") > 0), arrays, k + 1, slots)
    near = storage.kept(near, f"{path}/near")
    by_low = Window.partitionBy("query").orderBy(F.desc("low"))
    sure = near.withColumn("n", F.row_number().over(by_low)).where(F.col("n") <= k + 1).groupBy("query").agg(F.min("low").alias("sure"), F.count("low").alias("have"))
    by_high = Window.partitionBy("query").orderBy(F.desc("high"), "cls")
    near = near.join(sure, "query").where((F.col("have") <= k) | (F.col("high") >= F.col("sure")))
    near = storage.kept(near.select("query", "cls", "high", F.row_number().over(by_high).alias("n")), f"{path}/ordered")

    def exact(pairs: DataFrame) -> DataFrame:
        of = classes.select("cls", "v").join(pairs.select("query", "cls"), "cls").join(distinct.select(F.col("cls").alias("query"), F.col("v").alias("q")), "query")
        return of.select("query", "cls", _product().alias("score"))

    first = storage.kept(exact(near.where(F.col("n") <= k + 1)), f"{path}/first")
    kth = first.groupBy("query").agg(F.min("score").alias("kth"))
    rest = near.where(F.col("n") > k + 1).join(kth, "query").where(F.col("high") >= F.col("kth"))
    scored = storage.kept(first.unionByName(exact(rest)), f"{path}/scored")
    order = [F.desc("score"), F.asc("vec_id")]
    found = scored.join(classes.select("cls", "ids"), "cls").select("query", "cls", "score", F.posexplode("ids").alias("pos", "vec_id"))
    found = found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*order, "cls", "pos"))).where(F.col("n") <= k + 1)
    # of the rows with the query's vector and id one is the query itself
    own = F.row_number().over(Window.partitionBy("query", "cls", "vec_id").orderBy("pos"))
    found = found.withColumn("copy", own).drop("pos", "n")
    asked = queries.withColumn("turn", F.row_number().over(Window.partitionBy("vec_id", "cls").orderBy("cls")))
    out = asked.select(F.col("vec_id").alias("query_id"), F.col("cls").alias("query"), "turn").join(found, "query")
    out = out.where((F.col("vec_id") != F.col("query_id")) | (F.col("cls") != F.col("query")) | (F.col("copy") > 1))
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query", "turn").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
