"""Divergence of the sources of a language, worked out in the cells of a cube (group block, group block, term block).

A slice holds the probabilities of one block of groups for one block of terms. It is replicated to the cells of its row
and of its column, so that each cell finds the two slices it compares; a task computes the partial sums of its cells,
and a sum along the term axis gives the result. The work is dense in (group, group, term), and no task holds more than
two slices at a time.

Probabilities are integers: p = 1 + floor(SCALE * (count + 1) / (N + V)), for N counted terms in the group and V kept terms.
The divergence of p from q at a term is floor((p - q)^2 / q). All arithmetic is exact; see _scaled() and cell().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from zonewright.llm import storage, words
from zonewright.operators.skew import salted_join

SCALE = 1_000_000_000
GROUPS = 32
TERMS = 4096
HELD = 1 << 19
_COUNT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_PARTIAL = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())])

# fixed values: bytes of a term: letters of ASCII and whatever is beyond ASCII
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class _Tally:
    """Counts of some chunks of texts by group and term, added up before they leave the task."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.entries: list[tuple[np.ndarray, ...]] = []
        self.terms: list[np.ndarray] = []
        self.names: list[pa.StringArray] = []
        self.bare: set[int] = set()
        self.size = 0

    def add(self, group: np.ndarray, chunk: words.Chunk) -> None:
        """Count the terms of a chunk; group: number of the group of each row."""
        self.bare.update(np.unique(group).tolist())
        data = words.ASCII_LOWER[chunk.data]
        w = words.split(chunk, ~_LETTER[data])
        if not len(w.start):
            return
        of, at, term = np.unique(words.hashes(data, w.start, w.end), return_index=True, return_inverse=True)
        pair, n = np.unique(group[w.row] * len(of) + term, return_counts=True)
        once = np.unique(w.row * len(of) + term)
        docs = np.bincount(np.searchsorted(pair, group[once // len(of)] * len(of) + once % len(of)), minlength=len(pair))
        self.entries.append((pair // len(of), of[pair % len(of)], n, docs))
        order = np.argsort(at)
        start, end = w.start[at[order]], w.end[at[order]]
        step = np.zeros(len(data) + 1, np.int64)
        step[start] += 1
        step[end] -= 1
        offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
        self.terms.append(of[order])
        self.names.append(pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[np.cumsum(step[:-1]) > 0].tobytes())))
        self.size += len(pair)

    def take(self) -> pa.RecordBatch:
        """The sums, and a row without a term for each group seen; the tally is empty afterwards."""
        keys = list(self.groups)
        bare = sorted(self.bare)
        number, n, docs, names = np.array(bare, np.int64), np.zeros(len(bare), np.int64), np.zeros(len(bare), np.int64), pa.nulls(len(bare), pa.string())
        if self.entries:
            terms, first = np.unique(np.concatenate(self.terms), return_index=True)
            group, of, count, held = (np.concatenate([e[i] for e in self.entries]) for i in range(4))
            pair, back = np.unique(group * len(terms) + np.searchsorted(terms, of), return_inverse=True)
            total, both = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            np.add.at(total, back, count)
            np.add.at(both, back, held)
            number, n, docs = np.concatenate([number, pair // len(terms)]), np.concatenate([n, total]), np.concatenate([docs, both])
            names = pa.concat_arrays([names, pa.concat_arrays(self.names).take(pa.array(first[pair % len(terms)]))])
        lang, source = (pa.array([k[i] for k in keys], pa.string()).take(pa.array(number)) for i in range(2))
        self.entries, self.terms, self.names, self.bare, self.size = [], [], [], set(), 0
        return pa.RecordBatch.from_arrays([lang, source, names, pa.array(n), pa.array(docs)], schema=_COUNT)


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term and documents that hold it, added up over up to HELD terms of a task.

    The sums of n and of docs over equal rows are right. Each group also stands with a NULL term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            group = np.array([tally.groups.setdefault(p, len(tally.groups)) for p in pairs], np.int64)
            for chunk in words.chunks(batch.column(2)):
                tally.add(group[chunk.first : chunk.first + len(chunk)], chunk)
                if tally.size >= HELD:
                    yield tally.take()
        if tally.bare:
            yield tally.take()

    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return named.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def _scaled(count: Column, all_: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / all_) for count < all_, by long division in three steps of 1000: exact for all_ up to 2^53."""
    left, result = count + F.lit(1), F.lit(0).cast("long")
    for _ in range(3):
        step = left * F.lit(1000)
        result, left = result * F.lit(1000) + F.call_function("div", step, all_), step % all_
    return result + F.lit(1)


def scaled(count: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """The same over arrays."""
    left, result = count + 1, np.zeros_like(count)
    for _ in range(3):
        step = left * 1000
        result, left = result * 1000 + step // all_, step % all_
    return result + 1


def cell(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Partial divergences of the rows of p from those of q: sums over the terms. The square of a difference fits 63 bits."""
    out = np.zeros((len(p), len(q)), np.int64)
    for i, row in enumerate(p):
        d = row - q
        out[i] = (d * d // q).sum(axis=1)
    return out


def statistics(docs: DataFrame, least_docs: int, term_block: int, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the sums need, as written tables: terms, groups and counts, over all documents.

    terms: (lang, term, total, lang_all, tblock, t) of each kept term: its count in the language, N + V of the language, and its place.
    groups: (lang, source, g, all) of each group, numbered in its language, with its own N + V. counts: (lang, source, g, all, term, n and the
    columns of terms) of each group and kept term that meet.
    """
    grouped = storage.kept(counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), f"{path}/grouped")
    held = grouped.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    held = storage.kept(held.drop("docs"), f"{path}/held")
    langs = held.groupBy("lang").agg(F.count(F.lit(1)).alias("V"), (F.sum("total") + F.count(F.lit(1))).alias("lang_all"))
    blocks = F.ceil(F.col("V") / term_block).cast("int")
    placed = (salted_join(held, langs, ["lang"], F.col("term"), "inner").withColumn("tblock", F.pmod(F.xxhash64("term"), blocks).cast("int"))
              .withColumn("t", F.row_number().over(Window.partitionBy("lang", "tblock").orderBy("term")) - 1))
    terms = storage.kept(placed.select("lang", "term", "total", "lang_all", "tblock", "t"), f"{path}/terms")
    met = storage.kept(grouped.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), f"{path}/met")
    own = grouped.select("lang", "source").distinct().join(met.groupBy("lang", "source").agg(F.sum("n").alias("N")), ["lang", "source"], "left")
    groups = (own.join(langs, "lang", "left").withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
              .select("lang", "source", "g", (F.coalesce("N", F.lit(0)) + F.coalesce("V", F.lit(0))).alias("all")))
    groups = storage.kept(groups, f"{path}/groups")
    return terms, groups, storage.kept(salted_join(met, groups, ["lang", "source"], F.col("term"), "inner"), f"{path}/counts")


def slices(terms: DataFrame, groups: DataFrame, counts: DataFrame, group_block: int) -> DataFrame:
    """(lang, gblock, gblocks, tblock, terms, all, cells): the counts of one block of groups for one block of terms.

    all: (g, N + V) of each group of the block; cells: (g, t, n) of the counts that are not 0, t the place in the block, of `terms`
    places. Each block of groups meets each block of terms of its language, with or without counts; a language that keeps no term has one
    empty block of terms.
    """
    gblock = F.floor(F.col("g") / group_block).cast("int").alias("gblock")
    sizes = groups.groupBy("lang").agg((F.floor(F.max("g") / group_block) + 1).cast("int").alias("gblocks"))
    blocks = terms.groupBy("lang", "tblock").agg(F.count(F.lit(1)).cast("int").alias("terms"))
    axis = sizes.join(blocks, "lang", "left").fillna(0, ["tblock", "terms"])
    axis = axis.withColumn("gblock", F.explode(F.expr("sequence(0, gblocks - 1)")))
    members = groups.groupBy("lang", gblock).agg(F.collect_list(F.struct("g", "all")).alias("all"))
    held = counts.groupBy("lang", gblock, "tblock").agg(F.collect_list(F.struct("g", "t", "n")).alias("cells"))
    return axis.join(members, ["lang", "gblock"]).join(held, ["lang", "gblock", "tblock"], "left")


def _dense(all_: pa.StructScalar, cells: pa.ListScalar, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the groups of a slice, and their probabilities: one row per group, one column per term."""
    g, size = (all_.values.field(i).to_numpy().astype(np.int64) for i in range(2))
    order = np.argsort(g)
    g, size = g[order], size[order]
    n = np.zeros((len(g), terms), np.int64)
    if cells.is_valid and terms:
        row, t, count = (cells.values.field(i).to_numpy() for i in range(3))
        n[np.searchsorted(g, row), t] = count
    return g, scaled(n, np.maximum(size, 1)[:, None])


def pair_sums(sliced: DataFrame) -> DataFrame:
    """(lang, a, b, value): divergence of group a from group b, for all a and b of a language, summed along the term axis.

    The cube of a language has a cell for each two blocks of groups, in order, and each block of terms. Slices are replicated along
    the other group axis only, and meet by an equi-join on the cell, whose task works out both directions.
    """
    row = sliced.withColumn("other", F.explode(F.expr("sequence(gblock, gblocks - 1)")))
    col = sliced.withColumn("other", F.explode(F.expr("sequence(0, gblock)")))
    keys = ["lang", "i", "j", "tblock"]
    cube = (row.select("lang", F.col("gblock").alias("i"), F.col("other").alias("j"), "tblock", "terms", "all", "cells")
            .join(col.select("lang", F.col("other").alias("i"), F.col("gblock").alias("j"), "tblock", F.col("all").alias("all_j"), F.col("cells").alias("cells_j")), keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, i, j, terms, *data = batch.columns
            for r in range(batch.num_rows):
                size = terms[r].as_py()
                (ga, p), (gb, q) = _dense(data[0][r], data[1][r], size), _dense(data[2][r], data[3][r], size)
                found = [(ga, gb, cell(p, q))] + ([(gb, ga, cell(q, p))] if i[r] != j[r] else [])
                for x, y, value in found:
                    a, b, v = np.repeat(x, len(y)), np.tile(y, len(x)), value.ravel()
                    apart = a != b
                    yield pa.RecordBatch.from_arrays([pa.array([lang[r].as_py()] * int(apart.sum()), pa.string()), pa.array(a[apart]), pa.array(b[apart]), pa.array(v[apart])],
                                                     schema=_PARTIAL)

    parts = cube.select("lang", "i", "j", "terms", "all", "cells", "all_j", "cells_j").mapInArrow(run, "lang string, a bigint, b bigint, value bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200, group_block: int = GROUPS, term_block: int = TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of each language differ in their use of terms.

    NULL lang, source and text count as ''. Terms are runs of ASCII letters, A-Z lower-cased, and of characters beyond ASCII. A language
    keeps the terms in at least `least_docs` of its documents; V is their number. Part `pair`: item is each other source of the language, value the divergence of
    the source from it, summed over all kept terms (0 if V is 0). Part `term`: item is each kept term that the source uses more
    than the language does, value the divergence of the source from the language at that term; of these the first `top`. rank counts from 1 per source
    and part by falling value; ties go to the item that is less as UTF-8.

    Rows that repeat a document count as often as they stand; empty texts make a group without terms; texts of any length are read whole, in chunks. Other columns
    are ignored, whatever their names; an empty table gives an empty result. Exact for up to 2^53 words in a language and 10^9 kept terms.
    """
    path = storage.run_dir(docs.sparkSession, "divergence")
    terms, groups, counts = statistics(docs, least_docs, term_block, path)
    sums = pair_sums(storage.kept(slices(terms, groups, counts, group_block), f"{path}/slices"))
    named = groups.select("lang", "g", "source")
    pairs = (sums.join(named.withColumnRenamed("g", "a"), ["lang", "a"])
             .join(named.select("lang", F.col("g").alias("b"), F.col("source").alias("item")), ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    p, q = _scaled(F.col("n"), F.col("all")), _scaled(F.col("total"), F.col("lang_all"))
    more = counts.withColumn("p", p).withColumn("q", q).where("p > q").withColumn("value", F.expr("((p - q) * (p - q)) div q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
