"""Benchmark decontamination: windows of templates, joined by hash, then checked for consistent slots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zonewright.llm import storage, words

WINDOW = 8
SHORTEST = 3
COVERAGE = 0.5
SCREEN = 1 << 24
SCREEN_SLICE = 1 << 16

# fixed values: units of measure
UNITS = ("mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec secs second seconds min mins minute minutes h hr hrs hour hours day "
         "days week weeks month months year years meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram grams "
         "kilogram kilograms pound pounds ounce ounces liter liters litre litres dollar dollars euro euros cent cents usd eur gbp mph kmh "
         "hz khz mhz ghz kb mb gb tb w kw v a pa bar degree degrees percent").split()

_SPOT = pa.schema([("id", pa.int64()), ("pos", pa.int64()), ("total", pa.int64()), ("hash", pa.int64()), ("slots", pa.list_(pa.int64())),
                   ("size", pa.int32())])
_SPOT_DDL = "id bigint, pos bigint, total bigint, hash bigint, slots array<bigint>, size int"


def _hash_words(texts: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    w = words.split(words.Chunk(0, data, np.array([0, len(data)])), words.SPACE[data])
    return words.hashes(data, w.start, w.end)


_UNIT_HASHES = np.sort(_hash_words(UNITS))
_NUMBER, _NAME, _UNIT = _hash_words(["<number>", "<name>", "<unit>"])


def templates(chunk: words.Chunk) -> tuple[words.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the chunk, the hash of each, the hash of its canonical form, and whether that is a placeholder.

    Numbers (digits, with `.` and `,` between digits) become <number>, words of UNITS after a number <unit>, and
    capitalised words (not those all in capitals) that do not begin a sentence or a text <name>. Other words are lower-cased.
    """
    raw = chunk.data
    gap = words.letter_gaps(raw)
    digit = words.DIGIT[raw]
    inner = np.flatnonzero((raw[1:-1] == 0x2E) | (raw[1:-1] == 0x2C)) + 1
    gap[inner[digit[inner - 1] & digit[inner + 1]]] = False
    w = words.split(chunk, gap)
    data = words.lowered(raw)
    plain = words.hashes(data, w.start, w.end)
    letters = np.concatenate([[0], np.cumsum(words.ALNUM[raw] & ~digit)])
    number = letters[w.end] == letters[w.start]
    first = np.zeros(len(w.start), bool)
    first[w.first[:-1][w.first[:-1] < w.first[1:]]] = True
    after = np.concatenate([[False], number[:-1]]) & ~first
    at = np.minimum(np.searchsorted(_UNIT_HASHES, plain), len(_UNIT_HASHES) - 1)
    unit = after & (_UNIT_HASHES[at] == plain)
    stops = np.concatenate([[0], np.cumsum(np.isin(raw, np.frombuffer(b".!?:;\n", np.uint8)))])
    before = np.concatenate([[0], w.end[:-1]])
    begins = first | (stops[w.start] > stops[before])
    capital = (raw[w.start] >= 65) & (raw[w.start] <= 90)
    latin = np.flatnonzero(raw[w.start] == 0xC3)
    capital[latin] = (raw[w.start[latin] + 1] <= 0x9E) & (raw[w.start[latin] + 1] != 0x97)
    small = (raw >= 97) & (raw <= 122)
    small[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0xA0)
    smalls = np.concatenate([[0], np.cumsum(small)])
    name = capital & (smalls[w.end] > smalls[w.start]) & ~begins & ~number & ~unit
    form = plain.copy()
    form[number], form[name], form[unit] = _NUMBER, _NAME, _UNIT
    return w, plain, form, number | name | unit


def spots(rows: DataFrame, sizes: list[int] | None, screen: np.ndarray | None) -> DataFrame:
    """(id, pos, total, hash, slots, size) of the template windows of rows (id, text).

    With sizes None a text's windows have WINDOW words, or all it has if fewer; else each size is tried. Windows of fewer than
    SHORTEST words are whole texts only. Windows of placeholders for the most part are left out; total is the number of windows
    kept. slots are hashes of what the placeholders stand for. With a screen only windows whose bit is set are returned.
    """
    shared = None if screen is None else rows.sparkSession.sparkContext.broadcast(screen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in words.chunks(batch.column(1)):
                w, plain, form, slot = templates(chunk)
                size_of = np.diff(w.first)
                filled = np.concatenate([[0], np.cumsum(slot)])
                for k in range(1, WINDOW + 1) if sizes is None else sizes:
                    if len(form) < k:
                        continue
                    n = len(form) - k + 1
                    h = np.full(n, k, np.uint64)
                    for j in range(k):
                        h += form[j : j + n] * words._ORDER[j]
                    h = words.mix(h)
                    row = w.row[:n]
                    ok = (row == w.row[k - 1 :]) & (2 * (filled[k:] - filled[:n]) <= k)
                    if k < SHORTEST or (sizes is None and k < WINDOW):
                        ok &= size_of[row] == k
                    total = np.bincount(row[ok], minlength=len(chunk))
                    if shared is not None:
                        bit = (h % np.uint64(SCREEN)).astype(np.int64)
                        ok &= ((shared.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(bool)
                    at = np.flatnonzero(ok)
                    if not len(at):
                        continue
                    own = [plain[i : i + k][slot[i : i + k]].view(np.int64).tolist() for i in at]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[chunk.first + row[at]], pa.int64()), pa.array(at - w.first[row[at]], pa.int64()),
                                                      pa.array(total[row[at]], pa.int64()), pa.array(h[at].view(np.int64)), pa.array(own, pa.list_(pa.int64())),
                                                      pa.array(np.full(len(at), k), pa.int32())],
                                                     schema=_SPOT)

    return rows.mapInArrow(run, _SPOT_DDL)


def _screen(hashes: DataFrame) -> np.ndarray:
    """Bitmap of the hashes, 2 MB whatever their number."""

    def bits(t: pa.Table) -> pa.Table:
        flags = np.zeros(SCREEN_SLICE, bool)
        flags[t.column("bit").to_numpy() % SCREEN_SLICE] = True
        return pa.table({"slice": t.column("slice")[:1], "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    # the low 24 bits of the hash, read as unsigned
    bit = hashes.select(F.col("hash").bitwiseAND(SCREEN - 1).alias("bit")).distinct()
    out = np.zeros(SCREEN // 8, np.uint8)
    for r in bit.withColumn("slice", F.col("bit").bitwiseAND(-SCREEN_SLICE)).groupBy("slice").applyInArrow(bits, "slice bigint, bits binary").collect():
        out[r["slice"] // 8 : (r["slice"] + SCREEN_SLICE) // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, matched, windows, coverage, reworded) for each document that holds a benchmark item.

    Whole texts are canonicalised and cut into windows of 8 words (items with 3 to 7 words are one window; which of
    these sizes are looked for follows from the items' own windows). Items of one or two words are found where they are the
    whole text of a document, so that common words leave other documents alone. Windows
    meet by hash in an ordinary join, after a bitmap of fixed size has sorted out nearly all that meet nothing. Matches
    of one document and item are lined up by the distance of their positions; along one line each slot value of the
    item must stand for one value in the document, else the line does not count. A pair is returned when the lines
    that hold cover `coverage` of the item's windows; reworded says that some slot value differs from the item's.
    Items without words or of placeholders for the most part, and NULL or empty texts match nothing. Equal items each
    match; repeated rows of a document or item count once; rows without an id are left out. Other columns are ignored. Texts
    are read once: windows of items, and windows that met, are written below spark.checkpoint.dir.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null and text is not null")
    items = (benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
             .where("id is not null and text is not null"))
    path = storage.run_dir(docs.sparkSession, "leaks")
    item = storage.kept(spots(items, None, None).distinct(), f"{path}/items")
    kept = item.select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), F.col("total").alias("windows"), "hash",
                       F.col("slots").alias("item_slots"))
    sizes = sorted(r["size"] for r in item.select("size").distinct().collect())  # at most WINDOW of them
    found = spots(rows, sizes, _screen(item)).select(F.col("id").alias("doc_id"), "pos", "hash", "slots")
    met = found.join(kept, "hash").where(F.size("slots") == F.size("item_slots")).withColumn("line", F.col("pos") - F.col("item_pos"))
    met = storage.kept(met, f"{path}/met")
    line = ["doc_id", "item_id", "line"]
    slot = met.select(*line, F.explode(F.arrays_zip("item_slots", "slots")).alias("s")).where("s.item_slots is not null")
    torn = (slot.groupBy(*line, "s.item_slots").agg(F.min("s.slots").alias("lo"), F.max("s.slots").alias("hi"))
            .groupBy(*line).agg(F.max(F.expr("lo != hi")).alias("torn"), F.max(F.expr("item_slots != lo or item_slots != hi")).alias("reworded")))
    spread = met.groupBy(*line, "item_pos").agg(F.max("windows").alias("windows")).groupBy(*line).agg(
        F.collect_set("item_pos").alias("at"), F.max("windows").alias("windows"))
    holds = spread.join(torn, line, "left").where("not coalesce(torn, false)")
    pairs = holds.groupBy("doc_id", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("matched"),
                                                   F.max("windows").alias("windows"), F.coalesce(F.max("reworded"), F.lit(False)).alias("reworded"))
    return (pairs.withColumn("coverage", F.col("matched") / F.col("windows")).where(F.col("coverage") >= coverage)
            .select("doc_id", "item_id", "matched", "windows", "coverage", "reworded"))
