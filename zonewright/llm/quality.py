"""Text quality from weak labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zonewright.llm import words

TRAIN_ROWS = 6_000
FEATURES = 1 << 11
ROUNDS = 60
STEPS = 200
LABELLERS = ("length", "word_length", "letters", "capitals", "sentences", "repeats", "symbols", "bars")


# fixed values: full stop, exclamation and question mark of full width, in UTF-8
WIDE_STOPS = ("\u3002".encode(), "\uff01".encode(), "\uff1f".encode())


STOP, SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
STOP[list(b".?")] = True
SYMBOL[list(b"!&%#$*@~^<>{}\\")] = True


def _words(chunk: words.Chunk) -> tuple[words.Words, np.ndarray]:
    """Words between white space, each kana or Han character a word of its own, and the number of such characters of each row."""
    raw = chunk.data
    w = words.split(chunk, words.SPACE[raw])
    han = np.flatnonzero((raw >= 0xE3) & (raw <= 0xE9))
    han = han[(raw[han] > 0xE3) | (raw[np.minimum(han + 1, len(raw) - 1)] >= 0x81)]
    wide = np.diff(np.searchsorted(han, chunk.offsets))
    if len(han):
        cuts = np.setdiff1d(np.concatenate([han, han + 3]), np.concatenate([w.start, w.end]))
        start, end = np.sort(np.concatenate([w.start, cuts])), np.sort(np.concatenate([w.end, cuts]))
        first = np.searchsorted(start, chunk.offsets)
        w = words.Words(start, end, np.repeat(np.arange(len(chunk)), np.diff(first)), first)
    return w, wide


def _votes(chunk: words.Chunk, w: words.Words, wide: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Votes of the labellers (0 bad, 1 no vote, 2 good) on each row of a chunk, from counts of characters and words.

    Kana and Han count as half a word each; texts that hold them for a third or more get no vote on the length of words.
    """
    raw, rows = chunk.data, len(chunk)
    begins = (raw & 0xC0) != 0x80  # the first byte of each character
    chars = np.concatenate([[0], np.cumsum(begins)])
    size = np.maximum(chars[chunk.offsets[1:]] - chars[chunk.offsets[:-1]], 1)
    shown = np.diff(w.first)
    count = shown - wide / 2

    def number(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[chunk.offsets[1:]] - total[chunk.offsets[:-1]]

    mean = np.bincount(w.row, weights=chars[w.end] - chars[w.start], minlength=rows) / np.maximum(shown, 1)
    letters = number(begins & words.ALNUM[raw] & ~words.DIGIT[raw]) / size
    capitals = number((raw >= 65) & (raw <= 90)) / size
    ends = STOP[raw]
    if wide.any():
        for mark in WIDE_STOPS:
            at = np.flatnonzero(raw == mark[0])
            at = at[at + 2 < len(raw)]
            ends[at[(raw[at + 1] == mark[1]) & (raw[at + 2] == mark[2])]] = True
    stops = number(ends) / np.maximum(count, 1)
    symbols, bars = number(SYMBOL[raw]) / size, number(raw == 0x7C) / size
    gram = np.zeros(0, np.uint64)
    if len(key) > 4:
        gram = words.mix(key[:-4] * words._ORDER[0] + key[2:-2] * words._ORDER[2] + key[4:] * words._ORDER[4])
    inside = w.row[:-4] == w.row[4:] if len(key) > 4 else np.zeros(0, bool)
    of, gram = w.row[: len(inside)][inside], gram[inside]
    # equal grams of a row meet in one sort of single keys
    once = np.unique(gram ^ words.mix(of.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    fresh = np.bincount(of[once], minlength=rows) / np.maximum(np.bincount(of, minlength=rows), 1)
    long_ = count >= 40
    votes = np.stack([np.where(count < 8, 0, np.where(long_, 2, 1)),
                      np.where(3 * wide >= size, 1, np.where((mean < 2) | (mean > 14), 0, np.where((mean > 3) & (mean < 9), 2, 1))),
                      np.where(letters < 0.6, 0, np.where(letters > 0.75, 2, 1)), np.where(capitals > 0.3, 0, np.where(capitals < 0.1, 2, 1)),
                      np.where(stops < 0.005, 0, np.where((stops > 0.03) & (stops < 0.4), 2, 1)),
                      np.where(long_ & (fresh < 0.6), 0, np.where(long_ & (fresh > 0.9), 2, 1)),
                      np.where(symbols > 0.02, 0, np.where(symbols < 0.002, 2, 1)), np.where(bars > 0.01, 0, np.where(bars == 0, 1, 0))], 1)
    return votes.astype(np.int64)


def _vectors(chunk: words.Chunk, w: words.Words, key: np.ndarray) -> np.ndarray:
    """What the linear scorer sees of each row, of length 1 in all: words, word ends and shapes by hash, not the labellers' values."""
    raw, rows = chunk.data, len(chunk)
    upper = (raw >= 65) & (raw <= 90)
    last, first = raw[w.end - 1].astype(np.uint64), raw[w.start].astype(np.uint64)
    shape = words.mix(last * np.uint64(1 << 20) + np.minimum(w.end - w.start, 20).astype(np.uint64) * np.uint64(1 << 10)
                      + words.DIGIT[first.astype(np.int64)] * np.uint64(2) + upper[w.start] * np.uint64(4) + upper[np.maximum(w.end - 2, w.start)] * np.uint64(8))
    dims = np.concatenate([shape % np.uint64(FEATURES), key % np.uint64(FEATURES)]).astype(np.int64)
    x = np.bincount(np.concatenate([w.row, w.row]) * FEATURES + dims, minlength=rows * FEATURES).reshape(rows, FEATURES).astype(np.float32)
    x = np.log1p(x)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _read(chunk: words.Chunk, vectors: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Vote patterns and, if asked for, vectors of the rows of a chunk."""
    w, wide = _words(chunk)
    key = words.hashes(words.lowered(chunk.data), w.start, w.end)
    return pattern_of(_votes(chunk, w, wide, key)), _vectors(chunk, w, key) if vectors else None


def pattern_of(votes: np.ndarray) -> np.ndarray:
    return votes @ 3 ** np.arange(votes.shape[1])


def accuracies(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over counts of vote patterns: chance of each vote under bad and good texts (class, labeller, vote) and share of good."""
    patterns = np.array(sorted(counts), np.int64)
    n = np.array([counts[p] for p in patterns.tolist()], float)
    votes = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    good = np.clip(0.5 + ((votes == 2).sum(1) - 2 * (votes == 0).sum(1)) / (2 * len(LABELLERS)), 0.02, 0.98)  # most labellers beat chance
    for _ in range(ROUNDS):
        weight = np.stack([n * (1 - good), n * good])
        prior = float(np.clip(weight[1].sum() / max(n.sum(), 1), 0.02, 0.98))
        chance = np.stack([np.stack([((votes == v) * w[:, None]).sum(0) + 1 for v in range(3)], 1) for w in weight])
        chance /= chance.sum(2, keepdims=True)
        logs = np.log(chance)[:, np.arange(len(LABELLERS)), votes].sum(2)
        good = 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + np.log(1 - prior) - np.log(prior), -50, 50)))
    return patterns, good, prior


def score(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, weak_label, score, keep) of each whole text; no label of the tables is read.

    Eight heuristics vote good, bad or nothing (`bars` never good) on counts of characters and words, so that scripts of several
    bytes a character are judged alike; texts without spaces are read by character. Patterns of votes are counted over all texts (3^8 at most), and EM on the
    counts estimates how often each heuristic is right and so the posterior of each pattern, weak_label. A linear
    scorer on hashed word features is trained on those posteriors, on at most `train_rows` different texts (those of least hash),
    and gives score; keep is score >= 0.5. NULL and empty texts vote too (as too short). An empty table gives no
    rows. Repeated rows count as often as they occur; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            for chunk in _small(batch.column(1)):
                for p in _read(chunk, False)[0].tolist():
                    counts[p] = counts.get(p, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["pattern", "n"])

    counted = docs.mapInArrow(vote, "pattern int, n bigint").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return spark.createDataFrame([], "doc_id long, weak_label double, score double, keep boolean")
    patterns, good, _ = accuracies({r["pattern"]: r["n"] for r in counted})
    label = dict(zip(patterns.tolist(), good.tolist()))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # at most train_rows keys
        for batch in batches:
            keys = batch.column(0).to_pylist()
            fresh = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
            batch = batch.take(pa.array(fresh, pa.int64()))
            for chunk in _small(batch.column(1)):
                p, x = _read(chunk, True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, len(chunk)), pa.array(p, pa.int32()),
                                                  pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], names=["k", "p", "x"])

    # each text once, however often it occurs; equal texts have equal vectors
    keyed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"), "text")
    edge = keyed.select("k").distinct().orderBy("k").limit(train_rows).agg(F.max("k")).first()[0]
    sample = keyed.where(F.col("k") <= edge).mapInArrow(describe, "k bigint, p int, x binary").dropDuplicates(["k"]).orderBy("k").collect()
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in sample]).astype(np.float32)
    y = np.array([label[r["p"]] for r in sample], np.float32)
    weights, bias, speed = np.zeros(FEATURES, np.float32), 0.0, np.zeros(FEATURES, np.float32)
    for _ in range(STEPS):
        off = 1 / (1 + np.exp(-(x @ weights + bias))) - y
        speed = 0.9 * speed + x.T @ off / len(y) + 1e-5 * weights
        weights, bias = weights - 4 * speed, bias - 2 * float(off.mean())
    shared = spark.sparkContext.broadcast((weights, bias))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in batches:
            for chunk in _small(batch.column(1)):
                pattern, x = _read(chunk, True)
                p = 1 / (1 + np.exp(-(x @ w + b).astype(float)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, len(chunk)), pa.array([label[v] for v in pattern.tolist()]),
                                                  pa.array(p), pa.array(p >= 0.5)], names=["doc_id", "weak_label", "score", "keep"])

    return docs.mapInArrow(apply, "doc_id bigint, weak_label double, score double, keep boolean")


def _small(col: pa.Array) -> Iterator[words.Chunk]:
    """Chunks of at most 512 rows, so that dense features stay small."""
    for at in range(0, len(col), 512):
        for chunk in words.chunks(col.slice(at, 512)):
            yield words.Chunk(at + chunk.first, chunk.data, chunk.offsets)
