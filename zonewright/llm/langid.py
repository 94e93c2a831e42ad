"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from zonewright.llm import words

BUCKETS = 1 << 15
GRAMS = (1, 2, 3)
SMOOTHING = 0.5
MODEL_BYTES = 256 << 20
UNKNOWN = "und"

_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves `remainder`; a NULL id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each character n-gram of the lower-cased texts, and the text it is of."""
    points = [_points(t) for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    all_points = np.concatenate(points) if points else np.zeros(0, np.uint64)
    parts, rows = [], []
    for n in GRAMS:
        if len(all_points) < n:
            continue
        h = np.full(len(all_points) - n + 1, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + all_points[j : len(all_points) - n + 1 + j]
        same = row[: len(h)] == row[n - 1 :]
        parts.append((words.mix(h[same]) % np.uint64(BUCKETS)).astype(np.int32))
        rows.append(row[: len(h)][same])
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(rows)


def _some(texts: list[str | None], size: int = 1 << 19) -> Iterator[list[str]]:
    """The texts in runs of about `size` characters."""
    run, held = [], 0
    for t in texts:
        run.append(t or "")
        held += len(run[-1])
        if held > size:
            yield run
            run, held = [], 0
    if run:
        yield run


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log-probability of each bucket, with the log prior as last column.

    Counts cover all rows with a text and a lang. Each task adds up its own counts, so at most languages x buckets
    rows per task are shuffled. The matrix is the only thing that reaches the driver; it follows the number of
    languages, not of rows, and a ValueError is raised where it would exceed MODEL_BYTES.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, np.ndarray] = {}
        for batch in batches:
            text, lang = (batch.column(i).to_pylist() for i in range(2))
            by_lang: dict[str, list[str]] = {}
            for t, name in zip(text, lang):
                by_lang.setdefault(name, []).append(t)
            for name, own in by_lang.items():
                counts = table.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                counts[-1] += len(own)
                for run in _some(own):
                    counts[:-1] += np.bincount(grams(run)[0], minlength=BUCKETS)
        for name, counts in table.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                                             names=["lang", "bucket", "n"])

    counted = (docs.where("text is not null and lang is not null").select("text", "lang")
               .mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    packed = counted.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("c"))
    found = packed.take(MODEL_BYTES // (8 * BUCKETS) + 1)
    if len(found) > MODEL_BYTES // (8 * BUCKETS):
        raise ValueError("too many languages for a model that every executor holds")
    found.sort(key=lambda r: r["lang"])
    counts = np.zeros((len(found), BUCKETS + 1))
    for i, r in enumerate(found):
        at = np.array([x["bucket"] for x in r["c"]])
        counts[i, at] = [x["n"] for x in r["c"]]
    logs = np.log(counts[:, :-1] + SMOOTHING) - np.log((counts[:, :-1] + SMOOTHING).sum(1, keepdims=True))
    prior = np.log(counts[:, -1:]) - np.log(counts[:, -1:].sum()) if len(found) else counts[:, -1:]
    return [r["lang"] for r in found], np.hstack([logs, prior])


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of docs (doc_id, text, held_out); see identify()."""
    shared = docs.sparkSession.sparkContext.broadcast((model[0], np.ascontiguousarray(model[1].T)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names, scores = [], []
            for part in _some(texts):
                bucket, row = grams(part)
                total = np.tile(logs[-1], (len(part), 1)) if langs else np.zeros((len(part), 0))
                for j in range(len(langs)):
                    total[:, j] += np.bincount(row, weights=logs[:, j][bucket], minlength=len(part))
                for i, t in enumerate(part):
                    if not langs or not any(map(str.isalpha, t)):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    best = int(total[i].argmax())
                    names.append(langs[best])
                    scores.append(float(1 / np.exp(total[i] - total[i, best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             schema=_SCORED)

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """Language of each whole text, learned from the rows that are not held out.

    Counts of character 1- to 3-grams, hashed into 2^15 buckets, give a matrix of log-probabilities that is broadcast;
    texts are scored in batches by adding its entries for the n-grams they have. score is the posterior of lang_pred.
    Rows are held out where crc32 of doc_id as text leaves `remainder` by `modulus` (a NULL id counts as empty text).
    A text that is NULL, empty or without any letter gives `und` with score 0, as do all texts when nothing could be
    learned. Ties: the first language by name. Repeated rows count and are returned as often as they occur.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), held_out(F.col("doc_id"), modulus, remainder).alias("held_out"))
    return predict(docs, train(docs.where("not held_out")))
