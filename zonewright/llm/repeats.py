"""Removal of passages that stand in an earlier document too, by seed and extend.

Seeds: of each `length` words in a row the k-word gram with the least hash is an anchor, so two equal passages of `length` words
share one at the same place. Documents are joined on anchors, each occurrence with the first one only (in the document with the
least doc_id), so a passage of n documents gives n seeds. Seeds that follow each other at the same distance in both
documents overlap (k is at least half of `length`), and so chain to a match known word for word.

Both ends of a chain are extended through the windows that stick out of it: their hashes are asked of the partner, and
compared with those of all other documents whose chains end there; so a passage is also found where the first document that
has its anchor goes on otherwise. What is covered by matches of `length` words or more, merged, are the maximal repeats.

Occurrences are ordered by range over anchor and document, and read as a stream that holds one row: an anchor of any
number of documents is split, and what its rows need from earlier ranges is at most two rows a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zonewright.llm import storage, words

BLOCK_ROWS = 1 << 16
SPAN, OWN, ASKED = 0, 1, 2
_AT = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("own", pa.bool_())])
_FIRST = pa.schema([("mark", pa.bool_()), ("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("e_doc", pa.int64()), ("e_at", pa.int64())])
_RANGE = pa.schema([("doc", pa.int64()), ("fp", pa.int32()), ("kind", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("repeats", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def grams(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    whole = np.zeros(n, np.uint64)
    for j in range(k):
        whole += word_hash[j : j + n] * words.order(j)
    return words.mix(whole)


def winnowed(gram: np.ndarray, row: np.ndarray, k: int, length: int) -> np.ndarray:
    """Places of the anchors: for each `length` words of one row the first of the grams with the least hash."""
    n = len(row) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    inside = np.flatnonzero(row[:n] == row[length - 1 :])
    best, least = inside.copy(), gram[inside]
    for j in range(1, length - k + 1):
        less = gram[inside + j] < least
        least[less] = gram[inside + j][less]
        best[less] = inside[less] + j
    return np.unique(best)


def anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(key, doc, at, own): hash and place of each anchor. at: hash of the whole text in the upper half, number of the word in the lower."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fp = (batch.column(i).to_numpy() for i in range(2))
            for chunk in words.chunks(batch.column(2)):
                w = words.split(chunk, words.SPACE[chunk.data])
                gram = grams(words.hashes(chunk.data, w.start, w.end), k)
                at = winnowed(gram, w.row, k, length)
                row = w.row[at]
                place = (fp[chunk.first + row].astype(np.int64) << 32) | (at - w.first[row])
                yield pa.RecordBatch.from_arrays([pa.array(gram[at].view(np.int64)), pa.array(ids[chunk.first + row]), pa.array(place), pa.array(np.ones(len(at), bool))], schema=_AT)

    return docs.where("doc_id is not null").select("doc_id", "fp", "text").mapInArrow(run, _ddl(_AT))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of some batches at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]
            held = []
    if sum(b.num_rows for b in held):
        yield [c.to_numpy() for c in pa.Table.from_batches(held).columns]


def firsts(places: DataFrame, path: str) -> DataFrame:
    """(doc, at, e_doc, e_at) of each distinct place (key, doc, at, own) marked as own but the first of its key: that one's document and place.

    The rows are dealt out in ranges of (key, doc, at), so a key may cover many tasks. A task knows the first row of every key but that
    of its first key, which may have begun in an earlier one; those rows wait until the marks of all tasks, two of each, say where it began; the marks are broadcast.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = first = last = None  # the task's first key; the row its present key begins with; the row before
        for key, doc, at, own in _blocks(batches):
            begin = np.ones(len(key), bool)
            begin[1:] = key[1:] != key[:-1]
            again = np.zeros(len(key), bool)
            again[1:] = ~begin[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1]) & (own[1:] <= own[:-1])
            if first is None:
                head = int(key[0])
                yield _marked(True, [head], [int(doc[0])], [int(at[0])])
            else:
                begin[0] = key[0] != first[0]
                again[0] = (int(key[0]), int(doc[0]), int(at[0])) == last[:3] and own[0] <= last[3]
            run_of, start = np.cumsum(begin) - 1, np.flatnonzero(begin)
            e_doc, e_at = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
            old = run_of < 0
            if old.any():
                e_doc[old], e_at[old] = first[1], first[2]
            e_doc[~old], e_at[~old] = doc[start[run_of[~old]]], at[start[run_of[~old]]]
            open_ = key == head
            told = own & ~again & (open_ | (doc != e_doc) | (at != e_at))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(int(told.sum()), bool)), pa.array(key[told], mask=~open_[told]), *(pa.array(c[told]) for c in (doc, at, e_doc, e_at))],
                                             schema=_FIRST)
            first, last = (int(key[-1]), int(e_doc[-1]), int(e_at[-1])), (int(key[-1]), int(doc[-1]), int(at[-1]), bool(own[-1]))
        if first is not None:
            yield _marked(True, [first[0]], [first[1]], [first[2]])

    order = ["key", "doc", "at"]
    sorted_ = places.repartitionByRange(*order).sortWithinPartitions(*order, F.desc("own"))
    found = storage.kept(sorted_.select(*order, "own").mapInArrow(run, _ddl(_FIRST)), path)
    # at most two rows a task
    begun = found.where("mark").groupBy("key").agg(F.min(F.struct("e_doc", "e_at")).alias("e")).select("key", "e.*").orderBy("key").collect()
    shared = places.sparkSession.sparkContext.broadcast(np.array([tuple(r) for r in begun], np.int64).reshape(len(begun), 3).T.copy())

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, ats = shared.value
        for batch in batches:
            doc, at, e_doc, e_at = (batch.column(i).to_numpy() for i in range(1, 5))
            wait = np.flatnonzero(~batch.column(0).is_null().to_numpy(zero_copy_only=False))
            of = np.searchsorted(keys, batch.column(0).fill_null(0).to_numpy()[wait])
            e_doc, e_at = e_doc.copy(), e_at.copy()
            e_doc[wait], e_at[wait] = docs[of], ats[of]
            later = (doc != e_doc) | (at != e_at)
            yield pa.RecordBatch.from_arrays([pa.array(c[later]) for c in (doc, at, e_doc, e_at)], names=["doc", "at", "e_doc", "e_at"])

    return found.where("not mark").select("key", "doc", "at", "e_doc", "e_at").mapInArrow(settle, "doc bigint, at bigint, e_doc bigint, e_at bigint")


def _marked(mark: bool, key: list[int], doc: list[int], at: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([mark] * len(key)), *(pa.array(c, pa.int64()) for c in (key, doc, at, doc, at))], schema=_FIRST)


def chains(seeds: DataFrame, length: int, k: int) -> DataFrame:
    """(doc, fp, kind, lo, hi) of the chains of seeds (doc, at, e_doc, e_at): SPAN words lo to hi, matched; OWN windows from
    lo to hi, to be compared, and ASKED ones of the partner.

    Seeds chain where the next is at most k words on, and as far on in the partner. Seeds whose first occurrence is in the same document
    match nothing earlier, but other documents may match them by their windows.
    """
    reach = length - k

    def ranges(doc: np.ndarray, at: np.ndarray, end: np.ndarray, e_doc: np.ndarray, e_at: np.ndarray) -> pa.RecordBatch:
        """From the first and last seed of each chain."""
        fp, a, b = (at >> 32).astype(np.int32), at & 0xFFFFFFFF, (end & 0xFFFFFFFF) + k
        e_fp, shift = (e_at >> 32).astype(np.int32), (e_at & 0xFFFFFFFF) - a
        other = e_doc != doc
        long = other & (b - a >= length)
        lo = np.concatenate([a - reach, (b - length + 1)[long]])
        hi = np.concatenate([np.where(long, a - 1, b - k), (b - k)[long]])
        every = np.concatenate([np.arange(len(a)), np.flatnonzero(long)])
        ask = other[every]
        parts = [(doc[long], fp[long], SPAN, a[long], b[long]), (doc[every], fp[every], OWN, lo, hi),
                 (e_doc[every][ask], e_fp[every][ask], ASKED, (lo + shift[every])[ask], (hi + shift[every])[ask])]
        cols = [[p[0] for p in parts], [p[1] for p in parts], [np.full(len(p[0]), p[2]) for p in parts], [p[3] for p in parts], [p[4] for p in parts]]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(f.type.to_pandas_dtype())) for c, f in zip(cols, _RANGE)], schema=_RANGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # first and last seed of the chain that is still open
        for block in _blocks(batches):
            if held is not None:
                block = [np.concatenate([h, c]) for h, c in zip(held, block)]
            doc, at, e_doc, e_at = block
            step, own = at[1:] - at[:-1], e_doc == doc
            on = (doc[1:] == doc[:-1]) & (step >= 0) & (step <= k) & (e_doc[1:] == e_doc[:-1]) & (own[1:] | (e_at[1:] - e_at[:-1] == step))
            if held is not None and len(held[0]) == 2:
                on[0] = True
            start = np.flatnonzero(np.concatenate([[True], ~on]))
            stop = np.append(start[1:], len(doc)) - 1
            done = slice(0, len(start) - 1)
            yield ranges(doc[start[done]], at[start[done]], at[stop[done]], e_doc[start[done]], e_at[start[done]])
            ends = [start[-1]] if start[-1] == stop[-1] else [start[-1], stop[-1]]
            held = [c[ends] for c in block]
        if held is not None:
            doc, at, e_doc, e_at = held
            yield ranges(doc[:1], at[:1], at[-1:], e_doc[:1], e_at[:1])

    by_doc = seeds.repartition("doc", F.shiftright("at", 32)).sortWithinPartitions("doc", "at")
    return by_doc.select("doc", "at", "e_doc", "e_at").mapInArrow(run, _ddl(_RANGE))


def _covered(lists: pa.ListArray, chunk: words.Chunk, w: words.Words, kinds: tuple[int, ...], last: int) -> np.ndarray:
    """Flags of the words from lo to hi, less `last` words at the end of each row, of the ranges of some kinds."""
    part = lists.slice(chunk.first, len(chunk))
    of = np.repeat(np.arange(len(chunk)), part.value_lengths().fill_null(0).to_numpy())
    kind, lo, hi = (part.flatten().field(i).to_numpy() for i in range(3))
    pick = np.isin(kind, kinds)
    of, lo, hi = of[pick], lo[pick].astype(np.int64), hi[pick].astype(np.int64)
    base, size = w.first[of], w.first[of + 1] - w.first[of] - last
    lo, hi = np.maximum(lo, 0), np.minimum(hi + 1, size)
    ok = lo < hi
    step = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(step, (base + lo)[ok], 1)
    np.add.at(step, (base + hi)[ok], -1)
    return np.cumsum(step[:-1]) > 0


def windows(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """(key, doc, at, own) of the windows that are to be compared: hash, document and first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fp = (batch.column(i).to_numpy() for i in range(2))
            for chunk in words.chunks(batch.column(2)):
                w = words.split(chunk, words.SPACE[chunk.data])
                gram = grams(words.hashes(chunk.data, w.start, w.end), length)
                own = _covered(batch.column(3), chunk, w, (OWN,), length - 1)
                at = np.flatnonzero(own | _covered(batch.column(3), chunk, w, (ASKED,), length - 1))
                row = w.row[at]
                place = (fp[chunk.first + row].astype(np.int64) << 32) | (at - w.first[row])
                yield pa.RecordBatch.from_arrays([pa.array(gram[at].view(np.int64)), pa.array(ids[chunk.first + row]), pa.array(place), pa.array(own[at])], schema=_AT)

    lists = asked.groupBy(F.col("doc").alias("doc_id"), "fp").agg(F.collect_set(F.struct("kind", "lo", "hi")).alias("asked"))
    return docs.join(lists, ["doc_id", "fp"]).select("doc_id", "fp", "text", "asked").mapInArrow(run, _ddl(_AT))


def _with_fingerprint(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("fp"), text.alias("text"))


def repeats(docs: DataFrame, length: int = 13, k: int = 7) -> DataFrame:
    """(doc_id, fp, lo, hi): words lo to hi - 1 of a text, `length` or more, that stand in a document with a smaller doc_id. They may overlap.

    fp: hash of the text, which tells rows with the same doc_id apart; equal rows have one result. See remove() for the rest.
    """
    if not 0 < k <= length < 2 * k + 1:
        raise ValueError("anchors must have at least half the words of a passage")
    path = storage.run_dir(docs.sparkSession, "repeats")
    docs = _with_fingerprint(docs)
    seeds = firsts(storage.kept(anchors(docs, length, k), f"{path}/anchors"), f"{path}/seeds")
    found = storage.kept(chains(seeds, length, k), f"{path}/chains")
    places = storage.kept(windows(docs, found.where(f"kind != {SPAN}"), length), f"{path}/windows")
    later = firsts(places, f"{path}/compared").where("e_doc < doc")
    lo = F.col("at").bitwiseAND(0xFFFFFFFF).cast("int")
    ends = later.select(F.col("doc").alias("doc_id"), F.shiftright("at", 32).cast("int").alias("fp"), lo.alias("lo"), (lo + length).alias("hi"))
    return found.where(f"kind = {SPAN}").select(F.col("doc").alias("doc_id"), "fp", "lo", "hi").unionByName(ends)


def remove(docs: DataFrame, length: int = 13, k: int = 7) -> DataFrame:
    """doc_id, text (the words that stay, joined by one space), n_words, n_removed, repeats (start, end): one row per input row.

    A word goes if it is in `length` words in a row that also stand, unchanged, in a document with a smaller doc_id, be it in words that go
    there themselves. Words are whatever is between ASCII white space, compared as they are, by 64-bit hashes. repeats are the longest runs of
    words removed, in order. Copies with the same doc_id do not count against each other; rows without doc_id lose nothing and take nothing.
    NULL, empty and blank texts have no words and stay as ''; texts of any length are handled whole, in chunks of a few MB of short
    ones. Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    spans = repeats(docs, length, k).groupBy("doc_id", "fp").agg(F.collect_list(F.struct(F.lit(SPAN).alias("kind"), "lo", (F.col("hi") - 1).alias("hi"))).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words.chunks(batch.column(1)):
                w = words.split(chunk, words.SPACE[chunk.data])
                gone = _covered(batch.column(2), chunk, w, (SPAN,), 0)
                kept = np.flatnonzero(~gone)
                data, take = chunk.data.copy(), np.zeros(len(chunk.data) + 1, np.int64)
                np.add.at(take, w.start[kept], 1)
                np.add.at(take, w.end[kept], -1)
                take = np.cumsum(take[:-1]) > 0
                after = w.end[kept[:-1]][w.row[kept[1:]] == w.row[kept[:-1]]]
                data[after] = 0x20
                take[after] = True
                offsets = np.concatenate([[0], np.cumsum(take)])[chunk.offsets].astype(np.int32)
                text = pa.StringArray.from_buffers(len(chunk), pa.py_buffer(offsets), pa.py_buffer(data[take].tobytes()))
                begin = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1] | (w.row[1:] != w.row[:-1])])[: len(gone)])
                end = np.flatnonzero(gone & np.concatenate([~gone[1:] | (w.row[1:] != w.row[:-1]), [True]])[: len(gone)]) + 1
                row = w.row[begin]
                runs = pa.StructArray.from_arrays([pa.array((x - w.first[row]).astype(np.int32)) for x in (begin, end)], names=["start", "end"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(chunk) + 1)).astype(np.int32)), runs)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, len(chunk)), text, pa.array(np.diff(w.first)),
                                                  pa.array(np.bincount(w.row[gone], minlength=len(chunk))), lists], schema=_KEPT)

    joined = _with_fingerprint(docs).join(spans, ["doc_id", "fp"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id bigint, text string, n_words bigint, n_removed bigint, repeats array<struct<start: int, end: int>>")
