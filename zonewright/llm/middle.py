"""Fill-in-middle transformation of whole texts, cut between lines.

Texts stay UTF-8 bytes. For each chunk of texts a sparse index records only the multibyte characters: where they begin
and how many bytes they have beyond the first. A search in it turns byte cuts into code-point cuts and back; between
two entries both differ by a constant, so spans of ASCII need no table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zonewright.llm import words

# fixed values: the marks of the parts
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_MADE = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                   ("output", pa.string()), ("restored_sha256", pa.string())])
_MADE_DDL = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored_sha256 string"


@dataclass
class Exceptions:
    """Multibyte characters of some UTF-8 bytes: first byte and code point of each, and excess bytes up to each, itself included."""

    byte: np.ndarray
    point: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> Exceptions:
        byte = np.flatnonzero(data >= 0xC0)
        lead = data[byte]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        excess = np.cumsum(extra)
        return cls(byte, byte - (excess - extra), excess)

    def _before(self, at: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Excess bytes of all entries that begin before each cut."""
        n = np.searchsorted(at, cuts, "left")
        return np.where(n > 0, self.excess[n - 1], 0) if len(at) else np.zeros(len(cuts), np.int64)

    def points(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut; a cut must not be inside a character."""
        return cuts - self._before(self.byte, cuts)

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self._before(self.point, cuts)


def line_ends(chunk: words.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Byte after each line of the chunk, and the number of the first line of each row (one more at the end).

    A line ends with its newline, or with the text. An empty text has none.
    """
    last = chunk.offsets[1:][np.diff(chunk.offsets) > 0]
    ends = np.unique(np.concatenate([np.flatnonzero(chunk.data == 0x0A) + 1, last]))
    return ends, np.searchsorted(ends, chunk.offsets, "right")


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """First four 32-bit numbers of the SHA-256 of seed and doc_id; no doc_id counts as an empty one."""
    raw = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(raw[i : i + 4], "big") for i in range(0, 16, 4))


def joined(prefix: bytes, middle: bytes, suffix: bytes, form: str) -> bytes:
    if form == PSM:
        return b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    return b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])


def restored(output: bytes, form: str) -> bytes:
    """The text again, from the output and its form alone. The marks stand once each, as texts that hold one stay plain."""
    if form == PLAIN:
        return output
    if form == PSM:
        prefix, rest = output[len(PREFIX) :].split(SUFFIX)
        suffix, middle = rest.split(MIDDLE)
    else:
        suffix, rest = output[len(SUFFIX) :].split(PREFIX)
        prefix, middle = rest.split(MIDDLE)
    return prefix + middle + suffix


def transform(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """doc_id and, for each row, n (lines), form, prefix_chars, middle_chars, output (the text so arranged), restored_sha256.

    The prefix ends after the lesser and the middle after the greater of two line numbers drawn from seed and doc_id, from 0
    to n. Form: plain (the text as it is) for empty and NULL texts, texts that hold a mark, and all but `percent` of the rest;
    else spm for `spm_percent` of them, else psm. Character counts are code points, NULL where plain. restored_sha256 is that of the
    text rebuilt from output and form. One row per input row; rows that share a doc_id are cut by the same draws, rows
    without one by those of an empty id. Texts of any length are cut as a whole, a few MB of short ones at a time. Other columns
    are ignored, whatever their names; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in words.chunks(batch.column(1)):
                rows = []
                index = Exceptions.of(chunk.data)
                ends, first = line_ends(chunk)
                for r in range(len(chunk)):
                    begin, end = int(chunk.offsets[r]), int(chunk.offsets[r + 1])
                    text = chunk.data[begin:end].tobytes()
                    n = int(first[r + 1] - first[r])
                    h1, h2, h3, h4 = draws(ids[chunk.first + r], seed)
                    if not text or h3 % 100 >= percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                        rows.append((n, PLAIN, None, None, text.decode(), hashlib.sha256(restored(text, PLAIN)).hexdigest()))
                        continue
                    form = SPM if h4 % 100 < spm_percent else PSM
                    units = sorted((h1 % (n + 1), h2 % (n + 1)))
                    cuts = np.array([begin, *(int(ends[first[r] + u - 1]) if u else begin for u in units)], np.int64)
                    points = index.points(cuts)
                    a, b = (int(c) - begin for c in cuts[1:])
                    output = joined(text[:a], text[a:b], text[b:], form)
                    rows.append((n, form, int(points[1] - points[0]), int(points[2] - points[1]), output.decode(),
                                 hashlib.sha256(restored(output, form)).hexdigest()))
                made = [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(_MADE)]
                own = batch.column(0).slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([own, *made], names=["doc_id", *_MADE.names])

    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return light.mapInArrow(run, f"doc_id bigint, {_MADE_DDL}")
