"""Words and shingles of Arrow text columns, hashed with numpy over the UTF-8 bytes.

Texts are handled in chunks of a few MB, so memory follows the chunk and the longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit values."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_ODD = 0xD6E8FEB86659FD93
_ORDER = mix(np.arange(1, 65, dtype=_U) * _U(0xA24BAED4963EE407)) | _U(1)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK)
        for slot, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[slot] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Chunk:
    """Some rows of a batch: their bytes, and offsets of each row in them."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(col: pa.Array | pa.ChunkedArray, size: int = CHUNK) -> Iterator[Chunk]:
    """Rows in pieces of about `size` bytes; NULL counts as an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    if not len(col):
        return
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        end = min(end, len(col))
        yield Chunk(at, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at])
        at = end


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True


def letter_gaps(data: np.ndarray) -> np.ndarray:
    """Flags of the bytes between words of letters and digits: other ASCII, U+0080 to U+00BF and U+2000 to U+203F."""
    gap = ~ALNUM[data]
    lead = np.flatnonzero((data[:-1] == 0xC2) & (data[1:] >= 0x80))
    gap[lead] = gap[lead + 1] = True
    lead = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
    gap[lead] = gap[lead + 1] = gap[lead + 2] = True
    return gap


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the capitals of Latin-1 in lower case."""
    out = ASCII_LOWER[data]
    if len(out) > 1:
        up = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[up] += 0x20
    return out


@dataclass
class Words:
    """Start, end and row of each word, and the number of its first word for each row (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray


def split(chunk: Chunk, gap: np.ndarray) -> Words:
    """Words: maximal runs of bytes where `gap` (one flag per byte) is false; none spans two rows."""
    n = len(chunk.data)
    word = ~gap
    begin = word.copy()
    begin[1:] &= gap[:-1]
    cuts = chunk.offsets[1:-1]
    cuts = cuts[cuts < n]
    begin[cuts] = word[cuts]
    stop = word.copy()
    stop[:-1] &= gap[1:]
    ends = cuts[cuts > 0] - 1
    stop[ends] = word[ends]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    first = np.searchsorted(start, chunk.offsets)
    row = np.repeat(np.arange(len(chunk)), np.diff(first))
    return Words(start, end, row, first)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, the same wherever the range stands."""
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def order(j: int) -> np.uint64:
    """Odd factor of the word at place j of a gram."""
    return _ORDER[j]


def shingles(words: Words, word_hash: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k-word shingle and its row; a row with fewer words, but some, has its whole sequence as one."""
    n = len(word_hash)
    count = np.diff(words.first)
    parts, rows = [], []
    if n >= k:
        whole = np.zeros(n - k + 1, _U)
        for j in range(k):
            whole += word_hash[j : n - k + 1 + j] * _ORDER[j]
        same = words.row[: n - k + 1] == words.row[k - 1 :]
        parts.append(mix(whole[same]))
        rows.append(words.row[: n - k + 1][same])
    for m in range(1, k):
        few = np.flatnonzero(count == m)
        if len(few):
            at = words.first[few]
            whole = np.full(len(few), m, _U)
            for j in range(m):
                whole += word_hash[at + j] * _ORDER[j]
            parts.append(mix(whole))
            rows.append(few)
    if not parts:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    got, row = np.concatenate(parts), np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return got[order], row[order]


def shingle_sets(col: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles: A-Z lower-cased, words between white space."""
    for chunk in chunks(col):
        data = ASCII_LOWER[chunk.data]
        words = split(chunk, SPACE[data])
        got, row = shingles(words, hashes(data, words.start, words.end), k)
        bounds = np.searchsorted(row, np.arange(len(chunk) + 1))
        for i in range(len(chunk)):
            yield np.unique(got[bounds[i] : bounds[i + 1]])


def rows_of(batch: pa.RecordBatch | pa.Table, names: list[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]
