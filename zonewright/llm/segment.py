"""N-best SentencePiece segmentation: forward Viterbi scores guide a backward A* search over the piece lattice."""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from zonewright.llm import words

NEVER = -1e300
LONG = 40
STORE = 800_000
CHUNK = 1 << 21
_MULT = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = ("doc_id bigint, ids array<int>, score double, decoded boolean, "
          "others array<struct<rank:int, score:double, changes:array<struct<at:int, drop:int, ids:array<int>>>>>")
_CHANGE = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])
_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("score", pa.float64()), ("decoded", pa.bool_()),
                    ("others", pa.list_(pa.struct([("rank", pa.int32()), ("score", pa.float64()), ("changes", pa.list_(_CHANGE))])))])


@dataclass
class Vocabulary:
    """Normal pieces (a space stands for the mark of word begins) with scores; byte pieces; bytes of each id."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    raw: list[bytes]
    unknown: float
    widest: int

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids, raw = {}, [0] * 256, []
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i).replace("▁", " ")
            if model.is_byte(i):
                byte_ids[int(name[3:5], 16)] = i
                raw.append(bytes([int(name[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                raw.append(b"")
            else:
                if " " in name.lstrip(" "):
                    raise ValueError("a piece spans a word begin, so words can't be segmented one by one")
                pieces[name] = (i, model.get_score(i))
                raw.append(name.encode())
        return Vocabulary(pieces, byte_ids, raw, min(s for _, s in pieces.values()) - 10, max(map(len, pieces)))


def n_best(word: str, vocabulary: Vocabulary, n: int) -> list[tuple[float, list[int]]]:
    """The n best segmentations, best first: (score, ids). Characters without a piece become bytes at the unknown score.

    `ahead[i]` is the best score of the first i characters, an exact bound for what a path that ends at i still gains,
    so the backward search takes paths off its queue in the order of their full scores.
    """
    size = len(word)
    into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
    for e in range(1, size + 1):
        for s in range(max(0, e - vocabulary.widest), e):
            if (hit := vocabulary.pieces.get(word[s:e])) is not None:
                into[e].append((s, hit[1], (hit[0],)))
        if word[e - 1] not in vocabulary.pieces:
            into[e].append((e - 1, vocabulary.unknown, tuple(vocabulary.byte_ids[b] for b in word[e - 1].encode("utf-8", "surrogatepass"))))
    ahead = [0.0] + [NEVER] * size
    for e in range(1, size + 1):
        ahead[e] = max((ahead[s] + score for s, score, _ in into[e]), default=NEVER)
    turn = itertools.count()
    queue = [(-ahead[size], next(turn), size, 0.0, None)]
    out = []
    while queue and len(out) < n:
        _, _, at, gained, path = heapq.heappop(queue)
        if not at:
            ids: list[int] = []
            while path is not None:
                ids.extend(path[0])
                path = path[1]
            out.append((gained, ids))
            continue
        for s, score, piece in into[at]:
            heapq.heappush(queue, (-(gained + score + ahead[s]), next(turn), s, gained + score, (piece, path)))
    return out


class _Table:
    """Piece ids by hash of code points: two probes into tables of 2^22 slots."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        names = list(vocabulary.pieces)
        self.widest = max(map(len, names))
        self.key = np.zeros(len(vocabulary.raw), np.uint64)
        self.score = np.full(len(vocabulary.raw) + 1, NEVER)
        for p, (i, s) in vocabulary.pieces.items():
            h = 0
            for c in p:
                h = ((h + ord(c) + 1) * int(_MULT)) & (1 << 64) - 1
            self.key[i], self.score[i] = h, s
        self.slots = [np.full(1 << 22, -1, np.int32) for _ in range(2)]
        for i, _ in vocabulary.pieces.values():
            for t, shift in zip(self.slots, (42, 18)):
                at = int(self.key[i]) >> shift & (1 << 22) - 1
                if t[at] < 0:
                    t[at] = i
                    break
            else:
                raise ValueError("piece table is too full")

    def find(self, h: np.ndarray) -> np.ndarray:
        """Ids of hashes; -1 (which has a hopeless score) where there is none."""
        out = np.full(len(h), -1, np.int32)
        for t, shift in zip(self.slots, (42, 18)):
            i = t[(h >> np.uint64(shift)) & np.uint64((1 << 22) - 1)]
            hit = (i >= 0) & (self.key[i] == h)
            out[hit] = i[hit]
        return out


class Segmenter:
    """Best segmentations of many words at once, kept by hash, with the loss of the second best of each."""

    def __init__(self, vocabulary: Vocabulary, n: int) -> None:
        self.v, self.n, self.table = vocabulary, n, _Table(vocabulary)
        self.single = {ord(p) for p in vocabulary.pieces if len(p) == 1}
        self.alternatives: dict[bytes, list[tuple[float, list[int]]]] = {}
        self._reset()

    def _reset(self) -> None:
        self.hash, self.score, self.loss = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
        self.start, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def nth(self, word: bytes) -> list[tuple[float, list[int]]]:
        if word not in self.alternatives:
            if len(self.alternatives) > 200_000:
                self.alternatives.clear()
            self.alternatives[word] = n_best(word.decode("utf-8", "surrogatepass"), self.v, self.n)
        return self.alternatives[word]

    def learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> None:
        """Segment distinct words that are not kept yet."""
        if len(self.hash) + len(key) > STORE:
            self._reset()
        flat = np.concatenate([data[a:b] for a, b in zip(start.tolist(), end.tolist())]) if len(start) else data[:0]
        lead = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)])
        points = np.frombuffer(flat.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        size_b = end - start
        edge = np.concatenate([[0], np.cumsum(size_b)])
        first = lead[np.concatenate([[0], np.cumsum(size_b)[:-1]])] if len(start) else lead[:0]
        size = lead[np.cumsum(size_b)] - first
        score, loss = np.zeros(len(start)), np.zeros(len(start))
        ids: list[list[int] | np.ndarray] = [[]] * len(start)
        has = np.isin(points, np.fromiter(self.single, np.uint64))
        for w in np.flatnonzero(size > LONG).tolist():
            two = n_best(flat[edge[w] : edge[w + 1]].tobytes().decode("utf-8", "surrogatepass"), self.v, 2)
            score[w], loss[w], ids[w] = two[0][0], two[0][0] - two[1][0] if len(two) > 1 else np.inf, two[0][1]
        for n in np.unique(size[size <= LONG]).tolist():
            pick = np.flatnonzero(size == n)
            at = first[pick][:, None] + np.arange(n)
            cp, known = points[at], has[at]
            m = len(pick)
            best, second = [np.zeros(m)] + [np.full(m, NEVER) for _ in range(n)], [np.full(m, NEVER) for _ in range(n + 1)]
            step, piece = [np.ones(m, np.int32) for _ in range(n + 1)], [np.full(m, -1, np.int32) for _ in range(n + 1)]
            for s in range(n):
                h = np.zeros(m, np.uint64)
                for k in range(1, min(self.table.widest, n - s) + 1):
                    h = (h + cp[:, s + k - 1] + np.uint64(1)) * _MULT
                    found = self.table.find(h)
                    gain = self.table.score[found]
                    if k == 1:
                        gain = np.where(known[:, s], gain, self.v.unknown)
                    e = s + k
                    one, two = best[s] + gain, second[s] + gain
                    up = one > best[e]
                    second[e] = np.maximum(np.where(up, best[e], one), np.where(up, two, second[e]))
                    best[e] = np.where(up, one, best[e])
                    step[e] = np.where(up, k, step[e])
                    piece[e] = np.where(up, found, piece[e])
            score[pick] = best[n]
            loss[pick] = np.where(second[n] > NEVER / 2, best[n] - second[n], np.inf)
            back = [np.full(m, -2, np.int32) for _ in range(n)]
            pos = np.full(m, n)
            step_m, piece_m = np.stack(step), np.stack(piece)
            rows = np.arange(m)
            for j in range(n - 1, -1, -1):
                live = pos > 0
                back[j][live] = piece_m[pos[live], rows[live]]
                pos[live] -= step_m[pos[live], rows[live]]
            table = np.stack(back, 1)
            plain = ~(table == -1).any(1)
            for r in np.flatnonzero(~plain).tolist():
                ids[pick[r]] = n_best("".join(map(chr, cp[r].tolist())), self.v, 1)[0][1]
            for r, row, length in zip(pick[plain].tolist(), table[plain], (table[plain] != -2).sum(1).tolist()):
                ids[r] = row[n - length :]
        count = np.array([len(x) for x in ids], np.int64)
        offset = len(self.ids) + np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else count
        order = np.argsort(np.concatenate([self.hash, key]), kind="stable")
        for name, new in (("hash", key), ("score", score), ("loss", loss), ("start", offset), ("count", count)):
            setattr(self, name, np.concatenate([getattr(self, name), new])[order])
        self.ids = np.concatenate([self.ids, *[np.asarray(x, np.int32) for x in ids]]) if len(ids) else self.ids

    def look_up(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of each word in the store."""
        key = words.hashes(data, start, end)
        uniq, first, back = np.unique(key, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hash, uniq)
        new = np.ones(len(uniq), bool)
        inside = at < len(self.hash)
        new[inside] = self.hash[at[inside]] != uniq[inside]
        if new.any():
            if len(self.hash) + new.sum() > STORE:
                self._reset()
                new[:] = True
            self.learn(data, start[first[new]], end[first[new]], uniq[new])
            at = np.searchsorted(self.hash, uniq)
        return at[back]


def _ragged(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[start : start + count] of each row, one after the other."""
    total = int(count.sum())
    shift = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else start, count)
    return flat[shift + np.arange(total)]


def _combined(seg: Segmenter, parts: list[bytes], at: list[int], count: list[int], best: float) -> list[dict]:
    """The next best segmentations of a text from the alternatives of its words with the least losses."""
    options = [[(own[0][0] - s, ids) for s, ids in own] for own in (seg.nth(p) for p in parts)]
    sums: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for o in options:
        sums = sorted((a + loss, (*pick, i)) for a, pick in sums for i, (loss, _) in enumerate(o))[: seg.n]
    return [{"rank": r, "score": best - lost, "changes": [{"at": at[w], "drop": count[w], "ids": options[w][i][1]} for w, i in enumerate(pick) if i]}
            for r, (lost, pick) in enumerate(sums) if r]


def segment(docs: DataFrame, model: str, n: int = 3) -> DataFrame:
    """The n best segmentations of each whole text under a SentencePiece model, and whether the best decodes to the text.

    (doc_id, ids, score, decoded, others): the best one's ids and score (sum of piece scores); others holds the ranks
    from 1 on, each as changes of the best (at: first piece, drop: pieces left out, ids: those put in). As the model does,
    a space is put before the text and spaces mark word begins; a mark in the text itself is read as a space. Pieces do
    not span word begins, so words are lattices of their own: their best and second-best scores come from a Viterbi
    pass over all distinct words at once, and the n - 1 words of a text that lose least are searched by A*, which is
    enough for its n best. Equal scores: any order, the same in each run. NULL and empty texts have no ids, score 0, decoded
    true and no others. One row per input row, repeated rows too. The model file is read by the driver only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        seg = Segmenter(v, n)
        raw = np.frombuffer(b"".join(v.raw), np.uint8)
        raw_size = np.array([len(r) for r in v.raw])
        raw_at = np.cumsum(raw_size) - raw_size
        for batch in batches:
            ids_col = batch.column(0)
            text = pc.replace_substring(batch.column(1).cast(pa.large_string()).fill_null(""), "▁", " ")
            spaced = pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
            for c in words.chunks(spaced, CHUNK):
                data = c.data
                space = data == 0x20
                begin = space.copy()
                begin[1:] &= ~space[:-1]
                firsts = c.offsets[:-1][c.offsets[:-1] < c.offsets[1:]]
                begin[firsts] = True
                start = np.flatnonzero(begin)
                end = np.append(start[1:], len(data))[: len(start)]
                at = seg.look_up(data, start, end)
                count, loss, score = seg.count[at], seg.loss[at], seg.score[at]
                ids = _ragged(seg.ids, seg.start[at], count)
                word_of = np.searchsorted(start, c.offsets)
                piece_at = np.concatenate([[0], np.cumsum(count)])
                out_bytes = _ragged(raw, raw_at[ids], raw_size[ids])
                byte_at = np.concatenate([[0], np.cumsum(raw_size[ids])])
                total = np.concatenate([[0.0], np.cumsum(score)])
                offs = piece_at[word_of]
                scores, decoded, others = [], [], []
                for r in range(len(c)):
                    a, b = int(word_of[r]), int(word_of[r + 1])
                    x, y = byte_at[offs[r]], byte_at[offs[r + 1]]
                    decoded.append(bool(np.array_equal(out_bytes[x:y], data[c.offsets[r] : c.offsets[r + 1]])))
                    scores.append(float(total[b] - total[a]))
                    own = loss[a:b]
                    least = np.sort(np.argpartition(own, n - 2)[: n - 1] if 1 < n <= len(own) else np.arange(len(own)))
                    least = least[np.isfinite(own[least])] + a
                    parts = [data[start[w] : end[w]].tobytes() for w in least.tolist()]
                    others.append(_combined(seg, parts, (piece_at[least] - offs[r]).tolist(), count[least].tolist(), scores[-1]) if n > 1 else [])
                rows = ids_col.slice(c.first, len(c))
                yield pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids)), pa.array(scores, pa.float64()),
                                                  pa.array(decoded), pa.array(others, _ARROW.field("others").type)], schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def decode(pieces: DataFrame, model: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """`pieces` with the texts of its lists of ids in column `out`: the pieces joined, without the space that was put before the text.

    Byte pieces that make no UTF-8 come out as U+FFFD; control and unknown pieces as nothing; an id the model does not have fails the job.
    NULL and empty lists give ''. Other columns stay; an own column `out` is replaced.
    """
    shared = pieces.sparkSession.sparkContext.broadcast(Vocabulary.load(model).raw)

    @F.pandas_udf("string")
    def texts(lists: pd.Series) -> pd.Series:
        raw = shared.value
        if any(len(x) and (min(x) < 0 or max(x) >= len(raw)) for x in lists):
            raise ValueError("not an id of the model")
        return pd.Series([b"".join(raw[i] for i in x).removeprefix(b" ").decode("utf-8", "replace") for x in lists], dtype=object)

    return pieces.withColumn(out, texts(F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>"))))
