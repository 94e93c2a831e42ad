"""Toxicity: a learned lexicon, met by Levenshtein automata run along its trie, weighed by the words around."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zonewright.llm import words
from zonewright.llm.langid import held_out

TRAIN_ROWS = 20_000
MIN_CONTEXTS = 4
MIN_ODDS = 3.0
STEM = 4
WINDOW = 8
QUOTED = 0.1
THRESHOLD = 0.3
CACHE = 100_000
LONGEST = 64

_WORD = re.compile(r"[^\W_]+")
# fixed values: quotation marks, and words by which a text reports what others said
_MARKS = re.compile("[\"“”„«»‹›「」\n]")
_OPENING, _CLOSING = "«‹「„", "」"
_REPORT = frozenset("said says wrote writes quoted quote quotes cited called term word phrase slur insult so-called".split())
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def quotations(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, closed) of each quotation, in order; one that is not closed ends with its line.

    A mark that can open and close opens where no word ends right before it; a closing mark without an opening one counts for nothing.
    """
    spans: list[tuple[int, int, bool]] = []
    begun = None
    for m in _MARKS.finditer(text):
        mark, at = m.group(), m.start()
        if mark == "\n":
            if begun is not None:
                spans.append((begun, at, False))
            begun = None
        elif begun is None:
            if mark in _OPENING or (mark not in _CLOSING and (at == 0 or text[at - 1].isspace() or text[at - 1] in "([{-–—:,")):
                begun = m.end()
        elif mark not in _OPENING or not text[at - 1].isspace():
            spans.append((begun, at, True))
            begun = None
    if begun is not None:
        spans.append((begun, len(text), False))
    return spans


@dataclass
class Trie:
    """Lexicon entries by their letters."""

    next: dict[str, Trie] = field(default_factory=dict)
    entry: str | None = None
    stem: str | None = None

    def add(self, entry: str) -> None:
        """Add a word, or a stem, written with a star, that takes any ending."""
        node = self
        for c in entry.rstrip("*"):
            node = node.next.setdefault(c, Trie())
        if entry.endswith("*"):
            node.stem = entry
        else:
            node.entry = entry


def reach(entry: str) -> int:
    """Edits allowed for an entry: none up to four letters, else one."""
    return 0 if len(entry) <= 4 else 1


def nearest(trie: Trie, word: str) -> tuple[str, int] | None:
    """The entry with the fewest edits from `word`, within its reach; ties to the first by name.

    A stem takes words that begin with it, without edits. The automaton's state after a path of the trie is two sets of
    positions in the word, held as bits: those reached with no edit and with one. A path is left when both are empty.
    """
    n = len(word)
    at: dict[str, int] = {}
    for j, c in enumerate(word):
        at[c] = at.get(c, 0) | 1 << j
    end, full = 1 << n, (2 << n) - 1
    best: tuple[int, str] | None = None
    stack = [(trie, 1, 3 & full)]
    while stack:
        node, exact, near = stack.pop()
        if node.entry is not None:
            edits = 0 if exact & end else 1 if near & end else 2
            if edits <= reach(node.entry) and (best is None or (edits, node.entry) < best):
                best = (edits, node.entry)
        if node.stem is not None and exact and (best is None or (0, node.stem) < best):
            best = (0, node.stem)
        for c, child in node.next.items():
            here = at.get(c, 0)
            moved = (exact & here) << 1
            one = ((near & here) << 1 | exact | exact << 1 | moved << 1) & full
            if moved or one:
                stack.append((child, moved, one))
    return None if best is None else (best[1], best[0])


class Matcher:
    """Finds lexicon words in texts; only words that share a beginning or end with an entry meet the automaton."""

    def __init__(self, lexicon: list[str]) -> None:
        self.trie = Trie()
        self.heads: dict[int, np.ndarray] = {}
        self.tails: dict[int, np.ndarray] = {}
        heads: dict[int, set[int]] = {}
        tails: dict[int, set[int]] = {}
        for e in lexicon:
            self.trie.add(e)
            raw = e.rstrip("*").encode()
            if e.endswith("*"):
                heads.setdefault(min(6, len(raw)), set()).add(int.from_bytes(raw[:6], "big"))
                continue
            # one edit leaves the first h bytes or the last h as they are
            h = len(raw) if not reach(e) and len(raw) <= 3 else max(1, min(3, len(raw) // 2 if e.isascii() else (len(raw) - 3) // 2))
            heads.setdefault(h, set()).add(int.from_bytes(raw[:h], "big"))
            tails.setdefault(h, set()).add(int.from_bytes(raw[-h:], "big"))
        self.heads = {h: np.array(sorted(v)) for h, v in heads.items()}
        self.tails = {h: np.array(sorted(v)) for h, v in tails.items()}
        self.known: dict[str, tuple[str, int] | None] = {}

    def find(self, word: str) -> tuple[str, int] | None:
        """The nearest entry; of very long words the beginning decides, as no entry is that long and a stem takes any ending."""
        word = word[: 2 * LONGEST]
        if word not in self.known:
            if len(self.known) > CACHE:
                self.known.clear()
            self.known[word] = nearest(self.trie, word)
        return self.known[word]

    def may_hold(self, chunk: words.Chunk) -> np.ndarray:
        """Rows of the chunk with a word near a lexicon entry, or with capitals that change their length when lowered."""
        data, wide = self._lowered(chunk)
        w = words.split(chunk, words.letter_gaps(data))
        near = np.zeros(len(w.start), bool)
        size = w.end - w.start
        for table, at_end in ((self.heads, False), (self.tails, True)):
            for h, keys in table.items():
                fits = np.flatnonzero(size >= h)
                first = w.end[fits] - h if at_end else w.start[fits]
                key = np.zeros(len(fits), np.int64)
                for j in range(h):
                    key = key << 8 | data[first + j]
                near[fits] |= np.isin(key, keys)
        pick = np.flatnonzero(near & (size >= 2))
        if not len(pick):
            return wide
        _, at, back = np.unique(words.hashes(data, w.start[pick], w.end[pick]), return_index=True, return_inverse=True)
        hit = np.array([self.find(data[w.start[i] : w.end[i]].tobytes().decode("utf-8", "replace")) is not None for i in pick[at]], bool)
        return np.union1d(w.row[pick[hit[back]]], wide)

    @staticmethod
    def _lowered(chunk: words.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The bytes lowered as `hits` lowers texts, and the rows where that changes the length, which are left to `hits`."""
        data = words.lowered(chunk.data)
        wide = []
        beyond = np.flatnonzero((chunk.data >= 0xC4) & (chunk.data != 0xE2))
        for r in np.unique(np.searchsorted(chunk.offsets, beyond, "right") - 1).tolist():
            a, b = int(chunk.offsets[r]), int(chunk.offsets[r + 1])
            low = data[a:b].tobytes().decode("utf-8", "replace").lower().encode()
            if len(low) == b - a:
                data[a:b] = np.frombuffer(low, np.uint8)
            else:
                wide.append(r)
        return data, np.array(wide, np.int64)

    def hits(self, text: str) -> list[tuple[str, str, int, bool]]:
        """(word, entry, edits, quoted) of each lexicon word: quoted inside quotation marks, or where marks were opened and the
        WINDOW words before tell of somebody else's words."""
        found = []
        text = text.lower()
        tokens = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(text)]
        spans = quotations(text)
        for i, (word, start, end) in enumerate(tokens):
            if len(word) < 2 or (near := self.find(word)) is None:
                continue
            at = bisect.bisect_right(spans, start, key=lambda s: s[0]) - 1
            inside = at >= 0 and end <= spans[at][1]
            closed = inside and spans[at][2]
            told = any(t[0] in _REPORT for t in tokens[max(0, i - WINDOW) : i])
            found.append((word, *near, closed or (inside and told)))
        return found


@dataclass
class Model:
    """Log-odds of the words met, of near words not met in training, and of texts with and without any hit."""

    lexicon: list[str]
    forms: dict[str, float]
    near: float
    base: float
    bare: float | None

    def score(self, hits: list[tuple[str, str, int, bool]]) -> float:
        if self.bare is None:
            return 0.0
        plain, quoted = {}, 0.0
        for word, entry, edits, inside in hits:
            w = max(0.0, self.forms.get(entry if entry.endswith("*") else word, self.near if edits else 0.0))
            if inside:
                quoted = max(quoted, QUOTED * w)
            else:
                plain[entry] = max(plain.get(entry, 0.0), w)
        found = sum(plain.values())
        logit = max(self.bare, self.base + found) if found >= MIN_ODDS else self.bare
        return float(1 / (1 + np.exp(-(logit + quoted))))


def _stands_out(pos: int, neg: int, share: float, tried: int) -> bool:
    """Whether `pos` of pos + neg is more than chance would give any of `tried` words, at a `share` of toxic words."""
    n = pos + neg
    gain = pos * np.log(pos / (n * share)) + (neg * np.log(neg / (n * (1 - share))) if neg else 0.0)
    return pos > n * share and gain > np.log(tried) + 3


def _with_stems(tokens: list[str]) -> list[str]:
    return [*tokens, *(t[:STEM] + "*" for t in tokens if len(t) > STEM)]


def _logit(p: float) -> float:
    return float(np.log(p) - np.log(1 - p))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model from at most `rows` labelled rows, those with the least hash of doc_id; each is read as a whole.

    docs: doc_id, text. labels: doc_id, toxic (0 or 1; other values are ignored, of several the greatest counts).
    A lexicon entry (a word, or a stem of STEM letters) stands in toxic texts after at least MIN_CONTEXTS different words, so copies of one
    text do not make one; that is more often than chance explains, and its log-odds are at least MIN_ODDS. All that reaches the driver follows `rows`, not the table.
    """
    spark = docs.sparkSession
    chosen = (labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    sample = docs.where("text is not null").join(F.broadcast(chosen), "doc_id").select("text", "toxic").cache()

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = _WORD.findall(text.lower())
                left = ["", *tokens]
                seen.update(zip(_with_stems(tokens), [*left[:-1], *(b for t, b in zip(tokens, left) if len(t) > STEM)]))
        pairs = sorted(seen)
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in range(2)], names=["word", "left"])

    toxic = sample.where("toxic = 1").select("text").mapInArrow(contexts, "word string, left string")
    stands = toxic.distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    stem = F.concat(F.substring("word", 1, STEM), F.lit("*"))
    top = stands.where(f"length(word) > {STEM + 1}").union(stands.where(f"length(word) = {STEM + 1} and word not like '%*'"))
    top = top.groupBy(stem.alias("word")).agg(F.max("n").alias("top"))
    # a stem counts for what it adds to its most frequent word
    counted = stands.join(top, "word", "left").select("word", (F.col("n") - F.coalesce("top", F.lit(0))).alias("n"))
    likely = {r["word"]: r["n"] for r in counted.where(f"n >= {MIN_CONTEXTS} and length(word) between 2 and {LONGEST}").collect()}
    tried = stands.count()

    def presence(known: frozenset[str], matcher: Matcher | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: dict[tuple[str, int], list[int]] = {}
            for batch in batches:
                for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    own = ({(w, 0) for w in known.intersection(_with_stems(_WORD.findall(text.lower())))} if matcher is None
                           else {(h[1] if h[1].endswith("*") else h[0], h[2]) for h in matcher.hits(text)})
                    for key in own or ({("", 0)} if matcher else ()):
                        counts.setdefault(key, [0, 0])[y] += 1
            keys = sorted(counts)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                              pa.array([counts[k][1] for k in keys], pa.int64()), pa.array([counts[k][0] for k in keys], pa.int64())],
                                             names=["word", "edits", "pos", "neg"])

        got = sample.mapInArrow(run, "word string, edits int, pos bigint, neg bigint")
        return got.groupBy("word", "edits").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()

    total = {r["toxic"]: (r["n"], r["size"]) for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("size")).collect()}
    (pos, size), (neg, size_neg) = total.get(1, (0, 0)), total.get(0, (0, 0))
    if not pos + neg:
        return Model([], {}, 0.0, 0.0, None)
    base = _logit((pos + 0.5) / (pos + neg + 1))
    odds = lambda a, b, q: _logit((a + q) / (a + b + 1)) - base
    share = float(np.clip(size / max(1, size + size_neg), 1e-6, 1 - 1e-6))
    lexicon = sorted(r["word"] for r in presence(frozenset(likely), None)
                     if _stands_out(likely[r["word"]], r["neg"], share, tried) and odds(r["pos"], r["neg"], 0.5) >= MIN_ODDS)
    met = presence(frozenset(), Matcher(lexicon))
    bare = next(((r["pos"], r["neg"]) for r in met if r["word"] == ""), (0, 0))
    once = [r["pos"] for r in met if r["edits"] and r["pos"] + r["neg"] == 1]  # what forms met for the first time tell of new ones
    guess = (sum(once) + 0.5) / (len(once) + 1)
    forms = {r["word"]: odds(r["pos"], r["neg"], guess if r["edits"] else 0.5) for r in met if r["word"]}
    return Model(lexicon, forms, _logit(guess) - base, base, _logit((bare[0] + 0.5) / (sum(bare) + 1)) if sum(bare) else base)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for docs (doc_id, text, held_out)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value.lexicon)
        none = shared.value.score([])
        for batch in batches:
            scores = np.full(batch.num_rows, none)
            for chunk in words.chunks(batch.column(1)):
                for r in matcher.may_hold(chunk):
                    text = chunk.data[chunk.offsets[r] : chunk.offsets[r + 1]].tobytes().decode("utf-8", "replace")
                    scores[chunk.first + r] = shared.value.score(matcher.hits(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                                             schema=_SCORED)

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def detect(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """Toxicity of each whole text, one row per input row; labels are learned only from rows that are not held out.

    Rows are held out where crc32 of doc_id as text leaves `remainder` by `modulus`. score is a probability: the odds of
    the lexicon words met (each once; misspelled ones by their own or by the usual odds of near words; those in
    quotations for a tenth). NULL, empty and hit-free texts have the score of texts without a hit; without any label
    all scores are 0. Ties between entries: fewest edits, then the first by name. predicted is 1 from `threshold` on.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       held_out(F.col("doc_id"), modulus, remainder).alias("held_out"))
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("toxic"))
    model = train(docs.where("not held_out").select("doc_id", "text"), labels.where(~held_out(F.col("doc_id"), modulus, remainder)))
    return score(docs, model)
