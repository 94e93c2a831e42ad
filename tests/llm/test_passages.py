"""Repeated passages, source divergence and fill-in-middle on small frames against brute force, with all odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from zonewright.llm import divergence, middle, repeats, words

DOCS = "doc_id long, text string, lang string, source string, fp string, at int, key long, spans string, n long, value long"


def docs_of(spark, rows):
    """Frame of (doc_id, text, lang, source) with columns whose names the operators also use inside."""
    return spark.createDataFrame([(i, t, a, s, "f", 1, 2, "s", 3, 4) for i, t, a, s in rows], DOCS)


def plain(rows):
    return [(i, t, "en", "s") for i, t in rows]


def brute_removed(rows, length):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        if i is not None:
            for j in range(len(w) - length + 1):
                x = tuple(w[j : j + length])
                least[x] = min(i, least.get(x, i))
    out = []
    for i, w in split:
        gone = set()
        for j in range(len(w) - length + 1) if i is not None else ():
            if least[tuple(w[j : j + length])] < i:
                gone.update(range(j, j + length))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def mixed_texts(seed, n=80, few=False):
    """Texts of shared passages of 1 to 60 words, edited here and there, in and out of order, with repeats inside a text."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3 if few else 300)]
    passages = [rng.choices(vocabulary, k=rng.randint(1, 60)) for _ in range(25)]
    rows = []
    for i in range(n):
        body = []
        for _ in range(rng.randint(0, 6)):
            p = list(rng.choice(passages))
            if rng.random() < 0.5 and p:
                p[rng.randrange(len(p))] = rng.choice(vocabulary)
            body += p if rng.random() < 0.8 else rng.choices(vocabulary, k=rng.randint(1, 40))
        rows.append((rng.randrange(n), rng.choice([" ", "\n", " \t"]).join(body)))
    return rows


@pytest.mark.parametrize("seed, few, length, k", [(1, False, 13, 7), (2, False, 13, 9), (3, True, 13, 7), (4, False, 13, 13), (5, False, 6, 4), (6, True, 5, 3)])
def test_remove_matches_brute_force(spark, monkeypatch, seed, few, length, k):
    monkeypatch.setattr(repeats, "BLOCK_ROWS", 7)
    rows = mixed_texts(seed, few=few) + [(None, "w1 " * 40), (3, None), (4, ""), (5, " \n ")]
    got = repeats.remove(docs_of(spark, plain(rows)), length, k).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got), key=str) == brute_removed(rows, length)


def test_remove_keeps_maximal_runs(spark):
    a = [f"a{i}" for i in range(40)]
    rows = [(1, " ".join(a)), (2, " ".join(["x", *a[5:30], "y", *a[:12], "z", *a[20:33]]))]
    got = {r["doc_id"]: r for r in repeats.remove(docs_of(spark, plain(rows))).collect()}
    assert [tuple(r) for r in got[2]["repeats"]] == [(1, 26), (40, 53)] and got[1]["repeats"] == []
    assert got[2]["text"] == " ".join(["x", "y", *a[:12], "z"])


def test_remove_edges(spark):
    assert repeats.remove(docs_of(spark, [])).collect() == []
    long = " ".join(f"v{i % 5000}" for i in range(60_000))
    rows = [(7, long), (9, long), (9, long), (8, "äö 漢字 " * 20), (8, "äö 漢字 " * 20), (12, "äö 漢字 " * 20 + "end")]
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in repeats.remove(docs_of(spark, plain(rows))).collect()]
    assert sorted(got, key=str) == brute_removed(rows, 13)
    with pytest.raises(ValueError):
        repeats.repeats(docs_of(spark, []), 13, 5)


def test_passage_of_many_documents_over_many_tasks(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"{passage} own{i} " + " ".join(f"d{i}x{j}" for j in range(15))) for i in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["doc_id"]: r["n_removed"] for r in repeats.remove(docs_of(spark, plain(rows))).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {i: 20 if i else 0 for i in range(400)}


def brute_audit(rows, least_docs, top):
    texts = defaultdict(list)
    for _, t, a, s in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        texts[a or "", s or ""].append(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
    out = []
    for lang in {a for a, _ in texts}:
        own = {s: Counter(w for d in ds for w in d) for (a, s), ds in texts.items() if a == lang}
        held = Counter(w for (a, _), ds in texts.items() if a == lang for d in ds for w in set(d))
        kept = [w for w, n in held.items() if n >= least_docs]
        p = {}
        for s, counts in [*own.items(), (None, sum(own.values(), Counter()))]:
            all_ = sum(counts[w] for w in kept) + len(kept)
            p[s] = {w: 1 + 10**9 * (counts[w] + 1) // all_ for w in kept}
        for s in own:
            pairs = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o) for o in own if o != s]
            more = [((p[s][w] - p[None][w]) ** 2 // p[None][w], w) for w in kept if own[s][w] and p[s][w] > p[None][w]]
            for part, items in (("pair", pairs), ("term", more)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, o, v, i + 1) for i, (v, o) in enumerate(items) if part == "pair" or i < top]
    return sorted(out)


def source_rows(seed, n=150):
    rng = random.Random(seed)
    terms = ["the", "Of", "über", "漢字", "don't", "a1b", "x_y", "ÄB", "é", "zeta", "Alpha", "beta", *[f"t{chr(97 + i)}" for i in range(20)]]
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "12 34 .", *[" ".join(rng.choices(terms, k=rng.randint(1, 60))) for _ in range(9)]])
        rows.append((rng.choice([i, 5, None]), text, rng.choice(["en", "de", None, ""]), rng.choice([None, *[f"s{j}" for j in range(9)]])))
    return rows + [(1, "alone word", "fr", "s1"), (2, None, "xx", "b"), (3, "", "xx", "a"), (4, "q q q q", "fr", "s2")]


@pytest.mark.parametrize("groups, terms, held", [(32, 4096, 1 << 19), (3, 5, 4), (1, 1, 1)])
def test_audit_matches_brute_force(spark, monkeypatch, groups, terms, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = source_rows(groups)
    got = divergence.audit(docs_of(spark, rows), 3, 4, groups, terms).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, 3, 4)


def test_audit_edges(spark):
    assert divergence.audit(docs_of(spark, [])).collect() == []
    rows = [(i, "Word " * 50_000 + f"w{chr(97 + i)}", "en", s) for i, s in enumerate("aab")] + [(9, "word", "en", "b")] * 3
    assert sorted(tuple(r) for r in divergence.audit(docs_of(spark, rows)).collect()) == brute_audit(rows, 3, 200)


def test_scaled_is_exact_for_large_counts(spark):
    rng = random.Random(3)
    cases = [(0, 1), (6, 7), (2**53 - 2, 2**53 - 1), *[(rng.randrange(a), a) for a in (rng.randrange(1, 2**53) for _ in range(200))]]
    want = [1 + 10**9 * (c + 1) // a for c, a in cases]
    count, all_ = (np.array([c[i] for c in cases], np.int64) for i in range(2))
    assert divergence.scaled(count, all_).tolist() == want
    frame = spark.createDataFrame(cases, "c long, a long")
    assert [r[0] for r in frame.select(divergence._scaled(frame.c, frame.a)).collect()] == want


def brute_middle(doc_id, text, seed=7, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return (doc_id, n, "plain", None, None, text, hashlib.sha256(text.encode()).hexdigest())
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    form = "spm" if h4 % 100 < spm else "psm"
    output = f"<S>{z}<P>{x}<M>{y}" if form == "spm" else f"<P>{x}<S>{z}<M>{y}"
    return (doc_id, n, form, len(x), len(y), output, hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("percent, spm", [(100, 50), (40, 10)])
def test_middle_matches_brute_force(spark, percent, spm):
    rng = random.Random(percent)
    bits = ["a", "line of text", "é", "漢字", "😀", "\n", "\n\n", "\r\n", " ", "\x0b", " ", "<P", "S>"]
    rows = [(rng.choice([i, i, None]), "".join(rng.choices(bits, k=rng.randint(0, 30)))) for i in range(300)]
    rows += [(1, None), (2, ""), (3, "\n"), (4, "no end"), (5, "has <M> in it\nx"), (6, "<P>"), (7, "ü漢\n" * 40_000), (7, "ü漢\n" * 40_000), (-5, "x\ny\n")]
    got = middle.transform(docs_of(spark, plain(rows)), 7, percent, spm).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_middle(i, t, 7, percent, spm) for i, t in rows), key=str)


def test_middle_of_empty_table(spark):
    assert middle.transform(docs_of(spark, [])).collect() == []


def test_exceptions_convert_both_ways():
    rng = random.Random(1)
    for _ in range(50):
        text = "".join(rng.choices(["a", "bc", "é", "漢", "😀", "\n"], k=rng.randint(0, 40)))
        index = middle.Exceptions.of(np.frombuffer(text.encode(), np.uint8))
        points = np.arange(len(text) + 1)
        cuts = np.array([len(text[:i].encode()) for i in points])
        assert index.bytes(points).tolist() == cuts.tolist() and index.points(cuts).tolist() == points.tolist()


def test_lines_of_texts_that_end_without_newline():
    (chunk,) = words.chunks(pa.array(["a\nb", "", None, "\n", "c"]))
    ends, first = middle.line_ends(chunk)
    assert ends.tolist() == [2, 3, 4, 5] and np.diff(first).tolist() == [2, 0, 0, 1, 1]
