"""Operators beyond SQL against plain versions written a word or a text at a time."""

import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from zonewright.llm import decontaminate, quality, words

DOCS = "doc_id long, text string, hash long, pos int, size int, item_id long, k long, p int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, 6) for i, t in rows], DOCS).repartition(3)


# --- benchmark decontamination -----------------------------------------------------------------------
def _lower(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in word)


def _canonical(text):
    """(form, value, is placeholder) of each word of a text."""
    gap = r"(?:(?![0-9A-Za-z])[\x00-\x7F]|[\u0080-¿ -‿])"
    out, end = [], 0
    for m in re.finditer(rf"(?:(?<=[0-9])[.,](?=[0-9])|(?!{gap}).)+", text, re.S):
        w = m[0]
        number = not re.search(r"[^0-9.,]", w)
        unit = bool(out) and out[-1][0] == "<number>" and _lower(w) in decontaminate.UNITS
        begins = not out or re.search(r"[.!?:;\n]", text[end : m.start()])
        name = re.match(r"[A-ZÀ-ÖØ-Þ]", w) and re.search(r"[a-zà-ÿ]", w) and not begins and not number and not unit
        out.append(("<number>" if number else "<unit>" if unit else "<name>" if name else _lower(w), _lower(w), bool(number or unit or name)))
        end = m.end()
    return out


def _windows(text, size):
    w = _canonical(text or "")
    return [(i, tuple(f for f, _, _ in w[i : i + size]), tuple(v for _, v, s in w[i : i + size] if s)) for i in range(len(w) - size + 1)
            if size and 2 * sum(s for _, _, s in w[i : i + size]) <= size]


def brute_leaks(docs, items, coverage=0.5):
    found = set()
    for j, item in set(items):
        size = min(len(_canonical(item or "")), decontaminate.WINDOW)
        own = _windows(item, size)
        by_form = defaultdict(list)
        for i, form, slots in own:
            by_form[form].append((i, slots))
        for d, text in set(docs):
            if d is None or j is None or (0 < size < decontaminate.SHORTEST and len(_canonical(text or "")) != size):
                continue
            lines = defaultdict(list)
            for at, form, slots in _windows(text, size):
                for i, mine in by_form.get(form, ()):
                    lines[at - i].append((i, mine, slots))
            held, other = set(), False
            for line in lines.values():
                stands = defaultdict(set)
                for _, mine, slots in line:
                    for a, b in zip(mine, slots):
                        stands[a].add(b)
                if all(len(b) == 1 for b in stands.values()):
                    held |= {i for i, _, _ in line}
                    other |= any(b != {a} for a, b in stands.items())
            if own and len(held) / len(own) >= coverage:
                found.add((d, j, len(held), len(own), other))
    return found


def found_leaks(spark, docs, items):
    bench = spark.createDataFrame([(i, t, "x", 0) for i, t in items], "item_id long, text string, hash string, doc_id int")
    rows = [(r["doc_id"], r["item_id"], r["matched"], r["windows"], r["reworded"]) for r in decontaminate.leaks(frame(spark, docs), bench).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leaks_match_a_plain_version(spark, seed):
    rng = random.Random(seed)
    vocabulary = "the a sold bought found Ärzte ärzte größer Ann Bob Élan 3 12 3.5 1,000 km kg apples trees and then of NASA x1 漢字".split()
    marks = [" ", " ", " ", " ", ", ", ". ", " – ", "? ", "\n"]

    def text(n):
        return "".join(w + rng.choice(marks) for w in rng.choices(vocabulary, k=n))

    def retold(t):
        return re.sub(r"\b(Ann|Bob|12|3)\b", lambda m: rng.choice(["Ann", "Bob", "Eve"] if m[0].isalpha() else ["3", "12", "77"]), t)

    items = [(i, text(rng.choice([1, 2, 3, 5, 7, 8, 9, 14, 30]))) for i in range(25)]
    docs = [(i, text(20) + rng.choice([str, retold])(rng.choice(items)[1]) + text(20)) for i in range(60)]
    docs += [(100 + i, t) for i, t in items] + [(200, None), (201, ""), (202, "..."), (None, items[0][1]), (203, "word " * 40_000 + items[-1][1])] + docs[:3]
    items += [(50, items[0][1]), (51, None), (52, ""), (None, items[1][1]), (53, "12 13"), items[2]]
    got = found_leaks(spark, docs, items)
    assert got == brute_leaks(docs, items) and any(r[4] for r in got) and any(r[0] == 203 for r in got)


def test_short_items_are_looked_for_whatever_else_the_benchmark_holds(spark):
    dotted = "sum of 1.2.3.4.5.6.7.8.9.10.11.12.13.14.15.16.17.18 is due"
    docs = [(1, f"so: {dotted} today"), (2, "a short one here"), (3, "Short one"), (4, "nothing of it")]
    for more in ([], [(9, "other short item")]):
        assert {r[:2] for r in found_leaks(spark, docs, [(7, dotted), *more])} == {(1, 7)}
    # one or two words: whole texts only
    assert {r[:2] for r in found_leaks(spark, docs, [(8, "short one")])} == {(3, 8)}


# --- quality -----------------------------------------------------------------------------------------
def _vote(text):
    (chunk,) = words.chunks(pa.array([text]), 1 << 30)
    pattern = int(quality._read(chunk, False)[0][0])
    return {name: pattern // 3**i % 3 for i, name in enumerate(quality.LABELLERS)}


def test_scripts_of_several_bytes_vote_like_latin():
    plain = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} goes on here quietly." for i in range(30))
    other = plain.translate({c: 0x430 + (c - 97) for c in range(97, 123)})
    assert _vote(plain) == _vote(other) and 0 not in _vote(plain).values()
    rng = random.Random(1)
    chinese = "".join("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(20)) + "。" for _ in range(30))
    assert 0 not in _vote(chinese).values() and _vote(chinese)["length"] == 2 and _vote("东西。" * 100)["repeats"] == 0
    assert _vote("你好")["length"] == 0 and _vote("")["length"] == 0


def test_words_of_mixed_scripts():
    (chunk,) = words.chunks(pa.array(["ab漢字c", "", None, "カ　x 漢", "字", "é。"]), 1 << 30)
    w, wide = quality._words(chunk)
    got = [bytes(chunk.data[a:b]).decode() for a, b in zip(w.start, w.end)]
    assert got == ["ab", "漢", "字", "c", "カ", "　x", "漢", "字", "é。"] and wide.tolist() == [2, 0, 0, 2, 1, 0]
    assert w.row.tolist() == [0] * 4 + [3] * 3 + [4, 5] and w.first.tolist() == [0, 4, 4, 4, 7, 8, 9]


def test_the_sample_holds_each_text_once_and_scores_repeat(spark):
    rng = random.Random(4)
    good = [(i, ". ".join(" ".join(rng.choices("kaler losta mivel nesto rentor".split(), k=9)) for _ in range(8)) + ".") for i in range(80)]
    bad = [(i, "!!".join(rng.choices(["KALER", "LOSTA", "X!!"], k=60))) for i in range(80, 110)]
    rows = good + bad + [(500 + i, "one text that fills a third of all rows") for i in range(60)] + [(None, None), (1, ""), (2, "long " * 50_000)]
    runs = [sorted(tuple(r) for r in quality.score(frame(spark, rows).repartition(n), 40).na.fill(-1, ["doc_id"]).collect()) for n in (1, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    keep = {r[0]: r[3] for r in runs[0]}
    assert sum(keep[i] for i, _ in good[3:]) >= 70 and sum(keep[i] for i, _ in bad) <= 3
