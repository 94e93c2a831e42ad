"""What the contracts of single operators ask for beyond their plain cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from zonewright.llm import segment, surrogates, toxicity, vafile, words
from zonewright.llm.catalog import VOCABULARY

import pyarrow as pa


# --- surrogates ------------------------------------------------------------------------------------
def _syllables(i, parts):
    out = ""
    while True:
        out += parts[i % len(parts)]
        i //= len(parts)
        if not i:
            return out


def test_surrogates_never_run_out_and_stay_distinct(spark):
    latin, cyrillic = ["ka", "lo", "mi", "ne", "su", "ta"], ["ка", "ло", "ми", "не", "су", "та"]
    n = 25_000
    rows = [(i, f"Mr. {_syllables(i, latin).title()}x met Господин {_syllables(i, cyrillic).title()}р") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    out = surrogates.replace(df).select("doc_id", F.split("text", " ").alias("w"), "n_entities").selectExpr("doc_id", "w[1] a", "w[4] b", "n_entities").collect()
    assert len(out) == n and {r["n_entities"] for r in out} == {2}
    real = {t.split(" ")[j] for _, t in rows for j in (1, 4)}
    assert len({r["a"] for r in out}) == n == len({r["b"] for r in out}) and not real & {r["a"] for r in out} and not real & {r["b"] for r in out}


def test_own_columns_come_back_and_hold_no_data(spark):
    df = spark.createDataFrame([("mine", "ann@x.com and ann@x.com", 1, "d", "o", "c", 9, "dot"), (None, None, 2, None, None, None, None, None)],
                               "_hits string, text string, _row int, _drawn string, _own string, c0 string, n_entities int, `a.b` string")
    out = surrogates.replace(df)
    assert out.columns == ["_hits", "text", "_row", "_drawn", "_own", "c0", "a.b", "n_entities"]
    got = sorted(map(tuple, out.collect()), key=lambda r: r[2])
    assert (got[0][0], *got[0][2:]) == ("mine", 1, "d", "o", "c", "dot", 2) and got[1] == (None, None, 2, None, None, None, None, 0)
    a, b = got[0][1].split(" and ")
    assert a == b != "ann@x.com" and a.endswith(".com")


def test_family_names_follow_the_gender_of_the_value(spark):
    texts = ["Госпожа Анна Петрова", "Господин Иван Петров", "Госпожа Ольга Коваленко", "Госпожа Сидорова и Сидорова", "Mrs. Anna Petrova"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in surrogates.replace(df).collect()}
    assert got[0].endswith(("ова", "ева", "ина")) and got[1].endswith(("ов", "ев", "ин")) and got[2].endswith("ко")
    first, _, again = got[3].split(" ")[1:]
    assert first == again and first.endswith(("ова", "ева", "ина")) and got[4].split(" ")[2].isascii()


# --- exact top-k -------------------------------------------------------------------------------------
def _brute_top(rows, k, every):
    took = [(j, i, [math.floor(256 * float(x)) for x in v]) for j, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for j, i, q in took:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), o) for n, o, v in took if n != j and len(v) == len(q))
            out += [(i, r + 1, o, -s) for r, (s, o) in enumerate(scores[:k])]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, v string, cls long, query long, rank int"


def _search(spark, rows, k=3, every=5, **settings):
    df = spark.createDataFrame([(i, v, "v", 1, 2, 3) for i, v in rows], VECTORS).repartition(3)
    return sorted(map(tuple, vafile.search(df, k, every).select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("size, digits", [(1.0, 2), (1e6, 0), (3e6, 0), (1e-9, 12)])
def test_topk_with_components_of_any_size(spark, monkeypatch, size, digits):
    monkeypatch.setattr(vafile, "DATA_ROWS", 16)
    monkeypatch.setattr(vafile, "QUERY_ROWS", 4)
    rng = random.Random(digits)
    rows = [(i, [round(rng.uniform(-size, size), digits) for _ in range(6)]) for i in range(150)]
    rows += [(200, [0.0] * 6), (205, [size] * 6), (210, [70_000.0] * 6), (215, [70_000.0] * 6), (220, None), (225, [None] * 6), (230, [math.inf] + [0.0] * 5),
             (235, [math.nan] * 6), (None, [size] * 6), (240, [1.0, 2.0]), (245, [1.5, 2.0])]
    assert _search(spark, rows) == _brute_top(rows, 3, 5)


def test_topk_counts_rows_that_repeat_an_id_or_a_vector(spark):
    rng = random.Random(5)
    vectors = [[float(rng.randrange(-3, 4)) for _ in range(3)] for _ in range(6)]
    rows = [(rng.randrange(12), rng.choice(vectors)) for _ in range(60)] + [(5, vectors[0])] * 4 + [(100, vectors[1])] * 9
    assert _search(spark, rows) == _brute_top(rows, 3, 5)
    assert _search(spark, [(5, [1.0, 2.0])]) == [] and _search(spark, []) == []


def test_topk_with_sums_that_pass_a_long_on_the_way(spark):
    big = 2.0**24
    rows = [(0, [big, big, 1.0]), (1, [2.0**23, -(2.0**23), 3.0]), (2, [1.0, 1.0, 1.0]), (3, [-big, big, 5.0])]
    assert _search(spark, rows) == _brute_top(rows, 3, 5)
    with pytest.raises(Exception, match="does not fit a long"):
        _search(spark, [(0, [1e300]), (1, [1.0])])
    with pytest.raises(Exception, match="(?i)overflow"):
        _search(spark, [(0, [2.0**50]), (1, [2.0**50])])


# --- toxicity ----------------------------------------------------------------------------------------
def _quoted(text, word="dullard"):
    matcher = toxicity.Matcher([word])
    return [h[3] for h in matcher.hits(text)]


@pytest.mark.parametrize("text, quoted", [
    ('he said "hi there" you dullard and "other" things', False), ('see the sign" you dullard "x"', False), ('they wrote "you dullard" to me', True),
    ('"' + "long words go on and on here " * 3 + 'dullard and more"', True), ("«you dullard»", True), ("„du dullard“ sagte er", True), ("you dullard", False),
    ('she said "you dullard', True), ('"you dullard', False), ('"open on one line\nyou dullard" there', False), ("»du dullard.«", True)])
def test_quotations_are_judged_from_their_marks(text, quoted):
    assert _quoted(text) == [quoted]


@pytest.mark.parametrize("text", ["ДУРАЦКИЙ текст", "Дурацкий", "дурацкий", "ΓΕΛΟΊΟΣ ДУРАЦКИЙ", "İ дурацкий", "x" * 300_000 + " ДУРАЦКИЙ"])
def test_capitals_of_all_scripts_are_lowered_alike(text):
    matcher = toxicity.Matcher(["дурацкий"])
    (chunk,) = words.chunks(pa.array([text, "clean"]), 1 << 30)
    assert matcher.may_hold(chunk).tolist() == [0] and [h[1] for h in matcher.hits(text)] == ["дурацкий"]


def test_long_words_meet_stems_and_no_entry():
    matcher = toxicity.Matcher(["dull*", "stupid"])
    assert matcher.find("dull" + "x" * 1_000_000) == ("dull*", 0) and matcher.find("stupid" + "x" * 1_000_000) is None
    (chunk,) = words.chunks(pa.array(["dull" + "x" * 500, "stupid" + "y" * 500]), 1 << 30)
    assert matcher.may_hold(chunk).tolist() == [0]


# --- segmentation ------------------------------------------------------------------------------------
def test_decoding_gives_the_texts_again(spark):
    texts = ["Hello world", "  two  spaces \n", "漢字 😀 ünï\u0007", "", None, "word " * 20_000, "Hello world"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = segment.segment(df, VOCABULARY, 2).select("doc_id", "ids")
    got = {r["doc_id"]: r["text"] for r in segment.decode(found, VOCABULARY).collect()}
    assert got == {i: t or "" for i, t in enumerate(texts)}
    own = spark.createDataFrame([(None, "x"), ([], "y")], "ids array<int>, text string")
    assert [r["text"] for r in segment.decode(own, VOCABULARY).collect()] == ["", ""]
    with pytest.raises(Exception, match="not an id"):
        segment.decode(spark.createDataFrame([([10**6],)], "ids array<int>"), VOCABULARY).collect()
