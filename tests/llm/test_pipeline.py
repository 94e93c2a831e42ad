"""Each stage of the pipeline against a plain version, and all of them in turn, on texts with every odd case."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_operators import brute_components
from test_references import brute_leaks
from zonewright.llm import segment, toxicity
from zonewright.llm.catalog import VOCABULARY

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "well Anna Smith bought 12 apples for 30 dollars and then sold 12 apples to her friend Bob yesterday"
TOLD = "so well Carla Jones bought 7 apples for 99 euros and then sold 7 apples to her friend Tim yesterday again"
STAGES = dict(corpus_pipeline.STAGES)


def texts():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "ka lo mi ne pu ra".split() for b in "ren sta tor vel wig".split()]
    plain = [(i, " ".join(rng.choices(vocabulary, k=30 + i))) for i in range(60)]
    toxic = [(100 + i, " ".join(rng.choices(vocabulary, k=15)) + " you stupid grobbel " + " ".join(rng.choices(vocabulary, k=5))) for i in range(60)]
    copies = [(200, plain[0][1]), (201, plain[0][1]), (202, plain[59][1].upper()), (203, plain[50][1] + " more")]
    private = [(300, "write to ann.lee92@mail8.example.com or call +1 (489) 555-0950 today"), (301, "write to ann.lee92@mail8.example.com once more for all")]
    odd = [(400, None), (401, ""), (402, " \n\t"), (403, "Ünïcode — 漢字 😀"), (404, "long " * 20_000 + "end"), (None, "a row without any id"), (None, None), (405, "one")]
    return plain, toxic, copies + [(500, f"Before. {ITEM} After."), (501, TOLD)] + private + odd + [plain[1], odd[3]]


def tables(spark, path, rows, labels):
    docs = spark.createDataFrame([(i, t, "en" if i else None, None if i == 3 else "web", len(t) if t else None) for i, t in rows], DOCS).repartition(3)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    plain, toxic, rest = texts()
    labels = [(i, 1, 0) for i, _ in plain] + [(i, 0, 1) for i, _ in toxic]
    return path, tables(spark, path, plain + toxic + rest, labels), plain, toxic, rest


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_toxic_documents_go_and_others_stay_as_they_are(spark, made):
    path, docs, plain, toxic, rest = made
    out = STAGES["toxicity"](spark, docs, path)
    assert out.columns == corpus_pipeline.COLUMNS
    kept, bad = rows_of(out), {i for i, _ in toxic}
    assert kept == Counter({r: n for r, n in rows_of(docs).items() if r[0] not in bad})
    scored = toxicity.detect(docs, spark.read.parquet(f"{path}/labels.parquet"))
    assert scored.count() == docs.count() and scored.where("score is null or score < 0 or score > 1").isEmpty()


def test_one_document_of_each_group_of_copies_stays(spark, made):
    path, docs, *_ = made
    out = STAGES["ngram_jaccard_join"](spark, docs, path)
    groups = brute_components([(i, t) for i, t in pairs(docs) if i is not None], 5, 80)
    assert rows_of(out) == Counter({r: n for r, n in rows_of(docs).items() if r[0] is None or groups[r[0]][1] == r[0]})
    assert not {200, 201, 202, 203} & {i for i, _ in pairs(out)}


def test_documents_with_benchmark_items_go(spark, made):
    path, docs, *_ = made
    leaked = {r[0] for r in brute_leaks(pairs(docs), [(1, ITEM)])}
    assert leaked == {500, 501}
    assert rows_of(STAGES["benchmark_decontamination"](spark, docs, path)) == Counter({r: n for r, n in rows_of(docs).items() if r[0] not in leaked})


def test_private_data_is_replaced_and_nothing_else(spark, made):
    path, docs, *_ = made
    out = STAGES["pii"](spark, docs, path)
    assert out.columns == corpus_pipeline.COLUMNS
    before, after = rows_of(docs), rows_of(out)
    changed, given = before - after, after - before
    assert {r[0] for r in changed} == {300, 301} == {r[0] for r in given} and sum(after.values()) == sum(before.values())
    got = {r[0]: r for r in given}
    assert all(r[4] == len(r[1]) for r in given) and "ann.lee92" not in got[300][1] + got[301][1] and "555-0950" not in got[300][1]
    assert got[300][1].split()[2] == got[301][1].split()[2]


def test_ids_give_the_texts_again(spark, made):
    path, docs, *_ = made
    out = STAGES["sentencepiece"](spark, docs, path)
    again = segment.decode(out.select("doc_id", "ids"), VOCABULARY).select("doc_id", "text")
    assert rows_of(again) == Counter((i, t or "") for i, t in pairs(docs)) and out.where("not decoded").isEmpty()


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_an_empty_table(spark, made, name):
    path, docs, *_ = made
    assert STAGES[name](spark, docs.limit(0), path).collect() == []


@pytest.mark.parametrize("name", list(STAGES)[:4])
def test_stages_with_more_columns(spark, made, name):
    path, docs, *_ = made
    few = docs.where("doc_id < 3 or doc_id > 299 and doc_id < 404")
    more = few.withColumns({c: F.lit("own") for c in ("hash", "id", "label", "score", "predicted", "component_id", "k", "size", "n_entities", "_row")})
    assert rows_of(STAGES[name](spark, more, path)) == rows_of(STAGES[name](spark, few, path))


def test_all_stages_in_turn(spark, made):
    path, docs, plain, toxic, rest = made
    out = corpus_pipeline.run(spark, path)
    left = [(i, t) for i, t in pairs(docs) if i not in {j for j, _ in toxic}]
    groups = brute_components([(i, t) for i, t in left if i is not None], 5, 80)
    left = [(i, t) for i, t in left if i is None or groups[i][1] == i]
    leaked = {r[0] for r in brute_leaks(left, [(1, ITEM)])}
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(i for i, _ in left if i not in leaked)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "pii", "sentencepiece"]
