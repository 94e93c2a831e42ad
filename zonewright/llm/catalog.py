"""Registered queries of the training-data operators over the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.llm import (archives, decontaminate, divergence, langid, middle, quality, repeats, segment, shards, signature_tree, storage,
                            surrogates, toxicity, vafile)


VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    storage.small_batches(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    return langid.identify(table(spark, sf, "documents"))


def op2_warc_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a WARC record in ZIP packages, read back by ranges."""
    return archives.round_trip(table(spark, sf, "pages"))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document from weak labels."""
    return quality.score(table(spark, sf, "documents"))


def op4_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with personal data and secrets replaced by keyed surrogates."""
    return surrogates.replace(table(spark, sf, "documents")).select("doc_id", "text", "n_entities")


def segmented(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The best segmentation's ids, and of the three best their scores, with a hash of what the others change."""
    found = segment.segment(docs, vocabulary, 3)
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), F.col("score").alias("best_score"),
                        F.expr("try_element_at(others, 1).score").alias("second_score"), F.expr("try_element_at(others, 2).score").alias("third_score"),
                        F.size("others").alias("n_others"), F.xxhash64(F.to_json("others")).alias("others_hash"), "decoded")


def op5_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Five nearest vectors by integer inner product for every fiftieth vector."""
    return vafile.search(table(spark, sf, "embeddings"), k=5, every=50)


def op6_sentencepiece_nbest(spark: SparkSession, sf: str) -> DataFrame:
    """The three best segmentations of every document, decoded again."""
    return segmented(table(spark, sf, "documents"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


def op7_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a benchmark item, as it stands or with other names, numbers and units."""
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op8_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents linked by sets of four-word shingles with a Jaccard similarity of 0.85 or more."""
    return signature_tree.jaccard_components(table(spark, sf, "documents"), k=4, percent=85)


def op9_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Shard and slot of every document by jump consistent hashing of doc_id into 40 shards."""
    return shards.assign(table(spark, sf, "documents"), 40)


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document by a lexicon learned from three quarters of the labels."""
    return toxicity.detect(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the passages of 13 words or more that an earlier document holds."""
    kept = repeats.remove(table(spark, sf, "documents"), 13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    """Divergence of the sources of each language from each other, and the terms that tell each from its language."""
    return divergence.audit(table(spark, sf, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Every document cut between lines and put in fill-in-middle form, and what its output restores to."""
    made = middle.transform(table(spark, sf, "documents"), seed=7, percent=100, spm_percent=50)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), "restored_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_warc_archives": op2_warc_archives,
    "op3_quality": op3_quality,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_exact_topk": op5_exact_topk,
    "op6_sentencepiece_nbest": op6_sentencepiece_nbest,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op2_warc_archives": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        f AS (SELECT h, min(page_id) AS least FROM p GROUP BY h)
        SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
                                for i in range(32)], '') AS payload_digest,
               CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to
        FROM p JOIN f USING (h)""",
    "op5_exact_topk": """
        WITH x AS (SELECT vec_id, unnest(embedding) AS c, generate_subscripts(embedding, 1) AS i, len(embedding) AS n FROM embeddings),
        v AS (SELECT vec_id, i, n, CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) AS c FROM x
              WHERE vec_id NOT IN (SELECT vec_id FROM x WHERE c IS NULL OR NOT isfinite(c))),
        s AS (SELECT q.vec_id AS query_id, o.vec_id, CAST(sum(q.c * o.c) AS BIGINT) AS score
              FROM v q JOIN v o ON q.i = o.i AND q.n = o.n AND q.vec_id <> o.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
        SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5""",
    "op8_ngram_jaccard_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
                             FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [w[i : i + 3] for i in range(1, len(w) - 2)] WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        l AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r AS (SELECT doc_id, doc_id AS o FROM d UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.o = u.a)
        SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.o) AS component_id
        FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY 1""",
    "op9_sharding": r"""
        WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(CAST(i AS UBIGINT), [CAST(k AS UBIGINT) for k in range(8)]),
                                                       lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
        x AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
        y AS (SELECT r, doc_id, CAST(octet_length(b) + 16 AS BIGINT) AS size, CAST(coalesce(doc_id, 0) AS UBIGINT) AS id,
                     xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), [CAST('0x' || h AS UBIGINT) for h in regexp_extract_all(hex(b), '..')]),
                                     lambda c, h: xor(c >> 8, t[CAST(1 + xor(c, h) % 256 AS BIGINT)])), CAST(4294967295 AS UBIGINT)) AS crc FROM x, crc),
        m1 AS (SELECT r, doc_id, size, crc, xor(id, id >> 30) AS z FROM y),
        m2 AS (SELECT r, doc_id, size, crc, CAST(CAST(z AS UHUGEINT) * 13787848793156543929 % 18446744073709551616 AS UBIGINT) AS z FROM m1),
        m3 AS (SELECT r, doc_id, size, crc, CAST(CAST(xor(z, z >> 27) AS UHUGEINT) * 10723151780598845931 % 18446744073709551616 AS UBIGINT) AS z FROM m2),
        m AS (SELECT r, doc_id, size, crc, xor(z, z >> 31) AS key FROM m3),
        o AS (SELECT r, CAST((CAST(key AS UHUGEINT) + (CAST(crc AS UHUGEINT) << 32) + CAST(size AS UHUGEINT)) % 18446744073709551616 AS UBIGINT) AS v FROM m),
        k1 AS (SELECT r, xor(v, v >> 30) AS z FROM o),
        k2 AS (SELECT r, CAST(CAST(z AS UHUGEINT) * 13787848793156543929 % 18446744073709551616 AS UBIGINT) AS z FROM k1),
        k3 AS (SELECT r, CAST(CAST(xor(z, z >> 27) AS UHUGEINT) * 10723151780598845931 % 18446744073709551616 AS UBIGINT) AS z FROM k2),
        k AS (SELECT r, xor(z, z >> 31) AS key FROM k3),
        j AS (SELECT r, key, CAST(-1 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS ahead FROM m
              UNION ALL
              SELECT r, key, shard, CAST(trunc((shard + 1) * (CAST(2147483648 AS DOUBLE) / CAST((key >> 33) + 1 AS DOUBLE))) AS BIGINT)
              FROM (SELECT r, ahead AS shard, CAST((CAST(key AS UHUGEINT) * 2862933555777941757 + 1) % 18446744073709551616 AS UBIGINT) AS key FROM j WHERE ahead < 41)),
        g AS (SELECT r, CAST(max(shard) FILTER (shard < 40) AS INTEGER) AS shard, CAST(max(shard) FILTER (shard < 41) AS INTEGER) AS grown_shard FROM j GROUP BY r)
        SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY k.key % 256, doc_id, crc, size) - 1 AS slot, grown_shard
        FROM m JOIN k USING (r) JOIN g USING (r)""",
    "op11_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS i, w FROM d WHERE len(w) >= 13),
        g AS (SELECT doc_id, i, hash(array_to_string(w[i : i + 12], ' ')) AS h, array_to_string(w[i : i + 12], ' ') AS x FROM s),
        f AS (SELECT x, min(doc_id) AS least FROM g GROUP BY x),
        gone AS (SELECT DISTINCT doc_id, i + j AS p FROM g JOIN f USING (x), generate_series(0, 12) AS t(j) WHERE doc_id > least),
        left_ AS (SELECT e.doc_id, string_agg(v, ' ' ORDER BY e.p) AS kept, count(*) AS n
                  FROM (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS p FROM d) e ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN left_ USING (doc_id)""",
    "op12_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
        l AS (SELECT lang, CAST(count(*) + sum(total) AS HUGEINT) AS all_ FROM k GROUP BY 1),
        c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
        g AS (SELECT lang, source, (SELECT count(*) FROM k WHERE k.lang = x.lang) + coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0) AS all_
              FROM (SELECT DISTINCT lang, source FROM d) x),
        p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1) // CAST(g.all_ AS HUGEINT) AS p,
                     1 + CAST(1000000000 AS HUGEINT) * (total + 1) // l.all_ AS q
              FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
              FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT * FROM r WHERE part = 'pair' OR rank <= 200""",
    "op13_fill_in_middle": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                     CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
        c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                          WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
        p AS (SELECT *, array_to_string(units[1:a], '') AS x, array_to_string(units[a + 1 : b], '') AS y, array_to_string(units[b + 1 : n], '') AS z FROM c)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(y) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM p""",
}
