"""The registered queries of this package: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import capfilter, mixing, oph, packing, partcode, pieces, quality, resample, sanitise, secrets, threshold, tokenstore, toxicity
from lodestar.llm.common import read_table, shared_path, tokenizer_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


@query("op1_cap_filter_dedup", """
WITH RECURSIVE
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
             label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
             AND len(list_filter(embedding, lambda e: e <> 0)) > 0 AS fine FROM embeddings),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
         ON a.label = b.label AND a.vec_id <> b.vec_id AND a.fine AND b.fine AND len(a.x) = len(b.x)
         WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(deg.n, 0) AS n_links, comp.c AS component_id, v.vec_id = comp.c AS kept
FROM v JOIN comp ON comp.a = v.vec_id LEFT JOIN deg ON deg.a = v.vec_id""")
def op1(spark, sf_dir):
    return capfilter.near_vectors(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


@query("op2_minhash_dedup", r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5
        THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT i.a, i.b FROM i JOIN s x ON x.doc_id = i.a JOIN s y ON y.doc_id = i.b
         WHERE 100 * i.n >= 75 * (len(x.sh) + len(y.sh) - i.n)),
reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c, count(*) AS n FROM reach GROUP BY a),
same AS (SELECT list_sort(sh) AS k, count(*) AS n FROM s GROUP BY 1)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, comp.c AS component_id, s.doc_id = comp.c AS kept,
       CASE WHEN len(s.sh) = 0 THEN 1 ELSE same.n END AS n_class
FROM s JOIN comp ON comp.a = s.doc_id JOIN same ON same.k = list_sort(s.sh)""")
def op2(spark, sf_dir):
    return oph.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query("op3_threshold_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS DOUBLE)) AS x
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.x, r.x) AS BIGINT) AS score
      FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.x) = len(r.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""")
def op3(spark, sf_dir):
    v = threshold.integer_vectors(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))
    return threshold.top_k(v.where("id % 50 = 0"), v)


@query("op4_nnls_packing")
def op4(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), tokenizer_file("word_bpe_49k.json"))


@query("op10_perfect_hash_store")
def op10(spark, sf_dir):
    path = shared_path(spark, "store")
    tokenstore.store(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), path, tokenizer_file("byte_bpe_50k.json"))
    return tokenstore.digest(spark, path, tokenstore.entries(spark, path).select("doc_id", "copy"))


@query("op7_disclosure_pii")
def op7(spark, sf_dir):
    return sanitise.digest(sanitise.sanitise(read_table(spark, sf_dir, "documents", ["doc_id", "text"])))


@query("op5_prefix_viterbi")
def op5(spark, sf_dir):
    return pieces.digests(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), tokenizer_file("piece_bpe_32k.model"))


@query("op6_secret_forest")
def op6(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return secrets.scan(docs, secrets.fit(docs))


@query("op8_line_crf_quality")
def op8(spark, sf_dir):
    return quality.classify(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                            read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


@query("op9_string_kernel_toxicity")
def op9(spark, sf_dir):
    return toxicity.classify(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                             read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


def _nearest(n: int) -> str:
    """Steps of the SQL of operator 11: parts to the nearest entries of the n-th codebooks."""
    return f"""
d{n} AS (SELECT p.vec_id, p.j, p.part, c.e, list_sum(list_transform(list_zip(p.part, c.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
         FROM p JOIN c{n} c ON c.j = p.j),
a{n} AS (SELECT vec_id, j, part, e, CAST(d AS BIGINT) AS d FROM d{n} QUALIFY row_number() OVER (PARTITION BY vec_id, j ORDER BY d, e) = 1)"""


def _means(n: int) -> str:
    return f"""
m{n} AS (SELECT j, e, k, CAST(floor(sum(part[k]) / count(*)) AS BIGINT) AS v FROM a{n - 1}, range(1, len(part) + 1) r(k) GROUP BY j, e, k),
c{n} AS (SELECT c.j, c.e, coalesce(m.part, c.part) AS part FROM c{n - 1} c
         LEFT JOIN (SELECT j, e, list(v ORDER BY k) AS part FROM m{n} GROUP BY j, e) m ON m.j = c.j AND m.e = c.e)"""


@query("op11_trie_part_codes", f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
p AS (SELECT vec_id, j, x[j * (len(x) // 16) + 1 : (j + 1) * (len(x) // 16)] AS part FROM k, range(16) r(j)),
c0 AS (SELECT j, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS e, part FROM p QUALIFY e < 64),{_nearest(0)},{_means(1)},{_nearest(1)},{_means(2)},{_nearest(2)},
v AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY j) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id),
s AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY j, e)) AS codebooks_sha256 FROM c2)
SELECT v.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN k ON k.vec_id = v.vec_id, s""")
def op11(spark, sf_dir):
    return partcode.compress(read_table(spark, sf_dir, "embeddings", ["vec_id", "label", "embedding"]))


@query("op12_bit_sliced_resampling")
def op12(spark, sf_dir):
    return resample.resample(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), read_table(spark, sf_dir, "benchmark", ["text"]))


@query("op13_context_mixing_lm")
def op13(spark, sf_dir):
    return mixing.language_scores(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
