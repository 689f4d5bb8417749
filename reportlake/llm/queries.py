"""The operators as queries over whole tables, with production parameters, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm import align, bpe, imatch, importance, licenses, nearset, nndescent, packing, pii, tokencount, topk, toxicity, warc
from reportlake.llm.common import ready
from reportlake.session import scratch_dir


#: The public pre-token pattern with its contractions written as one branch, and the same for ASCII texts.
BYTE_PATTERN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_PATTERN_ASCII = (r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|"
                      r"[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_voronoi_topk(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op2_packing(spark, sf_dir):
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          BYTE_PATTERN, ascii_pattern=BYTE_PATTERN_ASCII)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_license_scan(spark, sf_dir):
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op4_nn_descent(spark, sf_dir):
    return nndescent.near_vectors(_table(spark, sf_dir, "embeddings"), 0.93)


def op5_pii(spark, sf_dir):
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = [pii.count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op6_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_counts(spark, sf_dir):
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                   public_tokenizers.PATTERN)


def op8_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op9_near_duplicates(spark, sf_dir):
    return nearset.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op10_warc(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    path = f"{scratch_dir(spark, 'warc')}/archive"
    warc.write(pages, path)
    return warc.read(spark, path).drop("url")


def op11_importance_resampling(spark, sf_dir):
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_imatch_fingerprints(spark, sf_dir):
    return imatch.fingerprints(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark, sf_dir):
    return align.score_links(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"), BYTE_PATTERN, BYTE_PATTERN_ASCII)


def queries():
    return {f.__name__: f for f in (op1_voronoi_topk, op2_packing, op3_license_scan, op4_nn_descent, op5_pii, op6_bpe,
                                    op7_token_counts, op8_toxicity, op9_near_duplicates, op10_warc,
                                    op11_importance_resampling, op12_imatch_fingerprints, op13_token_alignment)}


_USABLE = "{x} IS NOT NULL AND len(list_filter({x}, lambda a: a IS NULL OR NOT isfinite(a))) = 0"

ORACLE_SQL = {
    "op1_voronoi_topk": f"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda a: floor(CAST(a AS DOUBLE) * 256)) AS y
                   FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE.format(x='embedding')}),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.y, c.y) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""",
    "op4_nn_descent": f"""
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE.format(x='embedding')}
                     AND len(list_filter(embedding, lambda a: a <> 0)) > 0),
             l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
                   WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
             reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
             c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
             n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
        SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links,
               coalesce(c.component_id, e.vec_id) AS component_id,
               e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
    "op9_near_duplicates": r"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda a: a <> '') AS w FROM documents),
             s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
                     ELSE list_distinct(list_transform(range(1, len(w) - 2),
                       lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2], ' ', w[i + 3]))) END AS s FROM w),
             n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
             -- every link has a partner among the documents of a shingle; the rarest tenth of a set would do, all are used
             u AS (SELECT doc_id, hash(unnest(s)) AS h FROM s),
             i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id
                   GROUP BY 1, 2),
             l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
             reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
             c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
        FROM n JOIN c ON c.a = n.doc_id""",
    "op10_warc": """
        WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                          sha1(coalesce(html, '')) AS payload_digest FROM pages),
             o AS (SELECT *, CASE WHEN payload_bytes >= 1000
                     THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS original FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original <> page_id THEN original END AS refers_to FROM o""",
    "op11_importance_resampling": r"""
        WITH RECURSIVE crc(b, c, k) AS (SELECT b, b, 0 FROM range(256) r(b) UNION ALL
                    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8),
             step AS (SELECT list(c ORDER BY b) AS t FROM crc WHERE k = 8),
             texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), text FROM benchmark),
             w AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
             g AS (SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat_ws(' ', w[i], w[i + 1])),
                            list_transform(range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2])))) AS f FROM w),
             f AS (SELECT side, id, f, count(*) AS n FROM g GROUP BY ALL),
             d AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM f)),
             h AS (SELECT f, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: CAST(concat('0x', substr(x, 2 * i + 1, 2)) AS BIGINT)),
                            lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket FROM d, step),
             m AS (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM f JOIN h USING (f) GROUP BY bucket),
             gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                            / ((coalesce(s, 0) + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM m),
             x AS (SELECT id, sum(n) AS n_features, sum(n * gain) AS weight FROM f JOIN h USING (f) JOIN gain USING (bucket) WHERE side = 0 GROUP BY id),
             y AS (SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                          CAST(concat('0x', substr(sha256(concat('42:', w.id)), 1, 8)) AS BIGINT)::DOUBLE AS h
                   FROM w LEFT JOIN x ON x.id = w.id WHERE side = 0),
             z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM y),
             r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM z WHERE n_words >= 20)
        SELECT z.doc_id, n_words::BIGINT AS n_words, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM z LEFT JOIN r ON r.doc_id = z.doc_id""",
}


def oracle_sql():
    return dict(ORACLE_SQL)
