"""The queries of these operators, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractframe.llm import byte_bpe, code_search, collocations, cotraining, decontaminate, filter_audit, minhash_forest, packing, pseudo_likelihood, substring_dedup, token_store, toxicity, warc
from contractframe.llm.common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(), 1024)


@query
def op2_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return code_search.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


ORACLES["op2_code_search"] = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
     p AS (SELECT q.vec_id AS query_id, r.vec_id AS id, list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: CASE WHEN z[1] = z[2] THEN 0 ELSE 1 END)) AS distance
           FROM c q, c r WHERE q.vec_id % 100 = 0),
     k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, CAST(distance AS BIGINT) AS distance FROM k WHERE rank <= 10
"""


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score_documents(table(spark, sf_dir, "documents"), own_words=True)


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


ORACLES["op5_warc"] = """
WITH own AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
     told AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM own),
     ranked AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM told)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN first END AS refers_to
FROM ranked
"""


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_report(table(spark, sf_dir, "documents"), 35)


ORACLES["op6_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
     p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35),
     w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM p),
     r AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
     gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM w JOIN r USING (h)),
     flat AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS j FROM d),
     kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t, count(*) AS n FROM flat ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query
def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotraining.score_documents(docs, cotraining.train(docs, table(spark, sf_dir, "labels")))


@query
def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), vocabulary())
    return token_store.read_tokens(spark, manifest)


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.drop("item_ids")


ORACLES["op9_decontaminate"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
     s AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM b WHERE len(ws) > 0),
     w AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM s),
     sizes AS (SELECT DISTINCT n FROM w),
     p AS (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n),
     occ AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM p),
     hit AS (SELECT doc_id, i, o.n, item_id FROM occ o JOIN w ON o.win = w.win AND o.n = w.n),
     words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
     items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op10_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), 75)


ORACLES["op10_minhash_forest"] = r"""
WITH RECURSIVE
     d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
     s AS (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM d WHERE len(ws) > 0),
     g AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS h FROM s),
     n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
     overlap AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
     links AS (SELECT x, y FROM overlap JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
     reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
     comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN n USING (doc_id)
"""


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH RECURSIVE
     d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
     m AS (SELECT d.doc_id, part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
                  len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
                  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
                  regexp_matches(t, '[#$%&*|]') AS d, d.doc_id > min(d.doc_id) OVER (PARTITION BY t) AS e
           FROM d LEFT JOIN labels USING (doc_id)),
     f AS (SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
                  || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails, count(*) AS n FROM m GROUP BY ALL),
     o AS (SELECT '' AS p UNION ALL SELECT p || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(p, x)),
     s AS (SELECT p AS filter_order, step, substr(p, step, 1) AS x, substr(p, 1, step - 1) AS gone FROM o, (SELECT unnest(range(1, 6)) AS step) WHERE length(p) = 5),
     r AS (SELECT part, filter_order, step, x, n, good, toxic, contains(fails, x) AS hit, fails = x AS alone,
                  regexp_matches(fails, '[_' || gone || ']') AS before FROM f, s),
     k AS (SELECT part, filter_order, step, x,
                  coalesce(sum(n) FILTER (NOT before AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (hit AND NOT before), 0) AS removed,
                  coalesce(sum(n) FILTER (hit AND before), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
                  coalesce(sum(n) FILTER (hit AND NOT before AND good), 0) AS good_lost,
                  coalesce(sum(n) FILTER (hit AND NOT before AND toxic), 0) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM k
"""


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, pattern)
    return byte_bpe.decode_documents(encoded, ranks, pattern).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), 100, 2000)


ORACLES["op12_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
           FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
     g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
           FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS m) WHERE len(ws) >= m)),
     f AS (SELECT lang, m, phrase, count(*) AS n FROM g GROUP BY ALL),
     total AS (SELECT lang, sum(n)::HUGEINT AS n FROM f WHERE m = 1 GROUP BY lang),
     c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, n AS a FROM f WHERE m > 1 AND n >= 100),
     cuts AS (SELECT lang, m, phrase, ws, a, unnest(range(1, m)) AS k FROM c),
     s AS (SELECT x.lang, x.phrase, x.m, x.a, k, h.n AS l, t.n AS r, total.n, (1000::HUGEINT * x.a * total.n) // (h.n::HUGEINT * t.n) AS score
           FROM cuts x JOIN total ON total.lang = x.lang
           JOIN f h ON h.lang = x.lang AND h.phrase = array_to_string(x.ws[1:k], ' ') AND h.m = k
           JOIN f t ON t.lang = x.lang AND t.phrase = array_to_string(x.ws[k + 1:x.m], ' ') AND t.m = x.m - k),
     best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     left_ AS (SELECT * FROM best b WHERE NOT EXISTS (
         SELECT 1 FROM c WHERE c.lang = b.lang AND c.m > b.m AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.a >= 100 * b.a)),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
