"""The operators as registered queries over the given tables, and DuckDB SQL
for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.llm import (bpe_chunks, bytecnn_lang, conv_trie, decontam, gam_quality, html_wrapper, interleave,
                         minhash_tensor, packing, target_resample, token_resync, voronoi_knn, warc_revisit)
from bowline.llm.common import importable
from bowline.sources.corpus import read_table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return html_wrapper.extract_main_text(spark, read_table(spark, sf_dir, "pages"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as crawl records: per revisit what it resolves to, the merged
    headers as sorted lines."""
    records = warc_revisit.crawl_records(read_table(spark, sf_dir, "pages"))
    lines = F.array_join(F.array_sort(F.transform(
        F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return warc_revisit.resolve_revisits(spark, records).withColumn("headers", lines)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return minhash_tensor.near_duplicates(spark, read_table(spark, sf_dir, "documents"), width=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontam.benchmark_hits(spark, docs, read_table(spark, sf_dir, "benchmark"), "hits")
    return (hits.select("doc_id", "hits.n_words", "hits.n_hit", "hits.n_items", "hits.items_sha256")
            .withColumn("contaminated", F.col("n_hit") > 0))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_resync.count_tokens(docs).drop("text")


def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return gam_quality.classify_quality(spark, read_table(spark, sf_dir, "documents"),
                                        read_table(spark, sf_dir, "labels"))


def op7_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave.shard_rows(spark, read_table(spark, sf_dir, "documents"))


def op8_language_bytecnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return bytecnn_lang.identify_languages(spark, read_table(spark, sf_dir, "documents"))


def op9_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return voronoi_knn.top_k(spark, read_table(spark, sf_dir, "embeddings"))


def op10_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return packing.pack_documents(spark, read_table(spark, sf_dir, "documents"))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return target_resample.resample(spark, read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "benchmark"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return conv_trie.shared_prefixes(spark, read_table(spark, sf_dir, "conversations"))


def op13_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them."""
    importable(spark)
    coded = bpe_chunks.encode_documents(spark, read_table(spark, sf_dir, "documents"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_warc_revisits, op3_minhash_dedup, op4_decontamination, op5_token_counts,
    op6_quality_gam, op7_interleaved_shards, op8_language_bytecnn, op9_voronoi_topk, op10_bestfit_packing,
    op11_target_resampling, op12_conversation_trie, op13_bpe_chunks)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CANON = """
bare AS (SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i)https?://', '') AS b FROM pages),
place AS (SELECT *, regexp_extract(b, '^[^?]*') AS p, regexp_extract(b, '\\?(.*)$', 1) AS q FROM bare),
parts AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(p, '^[^/]*')), '^www\\.', ''), ':(80|443)$', '') AS host,
  regexp_replace(regexp_replace(regexp_extract(p, '/.*$'), '\\.html$', ''), '/+$', '') AS path,
  list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND regexp_extract(x, '^[^=]*') NOT IN ({tracking}))) AS params
  FROM place),
canon AS (SELECT page_id, html, nullif(host || path || CASE WHEN len(params) > 0
  THEN '?' || array_to_string(params, '&') ELSE '' END, '') AS canonical_url FROM parts)
""".format(tracking=", ".join(f"'{t}'" for t in warc_revisit.TRACKING))

ORACLE = {
    "op2_warc_revisits": f"""
WITH {_CANON},
resp AS (SELECT 2 * page_id AS source_id, page_id AS ts, canonical_url, md5(coalesce(html, '')) AS tag,
  strlen(coalesce(html, '')) AS size FROM canon),
rev AS (SELECT 2 * page_id + 1 AS record_id, page_id + 1000 AS ts, canonical_url, md5(coalesce(html, '')) AS tag FROM canon),
hit AS (SELECT rev.record_id, rev.ts, rev.canonical_url, rev.tag, resp.source_id, resp.size,
  CASE WHEN resp.source_id IS NULL THEN 'no_response' WHEN resp.tag <> rev.tag THEN 'validator_mismatch' ELSE 'resolved' END AS outcome
  FROM rev ASOF LEFT JOIN resp ON rev.canonical_url = resp.canonical_url AND rev.ts >= resp.ts)
SELECT record_id, canonical_url, CASE WHEN outcome = 'resolved' THEN source_id END AS source_id, outcome,
  CASE WHEN outcome = 'resolved' THEN 200::INTEGER END AS status,
  CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || size || chr(10)
    || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10) || 'etag: W/' || tag END AS headers
FROM hit""",
    "op3_minhash_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")},
  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
  ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s FROM w),
sized AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y
  WHERE 100 * i >= 80 * (p.n + q.n - i)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
comp AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM documents d LEFT JOIN sized USING (doc_id) LEFT JOIN comp USING (doc_id)""",
    "op4_decontamination": f"""
WITH dw AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item_id, least(len(ws), 10) AS n,
  unnest(list_transform(range(1, greatest(1, len(ws) - 9) + 1), lambda i: array_to_string(ws[i:i + 9], ' '))) AS s
  FROM iw WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM dw, sizes WHERE len(ws) >= n),
hits AS MATERIALIZED (SELECT DISTINCT d.doc_id, d.i, d.n, w.item_id FROM
  (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS s FROM dwin) d JOIN win w ON d.n = w.n AND d.s = w.s),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
  (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
  (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op7_interleaved_shards": f"""
WITH crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
base AS (SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
crc AS (SELECT doc_id, source, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(range(size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
  lambda c, b: xor(t[(xor(c, b) % 256) + 1], c // 256))) AS text_crc32 FROM base, crc_table),
keyed AS (SELECT *, coalesce('=' || source, '') AS stratum,
  ('0x' || substr(md5('{interleave.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key FROM crc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id, text_crc32, size) AS k,
  count(*) OVER (PARTITION BY stratum) AS n,
  ('0x' || substr(md5('{interleave.SEED}:' || stratum), 1, 15))::BIGINT::DOUBLE / 1152921504606846976.0::DOUBLE AS phase FROM keyed),
placed AS (SELECT *, row_number() OVER (ORDER BY ((k - 1)::DOUBLE + phase) / n, stratum, key, doc_id, text_crc32, size) - 1 AS pos,
  count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, CASE WHEN pos < (total % 8) * (total // 8 + 1) THEN pos // (total // 8 + 1)
  ELSE total % 8 + (pos - (total % 8) * (total // 8 + 1)) // greatest(total // 8, 1) END AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
  (pos - shard * (total // 8) - least(shard, total % 8))::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM cut""",
    "op11_target_resampling": f"""
WITH crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
dw AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, ws FROM dw),
tw AS MATERIALIZED (SELECT unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")},
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
fw AS MATERIALIZED (SELECT r, unnest(ws) AS w FROM docs),
words AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM fw UNION SELECT w FROM tw)),
bucket AS MATERIALIZED (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
  lambda c, b: xor(t[(xor(c, b) % 256) + 1], c // 256))) % 10000 AS b FROM words, crc_table),
s AS (SELECT b, count(*) AS n FROM fw JOIN bucket USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM tw JOIN bucket USING (w) GROUP BY b),
gain AS (SELECT b, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM fw) + 10000))::DOUBLE
  / ((s.n + 1) * ((SELECT count(*) FROM tw) + 10000))::DOUBLE))::BIGINT AS g FROM s LEFT JOIN t USING (b)),
weight AS (SELECT r, sum(g)::BIGINT AS weight FROM fw JOIN bucket USING (w) JOIN gain USING (b) GROUP BY r),
scored AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296::DOUBLE)))::BIGINT AS score FROM docs LEFT JOIN weight USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k,
  count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM ranked""",
    "op12_conversation_trie": """
WITH crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
  ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, hex(encode(conv_id::VARCHAR)) AS hx FROM own),
convs AS MATERIALIZED (SELECT conv_id, base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(range(len(hx) // 2), lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT)),
  lambda c, b: xor(t[(xor(c, b) % 256) + 1], c // 256))) % 9 AS h FROM ids, crc_table),
parts AS (SELECT c.conv_id, 1 AS part, place, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND place <= h
  UNION ALL SELECT c.conv_id, 2, place, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND place > h),
rebuilt AS MATERIALIZED (SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS b,
  md5(strlen(role) || ':' || role || text) AS t FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
lens AS (SELECT conv_id, coalesce(max(depth), 0) AS len FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
step AS MATERIALIZED (SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS b FROM convs UNION ALL
  SELECT a.conv_id, a.depth, string_agg(p.t, '' ORDER BY p.depth),
    coalesce(string_agg(p.t, '' ORDER BY p.depth) FILTER (p.depth < a.depth), ''), any_value(a.b)
  FROM rebuilt a JOIN rebuilt p ON p.conv_id = a.conv_id AND p.depth <= a.depth GROUP BY a.conv_id, a.depth),
nodes AS MATERIALIZED (SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, depth, count(*) AS n_convs, any_value(b) AS b,
  coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = depth), '') AS ends
  FROM step JOIN lens USING (conv_id) GROUP BY node, depth),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (SELECT DISTINCT d.node, a.node AS top FROM step d JOIN step a ON a.conv_id = d.conv_id AND a.depth <= d.depth),
under AS (SELECT top AS node, count(*) FILTER (kids.node IS NULL) AS n_leaves, sum((n_convs - 1) * b) AS saved
  FROM above JOIN nodes USING (node) LEFT JOIN kids USING (node) GROUP BY top)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
  n_leaves, saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN under USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes p ON p.node = n.parent""",
    "op9_voronoi_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
