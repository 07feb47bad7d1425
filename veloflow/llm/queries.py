"""The corpus operators as named queries over the driver tables, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veloflow.llm.chat import render
from veloflow.llm.clustering import cluster
from veloflow.llm.html_text import extract
from veloflow.llm.minhash import min_hash_duplicates
from veloflow.llm.mixing import mix
from veloflow.llm.neardup import near_duplicates
from veloflow.llm.packing import pack
from veloflow.llm.quality import quality_report
from veloflow.llm.repair import repair
from veloflow.llm.search import every_twentieth, top_k
from veloflow.llm.secrets import scan
from veloflow.llm.token_files import token_files
from veloflow.llm.warc import round_trip

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op1_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return top_k(docs, every_twentieth(docs))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return min_hash_duplicates(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
pos AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
nb AS (SELECT r, p, word, lag(word) OVER o AS prev, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2,
  lead(word, 3) OVER o AS w3, lead(word, 4) OVER o AS w4 FROM pos WINDOW o AS (PARTITION BY r ORDER BY p)),
seen AS (SELECT r, p, count(*) OVER (PARTITION BY r, word, w1, w2, w3, w4) AS n FROM nb WHERE w4 IS NOT NULL),
rep AS (SELECT r, least(5, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 5)) AS cover FROM seen WHERE n > 1),
repeated AS (SELECT r, sum(cover) AS n FROM rep GROUP BY r),
stutter AS (SELECT r, count(*) AS n FROM nb WHERE word = prev GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(stutter.n, 0) AS n_stutter
  FROM w LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r) LEFT JOIN stutter USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols * 10 > n_words OR n_stutter * 10 > n_words * 3
    OR (n_dup_lines > 2 AND n_dup_lines * 5 > n_words) OR word_chars > n_words * 15 OR word_chars < n_words * 2) AS kept
FROM m
"""

MIXING_SQL = r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  md5(coalesce(doc_id::VARCHAR, chr(0))) AS turn FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS weight FROM sources),
fill AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
  coalesce(sum(3 * source_size) OVER before, 0) AS caps_before, coalesce(sum(weight) OVER before, 0) AS weights_before
  FROM weighed WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rates AS (SELECT min_by(total - caps_before, weights_before) AS top, min_by(weights - weights_before, weights_before) AS bottom
  FROM fill WHERE weight * (total - caps_before) <= 3 * source_size * (weights - weights_before)),
aimed AS (SELECT source, source_size, CASE WHEN weight * top > 3 * source_size * bottom THEN (3 * source_size)::DOUBLE
  ELSE weight::DOUBLE * top::DOUBLE / bottom::DOUBLE END AS target FROM weighed, rates),
placed AS (SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
  coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY turn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target, (CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
  + greatest(0, least(size, budget - budget // source_size * source_size - start)) END)::BIGINT AS taken FROM placed
"""

SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
tf AS (SELECT r, doc_id, word, count(*) AS tf FROM (SELECT r, doc_id, unnest(ws) AS word FROM d) GROUP BY ALL),
stats AS (SELECT count(*) AS n, greatest(sum(len(ws)), 1) / count(*) AS mean FROM d),
sizes AS (SELECT r, len(ws) AS size FROM d),
df AS (SELECT word, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, stats GROUP BY word),
q AS (SELECT doc_id AS query_id, word, tf * idf AS weight FROM tf JOIN df USING (word) WHERE doc_id % 20 = 0),
scored AS (SELECT query_id, tf.doc_id, round(sum(weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 6) AS score
  FROM q JOIN tf USING (word) JOIN sizes USING (r), stats GROUP BY query_id, r, tf.doc_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored QUALIFY rank <= 10
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f
"""

CHAT_SQL = """
WITH lines AS (SELECT conv_id, turn, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS line FROM conversations),
p AS (SELECT conv_id, string_agg(line, '') OVER so_far AS prefix, row_number() OVER so_far AS place, count(*) OVER (PARTITION BY conv_id) AS n
  FROM lines WINDOW so_far AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS (SELECT prefix, n, min(conv_id) AS conv_id, count(*) AS n_equal FROM p WHERE place = n GROUP BY prefix, n)
SELECT conv_id, n AS n_turns, n_equal, prefix AS rendered FROM whole
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.place < p.n AND p.place = whole.n AND p.prefix = whole.prefix)
"""

MINHASH_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END) AS shingle FROM d),
n AS MATERIALIZED (SELECT r, count(*) AS size FROM s GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.r < b.r GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM pairs JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * common >= 80 * (p.size + q.size - common)),
reach AS (SELECT r, r AS other FROM d UNION
  SELECT reach.r, e.y FROM reach JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) e ON e.x = reach.other)
SELECT d.doc_id, coalesce(any_value(n.size), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id, d.doc_id IS NOT DISTINCT FROM min(o.doc_id) AS kept
FROM d JOIN reach ON reach.r = d.r JOIN d o ON o.r = reach.other LEFT JOIN n ON n.r = d.r GROUP BY d.r, d.doc_id
"""


def clustering_sql(rounds: int = 3, count: int = 16) -> str:
    """The rounds written out one after another, all in whole numbers."""
    near = """SELECT vec_id, v.r, arg_min(c.number, struct_pack(far := gap(v.x, c.x), number := c.number)) AS number, min(gap(v.x, c.x)) AS far FROM v, {c} c GROUP BY vec_id, v.r"""
    gap = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        "v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS number, x FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {count}))",
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED ({near.replace('gap(v.x, c.x)', gap.format(a='v.x', b='c.x')).format(c=f'c{i}')})")
        if i < rounds:
            steps.append(f"m{i} AS (SELECT number, place, (s - ((s % k) + k) % k) // k AS x FROM (SELECT number, place, sum(value)::BIGINT AS s, count(*) AS k FROM (SELECT number, unnest(v.x) AS value, generate_subscripts(v.x, 1) AS place FROM a{i} JOIN v USING (r)) GROUP BY number, place))")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.number, coalesce(any_value(n.x), any_value(c.x)) AS x FROM c{i} c LEFT JOIN (SELECT number, list(x ORDER BY place) AS x FROM m{i} GROUP BY number) n ON n.number = c.number GROUP BY c.number)")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, a.number::INTEGER AS cluster, far::BIGINT AS distance, (sum(far) OVER (PARTITION BY a.number))::BIGINT AS cluster_inertia, (sum(far) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.number = a.number"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_exact_top_k_search,
        op2_secret_scans,
        op3_token_files,
        op4_mixing,
        op5_quality_rules,
        op6_warc,
        op7_chat_formatting,
        op8_simhash_near_dedup,
        op9_html_extraction,
        op10_best_fit_packing,
        op11_conversation_repair,
        op12_minhash_near_dedup,
        op13_centroid_clustering,
    )
}
ORACLE: dict[str, str] = {
    "op1_exact_top_k_search": SEARCH_SQL,
    "op4_mixing": MIXING_SQL,
    "op5_quality_rules": QUALITY_SQL,
    "op6_warc": WARC_SQL,
    "op7_chat_formatting": CHAT_SQL,
    "op12_minhash_near_dedup": MINHASH_SQL,
    "op13_centroid_clustering": clustering_sql(),
}
