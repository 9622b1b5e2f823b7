"""One query per operator, over its whole table, as the catalogue registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.llm import conversation_repair, html_crf, mixing, packing, pii, prefix_trie, quality, rp_forest, secret_scan, simhash, token_counts, vector_graph, warc
from tidemerge.llm.common import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: What SQL can express of these; the tests hold the others against brute force.
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.main_text(table(spark, sf_dir, "pages"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"), shared_folder(spark))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


@query
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return rp_forest.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The domains are languages, learnt from the documents that ``labels`` lists, at weights that lift the rare ones."""
    documents = table(spark, sf_dir, "documents")
    labelled = documents.select("doc_id", F.col("lang").alias("domain")).join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return mixing.mixing_rates(documents, labelled, power=0.7)


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repairs(conversation_repair.damage(table(spark, sf_dir, "conversations")))


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary lies on every executor beside the module that names its path."""
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


# every pair compared: where the operator finds all links, as it does at small sizes, both agree
ORACLE["op7_embedding_near_dedup"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, x FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)
    WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
reached AS (
    SELECT vec_id AS a, vec_id AS b FROM usable
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
groups AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, coalesce(g.component_id, e.vec_id) AS component_id, e.vec_id = coalesce(g.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN groups g ON g.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""

#: Base32 of a SHA-1: five bits at a time, each from two hexadecimal digits.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    ((strpos('0123456789abcdef', substr(sha, (5 * i // 4 + 1)::BIGINT, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(sha, (5 * i // 4 + 2)::BIGINT, 1)) - 1)
    // CASE 5 * i % 4 WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END % 32), 1)), '')"""

ORACLE["op5_warc"] = f"""
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS sha, max(page_id) OVER (PARTITION BY html) AS last
      FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
"""


def _crc32(text: str) -> str:
    """crc32 of a text of ASCII, a byte and a bit at a time."""
    return f"""xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), lambda x: ord(x)::UBIGINT)),
    lambda a, b: xor(a >> 8, list_reduce([xor(a & 255, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: CASE WHEN p & 1 = 1 THEN xor(3988292384, p >> 1) ELSE p >> 1 END))))"""


def _edit(state: str, cost: str, letter: str) -> str:
    """A state, its cost in seven digits and its audit, after one more edit."""
    return f"(lpad((left({state}, 7)::INT + {cost})::VARCHAR, 7, '0') || substr({state}, 8) || '{letter}')"


def _stay(initial: str, state: str) -> str:
    return f"CASE WHEN NOT gone AND initial = '{initial}' THEN {_edit(state, 'extra', 'K')} END"


def _role(state: str) -> str:
    return f"CASE WHEN NOT gone THEN {_edit(state, '3 + extra', 'R')} END"


# the least of cost and audit of each state (nothing, system, user, assistant), row by row; inserted turns in between
ORACLE["op11_conversation_repair"] = rf"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM given WHERE kind <> 0),
numbered AS (
    SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM numbered),
rows_ AS (
    SELECT conv_id, i, initial, role, text, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM judged),
convs AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
    SELECT conv_id, 0::BIGINT AS i, '0000000' AS s0, '1000000' AS s1, '0000003I' AS s2, '0000006II' AS s3 FROM convs
    UNION ALL
    SELECT conv_id, i, n0, n1, least(m2, {_edit('m3', '3', 'I')}), m3 FROM (
        SELECT *, least(n3, {_edit('m2', '3', 'I')}) AS m3 FROM (
            SELECT *, least(n2, {_edit('n0', '3', 'I')}, {_edit('n1', '3', 'I')}, {_edit('n3', '3', 'I')}) AS m2 FROM (
                SELECT r.conv_id, r.i, {_edit('s0', '4', 'D')} AS n0,
                       least({_edit('s1', '4', 'D')}, {_stay('s', 's0')}) AS n1,
                       least({_edit('s2', '4', 'D')}, {_role('s0')}, {_role('s1')}, {_role('s3')}, {_stay('u', 's0')}, {_stay('u', 's1')}, {_stay('u', 's3')}) AS n2,
                       least({_edit('s3', '4', 'D')}, {_role('s2')}, {_stay('a', 's2')}) AS n3
                FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)))),
best AS (
    SELECT conv_id, left(best, 7)::BIGINT AS cost, substr(best, 8) AS audit
    FROM (SELECT conv_id, arg_max(least(s0, s3), i) AS best FROM walk GROUP BY conv_id)),
edits AS (
    SELECT conv_id, j, substr(audit, j, 1) AS letter, length(replace(left(audit, j), 'I', '')) AS i
    FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM best)),
kept AS (
    SELECT e.conv_id, j, letter, r.role, initial, CASE WHEN letter = 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY e.conv_id ORDER BY j) AS place
    FROM edits e LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.i WHERE letter <> 'D'),
lines AS (
    SELECT *, place - max((place = 1 AND letter = 'K' AND initial = 's')::INT) OVER (PARTITION BY conv_id) AS turn_ FROM kept),
repaired AS (
    SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN turn_ % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j)) AS sha
    FROM lines GROUP BY conv_id),
counts AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM b.conv_id
"""

ORACLE["op13_prefix_trie"] = rf"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
    SELECT *, left(sha256(length(role) || ':' || role || text), 32) AS tid, len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM given),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) AS i FROM turns),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS leader, {_crc32('conv_id::VARCHAR')} % 4 AS shared FROM (SELECT DISTINCT conv_id FROM given)),
rebuilt AS (
    SELECT c.conv_id, 0 AS own, i, tid, words FROM convs c JOIN numbered n ON n.conv_id = c.leader AND n.i <= c.shared
    UNION ALL SELECT c.conv_id, 1, i, tid, words FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.i > c.shared),
paths AS (
    SELECT conv_id, 0 AS depth, '' AS path, 0 AS words FROM convs
    UNION ALL SELECT conv_id, row_number() OVER w, string_agg(tid, '') OVER w, words FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)),
nodes AS (
    SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY path),
children AS (
    SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
ends AS (
    SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path),
whole AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, coalesce(ends_sha256, sha256('')) AS ends_sha256
    FROM nodes n LEFT JOIN children USING (path) LEFT JOIN ends USING (path)),
below AS (
    SELECT left(path, 32 * up) AS path, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM whole) GROUP BY ALL)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children::BIGINT AS n_children,
    n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM whole w JOIN below USING (path) LEFT JOIN whole p ON w.depth > 0 AND p.path = left(w.path, 32 * (w.depth - 1))
"""
