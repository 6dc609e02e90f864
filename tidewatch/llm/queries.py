"""One query for each operator, over whole tables, and the SQL that states its rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format, decontaminate, language_id, lattice_lm, main_text, merkle, ngram_join, piece_codec, prefix_trie,
    token_count, topk_search, toxicity, url_filter,
)
from .common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text as DuckDB SQL."""
    return f"""xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
            lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)), 4294967295)"""


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build
    return register


URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


@query("""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://([^?#]*)', 1) ELSE '' END AS rest
    FROM pages),
part AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '(?s)/.*$') AS path FROM cut),
rules(action, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
SELECT page_id, any_value(host) AS host, any_value(path) AS path,
    arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    coalesce(arg_max(action, length(rule_host || rule_path)), 'allow') AS verdict
FROM part LEFT JOIN rules ON ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path)
GROUP BY page_id
""")
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@query("""
WITH sides AS (
    SELECT conv_id AS pair_id, 1 AS chosen, turn, role, text FROM conversations
    UNION ALL
    SELECT c.conv_id, 0, c.turn, c.role, c.text FROM conversations c
    LEFT JOIN (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id) l
        USING (conv_id) WHERE l.last IS NULL OR c.turn < l.last
    UNION ALL
    SELECT xor(c.conv_id, 1), 0, 1000000000 + c.turn, c.role, c.text FROM conversations c
    JOIN (SELECT conv_id, max(turn) AS turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id) l
        USING (conv_id, turn)
    WHERE c.role = 'assistant' AND EXISTS (SELECT 1 FROM conversations p WHERE p.conv_id = xor(c.conv_id, 1))),
placed AS (SELECT *, row_number() OVER (PARTITION BY pair_id, chosen ORDER BY turn, role, text) AS pos FROM sides),
meet AS (
    SELECT pair_id, pos, c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text
        AND c.pos IS NOT NULL AND r.pos IS NOT NULL AS same
    FROM (SELECT * FROM placed WHERE chosen = 1) c FULL JOIN (SELECT * FROM placed WHERE chosen = 0) r
        USING (pair_id, pos)),
common AS (
    SELECT pair_id, CAST(coalesce(min(pos) FILTER (NOT same) - 1, max(pos)) AS INTEGER) AS n FROM meet GROUP BY pair_id),
shown AS (
    SELECT pair_id, chosen, pos, pos <= n AS shared, '<|im_start|>' || coalesce(role, '') || chr(10) AS header,
        coalesce(text, '') || '<|im_end|>' AS body, coalesce(role = 'assistant', false) AS trained
    FROM placed JOIN common USING (pair_id))
SELECT pair_id, any_value(n) AS n_prompt_turns,
    coalesce(string_agg(header || body || chr(10), '' ORDER BY pos) FILTER (chosen = 1 AND shared), '') AS prompt,
    coalesce(string_agg(header || body || chr(10), '' ORDER BY pos) FILTER (chosen = 1 AND NOT shared), '') AS chosen,
    coalesce(string_agg(header || body || chr(10), '' ORDER BY pos) FILTER (chosen = 0 AND NOT shared), '') AS rejected,
    coalesce(string_agg('-' || length(header) || ',' || CASE WHEN trained THEN '+' ELSE '-' END || length(body)
        || ',-1', ',' ORDER BY pos) FILTER (chosen = 1 AND NOT shared), '') AS chosen_mask,
    coalesce(string_agg('-' || length(header) || ',' || CASE WHEN trained THEN '+' ELSE '-' END || length(body)
        || ',-1', ',' ORDER BY pos) FILTER (chosen = 0 AND NOT shared), '') AS rejected_mask
FROM shown JOIN common USING (pair_id) GROUP BY pair_id
""")
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with its last answer exchanged for that of its neighbour (conv_id XOR 1).

    Without a neighbour, or where the neighbour has no answer, the rejected side has none either.  Answers that tie in the
    last turn are all exchanged; answers without a turn are not.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    last = rows.where(F.col("role") == "assistant").groupBy("conv_id").agg(
        F.max("turn").alias("last"), F.collect_list(F.struct("turn", "text")).alias("answers"))
    chosen = rows.withColumnRenamed("conv_id", "pair_id")
    before = rows.join(last.drop("answers"), "conv_id", "left").where("last IS NULL OR turn < last").select(
        F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    known = rows.select(F.col("conv_id").alias("pair_id")).distinct()
    borrowed = last.select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("pair_id"), (F.lit(1000000000) + F.col("last")).alias("turn"),
        F.lit("assistant").alias("role"),
        F.explode(F.filter("answers", lambda a: a["turn"] == F.col("last"))).alias("_answer")
    ).select("pair_id", "turn", "role", F.col("_answer.text").alias("text")).join(known, "pair_id", "left_semi")
    pairs = chat_format.format_preferences(chosen, before.unionByName(borrowed))
    return pairs.select(
        "pair_id", "n_prompt_turns", "prompt", chat_format.render(F.col("chosen")).alias("chosen"),
        chat_format.render(F.col("rejected")).alias("rejected"), chat_format.mask(F.col("chosen")).alias("chosen_mask"),
        chat_format.mask(F.col("rejected")).alias("rejected_mask"))


@query("""
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
""")
def op3_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query()
def op9_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, fold("doc_id", 4) != 2)
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return toxicity.score(docs, model, threshold=0.3).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted",
        F.size("offending").alias("n_offending"))


@query()
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(spark, table(spark, sf_dir, "documents"), width=4, percent=85)


@query()
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out is the fold alone: a row without an id is not learned from, yet belongs to no fold."""
    docs = table(spark, sf_dir, "documents")
    scored = lattice_lm.score(
        spark, docs, public_tokenizers.path("piece_bpe_32k.model"), fold("doc_id", 7) != 2)
    return scored.withColumn("held_out", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)))


_FIELD_SQL = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || {0} END"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_FIELD_SQL.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


@query(f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
        CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")}
            ELSE {_leaf_sql('text')} END AS changed,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n
    FROM documents),
up(level, source, pos, digest, n) AS (
    SELECT 0, source, pos, leaf, n FROM leaves
    UNION ALL
    SELECT level + 1, source, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3
    FROM up WHERE n > 1 GROUP BY level, source, pos // 3),
subroots AS (
    SELECT source, digest AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
        count(*) OVER () AS n FROM up WHERE n = 1),
top(level, pos, digest, n) AS (
    SELECT 0, pos, subroot, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 2) // 3
    FROM top WHERE n > 1 GROUP BY level, pos // 3),
nodes AS (
    SELECT 'below ' || coalesce('+' || source, '') AS tree, level, pos, digest FROM up
    UNION ALL SELECT 'top', level, pos, digest FROM top),
runs AS (SELECT tree, level, pos // 3 AS run, list(digest ORDER BY pos) AS digests FROM nodes GROUP BY tree, level, pos // 3),
-- every leaf climbs its own tree, then that of the subroots
way AS (
    SELECT l.doc_id, l.source, l.leaf, l.changed, s.subroot, s.height, s.pos AS top_pos, l.pos,
        (SELECT max(level) FROM top) AS top_height FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
steps AS (
    SELECT way.*, step, 'below ' || coalesce('+' || source, '') AS tree, step AS level, pos // CAST(3 ** step AS BIGINT) AS place
    FROM way, range(64) t(step) WHERE step < height
    UNION ALL
    SELECT way.*, height + step, 'top', step, top_pos // CAST(3 ** step AS BIGINT) FROM way, range(64) t(step) WHERE step < top_height),
met AS (
    SELECT doc_id, source, leaf, step, digests[:place % 3] AS lefts, digests[place % 3 + 2:] AS rights
    FROM steps JOIN runs ON steps.tree = runs.tree AND steps.level = runs.level AND steps.place // 3 = runs.run),
gathered AS (
    SELECT doc_id, source, leaf, list([array_to_string(lefts, ''), array_to_string(rights, '')] ORDER BY step) AS sides
    FROM met GROUP BY doc_id, source, leaf),
folded AS (
    SELECT way.doc_id, way.leaf, way.subroot, (SELECT digest FROM top WHERE n = 1) AS root,
        sha256(array_to_string(flatten(coalesce(sides, [])), '')) AS proof_sha256,
        list_reduce(list_prepend(['', changed], coalesce(sides, [])), lambda a, b: ['', sha256(b[1] || a[2] || b[2])])[2] AS folded_root
    FROM way LEFT JOIN gathered g ON way.doc_id IS NOT DISTINCT FROM g.doc_id AND way.leaf = g.leaf)
SELECT *, folded_root = root AS verified FROM folded
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line feeds are deleted from texts whose crc32(doc_id) is even; a row without an id is left alone."""
    return merkle.manifest(
        spark, table(spark, sf_dir, "documents"), group="source", key="doc_id",
        fields=["doc_id", "source", "lang", "n_chars", "text"],
        changed={"text": F.replace("text", F.lit("\n"), F.lit(""))}, where=fold("doc_id", 2) == 0)


@query(f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (
    SELECT conv_id, count(*) AS n, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 9 AS h, conv_id - conv_id % 5 AS base
    FROM t GROUP BY conv_id),
k AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (
    SELECT k.conv_id, pos + 1 AS depth, role, text FROM k JOIN t ON t.conv_id = k.base AND pos < h
    UNION ALL
    SELECT k.conv_id, taken + pos - h + 1, role, text FROM k JOIN t ON t.conv_id = k.conv_id AND pos >= h),
p AS (
    SELECT conv_id, depth, text, list([role, text]) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
    UNION ALL
    SELECT conv_id, 0, '', CAST([] AS VARCHAR[][]) FROM k),
g AS (
    SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, octet_length(encode(any_value(text))) AS n_bytes
    FROM p GROUP BY depth, path),
m AS (
    SELECT p.conv_id AS member, p.depth, g.conv_id AS node, p.depth = max(p.depth) OVER (PARTITION BY p.conv_id) AS is_last
    FROM p JOIN g USING (depth, path)),
up AS (SELECT g.conv_id, g.depth, m.node AS parent FROM g LEFT JOIN m ON m.member = g.conv_id AND m.depth = g.depth - 1),
kids AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n FROM up WHERE parent IS NOT NULL GROUP BY 1, 2),
below AS (
    SELECT m.node AS conv_id, m.depth, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((g.n_convs - 1) * g.n_bytes) AS saved
    FROM g JOIN m ON m.member = g.conv_id AND m.depth <= g.depth
    LEFT JOIN kids ON kids.conv_id = g.conv_id AND kids.depth = g.depth GROUP BY 1, 2),
ends AS (
    SELECT node AS conv_id, depth, sha256(coalesce(string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) FILTER (is_last), '')) AS digest
    FROM m GROUP BY 1, 2)
SELECT g.conv_id, CAST(g.depth AS BIGINT) AS depth, up.parent AS parent_conv_id, g.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves,
    CAST(saved AS BIGINT) AS saved_tokens, digest AS ends_sha256
FROM g JOIN up USING (conv_id, depth) JOIN below USING (conv_id, depth) JOIN ends USING (conv_id, depth)
LEFT JOIN kids USING (conv_id, depth)
""")
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(spark, table(spark, sf_dir, "conversations"))


# what the pages of the tables hold: one article of p, h1, b and br elements, and references to five characters
@query("""
WITH body AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS markup FROM pages),
plain AS (
    SELECT page_id, url, regexp_replace(regexp_replace(markup, '</?(p|h1|br)[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g') AS text FROM body),
read AS (
    SELECT page_id, url, regexp_replace(replace(replace(regexp_replace(text, '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>'),
        '&amp;?', '&', 'g') AS text FROM plain)
SELECT page_id, url, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS n_chars
FROM read
""")
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
