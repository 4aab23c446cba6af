"""The registered queries of this folder and the SQL that checks them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cityflow.llm import (
    bestfit,
    bpe,
    chat,
    clustering,
    embedding_dedup,
    exact_dedup,
    line_dedup,
    periodic_runs,
    quality,
    simhash,
    site_tree,
    token_output,
    toxicity,
)
from cityflow.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.learn(docs, labels))


def op3_quality_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, quality.learn(docs, labels))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    clash = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", clash), (-7, 1, "assistant", clash)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select(more.columns).unionByName(more)
    return chat.read_back(chat.format_chats(rows))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id"
    )


def op7_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.write_rows(table(spark, sf_dir, "documents"), WORD_BPE)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.clean(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "keep_id", "group_size", "kept", "lower(hex(digest)) AS text_sha256"
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), prepare=periodic_runs.with_tail)
    return periodic_runs.summary(found)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(table(spark, sf_dir, "pages"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings")).selectExpr(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "sha2(centroid, 256) AS centroid_sha256"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_toxicity_chain,
        op3_quality_sites,
        op4_chat_formatting,
        op5_bpe_round_trip,
        op6_simhash_near_dedup,
        op7_token_rows,
        op8_best_fit_packing,
        op9_line_dedup,
        op10_exact_dedup,
        op11_periodic_runs,
        op12_html_extraction,
        op13_centroid_clustering,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_ESCAPED = "{}"
for _plain, _code in chat.CODES.items():
    _ESCAPED = f"replace({_ESCAPED}, '{_plain}', '{_code}')"


def _cluster_rounds() -> str:
    """The rounds of ``op13`` written out: v has a row per vector and component."""
    nearest = """
        a{0} AS (
            SELECT id, cluster, d FROM (
                SELECT v.id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS d,
                       row_number() OVER (PARTITION BY v.id ORDER BY sum((v.x - c.x) * (v.x - c.x)), c.cluster) AS place
                FROM v JOIN c{0} c USING (i) GROUP BY v.id, c.cluster)
            WHERE place = 1)"""
    moved = """
        c{1} AS (
            SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x
            FROM c{0} c LEFT JOIN (
                SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x
                FROM (SELECT a.cluster, v.i, sum(v.x) AS s, count(*) AS n FROM v JOIN a{0} a USING (id) GROUP BY ALL)) m
            USING (cluster, i))"""
    steps = []
    for r in range(clustering.ROUNDS):
        steps += [nearest.format(r), moved.format(r, r + 1)]
    return ",".join([*steps, nearest.format(clustering.ROUNDS)])


_CONFLICT = "contains({0}, '</s>') OR regexp_matches({0}, '&[aebic];')"

ORACLES = {
    "op4_chat_formatting": f"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(19 + length(role)
                   + CASE WHEN {_CONFLICT.format("text")} THEN length({_ESCAPED.format("text")}) ELSE length(text) END)
                   AS BIGINT) AS formatted_chars
        FROM r GROUP BY conv_id""",
    "op1_embedding_near_dedup": f"""
        WITH RECURSIVE v AS (
            SELECT row_number() OVER () AS id, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        valid AS (
            SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.id AS a, b.id AS b FROM valid a JOIN valid b ON a.label = b.label AND len(a.e) = len(b.e) AND a.id <> b.id
            WHERE list_cosine_similarity(a.e, b.e) >= {embedding_dedup.COSINE}),
        reached AS (
            SELECT id AS start, id AS node FROM v
            UNION SELECT r.start, l.b FROM reached r JOIN links l ON l.a = r.node)
        SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.id) AS n_links, c.component_id,
               v.vec_id = c.component_id AS kept
        FROM v JOIN (SELECT start, min(m.vec_id) AS component_id FROM reached JOIN v m ON m.id = node GROUP BY start) c ON c.start = v.id""",
    "op9_line_dedup": f"""
        WITH l AS (
            SELECT d.rowid AS id, d.source AS site, u.line, u.pos
            FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d,
                 unnest(string_split(d.text, chr(10))) WITH ORDINALITY AS u(line, pos)),
        b AS (
            SELECT trim(line) AS line FROM l WHERE trim(line) <> '' GROUP BY 1
            HAVING count(DISTINCT site) >= {line_dedup.SITES})
        SELECT doc_id, text, n_lines, n_removed FROM (
            SELECT d.doc_id,
                   CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
                       FILTER (b.line IS NULL), '') END AS text,
                   count(l.pos) AS n_lines, count(b.line) AS n_removed
            FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d
            LEFT JOIN l ON l.id = d.rowid LEFT JOIN b ON b.line = trim(l.line)
            GROUP BY d.rowid, d.doc_id, d.text)""",
    "op10_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents)
        WINDOW same AS (PARTITION BY norm)""",
    # the pages' markup names the article, with no element in it but headings, paragraphs and inline ones
    "op12_html_extraction": """
        WITH p AS (
            SELECT row_number() OVER () AS id, page_id, url,
                   regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1) AS body
            FROM pages),
        l AS (
            SELECT id, pos, trim(regexp_replace(replace(replace(replace(replace(replace(
                       line, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\\s+', ' ', 'g')) AS line
            FROM p, unnest(string_split(regexp_replace(regexp_replace(
                       body, '</?(p|h1)[^>]*>', chr(10), 'g'), '<[^>]*>', ' ', 'g'), chr(10))) WITH ORDINALITY AS u(line, pos)),
        t AS (SELECT id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l WHERE line <> '' GROUP BY id)
        SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars
        FROM p LEFT JOIN t USING (id)""",
    "op13_centroid_clustering": f"""
        WITH k AS (
            SELECT row_number() OVER () AS id, vec_id, embedding FROM embeddings
            WHERE len(embedding) = {clustering.DIMENSIONS}
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS MATERIALIZED (
            SELECT id, vec_id, u.i, CAST(floor({clustering.SCALE} * CAST(u.x AS DOUBLE)) AS BIGINT) AS x
            FROM k, unnest(embedding) WITH ORDINALITY AS u(x, i)),
        c0 AS (
            SELECT s.cluster, v.i, v.x
            FROM v JOIN (
                SELECT id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM k
                QUALIFY cluster < {clustering.K}) s USING (id)),{_cluster_rounds()},
        h AS (
            SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
            FROM c{clustering.ROUNDS} GROUP BY cluster)
        SELECT k.vec_id, CAST(a.cluster AS INT) AS cluster, CAST(a.d AS BIGINT) AS distance,
               CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
        FROM a{clustering.ROUNDS} a JOIN k USING (id) JOIN h USING (cluster)""",
}
