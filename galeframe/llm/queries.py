"""The numbered queries: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.llm.bpe import round_trip
from galeframe.llm.chat import conversation_digests, format_conversations
from galeframe.llm.decontaminate import find_leaks
from galeframe.llm.lang_id import fit_languages, identify_languages
from galeframe.llm.lexical_search import search_documents
from galeframe.llm.licenses import scan_licenses
from galeframe.llm.lm_scoring import score_documents, target_documents
from galeframe.llm.near_dup import near_duplicates
from galeframe.llm.quality_classifier import fit_quality, quality_scores
from galeframe.llm.quality_rules import quality_rules
from galeframe.llm.sql_bpe import round_trip as sql_round_trip
from galeframe.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, compression_report
from galeframe.llm.warc import pages_through_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_through_warc(table(spark, sf_dir, "pages"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    return conversation_digests(format_conversations(rows.union(spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema))))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_documents(table(spark, sf_dir, "documents"), target_documents(table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", *(F.round(c, 6).alias(c) for c in ("loss_target", "loss_background", "score")))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_languages(docs, fit_languages(docs))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_report(table(spark, sf_dir, "embeddings"))


def op13_sql_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _codes_sql() -> str:
    """Rounds of assignment and floored means, one after another; a part's tie goes to the lower entry."""
    steps = [
        f"""v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (SELECT vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS v FROM v, range({PARTS}) t(p)),
        b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM p QUALIFY e < {ENTRIES})"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
            SELECT vec_id, label, p, v, (min(d * 1000 + e) % 1000) AS e, min(d * 1000 + e) // 1000 AS d
            FROM (SELECT q.*, b.e, list_sum(list_transform(list_zip(q.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p q JOIN b{i} b USING (p)) GROUP BY ALL)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""m{i} AS (
            SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v
            FROM (SELECT p, e, j, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS j FROM a{i}) GROUP BY ALL) GROUP BY ALL),
        b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN m{i} m USING (p, e))"""
            )
    return f"""
        WITH {", ".join(steps)},
        c AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY ALL)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
        FROM c"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_chat, op3_quality_rules, op4_lm_scoring, op5_licenses, op6_minhash, op7_quality_classifier, op8_decontamination, op9_bpe, op10_language_id,
        op11_lexical_search, op12_vector_codes, op13_sql_bpe,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        q AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS top FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM q""",
    "op2_chat": r"""
        WITH r AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, length(regexp_replace(regexp_replace(text, '(<\\*)(/?s>)', '\1\\\2', 'g'), '(\[\\*)(/?INST\])', '\1\\\2', 'g')) AS n FROM r)
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(3 + length(role) + 1 + n + CASE WHEN role = 'user' THEN 15 ELSE 0 END + 5)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op4_lm_scoring": r"""
        WITH g AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING avg(quality) >= 0.5),
        d AS (
            SELECT row_number() OVER () AS r, d.doc_id, (g.doc_id IS NOT NULL)::INT AS t,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
            FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id),
        w AS (SELECT r, t, unnest(ws) AS w, unnest(list_prepend('', ws)[1:len(ws)]) AS h FROM d),
        s AS (SELECT sum(t)::DOUBLE AS t, sum(1 - t)::DOUBLE AS b, 1.0 + count(DISTINCT w) AS v FROM w),
        k AS (SELECT CASE WHEN t > 0 AND b > 0 THEN t / b ELSE 1 END AS k, * FROM s),
        one AS (SELECT w, sum(t)::DOUBLE AS t, sum(1 - t)::DOUBLE AS b FROM w GROUP BY w),
        hist AS (SELECT h, sum(t)::DOUBLE AS t, sum(1 - t)::DOUBLE AS b FROM w GROUP BY h),
        two AS (SELECT h, w, sum(t)::DOUBLE AS t, sum(1 - t)::DOUBLE AS b FROM w GROUP BY h, w),
        loss AS (
            SELECT two.h, two.w,
                   -ln((two.t + 50 * (one.t + 100 / k.v) / (k.t + 100)) / (hist.t + 50)) AS lt,
                   -ln((two.b * k + 50 * (one.b * k + 100 / k.v) / (k.b * k + 100)) / (hist.b * k + 50)) AS lb
            FROM two JOIN one ON one.w = two.w JOIN hist ON hist.h = two.h CROSS JOIN k),
        a AS (SELECT r, avg(lt) AS lt, avg(lb) AS lb FROM w JOIN loss l ON l.h = w.h AND l.w = w.w GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words, round(lt, 6) AS loss_target, round(lb, 6) AS loss_background, round(lt - lb, 6) AS score
        FROM d LEFT JOIN a ON a.r = d.r""",
    "op6_minhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1), lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM w),
        n AS (SELECT d.doc_id, count(g) AS n FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(d, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d)
        SELECT n.doc_id, n.n AS n_shingles, m.c AS component_id, n.doc_id = m.c AS kept
        FROM n JOIN (SELECT d, min(c) AS c FROM r GROUP BY d) m ON m.d = n.doc_id""",
    "op11_lexical_search": r"""
        WITH t AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
            FROM documents),
        d AS (SELECT doc_id, ts, len(ts) AS n FROM t WHERE len(ts) > 0),
        k AS (SELECT count(*) AS n, sum(n)::BIGINT AS l FROM d),
        f AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM d) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * k.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, k GROUP BY term, k.n),
        q AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY ALL),
        s AS (
            SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * f.n * k.n) // k.l))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN f USING (term) CROSS JOIN k GROUP BY item_id, doc_id)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 20""",
    "op12_vector_codes": _codes_sql(),
}
