"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kerbstream.llm import (
    alignment, bpe, fim, language, merkle, mixing, quality, sharding, simhash, token_counts, toxicity,
    url_filter, warc)
from kerbstream.llm.common import prepare, table

URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]
COUNT_MODEL = "piece_bpe_32k.model"
CODEC_RANKS = "byte_bpe_50k.tiktoken"
ALIGNED_A = "byte_bpe_50k.json"
ALIGNED_B = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
SHARDS = 8


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints_of_edits(table(spark, sf_dir, "documents"))


def op2_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.through_archives(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"),
                                   URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance", "group", *quality.VECTOR)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_MODEL), TOKEN_LIMIT)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path(CODEC_RANKS),
        public_tokenizers.PATTERN)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), SHARDS)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments_with_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(ALIGNED_A),
        public_tokenizers.PATTERN, public_tokenizers.path(ALIGNED_B))


def _registered(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _registered(f) for f in (
    op1_document_fingerprints, op2_warc_normaliser, op3_simhash_near_dedup, op4_url_filters,
    op5_quality_rules, op6_token_counts, op7_language_id, op8_source_mix, op9_bpe_codec,
    op10_sharding, op11_fill_in_middle, op12_toxicity, op13_tokenizer_alignment)}

_RULES_SQL = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)

_PIECES = r"[^.!?\n]{1,64}[.!?]*|[.!?]+"


def _root_sql(text: str) -> str:
    return f"""sha256('d' || array_to_string(list_transform(
      string_split({text}, chr(10) || chr(10)), lambda s: sha256('s' || array_to_string(list_transform(
        string_split(s, chr(10)), lambda p: sha256('p' || p)), ''))), ''))"""


def _marks_sql(name: str, text: str) -> str:
    """Each piece of a text, numbered among its equals."""
    return f"""{name} AS (
      SELECT doc_id, piece, row_number() OVER (PARTITION BY doc_id, piece) AS nth
      FROM (SELECT doc_id, trim(unnest(regexp_extract_all({text}, '{_PIECES}'))) AS piece
            FROM edits))"""


def _aligned_sql(name: str, source: str, a: str, b: str) -> str:
    """``source`` with ``lead`` and ``trail``, the equal items at both ends of two lists, and the
    lengths of what is between them."""
    def run(x: str, y: str) -> str:
        return f"""coalesce(nullif(list_position(list_transform(range(1, least(len({a}), len({b})) + 1),
          lambda i: {x}[i] = {y}[i]), false), 0) - 1, least(len({a}), len({b})))"""

    return f"""{name} AS (
      SELECT *, len({a}) - lead - trail AS of_a, len({b}) - lead - trail AS of_b FROM (
        SELECT *, least({run('ra', 'rb')}, least(len({a}), len({b})) - lead) AS trail FROM (
          SELECT *, {run(a, b)} AS lead, list_reverse({a}) AS ra, list_reverse({b}) AS rb
          FROM {source})))"""


# Paragraphs as text: nodes are equal where their texts are.
_BRANCHES_SQL = f"""
      nested AS (
        SELECT doc_id,
          list_transform(string_split(text, chr(10) || chr(10)), lambda s: string_split(s, chr(10))) AS a,
          list_transform(string_split(edited, chr(10) || chr(10)), lambda s: string_split(s, chr(10))) AS b
        FROM edits WHERE text <> edited),
      {_aligned_sql('sections', 'nested', 'a', 'b')},
      pairs AS (
        SELECT doc_id, lead + k AS section,
               CASE WHEN k < of_a THEN a[lead + k + 1] ELSE []::VARCHAR[] END AS x,
               CASE WHEN k < of_b THEN b[lead + k + 1] ELSE []::VARCHAR[] END AS y,
               k < of_a AND k < of_b AS paired
        FROM (SELECT *, unnest(range(greatest(of_a, of_b))) AS k FROM sections)),
      {_aligned_sql('paragraphs', '(SELECT * FROM pairs WHERE NOT paired OR x <> y)', 'x', 'y')},
      branches AS (
        SELECT doc_id, count(*) AS n,
               min({{'section': section, 'paragraph': lead + k}}) AS first
        FROM (SELECT *, unnest(range(greatest(of_a, of_b))) AS k FROM paragraphs)
        WHERE NOT (k < of_a AND k < of_b) OR x[lead + k + 1] <> y[lead + k + 1]
        GROUP BY doc_id)"""


def _near_sql(other: str, root: str) -> str:
    return f"""CASE WHEN e.fingerprint = {root} THEN 1.0::DOUBLE ELSE least(
        2::DOUBLE * coalesce(c_{other}.n, 0)
          / greatest(coalesce(n_own.n, 0) + coalesce(n_{other}.n, 0), 1),
        1::DOUBLE - 1::DOUBLE / (coalesce(n_own.n, 0) + coalesce(n_{other}.n, 0) + 1)) END"""


ORACLE_SQL = {
    "op1_document_fingerprints": f"""
      WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
      followed AS (
        SELECT doc_id, text, length(text) AS n_chars,
               coalesce(lead(text) OVER (ORDER BY doc_id),
                        first_value(text) OVER (ORDER BY doc_id)) AS next_text FROM texts),
      edits AS (
        SELECT *, substr(text, 1, n_chars - n_chars // 2) || substr(next_text, 1, n_chars // 2)
               AS edited, {_root_sql('text')} AS fingerprint FROM followed),
      {_marks_sql('own', 'text')}, {_marks_sql('edited_marks', 'edited')},
      {_marks_sql('next_marks', 'next_text')},
      n_own AS (SELECT doc_id, count(*) AS n FROM own GROUP BY doc_id),
      n_edited AS (SELECT doc_id, count(*) AS n FROM edited_marks GROUP BY doc_id),
      n_next AS (SELECT doc_id, count(*) AS n FROM next_marks GROUP BY doc_id),
      c_edited AS (SELECT doc_id, count(*) AS n FROM own JOIN edited_marks
                   USING (doc_id, piece, nth) GROUP BY doc_id),
      c_next AS (SELECT doc_id, count(*) AS n FROM own JOIN next_marks
                 USING (doc_id, piece, nth) GROUP BY doc_id),
      {_BRANCHES_SQL}
      SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, e.fingerprint,
             {_root_sql('e.edited')} AS edited_fingerprint,
             coalesce(b.n, 0)::INT AS edited_branches, b.first.section::INT AS first_section,
             b.first.paragraph::INT AS first_paragraph,
             {_near_sql('edited', _root_sql('e.edited'))} AS near_edited,
             {_near_sql('next', _root_sql('e.next_text'))} AS near_next
      FROM edits e LEFT JOIN n_own USING (doc_id) LEFT JOIN n_edited USING (doc_id)
      LEFT JOIN n_next USING (doc_id) LEFT JOIN c_edited USING (doc_id)
      LEFT JOIN c_next USING (doc_id) LEFT JOIN branches b USING (doc_id)""",
    "op2_warc_normaliser": """
      WITH sized AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
               sha256(coalesce(html, '')) AS digest FROM pages),
      firsts AS (SELECT digest, min(page_id) AS first FROM sized WHERE n >= 100 GROUP BY digest)
      SELECT page_id, n AS payload_bytes, digest AS payload_digest,
             CASE WHEN f.first IS NOT NULL AND (page_id IS NULL OR page_id > f.first)
                  THEN 'revisit' ELSE 'response' END AS record_type,
             CASE WHEN page_id IS NULL OR page_id > f.first THEN f.first END AS refers_to
      FROM sized LEFT JOIN firsts f USING (digest)""",
    "op11_fill_in_middle": rf"""
      WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text,
               sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
      lined AS (
        SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
               [('0x' || substr(digest, 1 + 8 * i, 8))::BIGINT FOR i IN range(4)] AS h
        FROM texts),
      cut AS (
        SELECT *, len(lines) AS n,
               least(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS a,
               greatest(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                         OR contains(text, '<M>') OR h[3] % 100 >= {fim.FIM_PERCENT} THEN 'plain'
                    WHEN h[4] % 100 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
        FROM lined),
      parts AS (
        SELECT doc_id, text, n, form, array_to_string(lines[1:a], '') AS prefix,
               array_to_string(lines[a + 1:b], '') AS middle,
               array_to_string(lines[b + 1:], '') AS suffix FROM cut)
      SELECT doc_id, n::BIGINT AS n, form,
             CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
             CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
             sha256(CASE form WHEN 'plain' THEN text
               WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
               ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
             sha256(text) AS restored_sha256
      FROM parts""",
    "op4_url_filters": f"""
      WITH rules(verdict, rule_host, rule_path) AS (VALUES {_RULES_SQL}),
      cut AS (
        SELECT page_id, url, CASE WHEN contains(url, '://')
                 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
      parsed AS (
        SELECT page_id, url,
               translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
      fits AS (
        SELECT p.page_id, p.url, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
               length(r.rule_host) AS a, length(r.rule_path) AS b
        FROM parsed p LEFT JOIN rules r
          ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host))
         AND starts_with(p.path, r.rule_path)),
      best AS (
        SELECT page_id, url, host, path, arg_max(rule, (a, b)) AS rule,
               arg_max(verdict, (a, b)) AS verdict
        FROM fits GROUP BY page_id, url, host, path)
      SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
      FROM parsed p JOIN best b
        ON p.page_id IS NOT DISTINCT FROM b.page_id AND p.url IS NOT DISTINCT FROM b.url""",
}
