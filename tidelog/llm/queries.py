"""The queries of this subpackage: each applies one operator with its production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, lines, lm, near, packing, quality, spans, suffixes, tokens, warc
from .common import rows_of


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file; the operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(rows_of(spark, sf_dir, "documents"), tokens.piece_list(tokenizer_path("piece_bpe_32k.model")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(rows_of(spark, sf_dir, "documents"), rows_of(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(rows_of(spark, sf_dir, "pages"))
    return warc.read(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup_spans(rows_of(spark, sf_dir, "documents"), extend=True)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(rows_of(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_dedup(rows_of(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(rows_of(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(rows_of(spark, sf_dir, "documents"))


def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(rows_of(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(rows_of(spark, sf_dir, "documents"), rows_of(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_token_counts,
            op2_quality_rules,
            op3_warc,
            op4_sentence_spans,
            op5_lm_score,
            op6_suffix_dedup,
            op7_packing,
            op8_line_dedup,
            op9_bagminhash,
            op10_decontamination,
        )
    }


OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), b AS (
  SELECT line, min((doc_id, pos)) AS first
  FROM l WHERE length(translate(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) >= 12
  GROUP BY line HAVING count(DISTINCT source) >= 10
), k AS (
  SELECT l.doc_id, l.pos, l.line, b.line IS NOT NULL AND (l.doc_id, l.pos) <> b.first AS gone FROM l LEFT JOIN b ON l.line = b.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
FROM k GROUP BY doc_id
"""


OP3_SQL = """
WITH p AS (SELECT page_id, url, sha1(coalesce(html, '')) AS x, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT x, min(page_id) AS first FROM p GROUP BY x)
SELECT page_id, url, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(p.x, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f ON p.x = f.x
"""


def _op2_sql() -> str:
    """The base counts, and the cutoffs by the binomial sum written out."""
    tried = [(r, i, c) for r, cs in quality.RULES.items() for i, c in enumerate(cs)]
    risk = quality.RISK / len(quality.RULES)
    rows = ", ".join(f"('{r}', {c})" for r, _, c in tried)
    ratio = "CASE rule " + " ".join(f"WHEN '{r}' THEN {r}" for r in quality.RULES) + " END"
    cuts = ", ".join(f"max_by(c, (b, c)) FILTER (rule = '{r}') AS cut_{r}" for r in quality.RULES)
    over = " OR ".join(f"coalesce({r} > cut_{r}, false)" for r in quality.RULES)
    return f"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
k AS (SELECT doc_id, i, list_slice(ws, i, i + 7) AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
h AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM k) WHERE n > 1),
r AS (SELECT doc_id, count(*) AS r FROM h GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM w),
b AS (SELECT doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        coalesce(r, 0) AS n_repeat_words, len(ls) AS n_lines, length(text) - length(translate(text, '!', '')) AS n_exclaim
      FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_symbols / greatest(word_chars, 1) AS symbol_ratio,
        n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio, n_repeat_words / greatest(n_words, 1) AS repeat_ratio, n_exclaim / greatest(n_words, 1) AS exclaim_ratio FROM b),
q AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
t AS (SELECT stratum, rule, c, count(*) FILTER (good > 0) AS n, count(*) FILTER (good > 0 AND {ratio} > c) AS g, count(*) FILTER (good <= 0 AND {ratio} > c) AS b,
        count(DISTINCT stratum) OVER () AS m
      FROM f JOIN q USING (doc_id), (VALUES {rows}) v(rule, c) WHERE NOT base_failed GROUP BY stratum, rule, c),
s AS (SELECT * FROM t WHERE g <= n * {risk} AND
        list_sum(list_transform(range(0, g + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) <= {quality.DELTA} / ({len(tried)} * m)),
c AS (SELECT stratum, {cuts} FROM s GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({over}) AS kept, {", ".join(quality.RULES)}
FROM f LEFT JOIN c USING (stratum)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": _op2_sql(), "op3_warc": OP3_SQL, "op8_line_dedup": OP8_SQL}
