"""Registered queries of the package and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vectrace.llm import bpe, chat, gif, hpyp, jaccard, packing, pii, quality, unigram, warc
from vectrace.llm.common import shared_folder, table


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; the files are read in place, never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op5_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(table(spark, sf_dir, "conversations"))


def op6_hpyp_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpyp.score(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op1_media_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.round_trip(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join(table(spark, sf_dir, "documents"), n=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = unigram.read_pieces(tokenizer_path("piece_bpe_32k.model"))
    return unigram.token_counts(table(spark, sf_dir, "documents"), pieces)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES: dict[str, Query] = {
    "op1_media_gif": op1_media_gif,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_packing": op3_packing,
    "op4_token_counts": op4_token_counts,
    "op5_chat_collapse": op5_chat_collapse,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_byte_bpe": op10_byte_bpe,
    "op6_hpyp_score": op6_hpyp_score,
    "op7_quality_rules": op7_quality_rules,
}

_STOPS = ", ".join(f"'{w}'" for x in quality.STOP_WORDS for w in (x, x.capitalize()))

SQL: dict[str, str] = {
    "op2_ngram_jaccard": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\x0c\r]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS g FROM d),
g AS (SELECT r, unnest(g) AS g FROM s),
o AS (SELECT x.r AS a, y.r AS b, count(*) AS n FROM g x JOIN g y ON x.g = y.g AND x.r < y.r GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN s x ON x.r = a JOIN s y ON y.r = b WHERE 100 * n >= 90 * (len(x.g) + len(y.g) - n)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, least(s.doc_id, coalesce((SELECT min(t.doc_id) FROM c JOIN s t ON t.r = c.b WHERE c.a = s.r), s.doc_id))::BIGINT AS component_id FROM s""",
    "op5_chat_collapse": """
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM conversations),
r AS (SELECT conv_id, pos, md5(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n')) AS h,
        '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS s FROM t),
p AS (SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY pos) AS pre FROM r),
w AS (SELECT pre, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM p WHERE pos = n GROUP BY pre, n),
k AS (SELECT w.* FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pre = w.pre))
SELECT k.conv_id, k.n AS n_turns, k.n_copies, string_agg(r.s, '' ORDER BY r.pos) AS text
FROM k JOIN r ON r.conv_id = k.conv_id GROUP BY k.conv_id, k.n, k.n_copies""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p),
x AS (SELECT *, list_transform(range(32), lambda i: (('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT // [32768, 1024, 32, 1][1 + i % 4]) % 32) AS v FROM d)
SELECT page_id, payload_bytes, array_to_string(list_transform(v, lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', k::INTEGER + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM x""",
    "op7_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, doc_id, text,
        list_filter(string_split_regex(text, '[ \t\n\x0b\x0c\r]+'), lambda w: w <> '') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\x0c\r]')) AS ls FROM d),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM s),
g AS (SELECT r, i, w || ' ' || lead(w) OVER p || ' ' || lead(w, 2) OVER p AS g FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g WHERE g IS NOT NULL),
v AS (SELECT r, count(DISTINCT i + k) AS n FROM h, range(3) AS t(k) WHERE c > 1 GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(list_aggregate(ws, 'string_agg', '')) AS wc,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words,
        len(ls) AS n_lines, len(list_filter(ws, lambda x: x IN ({_STOPS}))) AS n_stop,
        len(list_filter(ls, lambda x: x LIKE '%...' OR x LIKE '%…')) AS n_ell,
        length(regexp_replace(list_aggregate(ws, 'string_agg', ''), '\P{{L}}', '', 'g')) AS n_let
      FROM s LEFT JOIN v USING (r)),
b AS (SELECT *, coalesce(wc, 0)::BIGINT AS word_chars, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) BETWEEN 2.0 AND 12.0
    AND coalesce(n_symbols::DOUBLE / nullif(n_words, 0), 0) <= 0.15
    AND coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) <= 0.5
    AND coalesce(n_stop::DOUBLE / nullif(n_words, 0), 0) >= 0.02
    AND coalesce(n_ell::DOUBLE / nullif(n_lines, 0), 0) <= 0.5
    AND coalesce(n_let::DOUBLE / nullif(word_chars, 0), 0) >= 0.6 AS kept
FROM b""",
}
