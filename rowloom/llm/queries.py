"""The registered queries of the text operators and, where SQL can say it, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from rowloom.llm import bpe, exact_dedup, fill_middle, html_wrappers, jaccard, line_dedup, lm, mixing, repetition, secret_scan, spelling, toxicity, url_filter

RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def pages(spark, folder):
    return spark.read.parquet(f"{folder}/pages.parquet")


def op1_repetition(spark, folder):
    judged = repetition.judge_repetition(documents(spark, folder))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(*base, "base_failed", "kept", "covered_words")


def op3_lm(spark, folder):
    scored = lm.score_texts(documents(spark, folder), order=2)
    held_out = (~F.col("learned")).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_bpe(spark, folder):
    found = bpe.encode_documents(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))
    digests = [F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256") for name in ("ids", "decoded", "readable")]
    return found.select("doc_id", "n_tokens", *digests)


def op2_line_dedup(spark, folder):
    found = line_dedup.drop_shared_lines(documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_exact_dedup(spark, folder):
    marks = exact_dedup.mark_copies(documents(spark, folder))
    return marks.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_jaccard(spark, folder):
    return jaccard.similar_documents(documents(spark, folder), threshold=0.8)


def op7_html(spark, folder):
    found = html_wrappers.extract_text(pages(spark, folder))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_mixing(spark, folder):
    mix = mixing.mix_sources(documents(spark, folder), weights=(5, 2, 1), share=1.5, most=2.0)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    return toxicity.score_toxicity(documents(spark, folder), labels)


def op10_url_filter(spark, folder):
    return url_filter.judge_urls(pages(spark, folder), RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_spelling(spark, folder):
    return spelling.spelling_variants(documents(spark, folder), min_length=5, min_count=3, times=2, every=97)


def op12_fim(spark, folder):
    made = fill_middle.fill_in_middle(documents(spark, folder), unit="line", rate=100, spm_rate=50, seed=7)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2(c.cast("binary"), 256).alias(n) for c, n in ((F.col("output"), "output_sha256"), (back, "restored_sha256"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_secrets(spark, folder):
    found = secret_scan.find_secrets(documents(spark, folder), min_decades=10.0)

    def of(kind):
        return F.filter("secrets", lambda s: s["kind"] == kind)

    base = secret_scan.joined(F.filter("secrets", lambda s: s["kind"] != "guess"))
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS]
    spans = secret_scan.joined(F.col("secrets")).alias("spans")
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans)


QUERIES = {
    "op1_repetition": op1_repetition,
    "op2_line_dedup": op2_line_dedup,
    "op3_lm": op3_lm,
    "op4_bpe": op4_bpe,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_jaccard": op6_jaccard,
    "op7_html": op7_html,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_url_filter": op10_url_filter,
    "op11_spelling": op11_spelling,
    "op12_fim": op12_fim,
    "op13_secrets": op13_secrets,
}

ORACLE = {
    "op1_repetition": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), g1 AS (
            SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i, len(words) AS size FROM t
        ), g2 AS (SELECT *, hash(w, lead(w) OVER d) AS h2, lead(w, 2) OVER d AS third FROM g1 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), g4 AS (SELECT *, hash(h2, third) AS h3, hash(h2, lead(h2, 2) OVER d) AS h4 FROM g2 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), g8 AS (SELECT *, hash(h4, lead(h4, 4) OVER d) AS h8 FROM g4 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), g16 AS (SELECT *, hash(h8, lead(h8, 8) OVER d) AS h16 FROM g8 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), g32 AS (SELECT *, hash(h16, lead(h16, 16) OVER d) AS h32 FROM g16 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), g51 AS (
            SELECT *, hash(h32, lead(h16, 32) OVER d, lead(h3, 48) OVER d) AS h51 FROM g32 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), sized AS (
            SELECT doc_id, i, size, unnest([3, 8, 51]) AS k, unnest([h3, h8, h51]) AS h FROM g51
        ), windows AS (
            SELECT doc_id, k, i, count(*) OVER (PARTITION BY doc_id, k, h) AS n FROM sized WHERE i + k - 1 <= size
        ), places AS (
            SELECT DISTINCT doc_id, k, unnest(range(i, i + k)) AS place FROM windows WHERE n > 1
        ), repeats AS (
            SELECT doc_id, count(*) FILTER (WHERE k = 3) AS n_repeat_words, count(*) FILTER (WHERE k = 8) AS covered_words,
                   count(*) FILTER (WHERE k = 51) AS too_long
            FROM places GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t
        ), dup AS (
            SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
        ), measured AS (
            SELECT t.doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(covered_words, 0) AS covered_words, coalesce(too_long, 0) AS too_long
            FROM t LEFT JOIN repeats USING (doc_id) LEFT JOIN dup USING (doc_id)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * covered_words > 45 * n_words OR too_long > 0) AS kept
        FROM measured
    """,
    "op2_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS position
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), keepers AS (
            SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) >= 2
        ), marked AS (
            SELECT keyed.*, keeper IS NOT NULL AND doc_id <> keeper AS dropped
            FROM keyed LEFT JOIN keepers USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op5_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(text) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY text)
    """,
    "op8_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   substring(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS key
            FROM documents
        ), sources AS (
            SELECT source, sum(size) AS source_size,
                   [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
            FROM sized GROUP BY source
        ), ranked AS (
            SELECT *, row_number() OVER by_ratio AS place, 2.0 * sum(source_size) OVER by_ratio AS held, sum(weight) OVER by_ratio AS used,
                   1.5 * sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight
            FROM sources WINDOW by_ratio AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST)
        ), levels AS (
            SELECT 0 AS place, max(total) / max(all_weight) AS level FROM ranked
            UNION ALL SELECT place, (total - held)::DOUBLE / (all_weight - used)::DOUBLE FROM ranked WHERE used < all_weight
        ), chosen AS (
            SELECT level FROM levels JOIN ranked ON ranked.place = levels.place + 1
            WHERE level * weight <= 2.0 * source_size ORDER BY levels.place LIMIT 1
        ), targets AS (
            SELECT source, source_size, least(2.0 * source_size, (SELECT level FROM chosen) * weight)::DOUBLE AS target FROM sources
        ), placed AS (
            SELECT sized.*, source_size, target, floor(target + 0.5)::BIGINT AS budget,
                   sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
            FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
        )
        SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
               (greatest(0, least(size, budget - before)) + greatest(0, least(size, budget - source_size - before)))::BIGINT AS taken
        FROM placed
    """,
    "op12_fim": """
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents
        ), counted AS (
            SELECT *, length(text) - length(replace(text, chr(10), '')) + (text <> '' AND right(text, 1) <> chr(10))::INT AS n FROM drawn
        ), cuts AS (
            SELECT *, string_split(text, chr(10)) AS lines,
                   CAST('0x' || substr(s, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(s, 9, 8) AS BIGINT) % (n + 1) AS two,
                   CAST('0x' || substr(s, 17, 8) AS BIGINT) % 100 >= 100 OR text = '' OR regexp_matches(text, '<[PSM]>') AS plain,
                   CAST('0x' || substr(s, 25, 8) AS BIGINT) % 100 < 50 AS spm
            FROM counted
        ), places AS (
            SELECT *, least(length(text), length(array_to_string(lines[1:least(one, two)], chr(10))) + (least(one, two) > 0)::INT) AS a,
                   least(length(text), length(array_to_string(lines[1:greatest(one, two)], chr(10))) + (greatest(one, two) > 0)::INT) AS b
            FROM cuts
        ), parts AS (
            SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM places
        )
        SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars, CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
               sha256(CASE WHEN plain THEN text WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                           ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
}
