"""The numbered corpus queries and, where SQL can express them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .licenses import oracle as license_oracle


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import decode, encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    done = decode(encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return done.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_report

    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_report

    return simhash_report(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_dedup

    done = line_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_report

    planted = spark.createDataFrame([(-1, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return format_report(rows.union(planted))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .infill import infill_report

    return infill_report(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .structure_repair import damaged, repair_report

    rows = table(spark, sf_dir, "conversations")
    return repair_report(damaged(rows), rows)


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_exact_dedup, op3_license_scan, op4_best_fit_packing, op5_embedding_near_dedup, op6_quality_classifier, op7_html_extraction,
        op8_simhash_near_dedup, op9_line_dedup, op10_chat_format, op11_fill_in_middle, op12_token_counts, op13_structure_repair,
    )
}

ORACLES = {
    "op2_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op3_license_scan": license_oracle(),
    "op10_chat_format": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sized AS (
            SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?s>|<SYS>>|</SYS>>|<ROLE>>|</ROLE>>|</TURN>>)', '\1-\2\3', 'g'))
                + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE length(role) + 26 END AS n
            FROM rows)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(n)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op11_fill_in_middle": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
                   sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
            FROM documents),
        drawn AS (
            SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
            FROM cut),
        formed AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn),
        parted AS (
            SELECT *, coalesce(array_to_string(list_slice(units, 1, a), ''), '') AS p, coalesce(array_to_string(list_slice(units, a + 1, b), ''), '') AS m,
                   coalesce(array_to_string(list_slice(units, b + 1, n), ''), '') AS s
            FROM formed)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parted""",
    "op9_line_dedup": """
        WITH cut AS (
            SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS parts
            FROM documents),
        lines AS (
            SELECT doc_id, site, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM cut),
        first AS (
            SELECT trim(line, ' ') AS line, min((doc_id, pos)) AS first FROM lines WHERE trim(line, ' ') <> ''
            GROUP BY 1 HAVING count(DISTINCT site) >= 8),
        marked AS (
            SELECT doc_id, pos, l.line, f.line IS NOT NULL AND (doc_id, pos) <> f.first AS gone
            FROM lines l LEFT JOIN first f ON trim(l.line, ' ') = f.line)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS text_sha256
        FROM marked GROUP BY doc_id""",
}
