"""One query per operator of this package, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twintext.llm import (
    bpe_automaton,
    chat_format,
    line_dedup,
    near_dedup,
    packing,
    phrases,
    quality_rules,
    simhash_dedup,
    token_counts,
    url_filter,
    vector_search,
    warc_archives,
    whitening,
)
from twintext.llm.common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs, near_dedup.Rule(words=3, percent=85))


def op2_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archives.written_and_read(table(spark, sf_dir, "pages"))


def vocabulary_file(name: str) -> str:
    """Where the installed vocabulary files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe_automaton.digests(docs, vocabulary_file("byte_bpe_50k.json"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed_pieces(docs, vocabulary_file("word_bpe_49k.json"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.flat(table(spark, sf_dir, "conversations"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, vocabulary_file("byte_bpe_50k.tiktoken"))


#: The rules of the query. Hosts that none fits are blocked if they are listed.
URL_RULES = [
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judged(pages, URL_RULES, url_filter.query_heavy_hosts(pages))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash_dedup.near_duplicates(docs, simhash_dedup.Rule(words=3, most=3))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return phrases.collocations(docs, phrases.Rule(longest=3, least=10, inside=50, first=2000))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=32, weights="count")


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_warc_archives": op2_warc_archives,
    "op3_bpe_automaton": op3_bpe_automaton,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_format": op6_chat_format,
    "op7_line_dedup": op7_line_dedup,
    "op8_vector_search": op8_vector_search,
    "op9_token_counts": op9_token_counts,
    "op10_url_filters": op10_url_filters,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLES = {
    "op2_warc_archives": r"""
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op5_quality_rules": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
            FROM documents),
        p AS (
            SELECT doc_id, i,
                   array_to_string(w[i:i + 4], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
        twice AS (
            SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
            FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM p) WHERE c >= 2),
        r AS (
            SELECT doc_id, sum(least(5, i - coalesce(before, -5)))::BIGINT AS n_repeat_words
            FROM twice GROUP BY doc_id),
        m AS (
            SELECT d.doc_id, len(w)::BIGINT AS n_words,
                   length(array_to_string(w, ''))::BIGINT AS word_chars,
                   (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                   (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                   (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclamations,
                   len(ls)::BIGINT AS n_lines
            FROM d LEFT JOIN r USING (doc_id)),
        f AS (
            SELECT *, ((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
                + 4 * (10 * n_symbols > n_words)::INT + 8 * (10 * n_exclamations > 3 * n_words)::INT
                + 16 * (10 * n_dup_lines > 3 * n_lines)::INT
                + 32 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT)::BIGINT AS failed_bits
            FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept,
               n_exclamations, n_lines, failed_bits
        FROM f""",
    "op6_chat_format": r"""
        WITH t AS (SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
        s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
        g AS (
            SELECT conv_id, speaker, turn, role, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS text,
                   turn // 32 AS block, coalesce(role = speaker, false) AS trained,
                   '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
                       WHEN role IS NULL THEN 'user' ELSE 'user name=' || regexp_replace(
                           replace(replace(replace(role, '\', '\\'), chr(10), '\n'), chr(13), '\r'),
                           '<(\\*)\|', '<\1\\|', 'g') END || chr(10) AS header
            FROM t JOIN s USING (conv_id)),
        r AS (
            SELECT *, header || text || '<|im_end|>' || chr(10) AS rendered FROM g),
        o AS (
            SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, speaker, block
                ORDER BY turn NULLS FIRST, role NULLS FIRST, text ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM r)
        SELECT conv_id, speaker, block, NULL::BIGINT AS crowded_turn, 0::INT AS lane, count(*)::INT AS n_turns,
               string_agg(rendered, '' ORDER BY e) AS text,
               coalesce(string_agg((e - length(rendered) + length(header)) || '-' || e, ' ' ORDER BY e)
                   FILTER (WHERE trained), '') AS trained
        FROM o GROUP BY conv_id, speaker, block""",
    "op7_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, line, pos,
                   translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
        k AS (
            SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        j AS (
            SELECT l.*, last IS NOT NULL AND last <> doc_id AS gone FROM l LEFT JOIN k USING (key))
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM j GROUP BY doc_id""",
    "op10_url_filters": r"""
        WITH a AS (
            SELECT page_id, url,
                   CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        h AS (
            SELECT page_id, url,
                   translate(regexp_extract(rest, '^[^/?#]*'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM a),
        listed AS (
            SELECT host, true AS listed FROM h GROUP BY host
            HAVING count(*) >= 2 AND 2 * count(*) FILTER (WHERE instr(url, '?') > 0) > count(*)),
        rules(verdict, pattern, rule_host, rule_path) AS (VALUES
            ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
            ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
            ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
        fits AS (
            SELECT page_id, arg_max(pattern, length(pattern)) AS rule, arg_max(verdict, length(pattern)) AS verdict
            FROM h JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                             AND starts_with(path, rule_path)
            GROUP BY page_id)
        SELECT h.page_id, h.host, h.path, rule,
               coalesce(verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
        FROM h LEFT JOIN fits USING (page_id) LEFT JOIN listed ON listed.host = h.host""",
    "op12_phrase_mining": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents),
        p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (
            SELECT row_number() OVER () AS id, lang,
                   list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
        u AS (SELECT id, lang, unnest(w) AS w1, unnest(range(len(w))) AS i FROM w),
        x AS (
            SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3
            FROM u WINDOW o AS (PARTITION BY id ORDER BY i)),
        f AS (
            SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM x GROUP BY ALL
            UNION ALL
            SELECT lang, 2, w1 || ' ' || w2, count(*) FROM x WHERE w2 IS NOT NULL GROUP BY ALL
            UNION ALL
            SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM x WHERE w3 IS NOT NULL GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS x, f AS a FROM f WHERE k >= 2 AND f >= 10),
        cuts AS (
            SELECT lang, k, phrase, a, x, j, array_to_string(x[1:j], ' ') AS before, array_to_string(x[j + 1:], ' ') AS after
            FROM c, (VALUES (1), (2)) s(j) WHERE j < k),
        scored AS (
            SELECT cuts.*, b.f AS l, e.f AS r, ((1000000::HUGEINT * a * a) // (b.f::HUGEINT * e.f))::BIGINT AS score
            FROM cuts JOIN f b ON b.lang = cuts.lang AND b.phrase = before
                      JOIN f e ON e.lang = cuts.lang AND e.phrase = after),
        best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        inside AS (
            SELECT lang, phrase, max(a) AS most FROM (
                SELECT lang, array_to_string(x[1:2], ' ') AS phrase, a FROM c WHERE k = 3
                UNION ALL SELECT lang, array_to_string(x[2:3], ' '), a FROM c WHERE k = 3) GROUP BY ALL),
        kept AS (
            SELECT best.* FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase AND k = 2
            WHERE most IS NULL OR 100 * most < 50 * a),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
}
