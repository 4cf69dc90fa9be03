"""DuckDB statements that compute the results of :mod:`checks.queries`."""

from __future__ import annotations

from hashlib import md5

from checks.queries import BATCHES_PER_EPOCH, DOCUMENT_MERGES, PAD_LABEL, PAIR_MERGES, TGT_LIMIT
from twintext.operators.alphabet import alphabet
from twintext.params import END_TOKEN, PADDING_TOKEN, START_TOKEN, special_tokens

START, PAD, END = (special_tokens(500)[name] for name in (START_TOKEN, PADDING_TOKEN, END_TOKEN))

PAIRS = """
pairs AS (
  SELECT conv_id * 1000 + turn AS pair_id, text AS src, next_text AS tgt
  FROM (SELECT *, lead(text) OVER w AS next_text, lead(role) OVER w AS next_role
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""


def numbered(source: str, row_id: str, salt: str = "1") -> str:
    return f"""(SELECT *, row_number() OVER (ORDER BY md5('{salt}:' || {row_id})) - 1 AS k,
        count(*) OVER () AS total FROM {source})"""


def permuted(source: str, row_id: str, seed: int, epoch: int) -> str:
    """CTEs that end in ``places``: rows with their stored position k and place x in the epoch.

    The number of rows gives the grid; rounds are nested queries, so that each has names.
    """
    prime = 2**31 - 1

    def key(i: int) -> int:
        return int(md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()[:8], 16) % prime

    def mixed(x: str, k: int) -> str:
        y = f"(({x} + {k}) % {prime})"
        return f"{y} * {y} % {prime} * {y} % {prime}"

    def turned(source: str, x: str) -> str:
        query = f"(SELECT *, {x} // low AS l, {x} % low AS r FROM {source})"
        for i in range(4):
            query = f"(SELECT * REPLACE ((l + {mixed('r', key(2 * i))}) % high AS l) FROM {query})"
            query = f"(SELECT * REPLACE ((r + {mixed('l', key(2 * i + 1))}) % low AS r) FROM {query})"
        return query

    return f"""RECURSIVE grid AS (SELECT *, ceil(total / high)::bigint AS low
  FROM (SELECT {row_id}, k, total, ceil(sqrt(total))::bigint AS high FROM {numbered(source, row_id, f'{seed}:stored')})),
walk AS (SELECT {row_id}, k, total, high, low, l * low + r AS x FROM {turned('grid', 'k')}
  UNION ALL SELECT {row_id}, k, total, high, low, l * low + r AS x
  FROM {turned('(SELECT * FROM walk WHERE x >= total)', 'x')}),
places AS (SELECT {row_id}, k, total, x FROM walk WHERE x < total)"""


def split_of(source: str, row_id: str) -> str:
    """Half of the rows, rounded up, are held out; half of those are the test part."""
    return f"""(SELECT * EXCLUDE (total),
        CASE WHEN k < ((total + 1) // 2 + 1) // 2 THEN 'test'
             WHEN k < (total + 1) // 2 THEN 'val' ELSE 'train' END AS split
        FROM {numbered(source, row_id)})"""


def latin1(text: str) -> str:
    """Bytes of a text as code points."""
    return (
        f"array_to_string(list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        "lambda h: chr(('0x' || h)::int)), '')"
    )


def adjacent(source: str) -> str:
    """Adjacent pairs of ``source(ord, side, seq)`` with their 0-based places."""
    return f"""(SELECT ord, side, u[1] || u[2] AS pair, u[3] AS pos
      FROM (SELECT ord, side, unnest(list_zip(a[1:-2], a[2:], range(0, len(a) - 1))) AS u
            FROM (SELECT ord, side, string_split(seq, '') AS a FROM {source}) WHERE len(a) > 1))"""


BOTH_SIDES = """(SELECT pair_id AS ord, 0 AS side, src AS text FROM {0}
      UNION ALL SELECT pair_id, 1, tgt FROM {0})"""
DOCUMENT_CORPUS = f"corpus AS (SELECT doc_id AS ord, 0 AS side, {latin1('text')} AS seq FROM documents)"
SPLIT_PAIRS = f"{PAIRS}, split_pairs AS {split_of('pairs', 'pair_id')}"
TRAIN_CORPUS = f"""{SPLIT_PAIRS},
corpus AS (SELECT ord, side, {latin1('text')} AS seq
  FROM {BOTH_SIDES.format("(SELECT * FROM split_pairs WHERE split = 'train')")})"""


def merge_rounds(n: int) -> str:
    """``merges(rank, pair)``: n rounds of counting and replacing."""
    return f"""
rounds AS (
  SELECT 0 AS k, ord, side, seq, NULL::varchar AS pair FROM corpus
  UNION ALL
  SELECT r.k + 1, r.ord, r.side, replace(r.seq, t.pair, chr(256 + r.k)), t.pair
  FROM rounds r, (SELECT pair FROM {adjacent('rounds')} GROUP BY pair
                  ORDER BY count(*) DESC, min(struct_pack(o := ord, s := side, p := pos)) LIMIT 1) t
  WHERE r.k < {n}),
merges AS (SELECT DISTINCT k - 1 AS rank, pair FROM rounds WHERE k > 0),
merge_list AS (SELECT list(struct_pack(pair := pair, token := chr(256 + rank)) ORDER BY rank) AS steps
  FROM merges)"""


def encoded(text: str) -> str:
    """Token string of a text; needs ``merge_list`` in scope."""
    return f"""list_reduce(
      list_prepend(struct_pack(pair := '', token := {latin1(text)}), steps),
      lambda s, m: struct_pack(pair := '', token := replace(s.token, m.pair, m.token))).token"""


def ids(seq: str) -> str:
    return f"list_transform(string_split({seq}, ''), lambda c: unicode(c))"


MERGES_OUT = """SELECT rank::int AS rank, unicode(pair[1]) AS "left", unicode(pair[2]) AS "right",
  (256 + rank)::int AS token FROM merges"""
WITH_PAIR_MERGES = f"WITH RECURSIVE {TRAIN_CORPUS}, {merge_rounds(PAIR_MERGES)}"
WITH_DOCUMENT_MERGES = f"WITH RECURSIVE {DOCUMENT_CORPUS}, {merge_rounds(DOCUMENT_MERGES)}"

TOKEN_PAIRS = f"""{WITH_PAIR_MERGES},
token_pairs AS (
  SELECT pair_id, split, {ids(encoded('src'))} AS src_tokens, {ids(encoded('tgt'))} AS tgt_tokens
  FROM split_pairs, merge_list WHERE length(src) <= 300 AND length(tgt) <= {TGT_LIMIT})"""


def padded(tokens: str, start: bool = False, end: bool = False, n: int = 300) -> str:
    first = f"[{START}]" if start else "[]::int[]"
    last = f"[{END}]" if end else "[]::int[]"
    return (
        f"list_resize(list_concat(list_concat({first}, {tokens}), {last})[1:{n}], {n}, {PAD})"
    )


EXAMPLES = f"""{TOKEN_PAIRS},
examples AS (
  SELECT pair_id, split, {padded('src_tokens')} AS src, {padded('tgt_tokens', start=True)} AS tgt,
    {padded('tgt_tokens', end=True)} AS label FROM token_pairs),
lengths AS (
  SELECT *, coalesce(list_position(src, {PAD}) - 1, 300)::int AS src_len,
    coalesce(list_position(tgt, {PAD}) - 1, 300)::int AS tgt_len FROM examples)"""


def flat(columns: str, source: str, *arrays: str) -> str:
    """One row per 0-based position of equally long lists."""
    cells = ", ".join(f"{a}[i] AS {a}" for a in arrays)
    return f"""SELECT {columns}, (i - 1)::int AS pos, {cells}
  FROM (SELECT *, unnest(range(1, len({arrays[0]}) + 1)) AS i FROM {source})"""


def alphabet_usage(language: str) -> str:
    rows = ", ".join(
        "({}, {})".format(i, " || ".join(f"chr({ord(c)})" for c in token))
        for i, token in enumerate(alphabet(language))
    )
    return f"""WITH letters(idx, token) AS (VALUES {rows}),
found AS (SELECT token, count(*) AS n FROM
  (SELECT DISTINCT doc_id, unnest(string_split(text, '')) AS token FROM documents) GROUP BY token)
SELECT idx::int AS idx, letters.token, coalesce(n, 0)::bigint AS n_docs
FROM letters LEFT JOIN found ON found.token = letters.token"""


ENGLISH = alphabet("eng")
ENGLISH_LIST = "[{}]".format(
    ", ".join(" || ".join(f"chr({ord(c)})" for c in token) for token in ENGLISH)
)

SCORED = f"""
scored AS (
  SELECT vec_id, vec_id // 64 AS batch_id, vec_id // 64 // 4 AS epoch, label,
    list_transform(embedding, lambda x: x::double) AS l FROM embeddings),
costs AS (
  SELECT *, CASE WHEN label = {PAD_LABEL} THEN 0.0 ELSE
    ln(list_sum(list_transform(l, lambda x: exp(x)))) - l[label + 1] END AS ce FROM scored),
batches AS (
  SELECT epoch, batch_id, count(*) FILTER (label <> {PAD_LABEL}) AS n_tokens,
    sum(ce) / count(*) FILTER (label <> {PAD_LABEL}) AS loss FROM costs GROUP BY ALL),
epochs AS (SELECT epoch, avg(loss) AS loss, count(*) AS n_batches FROM batches GROUP BY epoch)"""

METRICS = f"""
log AS (SELECT event_type AS tag, date_diff('day', date '1970-01-01', ts::date)::int AS epoch,
  hour(ts)::int AS batch, value FROM events),
rollup_ AS (SELECT tag, epoch, avg(value) AS avg_value, count(*) AS n,
  min(epoch * {BATCHES_PER_EPOCH} + batch)::bigint AS first_step,
  max(epoch * {BATCHES_PER_EPOCH} + batch)::bigint AS last_step FROM log GROUP BY tag, epoch)"""

# Texts left alone, and texts meant to end inside a character where they have none.
DAMAGED = """SELECT doc_id AS pair_id, text AS src, lang AS tgt,
  doc_id % 4 = 0 OR doc_id % 4 = 2 AND NOT regexp_matches(text, '[^\\x00-\\x7f]') AS well_formed FROM documents"""

EARLIER = "ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

ORACLES: dict[str, str] = {
    "top_adjacent_pairs": f"""WITH {PAIRS},
corpus AS (SELECT ord, side, {latin1('text')} AS seq FROM {BOTH_SIDES.format(
    f"(SELECT * FROM pairs WHERE length(src) <= 300 AND length(tgt) <= {TGT_LIMIT})")})
SELECT unicode(pair[1]) AS "left", unicode(pair[2]) AS "right", n FROM (
  SELECT pair, count(*) AS n FROM {adjacent('corpus')} GROUP BY pair
  ORDER BY n DESC, min(struct_pack(o := ord, s := side, p := pos)) LIMIT 20)""",
    "drop_features": "SELECT doc_id, text, lang FROM documents",
    "valid_pairs": f"WITH {PAIRS} SELECT * FROM pairs WHERE src IS NOT NULL AND tgt IS NOT NULL",
    "validity_report": f"""WITH {PAIRS} SELECT
  count(*) FILTER (src IS NULL OR tgt IS NULL) AS invalid, count(*) AS total FROM pairs""",
    "length_filter": f"""WITH {PAIRS} SELECT * FROM pairs
WHERE length(src) <= 300 AND length(tgt) <= {TGT_LIMIT}""",
    "length_filter_default": f"""WITH {PAIRS} SELECT * FROM pairs
WHERE length(src) <= 300 AND length(tgt) <= 299""",
    "length_report": f"""WITH {PAIRS} SELECT
  count(*) FILTER (length(src) > 300 OR length(tgt) > 299) AS exceeded, count(*) AS total FROM pairs""",
    "split_exact": f"SELECT doc_id, split FROM {split_of('documents', 'doc_id')}",
    "split_hash": f"""SELECT doc_id, CASE WHEN k < '4{'0' * 31}' THEN 'test' WHEN k < '8{'0' * 31}' THEN 'val'
  ELSE 'train' END AS split FROM (SELECT doc_id, md5('1:' || doc_id) AS k FROM documents)""",
    "malformed_pairs": "SELECT pair_id, src, tgt FROM (" + DAMAGED + ") WHERE well_formed",
    "malformed_report": "SELECT count(*) FILTER (NOT well_formed) AS invalid, count(*) AS total FROM (" + DAMAGED + ")",
    "split_counts": f"""SELECT split, count(*) AS n_rows
FROM {split_of('documents', 'doc_id')} GROUP BY split""",
    "split_storage": f"WITH {SPLIT_PAIRS} SELECT pair_id, src, tgt FROM split_pairs WHERE split = 'val'",
    "read_parquet": f"WITH {PAIRS} SELECT * FROM pairs",
    "read_json": f"WITH {PAIRS} SELECT * FROM pairs",
    "read_orc": f"WITH {PAIRS} SELECT * FROM pairs",
    "read_csv": f"WITH {PAIRS} SELECT * FROM pairs",
    "damaged_json": """SELECT CASE WHEN doc_id % 4 = 0 THEN doc_id END AS pair_id,
  CASE WHEN doc_id % 4 = 0 THEN md5(text) END AS src, CASE WHEN doc_id % 4 = 0 THEN lang END AS tgt,
  CASE WHEN doc_id % 4 IN (1, 2) THEN 'unreadable' WHEN doc_id % 4 = 3 THEN 'no id' END AS reason,
  CASE doc_id % 4 WHEN 1 THEN '{"pair_id":' || doc_id || ',"src":"' || md5(text)
    WHEN 2 THEN '{"pair_id":"n' || doc_id || '","src":"' || md5(text) || '","tgt":"' || lang || '"}'
    WHEN 3 THEN '{"src":"' || md5(text) || '","tgt":"' || lang || '"}' END AS record
FROM documents""",
    "damaged_csv": """SELECT CASE WHEN doc_id % 4 = 0 THEN doc_id END AS pair_id,
  CASE WHEN doc_id % 4 = 0 THEN md5(text) END AS src, CASE WHEN doc_id % 4 = 0 THEN lang END AS tgt,
  CASE WHEN doc_id % 4 > 0 THEN 'unreadable' END AS reason,
  CASE doc_id % 4 WHEN 1 THEN doc_id || ',' || md5(text) WHEN 2 THEN 'n' || doc_id || ',' || md5(text) || ',' || lang
    WHEN 3 THEN doc_id || ',' || md5(text) || ',' || lang || ',more' END AS record
FROM documents""",
    "first_n": """SELECT doc_id, lang FROM
  (SELECT *, row_number() OVER (ORDER BY doc_id) AS r FROM documents) WHERE r <= 300""",
    "first_n_shuffled": f"SELECT doc_id, lang FROM {numbered('documents', 'doc_id')} WHERE k < 300",
    "first_n_per_split": f"""SELECT doc_id, split FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY k) AS r
  FROM {split_of('documents', 'doc_id')})
WHERE r <= CASE split WHEN 'train' THEN 300 ELSE 100 END""",
    "shuffle_epoch": f"SELECT doc_id, k AS ordinal FROM {numbered('documents', 'doc_id', '1:3')}",
    "permuted_epoch": f"WITH {permuted('documents', 'doc_id', 1, 3)} SELECT doc_id, k AS position, x AS ordinal FROM places",
    "permuted_batches": f"""WITH {permuted('documents', 'doc_id', 1, 1)}
SELECT doc_id, x // 64 AS batch_id, (x % 64)::int AS slot, length(text)::int AS n_chars
FROM places JOIN documents USING (doc_id) WHERE x < total // 64 * 64""",
    "chosen_batches": f"""WITH {permuted('documents', 'doc_id', 1, 1)}
SELECT doc_id, x // 64 AS batch_id, (x % 64)::int AS slot, length(text)::int AS n_chars
FROM places JOIN documents USING (doc_id) WHERE x < total // 64 * 64 AND x // 64 IN (0, 2, 5)""",
    "batches": f"""SELECT doc_id, k // 64 AS batch_id, (k % 64)::int AS slot
FROM {numbered('documents', 'doc_id', '1:0')} WHERE k < total // 64 * 64""",
    "every_k": f"""SELECT doc_id, k // 64 AS batch_id, (k % 64)::int AS slot
FROM {numbered('documents', 'doc_id', '1:0')} WHERE k < total // 64 * 64 AND k // 64 % 5 = 0""",
    "preview_batches": f"""SELECT doc_id, k // 64 AS batch_id, (k % 64)::int AS slot
FROM {numbered('documents', 'doc_id', '1:0')} WHERE k < total // 64 * 64 AND k // 64 <= 2""",
    "corpus_sides": f"WITH {PAIRS} SELECT ord, side::int AS side, text FROM {BOTH_SIDES.format('pairs')}",
    "byte_tokens": f"""WITH {PAIRS},
sides AS (SELECT ord, side::int AS side, list_transform(regexp_extract_all(hex(encode(text)), '..'),
  lambda h: ('0x' || h)::int) AS token FROM {BOTH_SIDES.format('pairs')})
{flat('ord, side', 'sides', 'token')}""",
    "pair_counts": f"""WITH {DOCUMENT_CORPUS}
SELECT unicode(pair[1]) AS "left", unicode(pair[2]) AS "right", count(*) AS n
FROM {adjacent('corpus')} GROUP BY pair""",
    "top_pair": f"""WITH {PAIRS},
corpus AS (SELECT ord, side, {latin1('text')} AS seq FROM {BOTH_SIDES.format('pairs')})
SELECT unicode(pair[1]) AS "left", unicode(pair[2]) AS "right", n,
  f.o AS ord, f.s::int AS side, f.p::int AS pos FROM (
  SELECT pair, count(*) AS n, min(struct_pack(o := ord, s := side, p := pos)) AS f
  FROM {adjacent('corpus')} GROUP BY pair ORDER BY n DESC, f LIMIT 1)""",
    "apply_merge": f"""SELECT doc_id, length(replace({latin1('text')}, 'e ', chr(256)))::int AS n_tokens
FROM documents""",
    "bpe_merges_8": f"{WITH_DOCUMENT_MERGES} {MERGES_OUT}",
    "bpe_merges_244": f"WITH RECURSIVE {TRAIN_CORPUS}, {merge_rounds(244)} {MERGES_OUT}",
    "bpe_vocabulary": f"""{WITH_PAIR_MERGES},
undo AS (SELECT list(struct_pack(pair := pair, token := chr(256 + rank)) ORDER BY rank DESC) AS steps
  FROM merges)
SELECT i::int AS token, array_to_string(list_transform(string_split(list_reduce(
    list_prepend(struct_pack(pair := '', token := chr(i::int)), steps),
    lambda s, m: struct_pack(pair := '', token := replace(s.token, m.token, m.pair))).token, ''),
  lambda c: printf('%02X', unicode(c))), '') AS bytes_hex, false AS is_special
FROM range(0, {256 + PAIR_MERGES}) r(i), undo
UNION ALL SELECT * FROM (VALUES ({START}, hex(encode('{START_TOKEN}')), true),
  ({PAD}, hex(encode('{PADDING_TOKEN}')), true), ({END}, hex(encode('{END_TOKEN}')), true))""",
    "bpe_encode": f"""{WITH_PAIR_MERGES},
sides AS (SELECT ord, side::int AS side, {ids(encoded('text'))} AS token
  FROM {BOTH_SIDES.format('pairs')}, merge_list)
{flat('ord, side', 'sides', 'token')}""",
    "bpe_encode_documents": f"""{WITH_PAIR_MERGES}
SELECT doc_id, length({encoded('text')})::int AS n_tokens FROM documents, merge_list""",
    "bpe_decode": "SELECT doc_id, text FROM documents",
    "bpe_decode_520": f"SELECT doc_id, text || '{END_TOKEN}' AS text FROM documents",
    "decode_stored": "SELECT doc_id, text FROM documents",
    "prepare_again": f"WITH {SPLIT_PAIRS} SELECT split, count(*) AS n_rows FROM split_pairs GROUP BY split",
    "roundtrip": "SELECT count(*) AS n_failed FROM (" + DAMAGED + ") WHERE NOT well_formed AND pair_id % 4 <> 3",
    "token_pairs": f"""{TOKEN_PAIRS},
sides AS (SELECT pair_id, split, 0 AS side, src_tokens AS token FROM token_pairs
  UNION ALL SELECT pair_id, split, 1, tgt_tokens FROM token_pairs)
{flat('pair_id, split, side', 'sides', 'token')}""",
    "prepare_corpus": f"{WITH_PAIR_MERGES} {MERGES_OUT}",
    "padded_train": f"""{TOKEN_PAIRS},
train AS (SELECT pair_id, split, {padded('src_tokens')} AS src, {padded('tgt_tokens', end=True)} AS tgt,
  {padded('tgt_tokens', end=True)} AS label FROM token_pairs)
{flat('pair_id, split', 'train', 'src', 'tgt', 'label')}""",
    "padded_eval": f"{EXAMPLES} {flat('pair_id, split', 'examples', 'src', 'tgt', 'label')}",
    "valid_length": f"{EXAMPLES} SELECT pair_id, src_len, tgt_len FROM lengths",
    "length_mask": f"""{EXAMPLES}
SELECT pair_id, p::int AS pos, (p < src_len)::tinyint AS visible FROM lengths, range(0, 300) r(p)""",
    "visible_cells": f"""{EXAMPLES}
SELECT pair_id, (src_len * src_len)::bigint AS encoder_cells,
  (tgt_len * (tgt_len + 1) // 2)::bigint AS decoder_cells,
  (tgt_len * src_len)::bigint AS cross_cells FROM lengths""",
    "non_pad": f"""{EXAMPLES}
SELECT pair_id, len(list_filter(label, lambda x: x <> {PAD}))::int AS n_labels FROM examples""",
    "cut_ends": f"""{TOKEN_PAIRS}
SELECT count(*) FILTER (len(tgt_tokens) >= 300) AS n_cut,
  count(*) FILTER (len(src_tokens) > 300) AS n_src_cut, count(*) AS total FROM token_pairs""",
    "epoch_batches": f"""{EXAMPLES},
placed AS (SELECT * FROM {numbered("(SELECT * FROM examples WHERE split = 'train')", 'pair_id', '1:1')}
  WHERE k < total // 16 * 16)
SELECT k // 16 AS batch_id, count(*) AS n_rows, sum(pair_id)::bigint AS sum_ids,
  sum(list_sum(src))::bigint AS sum_src, sum(list_sum(tgt))::bigint AS sum_tgt
FROM placed GROUP BY k // 16""",
    "alphabet_ml": alphabet_usage("ml"),
    "alphabet_eng": alphabet_usage("eng"),
    "character_vocabulary": """WITH spots AS (
  SELECT doc_id, unnest(list_zip(a, range(0, len(a)))) AS u
  FROM (SELECT doc_id, string_split(text, '') AS a FROM documents)),
firsts AS (SELECT u[1] AS token, min(struct_pack(d := doc_id, p := u[2])) AS f FROM spots GROUP BY u[1])
SELECT (row_number() OVER (ORDER BY f) - 1)::int AS idx, token FROM firsts""",
    "vocab_index": f"""WITH {PAIRS},
sides AS (SELECT ord, side::int AS side, list_transform(string_split(text, ''),
  lambda c: coalesce(list_position({ENGLISH_LIST}, c) - 1, 3)::int) AS token
  FROM {BOTH_SIDES.format('pairs')})
{flat('ord, side', 'sides', 'token')}""",
    "document_indexes": """WITH spots AS (
  SELECT doc_id, i, a[i] AS token FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i
    FROM (SELECT doc_id, string_split(text, '') AS a FROM documents))),
firsts AS (SELECT token, min(struct_pack(d := doc_id, p := i)) AS f FROM spots GROUP BY token),
vocabulary AS (SELECT token, row_number() OVER (ORDER BY f) AS idx FROM firsts)
SELECT doc_id, count(*)::int AS n_chars, sum(i * idx)::bigint AS weighted_sum
FROM spots JOIN vocabulary USING (token) GROUP BY doc_id""",
    "detokenize": f"""SELECT doc_id, array_to_string(list_transform(string_split(text, ''),
  lambda c: CASE WHEN list_contains({ENGLISH_LIST}, c) THEN c ELSE '{ENGLISH[3]}' END), '') AS text
FROM documents""",
    "token_ce": f"WITH {SCORED} SELECT vec_id, round(ce, 6) AS cross_entropy FROM costs",
    "argmax": f"WITH {SCORED} SELECT vec_id, (list_position(l, list_max(l)) - 1)::int AS picked FROM scored",
    "sharded_scores": f"""WITH {SCORED} SELECT vec_id, round(ce, 6) AS cross_entropy,
  (list_position(l, list_max(l)) - 1)::int AS picked FROM costs""",
    "sharded_batch_loss": f"WITH {SCORED} SELECT batch_id, n_tokens, round(loss, 6) AS loss FROM batches",
    "batch_loss": f"WITH {SCORED} SELECT batch_id, n_tokens, round(loss, 6) AS loss FROM batches",
    "epoch_loss": f"WITH {SCORED} SELECT epoch, round(loss, 6) AS loss, n_batches FROM epochs",
    "validation_report": f"""WITH {SCORED} SELECT epoch, round(loss, 6) AS loss, n_batches,
  coalesce(loss < min(loss) OVER ({EARLIER}), true) AS is_best FROM epochs""",
    "cut_at_end": f"""{TOKEN_PAIRS},
cut AS (SELECT pair_id, list_concat(tgt_tokens, [{END}]) AS token FROM token_pairs)
{flat('pair_id', 'cut', 'token')}""",
    "decode_generated": f"WITH {PAIRS} SELECT pair_id, src || '{END_TOKEN}' AS text FROM pairs",
    "metric_rollup": f"""WITH {METRICS}
SELECT tag, epoch, round(avg_value, 6) AS avg_value, n, first_step, last_step FROM rollup_""",
    "metric_rollup_streamed": f"""WITH {METRICS}
SELECT tag, epoch, round(avg_value, 6) AS avg_value, n, first_step, last_step FROM rollup_""",
    "best_so_far": f"""WITH {METRICS}
SELECT tag, epoch, round(avg_value, 6) AS loss,
  coalesce(avg_value < min(avg_value) OVER (PARTITION BY tag {EARLIER}), true) AS is_best
FROM rollup_""",
}
