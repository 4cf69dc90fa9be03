"""One query per operator, over the given tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twintext.functions.examples import length_mask, pad_tokens
from twintext.functions.scoring import cut_at_end, decode_generated
from twintext.functions.text import order_key
from twintext.functions.tokens import Merge, bpe_decode, bpe_encode, token_array
from twintext.operators import alphabet as letters
from twintext.operators.batches import (
    assign_batches,
    first_batches,
    sample_every_k,
    shuffle_epoch,
)
from twintext.operators.bpe import (
    apply_merge,
    expand_vocab,
    merges_table,
    most_frequent_pair,
    roundtrip_failures,
    stored_bytes,
    train_bpe,
    vocabulary_bytes,
)
from twintext.operators.corpus import byte_tokens, text_corpus, unpivot_corpus
from twintext.operators.evaluate import (
    batch_loss,
    batch_loss_of_costs,
    best_so_far,
    epoch_loss,
    metric_rollup,
    score_tokens,
)
from twintext.operators.filters import (
    drop_features,
    filter_length,
    filter_valid_utf8,
    length_report,
    split_counts,
    validity_report,
)
from twintext.operators.indexed_bpe import train_bpe_indexed
from twintext.operators.pair_counts import count_adjacent_pairs
from twintext.operators.permutation import permuted_batches, permuted_epoch, read_batches, store_positions
from twintext.operators.sharded import shard_logits, sharded_scores
from twintext.operators.splits import (
    random_split_exact,
    random_split_hash,
    take_first_n,
    take_first_n_per_split,
)
from twintext.params import PrepParams
from twintext.plans.examples import (
    build_token_pairs,
    cut_ends,
    epoch_batches,
    eval_examples,
    example_lengths,
    train_examples,
)
from twintext.plans.prepare import prepare_corpus
from twintext.plans.scoring import validation_report
from twintext.sources.pairs import read_pairs, read_split, turn_pairs, write_splits
from twintext.sources.quarantine import store_sides
from twintext.sources.storage import delete_path, ensure_directory, join_path, shared_directory
from twintext.sources.tokens import read_token_pairs, write_token_pairs
from twintext.sources.vocabulary import read_vocabulary
from twintext.streaming.metrics import append_log, end_log, stream_log, streamed_rollup, write_rollup_stream

TGT_LIMIT = 2000  # the given replies are longer than the default limit
PAIR_MERGES = 244
DOCUMENT_MERGES = 8
LARGE_VOCABULARY = 520
INDEXED_VOCABULARY = 640
INDEXED_BLOCK = 4096
PAD_LABEL = 9
BATCHES_PER_EPOCH = 24
POSITIONS_TO_A_PART = 100
SHARD_WIDTH = 16
LOG_PIECES = 4
CAPS = PrepParams(max_train_size=300, max_val_size=100, max_test_size=100)


# By turns a line is whole, ends early, has a word for an id, or lacks the id (JSON) or a field (CSV).
DAMAGED_JSON_LINE = """CASE doc_id % 4
  WHEN 0 THEN '{"pair_id":' || doc_id || ',"src":"' || md5(text) || '","tgt":"' || lang || '"}'
  WHEN 1 THEN '{"pair_id":' || doc_id || ',"src":"' || md5(text)
  WHEN 2 THEN '{"pair_id":"n' || doc_id || '","src":"' || md5(text) || '","tgt":"' || lang || '"}'
  ELSE '{"src":"' || md5(text) || '","tgt":"' || lang || '"}' END"""
DAMAGED_CSV_LINE = """CASE doc_id % 4
  WHEN 0 THEN doc_id || ',' || md5(text) || ',' || lang
  WHEN 1 THEN doc_id || ',' || md5(text)
  WHEN 2 THEN 'n' || doc_id || ',' || md5(text) || ',' || lang
  ELSE doc_id || ',' || md5(text) || ',' || lang || ',more' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *columns)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_pairs(table(spark, sf_dir, "conversations"))


def stored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs as a table, for what reads them again and again."""
    path = join_path(fresh_directory(spark), "pairs")
    pairs(spark, sf_dir).write.parquet(path)
    return read_pairs(spark, path)


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pairs in a binary Parquet table, of which many are damaged.

    By turns a text is left alone, led by a byte that no text holds, ended inside
    its last character of several bytes, or missing.
    """
    data = F.col("text").cast("binary")
    ascii_end = F.octet_length(F.regexp_extract(F.reverse("text"), r"\A[\x00-\x7f]*", 0))
    n_bytes = F.octet_length("text")
    inside = F.when(ascii_end == n_bytes, data).otherwise(F.substring(data, F.lit(1), n_bytes - ascii_end - 1))
    kind = F.col("doc_id") % 4
    src = F.when(kind == 0, data).when(kind == 1, F.concat(F.lit(b"\xff"), data)).when(kind == 2, inside)
    path = join_path(fresh_directory(spark), "damaged")
    docs = documents(spark, sf_dir, "text", "lang")
    docs.select(
        F.col("doc_id").alias("pair_id"), src.alias("src"), F.col("lang").cast("binary").alias("tgt")
    ).write.parquet(path)
    return read_pairs(spark, path, schema="pair_id long, src binary, tgt binary")


def split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_valid_utf8(random_split_exact(pairs(spark, sf_dir)))


def pair_merges(spark: SparkSession, sf_dir: str, n: int = PAIR_MERGES) -> list[Merge]:
    splits = filter_valid_utf8(random_split_exact(stored_pairs(spark, sf_dir)))
    train = splits.where(F.col("split") == "train")
    return train_bpe(unpivot_corpus(train), 256 + n)


def document_merges(spark: SparkSession, sf_dir: str, n: int = DOCUMENT_MERGES) -> list[Merge]:
    corpus = text_corpus(documents(spark, sf_dir, "text"), "doc_id")
    return train_bpe(corpus, 256 + n)


def token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_token_pairs(
        split_pairs(spark, sf_dir), pair_merges(spark, sf_dir), tgt_limit=TGT_LIMIT
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = F.floor(F.col("vec_id") / 64)
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        batch.alias("batch_id"),
        F.floor(batch / 4).alias("epoch"),
        F.col("embedding").alias("logits"),
        "label",
    )


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tag"),
        F.unix_date(F.to_date("ts")).alias("epoch"),
        F.hour("ts").alias("batch"),
        "value",
    )


def by_position(df: DataFrame, *arrays: str) -> DataFrame:
    """One row per position of equally long arrays."""
    rest = [c for c in df.columns if c not in arrays]
    return df.select(*rest, F.posexplode(F.arrays_zip(*arrays)).alias("pos", "cell")).select(
        *rest, "pos", *[F.col(f"cell.{a}").alias(a) for a in arrays]
    )


def by_token(df: DataFrame, tokens: str) -> DataFrame:
    rest = [c for c in df.columns if c != tokens]
    return df.select(*rest, F.posexplode(tokens).alias("pos", "token"))


def fresh_directory(spark: SparkSession) -> str:
    """A folder in the shared one, deleted at the end as lazy results still read it."""
    path = join_path(shared_directory(spark), f"twintext-query-{uuid.uuid4().hex}")
    atexit.register(_delete, spark, path)
    return ensure_directory(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception:  # the session has ended before
        pass


def top_adjacent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read, filter, unpivot, tokenize, count: the 20 leading pairs with ties in order."""
    kept = filter_length(filter_valid_utf8(pairs(spark, sf_dir)), 300, TGT_LIMIT)
    counted = count_adjacent_pairs(byte_tokens(unpivot_corpus(kept)), with_first=True)
    return counted.orderBy(F.desc("n"), "first").limit(20).select("left", "right", "n")


def _valid_pairs(spark, d):
    return filter_valid_utf8(pairs(spark, d))


def _length_filter(spark, d):
    return filter_length(pairs(spark, d), 300, TGT_LIMIT)


def _length_filter_default(spark, d):
    return filter_length(pairs(spark, d))


def _length_report(spark, d):
    return length_report(pairs(spark, d))


def _validity_report(spark, d):
    return validity_report(pairs(spark, d))


def _drop_features(spark, d):
    return drop_features(table(spark, d, "documents"), "source", "n_chars")


def _split_exact(spark, d):
    return random_split_exact(documents(spark, d), "doc_id")


def _split_hash(spark, d):
    return random_split_hash(documents(spark, d), "doc_id")


def _split_counts(spark, d):
    return split_counts(_split_exact(spark, d))


def _split_storage(spark, d):
    path = join_path(fresh_directory(spark), "splits")
    write_splits(split_pairs(spark, d), path)
    return read_split(spark, path, "val").select("pair_id", "src", "tgt")


def _reread(spark, d, format, **options):
    """Pairs written in another format and read back with the given schema."""
    path = join_path(fresh_directory(spark), format)
    pairs(spark, d).write.options(**options).format(format).save(path)
    return read_pairs(spark, path, format, **options)


def _read_csv(spark, d):
    # Texts hold line breaks and quotes and are kept to the last blank.
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return _reread(spark, d, "csv", multiLine="true", escape='"', **blanks)


def _written_lines(spark, d, line, format):
    """Documents as lines of text, of which many are damaged, read and split in two."""
    base = fresh_directory(spark)
    lines = documents(spark, d, "text", "lang").select(F.expr(line).alias("value"))
    lines.write.text(join_path(base, "lines"))
    sides = store_sides(spark, join_path(base, "lines"), base, format)
    kept = sides.pairs.select("*", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("record"))
    return kept.unionByName(sides.set_aside.drop("file"), allowMissingColumns=True)


def _damaged_json(spark, d):
    return _written_lines(spark, d, DAMAGED_JSON_LINE, "json")


def _damaged_csv(spark, d):
    return _written_lines(spark, d, DAMAGED_CSV_LINE, "csv")


def _first_n(spark, d):
    return take_first_n(documents(spark, d, "lang"), 300, "doc_id")


def _first_n_shuffled(spark, d):
    return take_first_n(documents(spark, d, "lang"), 300, key=order_key(F.col("doc_id"), 1))


def _first_n_per_split(spark, d):
    return take_first_n_per_split(_split_exact(spark, d), "doc_id", CAPS)


def _shuffle_epoch(spark, d):
    return shuffle_epoch(documents(spark, d), 3, "doc_id")


def _batches(spark, d):
    return assign_batches(documents(spark, d), 0, "doc_id")


def _every_k(spark, d):
    return sample_every_k(_batches(spark, d), 5)


def _preview(spark, d):
    return first_batches(documents(spark, d), 2, 0, "doc_id")


def stored_positions(spark, d):
    """Documents with positions, stored in ranges, and their number."""
    path = join_path(fresh_directory(spark), "positions")
    total = store_positions(documents(spark, d, "text"), path, "doc_id", rows_per_part=POSITIONS_TO_A_PART)
    return spark.read.parquet(path), total


def _permuted_epoch(spark, d):
    rows, total = stored_positions(spark, d)
    return permuted_epoch(rows, total, 3).select("doc_id", "position", "ordinal")


def _permuted_batches(spark, d):
    rows, total = stored_positions(spark, d)
    return permuted_batches(rows, total, 1).select("doc_id", "batch_id", "slot", F.length("text").alias("n_chars"))


def _chosen_batches(spark, d):
    rows, total = stored_positions(spark, d)
    chosen = read_batches(rows, total, [0, 2, 5], 1, rows_per_part=POSITIONS_TO_A_PART)
    return chosen.select("doc_id", "batch_id", "slot", F.length("text").alias("n_chars"))


def _corpus_sides(spark, d):
    return unpivot_corpus(pairs(spark, d))


def _byte_tokens(spark, d):
    rows = byte_tokens(unpivot_corpus(pairs(spark, d)))
    return by_token(rows.select("ord", "side", token_array(F.col("seq")).alias("ids")), "ids")


def _pair_counts(spark, d):
    return count_adjacent_pairs(byte_tokens(text_corpus(documents(spark, d, "text"), "doc_id")))


def _top_pair(spark, d):
    corpus = byte_tokens(unpivot_corpus(pairs(spark, d)))
    return most_frequent_pair(corpus).select("left", "right", "n", "first.ord", "first.side", "first.pos")


def _apply_merge(spark, d):
    corpus = byte_tokens(text_corpus(documents(spark, d, "text"), "doc_id"))
    merged = apply_merge(corpus, Merge(ord("e"), ord(" "), 256))
    return merged.select(F.col("ord").alias("doc_id"), F.char_length("seq").alias("n_tokens"))


def _bpe_merges(spark, d):
    return merges_table(spark, document_merges(spark, d))


def _bpe_merges_documents_full(spark, d):
    return merges_table(spark, document_merges(spark, d, 244))


def _bpe_merges_documents_indexed(spark, d):
    corpus = text_corpus(documents(spark, d, "text"), "doc_id")
    return merges_table(spark, train_bpe_indexed(corpus, INDEXED_VOCABULARY, block_tokens=INDEXED_BLOCK))


def _bpe_merges_full(spark, d):
    return merges_table(spark, pair_merges(spark, d, 244))


def _bpe_vocabulary(spark, d):
    table_ = expand_vocab(spark, pair_merges(spark, d), special=True)
    return table_.select("token", F.hex("bytes").alias("bytes_hex"), "is_special")


def _bpe_encode(spark, d):
    merges = pair_merges(spark, d)
    sides = unpivot_corpus(pairs(spark, d))
    encoded = sides.select("ord", "side", bpe_encode(F.col("text"), merges).alias("ids"))
    return by_token(encoded, "ids")


def _bpe_encode_documents(spark, d):
    merges = pair_merges(spark, d)
    docs = documents(spark, d, "text")
    return docs.select("doc_id", F.size(bpe_encode(F.col("text"), merges)).alias("n_tokens"))


def _bpe_decode(spark, d):
    merges = pair_merges(spark, d)
    docs = documents(spark, d, "text")
    ids = bpe_encode(F.col("text"), merges)
    return docs.select("doc_id", bpe_decode(ids, vocabulary_bytes(merges)).alias("text"))


def _bpe_decode_520(spark, d):
    """A vocabulary larger than the default one, with its special tokens, over the documents."""
    docs = documents(spark, d, "text")
    merges = train_bpe(text_corpus(docs, "doc_id"), LARGE_VOCABULARY)
    table_ = vocabulary_bytes(merges, vocab_size=LARGE_VOCABULARY)
    params = PrepParams(vocab_size=LARGE_VOCABULARY)
    closed = F.concat(bpe_encode(F.col("text"), merges), F.array(F.lit(params.end_id)))
    return docs.select("doc_id", bpe_decode(closed, table_).alias("text"))


def _decode_stored(spark, d):
    """Decoding with the vocabulary that a preparation run has stored."""
    run = fresh_directory(spark)
    merges = prepare_corpus(spark, stored_pairs(spark, d), run).merges
    stored = stored_bytes(read_vocabulary(spark, join_path(run, "bpe")))
    docs = documents(spark, d, "text")
    return docs.select("doc_id", bpe_decode(bpe_encode(F.col("text"), merges), stored).alias("text"))


def _prepare_again(spark, d):
    """A run over other pairs is refused, a second one over equal pairs reads what the first one stored."""
    run, params = fresh_directory(spark), PrepParams()
    stored = stored_pairs(spark, d)
    prepare_corpus(spark, stored, run, params)
    try:
        prepare_corpus(spark, stored.where(F.lit(False)), run, params)
    except ValueError:
        return split_counts(prepare_corpus(spark, stored, run, params).splits)
    raise RuntimeError("pairs that differ were taken for the stored ones")


def _roundtrip(spark, d):
    """Every whole document, and the damaged copies as further rows.

    Damaged texts come back otherwise; all others come back as they were.
    """
    whole = documents(spark, d, "text").withColumnRenamed("doc_id", "pair_id")
    copies = damaged(spark, d).select("pair_id", F.col("src").alias("text"))
    failed = roundtrip_failures(whole.unionByName(copies), pair_merges(spark, d))
    return failed.agg(F.count(F.lit(1)).alias("n_failed"))


def _malformed_pairs(spark, d):
    return filter_valid_utf8(damaged(spark, d))


def _malformed_report(spark, d):
    return validity_report(damaged(spark, d))


def _token_pairs(spark, d):
    path = join_path(fresh_directory(spark), "token_pairs")
    write_token_pairs(token_pairs(spark, d), path)
    stored = read_token_pairs(spark, path)
    return by_token(
        stored.select(
            "pair_id", "split", F.posexplode(F.array("src_tokens", "tgt_tokens")).alias("side", "ids")
        ),
        "ids",
    )


def _prepare_corpus(spark, d):
    params = PrepParams(vocab_size=256 + PAIR_MERGES)
    prepared = prepare_corpus(spark, stored_pairs(spark, d), fresh_directory(spark), params)
    return merges_table(spark, prepared.merges)


def _padded_train(spark, d):
    return by_position(train_examples(token_pairs(spark, d)), "src", "tgt", "label")


def _padded_eval(spark, d):
    return by_position(eval_examples(token_pairs(spark, d)), "src", "tgt", "label")


def _lengths(spark, d):
    return example_lengths(eval_examples(token_pairs(spark, d)))


def _valid_length(spark, d):
    return _lengths(spark, d).select("pair_id", "src_len", "tgt_len")


def _length_mask(spark, d):
    masked = _lengths(spark, d).select("pair_id", length_mask(F.col("src_len")).alias("mask"))
    return masked.select("pair_id", F.posexplode("mask").alias("pos", "visible"))


def _visible_cells(spark, d):
    return _lengths(spark, d).select("pair_id", "encoder_cells", "decoder_cells", "cross_cells")


def _non_pad(spark, d):
    return _lengths(spark, d).select("pair_id", "n_labels")


def _cut_ends(spark, d):
    return cut_ends(token_pairs(spark, d))


def _epoch_batches(spark, d):
    train = token_pairs(spark, d).where(F.col("split") == "train")
    batches = epoch_batches(train, 1, PrepParams(batch_size=16))
    return batches.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("pair_id").alias("sum_ids"),
        F.sum(F.aggregate("src", F.lit(0).cast("long"), lambda a, x: a + x)).alias("sum_src"),
        F.sum(F.aggregate("tgt", F.lit(0).cast("long"), lambda a, x: a + x)).alias("sum_tgt"),
    )


def _alphabet_usage(spark, d, language):
    """Every letter of an alphabet with the number of documents that hold it."""
    found = letters.characters(documents(spark, d, "text"), "doc_id").groupBy("token").count()
    vocabulary = letters.alphabet_table(spark, language)
    return vocabulary.join(found, "token", "left").select(
        "idx", "token", F.coalesce("count", F.lit(0)).cast("long").alias("n_docs")
    )


def _character_vocabulary(spark, d):
    return letters.character_vocabulary(documents(spark, d, "text"), "doc_id")


def _vocab_indexes(spark, d):
    _, to_index = letters.vocab_index(letters.alphabet_table(spark, "eng"))
    sides = unpivot_corpus(pairs(spark, d))
    return by_token(
        sides.select("ord", "side", letters.index_characters(F.col("text"), to_index).alias("ids")), "ids"
    )


def _document_indexes(spark, d):
    """Documents indexed with the characters that they hold themselves."""
    docs = documents(spark, d, "text")
    _, to_index = letters.vocab_index(letters.character_vocabulary(docs, "doc_id"))
    indexed = docs.select("doc_id", letters.index_characters(F.col("text"), to_index).alias("ids"))
    weighted = F.aggregate(
        F.transform("ids", lambda x, i: (i + 1).cast("long") * (x + 1)), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return indexed.select("doc_id", F.size("ids").alias("n_chars"), weighted.alias("weighted_sum"))


def _detokenize(spark, d):
    to_token, to_index = letters.vocab_index(letters.alphabet_table(spark, "eng"))
    ids = letters.index_characters(F.col("text"), to_index)
    docs = documents(spark, d, "text")
    return docs.select("doc_id", letters.detokenize(ids, to_token).alias("text"))


def _token_ce(spark, d):
    rows = score_tokens(scored(spark, d), pad_id=PAD_LABEL)
    return rows.select("vec_id", F.round("cross_entropy", 6).alias("cross_entropy"))


def _argmax(spark, d):
    return score_tokens(scored(spark, d), pad_id=PAD_LABEL).select("vec_id", "picked")


def _sharded_scores(spark, d):
    shards = shard_logits(scored(spark, d), SHARD_WIDTH)
    rows = sharded_scores(shards, ("vec_id",), pad_id=PAD_LABEL)
    return rows.select("vec_id", F.round("cross_entropy", 6).alias("cross_entropy"), "picked")


def _sharded_batch_loss(spark, d):
    shards = shard_logits(scored(spark, d), SHARD_WIDTH)
    costs = sharded_scores(shards, ("vec_id", "batch_id"), pad_id=PAD_LABEL)
    losses = batch_loss_of_costs(costs, pad_id=PAD_LABEL)
    return losses.select("batch_id", "n_tokens", F.round("loss", 6).alias("loss"))


def _batch_loss(spark, d):
    losses = batch_loss(scored(spark, d), pad_id=PAD_LABEL)
    return losses.select("batch_id", "n_tokens", F.round("loss", 6).alias("loss"))


def _epoch_loss(spark, d):
    batches = batch_loss(scored(spark, d), ("epoch", "batch_id"), pad_id=PAD_LABEL)
    return epoch_loss(batches).select("epoch", F.round("loss", 6).alias("loss"), "n_batches")


def _validation_report(spark, d):
    report = validation_report(scored(spark, d), PAD_LABEL)
    return report.select("epoch", F.round("loss", 6).alias("loss"), "n_batches", "is_best")


def _cut_at_end(spark, d):
    generated = token_pairs(spark, d).select(
        "pair_id", pad_tokens(F.col("tgt_tokens"), TGT_LIMIT + 2, start=True, end=True).alias("ids")
    )
    return by_token(generated.select("pair_id", cut_at_end(F.col("ids")).alias("ids")), "ids")


def _decode_generated(spark, d):
    merges = pair_merges(spark, d)
    encoded = pairs(spark, d).select("pair_id", bpe_encode(F.col("src"), merges).alias("ids"))
    # Three of padding behind the end of every row, whatever its length.
    ids = pad_tokens(F.col("ids"), F.size("ids") + 5, start=True, end=True)
    return encoded.select("pair_id", decode_generated(ids, vocabulary_bytes(merges)).alias("text"))


def _metric_rollup(spark, d):
    rolled = metric_rollup(metric_log(spark, d), BATCHES_PER_EPOCH)
    return rolled.withColumn("avg_value", F.round("avg_value", 6))


def _streamed_rollup(spark, d):
    """The log arrives in pieces, by epochs; the stream is stopped and started again after each."""
    base = fresh_directory(spark)
    source, sink, marks = (join_path(base, n) for n in ("log", "rollup", "marks"))
    log = metric_log(spark, d)
    low, high = log.agg(F.min("epoch"), F.max("epoch")).first()
    width = (high - low) // LOG_PIECES + 1
    for piece in range(LOG_PIECES):
        start = low + piece * width
        append_log(log.where(F.col("epoch").between(start, start + width - 1)), source)
        if piece == LOG_PIECES - 1:
            end_log(spark, source, high, width)
        rollup = streamed_rollup(stream_log(spark, source), BATCHES_PER_EPOCH, late_epochs=width)
        write_rollup_stream(rollup, sink, marks).awaitTermination()
    return spark.read.parquet(sink).withColumn("avg_value", F.round("avg_value", 6))


def _best_so_far(spark, d):
    rolled = metric_rollup(metric_log(spark, d), BATCHES_PER_EPOCH)
    losses = rolled.select("tag", "epoch", F.col("avg_value").alias("loss"))
    return best_so_far(losses, ("tag",)).withColumn("loss", F.round("loss", 6))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_adjacent_pairs": top_adjacent_pairs,
    "drop_features": _drop_features,
    "valid_pairs": _valid_pairs,
    "validity_report": _validity_report,
    "malformed_pairs": _malformed_pairs,
    "malformed_report": _malformed_report,
    "length_filter": _length_filter,
    "length_filter_default": _length_filter_default,
    "length_report": _length_report,
    "split_exact": _split_exact,
    "split_hash": _split_hash,
    "split_counts": _split_counts,
    "split_storage": _split_storage,
    "read_parquet": lambda spark, d: _reread(spark, d, "parquet"),
    "read_json": lambda spark, d: _reread(spark, d, "json"),
    "read_orc": lambda spark, d: _reread(spark, d, "orc"),
    "read_csv": _read_csv,
    "damaged_json": _damaged_json,
    "damaged_csv": _damaged_csv,
    "first_n": _first_n,
    "first_n_shuffled": _first_n_shuffled,
    "first_n_per_split": _first_n_per_split,
    "shuffle_epoch": _shuffle_epoch,
    "permuted_epoch": _permuted_epoch,
    "permuted_batches": _permuted_batches,
    "chosen_batches": _chosen_batches,
    "batches": _batches,
    "every_k": _every_k,
    "preview_batches": _preview,
    "corpus_sides": _corpus_sides,
    "byte_tokens": _byte_tokens,
    "pair_counts": _pair_counts,
    "top_pair": _top_pair,
    "apply_merge": _apply_merge,
    "bpe_merges_8": _bpe_merges,
    "bpe_merges_244": _bpe_merges_full,
    "bpe_merges_documents_244": _bpe_merges_documents_full,
    "bpe_merges_documents_indexed": _bpe_merges_documents_indexed,
    "bpe_vocabulary": _bpe_vocabulary,
    "bpe_encode": _bpe_encode,
    "bpe_encode_documents": _bpe_encode_documents,
    "bpe_decode": _bpe_decode,
    "bpe_decode_520": _bpe_decode_520,
    "decode_stored": _decode_stored,
    "roundtrip": _roundtrip,
    "token_pairs": _token_pairs,
    "prepare_corpus": _prepare_corpus,
    "prepare_again": _prepare_again,
    "padded_train": _padded_train,
    "padded_eval": _padded_eval,
    "valid_length": _valid_length,
    "length_mask": _length_mask,
    "visible_cells": _visible_cells,
    "non_pad": _non_pad,
    "cut_ends": _cut_ends,
    "epoch_batches": _epoch_batches,
    "alphabet_ml": lambda spark, d: _alphabet_usage(spark, d, "ml"),
    "alphabet_eng": lambda spark, d: _alphabet_usage(spark, d, "eng"),
    "character_vocabulary": _character_vocabulary,
    "vocab_index": _vocab_indexes,
    "document_indexes": _document_indexes,
    "detokenize": _detokenize,
    "token_ce": _token_ce,
    "argmax": _argmax,
    "sharded_scores": _sharded_scores,
    "sharded_batch_loss": _sharded_batch_loss,
    "batch_loss": _batch_loss,
    "epoch_loss": _epoch_loss,
    "validation_report": _validation_report,
    "cut_at_end": _cut_at_end,
    "decode_generated": _decode_generated,
    "metric_rollup": _metric_rollup,
    "metric_rollup_streamed": _streamed_rollup,
    "best_so_far": _best_so_far,
}
