import random

import pytest
from pyspark.sql import functions as F

from tests import brute
from twintext.functions.tokens import (
    Merge,
    bpe_decode,
    bpe_encode,
    bpe_encode_native,
    encode_tokens,
    expand_merges,
    merge_sequences,
    to_byte_tokens,
    token_array,
    token_char,
)
from twintext.operators.bpe import (
    apply_merge,
    expand_vocab,
    merges_table,
    most_frequent_pair,
    roundtrip_failures,
    train_bpe,
    vocabulary_bytes,
)
from twintext.operators.merge_order import PairCount, certain_merges
from twintext.operators.corpus import byte_tokens, collapse_equal
from twintext.operators.pair_counts import count_adjacent_pairs, count_pairs_native

TEXTS = ["", "a", "aa", "aaa", "aaaa", "baaaab", "héé é", "അആഇ അആഇ", "nul\0line\nend", "tab\t 😀😀😀"]


def corpus_of(spark, texts):
    rows = [(o, s, t) for (o, s), t in texts.items()]
    return spark.createDataFrame(rows, "ord long, side int, text string")


def random_texts(seed, n, letters, longest):
    rng = random.Random(seed)
    return {
        (o, s): "".join(rng.choice(letters) for _ in range(rng.randrange(longest)))
        for o in range(n)
        for s in (0, 1)
    }


def test_training_golden(spark):
    corpus = corpus_of(spark, {(0, 0): "aaabdaaabac"})
    merges = train_bpe(corpus, 260)
    assert merges == [(97, 97, 256), (256, 97, 257), (257, 98, 258), (258, 100, 259)]
    seq = corpus.select(token_array(encode_tokens(to_byte_tokens(F.col("text")), merges)).alias("ids"))
    assert seq.first()["ids"] == [259, 258, 97, 99]


def test_overlaps_are_counted(spark):
    counted = count_adjacent_pairs(byte_tokens(corpus_of(spark, {(0, 0): "aaabdaaabac"})))
    assert {(r["left"], r["right"]): r["n"] for r in counted.collect()}[(97, 97)] == 4


@pytest.mark.parametrize(
    "text, ids",
    [("", []), ("a", [97]), ("aa", [256]), ("aaa", [256, 97]), ("aaaa", [256, 256]),
     ("baaaab", [98, 256, 256, 98])],
)
@pytest.mark.parametrize("encode", [bpe_encode, bpe_encode_native])
def test_encoding_golden(spark, text, ids, encode):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(encode(F.col("text"), [Merge(97, 97, 256)]).alias("ids")).first()["ids"] == ids


def test_null_text_stays_null(spark):
    df = spark.createDataFrame([(None,), ("aa",)], "text string")
    ids = df.select(bpe_encode(F.col("text"), [Merge(97, 97, 256)]).alias("ids")).collect()
    assert [r["ids"] for r in ids] == [None, [256]]


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abc "), (3, "aé അ"), (4, "abcdefgh")])
def test_training_equals_brute_force(spark, seed, letters):
    texts = random_texts(seed, 12, letters, 30)
    expected, final = brute.train(texts, 40)
    corpus = corpus_of(spark, texts)
    merges = train_bpe(corpus, 256 + 40)
    assert [tuple(m) for m in merges] == expected
    encoded = corpus.select("ord", "side", bpe_encode(F.col("text"), merges).alias("ids")).collect()
    assert {(r["ord"], r["side"]): r["ids"] for r in encoded} == final


def test_training_stops_without_pairs(spark):
    assert train_bpe(corpus_of(spark, {(0, 0): "abab", (1, 0): "x", (2, 0): ""}), 300) == [
        (97, 98, 256),
        (256, 256, 257),
    ]


def test_copies_and_layout_do_not_matter(spark):
    texts = random_texts(7, 10, "abcd ", 25)
    texts.update({(100 + i, 0): texts[(0, 1)] for i in range(30)})
    expected, _ = brute.train(texts, 15)
    corpus = corpus_of(spark, texts)
    for n in (1, 4, 8):
        assert [tuple(m) for m in train_bpe(corpus.repartition(n), 271)] == expected
    assert [tuple(m) for m in train_bpe(corpus, 271, collapse=False, rewrite_share=0.01)] == expected


def test_counts_native_equal_arrow(spark):
    texts = random_texts(5, 40, "abé ", 40)
    texts.update({(200 + i, 0): texts[(3, 0)] for i in range(9)})
    table = brute.pair_table([(o, s, list(t.encode())) for (o, s), t in texts.items()])
    corpus = byte_tokens(collapse_equal(corpus_of(spark, texts)))
    for counted in (count_adjacent_pairs(corpus, with_first=True), count_pairs_native(corpus)):
        found = {(r["left"], r["right"]): (r["n"], tuple(r["first"])) for r in counted.collect()}
        assert found == table
    top = most_frequent_pair(corpus).first()
    assert (top["left"], top["right"]) == brute.leading_pair(
        [(o, s, list(t.encode())) for (o, s), t in texts.items()]
    )


def test_counts_with_large_vocabulary(spark):
    texts = random_texts(6, 20, "abé ", 40)
    corpus = byte_tokens(corpus_of(spark, texts))
    small = count_adjacent_pairs(corpus, with_first=True)
    for size in (5_000, 60_000):
        for first in (True, False):
            large = count_adjacent_pairs(corpus, size, with_first=first)
            assert set(large.collect()) == set(small.select(large.columns).collect())


def test_copies_are_combined_by_hashing(spark):
    plan = collapse_equal(corpus_of(spark, {(0, 0): "a", (0, 1): "a"}))
    assert "SortAggregate" not in plan._jdf.queryExecution().toString()
    assert [tuple(r) for r in plan.collect()] == [(0, 0, 2, "a")]
    later = collapse_equal(corpus_of(spark, {(3, 0): "a", (1, 1): "a", (2, 1): "b"})).collect()
    assert {tuple(r) for r in later} == {(1, 1, 2, "a"), (2, 1, 1, "b")}


def test_first_places_over_many_pieces(spark, monkeypatch):
    import twintext.functions.kernels as kernels

    monkeypatch.setattr(kernels, "_PIECE_BYTES", 64)
    texts = random_texts(11, 60, "abc ", 40)
    table = brute.pair_table([(o, s, list(t.encode())) for (o, s), t in texts.items()])
    corpus = byte_tokens(corpus_of(spark, texts)).repartition(3)
    counted = count_adjacent_pairs(corpus, with_first=True).collect()
    assert {(r["left"], r["right"]): (r["n"], tuple(r["first"])) for r in counted} == table


def test_ids_beyond_the_surrogates(spark):
    token = 0xD800 + 5
    merges = [Merge(97, 98, token), Merge(token, token, token + 1)]
    df = spark.createDataFrame([("xababab",)], "text string")
    seq = df.select(to_byte_tokens(F.col("text")).alias("seq"))
    merged = seq.select(merge_sequences(F.col("seq"), merges, token + 2).alias("seq"))
    assert merged.first()["seq"] == "x" + token_char(token + 1) + token_char(token)
    assert merged.select(token_array(F.col("seq"), token + 2).alias("ids")).first()["ids"] == [
        120, token + 1, token,
    ]


@pytest.mark.parametrize("encode", [bpe_encode, bpe_encode_native])
def test_encoding_equals_brute_force(spark, encode):
    texts = TEXTS + list(random_texts(9, 20, "aabbé ", 40).values())
    merges, _ = brute.train({(i, 0): t for i, t in enumerate(texts)}, 30)
    merges = [Merge(*m) for m in merges]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = df.select("id", encode(F.col("text"), merges).alias("ids")).collect()
    assert {r["id"]: r["ids"] for r in found} == {
        i: brute.encode(t, merges) for i, t in enumerate(texts)
    }


def test_round_trip(spark):
    merges = [Merge(*m) for m in brute.train({(i, 0): t for i, t in enumerate(TEXTS)}, 20)[0]]
    df = spark.createDataFrame([(t,) for t in TEXTS + ["Hello World!"]], "text string")
    assert roundtrip_failures(df, merges).count() == 0


def test_decoding_replaces_malformed_bytes(spark):
    df = spark.createDataFrame([([0xE0, 0xB4, 0x61],), ([],)], "ids array<int>")
    texts = df.select(bpe_decode(F.col("ids"), expand_merges([])).alias("text")).collect()
    assert [r["text"] for r in texts] == [bytes([0xE0, 0xB4, 0x61]).decode(errors="replace"), ""]


@pytest.mark.parametrize("token", [256, 499, 503, -1])
def test_decoding_refuses_unknown_tokens(spark, token):
    df = spark.createDataFrame([([97, token],)], "ids array<int>")
    with pytest.raises(Exception, match="not in vocabulary"):
        df.select(bpe_decode(F.col("ids"), vocabulary_bytes([])).alias("text")).collect()


def test_special_tokens_print_as_names(spark):
    df = spark.createDataFrame([([500, 97, 502, 501],)], "ids array<int>")
    text = df.select(bpe_decode(F.col("ids"), vocabulary_bytes([])).alias("text")).first()["text"]
    assert text == "<START>a<END><PAD>"


def test_apply_merge_keeps_the_tail(spark):
    corpus = byte_tokens(corpus_of(spark, {(0, 0): "aaa", (1, 0): "a"}))
    seqs = apply_merge(corpus, Merge(97, 97, 256)).orderBy("ord").collect()
    assert [r["seq"] for r in seqs] == [chr(256) + "a", "a"]


def test_tables(spark):
    merges = [Merge(97, 98, 256), Merge(256, 99, 257)]
    assert [tuple(r) for r in merges_table(spark, merges).collect()] == [(0, 97, 98, 256), (1, 256, 99, 257)]
    vocabulary = {r["token"]: (bytes(r["bytes"]), r["is_special"]) for r in expand_vocab(spark, merges, True).collect()}
    assert len(vocabulary) == 258 + 3
    assert vocabulary[257] == (b"abc", False)
    assert vocabulary[501] == (b"<PAD>", True)


def test_certain_merges_rules():
    def taken(pairs, ordered=True, complete=True, limit=10):
        batch, _ = certain_merges([PairCount(*p) for p in pairs], limit, 256, ordered, complete)
        return [(p.left, p.right) for p in batch]

    # Disjoint pairs go together; sharing a right or a left token is allowed.
    assert taken([(1, 2, 9), (3, 4, 8), (1, 5, 7), (6, 2, 6)]) == [(1, 2), (3, 4), (1, 5), (6, 2)]
    # A pair that begins where another ends waits, and so does all behind it.
    assert taken([(1, 2, 9), (2, 3, 8), (5, 6, 7)]) == [(1, 2)]
    assert taken([(1, 2, 9), (3, 1, 8)]) == [(1, 2)]
    # A pair of equal tokens closes the run.
    assert taken([(1, 2, 9), (3, 3, 8), (5, 6, 7)]) == [(1, 2), (3, 3)]
    # Ties need the order of first places.
    assert taken([(1, 2, 9), (3, 4, 8), (5, 6, 8)], ordered=False) == [(1, 2)]
    assert taken([(1, 2, 9), (3, 4, 8)], ordered=False, complete=False) == [(1, 2)]
    assert taken([(1, 2, 9), (3, 4, 9)], ordered=False) == []
    assert taken([(1, 2, 9), (3, 4, 8)], limit=1) == [(1, 2)]


def test_special_ids_follow_the_vocabulary(spark):
    from twintext.params import PrepParams

    merges = [Merge(97, 98, 256 + k) for k in range(300)]
    with pytest.raises(ValueError, match="learned"):
        vocabulary_bytes(merges)
    table = vocabulary_bytes(merges, vocab_size=600)
    params = PrepParams(vocab_size=600)
    assert [table[i] for i in (params.start_id, params.pad_id, params.end_id)] == [b"<START>", b"<PAD>", b"<END>"]
    assert PrepParams().cap("train") is None
