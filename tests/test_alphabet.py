import random

import pytest
from pyspark.sql import functions as F

from twintext.operators.alphabet import (
    add_distinct_ordered,
    alphabet,
    alphabet_table,
    character_vocabulary,
    detokenize,
    index_characters,
    vocab_index,
)


def test_alphabets():
    english, malayalam = alphabet("eng"), alphabet("ml")
    assert english[:4] == malayalam[:4] == ["<START>", "<END>", "<PAD>", "<UNK>"]
    assert len(english) == 4 + 94 and len(malayalam) == 4 + 118
    assert english[4:] == [chr(c) for c in range(32, 127) if chr(c) != ";"]
    assert len(set(malayalam)) == len(malayalam) and ";" not in malayalam


@pytest.mark.parametrize("args", [("fr",), ("eng", "word"), ("ml", "syllable")])
def test_unknown_vocabularies_are_refused(args):
    with pytest.raises(ValueError):
        alphabet(*args)


@pytest.mark.parametrize("language, text", [("eng", "Hello, World! ~"), ("ml", "അആ കൊ‍ 12")])
def test_indexes_and_back(spark, language, text):
    to_token, to_index = vocab_index(alphabet_table(spark, language))
    df = spark.createDataFrame([(text,), ("",), ("a;é",)], "text string")
    out = df.select(
        "text", index_characters(F.col("text"), to_index).alias("ids")
    ).withColumn("back", detokenize(F.col("ids"), to_token)).collect()
    assert out[0]["ids"] == [to_index[c] for c in text]
    assert out[0]["back"] == text
    assert out[1]["ids"] == [] and out[1]["back"] == ""
    assert out[2]["ids"][1:] == [3, 3]


def test_detokenize_refuses_unknown_indexes(spark):
    to_token, _ = vocab_index(alphabet_table(spark, "eng"))
    df = spark.createDataFrame([([4, 98],)], "ids array<int>")
    with pytest.raises(Exception, match="not in vocabulary"):
        df.select(detokenize(F.col("ids"), to_token).alias("t")).collect()


def test_first_place_wins(spark):
    tokens = spark.createDataFrame([(5, "b"), (2, "a"), (9, "a"), (1, "b")], "ord long, token string")
    assert {tuple(r) for r in add_distinct_ordered(tokens).collect()} == {("b", 1), ("a", 2)}


def test_character_vocabulary(spark):
    texts = [(2, "xéb"), (1, "abca"), (3, "")]
    rows = character_vocabulary(spark.createDataFrame(texts, "id long, text string"), "id").collect()
    assert {r["idx"]: r["token"] for r in rows} == dict(enumerate("abcxé"))


def test_a_character_far_up_is_indexed_quickly(spark):
    import time

    to_index = {"a": 0, "\U0001f600": 1, "<UNK>": 2}
    started = time.time()
    column = index_characters(F.col("text"), to_index)
    assert time.time() - started < 1
    df = spark.createDataFrame([("a\U0001f600b\u0d05",)], "text string")
    assert df.select(column.alias("ids")).first()["ids"] == [0, 1, 2, 2]


def test_gathering_costs_the_same_for_any_vocabulary(spark):
    """50,000 tokens, null and empty lists, tokens without bytes, and many pieces."""
    import pyarrow as pa

    from twintext.functions import kernels

    table = {i: chr(0x4E00 + i % 20000).encode() * (i % 4) for i in range(50_000)}
    rng = random.Random(2)
    rows = [[rng.randrange(50_000) for _ in range(rng.randrange(400))] for _ in range(3000)] + [[], None, [0, 4, 8]]
    lists = pa.array(rows, pa.list_(pa.int32()))
    for part in (lists, lists.slice(7, 2000), lists.slice(2999), lists.slice(0, 0)):
        found = kernels.gatherer(table, "token")(part).to_pylist()
        assert found == [None if r is None else b"".join(table[i] for i in r) for r in part.to_pylist()]
    for bad in ([50_000], [-1], [None]):
        with pytest.raises(ValueError, match="not in vocabulary"):
            kernels.gatherer(table, "token")(pa.array([[1], bad], pa.list_(pa.int32())))


def test_indexing_of_odd_texts():
    import pyarrow as pa

    from twintext.functions import kernels

    run = kernels.character_indexer({ord(c): k for k, c in enumerate("aé日😀")}, -1)
    texts = ["", None, "aé日😀z", "\U0010ffffa", "a" * 3_000_000, ""]
    known = {c: k for k, c in enumerate("aé日😀")}
    whole = pa.array(texts)
    for part in (whole, whole.slice(2), whole.slice(1, 1)):
        assert run(part).to_pylist() == [None if t is None else [known.get(c, -1) for c in t] for t in part.to_pylist()]
    odd = pa.array([b"a\xffa", b"a"], pa.binary())
    assert run(odd).to_pylist() == [[0, -1, 0], [0]]
    assert kernels.character_indexer({}, 7)(pa.array(["xy"])).to_pylist() == [[7, 7]]
