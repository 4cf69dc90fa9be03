import random

import pytest
from pyspark.sql import functions as F

from twintext.functions.text import valid_utf8
from twintext.operators.corpus import unpivot_corpus
from twintext.operators.filters import (
    drop_features,
    filter_length,
    filter_valid_utf8,
    length_report,
    validity_report,
)
from twintext.sources.pairs import turn_pairs

VALID = ["6F6B", "", "E0B485", "F09F9880"]
INVALID = ["EDA080", "E0B4", "C080", "E08080", "F4908080", "FFFE"]


def binary_pairs(spark):
    rows = [(i, bytearray.fromhex(h), bytearray(b"x")) for i, h in enumerate(VALID + INVALID)]
    rows += [(100, bytearray(b"x"), bytearray.fromhex("FFFE")), (101, None, bytearray(b"x")), (102, bytearray(b"x"), None)]
    return spark.createDataFrame(rows, "pair_id long, src binary, tgt binary")


def test_utf8_validity(spark):
    for hexed, expected in [(h, True) for h in VALID] + [(h, False) for h in INVALID]:
        df = spark.createDataFrame([(bytearray.fromhex(hexed),)], "b binary")
        assert df.select(valid_utf8(F.col("b")).alias("v")).first()["v"] is expected, hexed


def test_both_sides_have_to_be_valid(spark):
    assert [r[0] for r in filter_valid_utf8(binary_pairs(spark)).select("pair_id").collect()] == [0, 1, 2, 3]
    report = validity_report(binary_pairs(spark)).first()
    assert (report["invalid"], report["total"]) == (9, 13)


def test_malformed_bytes_survive_parquet(spark, tmp_path):
    path = str(tmp_path / "raw")
    binary_pairs(spark).write.parquet(path)
    stored = spark.read.schema("pair_id long, src string, tgt string").parquet(path)
    assert filter_valid_utf8(stored).count() == 4


def test_length_is_in_code_points(spark):
    rows = [(1, "അആഇഈഉ", "abcd"), (2, "അആഇഈഉ", "abcde"), (3, "abcdef", "a"), (4, None, "a")]
    pairs = spark.createDataFrame(rows, "pair_id long, src string, tgt string")
    assert [r["pair_id"] for r in filter_length(pairs, 5).collect()] == [1]
    assert [r["pair_id"] for r in filter_length(pairs, 5, 5).collect()] == [1, 2]
    report = length_report(pairs, 5).first()
    assert (report["exceeded"], report["total"]) == (3, 4)


def test_length_in_tokens(spark):
    rows = [(1, [1, 2, 3], [1, 2]), (2, [1, 2, 3], [1, 2, 3]), (3, None, [1])]
    pairs = spark.createDataFrame(rows, "pair_id long, src array<int>, tgt array<int>")
    assert [r["pair_id"] for r in filter_length(pairs, 3, unit="tokens").collect()] == [1]
    with pytest.raises(ValueError, match="unit"):
        filter_length(pairs, 3, unit="words")


def test_corpus_has_both_sides(spark):
    pairs = spark.createDataFrame([(7, "s", "t")], "pair_id long, src string, tgt string")
    assert [tuple(r) for r in unpivot_corpus(pairs).collect()] == [(7, 0, "s"), (7, 1, "t")]


def test_drop_features_prunes_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", 2)], "id long, idx string, n long").write.parquet(path)
    dropped = drop_features(spark.read.parquet(path), "idx")
    assert dropped.columns == ["id", "n"]
    assert "ReadSchema: struct<id:bigint,n:bigint>" in dropped._jdf.queryExecution().toString()


def test_turn_pairs(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"),
        (2, 0, "user", "q3"), (2, 1, "user", "q4"), (2, 2, "assistant", "a4"), (3, 0, "assistant", "a"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(tuple(r) for r in turn_pairs(turns).collect()) == [(1001, "q1", "a1"), (2001, "q4", "a4")]


def test_turn_pairs_with_gaps_and_many_turns(spark):
    rows = [
        (1, 0, "user", "q"), (1, 5, "assistant", "a"), (1, 9, "user", "q"), (1, 1000, "user", "q2"),
        (1, 1001, "assistant", "a2"), (2, 0, "user", "q3"), (2, 7, "assistant", "a3"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = sorted(tuple(r) for r in turn_pairs(turns).collect())
    assert found == [(10000, "q", "a"), (11000, "q2", "a2"), (20000, "q3", "a3")]


def next_turns(rows):
    """Pairs by sorting whole conversations."""
    rows = sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[0], r[1], r[2] or "", r[3] or ""))
    return sorted(
        (a[0], a[1], a[3], b[3])
        for a, b in zip(rows, rows[1:])
        if a[0] == b[0] and a[2] == "user" and b[2] == "assistant"
    )


def test_turn_pairs_across_ranges(spark):
    """A conversation with a third of all rows, gaps of many ranges, and rows without an id or a turn."""
    rnd = random.Random(3)
    rows = [(7, t, rnd.choice(["user", "assistant"]), f"t{t}") for t in range(0, 3000)]
    rows += [(c, t, rnd.choice(["user", "assistant", "system"]), f"{c}-{t}") for c in range(20, 60)
             for t in sorted(rnd.sample(range(9000), 100))]
    rows += [(1, 255, "user", "q"), (1, 256, "assistant", "a"), (2, 5, "user", "q"), (2, 9999, "assistant", "a")]
    rows += [(3, 100, "user", "q"), (3, 100, "user", "q"), (3, 900, "assistant", "a"), (3, 901, "assistant", "b")]
    rows += [(None, 1, "user", "x"), (None, 2, "assistant", "y"), (4, None, "user", "x"), (4, 0, "assistant", "y"), (5, 1, "user", None), (5, 700, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = turn_pairs(df).select(
        F.expr("pair_id div 10000").alias("c"), F.expr("pair_id % 10000").alias("t"), "src", "tgt"
    )
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(next_turns(rows), key=key)
    assert turn_pairs(df.where("false")).count() == 0


def test_negative_turns_are_refused(spark):
    turns = spark.createDataFrame([(1, -1, "user", "q")], "conv_id long, turn long, role string, text string")
    with pytest.raises(ValueError, match="negative"):
        turn_pairs(turns)
