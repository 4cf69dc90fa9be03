import hashlib
import math

import pytest
from pyspark.sql import functions as F

from twintext.functions.text import numeric_key, numeric_key_value, order_key
from twintext.operators import order
from twintext.operators.batches import assign_batches, first_batches, preview_batches, sample_every_k, shuffle_epoch
from twintext.operators.order import keys_at_ranks, with_ordinal
from twintext.operators.splits import (
    random_split_exact,
    random_split_hash,
    split_sizes,
    take_first_n,
    take_first_n_per_split,
)
from twintext.params import PrepParams


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "pair_id long")


def md5_order(values, salt):
    return sorted(values, key=lambda v: hashlib.md5(f"{salt}:{v}".encode()).hexdigest())


def test_split_sizes():
    assert split_sizes(10) == {"train": 5, "val": 2, "test": 3}
    for n in range(50):
        sizes = split_sizes(n)
        held = math.ceil(n * 0.5)
        assert sizes == {"train": n - held, "val": held - math.ceil(held / 2), "test": math.ceil(held / 2)}
    assert split_sizes(10, PrepParams(train_ratio=0.8, val_ratio=0.1, test_ratio=0.1)) == {
        "train": 8, "val": 1, "test": 1,
    }


@pytest.mark.parametrize("n", [0, 1, 2, 10, 131])
def test_exact_split_is_a_partition(spark, n):
    values = list(range(1000, 1000 + n))
    rows = random_split_exact(ids(spark, values)).collect()
    ordered, sizes = md5_order(values, 1), split_sizes(n)
    assert sorted(r["pair_id"] for r in rows) == values
    by_split = {s: {r["pair_id"] for r in rows if r["split"] == s} for s in sizes}
    assert by_split["test"] == set(ordered[: sizes["test"]])
    assert by_split["val"] == set(ordered[sizes["test"] : sizes["test"] + sizes["val"]])
    assert len(by_split["train"]) == sizes["train"]


def test_split_does_not_depend_on_the_layout(spark):
    df = ids(spark, range(300))
    expected = set(random_split_exact(df.repartition(1)).collect())
    for n in (4, 8):
        assert set(random_split_exact(df.repartition(n)).collect()) == expected


def test_hash_split_is_stable_and_near_its_shares(spark):
    few = {r["pair_id"]: r["split"] for r in random_split_hash(ids(spark, range(1000))).collect()}
    many = {r["pair_id"]: r["split"] for r in random_split_hash(ids(spark, range(20000))).collect()}
    assert all(many[i] == s for i, s in few.items())
    shares = {s: sum(v == s for v in many.values()) / 20000 for s in ("train", "val", "test")}
    assert abs(shares["train"] - 0.5) < 0.02
    assert abs(shares["val"] - 0.25) < 0.02


@pytest.mark.parametrize("finish", [1, 5, 100_000])
def test_keys_at_ranks_refines_to_the_exact_row(spark, monkeypatch, finish):
    monkeypatch.setattr(order, "_DIGITS", 1)
    monkeypatch.setattr(order, "_FINISH", finish)
    values = list(range(400))
    keys = sorted(hashlib.md5(f"1:{v}".encode()).hexdigest() for v in values)
    total, found = keys_at_ranks(
        ids(spark, values), order_key(F.col("pair_id"), 1), lambda n: [0, 1, 57, 58, 399, 400, 999]
    )
    assert total == 400
    assert found == [None, keys[0], keys[56], keys[57], keys[398], keys[399], keys[399]]


def test_equal_keys_cannot_be_cut(spark, monkeypatch):
    monkeypatch.setattr(order, "_FINISH", 10)
    df = ids(spark, [7] * 50 + list(range(100, 150)))
    key = order_key(F.col("pair_id"), 1)
    place = md5_order([7, *range(100, 150)], 1).index(7)
    assert keys_at_ranks(df, key, lambda n: [place + 50])[1] == [hashlib.md5(b"1:7").hexdigest()]
    with pytest.raises(ValueError, match="not unique"):
        keys_at_ranks(df, key, lambda n: [place + 20])


@pytest.mark.parametrize(
    "values",
    [
        list(range(100)),
        [-5, -4, 0, 3, 10**15, 10**15 + 1, -(10**12)],
        [-(2**63), -1, 0, 5, 2**63 - 1],
        [2**62 + i for i in range(40)],
        [3],
    ],
)
def test_first_n_by_id(spark, monkeypatch, values):
    monkeypatch.setattr(order, "_FINISH", 2)
    df = ids(spark, values)
    for n in (0, 1, 4, len(values), len(values) + 5):
        taken = sorted(r["pair_id"] for r in take_first_n(df, n).collect())
        assert taken == sorted(values)[:n]


def test_first_n_of_nothing(spark):
    assert take_first_n(ids(spark, []), 5).count() == 0


def test_first_n_by_id_is_a_range_filter(spark, tmp_path):
    path = str(tmp_path / "ids")
    ids(spark, range(1000)).write.parquet(path)
    plan = take_first_n(spark.read.parquet(path), 10)._jdf.queryExecution().toString()
    assert "LessThanOrEqual(pair_id,9)" in plan
    assert "Exchange" not in plan


def test_numeric_keys_sort_like_numbers(spark):
    values = [-(2**63), -7, 0, 9, 10, 2**63 - 1]
    for some in (values, values[1:5]):
        low, high = some[0], some[-1]
        rows = ids(spark, some).select("pair_id", numeric_key(F.col("pair_id"), low, high).alias("k")).collect()
        assert [r["pair_id"] for r in sorted(rows, key=lambda r: r["k"])] == some
        assert all(numeric_key_value(r["k"], low, high) == r["pair_id"] for r in rows)


def test_first_n_per_split(spark):
    params = PrepParams(max_train_size=20, max_val_size=7, max_test_size=1000)
    split = random_split_exact(ids(spark, range(101)))
    kept = take_first_n_per_split(split, params=params).collect()
    counts = {s: sum(r["split"] == s for r in kept) for s in ("train", "val", "test")}
    assert counts == {"train": 20, "val": 7, "test": 26}
    train = md5_order([r["pair_id"] for r in split.collect() if r["split"] == "train"], 1)
    assert {r["pair_id"] for r in kept if r["split"] == "train"} == set(train[:20])


def test_ordinals_are_dense_and_in_key_order(spark):
    values = list(range(500))
    for n in (1, 8):
        rows = with_ordinal(
            ids(spark, values).repartition(n), order_key(F.col("pair_id"), 1), total="total"
        ).collect()
        assert [r["pair_id"] for r in sorted(rows, key=lambda r: r["ordinal"])] == md5_order(values, 1)
        assert sorted(r["ordinal"] for r in rows) == values
        assert {r["total"] for r in rows} == {500}


def test_batches_drop_the_short_rest(spark):
    rows = assign_batches(ids(spark, range(130))).collect()
    ordered = md5_order(range(130), "1:0")
    assert {r["pair_id"]: (r["batch_id"], r["slot"]) for r in rows} == {
        v: (i // 64, i % 64) for i, v in enumerate(ordered[:128])
    }
    assert assign_batches(ids(spark, range(63))).count() == 0


def test_epochs_have_different_orders(spark):
    df = ids(spark, range(200))
    one, two = (
        {r["pair_id"]: r["ordinal"] for r in shuffle_epoch(df, e).collect()} for e in (1, 2)
    )
    assert one != two
    assert sorted(one.values()) == sorted(two.values()) == list(range(200))


def test_samples_of_batches(spark):
    batches = spark.createDataFrame([(i,) for i in range(12)], "batch_id long")
    assert [r[0] for r in sample_every_k(batches, 5).collect()] == [0, 5, 10]
    assert [r[0] for r in preview_batches(batches, 3).collect()] == [0, 1, 2, 3]


@pytest.mark.parametrize("rows, shown", [(1000, 3), (200, 3), (130, 2), (10, 0)])
def test_first_batches_equal_the_whole_order(spark, rows, shown):
    df = ids(spark, range(rows))
    whole = {tuple(r) for r in preview_batches(assign_batches(df, 1), 2).collect()}
    assert {tuple(r) for r in first_batches(df, 2, 1).collect()} == whole
    assert len({r[1] for r in whole}) == shown
