"""Epoch orders by arithmetic: bijections, batches and what is read for them."""

import re

import pytest
from pyspark.sql import functions as F

from twintext.operators import permutation
from twintext.operators.permutation import Permutation, permuted_batches, permuted_epoch, read_batches, store_positions
from twintext.params import PrepParams


@pytest.mark.parametrize("total", [1, 2, 3, 5, 63, 64, 65, 100, 1000, 1021, 4097])
def test_bijection_of_any_size(spark, total):
    for seed, epoch in ((1, 0), (1, 1), (9, 0)):
        p = Permutation(total, seed, epoch)
        placed = spark.range(total).select("id", p.forward(F.col("id")).alias("place")).collect()
        assert sorted(r["place"] for r in placed) == list(range(total))
        assert p.backward([r["place"] for r in placed]) == [r["id"] for r in placed]


def test_epochs_and_seeds_differ_and_spread():
    orders = [Permutation(5000, s, e).backward(range(5000)) for s, e in ((1, 0), (1, 1), (2, 0))]
    for k, order in enumerate(orders):
        assert sum(i == x for i, x in enumerate(order)) < 20
        assert sum(abs(x - y) == 1 for x, y in zip(order, order[1:])) < 20
        # Rows of each tenth of the table lie in all tenths of the epoch alike.
        for tenth in range(10):
            share = sum(x // 500 == tenth for x in order[:500])
            assert 25 <= share <= 80
        assert all(order != other for other in orders[:k])


def test_steps_are_few_and_too_few_are_an_error(spark, monkeypatch):
    assert Permutation(10**12, 1, 0).steps <= 10 and Permutation(10**6 + 1, 1, 0).steps <= 20
    monkeypatch.setattr(Permutation, "steps", 1)
    p = Permutation(5, 1, 0)  # a grid of six cells
    with pytest.raises(Exception, match="too long"):
        for seed in range(20):
            spark.range(5).select(Permutation(5, seed, 0).forward(F.col("id")).alias("x")).collect()
    assert p.shape == (3, 2)


def test_large_positions_stay_exact(spark):
    p = Permutation(3 * 10**12 + 7, 4, 2)
    rows = [0, 1, 10**12, p.total - 1]
    placed = spark.createDataFrame([(x,) for x in rows], "id long").select("id", p.forward(F.col("id")).alias("x")).collect()
    assert p.backward([r["x"] for r in placed]) == [r["id"] for r in placed] == rows
    with pytest.raises(ValueError):
        Permutation(1 << 62, 1, 0)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "rows")
    df = spark.range(1000).select((F.col("id") * 7 + 3).alias("pair_id"), F.lit("x").alias("src"))
    assert store_positions(df, path, rows_per_part=50) == 1000
    return spark.read.parquet(path)


def test_positions_have_no_gaps(stored):
    rows = stored.select("position", "part", "pair_id").collect()
    assert sorted(r["position"] for r in rows) == list(range(1000))
    assert all(r["part"] == r["position"] // 50 for r in rows) and len({r["pair_id"] for r in rows}) == 1000


def test_epochs_do_not_shuffle(stored):
    for df in (permuted_epoch(stored, 1000, 3), permuted_batches(stored, 1000, 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_batches_are_whole(stored):
    params = PrepParams(batch_size=64)
    rows = permuted_batches(stored, 1000, 2, params).collect()
    assert len(rows) == 960
    assert {(r["batch_id"], r["slot"]) for r in rows} == {(b, s) for b in range(15) for s in range(64)}


def test_a_batch_reads_its_own_parts(stored):
    params = PrepParams(batch_size=8)
    every = {(r["batch_id"], r["slot"]): r["pair_id"] for r in permuted_batches(stored, 1000, 2, params).collect()}
    df = read_batches(stored, 1000, [3, 7, 10**9], 2, params, rows_per_part=50)
    found = {(r["batch_id"], r["slot"]): r["pair_id"] for r in df.collect()}
    assert found == {k: v for k, v in every.items() if k[0] in (3, 7)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[part#\d+ IN", plan)
    one = read_batches(stored, 1000, [3], 2, params, rows_per_part=50)
    assert one.select(F.input_file_name()).distinct().count() <= 8
    assert read_batches(stored, 1000, [], 2, params, rows_per_part=50).count() == 0


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.createDataFrame([], "pair_id long, src string")
    assert store_positions(df, path) == 0
    assert permutation.permuted_epoch(spark.range(0).withColumnRenamed("id", "position"), 0, 1).count() == 0
