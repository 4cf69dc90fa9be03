import os

import pytest
from pyspark.sql import functions as F

from tests import brute
from twintext.functions.tokens import Merge
from twintext.params import PrepParams
from twintext.plans.examples import build_token_pairs, epoch_batches, token_pairs_once
from twintext.plans.prepare import prepare_corpus
from twintext.sources import storage
from twintext.sources.pairs import read_pairs, read_split, write_splits
from twintext.sources.storage import (
    Snapshots,
    data_path,
    ensure_directory,
    fingerprint,
    is_published,
    join_path,
    materialize_once,
    shared_directory,
)
from twintext.sources.tokens import read_token_pairs, write_token_pairs
from twintext.sources.vocabulary import read_merges, read_vocabulary, write_merges

SCHEMA = "pair_id long, src string, tgt string"


def some_pairs(spark, n=40):
    rows = [(i, f"the cat {i % 7} sat", f"അആ {i % 5} ഇഈ") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_read_pairs(spark, tmp_path, format):
    path = str(tmp_path / format)
    some_pairs(spark).write.format(format).save(path)
    assert set(read_pairs(spark, path, format).collect()) == set(some_pairs(spark).collect())


def test_read_pairs_maps_columns_and_options(spark, tmp_path):
    path = str(tmp_path / "tsv")
    some_pairs(spark).write.option("sep", "\t").option("header", True).csv(path)
    columns = {"pair_id": "idx", "src": "en", "tgt": "ml"}
    read = read_pairs(spark, path, "csv", "idx long, en string, ml string", columns, sep="\t", header="true")
    assert set(read.collect()) == set(some_pairs(spark).collect())
    with pytest.raises(ValueError, match="format"):
        read_pairs(spark, path, "pickle")


def test_paths_keep_their_scheme():
    assert join_path("gs://bucket/dir/", "a", "/b") == "gs://bucket/dir/a/b"
    assert join_path("/local", "a") == "/local/a"


def test_ensure_directory_makes_parents(spark, tmp_path):
    path = ensure_directory(spark, str(tmp_path / "a" / "b"))
    assert os.path.isdir(path)
    assert os.path.isdir(ensure_directory(spark, (tmp_path / "c").as_uri()).removeprefix("file://"))


def test_materialize_once(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert materialize_once(spark, path, build).count() == 3
    assert materialize_once(spark, path, build).count() == 3
    assert len(built) == 1 and is_published(spark, path)
    with pytest.raises(ValueError, match="other parameters"):
        materialize_once(spark, path, build, made_with={"seed": 2})
    with pytest.raises(ValueError, match="other rows"):
        materialize_once(spark, path, build, made_from=fingerprint(spark.range(4)))


def test_a_run_that_stops_before_the_manifest_leaves_no_table(spark, tmp_path, monkeypatch):
    path, made_with = str(tmp_path / "t"), {"seed": 1}

    def stopped(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(storage, "_publish", stopped)
        with pytest.raises(KeyboardInterrupt):
            materialize_once(spark, path, lambda: spark.range(5), made_with=made_with)
    assert os.listdir(path) and not is_published(spark, path)
    # Another seed neither meets the remains nor is mixed with them.
    assert materialize_once(spark, path, lambda: spark.range(3), made_with={"seed": 2}).count() == 3


def test_of_two_writers_one_publishes(spark, tmp_path):
    path, made_with = str(tmp_path / "t"), {"seed": 1}

    def slow():
        # The other writer is done while this one still builds.
        assert materialize_once(spark, path, lambda: spark.range(3), made_with=made_with).count() == 3
        return spark.range(3)

    assert materialize_once(spark, path, slow, made_with=made_with).count() == 3
    assert len([f for f in os.listdir(path) if f.startswith("data-")]) == 1
    assert not [f for f in os.listdir(path) if f.startswith("_")]

    def other():
        materialize_once(spark, str(tmp_path / "u"), lambda: spark.range(3), made_with={"seed": 2})
        return spark.range(3)

    with pytest.raises(ValueError, match="other parameters"):
        materialize_once(spark, str(tmp_path / "u"), other, made_with=made_with)


def test_the_manifest_names_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    materialize_once(spark, path, lambda: spark.range(30).repartition(3))
    data = data_path(spark, path)
    spark.range(5).write.mode("append").parquet(data)
    with pytest.raises(ValueError, match="manifest"):
        data_path(spark, path)


def test_fingerprints_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(k, "x" * (k % 7)) for k in range(100)], "id long, t string")
    same = [fingerprint(d) for d in (df, df.orderBy(F.desc("id")), df.repartition(5))]
    assert same[0] == same[1] == same[2]
    others = [df.where("id > 0"), df.union(df.limit(1)), df.withColumn("t", F.lit("x")), df.where("false"), df.select("id")]
    marks = [str(fingerprint(d)) for d in (df, *others)]
    assert len(set(marks)) == len(marks)


def test_snapshots_keep_the_latest(spark):
    snapshots = Snapshots(spark)
    first = snapshots.write(spark.range(5))
    second = snapshots.write(first.where("id > 1"))
    assert second.count() == 3
    snapshots.close()
    assert shared_directory(spark) == shared_directory(spark)


def test_shared_directory_comes_from_the_session(spark):
    assert shared_directory(spark) == spark.conf.get("spark.checkpoint.dir")


class _Session:
    """Just enough of a session to ask where intermediate tables go."""

    def __init__(self, master, checkpoint_dir=None):
        self.conf = {}
        self.master, self.directory = master, checkpoint_dir
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.directory

    def setCheckpointDir(self, path):
        self.directory = path


def test_a_cluster_has_to_name_the_shared_directory():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_directory(_Session("yarn"))
    assert shared_directory(_Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_directory(_Session("local[2]"))


def test_read_split_reads_one_directory(spark, tmp_path):
    path = str(tmp_path / "splits")
    labelled = some_pairs(spark).withColumn("split", F.expr("elt(1 + pair_id % 3, 'train', 'val', 'test')"))
    write_splits(labelled, path)
    val = read_split(spark, path, "val")
    assert {r["pair_id"] for r in val.collect()} == {i for i in range(40) if i % 3 == 1}
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="split"):
        read_split(spark, path, "dev")


def test_vocabulary_round_trip(spark, tmp_path):
    path, merges = str(tmp_path / "bpe"), [Merge(97, 98, 256), Merge(256, 99, 257)]
    write_merges(spark, path, merges)
    assert read_merges(spark, path) == merges
    assert read_vocabulary(spark, path).count() == 258 + 3
    assert read_vocabulary(spark, path, special=False).where("is_special").count() == 0


def test_preparation_end_to_end(spark, tmp_path):
    directory, params = str(tmp_path / "run"), PrepParams(vocab_size=270, max_train_size=12)
    bad = spark.createDataFrame([(900, bytearray(b"\xff"), bytearray(b"x"))], "pair_id long, src binary, tgt binary")
    pairs = some_pairs(spark).union(bad.select("pair_id", F.col("src").cast("string"), F.col("tgt").cast("string")))
    prepared = prepare_corpus(spark, pairs, directory, params)
    assert prepared.splits.count() == 40
    train = prepared.splits.where("split = 'train'").collect()
    texts = {(r["pair_id"], s): r[c] for r in train for s, c in enumerate(("src", "tgt"))}
    assert [tuple(m) for m in prepared.merges] == brute.train(texts, 14)[0]

    with pytest.raises(ValueError, match="other parameters"):
        prepare_corpus(spark, pairs, directory, PrepParams(vocab_size=280))
    with pytest.raises(ValueError, match="other rows"):
        prepare_corpus(spark, some_pairs(spark, 3), directory, params)
    again = prepare_corpus(spark, pairs.repartition(3), directory, params)
    assert again.merges == prepared.merges
    assert again.splits.count() == 40

    path = str(tmp_path / "tokens")
    stored = token_pairs_once(spark, path, prepared.splits, prepared.merges, params)
    reread = token_pairs_once(spark, path, again.splits, prepared.merges, params)
    with pytest.raises(ValueError, match="other rows"):
        token_pairs_once(spark, path, prepared.splits.limit(0), prepared.merges, params)
    assert stored.count() == reread.count()
    by_id = {r["pair_id"]: r for r in stored.collect()}
    assert sum(r["split"] == "train" for r in by_id.values()) == 12
    for row in train:
        if row["pair_id"] in by_id:
            assert by_id[row["pair_id"]]["src_tokens"] == brute.encode(row["src"], prepared.merges)
            assert by_id[row["pair_id"]]["tgt_tokens"] == brute.encode(row["tgt"], prepared.merges)

    small = PrepParams(batch_size=4)
    batches = epoch_batches(stored.where("split = 'train'"), 0, small, training=True).collect()
    assert len(batches) == 12 and {r["batch_id"] for r in batches} == {0, 1, 2}
    assert all(len(r["src"]) == len(r["tgt"]) == len(r["label"]) == 300 for r in batches)


def test_token_pairs_round_trip(spark, tmp_path):
    path = str(tmp_path / "tp")
    rows = [(1, [1, 2], [3], "train"), (2, [], [4], "val")]
    pairs = spark.createDataFrame(rows, "pair_id long, src_tokens array<int>, tgt_tokens array<int>, split string")
    write_token_pairs(pairs, path)
    assert {r["pair_id"]: tuple(r)[1:] for r in read_token_pairs(spark, path).collect()} == {
        1: ([1, 2], [3], "train"), 2: ([], [4], "val"),
    }


def test_long_pairs_are_dropped_before_encoding(spark):
    pairs = spark.createDataFrame(
        [(1, "ab", "c" * 299, "train"), (2, "ab", "c" * 300, "train"), (3, "a" * 301, "c", "val")],
        SCHEMA + ", split string",
    )
    built = build_token_pairs(pairs, [Merge(99, 99, 256)])
    assert [r["pair_id"] for r in built.collect()] == [1]
