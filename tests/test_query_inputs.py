"""What the registered queries feed to their operators."""

import random

import pytest
from pyspark.sql import functions as F

from checks import queries
from tests import brute

TEXTS = {0: "plain", 1: "é fault", 2: "é fault ü end", 3: "é fault", 6: "only ascii"}


@pytest.fixture
def sf_dir(spark, tmp_path):
    rows = [(i, text, "en") for i, text in TEXTS.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_roundtrip_tries_every_whole_document(spark, sf_dir, monkeypatch):
    seen = []

    def keep(df, merges):
        seen.extend(bytes(r["data"]) for r in df.where("text IS NOT NULL").select(F.col("text").cast("binary").alias("data")).collect())
        return df

    monkeypatch.setattr(queries, "pair_merges", lambda spark, d: [])
    monkeypatch.setattr(queries, "roundtrip_failures", keep)
    rows = queries._roundtrip(spark, sf_dir).first()["n_failed"]
    assert rows == 2 * len(TEXTS)
    assert {text.encode() for text in TEXTS.values()} <= set(seen)
    assert "é fault ü".encode()[:-1] in seen  # cut inside the last character of several bytes


def test_roundtrip_counts_a_fault_behind_any_place(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(queries, "pair_merges", lambda spark, d: [])
    monkeypatch.setattr(queries, "roundtrip_failures", lambda df, merges: df.where(F.col("text").contains("fault")))
    # Three whole texts, and the copies of 1 and 2.
    assert queries._roundtrip(spark, sf_dir).first()["n_failed"] == 5


def test_documents_train_all_merges(spark, tmp_path):
    rnd = random.Random(4)
    texts = {i: "".join(rnd.choice("abcdeé ") for _ in range(250)) for i in range(4)}
    rows = [(i, text) for i, text in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["bpe_merges_documents_244"](spark, str(tmp_path)).orderBy("rank").collect()
    expected, _ = brute.train({(i, 0): text for i, text in texts.items()}, 244)
    assert len(expected) == 244
    assert [(r["left"], r["right"], r["token"]) for r in found] == expected
