from twintext.functions.tokens import Merge
from twintext.operators.filters import filter_length, filter_valid_utf8
from twintext.operators.splits import random_split_hash
from twintext.plans.examples import encode_pairs
from twintext.sources.tokens import read_token_pairs
from twintext.streaming import encode_stream, stream_pairs, write_token_stream


def test_arriving_files_are_encoded_once(spark, tmp_path):
    source, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    merges = [Merge(97, 97, 256)]

    def arrive(ids):
        rows = [(i, "aaa" * (1 + i % 200), "b") for i in ids]
        spark.createDataFrame(rows, "pair_id long, src string, tgt string").write.mode("append").parquet(source)

    def run():
        stream = encode_stream(stream_pairs(spark, source), merges)
        write_token_stream(stream, sink, marks).awaitTermination()
        return read_token_pairs(spark, sink)

    arrive(range(50))
    assert run().count() == 50
    arrive(range(50, 150))
    tokens = run()
    pairs = filter_length(filter_valid_utf8(spark.read.parquet(source)))
    batch = encode_pairs(random_split_hash(pairs), merges)
    columns = ["pair_id", "split", "src_tokens", "tgt_tokens"]
    assert tokens.count() == 100
    assert sorted(map(tuple, tokens.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))
