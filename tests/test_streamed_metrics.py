import pytest

from twintext.operators.evaluate import metric_rollup
from twintext.streaming.metrics import LOG_SCHEMA, append_log, end_log, stream_log, streamed_rollup, write_rollup_stream


class Log:
    def __init__(self, spark, base, late):
        self.spark, self.late = spark, late
        self.source, self.sink, self.marks = (str(base / n) for n in ("log", "rollup", "marks"))

    def append(self, rows):
        append_log(self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), self.source)

    def run(self, files=None):
        log = stream_log(self.spark, self.source, files_per_batch=files)
        write_rollup_stream(streamed_rollup(log, 10, late_epochs=self.late), self.sink, self.marks).awaitTermination()
        return sorted(map(tuple, self.spark.read.parquet(self.sink).collect()), key=str)

    def whole(self):
        log = self.spark.read.schema(LOG_SCHEMA).parquet(self.source).where("tag IS NOT NULL")
        return sorted(map(tuple, metric_rollup(log, 10).collect()), key=str)


def entries(epochs):
    return [(tag, e, b, float(e * b) + len(tag)) for e in epochs for b in range(4) for tag in ("loss", "speed")]


def test_restarts_count_nothing_twice(spark, tmp_path):
    log = Log(spark, tmp_path, 1)
    log.append(entries([0, 1]))
    first = log.run()
    assert {r[1] for r in first} == {0}  # epoch 1 is open
    assert log.run() == first  # nothing new, nothing read again
    log.append(entries([1, 2]))  # epoch 1 goes on: its sum comes from the stored state
    assert {r[1] for r in log.run()} == {0, 1}
    log.append(entries([3]))
    end_log(spark, log.source, 3)
    found = log.run()
    assert found == log.whole()
    assert {r[1]: r[3] for r in found if r[0] == "loss"} == {0: 4, 1: 8, 2: 4, 3: 4}


def test_several_batches_equal_one_rollup(spark, tmp_path):
    log = Log(spark, tmp_path, 3)
    for epochs in ([0, 2], [1], [3, 5], [4], [6, 7]):  # out of order by less than what is waited for
        log.append(entries(epochs))
    end_log(spark, log.source, 7, 3)
    assert log.run(files=1) == log.whole()


def test_entries_beyond_the_wait_are_dropped(spark, tmp_path):
    log = Log(spark, tmp_path, 1)
    log.append(entries([0, 5]))
    before = log.run()
    log.append(entries([0]))
    end_log(spark, log.source, 5)
    after = log.run()
    assert [r for r in after if r[1] == 0] == [r for r in before if r[1] == 0]
    assert {r[1] for r in after} == {0, 5}


def test_nulls(spark, tmp_path):
    log = Log(spark, tmp_path, 1)
    log.append([("loss", None, 1, 1.0), ("loss", 0, None, None), ("loss", 0, 1, 2.0), (None, 0, 1, 3.0)])
    end_log(spark, log.source, 0)
    assert log.run() == sorted([("loss", 0, 2.0, 2, 1, 1), (None, 0, 3.0, 1, 1, 1)], key=str)


def test_state_has_partitions_of_its_own(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    log = stream_log(spark, str(tmp_path), state_partitions=3)
    assert log.sparkSession.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        streamed_rollup(stream_log(spark, str(tmp_path)), 1, late_epochs=-1)
