import json
import os

import pytest

from twintext.sources.quarantine import read_sides, set_aside_report, store_sides

LINES = [
    '{"pair_id":1,"src":"a","tgt":"b"}',
    '{"pair_id":2,"src":"a","tgt":',
    '{"pair_id":"x","src":"a","tgt":"b"}',
    '{"src":"ä","tgt":"b"}',
    '{"pair_id":5,"src":"a"}',
    '{"pair_id":6,"src":"","tgt":"","more":1}',
    "not json at all",
]


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


@pytest.fixture(params=["read", "store"])
def sides_of(request, spark, tmp_path):
    def build(path, *args, **options):
        if request.param == "read":
            return read_sides(spark, path, *args, **options)
        return store_sides(spark, path, str(tmp_path / "stored"), *args, **options)

    return build


def test_json_lines(spark, tmp_path, sides_of):
    path = str(tmp_path / "in")
    write(path, "one.json", LINES[:4])
    write(path, "two.json", LINES[4:])
    sides = sides_of(path)
    assert sorted(map(tuple, sides.pairs.collect())) == [(1, "a", "b"), (6, "", "")]
    aside = {(os.path.basename(r["file"]), r["reason"], r["record"]) for r in sides.set_aside.collect()}
    assert {a for a in aside if a[1] == "unreadable"} == {
        ("one.json", "unreadable", LINES[1]),
        ("one.json", "unreadable", LINES[2]),
        ("two.json", "unreadable", LINES[6]),
    }
    rest = {(f, reason): json.loads(record) for f, reason, record in aside if reason != "unreadable"}
    assert rest == {("one.json", "no id"): {"src": "ä", "tgt": "b"}, ("two.json", "no text"): {"pair_id": 5, "src": "a"}}
    counts = {(os.path.basename(r["file"]), r["reason"]): r["n"] for r in set_aside_report(sides).collect()}
    assert counts == {("one.json", "unreadable"): 2, ("one.json", "no id"): 1, ("two.json", "no text"): 1, ("two.json", "unreadable"): 1}
    # All records are on one side.
    assert sides.pairs.count() + sides.set_aside.count() == len(LINES)


def test_csv_lines_of_other_columns(spark, tmp_path, sides_of):
    path = str(tmp_path / "in")
    write(path, "a.csv", ["id,x,y", "1,a,b", "2,a", "3,a,b,c", "z,a,b", ",a,b", '4,"a,1",b'])
    sides = sides_of(path, "csv", "id long, x string, y string", {"pair_id": "id", "src": "x", "tgt": "y"}, header="true")
    assert sorted(map(tuple, sides.pairs.collect())) == [(1, "a", "b"), (4, "a,1", "b")]
    assert sides.pairs.select("src").count() == 2  # also where one column is asked for
    aside = sorted((r["reason"], r["record"]) for r in sides.set_aside.collect())
    assert [a for a in aside if a[0] == "unreadable"] == [("unreadable", "2,a"), ("unreadable", "3,a,b,c"), ("unreadable", "z,a,b")]
    assert [r for r, _ in aside].count("no id") == 1 and len(aside) == 4


def test_empty_files(spark, tmp_path, sides_of):
    path = str(tmp_path / "in")
    os.makedirs(path)
    open(os.path.join(path, "none.json"), "w").close()
    sides = sides_of(path)
    assert sides.pairs.count() == 0 and sides.set_aside.count() == 0


def test_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        read_sides(spark, str(tmp_path), "parquet")
    with pytest.raises(ValueError):
        read_sides(spark, str(tmp_path), mode="DROPMALFORMED")
