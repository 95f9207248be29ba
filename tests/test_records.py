"""Split reading of CSV files with line breaks in cells, against Spark's reader of whole files."""

from __future__ import annotations

import random

import pytest

from opinarium.sources.records import MalformedCsv, read_split_csv, records


def whole(spark, path):
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    return df.columns, sorted((tuple(r) for r in df.collect()), key=repr)


def split(spark, path):
    df = read_split_csv(spark, path)
    return df.columns, sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    for name in names:
        spark.conf.set(name, "64")
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


EDGES = {
    "plain": "a,b\n1,2\n3,4\n",
    "breaks": 'a,b\n1,"x\ny"\n"p\n\nq",2\n',
    "doubled": 'a,b\n"say ""hi""\nthen","""\n"""\n"",\n',
    "crlf": 'a,b\r\n1,"x\r\ny"\r\n\r\n2,"z"\r\n',
    "no_end": 'a,b\n1,"x\ny"',
    "blank_first": '\n\na,b\n\n1,2\n',
    "spread": 'a,b\n1,"' + "\n".join(f"line {i} of a cell, with commas" for i in range(60)) + '"\n2,x\n',
    "short_and_long": "a,b\n1\n1,2,3\n,\n",
    "quoted_names": '"a b","c,d"\n"1","2"\n',
}


@pytest.mark.parametrize("name", EDGES)
def test_same_rows_as_whole_files(spark, tmp_path, small_splits, name):
    path = tmp_path / "x.csv"
    path.write_bytes(EDGES[name].encode())
    assert split(spark, str(path)) == whole(spark, str(path))


def test_many_tasks_read_one_file(spark, tmp_path, small_splits):
    rng = random.Random(3)
    cells = ['"a ""quoted"" word"', '"two\nlines"', '"\r\n"', "plain", "", '"é, ü"', '"' + "x\n" * 40 + '"']
    lines = [",".join([str(i), rng.choice(cells), rng.choice(cells)]) for i in range(400)]
    path = tmp_path / "x.csv"
    path.write_bytes(("id,a,b\n" + "\n".join(lines) + "\n").encode())
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
    assert split(spark, str(path)) == whole(spark, str(path))
    found, names = records(spark, str(path))
    assert names == ["id", "a", "b"]
    numbers = sorted(r["record"] for r in found.collect())
    assert numbers == list(range(2, 402))


def test_ingest_order_follows_the_file(spark, tmp_path, small_splits):
    path = tmp_path / "x.csv"
    path.write_bytes(("id,a\n" + "".join(f'{i},"x\n{i}"\n' for i in range(50))).encode())
    rows = read_split_csv(spark, str(path), "place").orderBy("place").collect()
    assert [r["id"] for r in rows] == [str(i) for i in range(50)]


def test_several_files_and_their_headers(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('id,a\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text('id,a\r\n2,z\r\n', newline="")
    assert split(spark, str(tmp_path))[1] == [("1", "x\ny"), ("2", "z")]
    (tmp_path / "c.csv").write_text("id,b\n3,z\n")
    with pytest.raises(MalformedCsv, match="headers differ"):
        read_split_csv(spark, str(tmp_path))


def test_malformed_and_empty_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"x\n')
    with pytest.raises(MalformedCsv, match="open at the end"):
        read_split_csv(spark, str(tmp_path / "open.csv"))
    (tmp_path / "head.csv").write_text('"a\n",b\n1,2\n')
    with pytest.raises(MalformedCsv, match="second line"):
        read_split_csv(spark, str(tmp_path / "head.csv"))
    (tmp_path / "empty.csv").write_text("")
    assert read_split_csv(spark, str(tmp_path / "empty.csv")).count() == 0


def test_single_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n" + "1,2\n" * 100)
    df = read_split_csv(spark, str(tmp_path / "x.csv"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if " Exchange " in line]
    assert len(exchanges) == 1 and "record" in exchanges[0]
