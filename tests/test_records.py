"""Quoted line breaks read by many tasks a file, and headers found by tasks."""

import pathlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.test_plans import jobs_started, plan
from wayside.sources import records, tables
from wayside.sources.records import csv_records, file_headers

SCHEMA = "ID string, A string, B string, C string, _bad_record string"


@pytest.fixture
def splits(spark):
    """Sets the size of the splits that files are cut into."""
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}

    def set_size(size):
        for k, v in keys.items():
            spark.conf.set(k, v if v is not None else str(size))

    yield set_size
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def field(rng):
    kind = rng.randrange(9)
    text = "".join(rng.choice(["a", "bc", ",", '""', "\n", " ", "x", "é", "\n\n", "\r\n"]) for _ in range(rng.randrange(12)))
    if kind < 4:
        return f'"{text}"'
    if kind == 4:
        return '""'
    if kind == 5:
        return 'in"side'
    return rng.choice(["", "plain", "7", " sp ace ", "N/A"])


def write_file(path, rng, n, ending="\n", last=True):
    rows = [f"{path.stem}-{i}," + ",".join(field(rng) for _ in range(rng.choice([3, 3, 3, 3, 2, 4]))) for i in range(n)]
    if n > 20:
        rows[n // 2] = f'{path.stem}-long,"' + "line\n" * 400 + '",x,y'  # longer than several splits
    path.write_bytes(("ID,A,B,C" + ending + ending.join(rows) + (ending if last else "")).encode())


def by_spark(spark, path):
    reader = spark.read.options(**tables.CSV_OPTIONS, multiLine=True, columnNameOfCorruptRecord="_bad_record")
    return sorted(map(tuple, reader.schema(SCHEMA).csv(str(path)).collect()), key=str)


def by_tasks(spark, path):
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_bad_record"}
    parsed = csv_records(spark, str(path)).select(F.from_csv("record", SCHEMA, options).alias("r")).select("r.*")
    return sorted(map(tuple, parsed.collect()), key=str)


@pytest.mark.parametrize("size", [7, 64, 500, 4000, 1 << 27])
def test_like_the_reader_that_does_not_split(spark, tmp_path, splits, size):
    rng = random.Random(size)
    write_file(tmp_path / "a.csv", rng, 120 if size >= 64 else 15)
    write_file(tmp_path / "b b%.csv", rng, 40 if size >= 64 else 10, last=False)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only.csv").write_text("ID,A,B,C\n")
    splits(1 << 27)
    want = by_spark(spark, tmp_path)
    splits(size)
    assert by_tasks(spark, tmp_path) == want


def test_a_quote_that_is_never_closed(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text('ID,A,B,C\n1,"two\nlines",3,4\n5,"open\n6,7,8,9\n' + "x,y,z,w\n" * 50)
    splits(60)
    rows = by_tasks(spark, tmp_path)
    assert len(rows) == 2 and rows[0][:2] == ("1", "two\nlines") and rows[1][0] == "5"


def test_one_file_is_read_by_several_tasks(spark, tmp_path, splits):
    rng = random.Random(1)
    write_file(tmp_path / "a.csv", rng, 400)
    splits(2000)
    found = csv_records(spark, str(tmp_path))
    spread = found.select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 4
    begun = records._begin(records.text_lines(spark, str(tmp_path), "\n").withColumn("split", F.xxhash64("file", "start")))
    assert begun[1].any() and not begun[1].all()


def test_other_splits_than_planned_are_an_error(spark, tmp_path, splits):
    write_file(tmp_path / "a.csv", random.Random(2), 200)
    splits(1 << 27)
    found = csv_records(spark, str(tmp_path))
    splits(500)
    with pytest.raises(Exception, match="read them again"):
        found.collect()


def test_what_a_line_says():
    """The states after a line, by a reader that takes one character at a time."""

    def walk(line, inside):
        at, start = 0, not inside
        while at < len(line):
            c = line[at]
            if inside:
                if c == '"':
                    if line[at + 1 : at + 2] == '"':
                        at += 1
                    else:
                        inside, start = False, False
            elif c == '"' and start:
                inside = True
            else:
                start = c == ","
            at += 1
        return inside

    rng = random.Random(4)
    lines = ["".join(rng.choice('",ab"') for _ in range(rng.randrange(9))) for _ in range(4000)]
    split_ends, _ = records._tools()
    for k, line in enumerate(lines):
        if '"' in line and k % 8 == 0:
            batch = pa.RecordBatch.from_pydict({"value": [line], "file": ["f"], "start": [0], "split": [1]})
            (row,) = split_ends(iter([batch]))
            got = row.column("outside")[0].as_py(), row.column("inside")[0].as_py()
            assert got == (walk(line, False), walk(line, True)), line


def test_headers_of_ten_thousand_files(spark, tmp_path):
    for d in range(10):
        (tmp_path / f"d{d}").mkdir()
        for k in range(1000):
            n = 1000 * d + k
            head, row = ("City,ID", f"Reno,{n}") if n % 2500 == 7 else ("ID,City", f"{n},Dayton")
            (tmp_path / f"d{d}" / f"{k}.csv").write_text(f"{head}\n{row}\n")
    found, n = jobs_started(spark, lambda: file_headers(spark, str(tmp_path)).groupBy("header").count().collect())
    assert {tuple(r) for r in found} == {("ID,City", 9996), ("City,ID", 4)}
    read = tables.read_incidents(spark, str(tmp_path))
    counts = {r.City: (r.n, r.ids) for r in read.groupBy("City").agg(F.count("*").alias("n"), F.count_distinct("ID").alias("ids")).collect()}
    assert counts == {"Dayton": (9996, 9996), "Reno": (4, 4)}


@pytest.mark.parametrize("listed", [1000, 0])
@pytest.mark.parametrize("multi_line", [False, True])
def test_three_headers(spark, tmp_path, monkeypatch, listed, multi_line):
    """With the files of rarer headers listed by name, and joined with the headers."""
    monkeypatch.setattr(tables, "LISTED", listed)
    for k in range(12):
        order = [("ID", "City", "State"), ("State", "ID", "City"), ("City", "ID")][0 if k % 4 else k % 3]
        cells = {"ID": f"A-{k}", "City": f"c{k}", "State": f"s{k}"}
        (tmp_path / f"a b{k}%[1].csv").write_text(",".join(order) + "\n" + ",".join(cells[c] for c in order) + "\n")
    rows = {r.ID: (r.City, r.State) for r in tables.read_incidents(spark, str(tmp_path), multi_line=multi_line).collect()}
    assert rows.keys() == {f"A-{k}" for k in range(12)}
    for k in range(12):
        assert rows[f"A-{k}"] == (f"c{k}", None if k % 4 == 0 and k % 3 == 2 else f"s{k}")


def test_the_driver_opens_no_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,City\n1,x\n")
    assert "file_block_start" in plan(file_headers(spark, str(tmp_path)))
    assert not hasattr(tables, "csv_headers")
    assert pathlib.Path(tables.__file__).read_text().count("BufferedReader") == 0
