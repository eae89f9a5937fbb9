"""Readers and writers."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import types as T

from gate import fixtures as fx
from tests.conftest import SF_SMALL
from wayside.session import scratch_path
from wayside.sources import tables as io

CSV = """Severity,ID,Start_Time,End_Time,Temperature(F),City,State,Junction,Description,Extra
3,A-1,2021-01-02 03:04:05,2021-01-02 03:34:05.000000000,31.5,Dayton,OH,True,"Lane ""A"", blocked",x
2,A-2,2021-01-02 03:04:05.250000,bad,NaN,N/A,,False,nan,y
x,A-3,,2021-01-02 04:00:00,oops,None,OH,,text,
"""


def test_csv_by_header(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    df = io.read_incidents(spark, str(path))
    kinds = dict(df.dtypes)
    assert kinds["Severity"] == "tinyint" and kinds["Junction"] == "boolean"
    assert kinds["Start_Time"] == kinds["End_Time"] == "timestamp_ntz"
    assert kinds["Extra"] == "string"
    a, b, c = df.orderBy("ID").collect()
    assert (a["Severity"], a["Junction"], a["Temperature(F)"]) == (3, True, 31.5)
    assert a["Description"] == 'Lane "A", blocked'
    assert a["End_Time"] == dt.datetime(2021, 1, 2, 3, 34, 5)
    assert b["Start_Time"] == dt.datetime(2021, 1, 2, 3, 4, 5, 250000)
    assert (b["End_Time"], b["Temperature(F)"], b["City"], b["State"]) == (None,) * 4
    assert (c["Severity"], c["Temperature(F)"], c["City"], c["Extra"]) == (None,) * 4


def test_line_break_inside_quotes(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('ID,Start_Time,Description\nA-1,2021-01-02 03:04:05,"two\nlines"\n')
    row = io.read_incidents(spark, str(path), multi_line=True).collect()
    assert [r["Description"] for r in row] == ["two\nlines"]


def test_columns_follow_the_header_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,City,State\nA-1,Dayton,OH\n")
    (tmp_path / "b.csv").write_text("State,ID,City,Severity\nTX,B-1,Austin,2\n")
    (tmp_path / "c.csv").write_text("")
    with gzip.open(tmp_path / "d.csv.gz", "wt") as f:
        f.write("City,ID\nReno,D-1\n")
    rows = {r.ID: (r.City, r.State, r.Severity) for r in io.read_incidents(spark, str(tmp_path)).collect()}
    assert rows == {"A-1": ("Dayton", "OH", None), "B-1": ("Austin", "TX", 2), "D-1": ("Reno", None, None)}


def test_all_misfits_of_a_record_are_named(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("ID,Severity,Start_Time,Junction,City\n1,x,what,maybe,Reno\n2,3,N/A,,\n3,2,2021-01-01 10:00:00,True,Reno\n")
    rows = {r.ID: r["_bad_record"] for r in io.read_incidents(spark, str(path), keep_bad=True).collect()}
    assert rows == {"1": "Severity=x, Start_Time=what, Junction=maybe", "2": None, "3": None}


def test_any_column_name_can_be_read(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("ID,Severity,__text0,_0,__TEXT1\n1,2,a,b,c\n")
    rows = io.read_incidents(spark, str(path), keep_bad=True).select("ID", "Severity", "__text0", "_0", "__TEXT1")
    assert [tuple(r) for r in rows.collect()] == [("1", 2, "a", "b", "c")]


def test_the_reading_loop_is_compiled(spark, tmp_path):
    # the JVM interprets methods of more than 8,000 bytes
    io.write_table(fx.incidents(spark, SF_SMALL), str(tmp_path / "csv"), "csv")
    df = io.read_incidents(spark, str(tmp_path / "csv"), keep_bad=True)
    loops = df._jdf.queryExecution().debug().codegenToSeq()
    sizes = [loops.apply(i)._3().maxMethodCodeSize() for i in range(loops.size())]
    assert sizes and 0 < max(sizes) < 8000


def test_damaged_times_are_repaired(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("ID,Start_Time\n1,2021-01-01 10:00:00 UTC#\n2,*2021-01-01 10:00:00\n3,what\n")
    rows = {r.ID: r for r in io.read_incidents(spark, str(path), keep_bad=True).collect()}
    assert rows["1"].Start_Time == rows["2"].Start_Time == dt.datetime(2021, 1, 1, 10)
    assert rows["3"].Start_Time is None and rows["3"]["_bad_record"] == "Start_Time=what"


def test_unreadable_records_are_counted(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('ID,Severity,Temperature(F)\n1,2,N/A\n2,x,1\n3,"cut\nlines",1\n4,1,2,3\n')
    out = scratch_path(spark, "read")
    io.write_table(io.read_incidents(spark, str(path), keep_bad=True), out)
    got = io.bad_records(io.read_table(spark, out)).first()
    # the broken line makes two short records; 4 has a field too many
    assert (got.n_rows, got.n_bad) == (5, 4)
    whole = io.read_incidents(spark, str(path), multi_line=True, keep_bad=True).collect()
    assert [r.ID for r in whole if r["_bad_record"] is None] == ["1"] and len(whole) == 4


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        io.read_incidents(spark, str(tmp_path / "none.csv"))


def test_parquet_source(spark):
    path = scratch_path(spark, "raw-parquet")
    fx.incidents(spark, SF_SMALL).write.parquet(path)
    df = io.read_incidents(spark, path, "parquet")
    assert df.count() == 1500
    assert isinstance(df.schema["Start_Time"].dataType, T.TimestampNTZType)


def test_overwrite_and_partitions(spark):
    path = scratch_path(spark, "out")
    io.write_table(spark.range(5), path)
    io.write_table(spark.range(3), path)
    assert io.read_table(spark, path).count() == 3
    root = scratch_path(spark, "star")
    star = fx.star(spark, SF_SMALL)
    io.write_star(star, root, partition_fact=True)
    fact = spark.read.parquet(io.star_paths(root)["accident_detail"])
    assert "part_year" in fact.columns
    back = io.read_star(spark, root)
    assert back.accident_detail.columns == star.accident_detail.columns
    assert back.accident_detail.count() == star.accident_detail.count()


def test_read_cleaned_keeps_a_category(spark):
    path = scratch_path(spark, "cleaned")
    df = spark.createDataFrame([("Fog", "Kept")], "Weather_Condition string, Weather_Category string")
    io.write_table(df, path)
    assert io.read_cleaned(spark, path).first()["Weather_Category"] == "Kept"
    io.write_table(df.drop("Weather_Category"), path + "-b")
    assert io.read_cleaned(spark, path + "-b").first()["Weather_Category"] == "Fog"
