"""Replacing tables: nothing is lost, whatever a run does not get to."""

import contextvars
import os
import pathlib
import signal
import subprocess
import sys
import threading
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gate import fixtures as fx
from gate.fixtures import SETTINGS
from tests.conftest import SF_SMALL
from tests.test_plans import jobs_started, plan
from wayside.operators import rules as ru
from wayside.plans import jobs
from wayside.session import scratch_path, scratch_removed
from wayside.sources import publish
from wayside.sources import tables as io
from wayside.sources.publish import Files, Publication, finish, remove_unfinished

ROOT = pathlib.Path(__file__).resolve().parents[1]


def count(spark, path):
    return spark.read.parquet(path).count()


def left(root):
    return sorted(p.name for p in pathlib.Path(root.removeprefix("file:")).iterdir())


@pytest.fixture
def root(spark):
    path = scratch_path(spark, "published")
    with Publication(spark, path) as new:
        new.write(spark.range(10), f"{path}/a")
        new.write(spark.range(20), f"{path}/deep/b")
    return path


def test_tables_take_their_places(spark, root):
    assert (count(spark, f"{root}/a"), count(spark, f"{root}/deep/b")) == (10, 20)
    assert left(root) == ["a", "deep"]
    with Publication(spark, root) as new:
        staged = new.write(spark.range(1), f"{root}/a")
        assert (staged.count(), count(spark, f"{root}/a")) == (1, 10)
    assert (count(spark, f"{root}/a"), count(spark, f"{root}/deep/b")) == (1, 20)
    assert left(root) == ["a", "deep"]


def test_an_error_leaves_the_old_tables(spark, root):
    with pytest.raises(ZeroDivisionError), Publication(spark, root) as new:
        new.write(spark.range(1), f"{root}/a")
        raise ZeroDivisionError
    failing = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("no"))).otherwise("x").alias("x"))
    with pytest.raises(Exception, match="no"):
        io.write_table(failing, f"{root}/a")
    assert count(spark, f"{root}/a") == 10 and left(root) == ["a", "deep"]


@pytest.mark.parametrize("done", range(5))
def test_a_driver_lost_between_renames(spark, root, monkeypatch, done):
    """After any number of renames the next run carries out the rest."""
    calls, rename = [], Files.rename

    def some(self, old, new):
        if "journal" not in new:
            if len(calls) == done:
                raise KeyboardInterrupt
            calls.append(new)
        rename(self, old, new)

    monkeypatch.setattr(Files, "rename", some)
    try:
        with Publication(spark, root) as new:
            new.write(spark.range(1), f"{root}/a")
            new.write(spark.range(2), f"{root}/deep/b")
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    finish(spark, root)
    assert (count(spark, f"{root}/a"), count(spark, f"{root}/deep/b")) == (1, 2)
    assert left(root) == ["a", "deep"]


def test_a_rename_by_copying_that_was_cut_short(spark, root):
    new = Publication(spark, root)
    new.write(spark.range(3), f"{root}/a")
    ((path, staged),) = new.staged.items()
    new.files.rename(path, f"{staged}-old")
    publish.write_once(spark.range(1), path, "parquet", {})  # a part of the copy
    new.files.write(f"{new.folder}/journal.json", f'[["{path}", "{staged}", "{staged}-old"]]')
    finish(spark, root)
    assert count(spark, f"{root}/a") == 3 and left(root) == ["a", "deep"]


def test_a_killed_write_leaves_the_old_table(spark, root):
    path = root.removeprefix("file:")
    code = f"""
from wayside.session import get_session
from wayside.sources.tables import write_table
from pyspark.sql import functions as F
spark = get_session("killed", spark__master="local[2]", spark__driver__memory="512m")
rows = spark.range(0, 10**6, 1, 2)
rows = rows.where(F.expr("aggregate(sequence(1, 20000), 0L, (a, b) -> (a + b * id) % 97) >= 0"))
write_table(rows, {str(path) + "/a"!r})
"""
    run = subprocess.Popen([sys.executable, "-c", code], cwd=ROOT, start_new_session=True, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    deadline = time.time() + 120
    while not any(n.startswith("_staged-") for n in left(root)) and time.time() < deadline:
        assert run.poll() is None
        time.sleep(0.2)
    os.killpg(run.pid, signal.SIGKILL)
    run.wait()
    assert count(spark, f"{root}/a") == 10
    assert any(n.startswith("_staged-") for n in left(root))
    remove_unfinished(spark, root)
    assert left(root) == ["a", "deep"] and count(spark, f"{root}/a") == 10


def test_a_table_may_be_made_from_the_one_it_replaces(spark, root):
    io.write_table(spark.read.parquet(f"{root}/a").where("id < 4"), f"{root}/a")
    assert count(spark, f"{root}/a") == 4


def test_scratch_of_two_jobs_at_once(spark):
    """Each job removes its own scratch tables, and no other's."""
    first_in, second_done = threading.Event(), threading.Event()
    found = {}

    def first():
        with scratch_removed(spark):
            path = scratch_path(spark, "first")
            spark.range(7).write.parquet(path)
            first_in.set()
            second_done.wait(60)
            found["first"] = count(spark, path)
        found["gone"] = not Files(spark).exists(path)

    def second():
        first_in.wait(60)
        with scratch_removed(spark):
            spark.range(1).write.parquet(scratch_path(spark, "second"))
        second_done.set()

    threads = [threading.Thread(target=contextvars.copy_context().run, args=(f,)) for f in (first, second)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found == {"first": 7, "gone": True}


def test_two_whole_jobs_at_once(spark):
    source = scratch_path(spark, "raw")
    fx.incidents(spark, SF_SMALL).write.parquet(source)
    outs, rows = [scratch_path(spark, f"etl{k}") for k in range(2)], []
    run = lambda out: rows.append(jobs.run_etl(spark, source, out, SETTINGS, fmt="parquet", with_profile=False).cleaned.count())
    jobs.at_once([lambda o=o: run(o) for o in outs])
    assert rows[0] == rows[1] > 0


def test_every_table_of_the_job_is_written_once(spark, monkeypatch):
    source, out = scratch_path(spark, "raw"), scratch_path(spark, "etl")
    fx.incidents(spark, SF_SMALL).write.parquet(source)
    written, write = [], publish.write_once
    monkeypatch.setattr(publish, "write_once", lambda df, path, *a, **k: written.append(path) or write(df, path, *a, **k))
    kept, materialize = [], jobs.materialize
    monkeypatch.setattr(jobs, "materialize", lambda df: kept.append(df.columns) or materialize(df))
    jobs.run_etl(spark, source, out, SETTINGS, fmt="parquet")
    names = [p.rpartition("/")[2].partition("-")[2] for p in written]
    assert len(names) == len(set(names)) and {"cleaned", "accident_detail", "findings"} <= set(names)
    # the parsed rows and the findings on the star, no table that is published
    assert len(kept) == 2 and "_bad_record" in kept[0] and "passed" in kept[1]
    assert left(out) == ["aggregates", "cleaned", "dimensions", "fact", "profile", "quality"]


def test_checks_while_rows_are_written_cost_no_pass(spark):
    df = fx.filtered(spark, SF_SMALL).withColumn("Duration_min", F.lit(1.0))
    path = scratch_path(spark, "plain")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    rules = {"Severity": {"min": 1, "max": 5, "null_pct_max": 0}, "Year": {"min": 1996, "max": 1999}, "none": {"min": 1}}
    measures = [*ru.rule_measures(stored, rules), *ru.quality_measures(stored, SETTINGS)]
    watched, measured = ru.watch(stored, measures)
    _, plain = jobs_started(spark, lambda: stored.write.parquet(scratch_path(spark, "p")))
    _, n = jobs_started(spark, lambda: watched.write.parquet(scratch_path(spark, "w")))
    assert n == plain
    for got, want in (
        (ru.check_rules(stored, "s", rules, measured=measured()), ru.check_rules(stored, "s", rules)),
        (ru.check_quality(stored, SETTINGS, measured()), ru.check_quality(stored, SETTINGS)),
    ):
        assert "FileScan" not in plan(got) and got.collect() == want.collect()


def test_a_guarded_range(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.5)], "i long, x double")
    same = ru.guard_range(df, "x", 0, 10, "load")
    assert same.collect() == df.collect() and same.columns == df.columns
    tight = ru.guard_range(df, "x", hi=9, stage="load")
    with pytest.raises(Exception, match=r"\[load\] x outside None..9: 9.5"):
        tight.collect()
    assert tight.select("i").count() == 3
    assert ru.guard_range(df, "absent", 0, 1) is df
    path = scratch_path(spark, "guarded")
    io.write_table(df, path)
    with pytest.raises(Exception, match="outside"):
        io.write_table(tight, path)
    assert count(spark, path) == 3


def test_one_year_is_in_few_row_groups(spark):
    """Written in ranges of the start time, a year lies in the files it needs."""
    source = scratch_path(spark, "raw")
    fx.incidents(spark, SF_SMALL).write.parquet(source)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = {}
        for cluster in (False, True):
            out = scratch_path(spark, "etl")
            done = jobs.run_etl(spark, source, out, SETTINGS, fmt="parquet", with_profile=False, cluster=cluster)
            rows[cluster] = done.cleaned.count(), done.star.accident_detail.count()
            for table, column in (("cleaned", "Start_Time"), ("fact/accident_detail", "Start_Time")):
                groups = held = 0
                for file in pathlib.Path(f"{out}/{table}".removeprefix("file:")).glob("part-*"):
                    meta = pq.ParquetFile(file).metadata
                    at = meta.schema.names.index(column)
                    for g in range(meta.num_row_groups):
                        stats = meta.row_group(g).column(at).statistics
                        groups += 1
                        held += stats.min.year <= 1997 <= stats.max.year
                if cluster:
                    assert groups >= 4 and held <= groups // 2
                else:
                    assert held == groups
        assert rows[False] == rows[True]
    finally:
        spark.conf.set(key, before)
