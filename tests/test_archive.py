"""Archiving by commit: what committed runs read is moved, once, whatever fails in between."""

import os

import pytest
from pyspark.sql import functions as F

from dayfold.plans.daily import Warehouse, run_day
from dayfold.sinks import archive, archive_committed, read_commits
from test_daily import CONFIG, DAYS, inputs, stamp, write_drops

DAY, NEXT = DAYS[0], DAYS[1]


def names(day):
    return {f"transactions_{stamp(day)}.txt", f"terminals_{stamp(day)}.xlsx", f"passport_blacklist_{stamp(day)}.xlsx"}


def left(folder):
    return {p.name for p in folder.iterdir() if not p.name.startswith(".")}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """One committed day, a run of the next day that failed before its commit, and a day that no run has read."""
    drops = tmp_path_factory.mktemp("drops of days")
    write_drops(spark, drops, [DAY, NEXT, DAYS[2]], empty={DAY, DAYS[2]})
    wh = Warehouse(str(tmp_path_factory.mktemp("warehouse")))
    inp = inputs(spark, drops)
    run_day(spark, wh, inp, DAY, CONFIG)
    fails = inp.with_transactions(inp.transactions(NEXT).withColumn(
        "oper_type", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        run_day(spark, wh, fails, NEXT, CONFIG)
    return wh, inp, drops


def test_only_files_of_committed_runs_move_and_a_crash_loses_none(spark, store, tmp_path_factory, monkeypatch):
    wh, inp, drops = store
    target = tmp_path_factory.mktemp("archive")
    assert {os.path.basename(f).replace("%20", " ") for f in read_commits(spark, wh.base).files[DAY]} == names(DAY)

    seen, real = [], archive.written_at

    def crashes(session, name):
        seen.append(name)
        if len(seen) == 2:
            raise RuntimeError("driver lost")
        return real(session, name)

    monkeypatch.setattr(archive, "written_at", crashes)
    with pytest.raises(RuntimeError, match="driver lost"):
        archive_committed(spark, wh.base, str(target))
    monkeypatch.undo()
    assert len(left(drops) & names(DAY)) == 2

    assert len(archive_committed(spark, wh.base, str(target))) == 2
    assert archive_committed(spark, wh.base, str(target)) == []
    assert left(drops) == names(NEXT) | names(DAYS[2])
    attempt = read_commits(spark, wh.base).attempts[DAY]
    assert left(target / f"run={DAY}" / f"attempt={attempt}") == names(DAY)


def test_a_file_written_anew_under_a_listed_name_stays(spark, store, tmp_path_factory):
    wh, inp, drops = store
    run_day(spark, wh, inp, NEXT, CONFIG)
    changed = drops / f"transactions_{stamp(NEXT)}.txt"
    os.utime(changed, (changed.stat().st_atime, changed.stat().st_mtime + 60))
    target = tmp_path_factory.mktemp("archive")
    archive_committed(spark, wh.base, str(target))
    assert left(drops) == {changed.name} | names(DAYS[2])
    # the corrected file is read by a new attempt, and archived beside what the earlier one read
    again = inp.__class__(**{**inp.__dict__, **{k: (lambda _d, k=k: getattr(inp, k)(DAYS[2])) for k in ("terminals", "blacklist")}})
    run_day(spark, wh, again, NEXT, CONFIG)
    assert len(archive_committed(spark, wh.base, str(target))) == 3
    assert left(drops) == {f"transactions_{stamp(DAYS[2])}.txt"} and len(left(target / f"run={NEXT}")) == 2


def test_staged_rows_of_the_warehouse_are_no_drops(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "wh" / "staged"))
    spark.range(3).write.parquet(str(tmp_path / "drop"))
    both = [spark.read.parquet(str(tmp_path / n)) for n in ("wh/staged", "drop")]
    files = archive.input_files(*both, apart_from=str(tmp_path / "wh"))
    assert files and all("/drop/" in f for f in files)
