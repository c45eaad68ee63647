"""Archiving of drops by commit: what a committed run has read is moved, and nothing else.

A run's commit lists the files that its drops were read from, with the time each was last written. ``archive_committed``
is a step of its own after any number of runs: it moves the listed files to ``archive/run=D/attempt=A/``. A file goes
by one rename on the drops' file system, so a crash at any point leaves every file whole on one side, and the next call
moves the rest. Files of no committed run stay, as does a file that was written anew under a listed name since the run
read it: no run has loaded that one.

The driver handles a few files per run (the three drops of a day). Files are addressed through Spark's file system
layer, so drops may lie in any store that Spark reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dayfold.sinks.writers import read_commits


def _path(spark: SparkSession, name: str):
    """(file system, path) of a file's address."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(name.replace(" ", "%20")))
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def written_at(spark: SparkSession, name: str) -> int | None:
    """When a file was last written, in milliseconds; None if it is not there."""
    fs, path = _path(spark, name)
    return fs.getFileStatus(path).getModificationTime() if fs.exists(path) else None


def input_files(*drops: DataFrame, apart_from: str) -> dict[str, int]:
    """The files that drops will be read from and when each was last written; ask before they are read. Files of the
    warehouse at ``apart_from`` (rows staged by an earlier attempt) are no drops; a micro-batch lists none."""
    spark = drops[0].sparkSession
    fs, path = _path(spark, apart_from)
    own = fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"
    names = sorted({name for df in drops for name in df.inputFiles()})
    times = {name: written_at(spark, name) for name in names if not _path(spark, name)[1].toUri().getPath().startswith(own)}
    return {name: at for name, at in times.items() if at is not None}


def archive_committed(spark: SparkSession, root: str, archive_dir: str) -> list[str]:
    """Move the files of the committed runs of the warehouse at ``root`` into ``archive_dir``, which lies on the same
    file system as the drops; returns what was moved. May be repeated at any time."""
    commits, moved = read_commits(spark, root), []
    for run, files in sorted(commits.files.items()):
        for name, at in sorted(files.items()):
            if written_at(spark, name) != at:  # archived already, or another file under its name
                continue
            fs, path = _path(spark, name)
            folder = spark._jvm.org.apache.hadoop.fs.Path(
                f"{archive_dir.rstrip('/')}/run={run}/attempt={commits.attempts[run]}")
            fs.mkdirs(folder)
            target = spark._jvm.org.apache.hadoop.fs.Path(folder, path.getName())
            if fs.exists(target) or not fs.rename(path, target):
                raise OSError(f"{name} could not be moved to {target.toString()}")
            moved.append(name)
    return moved
