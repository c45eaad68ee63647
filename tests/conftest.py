import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="dayfold-tests-")
    s = (SparkSession.builder.master("local[4]").appName("dayfold-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.local.dir", scratch)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their session, so they may set the checkpoint folder; library code only reads it.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con
