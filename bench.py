"""Benchmark: headline contract queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built, planned and executed once as a warm-up, then timed best-of-$BENCH_REPS (building the
DataFrame, planning and execution into Spark's ``noop`` sink, the same for all) over materialised fixture tables, as
report) are timed once and reported separately (``daily_runs_sec``). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from dayfold.plans import contract  # noqa: E402
from dayfold.plans import fixtures as fx  # noqa: E402

HEADLINE = [
    "fraud_passport", "fraud_contract", "fraud_travel", "fraud_amount_probing", "fraud_report",
    "fraud_report_accumulated", "scd2_merge", "scd2_two_day_replay", "enriched_transactions",
    "capture_transactions", "lead_sequence",
]


def time_daily_runs(spark: SparkSession, sf_dir: str, scratch: str) -> dict:
    """Three consecutive daily runs (the reference's actual workload) on a fresh warehouse: text drops
    read through the delimited reader, full capture on the first day, production rule windows."""
    import datetime as dt

    from pyspark.sql import functions as F

    from dayfold.functions import inf
    from dayfold.plans.daily import DailyInputs, Warehouse, backfill
    from dayfold.schemas import TRANSACTIONS
    from dayfold.sources import read_delimited_drop

    days = [dt.date(2024, 1, 18), dt.date(2024, 1, 19), dt.date(2024, 1, 20)]
    drops = f"{scratch}/drops"
    text = fx.transactions_text(spark, sf_dir)
    for d in days:
        (text.where(F.to_date("trans_date") == F.lit(d)).coalesce(1).write.mode("overwrite")
         .option("header", True).option("sep", ";").csv(f"{drops}/transactions_{d:%d%m%Y}.txt"))
    t0 = F.lit(fx.T0).cast("timestamp_ntz")

    def source(df, cols):
        cur = df.where(F.col("effective_to") == inf())
        return cur.select(*cols, t0.alias("create_dt"),
                          F.when(F.col("effective_from") > t0, F.col("effective_from")).alias("update_dt"))

    inputs = DailyInputs(
        transactions=lambda d: read_delimited_drop(spark, f"{drops}/transactions_{d:%d%m%Y}.txt", TRANSACTIONS),
        terminals=lambda d: fx.terminals_hist(spark, sf_dir).select(
            "terminal_id", "terminal_type", "terminal_city", "terminal_address"),
        blacklist=lambda d: fx.blacklist(spark, sf_dir),
        cards=source(fx.cards_hist(spark, sf_dir), ["card_num", "account_num"]),
        accounts=source(fx.accounts_hist(spark, sf_dir), ["account_num", "valid_to", "client"]),
        clients=source(fx.clients_hist(spark, sf_dir), ["client_id", "last_name", "first_name", "patronymic",
                                                        "date_of_birth", "passport_num", "passport_valid_to",
                                                        "phone"]),
    )
    start = time.perf_counter()
    backfill(spark, Warehouse(f"{scratch}/warehouse"), inputs, days)
    total = time.perf_counter() - start
    return {"daily_runs": len(days), "daily_runs_sec": round(total, 3), "sec_per_daily_run": round(total / len(days), 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("dayfold-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.local.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for fixture in (fx.transactions, fx.cards_hist, fx.accounts_hist, fx.clients_hist, fx.terminals_hist, fx.blacklist,
                    fx.scd2_history, fx.scd2_changes, fx.scd2_keys):
        fixture(spark, sf_dir).persist().count()
    times, rows = {}, {}
    for name in names:
        fn = contract.QUERIES[name]
        rows[name] = fn(spark, sf_dir).count()

        def run():
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        best = float("inf")
        for _ in range(reps):
            t0 = time.perf_counter()
            run()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 4)
    try:
        daily = time_daily_runs(spark, sf_dir, scratch)
    except Exception as exc:  # the headline line is still printed; the exit code tells
        daily = {"daily_runs_error": f"{type(exc).__name__}: {exc}"[:200]}
    spark.stop()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_best_of_%d" % reps, "value": round(sum(times.values()), 4),
                      "unit": "sec", "queries": times, "rows": rows, "sf": sf,
                      "cpus": cpus, **daily}))
    sys.exit(1 if "daily_runs_error" in daily else 0)


if __name__ == "__main__":
    main()
