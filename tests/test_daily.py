"""The daily run end to end: drop files -> warehouse -> report; re-runs, empty days, stream intake."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dayfold.functions import inf
from dayfold.plans import contract
from dayfold.plans import fixtures as fx
from dayfold.plans.daily import (DailyInputs, RuleConfig, Warehouse, backfill, read_blacklist, read_dimension,
                                 read_facts, read_rejects, read_report, run_day)
from dayfold.schemas import BLACKLIST_FILE, DIM_CARDS, FACTS, TERMINALS, TRANSACTIONS
from dayfold.sinks import Attempt, read_commits, read_current, read_history
from dayfold.sources import parse_text_columns, read_delimited_drop, read_workbook_drop
from helpers import spark_rows, write_drop, write_xlsx

DAYS = [dt.date(2024, 1, 18), dt.date(2024, 1, 19), dt.date(2024, 1, 20)]
CONFIG = RuleConfig(probe_within=dt.timedelta(days=1))


def stamp(d):
    return d.strftime("%d%m%Y")


def write_drops(spark, folder, days, empty=()):
    tx = fx.transactions(spark, SF_SMALL)
    cols = [f.name for f in TRANSACTIONS.fields]
    for d in days:
        rows = [] if d in empty else [list(r) for r in tx.where(F.to_date("trans_date") == F.lit(d)).collect()]
        write_drop(str(folder / f"transactions_{stamp(d)}.txt"), cols,
                   [[r[0], r[1].isoformat(sep=" "), *r[2:]] for r in rows])
        terms = fx.terminals_hist(spark, SF_SMALL).collect()
        write_xlsx(str(folder / f"terminals_{stamp(d)}.xlsx"), "terminals",
                   [["terminal_id", "terminal_type", "terminal_city", "terminal_address"]] +
                   [[t.terminal_id, t.terminal_type, t.terminal_city, t.terminal_address] for t in terms])
        bl = fx.blacklist(spark, SF_SMALL).collect()
        write_xlsx(str(folder / f"passport_blacklist_{stamp(d)}.xlsx"), "blacklist",
                   [["date", "passport"]] + [[b.entry_dt.isoformat(), b.passport_num] for b in bl])


def sources(spark):
    t0 = F.lit(fx.T0).cast("timestamp_ntz")

    def src(df, cols):
        cur = df.where(F.col("effective_to") == inf())
        upd = F.when(F.col("effective_from") > t0, F.col("effective_from"))
        return cur.select(*cols, t0.alias("create_dt"), upd.alias("update_dt"))

    return (src(fx.cards_hist(spark, SF_SMALL), ["card_num", "account_num"]),
            src(fx.accounts_hist(spark, SF_SMALL), ["account_num", "valid_to", "client"]),
            src(fx.clients_hist(spark, SF_SMALL), ["client_id", "last_name", "first_name", "patronymic",
                                                  "date_of_birth", "passport_num", "passport_valid_to", "phone"]))


def inputs(spark, folder):
    cards, accounts, clients = sources(spark)
    return DailyInputs(
        transactions=lambda d: read_delimited_drop(spark, str(folder / f"transactions_{stamp(d)}.txt"), TRANSACTIONS),
        terminals=lambda d: read_workbook_drop(spark, str(folder / f"terminals_{stamp(d)}.xlsx"), "terminals",
                                               TERMINALS, with_file=False),
        blacklist=lambda d: read_workbook_drop(spark, str(folder / f"passport_blacklist_{stamp(d)}.xlsx"),
                                               "blacklist", BLACKLIST_FILE, with_file=False),
        cards=cards, accounts=accounts, clients=clients)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("drops")
    write_drops(spark, folder, DAYS + [dt.date(2024, 1, 21)], empty={dt.date(2024, 1, 21)})
    wh = Warehouse(str(tmp_path_factory.mktemp("warehouse")))
    inp = inputs(spark, folder)
    assert backfill(spark, wh, inp, DAYS, CONFIG) == DAYS
    return wh, inp


def test_report_of_the_day_equals_contract_query(spark, loaded):
    wh, _ = loaded
    got = read_report(spark, wh).where(F.col("report_dt") == F.lit(DAYS[-1]))
    assert spark_rows(got) == spark_rows(contract.fraud_report(spark, SF_SMALL))


def test_daily_reports_equal_the_accumulated_form(spark, loaded):
    wh, _ = loaded
    acc = contract.fraud_report_accumulated(spark, SF_SMALL).where(F.col("report_dt").isin(*DAYS))
    # the first loaded day cannot see probing chains that started the day before (not loaded)
    keep = (F.col("report_dt") > F.lit(DAYS[0])) | (F.col("event_type") != "4")
    assert spark_rows(read_report(spark, wh).where(keep)) == spark_rows(acc.where(keep))


def test_rerun_of_the_last_day_is_idempotent(spark, loaded):
    wh, inp = loaded
    before_rep = spark_rows(read_report(spark, wh))
    before_facts = spark_rows(read_facts(spark, wh))
    before_cards = spark_rows(read_dimension(spark, wh, "cards", DAYS[-1]))
    run_day(spark, wh, inp, DAYS[-1], CONFIG)
    assert spark_rows(read_report(spark, wh)) == before_rep
    assert spark_rows(read_facts(spark, wh)) == before_facts
    assert spark_rows(read_dimension(spark, wh, "cards", DAYS[-1])) == before_cards


def test_an_older_day_is_refused_unless_later_runs_are_replayed(spark, loaded):
    wh, inp = loaded
    with pytest.raises(ValueError, match="older than committed run"):
        run_day(spark, wh, inp, DAYS[0], CONFIG)
    with pytest.raises(ValueError, match="must include the later runs"):
        backfill(spark, wh, inp, DAYS[:1], CONFIG, replay=True)


def test_next_run_continues_from_watermark_and_empty_day_advances(spark, loaded):
    wh, inp = loaded
    day = run_day(spark, wh, inp, None, CONFIG)
    assert day == dt.date(2024, 1, 21)
    assert read_commits(spark, wh.base).marks[day]["fact_transactions"] == day
    assert read_report(spark, wh).where(F.col("report_dt") == F.lit(day)).count() == 0


def test_stream_intake_processes_waiting_drops_in_date_order(spark, tmp_path):
    from dayfold.streaming import start_intake

    drops = tmp_path / "drops"
    drops.mkdir()
    write_drops(spark, drops, DAYS[1:])
    wh = Warehouse(str(tmp_path / "warehouse"))
    inp = inputs(spark, drops)
    q = start_intake(spark, str(drops), wh, inp, str(tmp_path / "chk"), archive_dir=str(tmp_path / "archive"),
                     config=CONFIG)
    q.awaitTermination(300)
    assert q.exception() is None
    assert sorted(read_commits(spark, wh.base).attempts) == DAYS[1:]
    got = read_report(spark, wh).where(F.col("report_dt") == F.lit(DAYS[-1]))
    assert spark_rows(got) == spark_rows(contract.fraud_report(spark, SF_SMALL))


# --- the store: late rows, rejects, corrections, failures ------------------------------------------------

def text_drop(spark, rows):
    cols = [f.name for f in TRANSACTIONS.fields]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return parse_text_columns(df, TRANSACTIONS, bad_cells=True)


def fact_ids(spark, wh, *days):
    return sorted(r.trans_id for r in read_facts(spark, wh, *days).select("trans_id").collect())


def test_late_rows_rejects_and_corrections(spark, tmp_path, loaded):
    _, inp = loaded
    wh = Warehouse(str(tmp_path / "w"))
    day1, day2 = DAYS[0], DAYS[1]

    def row(i, at, amt="1,50", oper="PAYMENT"):
        return (i, at, amt, "1", oper, "SUCCESS", "1")

    first = text_drop(spark, [row(f"a{i}", "2024-01-18 10:00:00") for i in range(5)])
    run_day(spark, wh, inp.with_transactions(first), day1, CONFIG)
    second = text_drop(spark, [row("b0", "2024-01-19 09:00:00"), row("late", "2024-01-18 23:59:00"), row("null", None),
                               row("time", "01.03.2021 10:00:00"), row("amount", "2024-01-19 09:30:00", "1.234,56")])
    run_day(spark, wh, inp.with_transactions(second), day2, CONFIG)
    assert fact_ids(spark, wh) == ["a0", "a1", "a2", "a3", "a4", "b0", "late"]
    assert fact_ids(spark, wh, day1, day1) == ["a0", "a1", "a2", "a3", "a4", "late"]
    rejects = {r.trans_id: r.bad_cells for r in read_rejects(spark, wh).collect()}
    assert rejects == {"null": [], "time": ["trans_date=01.03.2021 10:00:00"], "amount": ["amt=1.234,56"]}
    # a corrected, empty drop replaces all of the run, and only that run
    run_day(spark, wh, inp.with_transactions(second.where("false")), day2, CONFIG)
    assert fact_ids(spark, wh) == ["a0", "a1", "a2", "a3", "a4"]
    assert read_rejects(spark, wh).count() == 0
    assert read_report(spark, wh).where(F.col("report_dt") == F.lit(day2)).count() == 0


def test_failed_runs_leave_nothing_visible(spark, tmp_path, loaded):
    _, inp = loaded
    wh = Warehouse(str(tmp_path / "w"))
    run_day(spark, wh, inp, DAYS[0], CONFIG)
    state = lambda: (fact_ids(spark, wh), spark_rows(read_report(spark, wh)), spark_rows(read_blacklist(spark, wh)),
                     spark_rows(read_dimension(spark, wh, "cards", DAYS[0])))
    before = state()
    broken = dataclasses.replace(inp, blacklist=lambda d: (_ for _ in ()).throw(OSError("no file")))
    for day in DAYS[:2]:  # a failed re-run, and a failed run of the next day
        with pytest.raises(OSError):
            run_day(spark, wh, broken, day, CONFIG)
        assert state() == before
    run_day(spark, wh, inp, DAYS[2], CONFIG)  # the failed day is skipped: no trace of it
    versions = read_dimension(spark, wh, "cards", DAYS[2])
    assert versions.where(F.col("effective_to") == inf()).groupBy("card_num").count().where("count > 1").count() == 0


def test_history_keeps_only_committed_versions(spark, tmp_path):
    root = str(tmp_path / "w")
    ts = lambda d: dt.datetime(2024, 1, d)
    end = dt.datetime(9999, 12, 31)

    def write(day, rows, commit=True):
        run = Attempt(spark, root, dt.date(2024, 1, day))
        run.write_history("dim_cards_hist", spark.createDataFrame(rows, DIM_CARDS))
        if commit:
            run.commit([])

    write(1, [("k", "A", ts(1), end, "n")])
    write(2, [("k", "A", ts(1), ts(2), "n"), ("k", "B", ts(2), end, "n")], commit=False)
    write(3, [("k", "A", ts(1), ts(3), "n"), ("k", "C", ts(3), end, "n")])
    write(3, [("k", "A", ts(1), ts(3), "n"), ("k", "D", ts(3), end, "n")])  # a second attempt replaces the first
    write(4, [])
    commits = read_commits(spark, root)
    got = read_history(spark, root, "dim_cards_hist", DIM_CARDS, commits, dt.date(2024, 1, 3))
    assert sorted((r.account_num, r.effective_to) for r in got.collect()) == [("A", ts(3)), ("D", end)]
    later = read_history(spark, root, "dim_cards_hist", DIM_CARDS, commits, dt.date(2024, 1, 3), since=dt.date(2024, 1, 4))
    assert [r.account_num for r in later.collect()] == ["D"]
    assert read_current(spark, root, "dim_cards_hist", DIM_CARDS, commits, dt.date(2024, 1, 4)).count() == 0


def test_sources_are_staged_before_they_are_used(spark, tmp_path, loaded):
    """A source that changes while the run is on: what the merge saw is what the watermark counts."""
    _, inp = loaded
    wh = Warehouse(str(tmp_path / "w"))
    path = str(tmp_path / "cards")
    inp.cards.write.parquet(path)
    live = spark.read.parquet(path)
    late = inp.cards.limit(1).withColumn("card_num", F.lit("new")).withColumn(
        "update_dt", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))

    def change(d):
        late.write.mode("append").parquet(path)
        spark.catalog.refreshByPath(path)
        return inp.blacklist(d)

    run_day(spark, wh, dataclasses.replace(inp, cards=live, blacklist=change), DAYS[0], CONFIG)
    mark = read_commits(spark, wh.base).marks[DAYS[0]]["cards"]
    cards = read_dimension(spark, wh, "cards", DAYS[0]).where("trim(card_num) = 'new'").count()
    assert (cards > 0) == (mark.year == 2030)


def test_first_run_starts_from_the_seed(spark, tmp_path, loaded):
    _, inp = loaded
    wh = Warehouse(str(tmp_path / "w"))
    config = dataclasses.replace(CONFIG, fact_seed=DAYS[0] - dt.timedelta(days=1))
    assert run_day(spark, wh, inp, None, config) == DAYS[0]
    assert read_facts(spark, wh).columns == FACTS.names


def test_intake_archives_takes_second_files_and_keeps_strays(spark, tmp_path):
    from dayfold.streaming import start_intake

    drops = tmp_path / "drops"
    drops.mkdir()
    write_drops(spark, drops, DAYS[1:2])
    wh = Warehouse(str(tmp_path / "warehouse"))
    inp = inputs(spark, drops)
    cols = [f.name for f in TRANSACTIONS.fields]

    def intake():
        q = start_intake(spark, str(drops), wh, inp, str(tmp_path / "chk"), archive_dir=str(tmp_path / "archive"),
                         config=CONFIG)
        q.awaitTermination(300)
        assert q.exception() is None

    intake()
    before = fact_ids(spark, wh)
    row = lambda i, at: [i, at, "5", "1", "PAYMENT", "SUCCESS", "1"]
    write_drop(str(drops / f"transactions_more_{stamp(DAYS[1])}.txt"), cols, [row("second", "2024-01-19 12:00:00")])
    write_drop(str(drops / "transactions_nodate.txt"), cols, [row("stray", "2024-01-19 12:00:00")])
    write_drop(str(drops / f"transactions_{stamp(DAYS[0])}.txt"), cols, [row("old", "2024-01-18 12:00:00")])
    intake()
    assert fact_ids(spark, wh) == sorted([*before, "second"])
    strays = spark.read.parquet(f"{wh.base}/_stray_files")
    assert sorted(r.trans_id for r in strays.select("trans_id").collect()) == ["old", "stray"]
    assert sorted(read_commits(spark, wh.base).attempts) == [DAYS[1]]
    moved = {p.name for p in (tmp_path / "archive").rglob("*.txt")}
    assert f"transactions_{stamp(DAYS[1])}.txt" in moved


def test_bucketed_layout_holds_the_same_warehouse(spark, loaded, tmp_path):
    wh, inp = loaded
    other = Warehouse(str(tmp_path), layout="buckets", buckets=4)
    backfill(spark, other, inp, DAYS[:2], CONFIG)
    for name in ("cards", "accounts", "clients", "terminals"):
        want = read_dimension(spark, wh, name, DAYS[1])
        assert spark_rows(read_dimension(spark, other, name, DAYS[1]).select(*want.columns)) == spark_rows(want)
    want = read_report(spark, wh).where(F.col("report_dt").isin(DAYS[:2]))
    assert spark_rows(read_report(spark, other)) == spark_rows(want)


def test_files_of_a_day_are_united_by_name(spark):
    from dayfold.streaming.intake import STAGED, with_new_files

    def rows(*some):
        return spark.createDataFrame([(i, None, None, "1", None, "SUCCESS", "1", [], f) for i, f in some], STAGED)

    def ids(df):
        return sorted(((r.trans_id, r.source_file) for r in df.collect()), key=str)

    earlier = rows(("a", "one"), ("a", "one"), ("b", "two"), ("c", None), ("c", None), ("d", None))
    got = with_new_files(earlier, rows(("b", "two"), ("b2", "two"), ("c", "three")))
    assert ids(got) == sorted([("a", "one"), ("a", "one"), ("b", "two"), ("b2", "two"), ("c", "three"),
                                                ("c", None), ("d", None)], key=str)
    again = with_new_files(rows(("a", "one"), ("a", "one")), rows(("a", "one"), ("a", "one")))
    assert ids(again) == [("a", "one"), ("a", "one")]  # a replayed batch


def test_only_a_missing_folder_means_no_commits(spark, tmp_path):
    assert read_commits(spark, str(tmp_path)).last() is None
    (tmp_path / "_commits").mkdir()
    (tmp_path / "_commits" / "part-0.parquet").write_bytes(b"not a table")
    with pytest.raises(Exception):
        read_commits(spark, str(tmp_path))
