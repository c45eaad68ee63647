"""Readers: delimited drops (decimal comma, positional columns), workbooks, drop dates, capture."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType

from dayfold.schemas import BLACKLIST_FILE, TERMINALS, TRANSACTIONS
from dayfold.sources import capture_increment, capture_keys, drop_date, read_delimited_drop, read_workbook_drop
from helpers import write_drop, write_xlsx


def test_decimal_comma_and_positional_columns(spark, tmp_path):
    p = tmp_path / "transactions_01032021.txt"
    p.write_text("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
                 "1;2021-03-01 00:00:10;1234,56;5902 1;PAYMENT;SUCCESS;P1\n"
                 "2;2021-03-01 00:00:11;7,5;5902 1;WITHDRAW;REJECT;P1\n"
                 "3;garbage;abc;5902 1;WITHDRAW;REJECT;P1\n")
    df = read_delimited_drop(spark, str(p), TRANSACTIONS, with_file=True)
    rows = sorted(df.collect(), key=lambda r: r.trans_id)
    assert rows[0].amt == Decimal("1234.56") and rows[1].amt == Decimal("7.50")
    assert rows[0].trans_date == dt.datetime(2021, 3, 1, 0, 0, 10)
    assert rows[2].amt is None and rows[2].trans_date is None  # dirty cells become NULL, the load goes on
    assert dict(df.dtypes)["amt"] == "decimal(18,2)" and dict(df.dtypes)["trans_date"] == "timestamp_ntz"
    assert df.select(drop_date("source_file")).distinct().collect()[0][0] == dt.date(2021, 3, 1)


def test_workbook_sheet_by_name_positional(spark, tmp_path):
    write_xlsx(str(tmp_path / "terminals_01032021.xlsx"), "terminals",
               [["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
                ["P1", "POS", "Moscow", "Red sq. 1"], ["A2", "ATM", "Kazan", None]])
    write_xlsx(str(tmp_path / "passport_blacklist_01032021.xlsx"), "blacklist",
               [["date", "passport"], [44256, "1234 567890"], ["2021-02-27", "9999 000000"]])
    t = read_workbook_drop(spark, str(tmp_path / "terminals_*.xlsx"), "terminals", TERMINALS)
    assert sorted(tuple(r)[:4] for r in t.collect()) == [("A2", "ATM", "Kazan", None), ("P1", "POS", "Moscow", "Red sq. 1")]
    b = read_workbook_drop(spark, str(tmp_path / "passport_*.xlsx"), "blacklist", BLACKLIST_FILE)
    got = sorted((r.passport_num, r.entry_dt) for r in b.collect())
    assert got == [("1234 567890", dt.date(2021, 3, 1)), ("9999 000000", dt.date(2021, 2, 27))]


def test_capture_increment_and_keys(spark):
    rows = [("c1", dt.datetime(2021, 2, 1), None), ("c2", dt.datetime(2021, 2, 1), dt.datetime(2021, 3, 1, 5)),
            ("c3", dt.datetime(2021, 3, 1, 0, 0, 1), None), ("c3", dt.datetime(2021, 2, 1), None)]
    df = spark.createDataFrame(rows, "card_num string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    inc = capture_increment(df, dt.date(2021, 3, 1))
    assert sorted(r.card_num for r in inc.collect()) == ["c2", "c3"]
    assert sorted(r.card_num for r in capture_keys(df, "card_num").collect()) == ["c1", "c2", "c3"]
    plan = inc._jdf.queryExecution().optimizedPlan().toString()
    assert "2021-03-01 00:00:00" in plan  # the watermark is a literal in the filter


def test_write_drop_helper_round_trip(spark, tmp_path):
    p = tmp_path / "transactions_02032021.txt"
    write_drop(str(p), [f.name for f in TRANSACTIONS.fields],
               [["9", "2021-03-02 10:00:00", Decimal("12.30"), "C", "PAY", "SUCCESS", "T"]])
    r = read_delimited_drop(spark, str(p), TRANSACTIONS).first()
    assert r.amt == Decimal("12.30") and r.trans_id == "9"
    assert read_delimited_drop(spark, str(p), TRANSACTIONS).where(F.col("amt") > 12).count() == 1


SHEET = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData>'
         '</worksheet>')


def write_sheet(path, rows, date1904=False, shared=None):
    """A workbook with the given row XML (and shared strings), for cells that ``write_xlsx`` doesn't make."""
    import zipfile

    write_xlsx(path, "s", [])
    with zipfile.ZipFile(path) as z:
        files = {n: z.read(n).decode() for n in z.namelist()}
    files["xl/worksheets/sheet1.xml"] = SHEET.format("".join(f"<row>{r}</row>" for r in rows))
    if date1904:
        files["xl/workbook.xml"] = files["xl/workbook.xml"].replace("<sheets>", '<workbookPr date1904="1"/><sheets>')
    if shared:
        files["xl/sharedStrings.xml"] = ('<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                                         f"{shared}</sst>")
    with zipfile.ZipFile(path, "w") as z:
        for n, text in files.items():
            z.writestr(n, text)


def test_workbook_times_are_exact_to_the_second(spark, tmp_path):
    start = dt.datetime(2021, 3, 1)
    times = [start + dt.timedelta(seconds=s) for s in range(0, 86400, 37)]
    serial = [(t - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1) for t in times]
    write_sheet(str(tmp_path / "w.xlsx"), ["<c><v>h</v></c>", *(f"<c><v>{x!r}</v></c>" for x in serial)])
    got = read_workbook_drop(spark, str(tmp_path / "w.xlsx"), "s", StructType([StructField("at", TimestampNTZType())]))
    assert sorted(r["at"] for r in got.collect()) == times


def test_workbook_cells_without_reference_1904_dates_phonetics_and_text_dates(spark, tmp_path):
    schema = StructType([StructField("name", StringType()), StructField("day", DateType()), StructField("at", TimestampNTZType())])
    path = str(tmp_path / "w.xlsx")
    write_sheet(path, ["<c/><c/>", '<c t="s"><v>0</v></c><c><v>1</v></c><c r="C2"><v>1.5</v></c>',
                       '<c t="inlineStr"><is><t>x</t></is></c><c t="str"><v>20210301</v></c>', ""], date1904=True,
                shared="<si><r><t>Ab</t></r><rPh><t>zz</t></rPh></si>")
    got = [tuple(r)[:3] for r in read_workbook_drop(spark, path, "s", schema).collect()]
    assert got == [("Ab", dt.date(1904, 1, 2), dt.datetime(1904, 1, 2, 12)), ("x", None, None), (None, None, None)]


def test_bad_cells_are_listed(spark, tmp_path):
    p = tmp_path / "transactions_01032021.txt"
    p.write_text("h;h;h;h;h;h;h\n1;01.03.2021 10:00:00;1.234,56;c;P;S;T\n2;2021-03-01 10:00:00;1 234,56;c;P;S;T\n3;;;c;P;S;T\n")
    rows = read_delimited_drop(spark, str(p), TRANSACTIONS, bad_cells=True).orderBy("trans_id").collect()
    assert [r.bad_cells for r in rows] == [["trans_date=01.03.2021 10:00:00", "amt=1.234,56"], [], []]
    assert rows[1].amt == Decimal("1234.56")


def test_a_name_without_a_date_gives_null(spark):
    df = spark.createDataFrame([("transactions_01032021.txt",), ("transactions.txt",), ("x_99999999.txt",), (None,)], "f string")
    assert [r[0] for r in df.select(drop_date("f")).collect()] == [dt.date(2021, 3, 1), None, None, None]
