"""Reading and writing transaction files."""

import pytest

from ledgersieve.fixed_values import CSV_HEADER, TRANSACTION_FIELDS
from ledgersieve.operators.cleanse import cleanse
from ledgersieve.operators.ranges import label_ranges, range_bounds
from ledgersieve.plans.outputs import stage_results
from ledgersieve.plans.validation import check_lines
from ledgersieve.sources.generated import generate_range
from ledgersieve.sources.transactions import (
    rescue_short_lines, resolve_input, scan_transactions, with_line_id, write_transaction_files,
)

from .helpers import GOLDEN, HEADER, golden_line, write_csv

LINES = [
    'A1,0987654321,N,BNI,1,M,BCA,IDR,10,TRANSFER,"note, with comma"',
    'A2,0987654321,N,BNI,1,M,BCA,IDR,10,TRANSFER,"say ""hi"" \\ there"',
    "A3,0987654321,N,BNI,1,M,BCA,IDR,10,TRANSFER",
    'A4,0987654321,"N, Jr",BNI,1,M,BCA,IDR,10,TRANSFER',
    "A5,0987654321,N,BNI,1,M,BCA,IDR,10",
    "A6,0987654321,N,BNI,1,M,BCA,IDR,10,TRANSFER,x,y",
    " A7 ,\t0987654321, N ,BNI ,1,M,BCA,IDR, 10 ,TRANSFER,  ",
    "A8,,N,BNI,1,M,BCA,IDR,,TRANSFER,",
]


def test_header_names():
    assert ",".join(CSV_HEADER) == HEADER


def test_short_long_and_quoted_lines(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", LINES)
    rows = {(r.referenceId or "").strip(): r for r in rescue_short_lines(scan_transactions(spark, path)).collect()}
    assert len(rows) == 8
    assert rows["A1"].note == "note, with comma" and rows["A1"]._corrupt is None
    assert rows["A2"].note == 'say "hi" \\ there'
    assert rows["A3"].note is None and rows["A3"].transactionType == "TRANSFER" and rows["A3"]._corrupt is None
    assert rows["A4"].sourceAccountName == "N, Jr" and rows["A4"]._corrupt is None
    assert rows["A5"]._corrupt == LINES[4]
    assert rows["A6"]._corrupt == LINES[5]
    assert rows["A8"].sourceAccount is None


def test_cleanse(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", LINES)
    rows = {r.referenceId: r for r in cleanse(rescue_short_lines(scan_transactions(spark, path))).collect()}
    seventh = rows["A7"]
    assert (seventh.sourceAccount, seventh.sourceAccountName, seventh.amount_text, seventh.note) == (
        "0987654321", "N", "10", "",
    )
    assert rows["A3"].note == "" and rows["A8"].sourceAccount == "" and rows["A8"].amount == 0
    assert rows["A1"].valid is True and rows["A1"].validationErrors is None


def test_no_line_is_left_out(spark, references, tmp_path):
    path = write_csv(tmp_path / "in.csv", LINES)
    rows = check_lines(with_line_id(scan_transactions(spark, path)), references).collect()
    outcomes = {r.referenceId: r.outcome for r in rows}
    assert sorted(r.line_id for r in rows) == list(range(8))
    assert outcomes["A5"] == outcomes["A6"] == "quarantined"
    assert {r.validationErrors for r in rows if r.outcome == "quarantined"} == {None}
    assert [o for o in outcomes.values()].count("quarantined") == 2


def test_each_file_of_a_directory_has_a_header(spark, tmp_path):
    for i in range(3):
        write_csv(tmp_path / "in" / f"{i}.csv", [golden_line(r) for r in GOLDEN])
    assert scan_transactions(spark, str(tmp_path / "in")).count() == 39
    assert scan_transactions(spark, str(tmp_path / "in" / "[01].csv")).count() == 26


def test_input_path(spark):
    assert resolve_input("a", "b") == "a" and resolve_input("  ", "b") == "b" and resolve_input(None, "b") == "b"
    with pytest.raises(ValueError):
        resolve_input(None, None)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_transactions(spark, "/no/such/file.csv")


def test_round_trip_of_generated_rows(spark, tmp_path):
    made = generate_range(spark, 500)
    write_transaction_files(made, str(tmp_path / "out"), 100)
    back = scan_transactions(spark, str(tmp_path / "out")).fillna("").select(*TRANSACTION_FIELDS)
    assert sorted(back.collect()) == sorted(made.select(*TRANSACTION_FIELDS).collect())
    assert len(spark.read.text(str(tmp_path / "out")).inputFiles()) >= 5


def test_fault_shares_and_seed(spark):
    rows = generate_range(spark, 20_000)
    counts = {r.fault: r["count"] for r in rows.groupBy("fault").count().collect()}
    faulty = sum(n for fault, n in counts.items() if fault)
    assert abs(faulty / 20_000 - 0.15) < 0.01
    for fault, share in (("bank_code", 0.30), ("inactive", 0.25), ("blocked", 0.15), ("unknown", 0.20), ("below_minimum", 0.10)):
        assert abs(counts[fault] / faulty - share) < 0.03
    assert generate_range(spark, 100, invalid_rate=7).filter("fault IS NULL").count() == 0
    assert generate_range(spark, 100, invalid_rate=-1).filter("fault IS NOT NULL").count() == 0
    one, two = (generate_range(spark, 100, seed=s).select("amount").collect() for s in (1, 2))
    assert one != two and one == generate_range(spark, 100, seed=1).select("amount").collect()


def test_generated_faults_fail_for_their_reason(spark, references):
    from ledgersieve.plans.validation import validate_transactions

    text = {
        "bank_code": "is not a recognised bank code", "inactive": "(INACTIVE)", "blocked": "(BLOCKED)",
        "unknown": "(NOT_FOUND)", "below_minimum": "is below the minimum",
    }
    rows = validate_transactions(cleanse(generate_range(spark, 5_000)), references).select("fault", "validationErrors")
    for row in rows.collect():
        if row.fault is None:
            assert row.validationErrors is None
        else:
            assert text[row.fault] in row.validationErrors


def test_ranges_follow_the_order_of_files_and_lines(spark, references, tmp_path, conf):
    """Spark packs large files first; ranges go by name and line all the same, for any number of tasks."""
    sizes = {"a": 3, "b": 30, "c": 2}
    for name, size in sizes.items():
        line = golden_line(GOLDEN[0])
        write_csv(tmp_path / "in" / f"{name}.csv", [line.replace(GOLDEN[0][0], f"{name}{i:02}") for i in range(size)])
    expected = {f"{n}{i:02}": place // 4 for place, (n, i) in enumerate((n, i) for n, s in sizes.items() for i in range(s))}
    for split in ("128m", "300"):
        conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
        lines = with_line_id(scan_transactions(spark, str(tmp_path / "in")))
        stored = stage_results(check_lines(lines, references), str(tmp_path / f"out-{split}"), "r")
        assert {r.referenceId: r.partition for r in label_ranges(stored, 9).collect()} == expected
        bounds = sorted(tuple(r) for r in range_bounds(label_ranges(stored, 9)).collect())
        assert bounds == [(p * 4 + 2, min(p * 4 + 5, 36), p) for p in range(9)]
