"""The stand-alone validators and the lookups."""

import pytest

from ledgersieve import schemas
from ledgersieve.operators.cleanse import cleanse
from ledgersieve.operators.lookups import limit_by_type, rows_with_known_account, rows_with_unknown_bank
from ledgersieve.operators.validators import (
    check_batches, validate_accounts, validate_accounts_in_bulk, validate_amounts, validate_bank_codes,
)
from ledgersieve.plans.validation import References, validate_transactions
from ledgersieve.sources.dimensions import (
    bank_lookup, duplicate_accounts, first_wins, local_table, read_accounts, read_banks, read_limits,
)

from .helpers import raw_frame


def test_bank_codes(spark, references):
    df = spark.createDataFrame([("BCA",), ("bca",), ("UNKNOWN_BANK",), ("",)], "bank string")
    rows = {tuple(r) for r in validate_bank_codes(df, references.banks, "bank").collect()}
    assert rows == {
        ("BCA", True, "Bank Central Asia"), ("UNKNOWN_BANK", False, None), ("", False, None),
    }
    assert references.banks.count() == 10


def test_column_may_already_be_called_code(spark, references):
    df = spark.createDataFrame([(1, "bni")], "id int, code string")
    assert validate_bank_codes(df, references.banks, "code").first() == (1, "BNI", True, "Bank Negara Indonesia")


def test_amounts(spark, references):
    df = spark.createDataFrame(
        [("TRANSFER", "500000"), ("TRANSFER", "5000"), ("TRANSFER", "2000000000"), ("UNKNOWN_TYPE", "100000"),
         ("withdrawal", "50000.00")],
        "type string, amount string",
    )
    rows = {(r.type, str(r.amount).rstrip("0").rstrip(".")): (r.valid, r.reason)
            for r in validate_amounts(df, references.limits, "type", "amount").collect()}
    assert rows == {
        ("TRANSFER", "500000"): (True, None),
        ("TRANSFER", "5000"): (False, "Amount 5000 is below the minimum of 10000 for type 'TRANSFER'."),
        ("TRANSFER", "2000000000"): (False, "Amount 2000000000 exceeds the maximum of 1000000000 for type 'TRANSFER'."),
        ("UNKNOWN_TYPE", "100000"): (False, "Transaction type 'UNKNOWN_TYPE' is not configured."),
        ("withdrawal", "50000"): (True, None),
    }
    assert references.limits.count() == 4


def test_negative_rest_against_a_zero_minimum(spark):
    limits = local_table(spark, schemas.LIMITS, [("T", "0", "10.00", "X", 0)])
    df = spark.createDataFrame([("T", "-1e-30"), ("T", "0"), ("T", "10.0000000000000000001")], "type string, amount string")
    rows = {r.reason for r in validate_amounts(df, limits, "type", "amount").collect()}
    assert rows == {
        None,
        "Amount -1E-30 is below the minimum of 0 for type 'T'.",
        "Amount 10.0000000000000000001 exceeds the maximum of 10.00 for type 'T'.",
    }


ACCOUNTS = [
    ("1234567890", "BCA", True, "ACTIVE", "Budi Santoso", None),
    ("6677889900", "CIMB", False, "INACTIVE", "Rudi Hermawan", "Account is INACTIVE."),
    ("3344556677", "PERMATA", False, "BLOCKED", "Hendra Gunawan", "Account is BLOCKED."),
    ("0000000000", "BCA", False, "NOT_FOUND", None, "Account number '0000000000' not found for bank 'BCA'."),
    ("1234567890", "BNI", False, "NOT_FOUND", None, "Account number '1234567890' not found for bank 'BNI'."),
]


def test_accounts(spark, references):
    df = spark.createDataFrame([a[:2] for a in ACCOUNTS], "number string, bank string")
    rows = {(r.accountNumber, r.bankCode): (r.valid, r.status, r.accountName, r.reason)
            for r in validate_accounts(df, references.accounts, "number", "bank").collect()}
    assert rows == {a[:2]: a[2:] for a in ACCOUNTS}


def test_account_bank_without_case(spark, references):
    df = spark.createDataFrame([("1234567890", "bca")], "number string, bank string")
    row = validate_accounts(df, references.accounts, "number", "bank").first()
    assert (row.valid, row.bankCode) == (True, "BCA")


def bulk(spark, references, rows):
    df = spark.createDataFrame(rows, "batch int, position int, number string, bank string")
    out = validate_accounts_in_bulk(df, references.accounts, "batch", "position", "number", "bank")
    return {r.batch: r for r in out.collect()}


def test_bulk_counts_and_order(spark, references):
    out = bulk(spark, references, [
        (1, 3, "0000000000", "BCA"), (1, 0, "1234567890", "BCA"), (1, 2, "6677889900", "CIMB"),
        (1, 1, "0987654321", "BNI"),
        (2, 0, "1234567890", "BCA"), (2, 1, "0987654321", "BNI"), (2, 2, "1122334455", "BRI"),
    ])
    assert (out[1].accepted, out[1].totalRequested, out[1].totalValid, out[1].totalInvalid) == (True, 4, 2, 2)
    assert [r.status for r in out[1].results] == ["ACTIVE", "ACTIVE", "INACTIVE", "NOT_FOUND"]
    assert (out[2].totalValid, out[2].totalInvalid) == (3, 0)


def test_bulk_contract(spark, references):
    out = bulk(spark, references, [
        *[(1, i, "1234567890", "BCA") for i in range(100)],
        *[(2, i, "1234567890", "BCA") for i in range(101)],
        (3, 0, "1234567890", " "),
        *[(4, i, "1234567890", "BCA") for i in range(5000)],
    ])
    assert {b: (r.accepted, r.totalRequested, r.totalValid) for b, r in out.items()} == {
        1: (True, 100, 100), 2: (False, 101, None), 3: (False, 1, None), 4: (False, 5000, None),
    }
    assert out[2].results is None and len(out[1].results) == 100


def test_check_batches(spark):
    df = spark.createDataFrame([(1, "1", "B"), (1, "", "B"), (2, "1", "B")], "batch int, number string, bank string")
    rows = {r.batch: (r.size, r.blank_entries, r.accepted) for r in check_batches(df, "batch", "number", "bank").collect()}
    assert rows == {1: (2, 1, False), 2: (1, 0, True)}


def test_semi_and_anti(spark, references):
    df = spark.createDataFrame([(1, "1234567890", "bca"), (2, "1", "BCA"), (3, "1", "OVO")], "id int, n string, b string")
    assert {r.id for r in rows_with_unknown_bank(df, references.banks, "b").collect()} == {3}
    assert {r.id for r in rows_with_known_account(df, references.accounts, "n", "b").collect()} == {1}


def test_limit_by_type(spark, references):
    assert limit_by_type(references.limits, "topup").collect() == [("TOPUP", "10000", "50000000", "IDR")]
    assert limit_by_type(references.limits, "REFUND").collect() == []


def test_first_wins(spark):
    banks = local_table(spark, schemas.BANKS, [("aa", "second", 2), ("AA", "first", 1), ("b", "only", 3)])
    assert {tuple(r) for r in bank_lookup(banks).collect()} == {("AA", "AA", "first"), ("B", "b", "only")}
    hot = spark.range(0, 10_000, 1, 8).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id AS ord")
    rows = {r.k: r.ord for r in first_wins(hot, ["k"], "ord").collect()}
    assert rows["hot"] == 0 and len(rows) == 1 + 6666


def test_duplicate_accounts(spark, references):
    more = references.accounts.union(local_table(spark, schemas.ACCOUNTS, [("1234567890", "X", "bca", "BLOCKED")]))
    assert duplicate_accounts(references.accounts).count() == 0
    assert duplicate_accounts(more).collect() == [("1234567890", "BCA", 2)]


def test_reference_tables_from_files(spark, tmp_path):
    (tmp_path / "banks.csv").write_text("code,name,ord\nBCA,Bank Central Asia,0\n")
    (tmp_path / "limits.csv").write_text("transactionType,minAmount,maxAmount,currency,ord\nT,10.50,99,IDR,0\n")
    accounts = local_table(spark, schemas.ACCOUNTS, [("0987654321", "Siti", "BNI", "ACTIVE")])
    accounts.write.parquet(str(tmp_path / "accounts"))
    assert read_banks(spark, str(tmp_path / "banks.csv")).collect() == [("BCA", "Bank Central Asia", 0)]
    assert read_limits(spark, str(tmp_path / "limits.csv")).first().minAmount == "10.50"
    assert read_accounts(spark, str(tmp_path / "accounts")).first().accountNumber == "0987654321"


def test_bulk_goes_by_the_number_of_entries(spark, references):
    out = bulk(spark, references, [
        *[(1, i, "1234567890", "BCA") for i in range(1, 101)],
        *[(2, i, "1234567890", "BCA") for i in (500, 502, 507)],
        *[(3, 0, "1234567890", "BCA") for _ in range(5000)],
        *[(4, 7, n, "BCA") for n in ("1234567890", "0000000000")],
    ])
    assert {b: (r.accepted, r.totalRequested, r.totalValid) for b, r in out.items()} == {
        1: (True, 100, 100), 2: (True, 3, 3), 3: (False, 5000, None), 4: (True, 2, 1),
    }
    assert max(len(r.results or []) for r in out.values()) == 100


def test_amounts_beyond_the_decimal_column(spark, references):
    texts = ["1" + "0" * 25, "-1" + "0" * 25, "10000." + "0" * 18 + "7"]
    rows = spark.createDataFrame([("TRANSFER", t) for t in texts], "transactionType string, amount string")
    found = {r.amount_text: r for r in validate_amounts(rows, references.limits, "transactionType", "amount").collect()}
    assert set(found) == set(texts)
    assert found[texts[0]].amount is None and "exceeds the maximum" in found[texts[0]].reason
    assert found[texts[1]].amount is None and "below the minimum" in found[texts[1]].reason
    assert found[texts[2]].valid


def test_duplicate_account_raises_in_every_action(spark, references, tmp_path):
    """Also where no column of the account is used; frames are built without a job."""
    twice = references.accounts.union(local_table(spark, schemas.ACCOUNTS, [("1234567890", "X", "bca", "ACTIVE")]))
    rows = spark.createDataFrame([("1234567890", "BCA"), ("other", "BCA")], "number string, bank string")
    context = spark.sparkContext
    context.setJobGroup("building", "")
    frames = [use(rows, twice, "number", "bank") for use in (validate_accounts, rows_with_known_account)]
    assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    context.setJobGroup("acting", "")
    for frame in frames:
        for action in (lambda f: f.count(), lambda f: f.select("*").collect(), lambda f: f.selectExpr("1").collect(), lambda f: f.isEmpty()):
            with pytest.raises(Exception, match="Duplicate account key 1234567890:BCA"):
                action(frame)


def test_a_table_that_changes_is_checked_when_it_is_read(spark, references, tmp_path):
    path = str(tmp_path / "accounts")
    references.accounts.write.parquet(path)
    rows = spark.createDataFrame([("1234567890", "BCA")], "number string, bank string")
    checked = validate_accounts(rows, read_accounts(spark, path), "number", "bank")
    assert checked.count() == 1
    local_table(spark, schemas.ACCOUNTS, [("1234567890", "X", "bca", "ACTIVE")]).write.mode("append").parquet(path)
    with pytest.raises(Exception, match="Duplicate account key 1234567890:BCA"):
        validate_accounts(rows, read_accounts(spark, path), "number", "bank").count()


def test_keys_are_counted_once_for_both_lookups(spark, references, tmp_path):
    path = str(tmp_path / "accounts")
    references.accounts.write.parquet(path)
    accounts = read_accounts(spark, path)
    clean = cleanse(raw_frame(spark, [{}]))
    checked = validate_transactions(clean, References(references.banks, references.limits, accounts))
    assert checked.collect()[0].valid
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "ReusedSubquery" in plan


def test_accounts_are_joined_without_an_aggregate(spark, references, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rows = spark.createDataFrame([("1234567890", "BCA")], "number string, bank string")
    joined = validate_accounts(rows, references.accounts, "number", "bank")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Aggregate" not in plan
    assert joined.first().status == "ACTIVE"
