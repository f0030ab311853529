"""The transaction check: the 13 known rows, every edge case, and the plan."""

import pytest

from ledgersieve.operators.cleanse import cleanse
from ledgersieve.operators.rules import Rule, count_rule_hits
from ledgersieve.plans.validation import References, look_up, transaction_rules, validate_transactions
from ledgersieve.sources.dimensions import local_table
from ledgersieve.sources.transactions import rescue_short_lines, scan_transactions
from ledgersieve import schemas

from .helpers import GOLDEN, check, golden_line, raw_frame, write_csv


def test_golden_rows(spark, references, tmp_path):
    path = write_csv(tmp_path / "in.csv", [golden_line(r) for r in GOLDEN])
    rows = validate_transactions(cleanse(rescue_short_lines(scan_transactions(spark, path))), references).collect()
    found = {r.referenceId: (r.valid, r.validationErrors) for r in rows}
    assert found == {r[0]: (r[-1] is None, r[-1]) for r in GOLDEN}
    assert len(rows) == 13


NO_RESULT = "account validation service returned no results"
CASES = [
    ({"amount": "abc"}, "amount 0 is below the minimum for TRANSFER"),
    ({"amount": ""}, "amount 0 is below the minimum for TRANSFER"),
    ({"amount": None}, "amount 0 is below the minimum for TRANSFER"),
    ({"amount": "10000"}, None),
    ({"amount": "1000000000"}, None),
    ({"amount": "9999.99999"}, "amount 9999.99999 is below the minimum for TRANSFER"),
    ({"amount": "9999.9999999999999999999999"}, "amount 9999.9999999999999999999999 is below the minimum for TRANSFER"),
    ({"amount": "1000000000.0000000000000000000001"},
     "amount 1000000000.0000000000000000000001 is below the minimum for TRANSFER"),
    ({"amount": "1000000001"}, "amount 1000000001 is below the minimum for TRANSFER"),
    ({"amount": "1" + "0" * 60}, "amount 1" + "0" * 60 + " is below the minimum for TRANSFER"),
    ({"amount": "1e999999999"}, "amount 1E+999999999 is below the minimum for TRANSFER"),
    ({"amount": "1e5"}, None),
    ({"amount": "-500000"}, "amount -500000 is below the minimum for TRANSFER"),
    ({"transactionType": "REFUND"}, "amount 500000 is below the minimum for REFUND"),
    ({"transactionType": ""}, "amount 500000 is below the minimum for "),
    ({"transactionType": "transfer", "sourceBankCode": "bca", "beneficiaryBankCode": "bni"}, None),
    ({"sourceAccount": ""}, NO_RESULT),
    ({"beneficiaryAccount": " \t"}, NO_RESULT),
    ({"sourceBankCode": ""}, f"sourceBankCode '' is not a recognised bank code; {NO_RESULT}"),
    ({"beneficiaryBankCode": None, "amount": "1"},
     f"beneficiaryBankCode '' is not a recognised bank code; amount 1 is below the minimum for TRANSFER; {NO_RESULT}"),
    # same number: the result of the source counts for both sides
    ({"beneficiaryAccount": "1234567890", "beneficiaryBankCode": "BNI"}, None),
    ({"sourceBankCode": "XENDIT", "beneficiaryAccount": "1234567890", "beneficiaryBankCode": "BCA"},
     "sourceBankCode 'XENDIT' is not a recognised bank code; sourceAccount '1234567890' is invalid (NOT_FOUND); "
     "beneficiaryAccount '1234567890' is invalid (NOT_FOUND)"),
    ({"sourceAccount": "4444555566", "sourceBankCode": "BNI", "beneficiaryAccount": "4444555566",
      "beneficiaryBankCode": "OVO"},
     "beneficiaryBankCode 'OVO' is not a recognised bank code; sourceAccount '4444555566' is invalid (INACTIVE); "
     "beneficiaryAccount '4444555566' is invalid (INACTIVE)"),
    # every failure is kept, in a fixed order
    ({"sourceBankCode": "OVO", "beneficiaryBankCode": "DANA", "amount": "9.50", "transactionType": "topup"},
     "sourceBankCode 'OVO' is not a recognised bank code; beneficiaryBankCode 'DANA' is not a recognised bank code; "
     "amount 9.50 is below the minimum for topup; sourceAccount '1234567890' is invalid (NOT_FOUND); "
     "beneficiaryAccount '0987654321' is invalid (NOT_FOUND)"),
    ({"currency": "USD"}, None),
    ({"sourceAccount": "  1234567890\x01", "amount": "\t500000 ", "transactionType": " TRANSFER\r"}, None),
    ({"sourceAccount": "987654321"}, "sourceAccount '987654321' is invalid (NOT_FOUND)"),
]


def test_edge_rows(spark, references):
    rows = check(spark, references, [case for case, _ in CASES])
    assert [r.validationErrors for r in rows] == [errors for _, errors in CASES]
    assert [r.valid for r in rows] == [errors is None for _, errors in CASES]


def test_reason_of_amount_failure(spark, references):
    rows = check(spark, references, [
        {}, {"amount": "1"}, {"amount": "1000000000.5"}, {"transactionType": "REFUND"}, {"amount": "1e-7"},
    ])
    assert [r.amount_reason for r in rows] == [
        None,
        "Amount 1 is below the minimum of 10000 for type 'TRANSFER'.",
        "Amount 1000000000.5 exceeds the maximum of 1000000000 for type 'TRANSFER'.",
        "Transaction type 'REFUND' is not configured.",
        "Amount 1E-7 is below the minimum of 10000 for type 'TRANSFER'.",
    ]


def test_status_is_compared_and_shown_in_upper_case(spark, references):
    accounts = local_table(spark, schemas.ACCOUNTS, [
        ("1", "A", "bca", "active"), ("2", "B", "BNI", "Suspended"),
    ])
    mixed = References(references.banks, references.limits, accounts)
    row = check(spark, mixed, [{"sourceAccount": "1", "beneficiaryAccount": "2"}])[0]
    assert row.validationErrors == "beneficiaryAccount '2' is invalid (SUSPENDED)"


def test_duplicate_dimension_rows_do_not_multiply_transactions(spark, references):
    banks = references.banks.union(local_table(spark, schemas.BANKS, [("bca", "Second", 99)]))
    limits = references.limits.union(local_table(spark, schemas.LIMITS, [("Transfer", "1", "2", "X", 99)]))
    rows = check(spark, References(banks, limits, references.accounts), [{}, {}])
    assert [r.valid for r in rows] == [True, True]


def test_duplicate_account_fails_the_query(spark, references):
    twice = references.accounts.union(local_table(spark, schemas.ACCOUNTS, [("1234567890", "X", "bca", "ACTIVE")]))
    with pytest.raises(Exception, match="Duplicate account key 1234567890:BCA"):
        check(spark, References(references.banks, references.limits, twice), [{}])


def test_own_rules(spark, references):
    rules = [Rule("odd", "amount % 2 = 1", "concat('odd ', amount_text)"), Rule("unknown", "CAST(NULL AS BOOLEAN)", "'x'")]
    clean = cleanse(raw_frame(spark, [{"amount": "3"}, {"amount": "4"}]))
    rows = validate_transactions(clean, references, rules).orderBy("amount").collect()
    assert [(r.valid, r.validationErrors) for r in rows] == [(False, "odd 3"), (True, None)]
    hits = count_rule_hits(look_up(clean, references), transaction_rules()).collect()
    assert {r.rule: r.hits for r in hits}["amount"] == 2


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_no_python_and_no_nested_loop(spark, references, tmp_path):
    path = write_csv(tmp_path / "in.csv", [golden_line(r) for r in GOLDEN])
    plan = plan_of(validate_transactions(cleanse(scan_transactions(spark, path)), references))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin"):
        assert node not in plan
    assert plan.count("BroadcastHashJoin") == 5


def test_only_needed_columns_are_scanned(spark, references, tmp_path):
    path = write_csv(tmp_path / "in.csv", [golden_line(r) for r in GOLDEN])
    plan = plan_of(scan_transactions(spark, path).filter("currency = 'IDR'").select("referenceId"))
    assert "ReadSchema: struct<referenceId:string,currency:string>" in plan
    assert "EqualTo(currency,IDR)" in plan


def test_hot_accounts_are_split_when_accounts_are_not_broadcast(spark, references, conf):
    """A third of the rows have one source and two fifths one beneficiary; both joins split them."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="10KB",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="30KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    rows = spark.range(0, 30_000, 1, 8).selectExpr(
        "CAST(id AS STRING) AS referenceId",
        "IF(id % 3 = 0, '1234567890', CAST(id AS STRING)) AS sourceAccount", "'A' AS sourceAccountName",
        "IF(id % 3 = 0 OR id % 2 = 0, 'BCA', 'BNI') AS sourceBankCode",
        "IF(id % 5 < 2, '0987654321', concat('b', id)) AS beneficiaryAccount", "'B' AS beneficiaryAccountName",
        "IF(id % 5 < 2, 'BNI', 'bri') AS beneficiaryBankCode", "'IDR' AS currency", "'500000' AS amount",
        "IF(id % 2 = 0, 'TRANSFER', 'TOPUP') AS transactionType", "'' AS note",
    )
    others = spark.range(0, 20_000).selectExpr("concat('x', id)", "'N'", "IF(id % 2 = 0, 'BCA', 'BRI')", "'ACTIVE'")
    accounts = references.accounts.union(others)
    checked = validate_transactions(cleanse(rows), References(references.banks, references.limits, accounts))
    found = checked.select("referenceId", "valid", "validationErrors").collect()
    assert plan_of(checked.select("valid")).count("BroadcastHashJoin") == 3
    ids = [int(r.referenceId) for r in found]
    assert sorted(ids) == list(range(30_000))
    assert {int(r.referenceId) for r in found if r.valid} == {i for i in range(30_000) if i % 3 == 0 and i % 5 < 2}

    out = checked.select("referenceId", "valid", "validationErrors")
    out.collect()
    assert plan_of(out).split("Initial Plan")[0].count("SortMergeJoin(skew=true)") == 2


def test_account_table_is_shuffled_once_for_both_sides(spark, references, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    from ledgersieve.operators.lookups import join_account

    clean = cleanse(raw_frame(spark, [{}]))
    df = join_account(clean, references.accounts, "sourceAccount", "sourceBankCode", "_s_")
    df = join_account(df, references.accounts, "beneficiaryAccount", "beneficiaryBankCode", "_b_")
    df = df.select("referenceId", "_s_status", "_b_status")
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_accounts_by_line_give_the_same_result(spark, references, tmp_path, conf):
    """A third of the rows have one source, two fifths one beneficiary; some have the same account twice, or blanks."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="10KB",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="30KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    rows = spark.range(0, 30_000, 1, 8).selectExpr(
        "CAST(id AS STRING) AS referenceId",
        "IF(id % 3 = 0, '1234567890', IF(id % 7 = 1, 'x5', CAST(id AS STRING))) AS sourceAccount", "'A' AS sourceAccountName",
        "IF(id % 3 = 0 OR id % 2 = 0, 'BCA', 'BNI') AS sourceBankCode",
        "IF(id % 5 < 2, '0987654321', IF(id % 7 < 3, 'x5', IF(id % 11 = 0, ' ', concat('x', id)))) AS beneficiaryAccount",
        "'B' AS beneficiaryAccountName", "IF(id % 5 < 2, 'BNI', 'bri') AS beneficiaryBankCode", "'IDR' AS currency",
        "'500000' AS amount", "IF(id % 2 = 0, 'TRANSFER', 'TOPUP') AS transactionType", "'' AS note",
    )
    rows.write.parquet(str(tmp_path / "rows"))
    others = spark.range(0, 20_000).selectExpr(
        "concat('x', id)", "'N'", "IF(id % 2 = 0, 'BCA', 'BRI')", "CASE id % 3 WHEN 0 THEN 'blocked' WHEN 1 THEN 'ACTIVE' END"
    )
    accounts = references.accounts.union(others)
    found = []
    for by_line in (False, True):
        own = References(references.banks, references.limits, accounts, by_line)
        looked_up = look_up(cleanse(spark.read.parquet(str(tmp_path / "rows"))), own)
        found.append(sorted(map(str, looked_up.collect())))
    assert found[0] == found[1] and len(found[0]) == 30_000
    narrow = looked_up.select("referenceId", "source_status", "beneficiary_status")
    narrow.collect()
    plan = plan_of(narrow).split("Initial Plan")[0]
    assert plan.count("SortMergeJoin") == 2 and "SortMergeJoin(skew=true)" in plan
