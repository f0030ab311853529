"""Transactions and reference tables derived from order and customer tables.

Two fact sets, one row per order, so that all work grows with the tables:

* ``order_transactions``: generated rows for the seeded reference tables, with
  every 97th rows changed to edge cases (bad amounts, case, blanks, padding)
* ``customer_transactions``: transfers between the customers, checked against
  accounts, banks and limits made from customer and nation
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..fixed_values import TRANSACTION_FIELDS, TRANSACTION_LIMITS
from ..plans.validation import References
from ..sources.dimensions import local_table
from ..sources.generated import generate_transactions

# type, minimum, maximum, currency, order
_PRIORITY_LIMITS = [
    ("1-URGENT", "5000", "400000", "IDR", 0),
    ("2-HIGH", "5000", "400000", "IDR", 1),
    ("3-MEDIUM", "5000", "400000", "IDR", 2),
    ("4-NOT SPECIFIED", "5000", "400000", "IDR", 3),
    ("5-LOW", "5000", "400000", "IDR", 4),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw transactions with edge cases, plus ``id``."""
    made = generate_transactions(order_ids(spark, folder)).withColumn("edge", F.expr("id % 97"))
    maximum = " ".join(f"WHEN '{limit[0]}' THEN {limit[2]}" for limit in TRANSACTION_LIMITS)
    changed = {
        "amount": f"""WHEN 10 THEN concat(id + 1, repeat('0', 24)) WHEN 11 THEN concat(id + 1, '.', repeat('0', 18), '7')
                      WHEN 0 THEN 'abc' WHEN 1 THEN CAST(CASE transactionType {maximum} END + 1 AS STRING)
                      WHEN 8 THEN '9999.99999' WHEN 9 THEN ''""",
        "transactionType": "WHEN 2 THEN 'REFUND' WHEN 7 THEN lower(transactionType)",
        "sourceBankCode": "WHEN 3 THEN lower(sourceBankCode)",
        "beneficiaryBankCode": "WHEN 3 THEN lower(beneficiaryBankCode)",
        "sourceAccount": "WHEN 4 THEN ''",
        "beneficiaryAccount": "WHEN 5 THEN sourceAccount",
    }
    return made.selectExpr(
        "id",
        *[
            f"CASE edge WHEN 6 THEN concat('  ', {c}, '  ') {changed.get(c, '')} ELSE {c} END AS {c}"
            for c in TRANSACTION_FIELDS
        ],
    )


def customer_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS accountNumber",
        "c_name AS accountName",
        f"{_customer_bank('c_custkey')} AS bankCode",
        "CASE WHEN c_acctbal < -500 THEN 'BLOCKED' WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status",
    )


def nation_banks(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "nation")
        .select(
            F.col("n_name").alias("code"),
            F.concat(F.lit("Bank of "), F.col("n_name")).alias("name"),
            F.col("n_nationkey").alias("ord"),
        )
    )


def priority_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Limits of the order priorities in use."""
    priority = F.col("o_orderpriority")
    used = table(spark, folder, "orders").select(priority).distinct()
    return used.select(
        priority.alias("transactionType"),
        F.lit("5000").alias("minAmount"),
        F.lit("400000").alias("maxAmount"),
        F.lit("IDR").alias("currency"),
        F.substring(priority, 1, 1).cast("int").alias("ord"),
    )


def customer_references(spark: SparkSession, folder: str) -> References:
    limits = local_table(spark, schemas.LIMITS, _PRIORITY_LIMITS)
    return References(nation_banks(spark, folder), limits, customer_accounts(spark, folder))


def customer_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One raw transfer per order, from its customer to another.

    Some name no customer, an unknown bank or type, or the same account on both sides.
    """
    customers = table(spark, folder, "customer").agg(F.count("*")).scalar()
    orders = table(spark, folder, "orders")
    other = (F.col("o_custkey") * 31 + 7) % (customers + 20)
    beneficiary = F.when(F.col("o_orderkey") % 19 == 6, F.col("o_custkey")).otherwise(other)
    return orders.withColumn("bene", beneficiary).selectExpr(
        "concat('ORD-', o_orderkey) AS referenceId",
        "CAST(o_custkey AS STRING) AS sourceAccount",
        "'' AS sourceAccountName",
        f"IF(o_orderkey % 10 = 3, lower({_customer_bank('o_custkey')}), {_customer_bank('o_custkey')}) AS sourceBankCode",
        "CAST(bene AS STRING) AS beneficiaryAccount",
        "'' AS beneficiaryAccountName",
        f"IF(o_orderkey % 13 = 5, 'NATION_99', {_customer_bank('bene')}) AS beneficiaryBankCode",
        "'IDR' AS currency",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS amount",
        "IF(o_orderkey % 17 = 4, 'REFUND', o_orderpriority) AS transactionType",
        "o_orderstatus AS note",
    )


def order_run_steps(spark: SparkSession, folder: str) -> DataFrame:
    """A run log made from the orders: 500 orders are a run, 50 of them a partition."""
    counted = (
        table(spark, folder, "orders")
        .groupBy(F.expr("o_orderkey div 500 + 1 AS run_id"), F.expr("o_orderkey % 500 div 50 AS part"))
        .agg(
            F.expr("count(*) AS read_count"),
            F.expr("count_if(o_orderstatus <> 'P') AS write_count"),
            F.expr("count_if(o_orderstatus = 'P') AS skip_count"),
            F.expr("min(o_orderdate) AS start_time"),
            F.expr("max(o_orderdate) AS last_time"),
        )
    )
    status = "CASE (run_id * 7 + part * 3) % 41 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'STARTED' WHEN 2 THEN 'STOPPED' ELSE 'COMPLETED' END"
    return counted.withColumn("status", F.expr(status)).selectExpr(
        "run_id",
        "concat('partition-', part) AS partition_name",
        "status",
        "read_count",
        "write_count",
        "skip_count",
        "0L AS filter_count",
        "start_time",
        "IF(status <> 'STARTED', last_time, NULL) AS end_time",
    )


def order_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of ``order_run_steps``: a run is as its worst partition."""
    steps = order_run_steps(spark, folder)
    any_is = lambda status: f"bool_or(status = '{status}')"
    worst = " ".join(f"WHEN {any_is(status)} THEN '{status}'" for status in ("FAILED", "STOPPED", "STARTED"))
    return steps.groupBy("run_id").agg(
        F.expr(f"CASE {worst} ELSE 'COMPLETED' END AS status"),
        F.expr("min(start_time) AS start_time"),
        F.expr(f"IF({any_is('STARTED')}, NULL, max(end_time)) AS end_time"),
    )


def _customer_bank(key: str) -> str:
    return f"concat('NATION_', {key} % 25)"
