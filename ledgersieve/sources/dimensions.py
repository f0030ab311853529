"""Reference tables: bank codes, amount limits per type, account master.

All joins against them go through the ``*_lookup`` frames below, which have one
row per key, so a join can neither lose nor multiply transactions. No join is
hinted blindly: Spark broadcasts a side whose size it knows to be small, AQE
decides again on real sizes, and a larger side is sort-merge joined with skewed
partitions split.

The bank and limit lookups derive their join key after the aggregate that makes it
unique. Were the grouping key itself joined on, the planner would join right on top
of the aggregate, without a shuffle of its own for that side, and AQE could then no
longer split the partition of a hot bank. Accounts are joined as they are; that their
keys are unique is part of the same query.
"""

from __future__ import annotations

import weakref

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..fixed_values import ACCOUNTS, BANK_CODES, TRANSACTION_LIMITS
from ..functions.text import case_key

# Account tables of constants whose keys were looked at when the frame was made.
_unique: weakref.WeakSet[DataFrame] = weakref.WeakSet()


def seeded_banks(spark: SparkSession) -> DataFrame:
    return local_table(spark, schemas.BANKS, [(*row, i) for i, row in enumerate(BANK_CODES)])


def seeded_limits(spark: SparkSession) -> DataFrame:
    return local_table(spark, schemas.LIMITS, [(*row, i) for i, row in enumerate(TRANSACTION_LIMITS)])


def seeded_accounts(spark: SparkSession) -> DataFrame:
    accounts = local_table(spark, schemas.ACCOUNTS, ACCOUNTS)
    if len({(number, bank.upper()) for number, _, bank, _ in ACCOUNTS}) == len(ACCOUNTS):
        _unique.add(accounts)
    return accounts


def read_banks(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, fmt, schemas.BANKS)


def read_limits(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Limits stay text until the lookup, so that messages keep their written scale."""
    return _read(spark, path, fmt, schemas.LIMITS)


def read_accounts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, schemas.ACCOUNTS)


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one that comes first in ``order``, which must be unique per key.

    An aggregate rather than a ranking window, so that rows of a key are combined
    before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in others])


def bank_lookup(banks: DataFrame) -> DataFrame:
    """Banks by code without case."""
    winners = first_wins(banks.withColumn("_key", F.expr(case_key("code"))), ["_key"], "ord")
    return winners.selectExpr(f"{case_key('code')} AS bank_key", "code", "name")


def limit_lookup(limits: DataFrame) -> DataFrame:
    """Limits by type without case; each bound as a number and as written.

    A bound that is no number fails the query.
    """
    winners = first_wins(limits.withColumn("_key", F.expr(case_key("transactionType"))), ["_key"], "ord")
    bounds = [
        column
        for side in ("min", "max")
        for column in (
            f"CAST({side}Amount AS {schemas.AMOUNT_TYPE}) AS {side}_amount",
            f"trim(CAST({side}Amount AS STRING)) AS {side}_text",
        )
    ]
    return winners.selectExpr(
        f"{case_key('transactionType')} AS type_key", "transactionType", *bounds, "currency"
    )


def account_lookup(accounts: DataFrame) -> DataFrame:
    """Accounts by number (as is) and bank (without case).

    A key that occurs twice raises in every query that looks an account up, whatever columns it uses: the
    rows pass a filter on one aggregate over the keys, which a query computes once for all its lookups. So the
    rows are checked that are joined, also if the table has changed since the frame was made.
    """
    keyed = accounts.selectExpr(
        "accountNumber AS account_key",
        f"{case_key('bankCode')} AS account_bank_key",
        "accountName",
        "bankCode",
        "status",
    )
    if accounts in _unique:
        return keyed
    twice = duplicate_accounts(accounts).agg(F.min(F.concat_ws(":", "accountNumber", "bankKey")).alias("k")).scalar()
    message = F.concat(F.lit("Duplicate account key "), twice)
    return keyed.filter(F.when(twice.isNull(), True).otherwise(F.raise_error(message).cast("boolean")))


def duplicate_accounts(accounts: DataFrame) -> DataFrame:
    """Account keys that occur more than once; must be empty for a usable table."""
    return (
        accounts.groupBy("accountNumber", F.expr(f"{case_key('bankCode')} AS bankKey"))
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
    )


def local_table(spark: SparkSession, ddl: str, rows) -> DataFrame:
    """A small local relation; unlike a parallelised list its size is known to the planner."""
    names = [part.split()[0] for part in ddl.split(", ")]
    columns = list(zip(*rows))
    types = [pa.int32() if part.endswith(" int") else pa.string() for part in ddl.split(", ")]
    table = pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)
    return spark.createDataFrame(table)


def _read(spark: SparkSession, path: str, fmt: str, ddl: str) -> DataFrame:
    reader = spark.read.schema(ddl).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("escape", '"').option("mode", "FAILFAST")
    return reader.load(path)
