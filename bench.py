"""Times the main queries on the given tables and prints one JSON line.

Every query runs over all rows and writes all its columns to the no-op sink, except
the file runs, which read and write CSV. A query's time is the median of three runs
after one warm-up, including planning.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from ledgersieve.operators.cleanse import cleanse
from ledgersieve.operators.rules import count_rule_hits
from ledgersieve.plans import reports
from ledgersieve.plans.batch_run import run_validation
from ledgersieve.plans.validation import References, look_up, transaction_rules, validate_transactions
from ledgersieve.queries.given_tables import order_ids, order_transactions
from ledgersieve.queries.registry import all_queries
from ledgersieve.session import build_session
from ledgersieve.sources.transactions import rescue_short_lines, scan_transactions, write_transaction_files

QUERIES = (
    "validate_transactions", "validate_transactions_customers", "validate_account", "bulk_account_summary",
    "run_progress", "range_split",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="ledgersieve-bench-")
    spark = build_session(
        f"local[{cpus}]", int(cpus),
        **{"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.checkpoint.dir": shared},
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = order_ids(spark, folder).count()

    source = f"{shared}/transactions"
    write_transaction_files(order_transactions(spark, folder), source, max(1, rows // int(cpus)))
    references = References.seeded(spark)
    jobs = {name: lambda f=query: _drain(f(spark, folder)) for name, query in all_queries().items() if name in QUERIES}
    clean = lambda: cleanse(rescue_short_lines(scan_transactions(spark, source)))
    checked = lambda: validate_transactions(clean(), references)
    jobs["cleanse_csv"] = lambda: _drain(clean())
    jobs["validate_csv"] = lambda: _drain(checked())
    jobs["validity_totals_csv"] = lambda: _drain(reports.validity_totals(checked()))
    jobs["error_histogram_csv"] = lambda: _drain(reports.error_histogram(checked().filter("NOT valid")))
    jobs["rule_hits_csv"] = lambda: _drain(count_rule_hits(look_up(clean(), references), transaction_rules()))
    jobs["batch_run_csv_to_csv"] = lambda: run_validation(spark, source, f"{shared}/out", references)

    seconds = {name: _time(job) for name, job in jobs.items()}
    spark.stop()
    print(json.dumps({
        "metric": "total_time_of_main_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "transactions": rows,
        "rows_per_sec": {
            name: round(rows / seconds[name])
            for name in ("validate_transactions", "validate_csv", "batch_run_csv_to_csv")
        },
        "cpus": int(cpus),
    }))


def _drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(job) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


if __name__ == "__main__":
    main()
