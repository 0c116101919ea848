"""Headline timings: the whole pipeline from raw CSV to published tables, then the queries on them.

Prints one JSON line.  BENCH_SF_DIR names the test data, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brassledger import fixtures as X  # noqa: E402
from brassledger.catalogue import queries  # noqa: E402
from brassledger.catalogue.workspace import Workspace  # noqa: E402
from brassledger.plans.run import Lake, Settings, publish  # noqa: E402
from brassledger.session import session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Row-level queries start from the raw CSV files, the others from the published lake.
HEADLINE = (
    "standardize_transactions", "flag_transactions", "quarantine_reason_counts", "dq_evaluate_rules",
    "mart_daily_transactions", "mart_monthly_kpis", "mart_monthly_segment", "mart_customer_value",
    "mart_merchant_monthly", "mart_branch_activity", "mart_account_book",
    "mart_monthly_kpis_secure", "mart_customer_value_secure", "mart_branch_activity_secure",
    "q01_monthly_value", "q02_deposits_mom", "q03_value_percentiles", "q04_active_customers", "q05_failed_rate",
    "q06_top_state_segment", "q07_net_outflow_3m", "q08_accounts_opened", "q09_dormant_active", "q10_channel_mix",
    "q11_digital_adoption", "q12_hourly_profile", "q13_busiest_branches", "q14_merchant_share", "q15_latest_run",
    "q16_latest_reasons", "q17_rule_compare", "q18_dq_trend", "q19_sample_quarantine", "q20_reconcile",
    "q21_freshness", "check_referential_integrity", "dq_scorecard", "governance_demo",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            # Small local data: let a rebalance still use all cores.
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    space = Workspace.of(spark, SF_DIR)
    layout = timed(lambda: space.raw_root)  # test input, not part of the result

    _ = space.lake  # set-up: the three-run history the quality queries look at; also warms the JVM

    lake = Lake(spark, space.fresh("bench-lake"))
    summary: dict = {}
    times = {"etl_publish": timed(lambda: summary.update(publish(space.raw, Settings(X.AS_OF), lake)))}
    # The same run once more, as a retry would, and a tenth of the rows: what is fixed cost and what grows.
    times["etl_publish_again"] = timed(lambda: publish(space.raw, Settings(X.AS_OF), lake))
    small_dir = str(Path(SF_DIR).parent / "sf0.01")
    if Path(small_dir).is_dir() and small_dir != SF_DIR:
        small = Workspace.of(spark, small_dir)
        raw, small_lake = small.raw, Lake(spark, small.fresh("bench-lake"))
        times["etl_publish_sf0.01"] = timed(lambda: publish(raw, Settings(X.AS_OF), small_lake))
    _ = space.run  # staged once for the queries on a run's rows

    registered = queries()
    raw_scans = {}
    for name in HEADLINE:
        build = registered[name]
        plan = build(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        raw_scans[name] = len(re.findall(r"FileScan csv \[[^\]]*transaction_timestamp", plan))
        times[name] = timed(lambda: build(spark, SF_DIR).write.format("noop").mode("overwrite").save())

    rows = summary["raw_rows"]
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    result = {
        "metric": "raw CSV to published star schema, then 38 marts and analyses",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
        "raw_rows": rows,
        "etl_rows_per_sec": round(rows / times["etl_publish"], 1),
        "layout_sec": layout,
        "raw_scans": {name: n for name, n in raw_scans.items() if n},
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
