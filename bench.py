"""Time the headline queries, and their SQL in DuckDB on the same cores, and print one JSON line."""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from motorledger.queries import QUERIES  # noqa: E402
from motorledger.session import local_session  # noqa: E402

HEADLINE = [
    "s12_table_profile", "s10_page_landing", "k3_upsert", "f8_prefer_rows", "j1_left_lookup",
    "j5_star_join", "j8_interval_join", "j9_asof_lookup", "j11_suffix_join", "a1_group_sum",
    "a3_join_distinct", "a5_join_all", "a10_summary", "w1_latest_per_key", "w3_group_span",
    "w5_allocate_once", "u3_union_at_cutover", "r2_melt_families", "q2_row_rules", "q5_quality_summary",
    "e2_apply_deletes", "x1_to_number", "x19_month_start", "m1_paid_accessories", "m2_vehicle_cost",
    "m6_inventory", "m10_sales_profit", "m10_profit_by_store", "m18_film_funnel", "m25_service_quality",
]


def duckdb_times(folder: str, cores: str, names: list[str]) -> dict[str, float]:
    """Seconds of the equivalent statements in single-node DuckDB; empty where it is not installed."""
    try:
        import duckdb
    except ImportError:
        return {}
    con = duckdb.connect(config={"threads": int(cores)} if cores.isdigit() else {})
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    times = {}
    for name in names:
        if QUERIES[name].sql is not None:
            began = time.time()
            con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {QUERIES[name].sql}")
            times[name] = round(time.time() - began, 3)
    return times


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "8g"), shuffle=int(cores) if cores.isdigit() else 8)
    wanted = sys.argv[1:] or HEADLINE
    QUERIES["a1_group_sum"].run(spark, folder).write.format("noop").mode("overwrite").save()  # warm the JVM
    times = {}
    for name in wanted:
        began = time.time()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    spark.stop()
    single = duckdb_times(folder, cores, wanted)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": float(scale.group(1)) if scale else None,
                "duckdb_total": round(sum(single.values()), 3), "duckdb": single,
            }
        )
    )


if __name__ == "__main__":
    main()
