"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely through the ``noop`` sink (no collect to
the driver). Prints ONE JSON line. DuckDB timings of the matching oracle SQL
on the same files are included for reference under ``duckdb``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_sales_margin",        # W10: 3-way join with the SCD-2 interval condition
    "action_monitoring",        # W17: snapshot vs current revenue / goal (flagship)
    "history_profile",          # W18: demand profile
    "doc_cohort_retention",     # D8: cohort table
    "stream_daily_load",        # X1: streaming daily load (incl. replay)
    "doc_revenue_margin",       # D1: star aggregate
    "doc_customer_segments",    # D6: distributed global quintiles
    "daily_load",               # W12: guarded append load
]

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ["BENCH_CPUS"] = cpus
    from saleslens import catalog
    from saleslens.session import build_session

    spark = build_session(master=f"local[{cpus}]")
    qs, oracles = catalog.queries(), catalog.oracle_sql()

    # Warm-up (JIT, file listing caches) on the smallest data, untimed.
    small = "/root/testdata/sf0.001"
    if os.path.isdir(small):
        qs["fact_sales_margin"](spark, small).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for k in HEADLINE:
        t0 = time.perf_counter()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
        print(f"[bench] {k}: {times[k]}s", file=sys.stderr, flush=True)

    spark.stop()   # free the JVM's memory before the reference engine runs
    duck: dict[str, float] = {}
    try:
        import duckdb
        con = duckdb.connect()
        con.execute(f"SET threads = {int(cpus)}")
        con.execute("SET memory_limit = '4GB'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        import threading
        cap = float(os.environ.get("BENCH_DUCKDB_CAP_SEC", "30"))
        for k in HEADLINE:
            if k in oracles:
                timer = threading.Timer(cap, con.interrupt)
                t0 = time.perf_counter()
                timer.start()
                try:
                    con.execute(f"SELECT count(*) FROM ({oracles[k]}) q").fetchall()
                    duck[k] = round(time.perf_counter() - t0, 3)
                except Exception:  # noqa: BLE001
                    duck[k] = f">{cap:g}"
                finally:
                    timer.cancel()
    except Exception:  # noqa: BLE001  (reference timings are optional)
        pass

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "duckdb": duck}))


if __name__ == "__main__":
    main()
