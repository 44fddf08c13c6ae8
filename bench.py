"""Time the headline queries; print one JSON line.

BENCH_SF_DIR   folder with the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up (default 2, median kept)
BENCH_QUERIES  comma-separated names (default: the headline list; "all" for all)
BENCH_ROWS     instead time the price fact over this many generated daily rows of
               616 tickers, to see how it grows
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from marketlake.plans import events, marts  # noqa: E402
from marketlake.session import get_session  # noqa: E402
from marketlake.workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "stg_prices",
    "fact_daily_prices",
    "fact_fundamentals",
    "fact_valuation",
    "fact_macro",
    "merge_upsert",
    "cumulative_return",
    "event_study",
    "event_forward_equi",
    "event_fan",
    "macro_asof",
    "asof_by_key",
    "corr_matrix",
    "sector_avg_return",
    "near_high_topk",
    "summary_stats",
    "coverage_by_key",
    "observations_from_json",
]


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_of(make, runs: int) -> float:
    timed(make)
    return round(statistics.median(timed(make) for _ in range(runs)), 3)


def generated_prices(spark, rows: int, tickers: int = 616):
    """Daily closes of `tickers` symbols, `rows` in all."""
    ids = spark.range(rows)
    wave = F.sin(F.col("id") * 0.37) * 20 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100
    return ids.select(
        F.concat(F.lit("T"), F.col("id") % tickers).alias("ticker"),
        F.date_add(F.lit("2010-01-01").cast("date"), F.floor(F.col("id") / tickers).cast("int"))
        .alias("price_date"),
        (F.lit(100) + wave).alias("close_price"),
        (F.lit(1000) + F.col("id") % 977).alias("volume"),
    )


def growth(spark, rows: int, runs: int) -> dict[str, float]:
    def fact():
        returns = marts.int_daily_returns(generated_prices(spark, rows))
        return returns.withColumn("pct_of_52w_high", marts.pct_of_high())

    return {
        "daily_returns": median_of(fact, runs),
        "event_study": median_of(lambda: events.event_study(fact(), "return_up", 20.0), runs),
        "event_fan": median_of(
            lambda: events.event_fan(events.event_study(fact(), "return_up", 20.0)), runs
        ),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    rows = int(os.environ.get("BENCH_ROWS", "0"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    if rows:
        seconds = growth(spark, rows, runs)
    else:
        seconds = {
            name: median_of(lambda name=name: QUERIES[name](spark, sf), runs) for name in names
        }
    print(
        json.dumps(
            {
                "metric": f"price_rows_{rows}" if rows else "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
