"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the runs
per query, of which the median counts. Each run computes the whole result and discards it.

``BENCH_VISITS=3100000`` times the fact job instead, on the arrivals repeated up to about that
many rows.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from starmart.operators import dims, facts
from starmart.plans import analytics
from starmart.plans.star import MONTH
from starmart.samples import views
from starmart.samples.queries import QUERIES
from starmart.session import get_or_create, scratch_dir
from starmart.sources import read_source, save

HEADLINE = [
    "fact_visits",
    "date_dim",
    "city_demographics",
    "state_dim",
    "country_temperature",
    "country_dim",
    "lookup_decode",
    "partitioned_write",
    "monthly_upsert",
    "duplicate_keys",
    "null_profile",
    "orphans_country",
    "source_target_counts",
    "visits_by_nationality",
    "visits_by_origin",
    "visits_by_airline",
    "avg_stay_by_state",
    "dest_source_matrix",
    "corr_dest_source",
    "corr_dest_climate",
    "corr_source_temperature",
    "corr_state_demographics",
    "visitor_profile_by_state",
]


def _drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _median(run, runs: int) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def bench_queries(spark, sf_dir: str, runs: int) -> dict[str, float]:
    _drain(QUERIES["visits_by_origin"](spark, sf_dir))  # start the JVM's code paths
    return {name: _median(lambda: _drain(QUERIES[name](spark, sf_dir)), runs) for name in HEADLINE}


# What the queries read in place of files; their times are part of the queries' own.
VIEWS = {
    "visits_raw": views.visits_raw,
    "demographics_raw": views.demographics_raw,
    "temperature_raw": views.temperature_raw,
    "country_lookup": views.country_lookup,
    "port_lookup": views.port_lookup,
}


def bench_views(spark, sf_dir: str, runs: int) -> dict[str, float]:
    return {name: _median(lambda: _drain(view(spark, sf_dir)), runs) for name, view in VIEWS.items()}


def bench_fact(spark, sf_dir: str, runs: int, rows: int) -> dict[str, float]:
    """Arrivals as stored Parquet to fact, dates and one report, at a given size."""
    raw = views.visits_raw(spark, sf_dir)
    n = raw.count()
    copies = F.explode(F.sequence(F.lit(0), F.lit(-(-rows // n) - 1)))
    source, target = scratch_dir(spark, "arrivals"), scratch_dir(spark, "visits")
    repeated = raw.repartition(32).withColumn("copy", copies)
    save(repeated.withColumn("cicid", F.col("cicid") + F.col("copy") * n).drop("copy"), source)
    arrivals = read_source(spark, source, "parquet")
    fact = facts.visits(arrivals)
    return {
        "rows": arrivals.count(),
        "fact_visits": _median(lambda: _drain(fact), runs),
        "fact_write": _median(lambda: save(fact, target, partition_by=MONTH), runs),
        "date_dim": _median(lambda: _drain(dims.date_dim(fact)), runs),
        "dest_source_matrix": _median(lambda: _drain(analytics.dest_source_matrix(fact)), runs),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    rows = int(os.environ.get("BENCH_VISITS", "0"))
    spark = get_or_create(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    if rows:
        times = bench_fact(spark, sf_dir, runs, rows)
        metric, total = "fact_job_sec", sum(v for k, v in times.items() if k != "rows")
    else:
        times = bench_queries(spark, sf_dir, runs)
        metric, total = "total_query_sec", sum(times.values())
        stand_ins = bench_views(spark, sf_dir, runs)
    apart = {} if rows else {"views": stand_ins}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": metric,
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                **apart,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
