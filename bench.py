"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up pass over all queries (JIT), then
``$BENCH_REPEAT`` (default 3) timed passes, round-robin over the queries; the
median per query is reported. ``more`` and a run of everything on a tenth of the
data follow; ``slope`` is a query's time as a power of the input. A run = build the query (including any sink or
stream work it performs) + execute it fully (``noop`` write, nothing
collected). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import math
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # parsing / quarantine
    "parse_quote_split", "parse_regex", "quarantine_counts", "ip_findall",
    # reports
    "top_urls", "hits_by_ip", "method_grouping_sets", "unique_ips_by_hour", "top10_ips",
    # joins / geography
    "geo_lookup", "ips_by_region", "first_n_ips",
    # windows / per-group
    "ip_trailing_3d", "ip_activity_snapshot", "top5_urls_per_group", "group_modes",
    # features / ML
    "ip_features", "frequency_index", "scaled_ip_features", "ip_clusters",
    # sinks
    "etl_access_rows", "upsert_accumulate_ip",
    # streaming
    "stream_url_totals", "stream_hourly_windows",
]

# Timed as well, reported apart, so that the sum stays comparable over the rounds.
MORE = ["request_clusters", "cluster_profile", "key_range_scan", "stream_dedup", "stream_ip_hourly_activity",
        "stream_event_windows", "stream_ip_trailing", "stream_unique_ips_bitmap", "stream_top_urls", "geo_client_lookup", "stored_model_scores"]
SMALL = "/root/testdata/sf0.01"          # second scale, for each query's slope


def main() -> None:
    from logscope.plans.catalog import all_queries
    from logscope.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=shuffle,
                          extra={"spark.driver.memory": "16g"})
    catalog = all_queries()
    names, more = only or HEADLINE, [] if only else MORE

    def run(name: str, where: str = sf_dir) -> float:
        t0 = time.perf_counter()
        catalog[name].build(spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names + more:               # warm-up pass
        run(name)
    samples: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(repeat):
        for name in names:
            samples[name].append(run(name))
    results = {n: round(statistics.median(v), 3) for n, v in samples.items()}
    extra = {n: round(run(n), 3) for n in more}
    small = {n: round(run(n, SMALL), 3) for n in names + more} if os.path.isdir(SMALL) else {}
    slope = {n: round(math.log(max(t, 1e-3) / max(small[n], 1e-3)) / math.log(10), 2)
             for n, t in (results | extra).items() if n in small} if "sf0.1" in sf_dir else {}
    for name, v in (results | extra).items():
        print(f"# {name}: {v}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus,
                      "repeat": repeat, "more": extra, "seconds_sf0.01": small, "slope": slope}))
    spark.stop()


if __name__ == "__main__":
    main()
