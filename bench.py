"""Headline-query benchmark.

/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is executed to completion with the ``noop`` sink (no driver
collect); time = best of ``$BENCH_REPEATS`` (default 3) after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "view_demographics", "view_participant_status", "view_diagnosis_history",
    "code_list_summary", "code_list_variable", "ambiguous_items", "page_tables",
    "prf_profile", "src_archive", "snk_create_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from frostline.plans.catalogue import queries
    from frostline.session import local_session

    spark = local_session(cpus, app="frostline-bench")
    registry = queries()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in only:
        fn = registry[name]
        best = None
        for i in range(repeats + 1):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        print(f"# {name}: {best:.3f}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({
        "metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "cpus": cpus, "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
