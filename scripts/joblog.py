"""Run one registered query with Spark's event log in a scratch folder and print
per-stage task counts, durations and the slowest task (no UI involved).

usage: python scripts/joblog.py <query> [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-joblog-")
    from frostline.plans.catalogue import queries
    from frostline.session import local_session

    spark = local_session(8, **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    fn = queries()[name]
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    t0 = time.time()
    df = fn(spark, sf_dir)
    t1 = time.time()
    df.write.format("noop").mode("overwrite").save()
    t2 = time.time()
    spark.stop()
    print(f"build {t1 - t0:.2f}s run {t2 - t1:.2f}s")
    import zstandard

    stages, tasks = {}, {}
    for f in glob.glob(os.path.join(log_dir, "*", "events_*")):
        raw = open(f, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if si.get("Submission Time", 0) / 1000 >= t0:
                    stages[si["Stage ID"]] = (si["Stage Name"][:70], si["Number of Tasks"],
                                              (si["Completion Time"] - si["Submission Time"]) / 1000)
            elif e["Event"] == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    for sid, (sname, n, dur) in sorted(stages.items()):
        ts = tasks.get(sid, [])
        print(f"stage {sid:4d} tasks={n:4d} dur={dur:6.2f}s max_task={max(ts) if ts else 0:6.2f}s  {sname}")


if __name__ == "__main__":
    main()
