"""Stage and job times from a Spark event log (no UI, no REST).

    python tools/stage_times.py <event-log dir or file> [job description]

Run the workload with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir`` pointing at a scratch folder; set a job description
(``sparkContext.setJobDescription``) around the part to measure.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            yield from stream


def main() -> None:
    path = sys.argv[1]
    if os.path.isdir(path) and not glob.glob(os.path.join(path, "events_*")):
        path = sorted(glob.glob(os.path.join(path, "eventlog_v2_*")) or [path])[-1]
    want = sys.argv[2] if len(sys.argv) > 2 else None
    jobs, stages, stage_job = {}, {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            desc = e.get("Properties", {}).get("spark.job.description")
            jobs[e["Job ID"]] = [e["Submission Time"], None, desc]
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if "Completion Time" in si and "Submission Time" in si:
                stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"],
                                          si["Number of Tasks"], si["Stage Name"][:60])
    picked = [j for j, v in jobs.items() if want is None or v[2] == want]
    total = sum(jobs[j][1] - jobs[j][0] for j in picked if jobs[j][1])
    print(f"jobs: {len(picked)}  job time: {total} ms")
    rows = sorted(((ms, sid, n, name) for sid, (ms, n, name) in stages.items()
                   if stage_job.get(sid) in picked), reverse=True)
    print(f"stages: {len(rows)}  stage time: {sum(r[0] for r in rows)} ms")
    for ms, sid, n, name in rows[:15]:
        print(f"  stage {sid:5d}  {ms:6d} ms  {n:4d} tasks  {name}")


if __name__ == "__main__":
    main()
