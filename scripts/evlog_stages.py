"""Summarise a Spark event log written to a scratch folder (no UI needed).

usage: python scripts/evlog_stages.py <eventLog.dir> [top_n]
Run the job with spark.eventLog.enabled=true and spark.eventLog.dir=<scratch>;
prints the slowest stages with their task count and operator scopes, which
shows single-task stages (e.g. after AQE coalescing) and where time goes.
"""

from __future__ import annotations

import glob
import json
import sys

import zstandard


def events(folder: str):
    for f in sorted(glob.glob(f"{folder}/eventlog_v2_*/events_*")) + sorted(glob.glob(f"{folder}/local-*")):
        with open(f, "rb") as fh:
            raw = zstandard.ZstdDecompressor().stream_reader(fh).read() if f.endswith(".zstd") else fh.read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main():
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(folder):
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = si.get("Completion Time", 0) - si.get("Submission Time", 0)
            scopes = sorted({json.loads(r["Scope"]).get("name") for r in si["RDD Info"] if r.get("Scope")})
            stages.append((dur, si["Stage ID"], si["Number of Tasks"], scopes))
    for dur, sid, n, scopes in sorted(stages, reverse=True)[:top]:
        print(f"stage {sid:5d} {dur / 1000:7.2f}s tasks={n:5d} {', '.join(scopes)[:120]}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f}s total stage time")


if __name__ == "__main__":
    main()
