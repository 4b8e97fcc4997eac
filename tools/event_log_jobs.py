"""Summarise job times from a Spark event log folder (zstd or plain).

usage: python tools/event_log_jobs.py <eventlog dir or file> [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode().splitlines()


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    jobs, stage_shuffle = {}, {}
    for line in lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            jobs[e["Job ID"]] = [e["Submission Time"], None, props.get("callSite.short", ""), e.get("Stage IDs", [])]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
            w = int(acc.get("internal.metrics.shuffle.write.bytesWritten") or 0)
            stage_shuffle[info["Stage ID"]] = w
    rows = [((en - s) / 1000, j, cs, st) for j, (s, en, cs, st) in jobs.items() if en]
    print(f"jobs={len(rows)} sum={sum(r[0] for r in rows):.1f}s")
    for d, j, cs, st in sorted(rows, reverse=True)[:top]:
        sh = sum(stage_shuffle.get(s, 0) for s in st)
        print(f"{d:7.2f}s job{j:4d} stages={len(st):2d} shuffle_write={sh / 1e6:8.1f}MB {cs}")


if __name__ == "__main__":
    main()
