"""Summarise a Spark event log: job count, busiest jobs and stages.

Usage: python tools/eventlog.py <event log dir or file> [top_n]
Reads plain or zstd-compressed JSON-lines logs (rolling logs included).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events*"), recursive=True)) \
        if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(stream, encoding="utf-8")
            else:
                yield from io.TextIOWrapper(fh, encoding="utf-8")


def summarise(path: str, top: int = 10) -> dict:
    jobs, stages = {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = {
                "tasks": si["Number of Tasks"], "name": si["Stage Name"],
                "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0)}
    for j in jobs.values():
        j["ms"] = j.get("end", j["start"]) - j["start"]
    starts = [j["start"] for j in jobs.values()] or [0]
    ends = [j.get("end", j["start"]) for j in jobs.values()] or [0]
    return {
        "jobs": len(jobs), "stages": len(stages),
        "wall_ms": max(ends) - min(starts),
        "sum_job_ms": sum(j["ms"] for j in jobs.values()),
        "top_jobs": sorted(((j["ms"], jid, len(j["stages"])) for jid, j in jobs.items()),
                           reverse=True)[:top],
        "top_stages": sorted(((s["ms"], sid, s["tasks"], s["name"][:60])
                              for sid, s in stages.items()), reverse=True)[:top],
    }


if __name__ == "__main__":
    out = summarise(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 10)
    print(json.dumps(out, indent=1))
