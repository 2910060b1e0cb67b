"""Rows read per table and rows shuffled, from the event log of a session of its own."""

from __future__ import annotations

import json
import os
import re
import subprocess
import sys
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


@dataclass
class Metrics:
    read: Counter = field(default_factory=Counter)
    # By the table that is read in the stage that writes the shuffle.
    shuffled: Counter = field(default_factory=Counter)


def run(names: list[str], sf_dir: str, folder: Path) -> dict[str, Metrics]:
    """Run registered queries in a new process and read its log."""
    events = folder / "events"
    events.mkdir()
    subprocess.run(
        [sys.executable, __file__, sf_dir, str(folder), *names],
        check=True,
        timeout=900,
        env=os.environ | {"PYTHONPATH": str(ROOT)},
    )
    (log,) = [p for p in events.rglob("*") if p.is_file() and not p.name.startswith((".", "appstatus"))]
    return parse(log)


def _scans(plan: dict, found: dict[int, str]) -> None:
    where = plan.get("metadata", {}).get("Location", "")
    table = re.search(r"/(\w+)\.parquet", where)
    if plan["nodeName"].startswith("Scan"):
        for metric in plan["metrics"]:
            if metric["name"] == "number of output rows":
                found[metric["accumulatorId"]] = table.group(1) if table else "intermediate"
    for child in plan["children"]:
        _scans(child, found)


def parse(log: Path) -> dict[str, Metrics]:
    scans: dict[int, str] = {}
    group: dict[int, str] = {}
    tasks = []
    for line in log.open():
        event = json.loads(line)
        kind = event["Event"].rsplit(".", 1)[-1]
        if kind in ("SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate"):
            _scans(event["sparkPlanInfo"], scans)
        elif kind == "SparkListenerJobStart":
            name = event["Properties"].get("spark.jobGroup.id")
            group |= dict.fromkeys(event["Stage IDs"], name)
        elif kind == "SparkListenerTaskEnd":
            tasks.append(event)
    out: dict[str, Metrics] = defaultdict(Metrics)
    for event in tasks:
        metrics = out[group[event["Stage ID"]]]
        tables = set()
        for value in event["Task Info"]["Accumulables"]:
            table = scans.get(value["ID"])
            if table and "Update" in value:
                metrics.read[table] += int(value["Update"])
                tables.add(table)
        written = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
        for table in tables:
            metrics.shuffled[table] += written
    return out


def main(sf_dir: str, folder: str, *names: str) -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{folder}/events")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.checkpoint.dir", f"{folder}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        contract.queries()[name](spark, sf_dir).collect()
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
