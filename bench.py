"""Wall time of the two reports and their main steps on the derived tables.

The derived source tables are written as parquet first, outside the timing, as they
would lie in a warehouse. Every run starts with an empty cache and includes planning.
Prints one JSON line; ``value`` is the sum of the medians of both reports. ``shuffle_mb`` has
what one warm run of each wrote to shuffles, from the event log; ``smaller`` the seconds of
both reports on the next smaller tables, if they are there.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from gradeledger.checks.derived import CONFIG, store
from gradeledger.checks.naive import report_r_long
from gradeledger.operators.reuse import Keeper
from gradeledger.plans import matched, risk
from gradeledger.plans.position import report_p
from gradeledger.plans.risk import report_r

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
PARTITIONS = "8"
EVENTS = tempfile.mkdtemp(prefix="gradeledger-events-")
SMALLER = {"sf0.1": "sf0.01", "sf0.01": "sf0.001"}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("gradeledger-bench")
        .config("spark.sql.shuffle.partitions", PARTITIONS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{EVENTS}")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def measure(name: str, build, runs: int = RUNS) -> tuple[float, int]:
    """Median seconds of the warm runs, planning included, and the row count.

    What a run keeps is released after it, as the jobs do.
    """
    times, rows = [], 0
    context = SparkSession.active().sparkContext
    for i in range(runs + 1):
        context.setJobGroup(name if i == runs else "", name)
        keeper, seen = Keeper(CONFIG.sharing), Observation()
        start = time.perf_counter()
        build(keeper).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
        rows = seen.get["n"]
        keeper.release()
    return round(statistics.median(times[1:]), 3), rows


def shuffled() -> dict[str, float]:
    """MB that the last run of each query wrote to shuffles."""
    group: dict[int, str] = {}
    written: dict[str, int] = {}
    for path in Path(EVENTS).iterdir():
        for line in path.read_text().splitlines():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group |= dict.fromkeys(event["Stage IDs"], event["Properties"].get("spark.jobGroup.id", ""))
            elif event["Event"] == "SparkListenerStageCompleted":
                info = event["Stage Info"]
                for a in info["Accumulables"]:
                    if a["Name"] == "internal.metrics.shuffle.write.bytesWritten":
                        name = group.get(info["Stage ID"], "")
                        written[name] = written.get(name, 0) + int(a["Value"])
    return {name: round(n / 1e6, 1) for name, n in written.items() if name}


def main() -> None:
    spark = session()
    source = store(spark, SF_DIR, tempfile.mkdtemp(prefix="gradeledger-bench-"))
    work = {
        "report_p": lambda keep: report_p(source, CONFIG, keep),
        "report_r": lambda keep: report_r(source, CONFIG, keep),
        "report_r_ten_joins": lambda keep: report_r_long(source, CONFIG, keep),
        "final_rating_p": lambda _: matched.final_rating_p(source, CONFIG),
        "final_rating_r": lambda _: matched.final_rating_r(source, CONFIG),
        "account_groups": lambda _: risk.groups_in_scope(
            source, CONFIG, risk.perimeter_r(source, CONFIG)
        ),
    }
    results = {
        name: measure(name, build, 1 if name == "report_r_ten_joins" else RUNS)
        for name, build in work.items()
    }
    seconds = {name: t for name, (t, _) in results.items()}
    smaller = {}
    less = Path(SF_DIR).parent / SMALLER.get(Path(SF_DIR).name, "none")
    if less.exists():
        few = store(spark, str(less), tempfile.mkdtemp(prefix="gradeledger-bench-"))
        smaller = {
            name: measure(f"{name} {less.name}", build, 2)[0]
            for name, build in {
                "report_p": lambda keep: report_p(few, CONFIG, keep),
                "report_r": lambda keep: report_r(few, CONFIG, keep),
            }.items()
        }
    spark.stop()
    print(json.dumps({
        "metric": "report_p + report_r, median warm wall time",
        "value": round(seconds["report_p"] + seconds["report_r"], 3),
        "unit": "sec",
        "queries": seconds,
        "rows": {name: n for name, (_, n) in results.items()},
        "shuffle_mb": shuffled(),
        "smaller": {"sf": less.name.removeprefix("sf"), "queries": smaller},
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "master": f"local[{CPUS}]",
        "shuffle_partitions": int(PARTITIONS),
        "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
