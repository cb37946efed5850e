"""Report snapshots, the views over them, and the audit log."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeledger.functions.scalars import sort_keys
from gradeledger.sources.commits import CommitLog, Files, PublishConflict, State

log = logging.getLogger(__name__)

# Columns of the audit log record, in order.
AUDIT_SCHEMA = (
    "id_ string, t_ string, JobId string, ETLFunction string, SourceTableName string, "
    "SourceTableCount long, TargetTableName string, TargetTableCount long, "
    "LogMessage string, SchemaName string"
)

# Folder of the runs below a report.
_RUNS = "_runs"
# A table name, with or without its database.
_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?")


def _folder(path: str, run: str) -> str:
    return f"{path}/{_RUNS}/{run}"


def write_report(
    df: DataFrame,
    path: str,
    ref_date: date,
    view: str | None = None,
    audit: Callable[[int], Mapping] | None = None,
    steps: Callable[[], Mapping[str, int]] | None = None,
) -> int:
    """Replace the snapshot of one reference date; returns its row count.

    Each run writes a folder of its own, and one commit points the date to it when it is
    complete; ``audit`` gives the record, made from the row count, and ``steps`` the row counts
    of steps, that the same commit holds. So whatever fails or dies before leaves the old snapshot, readers never meet half a run,
    and a snapshot is never without its record. Other dates are not touched, and an empty
    report replaces a full one. If another run published the date since this one began, this
    one raises ``PublishConflict`` and leaves nothing. Runs that are no longer named stay until
    ``drop_old_runs``, for readers that still hold them.

    Views registered over the report follow; ``view`` registers one.
    """
    spark, run, commits = df.sparkSession, uuid.uuid4().hex, CommitLog(df.sparkSession, path)
    before = commits.state().number(ref_date)
    df.write.parquet(_folder(path, run))
    count = spark.read.schema(df.schema).parquet(_folder(path, run)).count()
    entry = {"date": ref_date.isoformat(), "run": run, "rows": count}
    if audit is not None:
        entry["audit"] = dict(audit(count))
    if steps is not None:
        entry["steps"] = dict(steps())

    def unchanged(state: State) -> None:
        if state.number(ref_date) != before:
            raise PublishConflict(f"{path}: {ref_date} was published by another run meanwhile")

    try:
        commits.commit(entry, unchanged)
    except PublishConflict:
        runs = Files(spark, f"{path}/{_RUNS}")
        runs.fs.delete(runs._path(run), True)
        raise
    try:
        if view is not None:
            register_view(spark, path, view)
        follow_views(spark, path)
    except Exception as failure:  # the snapshot is published; the next run moves the views too
        log.warning("views of %s can't follow: %s", path, failure)
    return count


def read_report(spark: SparkSession, path: str, ref_date: date | None = None) -> DataFrame:
    """The snapshot of a reference date, by default the latest one written, empty or not."""
    state = CommitLog(spark, path).state()
    run = state.run(ref_date)
    if run is None:
        if ref_date is not None and state.dates:
            raise KeyError(ref_date)
        raise FileNotFoundError(f"no snapshot below {path}")
    return spark.read.parquet(_folder(path, run))


def _location(spark: SparkSession, name: str) -> str | None:
    """Where a table of the catalog lies; None if there is none."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return found.data_type if found else None


def _same_place(a: str, b: str) -> bool:
    plain = [re.sub("^file:/+", "/", p).rstrip("/") for p in (a, b)]
    return plain[0] == plain[1]


def _point(spark: SparkSession, name: str, folder: str) -> None:
    """Lets an external table show a folder; a new one if there is none with its columns."""
    place = _location(spark, name)
    if place is not None and _same_place(place, folder):
        return
    quoted = folder.replace("'", "\\'")
    if place is not None:
        if spark.table(name).schema == spark.read.parquet(folder).schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{quoted}'")


def register_view(
    spark: SparkSession, path: str, name: str, ref_date: date | None = None
) -> DataFrame:
    """Expose the snapshot of a date, by default the latest, under a name of the catalog.

    The name is an external table whose location the writers of the report move, so it is
    read without a look at the log, and shows later runs without being registered again,
    also to other sessions of the same metastore. It is in the report's own log that the name
    follows it. Files of a run never change: queries that are under way go on with theirs.
    """
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    commits = CommitLog(spark, path)
    day = ref_date.isoformat() if ref_date else None
    state = commits.state()
    run = state.run(day)
    if run is None:
        raise FileNotFoundError(f"no snapshot of {day or 'any date'} below {path}")
    if state.views.get(name, "") != day:
        commits.commit({"view": name, "view_date": day})
    if "." not in name:
        spark.catalog.dropTempView(name)
    _point(spark, name, _folder(path, run))
    follow_views(spark, path)
    return spark.table(name)


def follow_views(spark: SparkSession, path: str) -> None:
    """Moves the registered tables of this catalog to what the log says now.

    Tables that are gone, or have become another report's, are left alone. If the log moved
    on meanwhile, once more: of two publishers the later one's state stays.
    """
    commits = CommitLog(spark, path)
    last = -1
    while (state := commits.state()).last != last:
        last = state.last
        for name, day in state.views.items():
            place, run = _location(spark, name), state.run(day)
            if place is not None and run is not None and _same_place(place.rsplit("/", 1)[0], f"{path}/{_RUNS}"):
                _point(spark, name, _folder(path, run))


def drop_old_runs(spark: SparkSession, path: str) -> int:
    """Delete the runs that no date points to; returns how many. For quiet times: a reader of
    such a run, or a job that is about to publish one, would lose it."""
    named = {run for _, run in CommitLog(spark, path).state().dates.values()}
    runs = Files(spark, f"{path}/{_RUNS}")
    return sum(bool(runs.fs.delete(runs._path(name), True)) for name in runs.names() if name not in named)


def export_report(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write a report in presentation order (names as in ``sort_keys``): files in the order of
    the keys, each sorted.

    Range partitioning orders the files without one task that sees everything.
    """
    keys = sort_keys(order)
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def job_id(now: datetime) -> str:
    return "populate_report" + now.strftime("%Y%m%d%H%M")


def audit_record(
    function: str, target: str, target_count: int, message: str, now: datetime,
    log: str = "etl_log", schema: str = "reports",
) -> dict:
    return {
        "id_": uuid.uuid4().hex, "t_": f"{schema}.{log}", "JobId": job_id(now),
        "ETLFunction": function, "SourceTableName": None, "SourceTableCount": 0,
        "TargetTableName": target, "TargetTableCount": target_count,
        "LogMessage": message, "SchemaName": schema,
    }


def append_audit(spark: SparkSession, path: str, record: Mapping) -> None:
    """Append one record to the log of a report or of its own folder."""
    CommitLog(spark, path).commit({"audit": dict(record)})


def read_audit(spark: SparkSession, *paths: str) -> DataFrame:
    """The audit records below some folders, in the columns of ``AUDIT_SCHEMA``."""
    record = F.from_json("value", f"audit struct<{AUDIT_SCHEMA.replace(' string', ': string').replace(' long', ': long')}>")
    parts = [CommitLog(spark, p).read().select(record.audit.alias("audit")) for p in paths]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.where("audit IS NOT NULL").select("audit.*")


def read_steps(spark: SparkSession, path: str) -> DataFrame:
    """Row counts of the steps of each published run: ref_date, run, step, n_rows."""
    entry = F.from_json("value", "date date, run string, steps map<string, bigint>").alias("e")
    rows = CommitLog(spark, path).read().select(entry).where("e.steps IS NOT NULL")
    return rows.select(F.col("e.date").alias("ref_date"), "e.run", F.explode("e.steps").alias("step", "n_rows"))
