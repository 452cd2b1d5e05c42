"""Runnable jobs: raw files -> refined tables -> published tables.

Each job reads its inputs (latest snapshot folder, workbook sheet, JSON, CSV,
or refined tables), applies the plans of this package and writes its output
once. Paths come from :class:`~effort_analytics.config.TableSpec`; the run date
and upload time are parameters. Tables are Parquet folders (registered in the
catalogue when a database is named); a rewrite of a table that the plan reads
goes to a new version folder first (``sources.replace_table``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..operators.snapshot import newest_entries, newest_load
from ..operators.tables import empty_like
from ..sources import keyed, readers, sinks, versions
from . import calendar as cal_plans
from . import facts, refine, targets

MEMBER_COLUMNS = ["Office365ID", "WorkdayID", "GivenName", "Surname", "AssignedTo (Display Name in Teams)",
                  "JobTitle", "ManagerName", "Squad", "StartDate", "EndDate"]
ISSUE_COLUMNS = ["Summary", "IssueKey", "Status", "Created", "Resolved", "TimeSpent", "Assignee", "Projectname"]
#: What names a leave entry among loads: a worker, a day and a type.
LEAVE_ENTRY = ["EmployeeID", "TimeOffDate", "TimeOffTypeforTimeOffEntry"]
LEAVE_COLUMNS = ["TimeOffDate", "Worker", "TimeOffAbsenceTable", "Type", "Approved", "UnitofTime"]
PLANNER_JSON_SCHEMA = ("Title STRING, TaskID STRING, BucketID STRING, Progress STRING, "
                       "CreatedByOffice365ID STRING, CreatedDate STRING, StartDate STRING, DueDate STRING, "
                       "CompletedDate STRING, hours STRING")


def latest_snapshot_path(spark: SparkSession, root: str, depth: int = 4, numeric: bool = True) -> str:
    """Newest ``year/month/day/hourmin`` folder under ``root``.

    Folder *names* are listed level by level with the Hadoop file system (metadata
    only, like the notebooks' listing); names compare as integers when numeric, so
    an unpadded ``10`` beats ``9``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    for _ in range(depth):
        dirs = [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
        if not dirs:
            raise FileNotFoundError(f"no snapshot folder under {path}")

        def key(p):
            name = p.getName()
            return (0, int(name), name) if numeric and name.isdigit() else (-1, 0, name)

        path = max(dirs, key=key)
    return path.toString()


def _write(df: DataFrame, spec: C.TableSpec, mode: str = "overwrite") -> None:
    sinks.write_table(df, spec.output_path, mode=mode)
    if spec.database:
        sinks.register_table(df.sparkSession, spec.database, spec.table, spec.output_path)


def read_refined(spark: SparkSession, spec: C.TableSpec) -> DataFrame:
    """A table's current rows: through the catalogue where it is registered, else the current version
    of a versioned folder, else the folder."""
    current = _current(spark, spec)
    return spark.read.parquet(spec.output_path) if current is None else current


def _current(spark: SparkSession, spec: C.TableSpec) -> DataFrame | None:
    """The current version of a versioned table, as the catalogue or the folder itself tells it."""
    if spec.database and spark.catalog.tableExists(spec.qualified_name):
        return spark.table(spec.qualified_name)
    found = versions.current(spark, spec.output_path)
    if found is None:
        return None
    return keyed.read_keyed(spark, spec.output_path) if "parts" in found[1] else versions.read_current(spark, spec.output_path)


# -- refine jobs -------------------------------------------------------------------

def refine_lookup_job(spark: SparkSession, kind: str, spec: C.TableSpec, *, at: dt.datetime | None = None) -> None:
    """Buckets / roles / planner codes / productivity types from their workbook sheet."""
    sheets = {"buckets": (C.SHEET_BUCKETS, ["Bucket Name", "Bucket ID", "Source Planner"], refine.refine_buckets),
              "roles": (C.SHEET_ROLES, ["JobTitle", "Group"], refine.refine_roles),
              "planner_codes": (C.SHEET_PLANNER_CODES, ["Code", "Name"], refine.refine_planner_codes),
              "productivity_types": (C.SHEET_PRODUCTIVITY_TYPES, ["Category", "Type"],
                                     refine.refine_productivity_types)}
    sheet, cols, fn = sheets[kind]
    raw = readers.read_workbooks(spark, spec.src_paths[0], sheet, cols)
    _write(fn(raw, at=at), spec)


def refine_members_job(spark: SparkSession, spec: C.TableSpec, roles_src: str, *,
                       at: dt.datetime | None = None) -> None:
    raw = readers.read_workbooks(spark, spec.src_paths[0], C.SHEET_MEMBERS, MEMBER_COLUMNS)
    roles = readers.read_workbooks(spark, roles_src, C.SHEET_ROLES, ["JobTitle", "Group"])
    _write(refine.refine_members(raw, roles, at=at), spec)


def refine_leaves_job(spark: SparkSession, spec: C.TableSpec, *, load_id: str,
                      at: dt.datetime | None = None) -> None:
    """Leave entries of the newest snapshot, kept per ``load_id``. A snapshot may hold new or
    changed entries only: readers take the newest load of each (``operators.newest_entries``
    by ``LEAVE_ENTRY``)."""
    src = latest_snapshot_path(spark, spec.src_paths[0])
    raw = readers.read_workbooks(spark, src, C.SHEET_LEAVES, LEAVE_COLUMNS)
    sinks.append_load(refine.refine_leaves(raw, at=at), spec.output_path, load_id)


def refine_tasks_job(spark: SparkSession, spec: C.TableSpec, members_spec: C.TableSpec, *,
                     at: dt.datetime | None = None, buckets: int = 256) -> None:
    """Newest planner JSON snapshot + newest issue workbook snapshot, normalised,
    unioned, reduced to one row per task id and upserted into the task table, which
    is stored by key bucket: only touched buckets are read and written, and they are
    published in one step (in the catalogue: as a view of the current version)."""
    planner_src = latest_snapshot_path(spark, spec.src_paths[0])
    issue_src = latest_snapshot_path(spark, spec.src_paths[1])
    planner = readers.read_json(spark, planner_src, PLANNER_JSON_SCHEMA)
    issues = readers.read_workbooks(spark, issue_src, C.SHEET_ISSUES, ISSUE_COLUMNS)
    incoming = refine.unified_tasks(planner, issues, read_refined(spark, members_spec), at=at)
    keyed.upsert_keyed(refine.load_tasks(empty_like(incoming), incoming), spec.output_path, ["TaskID"],
                       buckets=buckets)
    if spec.database:
        keyed.register_keyed(spark, spec.database, spec.table, spec.output_path)


def refine_date_job(spark: SparkSession, spec: C.TableSpec, *, as_of: dt.date,
                    csv_src: str | None = None, at: dt.datetime | None = None) -> str:
    """Calendar: load a calendar CSV as the starting table when given, else the
    current table (or nothing); extend/refresh it (C1); write a new version."""
    existing = readers.read_csv(spark, csv_src, inferSchema=True) if csv_src else _current(spark, spec)
    if existing is None:
        out = cal_plans.date_dimension(spark, as_of, run_at=at)
    else:
        out = cal_plans.upsert_calendar(existing.select(*cal_plans.CALENDAR_COLUMNS), as_of, run_at=at)
    return sinks.replace_table(out, spec.output_path, spec.qualified_name if spec.database else None)


# -- publish jobs ------------------------------------------------------------------

def publish_task_job(spark: SparkSession, out: C.TableSpec, *, tasks: DataFrame, members: DataFrame,
                     calendar: DataFrame, buckets: DataFrame, planner_codes: DataFrame,
                     productivity_types: DataFrame, min_year: int = C.MIN_REPORT_YEAR) -> None:
    _write(facts.task_fact(tasks, members, calendar, buckets, planner_codes, productivity_types,
                           min_year=min_year), out)


def publish_task_and_leaves_job(spark: SparkSession, out: C.TableSpec, *, tasks: DataFrame, leaves: DataFrame,
                                members: DataFrame, calendar: DataFrame, buckets: DataFrame,
                                productivity_types: DataFrame, as_of: dt.date,
                                min_year: int = C.MIN_REPORT_YEAR, load_id: str | None = None,
                                whole_snapshots: bool = False, clip_leave_to_as_of: bool = False) -> None:
    """The task-and-leave fact, overwritten; with ``load_id`` each load is kept, and
    readers take the newest (appending without that doubles hours on a rerun).
    Of ``leaves`` the newest load of each entry is read, or, with ``whole_snapshots``,
    the newest load alone. ``clip_leave_to_as_of`` leaves out planned leave after the
    run date, as the target does with working days."""
    leaves = newest_load(leaves) if whole_snapshots else newest_entries(leaves, LEAVE_ENTRY)
    expected = targets.expected_hours(members, calendar, as_of, min_year)
    planned = targets.planned_leave_deduction(leaves, calendar, as_of=as_of if clip_leave_to_as_of else None)
    fact = facts.task_and_leave_fact(tasks, leaves, members, buckets, calendar, productivity_types, expected, planned, min_year=min_year)
    if load_id:
        sinks.append_load(fact, out.output_path, load_id)
    else:
        _write(fact, out)


def publish_target_hours_job(spark: SparkSession, out: C.TableSpec, *, task_and_leaves: DataFrame,
                             run_year: int) -> None:
    _write(targets.flag_under_target(newest_load(task_and_leaves), run_year), out)


def full_names_export_job(spark: SparkSession, csv_folder: str, target_file: str) -> str:
    """Distinct full names across every CSV in a folder, exported as one CSV file."""
    people = readers.read_csv_tagged(spark, csv_folder, readers.string_schema(["GivenName", "Surname"]))
    return sinks.export_single_csv(facts.distinct_full_names(people), target_file)
