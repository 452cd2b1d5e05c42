"""Raw -> refined: members, leaves, lookups and the unified task load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import config as C
from ..functions import (bracket_code, day_name, hours_decimal, issue_completed_date,
                         issue_productive_date, issue_progress, issue_status,
                         planner_productive_date, planner_progress, planner_status,
                         seconds_to_hours, split_name_id, to_date_safe)
from ..operators.project import rename_drop, with_audit
from ..operators.tables import dedup_latest, upsert

HOURS = DecimalType(10, 2)

TASK_COLUMNS = [
    "UploadDate", "UploadBy", "Title", "TC_PlannerCode", "TaskID", "BucketID", "Progress",
    "TC_ProgressDescription", "CreatedByOffice365ID", "CreatedDate", "StartDate", "DueDate",
    "CompletedDate", "TC_ProductiveDate", "Hours",
]


def _audit_cols(uploader: str, at: dt.datetime | None):
    ts = F.current_timestamp() if at is None else F.lit(at.isoformat(sep=" ")).cast("timestamp")
    return [ts.alias("UploadDate"), F.lit(uploader).alias("UploadBy")]


# -- members / roles --------------------------------------------------------

def refine_members(raw_members: DataFrame, raw_roles: DataFrame, *, uploader: str = C.UPLOADER,
                   at: dt.datetime | None = None,
                   display_name_col: str = "AssignedTo (Display Name in Teams)") -> DataFrame:
    """Members with typed dates, role group from the roles sheet (inner join on
    job title) and ``IsActive`` = end date is the open sentinel."""
    m = raw_members.alias("m")
    r = raw_roles.select(F.col("JobTitle").alias("_jt"), F.col("Group").alias("RoleGroup"))
    j = m.join(r, F.col("m.JobTitle") == F.col("_jt"), "inner")
    return j.select(
        *_audit_cols(uploader, at),
        F.col("m.Office365ID").alias("Office365ID"),
        F.col("m.WorkdayID").try_cast("bigint").alias("WorkdayID"),
        F.col("m.GivenName").alias("GivenName"),
        F.col("m.Surname").alias("Surname"),
        F.col(f"m.`{display_name_col}`").alias("AssignedTo"),
        F.col("m.JobTitle").alias("JobTitle"),
        F.col("RoleGroup"),
        F.col("m.ManagerName").alias("ManagerName"),
        F.col("m.Squad").alias("Squad"),
        to_date_safe(F.col("m.StartDate")).alias("StartDate"),
        to_date_safe(F.col("m.EndDate")).alias("EndDate"),
        F.when(F.col("m.EndDate").cast("string") == C.OPEN_END_DATE_TEXT, F.lit(1).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint")).alias("IsActive"),
    )


# -- leaves -------------------------------------------------------------------

def refine_leaves(raw: DataFrame, *, uploader: str = C.UPLOADER, at: dt.datetime | None = None,
                  hours_per_unit=C.LEAVE_HOURS_PER_UNIT) -> DataFrame:
    """Leave entries: typed date and day name, worker label split into name and
    id, units as DECIMAL(10,2), fixed hours per unit."""
    name, ident = split_name_id("Worker")
    d = to_date_safe("TimeOffDate")
    return raw.select(
        *_audit_cols(uploader, at),
        d.alias("TimeOffDate"),
        day_name(d).alias("DayoftheWeek"),
        name.alias("Worker"),
        ident.alias("EmployeeID"),
        F.col("TimeOffAbsenceTable").cast("string").alias("TimeOffAbsenceTable"),
        F.col("Type").cast("string").alias("TimeOffTypeforTimeOffEntry"),
        F.col("Approved").try_cast(HOURS).alias("Unit"),
        F.lit(hours_per_unit).cast(HOURS).alias("TC_Hours"),
        F.col("UnitofTime").cast("string").alias("UnitofTime"),
    )


# -- lookups ------------------------------------------------------------------

def refine_lookup(raw: DataFrame, *, rename: dict | None = None, drop=(), constants: dict | None = None,
                  uploader: str = C.UPLOADER, at: dt.datetime | None = None) -> DataFrame:
    """Rename / drop / constant columns, then trailing audit columns."""
    out = rename_drop(raw, rename, drop, constants)
    return with_audit(out, uploader, at, first=False)


def refine_buckets(raw: DataFrame, **kw) -> DataFrame:
    return refine_lookup(raw, rename={"Bucket Name": "BucketName", "Bucket ID": "BucketID"},
                         drop=["Source Planner"], constants={"IsActive": 1}, **kw)


def refine_roles(raw: DataFrame, **kw) -> DataFrame:
    return refine_lookup(raw, **kw)


def refine_planner_codes(raw: DataFrame, **kw) -> DataFrame:
    return refine_lookup(raw, **kw)


def refine_productivity_types(raw: DataFrame, **kw) -> DataFrame:
    return refine_lookup(raw, drop=["Unnamed: 4"], **kw)


# -- tasks (two vocabularies, one table) -------------------------------------

def refine_planner_tasks(raw: DataFrame, *, uploader: str = C.UPLOADER,
                         at: dt.datetime | None = None) -> DataFrame:
    """Planner export (all text) -> task rows."""
    return raw.select(
        *_audit_cols(uploader, at),
        F.col("Title"),
        bracket_code("Title").alias("TC_PlannerCode"),
        F.col("TaskID"),
        F.col("BucketID"),
        planner_progress("Progress").alias("Progress"),
        planner_status("Progress").alias("TC_ProgressDescription"),
        F.col("CreatedByOffice365ID"),
        to_date_safe("CreatedDate").alias("CreatedDate"),
        to_date_safe("StartDate").alias("StartDate"),
        to_date_safe("DueDate").alias("DueDate"),
        to_date_safe("CompletedDate").alias("CompletedDate"),
        planner_productive_date("Progress", "DueDate", "StartDate", "CompletedDate").alias("TC_ProductiveDate"),
        hours_decimal("hours").alias("Hours"),
    )


def issue_preproc(raw: DataFrame, members: DataFrame, *,
                  excluded_prefix: str = C.ISSUE_EXCLUDED_PROJECT_PREFIX,
                  planner_code: str = C.ISSUE_PLANNER_CODE,
                  bucket_id: str = C.ISSUE_BUCKET_ID) -> DataFrame:
    """Issue rows joined to members by display name; generated projects (and a
    NULL project) left out."""
    m = members.select(F.col("AssignedTo").alias("_assignee"), F.col("Office365ID"))
    j = raw.join(m, F.col("Assignee") == F.col("_assignee"), "inner")
    j = j.where(~F.col("Projectname").startswith(excluded_prefix))
    return j.select(
        F.col("Summary").alias("Title"),
        F.lit(planner_code).alias("TC_PlannerCode"),
        F.col("IssueKey").alias("TaskID"),
        F.lit(bucket_id).alias("BucketID"),
        F.lit("").alias("Progress"),
        F.col("Status").alias("ProgressDescription"),
        F.col("Office365ID").alias("CreatedByOffice365ID"),
        F.col("Created").alias("CreatedDate"),
        F.col("Resolved").alias("CompletedDate"),
        F.col("TimeSpent").alias("TimeSpent"),
    )


def refine_issue_tasks(pre: DataFrame, *, uploader: str = C.UPLOADER,
                       at: dt.datetime | None = None) -> DataFrame:
    """Pre-processed issue rows -> task rows (second vocabulary)."""
    return pre.select(
        *_audit_cols(uploader, at),
        F.col("Title"),
        F.col("TC_PlannerCode"),
        F.col("TaskID"),
        F.col("BucketID"),
        issue_progress("Progress", "ProgressDescription").alias("Progress"),
        issue_status("Progress", "ProgressDescription").alias("TC_ProgressDescription"),
        F.col("CreatedByOffice365ID"),
        to_date_safe("CreatedDate").alias("CreatedDate"),
        F.lit(None).cast("date").alias("StartDate"),
        F.lit(None).cast("date").alias("DueDate"),
        issue_completed_date("CompletedDate").alias("CompletedDate"),
        issue_productive_date("ProgressDescription", "CompletedDate", "CreatedDate").alias("TC_ProductiveDate"),
        seconds_to_hours("TimeSpent").alias("Hours"),
    )


def unified_tasks(planner_raw: DataFrame, issues_raw: DataFrame, members: DataFrame, *,
                  uploader: str = C.UPLOADER, at: dt.datetime | None = None) -> DataFrame:
    """Both sources normalised into the task schema and appended (UNION ALL)."""
    planner = refine_planner_tasks(planner_raw, uploader=uploader, at=at)
    issues = refine_issue_tasks(issue_preproc(issues_raw, members), uploader=uploader, at=at)
    return planner.select(*TASK_COLUMNS).unionByName(issues.select(*TASK_COLUMNS))


def load_tasks(target: DataFrame, incoming: DataFrame, *, dedup: bool = True) -> DataFrame:
    """Upsert the incoming task rows into the task table by ``TaskID``.

    ``MERGE`` refuses a target row matched by two source rows; with ``dedup``
    the incoming rows are first reduced to one per id (latest productive date,
    then the rest of the row as tie-break), otherwise they are taken as is.
    """
    src = incoming
    if dedup:
        src = dedup_latest(incoming, ["TaskID"], ["TC_ProductiveDate", "CompletedDate", "Progress"],
                           keep_null_keys=True)
    return upsert(target, src, ["TaskID"])
