"""End to end: raw snapshot folders (JSON, workbooks, CSV) -> refined -> published tables."""

import datetime as dt
import json
import os

from effort_analytics.config import TableSpec
from effort_analytics.operators import newest_load
from effort_analytics.plans import jobs
from effort_analytics.sources.xlsx import write_workbook

AT = dt.datetime(2024, 10, 15, 6, 0)
AS_OF = dt.date(2024, 10, 15)


def _mk(path):
    os.makedirs(path, exist_ok=True)
    return path


def _raw(root):
    ref = _mk(f"{root}/raw/reference")
    write_workbook(f"{ref}/reference.xlsx", {
        "Buckets": [["Bucket Name", "Bucket ID", "Source Planner"], ["Admin", "B1", "P"], ["Dev", "B2", "P"]],
        "Roles": [["JobTitle", "Group"], ["Engineer", "Tech"], ["Lead", "Mgmt"]],
        "PlannerCodes": [["Code", "Name"], ["[LEADS]", "Leads"], ["[DEV]", "Development"]],
        "ProductivityType": [["Category", "Type"], ["Admin", "Mixed"], ["Dev", "Productive"], ["Vacation", "Leave"]],
        "Members v2": [["Office365ID", "WorkdayID", "GivenName", "Surname", "AssignedTo (Display Name in Teams)",
                        "JobTitle", "ManagerName", "Squad", "StartDate", "EndDate"],
                       ["o1", 101, "Ann", "Lee", "Ann Lee", "Engineer", "Boss", "S1", "2024-01-01", "9999-12-31"],
                       ["o2", 102, "Bo", "Kim", "Bo Kim", "Lead", "Boss", "S1", "2024-10-07", "9999-12-31"]],
    })

    def task(i, title, bucket, progress, who, due, hours):
        return {"TaskID": i, "Title": title, "BucketID": bucket, "Progress": progress, "CreatedByOffice365ID": who,
                "CreatedDate": "2024-09-01", "StartDate": "2024-09-02", "DueDate": due, "CompletedDate": None,
                "hours": hours}
    old = _mk(f"{root}/raw/planner/2024/9/30/2359")
    with open(f"{old}/a.json", "w") as fh:
        fh.write(json.dumps(task("P1", "[DEV] old", "B2", "100", "o1", "2024-09-30", "99")) + "\n")
    new = _mk(f"{root}/raw/planner/2024/10/1/0800")
    with open(f"{new}/b.json", "w") as fh:
        for t in (task("P1", "[DEV] build", "B2", "100", "o1", "2024-10-02", "6"),
                  task("P2", "[LEADS] plan", "B1", "100", "o2", "2024-10-08", "40"),
                  task("P3", "[X] misc", "B1", "50", "o1", None, "2")):
            fh.write(json.dumps(t) + "\n")
    iss = _mk(f"{root}/raw/issues/2024/10/1/0900")
    write_workbook(f"{iss}/issues.xlsx", {"CDO-SSR": [
        ["Summary", "IssueKey", "Status", "Created", "Resolved", "TimeSpent", "Assignee", "Projectname"],
        ["Fix", "I-1", "Done", "2024-10-03", "2024-10-04", 7200, "Ann Lee", "Proj"],
        ["Gen", "I-2", "Done", "2024-10-03", "", 3600, "Ann Lee", "Generated X"]]})
    lv = _mk(f"{root}/raw/leaves/2024/10/1/0900")
    write_workbook(f"{lv}/leaves.xlsx", {"All Worker Time Off": [
        ["TimeOffDate", "Worker", "TimeOffAbsenceTable", "Type", "Approved", "UnitofTime"],
        ["2024-10-09", "Ann Lee (101)", "Abs", "Vacation", 1, "Days"],
        ["2024-10-10", "Ann Lee (101) (On Leave)", "Abs", "SICK DAY", 1, "Days"]]})
    people = _mk(f"{root}/raw/people")
    for name, rows in (("a.csv", ["Ann,Lee", "Bo,Kim"]), ("b.csv", ["Ann,Lee"])):
        with open(f"{people}/{name}", "w") as fh:
            fh.write("GivenName,Surname\n" + "\n".join(rows) + "\n")


def test_raw_to_published(spark, tmpdir_path):
    root = tmpdir_path
    _raw(root)
    db = "ea_jobs_db"
    spec = lambda name, src=(): TableSpec(name, tuple(src), f"{root}/refined/{name}", db, name)
    ref = [f"{root}/raw/reference"]
    for kind in ("buckets", "roles", "planner_codes", "productivity_types"):
        jobs.refine_lookup_job(spark, kind, spec(kind, ref), at=AT)
    jobs.refine_members_job(spark, spec("members", ref), ref[0], at=AT)
    leaves_spec = TableSpec("leaves", (f"{root}/raw/leaves",), f"{root}/refined/leaves")
    jobs.refine_leaves_job(spark, leaves_spec, load_id="2024-10-15", at=AT)
    jobs.refine_leaves_job(spark, leaves_spec, load_id="2024-10-15", at=AT)   # rerun: no doubling
    jobs.refine_leaves_job(spark, leaves_spec, load_id="2024-10-16", at=AT)   # the next day's load supersedes it
    tasks_spec = spec("tasks", [f"{root}/raw/planner", f"{root}/raw/issues"])
    jobs.refine_tasks_job(spark, tasks_spec, spec("members"), at=AT)
    jobs.refine_tasks_job(spark, tasks_spec, spec("members"), at=AT)          # rerun: upsert is idempotent
    date_spec = spec("dim_date")
    jobs.refine_date_job(spark, date_spec, as_of=AS_OF, at=AT)

    tasks = spark.table(f"{db}.tasks")
    got = sorted((r.TaskID, r.TC_PlannerCode, float(r.Hours), r.Progress) for r in tasks.collect())
    assert got == [("I-1", "CXMRA BAU", 2.0, 100), ("P1", "DEV", 6.0, 100), ("P2", "LEADS", 40.0, 100),
                   ("P3", "X", 2.0, 50)]
    leaves = spark.read.parquet(leaves_spec.output_path)
    assert sorted((r.EmployeeID, r.Worker) for r in newest_load(leaves).collect()) == [(101, "Ann Lee "), (101, "Ann Lee ")]

    read = lambda name: spark.table(f"{db}.{name}")
    calendar = spark.table(f"{db}.dim_date")
    fact_spec = TableSpec("vw_task_and_leaves", (), f"{root}/published/vw_task_and_leaves")
    for day in ("2024-10-15", "2024-10-16"):  # a second day's run changes no report
        jobs.publish_task_and_leaves_job(
            spark, fact_spec, tasks=tasks, leaves=leaves, members=read("members"), calendar=calendar,
            buckets=read("buckets"), productivity_types=read("productivity_types"), as_of=AS_OF, min_year=2024,
            load_id=day)
    fact = spark.read.parquet(fact_spec.output_path)
    task_spec = TableSpec("vw_task", (), f"{root}/published/vw_task")
    jobs.publish_task_job(spark, task_spec, tasks=tasks, members=read("members"), calendar=calendar,
                          buckets=read("buckets"), planner_codes=read("planner_codes"),
                          productivity_types=read("productivity_types"), min_year=2024)
    vw_task = {r.PlannerCode: (r.IsPlannerCodeCorrect, r.ProductivityType)
               for r in spark.read.parquet(task_spec.output_path).collect()}
    assert vw_task == {"DEV": ("Yes", "Productive"), "LEADS": ("Yes", "Productive")}

    target_spec = TableSpec("vw_target_hours", (), f"{root}/published/vw_target_hours")
    jobs.publish_target_hours_job(spark, target_spec, task_and_leaves=fact, run_year=2024)
    flagged = [(r.AssignedTo, r.DateYearMonthKey, float(r.TotalHours), float(r.FinalTargetHours))
               for r in spark.read.parquet(target_spec.output_path).collect()]
    # Ann: 11 weekdays x 7.5 = 82.5 minus 7.5 planned leave = 75; logged 6 + 2 + 7.5 + 7.5 = 23
    # Bo: 7 weekdays x 7.5 = 52.5; logged 40 >= 39.375, not flagged
    assert flagged == [("Ann Lee", "202410", 23.0, 75.0)]

    out = jobs.full_names_export_job(spark, f"{root}/raw/people", f"{root}/published/result_2024-10-15.csv")
    assert sorted(open(out).read().splitlines()) == ["Ann Lee", "Bo Kim", "FullName"]
