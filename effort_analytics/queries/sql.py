"""Oracle SQL (DuckDB dialect) for the derived inputs and the refined tables.

An independent statement of the same derivations as
``effort_analytics.plans.analogues`` and the refine/publish rules, used only to
check the Spark results. Each entry is a CTE body; ``with_ctes`` pulls in the
dependencies in order.
"""

from __future__ import annotations

import re

# Run parameters of the analogue, as SQL literals (must equal plans.analogues)
AS_OF = "DATE '2000-12-31'"
RUN_YEAR = 2000
MIN_YEAR = 1995
LEADS = "'Brand#1'"
PLAIN = r"'\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]*)\s*'"


def hours_sql(x: str) -> str:
    return (f"CAST(CASE WHEN regexp_full_match({x}, {PLAIN}) "
            f"THEN coalesce(TRY_CAST({x} AS DECIMAL(10,2)), 0) ELSE 0 END AS DECIMAL(10,2))")


def seconds_sql(x: str) -> str:
    # exact half-up rounding of seconds/3600 to cents, in integer arithmetic
    t4 = f"CAST(TRY_CAST({x} AS DECIMAL(20,4)) * 10000 AS HUGEINT)"
    cents = f"(sign({t4}) * ((abs({t4}) * 2 + 360000) // 720000))"
    return (f"CASE WHEN regexp_full_match({x}, {PLAIN}) THEN coalesce(TRY_CAST("
            f"CAST({cents} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)), 0) "
            f"ELSE CAST(0 AS DECIMAL(10,2)) END")


def whole_sql(x: str) -> str:
    # a number's whole part: the value rounded towards zero
    return (f"CASE WHEN regexp_full_match({x}, {PLAIN}) "
            f"THEN TRY_CAST(trunc(TRY_CAST(trim({x}) AS DECIMAL(38,6))) AS BIGINT) END")


def bracket_sql(x: str) -> str:
    return (f"CASE WHEN strpos({x}, ']') > 0 THEN replace(left({x}, strpos({x}, ']') - 1), '[', '') "
            f"ELSE replace({x}, ']', '') END")


def ym_sql(d: str) -> str:
    return f"CAST(year({d}) * 100 + month({d}) AS BIGINT)"


def datekey_sql(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS BIGINT)"


CTE: dict[str, str] = {}

CTE["raw_members"] = """
SELECT 'O365-' || CAST(s_suppkey AS VARCHAR) AS Office365ID,
       CAST(s_suppkey AS VARCHAR) AS WorkdayID,
       split_part(s_name, '#', 1) AS GivenName,
       split_part(s_name, '#', 2) AS Surname,
       s_name AS "AssignedTo (Display Name in Teams)",
       n_name AS JobTitle,
       'Manager ' || CAST(s_nationkey % 5 AS VARCHAR) AS ManagerName,
       CAST(s_nationkey AS VARCHAR) AS Squad,
       CAST(DATE '1995-01-01' + CAST(s_suppkey % 700 AS INTEGER) AS VARCHAR) AS StartDate,
       CASE WHEN s_suppkey % 4 = 0 THEN '1999-12-31' ELSE '9999-12-31' END AS EndDate
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTE["raw_roles"] = """
SELECT n_name AS JobTitle, r_name AS "Group" FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTE["members"] = """
SELECT m.Office365ID, TRY_CAST(m.WorkdayID AS BIGINT) AS WorkdayID, m.GivenName, m.Surname,
       m."AssignedTo (Display Name in Teams)" AS AssignedTo, m.JobTitle, r."Group" AS RoleGroup,
       m.ManagerName, m.Squad, TRY_CAST(m.StartDate AS DATE) AS StartDate,
       TRY_CAST(m.EndDate AS DATE) AS EndDate,
       CASE WHEN m.EndDate = '9999-12-31' THEN 1 ELSE 0 END AS IsActive
FROM raw_members m JOIN raw_roles r ON m.JobTitle = r.JobTitle"""

CTE["raw_planner_tasks"] = """
SELECT '[' || p_brand || '] ' || p_name AS Title,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS TaskID,
       'BKT-' || p_type AS BucketID,
       CASE WHEN l_linestatus = 'F' THEN '100' WHEN l_linenumber % 2 = 1 THEN '50' ELSE '0' END AS Progress,
       'O365-' || CAST(l_suppkey AS VARCHAR) AS CreatedByOffice365ID,
       CAST(CAST(l_shipdate AS DATE) - 10 AS VARCHAR) AS CreatedDate,
       CAST(CAST(l_shipdate AS DATE) - l_linenumber AS VARCHAR) AS StartDate,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS DueDate,
       CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) + 1 AS VARCHAR) ELSE '' END AS CompletedDate,
       CASE l_linenumber % 4 WHEN 0 THEN q WHEN 1 THEN q || '.0' WHEN 2 THEN q || '.'
            ELSE ' ' || q || ' ' END AS hours
FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem WHERE l_returnflag <> 'R') l
JOIN part ON l_partkey = p_partkey"""

CTE["planner_tasks"] = f"""
SELECT Title, {bracket_sql('Title')} AS TC_PlannerCode, TaskID, BucketID,
       {whole_sql('Progress')} AS Progress,
       CASE WHEN Progress = '0' THEN 'Not Started' WHEN Progress = '50' THEN 'In Progress'
            WHEN Progress = '100' THEN 'COMPLETED' ELSE 'NOT RECOGNIZED PLEASE CONTACT ADMIN' END
         AS TC_ProgressDescription,
       CreatedByOffice365ID,
       TRY_CAST(CreatedDate AS DATE) AS CreatedDate, TRY_CAST(StartDate AS DATE) AS StartDate,
       TRY_CAST(DueDate AS DATE) AS DueDate, TRY_CAST(CompletedDate AS DATE) AS CompletedDate,
       CASE WHEN Progress = '100' AND DueDate IS NOT NULL THEN TRY_CAST(DueDate AS DATE)
            WHEN Progress = '100' AND StartDate IS NOT NULL THEN TRY_CAST(StartDate AS DATE)
            ELSE TRY_CAST(CompletedDate AS DATE) END AS TC_ProductiveDate,
       {hours_sql('hours')} AS Hours
FROM raw_planner_tasks"""

CTE["raw_issues"] = """
SELECT 'Order ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS Summary,
       'ISS-' || CAST(o_orderkey AS VARCHAR) AS IssueKey,
       CASE WHEN o_orderkey % 13 = 0 THEN 'In Review' WHEN o_orderkey % 17 = 0 THEN 'Blocked'
            WHEN o_orderstatus = 'F' THEN 'Done' WHEN o_orderstatus = 'O' THEN 'In Progress'
            ELSE 'To Do' END AS Status,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS Created,
       CASE WHEN o_orderstatus = 'F' THEN
            CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE CAST(CAST(o_orderdate AS DATE) + 5 AS VARCHAR) END
       END AS Resolved,
       CASE WHEN o_orderkey % 19 = 0 THEN 'n/a'
            ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 100000 AS VARCHAR) END AS TimeSpent,
       'Supplier#' || lpad(CAST(o_custkey % 100 AS VARCHAR), 9, '0') AS Assignee,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL
            WHEN o_orderkey % 9 = 0 THEN 'Generated ' || o_orderpriority
            ELSE 'Project ' || o_orderpriority END AS Projectname
FROM orders"""

CTE["issue_pre"] = """
SELECT i.Summary AS Title, 'CXMRA BAU' AS TC_PlannerCode, i.IssueKey AS TaskID,
       'CbLSYAsOKUCI457rdCaIEmQAMH40' AS BucketID, '' AS Progress, i.Status AS ProgressDescription,
       m.Office365ID AS CreatedByOffice365ID, i.Created AS CreatedDate, i.Resolved AS CompletedDate,
       i.TimeSpent
FROM raw_issues i JOIN members m ON i.Assignee = m.AssignedTo
WHERE NOT starts_with(i.Projectname, 'Generated')"""

CTE["issue_tasks"] = f"""
SELECT Title, TC_PlannerCode, TaskID, BucketID,
       CASE WHEN {whole_sql('Progress')} IS NOT NULL THEN {whole_sql('Progress')} * 100
            WHEN ProgressDescription = 'Done' THEN 100 ELSE 0 END AS Progress,
       CASE WHEN ({whole_sql('Progress')} = 0 OR ProgressDescription = 'To Do') THEN 'Not Started'
            WHEN ProgressDescription IN ('In Progress', 'In Review') THEN 'In Progress'
            WHEN ({whole_sql('Progress')} = 1 OR ProgressDescription = 'Done') THEN 'COMPLETED'
            ELSE 'NOT RECOGNIZED PLEASE CONTACT ADMIN' END AS TC_ProgressDescription,
       CreatedByOffice365ID,
       TRY_CAST(CreatedDate AS DATE) AS CreatedDate,
       CAST(NULL AS DATE) AS StartDate, CAST(NULL AS DATE) AS DueDate,
       TRY_CAST(CASE WHEN trim(CompletedDate) = '' THEN NULL ELSE CompletedDate END AS DATE) AS CompletedDate,
       CASE WHEN ProgressDescription = 'Done' AND CompletedDate IS NOT NULL AND trim(CompletedDate) <> ''
              THEN TRY_CAST(CompletedDate AS DATE)
            WHEN ProgressDescription = 'Done' AND CreatedDate IS NOT NULL THEN TRY_CAST(CreatedDate AS DATE)
            ELSE NULL END AS TC_ProductiveDate,
       {seconds_sql('TimeSpent')} AS Hours
FROM issue_pre"""

CTE["incoming_tasks"] = """
SELECT * FROM planner_tasks UNION ALL SELECT * FROM issue_tasks"""

# one row per TaskID: greatest (productive date, completed date, progress, rest of the row);
# NULL ids are all kept
CTE["tasks"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY TaskID ORDER BY
      TC_ProductiveDate DESC NULLS LAST, CompletedDate DESC NULLS LAST, Progress DESC NULLS LAST,
      Title DESC NULLS LAST, TC_PlannerCode DESC NULLS LAST, BucketID DESC NULLS LAST,
      TC_ProgressDescription DESC NULLS LAST, CreatedByOffice365ID DESC NULLS LAST,
      CreatedDate DESC NULLS LAST, StartDate DESC NULLS LAST, DueDate DESC NULLS LAST,
      Hours DESC NULLS LAST) AS rn
  FROM incoming_tasks WHERE TaskID IS NOT NULL) x
WHERE rn = 1
UNION ALL SELECT * FROM incoming_tasks WHERE TaskID IS NULL"""

CTE["raw_leaves"] = """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS TimeOffDate,
       CASE WHEN l_linenumber = 6
            THEN s_name || ' (' || CAST(s_suppkey AS VARCHAR) || ') (On Leave)'
            ELSE s_name || ' (' || CAST(s_suppkey AS VARCHAR) || ')' END AS Worker,
       'Absence ' || CAST(l_linenumber AS VARCHAR) AS TimeOffAbsenceTable,
       CASE l_linenumber WHEN 1 THEN 'SICK DAY' WHEN 2 THEN 'Business Unit Holiday'
            WHEN 3 THEN ' sick day ' WHEN 4 THEN 'Emergency Leave' ELSE 'Vacation' END AS "Type",
       CASE WHEN l_orderkey % 10 = 0 THEN '-1' WHEN l_linenumber % 2 = 0 THEN '0.5' ELSE '1' END AS Approved,
       'Days' AS UnitofTime
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE l_returnflag = 'R'"""

CTE["leaves"] = """
SELECT TRY_CAST(TimeOffDate AS DATE) AS TimeOffDate,
       dayname(TRY_CAST(TimeOffDate AS DATE)) AS DayoftheWeek,
       split_part(Worker, '(', 1) AS Worker,
       TRY_CAST(split_part(split_part(Worker, '(', 2), ')', 1) AS BIGINT) AS EmployeeID,
       TimeOffAbsenceTable, "Type" AS TimeOffTypeforTimeOffEntry,
       TRY_CAST(Approved AS DECIMAL(10,2)) AS Unit, CAST(7.5 AS DECIMAL(10,2)) AS TC_Hours, UnitofTime
FROM raw_leaves"""

CTE["raw_buckets"] = """
SELECT CASE WHEN p_type = 'ECONOMY' THEN 'Admin' ELSE p_type END AS "Bucket Name",
       'BKT-' || p_type AS "Bucket ID", 'Planner ' || p_type AS "Source Planner"
FROM (SELECT DISTINCT p_type FROM part) t"""

CTE["buckets"] = """
SELECT "Bucket Name" AS BucketName, "Bucket ID" AS BucketID, 1 AS IsActive FROM raw_buckets"""

CTE["planner_codes"] = """
SELECT '[' || p_brand || ']' AS Code, 'Code ' || p_brand AS Name
FROM (SELECT DISTINCT p_brand FROM part) b
WHERE TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) % 3 <> 0"""

CTE["productivity_types"] = """
SELECT CASE WHEN p_type = 'ECONOMY' THEN 'Admin' ELSE p_type END AS Category,
       CASE WHEN p_type = 'ECONOMY' THEN 'Mixed'
            WHEN p_type IN ('STANDARD', 'MEDIUM', 'LARGE') THEN 'Productive'
            ELSE 'Nonproductive' END AS "Type"
FROM (SELECT DISTINCT p_type FROM part) t
UNION ALL
SELECT DISTINCT "Type" AS Category, 'Leave' AS "Type" FROM raw_leaves WHERE "Type" IS NOT NULL"""

CTE["dim_date"] = f"""
SELECT {datekey_sql('d')} AS DateKey, d AS DateShort, year(d) AS DateYear, quarter(d) AS DateQuarter,
       'Q' || CAST(quarter(d) AS VARCHAR) || '-' || CAST(year(d) AS VARCHAR) AS DateQuarterName,
       month(d) AS DateMonthNum, monthname(d) AS DateMonthName, day(d) AS DateDayNum,
       dayname(d) AS DateDayName, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend
FROM (SELECT CAST(g AS DATE) AS d
      FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(g)
      UNION ALL SELECT DATE '1900-01-01' UNION ALL SELECT DATE '9999-12-31') days"""

CTE["expected"] = f"""
SELECT m.WorkdayID, {ym_sql('dd.DateShort')} AS YearMonth, COUNT(*) AS TotalWorkingDays,
       COUNT(*) * 7.5 AS TargetHours
FROM members m JOIN dim_date dd
  ON dd.IsWeekend = 0 AND dd.DateYear >= {MIN_YEAR} AND dd.DateShort <= {AS_OF}
 AND dd.DateShort BETWEEN m.StartDate AND m.EndDate
GROUP BY 1, 2"""

CTE["planned"] = f"""
SELECT l.EmployeeID AS WorkdayID, {ym_sql('l.TimeOffDate')} AS YearMonth,
       SUM(l.TC_Hours * l.Unit) AS TotalHoursToDeduct
FROM leaves l
WHERE l.TimeOffDate IS NOT NULL
  AND upper(trim(coalesce(l.TimeOffTypeforTimeOffEntry, ''))) NOT IN
      ('SICK DAY', 'EMERGENCY LEAVE', 'PHILIPPINES UNPAID TIME OFF')
  AND EXISTS (SELECT 1 FROM dim_date dd WHERE dd.DateShort = l.TimeOffDate)
GROUP BY 1, 2"""

CTE["task_leave_rows"] = """
SELECT S.TaskID, S.TC_ProductiveDate AS "Date", B.BucketName AS Category,
       S.TC_PlannerCode AS PlannerCode, CAST(S.Hours AS DECIMAL(21,4)) AS Hours,
       M.AssignedTo, M.RoleGroup AS "Role", M.Squad, M.ManagerName, M.WorkdayID
FROM tasks S
JOIN members M ON M.Office365ID = S.CreatedByOffice365ID
LEFT JOIN buckets B ON B.BucketID = S.BucketID
WHERE S.Progress = 100 AND S.TC_ProductiveDate IS NOT NULL
UNION ALL
SELECT '' AS TaskID, S.TimeOffDate AS "Date", S.TimeOffTypeforTimeOffEntry AS Category,
       S.TimeOffTypeforTimeOffEntry AS PlannerCode, CAST(S.TC_Hours * S.Unit AS DECIMAL(21,4)) AS Hours,
       M.AssignedTo, M.RoleGroup AS "Role", M.Squad, M.ManagerName, M.WorkdayID
FROM leaves S
JOIN members M ON M.WorkdayID = S.EmployeeID
JOIN dim_date D ON D.DateShort = S.TimeOffDate
WHERE S.TimeOffDate IS NOT NULL AND S.TimeOffTypeforTimeOffEntry NOT LIKE 'Business Unit Holiday%'"""

CTE["final_tbl"] = f"""
SELECT DISTINCT S.TaskID, S."Date", D.DateKey, D.DateYear, D.DateMonthName, D.DateMonthNum,
       substring(CAST(D.DateKey AS VARCHAR), 1, 6) AS DateYearMonthKey,
       S.Category, S.PlannerCode,
       CASE WHEN S.Category = 'Admin' AND S.PlannerCode = {LEADS} THEN 'Productive'
            WHEN S.Category = 'Admin' AND S.PlannerCode <> {LEADS} THEN 'Nonproductive'
            ELSE P."Type" END AS ProductivityType,
       S.AssignedTo, S."Role", S.Squad, S.ManagerName, S.WorkdayID, S.Hours,
       CAST(S.WorkdayID AS VARCHAR) || substring(CAST(D.DateKey AS VARCHAR), 1, 6) AS WorkdayIDYearMonthKey,
       E.TargetHours, coalesce(PL.TotalHoursToDeduct, 0) AS TotalHoursToDeduct,
       E.TargetHours - coalesce(PL.TotalHoursToDeduct, 0) AS FinalTargetHours
FROM task_leave_rows S
LEFT JOIN dim_date D ON D.DateShort = S."Date"
LEFT JOIN productivity_types P ON P.Category = S.Category
LEFT JOIN expected E ON E.WorkdayID = S.WorkdayID AND E.YearMonth = {ym_sql('D.DateShort')}
LEFT JOIN planned PL ON PL.WorkdayID = S.WorkdayID AND PL.YearMonth = {ym_sql('D.DateShort')}
WHERE D.DateYear >= {MIN_YEAR}"""

CTE["vw_task_and_leaves"] = """
SELECT "Date", DateKey, DateYear, DateMonthName, DateMonthNum, DateYearMonthKey, Category, PlannerCode,
       ProductivityType, AssignedTo, "Role", Squad, ManagerName, WorkdayID, Hours,
       WorkdayIDYearMonthKey, TargetHours, TotalHoursToDeduct, FinalTargetHours
FROM final_tbl"""


_WORD = re.compile(r"\b([a-z_]+)\b")


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding every CTE the body (transitively) uses, in order."""
    ctes = dict(CTE)
    ctes.update(extra or {})
    order: list[str] = []

    def visit(name: str, stack=()):
        if name in order or name in stack:
            return
        for d in [w for w in dict.fromkeys(_WORD.findall(ctes[name])) if w in ctes and w != name]:
            visit(d, stack + (name,))
        order.append(name)

    for w in dict.fromkeys(_WORD.findall(body)):
        if w in ctes:
            visit(w)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in order) + "\n" + body
