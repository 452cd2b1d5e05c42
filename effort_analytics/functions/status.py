"""Status, progress, productive date and productivity class (two vocabularies)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from ._util import ColumnOrName, as_col
from .dates import to_date_safe
from .numbers import whole_number
from .text import blank_to_null


# -- planner source: progress is text '0' / '50' / '100' -------------------

def planner_progress(progress: ColumnOrName) -> Column:
    """Progress text as a whole number; a fraction is cut off."""
    return whole_number(progress)


def planner_status(progress: ColumnOrName, vocabulary: dict | None = None,
                   unknown: str = C.STATUS_UNKNOWN) -> Column:
    p = as_col(progress)
    vocab = vocabulary or C.PLANNER_PROGRESS_STATUS
    expr = None
    for code, label in vocab.items():
        expr = (F.when(p == code, label) if expr is None else expr.when(p == code, label))
    return expr.otherwise(unknown)


def planner_productive_date(progress: ColumnOrName, due: ColumnOrName, start: ColumnOrName,
                            completed: ColumnOrName, done: str = C.PLANNER_DONE_PROGRESS) -> Column:
    """Done: due date, else start date when due is missing; otherwise the completed date.

    The NULL tests look at the raw text, so an unparseable due date gives NULL
    and does not fall through to the start date.
    """
    p, du, st, co = (as_col(x) for x in (progress, due, start, completed))
    is_done = p == done
    return (F.when(is_done & du.isNotNull(), to_date_safe(du))
            .when(is_done & st.isNotNull(), to_date_safe(st))
            .otherwise(to_date_safe(co)))


# -- issue source: progress text (always '' there) plus a status word -------

def issue_progress(progress: ColumnOrName, status: ColumnOrName,
                   done: str = C.ISSUE_DONE) -> Column:
    """Numeric progress x 100; else 100 when done; else 0."""
    p, s = as_col(progress), as_col(status)
    return (F.when(whole_number(p, "int").isNotNull(), whole_number(p) * 100)
            .when(s == done, F.lit(100).cast("bigint"))
            .otherwise(F.lit(0).cast("bigint")))


def issue_status(progress: ColumnOrName, status: ColumnOrName) -> Column:
    p, s = as_col(progress), as_col(status)
    pn = whole_number(p, "int")
    return (F.when((pn == 0) | (s == C.ISSUE_TODO), C.STATUS_NOT_STARTED)
            .when(s.isin(*C.ISSUE_IN_PROGRESS), C.STATUS_IN_PROGRESS)
            .when((pn == 1) | (s == C.ISSUE_DONE), C.STATUS_COMPLETED)
            .otherwise(C.STATUS_UNKNOWN))


def issue_productive_date(status: ColumnOrName, completed: ColumnOrName, created: ColumnOrName,
                          done: str = C.ISSUE_DONE) -> Column:
    """Done: the completed date when not blank, else the created date; otherwise NULL."""
    s, co, cr = as_col(status), as_col(completed), as_col(created)
    is_done = s == done
    return (F.when(is_done & co.isNotNull() & (F.trim(co) != ""), to_date_safe(co))
            .when(is_done & cr.isNotNull(), to_date_safe(cr))
            .otherwise(F.lit(None).cast("date")))


def issue_completed_date(completed: ColumnOrName) -> Column:
    return to_date_safe(blank_to_null(completed))


# -- published facts -------------------------------------------------------

def productivity_class(category: ColumnOrName, code: ColumnOrName, lookup_type: ColumnOrName,
                       admin: str = C.ADMIN_CATEGORY, leads: str = C.LEADS_CODE) -> Column:
    """'Admin' + leads code -> Productive; 'Admin' + other code -> Nonproductive;
    otherwise (a NULL code included) the lookup's type."""
    cat, cd, lt = as_col(category), as_col(code), as_col(lookup_type)
    return (F.when((cat == admin) & (cd == leads), C.PRODUCTIVE)
            .when((cat == admin) & (cd != leads), C.NONPRODUCTIVE)
            .otherwise(lt))


def code_found_flag(code_key: ColumnOrName) -> Column:
    return F.when(as_col(code_key).isNull(), C.CODE_MISSING).otherwise(C.CODE_FOUND)
