"""String column expressions (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import ColumnOrName, as_col


def charindex(sub: str, s: ColumnOrName) -> Column:
    """1-based position of the first ``sub`` in ``s``; 0 when absent, NULL for NULL."""
    return F.instr(as_col(s), sub)


def bracket_code(title: ColumnOrName) -> Column:
    """Code taken from a bracketed title.

    Text before the first ``]`` with every ``[`` removed; without a ``]`` the
    whole title (nothing to remove). ``[AB] x`` -> ``AB``, ``pre [X] y`` ->
    ``pre X``, ``] y`` -> ``''``, ``[open`` -> ``[open``, NULL -> NULL.
    """
    t = as_col(title)
    pos = F.instr(t, "]")
    return F.when(pos > 0, F.replace(F.left(t, pos - 1), F.lit("["), F.lit(""))).otherwise(
        F.replace(t, F.lit("]"), F.lit(""))
    )


def split_name_id(worker: ColumnOrName) -> tuple[Column, Column]:
    """Split ``Name (123)`` into (``'Name '``, 123).

    The name keeps its trailing space. A label without ``(`` gives a NULL id;
    a non-numeric id gives NULL instead of an error.
    """
    w = as_col(worker)
    parts = F.split(w, "[(]")
    name = F.get(parts, 0)
    ident = F.get(F.split(F.get(parts, 1), "[)]"), 0).try_cast("bigint")
    return name, ident


def blank_to_null(s: ColumnOrName) -> Column:
    """NULL when the text is empty after trimming spaces, else the text unchanged."""
    c = as_col(s)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def normalized(s: ColumnOrName) -> Column:
    """``upper(trim(coalesce(s, '')))`` -- NULL becomes the empty string."""
    return F.upper(F.trim(F.coalesce(as_col(s), F.lit(""))))


def not_like_prefix(s: ColumnOrName, prefix: str) -> Column:
    """``s NOT LIKE 'prefix%'`` (NULL stays NULL, so a filter drops it)."""
    return ~as_col(s).startswith(prefix)


def not_in_normalized(s: ColumnOrName, values) -> Column:
    """Exclusion test on the normalised text; a NULL input is *kept*."""
    return ~normalized(s).isin([v.upper() for v in values])


def bracketed(code: ColumnOrName) -> Column:
    """``'[' || code || ']'`` -- NULL in, NULL out."""
    return F.concat(F.lit("["), as_col(code), F.lit("]"))


def full_name(given: ColumnOrName, surname: ColumnOrName) -> Column:
    """``given || ' ' || surname``; NULL when either part is NULL."""
    return F.concat(as_col(given), F.lit(" "), as_col(surname))
