"""Column helpers for the report's scalar rules.

All helpers return JVM-side ``Column`` expressions built from
``pyspark.sql.functions``; none of them is a Python UDF, so every rule stays
inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the report (they must equal the reference's output text).
REPORT_DATE_FORMAT = "dd/MM/yyyy"
NO_DATE_SENTINEL = _dt.date(1900, 1, 1)
FUNDING_SOURCE = "Fondos Propios"
GROUP_LOAN = "GRUPO SOLIDARIO"
LEGAL_PERSON = "J"
WRITTEN_OFF = "Saneado"
IN_COURT = "Cobro Judicial"
RATE_HISTORY_STATES = ("C", "E")
VARIABLE_RATE_PRODUCT = "COLABORADORES"
# modality code -> report text; any other code gives ''
MODALITY_TEXT = {"F": "Cuota Fija", "H": "Decreciente", "": "Al Vencimiento", "C": "Irregular"}
# risk grade -> class number; any other grade gives 0 (T-SQL casts '' to int 0)
GRADE_CLASS = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5}
WRITTEN_OFF_CLIENT_CLASS = 5
PERSON_NATURAL = "Natural"
PERSON_LEGAL = "Juridica"
RATE_VARIABLE = "Variable"
RATE_FIXED = "Fija"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_code(c: str | Column, *codes: str) -> Column:
    """Whether a coded column holds one of ``codes``, by the column's own
    collation (``sources/collation.py``)."""
    return col(c) == F.lit(codes[0]) if len(codes) == 1 else col(c).isin(*codes)


def day_diff(start: str | Column, end: str | Column) -> Column:
    """``DATEDIFF(DAY, start, end)``: calendar midnights crossed, not whole
    24-hour spans. ``datediff(end, start)`` on dates gives exactly that."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def fmt_date(c: str | Column) -> Column:
    """``FORMAT(d, 'dd/MM/yyyy')``; NULL stays NULL."""
    return F.date_format(col(c), REPORT_DATE_FORMAT)


def fmt_date_or_blank(c: str | Column) -> Column:
    """``ISNULL(FORMAT(d, 'dd/MM/yyyy'), '')``."""
    return F.coalesce(fmt_date(c), F.lit(""))


def sentinel_blank(c: str | Column) -> Column:
    """Formatted date where the 01/01/1900 placeholder becomes ''; NULL stays
    NULL. The comparison is on the formatted day, so any time of that day
    counts as the placeholder."""
    return (F.when(F.to_date(col(c)) == F.lit(NO_DATE_SENTINEL), F.lit(""))
            .otherwise(fmt_date(c)))


def grade_to_class(c: str | Column) -> Column:
    """Simple ``CASE`` grade A..E -> 1..5; anything else (NULL too) -> 0."""
    out = None
    for grade, n in GRADE_CLASS.items():
        cond = is_code(c, grade)
        out = F.when(cond, F.lit(n)) if out is None else out.when(cond, F.lit(n))
    return out.otherwise(F.lit(0))


def modality_text(c: str | Column) -> Column:
    out = None
    for code, text in MODALITY_TEXT.items():
        cond = is_code(c, code)
        out = F.when(cond, F.lit(text)) if out is None else out.when(cond, F.lit(text))
    return out.otherwise(F.lit(""))


def fx_factor(currency: str | Column, tc: Column) -> Column:
    """``CASE currency WHEN 1 THEN 1 ELSE @TC END`` (NULL currency takes TC)."""
    return F.when(col(currency) == 1, F.lit(1).cast("decimal(8,4)")).otherwise(tc)


def effective_annual_rate_raw(rate: str | Column) -> Column:
    """``(POWER(1 + (r/100)/12, 12) - 1) * 100`` as a double (Spark's ``pow``
    is double; T-SQL keeps the decimal base type)."""
    monthly = col(rate).cast("double") / 100.0 / 12.0
    return (F.pow(F.lit(1.0) + monthly, F.lit(12.0)) - 1.0) * 100.0


def effective_annual_rate(rate: str | Column) -> Column:
    """The effective annual rate rounded to 4 places; equal to the exact
    decimal result except at exact ties of the fifth decimal."""
    return effective_annual_rate_raw(rate).cast("decimal(15,4)")


def rate_to_sink(c: str | Column) -> Column:
    """Rates are computed as ``CONVERT(NUMERIC(15,4), ...)`` and inserted into a
    ``numeric(15,2)`` column: two roundings, both HALF_UP."""
    return col(c).cast("decimal(15,4)").cast("decimal(15,2)")


def quote_id(c: str | Column) -> Column:
    """``CONCAT('"', x, '"')``: NULL gives ``""`` (plain ``concat`` would
    return NULL)."""
    return F.concat_ws("", F.lit('"'), col(c).cast("string"), F.lit('"'))


def nonblank_or_empty(c: str | Column) -> Column:
    """``CASE WHEN LEN(x) > 0 THEN x ELSE '' END``: ``LEN`` ignores trailing
    blanks, so blank-only text and NULL both become ''."""
    return F.when(F.length(F.rtrim(col(c))) > 0, col(c)).otherwise(F.lit(""))


def single_value(value: Column, count: Column, what: str) -> Column:
    """A scalar subquery that must return at most one row: the value when the
    row count is 0 or 1, a runtime error otherwise. Use inside the branch that
    needs the value, so only rows taking that branch can fail."""
    return F.when(count > 1, F.raise_error(F.lit(
        f"subquery returned more than 1 value: {what}"))).otherwise(value)
