"""Run parameters: cutoff date, cutoff FX rate, control version.

Each is a single value read once on the driver (a one-row parameter table,
``take(2)`` so that a second row is detected) and then used as a typed
literal, so it folds into the plans and reaches the Parquet scans as a pushed
filter.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sources.collation import CASE_INSENSITIVE, check


class ParameterError(ValueError):
    pass


def single_value(df: DataFrame, column: str):
    """``SET @x = (SELECT c FROM t ...)``: NULL for no row, an error for more
    than one row."""
    rows = df.select(column).take(2)
    if len(rows) > 1:
        raise ParameterError(f"parameter {column!r}: subquery returned more than 1 value")
    return rows[0][0] if rows else None


def round_to_minute(t: dt.datetime) -> dt.datetime:
    """``SMALLDATETIME`` keeps minutes, rounding 29.999 s and above up."""
    base = t.replace(second=0, microsecond=0)
    if t.second * 1_000_000 + t.microsecond >= 29_999_000:
        base += dt.timedelta(minutes=1)
    return base


def ntz_literal(t: dt.datetime | dt.date) -> Column:
    if not isinstance(t, dt.datetime):
        t = dt.datetime(t.year, t.month, t.day)
    return F.expr(f"timestamp_ntz '{t:%Y-%m-%d %H:%M:%S}'")


@dataclass(frozen=True)
class RunParams:
    cutoff: dt.datetime
    tc: Decimal | None
    version: str | None
    #: how coded text columns compare (``sources/collation.py``)
    collation: str = CASE_INSENSITIVE

    @property
    def cutoff_col(self) -> Column:
        return ntz_literal(self.cutoff)

    @property
    def cutoff_date_col(self) -> Column:
        return F.lit(self.cutoff.date())

    @property
    def tc_col(self) -> Column:
        return F.lit(self.tc).cast("decimal(8,4)")

    @property
    def version_col(self) -> Column:
        return F.lit(self.version).cast("string")

    @classmethod
    def resolve(cls, parametros: DataFrame, maestro: DataFrame,
                fx_rates: DataFrame | None = None,
                tc: Decimal | str | None = None,
                collation: str = CASE_INSENSITIVE) -> "RunParams":
        """Cutoff from the process-date table, version from the master row
        with state 1, FX rate given or looked up at the cutoff date."""
        cutoff = single_value(parametros, "fechaproceso")
        if cutoff is None:
            raise ParameterError("no process date")
        if isinstance(cutoff, dt.date) and not isinstance(cutoff, dt.datetime):
            cutoff = dt.datetime(cutoff.year, cutoff.month, cutoff.day)
        cutoff = round_to_minute(cutoff)
        version = single_value(maestro.where(F.col("estado") == 1), "id_maestrounico")
        if tc is None and fx_rates is not None:
            from .functions.fx import rate_on
            tc = single_value(rate_on(fx_rates, cutoff.date()), "tipo_cambio")
        tc = None if tc is None else Decimal(str(tc)).quantize(Decimal("0.0001"))
        return cls(cutoff=cutoff, tc=tc, version=version, collation=check(collation))
