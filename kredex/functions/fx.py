"""Exchange-rate lookup by date.

One value per date is the table's contract. A date that is present more than
once raises, but only for a row that uses its rate (as a scalar lookup would).
The joins carry no hint: Spark broadcasts the rate table by its size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exprs import single_value

def rate_on(fx_rates: DataFrame, day: dt.date) -> DataFrame:
    """Rate of one date (exact match)."""
    return fx_rates.where(F.col("fecha") == F.lit(day)).select("tipo_cambio")


def one_rate_per_date(fx_rates: DataFrame) -> DataFrame:
    """(fecha, rate, rows): the rate of each date and how many rows it had."""
    return (fx_rates.groupBy(F.col("fecha").cast("date").alias("fecha"))
            .agg(F.max("tipo_cambio").alias("rate"), F.count(F.lit(1)).alias("rows")))


def rate_by_date(rows: DataFrame, date_col: Column | str, fx_rates: DataFrame,
                 out: str = "fx_rate", asof: bool = False, used: Column | None = None) -> DataFrame:
    """Attach to each row the rate of its date (a left lookup); with ``used``,
    only to rows for which it holds (a repeated date fails only these).

    ``asof=False``: exact-date match, NULL when the date has no rate.
    ``asof=True``: the last rate on or before the date. Each rate is valid from
    its date to the day before the next rate's date, the last one without end;
    those ranges are spelled out per calendar month they touch, so the lookup
    is an equi-join on the month with the day range as a condition. The window
    that finds the next date runs over one row per date.
    """
    d = F.to_date(F.col(date_col) if isinstance(date_col, str) else date_col)
    rates = one_rate_per_date(fx_rates)
    value = single_value(F.col("_fx_value"), F.coalesce("_fx_rows", F.lit(0)), "exchange rate of a date")
    rates = rates.select(F.col("fecha").alias("_fx_d"), F.col("rate").alias("_fx_value"), F.col("rows").alias("_fx_rows"))
    needed = F.lit(True) if used is None else used
    if not asof:
        return (rows.join(rates, d == F.col("_fx_d"), "left")
                .withColumn(out, F.when(needed, value)).drop("_fx_d", "_fx_value", "_fx_rows"))
    # the dates fold to one row each above, so this window sorts a row per day
    # the table covers
    nxt = F.lead("_fx_d").over(Window.orderBy("_fx_d"))
    ranges = rates.withColumn("_fx_to", nxt)
    months = F.explode(F.sequence(F.trunc("_fx_d", "month"), F.trunc(F.date_sub("_fx_to", 1), "month"), F.expr("interval 1 month")))
    ranges = ranges.where("_fx_to is not null").withColumn("_fx_month", months)
    joined = rows.join(ranges, (F.trunc(d, "month") == F.col("_fx_month"))
                       & (d >= F.col("_fx_d")) & (d < F.col("_fx_to")), "left")
    # the open end: one row by construction (an aggregate without keys)
    end = F.max(F.struct("_fx_d", "_fx_value", "_fx_rows"))
    joined = joined.crossJoin(F.broadcast(rates.agg(end.alias("_fx_end"))))
    tail = single_value(F.col("_fx_end._fx_value"), F.coalesce("_fx_end._fx_rows", F.lit(0)), "exchange rate of a date")
    return (joined.withColumn(out, F.when(needed & (d >= F.col("_fx_end._fx_d")), tail)
                              .when(needed, value))
            .drop("_fx_d", "_fx_value", "_fx_rows", "_fx_to", "_fx_month", "_fx_end"))
