"""FX lookup by date: exact match, as-of with gaps and a tail, repeated
dates, and no job while the join is built."""

import datetime as dt
from decimal import Decimal as D

from kredex.functions import fx


def _rates(spark):
    return spark.createDataFrame(
        [(dt.date(2018, 1, 1), D("30.0000")), (dt.date(2018, 1, 5), D("31.0000")),
         (dt.date(2018, 1, 8), D("32.0000"))], "fecha date, tipo_cambio decimal(8,4)")


def _rows(spark):
    days = [dt.datetime(2017, 12, 31), dt.datetime(2018, 1, 1, 10), dt.datetime(2018, 1, 4),
            dt.datetime(2018, 1, 5), dt.datetime(2018, 1, 7, 23, 59), dt.datetime(2018, 1, 8),
            dt.datetime(2019, 3, 1), None]
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d timestamp_ntz")


def test_exact_date(spark):
    got = {r.i: r.fx_rate for r in fx.rate_by_date(_rows(spark), "d", _rates(spark)).collect()}
    assert got == {0: None, 1: D("30.0000"), 2: None, 3: D("31.0000"), 4: None,
                   5: D("32.0000"), 6: None, 7: None}


def test_as_of(spark):
    got = {r.i: r.fx_rate for r in
           fx.rate_by_date(_rows(spark), "d", _rates(spark), asof=True).collect()}
    assert got == {0: None, 1: D("30.0000"), 2: D("30.0000"), 3: D("31.0000"),
                   4: D("31.0000"), 5: D("32.0000"), 6: D("32.0000"), 7: None}


def test_repeated_date_raises_only_where_used(spark):
    import pytest
    twice = _rates(spark).union(spark.createDataFrame([(dt.date(2018, 1, 5), D("99.0000"))],
                                                      "fecha date, tipo_cambio decimal(8,4)"))
    rows = _rows(spark)
    for asof in (False, True):
        out = fx.rate_by_date(rows, "d", twice, asof=asof)
        assert out.where("i in (0, 1, 5, 7)").count() == 4
        with pytest.raises(Exception, match="exchange rate of a date"):
            out.where("i = 3").collect()


def test_no_job_while_the_join_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    rows, rates = _rows(spark), _rates(spark)
    spark.sparkContext.setJobGroup("fx-build", "fx")
    try:
        fx.rate_by_date(rows, "d", rates)
        fx.rate_by_date(rows, "d", rates, asof=True)
        assert list(tracker.getJobIdsForGroup("fx-build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
