"""Child rows of loans that the spine does not hold are dropped before their
shuffle, at equal results."""

import datetime as dt
import re
import tempfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from kredex.operators import facts
from kredex.params import RunParams, ntz_literal
from kredex.plans.extract import build_extract
from kredex.session import ENGINE_SQL_CONF
from kredex.sources.collation import CASE_INSENSITIVE
from kredex.sources.tables import TableSource
from test_micro_fixture import CUT, write_fixture

FILTER = "spark.sql.optimizer.runtime.bloomFilter."


@pytest.fixture(scope="module")
def src(spark):
    """The fixture plus 2,000 loans that only the child tables know."""
    root = tempfile.mkdtemp(prefix="kredex-filter-") + "/src"
    write_fixture(spark, root)
    for name, key in (("plan_pagos", "saldo_jts_oid"), ("historia", "saldos_jts_oid"), ("gastos", "saldos_jts_oid")):
        own = spark.read.parquet(f"{root}/{name}")
        own.crossJoin(spark.range(100_000, 102_000)).withColumn(key, F.col("id") * 31 + F.col(key)).drop("id") \
            .write.mode("append").parquet(f"{root}/{name}")
    return TableSource(spark, root, cutoff=dt.date(2018, 10, 31), collation=CASE_INSENSITIVE)


@pytest.fixture
def with_filter(spark):
    """Runs with or without filters on scans of any size, joins by shuffle."""
    base = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.maxPlanStringLength": "100000000"}
    old = {k: spark.conf.get(k, None) for k in [*base, FILTER + "enabled", FILTER + "applicationSideScanSizeThreshold"]}

    def use(on):
        for k, v in {**base, FILTER + "enabled": str(on).lower(), FILTER + "applicationSideScanSizeThreshold": "0"}.items():
            spark.conf.set(k, v)

    yield use
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def shuffled(df):
    """(rows, records written by all exchanges of a run)."""
    plan = df._jdf.queryExecution().executedPlan()
    rows = df._jdf.queryExecution().toRdd().count()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        m = node.metrics().get("shuffleRecordsWritten")
        total += m.get().value() if m.isDefined() else 0
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return rows, total


def spine_facts(src):
    spine = facts.valid(src["saldos"]).where("c1704 is not null").select("jts_oid").join(
        src["universe"].select("jts_oid", "nro_prestamo"), "jts_oid")
    return (spine.join(facts.schedule_facts(src["plan_pagos"], ntz_literal(CUT)), "jts_oid", "left")
            .join(facts.history_facts(src["historia"]), "jts_oid", "left")
            .join(facts.first_instalment_fees(src["gastos"]), "jts_oid", "left"))


def test_engine_settings_turn_the_filter_on(spark):
    assert ENGINE_SQL_CONF[FILTER + "enabled"] == "true" and spark.conf.get(FILTER + "enabled") == "true"
    # what is built and sent has a bound
    assert int(spark.conf.get(FILTER + "maxNumBits")) // 8 <= 16 << 20


def test_fewer_rows_are_shuffled(spark, src, with_filter):
    got = {}
    for on in (False, True):
        with_filter(on)
        df = spine_facts(src)
        got[on] = (*shuffled(df), sorted(map(str, spine_facts(src).collect())))
    assert got[True][2] == got[False][2] and len(got[True][2]) == 14
    assert got[False][1] > 10_000 and got[True][1] < 0.05 * got[False][1], (got[False][1], got[True][1])


def test_report_is_equal_and_its_children_are_filtered(spark, src, with_filter):
    p = RunParams(cutoff=CUT, tc=D("32.1234"), version="1")
    out = {}
    for on in (False, True):
        with_filter(on)
        df = build_extract(src, p, checked=True)
        out[on] = sorted(map(str, df.collect()))
        keys = re.findall(r"might_contain\(scalar-subquery#\d+ \[\w*#?\d*\], xxhash64\((\w+)#|might_contain\(scalar-subquery#\d+ \[\], xxhash64\((\w+)#",
                          df._jdf.queryExecution().optimizedPlan().toString())
        assert bool(keys) == on
    assert out[True] == out[False] and len(out[True]) == 15
