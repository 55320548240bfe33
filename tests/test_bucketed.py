"""The layout by loan: no exchange for facts and spine, equal results."""

import datetime as dt
import re
import tempfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from kredex.operators import facts
from kredex.params import RunParams, ntz_literal
from kredex.plans.extract import build_extract
from kredex.sources import bucketed as B
from kredex.sources.collation import CASE_INSENSITIVE
from kredex.sources.tables import INPUT_SCHEMAS, TableSource
from test_micro_fixture import CUT, write_fixture

BUCKETS = 4


@pytest.fixture(scope="module")
def sources(spark):
    work = tempfile.mkdtemp(prefix="kredex-buckets-")
    write_fixture(spark, f"{work}/plain")
    plain = TableSource(spark, f"{work}/plain")
    for name in INPUT_SCHEMAS:
        rows = plain.read(name)
        if name in B.LOAN_KEYS:
            B.store(name, rows, f"{work}/by_loan/{name}", BUCKETS)
        else:
            rows.write.parquet(f"{work}/by_loan/{name}")
    kept = dict(cutoff=CUT.date(), collation=CASE_INSENSITIVE)
    return TableSource(spark, f"{work}/plain", **kept), B.BucketedSource(spark, f"{work}/by_loan", BUCKETS, **kept)


def plan_of(df):
    spark = df.sparkSession
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def exchanges(text):
    return len(re.findall(r"\bExchange ", text))


def test_facts_and_spine_need_no_exchange(spark, sources):
    _, src = sources
    cut = ntz_literal(CUT)
    assert exchanges(plan_of(facts.schedule_facts(src["plan_pagos"], cut))) == 0
    assert exchanges(plan_of(facts.history_facts(src["historia"]))) == 0        # its date level too
    assert exchanges(plan_of(facts.original_schedule_facts(src["plan_pagos_original"]))) == 0
    spine = (facts.valid(src["saldos"]).select("jts_oid", "c1620").join(src["universe"].select("jts_oid", "nro_prestamo"), "jts_oid")
             .join(facts.schedule_facts(src["plan_pagos"], cut), "jts_oid", "left")
             .join(facts.history_facts(src["historia"]), "jts_oid", "left")
             .join(facts.first_instalment_fees(src["gastos"]), "jts_oid", "left")
             .join(facts.accruals_at(src["devengamiento"], cut), "jts_oid", "left"))
    text = plan_of(spine)
    assert exchanges(text) == 0 and text.count("SortMergeJoin") == 5, text
    # the lock still reaches the scan, the day still cuts the dated tables
    assert "EqualTo(tz_lock,0)" in text
    assert len(re.findall(r"PartitionFilters: \[[^\]]*fecha", text)) == 2


def test_plain_layout_exchanges_the_same_plan(spark, sources):
    src, _ = sources
    assert exchanges(plan_of(facts.history_facts(src["historia"]))) == 2
    assert exchanges(plan_of(facts.schedule_facts(src["plan_pagos"], ntz_literal(CUT)))) == 1


def test_report_equals_the_plain_layout(spark, sources):
    p = RunParams(cutoff=CUT, tc=D("32.1234"), version="1")
    plain, by_loan = (sorted(map(str, build_extract(s, p, checked=True).collect())) for s in sources)
    assert len(plain) == 15 and by_loan == plain


def test_days_are_read_alone(spark, sources):
    _, src = sources
    assert src["universe"].count() == 15
    older = B.BucketedSource(spark, src.root, BUCKETS, cutoff=dt.date(2018, 9, 30))
    assert [r.nombre_cliente for r in older["universe"].collect()] == ["OLD"]


def test_a_hot_loan_is_refused(spark, tmp_path):
    rows = spark.range(50).select(F.lit(7).alias("saldos_jts_oid"), F.lit(1).alias("numero_cuota"), F.lit(1).alias("importe_gastos"))
    with pytest.raises(ValueError, match="a loan of gastos holds 50 rows"):
        B.store("gastos", rows, f"{tmp_path}/gastos", BUCKETS, most_rows=49)
    B.store("gastos", rows, f"{tmp_path}/gastos", BUCKETS, most_rows=50)
    assert B.open_table(spark, "gastos", f"{tmp_path}/gastos", BUCKETS).count() == 50
