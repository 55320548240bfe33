"""Plan-shape checks of the full extract: no Python UDF, no cartesian or
nested-loop join, filters and column pruning reach the scans."""

import re

import pytest

import __spark_entry__ as E


@pytest.fixture(scope="module")
def plan(spark, sf_dir):
    df = E.queries()["portfolio_extract"](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf(plan):
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF", plan)


def test_no_cartesian_or_nested_loop(plan):
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_lock_filter_pushed_to_scans(spark):
    """On source folders the lock is a stored column; its filter reaches the
    scan of the schedule."""
    import tempfile

    from kredex.operators import facts
    from kredex.params import ntz_literal
    from kredex.sources.tables import TableSource
    from test_micro_fixture import write_fixture
    import datetime as dt
    root = tempfile.mkdtemp(prefix="kredex-push-") + "/src"
    write_fixture(spark, root)
    src = TableSource(spark, root, cutoff=dt.date(2018, 10, 31))
    p = facts.schedule_facts(src["plan_pagos"], ntz_literal(dt.datetime(2018, 10, 31)))
    text = p._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(tz_lock,0\)", text), text
    # accruals are stored by date: the cutoff cuts them by partition
    text = facts.accruals_at(src["devengamiento"], ntz_literal(dt.datetime(2018, 10, 31)))._jdf.queryExecution() \
        .executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*fecha", text), text


def test_schedule_scan_is_pruned(spark, sf_dir):
    from kredex.operators import facts
    from kredex.plans.catalog import Ctx
    c = Ctx(spark, sf_dir)
    p = facts.schedule_facts(c["plan_pagos"], c.p.cutoff_col)
    txt = p._jdf.queryExecution().executedPlan().toString()
    scan = [l for l in txt.split("\n") if "FileScan parquet" in l][0]
    # only the lineitem columns the schedule view needs are read
    assert "l_discount" not in scan and "l_tax" not in scan


def test_history_facts_partial_aggregation(spark, sf_dir):
    from kredex.operators import facts
    from kredex.plans.catalog import Ctx
    c = Ctx(spark, sf_dir)
    txt = facts.history_facts(c["historia"])._jdf.queryExecution().executedPlan().toString()
    # map-side combine before each shuffle (a hot loan is reduced per task)
    assert "partial_max_by" in txt and "partial_sum" in txt


def test_one_scan_per_child_table(spark):
    """On real source folders each child table is read by exactly one scan of
    the extract plan (all its lookups are fused). The balance table is read
    twice (loans and collateral balances) and the universe twice (spine and
    whole-universe client totals), as in the report. The hot-key lists of the
    salted joins add a key-only scan of their large side."""
    import datetime as dt
    import tempfile
    from collections import Counter
    from decimal import Decimal

    from kredex.params import RunParams
    from kredex.plans.extract import build_extract
    from kredex.sources.tables import TableSource
    from test_micro_fixture import write_fixture

    root = tempfile.mkdtemp(prefix="kredex-scan-") + "/src"
    write_fixture(spark, root)
    src = TableSource(spark, root, cutoff=dt.date(2018, 10, 31))
    p = RunParams(cutoff=dt.datetime(2018, 10, 31), tc=Decimal("32.1234"), version="1-0-0")
    # leaf scans of the physical plan; key-only scans (the hot-key counts of
    # the salted joins read nothing but the join key) are counted apart
    leaves = build_extract(src, p)._jdf.queryExecution().sparkPlan().collectLeaves().iterator()
    scans, key_scans = Counter(), Counter()
    while leaves.hasNext():
        leaf = leaves.next()
        text = leaf.toString()
        m = re.search(r"\[file:[^\]]*/src/(\w+)\]", text)
        if m and leaf.nodeName().startswith("Scan parquet"):
            fields = re.findall(r"(\w+)#\d+", leaf.output().toString())
            if set(fields) <= {"c1704", "codigo_cliente", "nrogarantia", "tz_lock", "fecha"}:
                key_scans[m.group(1)] += 1
            else:
                scans[m.group(1)] += 1
    # one per join side before exchange reuse (see test_skew)
    assert key_scans == Counter({"saldos": 2, "universe": 2, "relacion_garantia": 2}), key_scans
    for child in ("plan_pagos", "plan_pagos_original", "historia", "gastos", "devengamiento",
                  "relacion_garantia", "garantias", "garantia_texto", "miembros",
                  "relacion_grupo", "persona_documento", "solicitudes", "clientes", "monedas"):
        assert scans[child] == 1, (child, scans)
    # one wide universe scan; key columns for the lookups and the coordinators,
    # and the columns of the client totals
    assert scans["saldos"] == 2 and scans["universe"] == 4, scans


def test_quarantine_split_does_not_shuffle_the_result(spark):
    """Good and rejected rows are split by a filter; the written list of
    duplicated keys is small in bytes, so Spark broadcasts it."""
    from kredex.operators.quality import enforce
    df = spark.range(1000).selectExpr("cast(id as decimal(15,0)) as Cod_Credito",
                                      "case when id % 7 = 0 then null else 'x' end as Sector")
    good, rejected = enforce(df, "quarantine")
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert good.count() == 1000 - 143 and rejected.count() == 143


def test_facts_are_hash_aggregates(spark, sf_dir):
    """Flat ordering keys: no sort of the largest tables before the combine."""
    from kredex.operators import facts
    from kredex.plans.catalog import Ctx
    c = Ctx(spark, sf_dir)
    for df in (facts.history_facts(c["historia"]), facts.schedule_facts(c["plan_pagos"], c.p.cutoff_col),
               facts.original_schedule_facts(c["plan_pagos_original"])):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in text and "HashAggregate" in text


def test_one_exchange_per_child_table(spark, sf_dir):
    """Every latest-row rule is a flat aggregate per loan, combined before its
    one exchange; the history's interest payments alone have a date level, and
    only they keep more than a row per loan in it."""
    from kredex.operators import facts
    from kredex.plans.catalog import Ctx
    c = Ctx(spark, sf_dir)
    for df, exchanges in ((facts.schedule_facts(c["plan_pagos"], c.p.cutoff_col), 1),
                          (facts.original_schedule_facts(c["plan_pagos_original"]), 1),
                          (facts.first_instalment_fees(c["gastos"]), 1), (facts.history_facts(c["historia"]), 2)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", text)) == exchanges, text
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_wide_universe_is_shuffled_once(spark, sf_dir):
    """Lookups run on the universe's key columns; its wide rows have one exchange."""
    df = E.queries()["portfolio_extract"](spark, sf_dir)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.debug.maxToStringFields": "5000"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    wide = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line
            and "AS analista" in "".join(lines[i + 1:i + 4])]
    assert len(wide) == 1, [lines[i][:200] for i in wide]


def test_wide_universe_rows_are_joined_last(spark, sf_dir):
    """The facts meet the narrow balance rows: no join of a loan fact carries the
    universe's wide columns. Stages with a method that the JVM would not compile
    run on projections."""
    df = E.queries()["portfolio_extract"](spark, sf_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [line for line in plan if re.search(r"Join (LeftOuter|Inner), \(jts_oid#\d+L? = (jts|saldos?)_", line)]
    depth = {re.search(r"Join (\w+)", line)[1]: line.index("Join") for line in reversed(joins)}
    assert depth["Inner"] < depth["LeftOuter"], joins
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
