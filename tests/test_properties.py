"""Equivalence properties on random data: the fused aggregates equal a
brute-force evaluation of the report's literal lookups, row by row.

The brute force reads the rows of one loan in plain Python, exactly as each
correlated lookup is written (filter, then MIN/MAX/SUM or TOP 1 ... ORDER BY
with SQL Server's NULL order); the Spark side is the single fused
``groupBy`` of ``kredex.operators.facts``.
"""

import datetime as dt
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kredex.operators import facts
from kredex.params import ntz_literal
from kredex.sources.tables import INPUT_SCHEMAS

CUT = dt.datetime(2018, 10, 31)
days = st.integers(min_value=-40, max_value=40).map(lambda d: CUT + dt.timedelta(days=d))
money = st.sampled_from([D("0.00"), D("0.00"), D("5.00"), D("12.50"), D("100.00")])

schedule_rows = st.lists(st.tuples(
    st.integers(1, 3),                 # loan
    st.one_of(st.none(), days),        # due date (NULL allowed)
    money, money, money, money,        # c2304, c2305, c2309, c2310
    st.sampled_from([0, 0, 0, 1])),    # tz_lock
    min_size=1, max_size=25)

history_rows = st.lists(st.tuples(
    st.integers(1, 3),
    st.sampled_from(["P", "P", "A", "I", "S", "X"]),
    st.one_of(st.none(), st.integers(-5, 5).map(lambda d: CUT + dt.timedelta(days=d))),
    money, money,                                # interespagado, capitalpagado
    st.sampled_from([D("0"), D("3"), D("7")]),   # tasainteres
    st.sampled_from([D("0"), D("5"), D("9")]),   # tasamora
    st.sampled_from([0, 0, 0, 1])),
    min_size=1, max_size=25)

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def _asc_nulls_first(v):
    return (v is not None, v)


def brute_schedule(rows, loan):
    r = [x for x in rows if x[0] == loan and x[6] == 0]
    if not r:
        return None
    due = [x[1] for x in r if x[1] is not None]

    def s(pred, i):
        v = [x[i] for x in r if pred(x)]
        return sum(v) if v else None

    def mn(pred):
        v = [x[1] for x in r if x[1] is not None and pred(x)]
        return min(v) if v else None

    pending = [x for x in r if (x[4] + x[5]) > 0]
    first = min(pending, key=lambda x: (_asc_nulls_first(x[1]), x[2] + x[3]), default=None)
    last = max(pending, key=lambda x: (_asc_nulls_first(x[1]), x[2] + x[3]), default=None)
    return dict(
        max_due=max(due) if due else None,
        principal_current=s(lambda x: x[4] > 0 and x[1] is not None and x[1] >= CUT, 4),
        principal_overdue=s(lambda x: x[4] > 0 and x[1] is not None and x[1] < CUT, 4),
        next_principal_due=mn(lambda x: x[4] > 0),
        next_interest_due=mn(lambda x: x[5] > 0),
        oldest_overdue_principal=mn(lambda x: x[4] > 0 and x[1] < CUT),
        oldest_overdue_interest=mn(lambda x: x[5] > 0 and x[1] < CUT),
        first_pending_amount=None if first is None else first[2] + first[3],
        last_pending_amount=None if last is None else last[2] + last[3],
    )


@SETTINGS
@given(rows=schedule_rows)
def test_schedule_facts_equal_literal_lookups(spark, rows):
    data = [(loan, 1, d, a, b, c, e, lock) for loan, d, a, b, c, e, lock in rows]
    df = spark.createDataFrame(data, INPUT_SCHEMAS["plan_pagos"])
    got = {r["jts_oid"]: r.asDict() for r in facts.schedule_facts(df, ntz_literal(CUT)).collect()}
    for loan in {x[0] for x in rows}:
        want = brute_schedule(rows, loan)
        if want is None:
            assert loan not in got
            continue
        g = got[loan]
        for k, v in want.items():
            assert g[k] == v, (loan, k, g[k], v)


def brute_history(rows, loan):
    # (loan, kind, date, int_paid, cap_paid, rate, late, lock, movement id)
    r = [x for x in rows if x[0] == loan and x[7] == 0]
    if not r:
        return None

    def latest(cands, value):
        # TOP 1 ... ORDER BY date DESC (NULLs last), movement DESC
        if not cands:
            return None
        best = max(cands, key=lambda x: (_asc_nulls_first(x[2]), x[8]))
        return value(best)

    paid_p = [x[2] for x in r if x[1] == "P" and x[4] > 0 and x[2] is not None]
    paid_i_rows = [x for x in r if x[1] == "P" and x[3] > 0]
    paid_i = [x[2] for x in paid_i_rows if x[2] is not None]
    # SUM per value date, the latest date's sum (a NULL date group ranks last)
    groups = {}
    for x in paid_i_rows:
        groups.setdefault(x[2], D(0))
        groups[x[2]] += x[3]
    last_sum = (groups[max(groups, key=_asc_nulls_first)] if groups else None)
    disb = [x for x in r if x[1] in ("A", "I")]
    rate_c = disb + [x for x in r if x[1] == "S" and x[5] > 0]
    spread_c = disb + [x for x in r if x[1] == "S" and (x[6] - x[5]) > 0]
    return dict(
        last_principal_payment=max(paid_p) if paid_p else None,
        last_interest_payment=max(paid_i) if paid_i else None,
        interest_paid_last_date=last_sum,
        disbursement_rows=len(disb),
        current_rate=latest(rate_c, lambda x: x[5]),
        current_spread=latest(spread_c, lambda x: x[6] - x[5]),
    )


@SETTINGS
@given(rows=history_rows)
def test_history_facts_equal_literal_lookups(spark, rows):
    full = [(loan, kind, d, ip, cp, rate, late, lock, i)
            for i, (loan, kind, d, ip, cp, rate, late, lock) in enumerate(rows)]
    data = [(loan, kind, d, ip, cp, rate, late, mov, lock)
            for loan, kind, d, ip, cp, rate, late, lock, mov in full]
    df = spark.createDataFrame(data, INPUT_SCHEMAS["historia"])
    got = {r["jts_oid"]: r.asDict() for r in facts.history_facts(df).collect()}
    for loan in {x[0] for x in full}:
        want = brute_history(full, loan)
        if want is None:
            assert loan not in got
            continue
        g = got.get(loan, {})          # no movement of a kind the rules read: no row
        for k, v in want.items():
            gv = g.get(k)
            if k == "disbursement_rows":
                gv = int(gv or 0)
            assert gv == v, (loan, k, gv, v)


def test_extract_invariants(spark, sf_dir):
    """One row per loan, two where its coordinator has two main documents;
    current + overdue principal = all positive
    outstanding principal x fx; days past due is 0 exactly when nothing is
    overdue; the export has one line per result row."""
    import __spark_entry__ as E
    from kredex.functions import exprs as X
    from kredex.plans.catalog import Ctx
    from kredex.plans.extract import build_extract
    from kredex.plans.extract_queries import EXTRACT_VIEWS
    from kredex.plans.publish import export_projection

    c = Ctx(spark, sf_dir)
    ext = build_extract({n: c[n] for n in EXTRACT_VIEWS}, c.p)
    n = ext.count()
    twice = c["persona_documento"].where("idpersona % 29 = 0").select("idpersona").distinct()
    # in the views every third client is coordinated by the next person
    person = F.col("Cod_Cliente") + F.when(F.col("Cod_Cliente") % 3 == 0, 1).otherwise(0)
    fanned = (ext.join(twice, person == F.col("idpersona")).where("Num_Identificacion like 'XC%'")).count()
    assert fanned > 0 and ext.select("Cod_Credito").distinct().count() == n - fanned
    assert export_projection(ext).count() == n

    pp = facts.valid(c["plan_pagos"]).where(F.col("c2309") > 0).groupBy(
        F.col("saldo_jts_oid").alias("jts_oid")).agg(
        F.sum("c2309").alias("out"),
        F.count(F.when(F.col("c2302") < c.p.cutoff_col, 1)).alias("n_over"))
    sal = c["saldos"].select("jts_oid", F.col("moneda").alias("ccy"))
    chk = (ext.join(sal, F.col("Cod_Credito") == F.col("jts_oid"))
           .join(pp, "jts_oid", "left")
           .select((F.col("Principal_corriente") + F.col("Principal_vencido")).alias("parts"),
                   (F.coalesce("out", F.lit(0)) * X.fx_factor("ccy", c.p.tc_col))
                   .cast("decimal(38,2)").alias("total"),
                   "Dias_mora_principal", F.coalesce("n_over", F.lit(0)).alias("n_over")))
    assert chk.where(F.abs(F.col("parts") - F.col("total")) > D("0.01")).count() == 0
    assert chk.where((F.col("Dias_mora_principal") == 0) != (F.col("n_over") == 0)).count() == 0
    _ = E


original_rows = st.lists(st.tuples(
    st.integers(1, 3),                               # loan
    st.integers(1, 4),                               # instalment number
    st.sampled_from([D("0"), D("0"), D("50")]),      # capital
    st.sampled_from([D("0"), D("9")]),               # interest
    st.one_of(st.none(), days),                      # due date
    st.sampled_from([0, 0, 1])),                     # tz_lock
    min_size=1, max_size=20)


def brute_grace(rows, loan, disbursed):
    """TOP 1 DATEDIFF(disbursement, due) over later capital instalments joined
    to an interest-only first instalment, ORDER BY due ASC (NULL first)."""
    first_io = any(x[0] == loan and x[1] == 1 and x[2] == 0 and x[3] > 0 for x in rows)
    later = [x for x in rows if x[0] == loan and x[5] == 0 and x[2] > 0 and x[1] > 1]
    if not first_io or not later:
        return 0
    best = min(later, key=lambda x: _asc_nulls_first(x[4]))
    return 0 if best[4] is None else (best[4].date() - disbursed.date()).days


@SETTINGS
@given(rows=original_rows)
def test_grace_days_equal_literal_lookup(spark, rows):
    disbursed = CUT - dt.timedelta(days=90)
    df = spark.createDataFrame(rows, INPUT_SCHEMAS["plan_pagos_original"])
    o = facts.original_schedule_facts(df)
    got = {r["jts_oid"]: r["g"] for r in
           o.withColumn("fecha_desembolso", ntz_literal(disbursed))
           .select("jts_oid", facts.grace_days().alias("g")).collect()}
    for loan in {x[0] for x in rows}:
        assert got.get(loan, 0) == brute_grace(rows, loan, disbursed), loan
