"""A hot key: one loan holds a third of the schedule rows and one client a
third of the loans. Results stay whole and exact, and every aggregate
combines on the map side before its shuffle."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from kredex.operators import facts
from kredex.params import ntz_literal
from kredex.sources.tables import INPUT_SCHEMAS

CUT = dt.datetime(2018, 10, 31)


def _schedule(spark, n_rest=4000):
    hot = n_rest // 2
    rows = []
    for i in range(hot):      # loan 0: a third of all rows
        due = CUT + dt.timedelta(days=(i % 200) - 100)
        rows.append((0, i, due, D("10.00"), D("1.00"), D("10.00"), D("0.00"), 0))
    for i in range(n_rest):
        due = CUT + dt.timedelta(days=(i % 30) - 15)
        rows.append((1 + i, 1, due, D("5.00"), D("1.00"), D("5.00"), D("1.00"), 0))
    return spark.createDataFrame(rows, INPUT_SCHEMAS["plan_pagos"]).repartition(8), rows


def test_hot_loan_schedule_is_whole_and_exact(spark):
    df, rows = _schedule(spark)
    out = facts.schedule_facts(df, ntz_literal(CUT))
    hot = out.where("jts_oid = 0").collect()[0]
    overdue = [r for r in rows if r[0] == 0 and r[2] < CUT]
    current = [r for r in rows if r[0] == 0 and r[2] >= CUT]
    assert hot["principal_overdue"] == sum(r[5] for r in overdue)
    assert hot["principal_current"] == sum(r[5] for r in current)
    assert hot["oldest_overdue_principal"] == min(r[2] for r in overdue)
    assert out.count() == 1 + 4000


def test_aggregates_combine_before_shuffle(spark):
    df, _ = _schedule(spark, 200)
    plan = facts.schedule_facts(df, ntz_literal(CUT))._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the exchange on the loan key
    assert plan.index("Exchange hashpartitioning(saldo_jts_oid") < plan.rindex("partial_")


def test_hot_client_totals(spark):
    loans = [(i, 7 if i % 3 == 0 else 100 + i, 1, D("10.00"), D("10.00")) for i in range(3000)]
    u = spark.createDataFrame(loans, "jts_oid bigint, codigo_cliente bigint, codigo_moneda int, "
                                     "saldo_mo decimal(15,2), saldo_mn decimal(15,2)")
    cf = facts.client_facts(u, F.lit(D("32.1234")).cast("decimal(8,4)"))
    hot = cf.where("codigo_cliente = 7").collect()[0]
    assert hot["loans_per_client"] == 1000
    assert hot["client_debt"] == D("10000.00")


def test_split_hot_keys_equals_plain_join(spark):
    from kredex.operators.skew import split_hot_keys
    big = spark.createDataFrame(
        [(i, 7 if i % 3 == 0 else (None if i % 11 == 0 else i % 50)) for i in range(3000)],
        "id bigint, k bigint")
    per_key = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40)], "k bigint, v string")
    def rows(df):
        return sorted((tuple(r) for r in df.select("k", "id", "v").collect()), key=repr)

    for how in ("inner", "left"):
        split = split_hot_keys(big, per_key, ["k"], how, id_cols=["id"], rows_per_task=100)
        assert rows(split) == rows(big.join(per_key, ["k"], how))
        assert split.where("k = 7").count() == big.where("k = 7").count()
    # the hot key (1,037 rows) is spread over ceil(1037 / 100) = 11 salts
    from kredex.operators.skew import COUNT, hot_keys
    from pyspark.sql import functions as F
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias(COUNT))
    assert [tuple(r) for r in hot_keys(counts, ["k"], 100).collect()] == [(7, 11)]


def test_hot_key_list_is_computed_once(spark):
    """Both join sides read the same hot-key list; the broadcast exchange is
    reused at run time, so the key count runs once."""
    from kredex.operators.skew import split_hot_keys
    big = spark.range(5000).selectExpr("id", "case when id % 2 = 0 then 1 else id end as k")
    per_key = spark.range(5000).selectExpr("id as k", "concat('v', id) as v")
    out = split_hot_keys(big, per_key, ["k"], "inner", id_cols=["id"], rows_per_task=100)
    assert out.count() == 5000
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_salted_join_partitions_on_key_and_salt(spark):
    """Both sides of a salted join are hash-partitioned on (key, salt), even
    when the large side is already partitioned on the key alone."""
    import re
    from kredex.operators.skew import split_hot_keys
    big = spark.range(2000).selectExpr("id", "id % 5 as k").repartition("k")
    per_key = spark.range(5).selectExpr("id as k", "id * 10 as v")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = split_hot_keys(big, per_key, ["k"], "inner", id_cols=["id"], rows_per_task=100)
        plan = out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    smj = plan[plan.index("SortMergeJoin"):]
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+L?, _salt#\d+", smj)) >= 1
    assert out.count() == 2000


def test_coordinator_rows_stay_linear(spark):
    """One person with many memberships and many groups: a loan meets only the
    relations of its own client."""
    n = 400
    loans = spark.createDataFrame([(i, i) for i in range(n)], "jts_oid bigint, codigo_cliente bigint")
    members = spark.createDataFrame([(i, 7) for i in range(n)], "saldo_jts_oid bigint, cod_cliente_m bigint")
    rel = spark.createDataFrame([(i, 7, "S ", "AC", 0) for i in range(n)],
                                "c3198 bigint, c3199 bigint, c3201 string, c3210 string, tz_lock int")
    doc = spark.createDataFrame([(7, "D7", "A ", "S")], "idpersona bigint, nrodocumento string, estado string, principal string")
    out = facts.coordinator(loans, members, rel, doc)
    assert out.count() == n
    assert {r.coord_document for r in out.collect()} == {"D7"}


def test_many_hot_keys_and_many_salts(spark):
    """No cap on hot keys or salts: every hot key is split as far as its rows ask."""
    from kredex.operators.skew import COUNT, hot_keys, split_hot_keys
    big = spark.range(20000).selectExpr("id", "id % 1000 as k")
    per_key = spark.range(1000).selectExpr("id as k", "concat('v', id) as v")
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias(COUNT))
    assert hot_keys(counts, ["k"], 1).where("_salts = 20").count() == 1000
    out = split_hot_keys(big, per_key, ["k"], "inner", id_cols=["id"], rows_per_task=1)
    assert out.count() == 20000 and out.where("v <> concat('v', k)").count() == 0


def test_reasons_cost_no_array_of_all_checks(spark):
    """The failed checks come sorted, from one text: no lambda runs and nothing
    is sorted per row."""
    from kredex.operators import quality
    df = spark.createDataFrame([(1, "ab", None), (None, "abcd", None), (2, "x", 3)], "b int, a string, c int")
    out = df.withColumn("reasons", quality.row_reasons(quality.row_checks(df, {"a": 3})))
    assert [r.reasons for r in out.collect()] == [["null c"], ["length a", "null b", "null c"], []]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array_sort" not in plan and out.schema["reasons"].dataType.simpleString() == "array<string>"
