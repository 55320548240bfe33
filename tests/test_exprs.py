"""Trap tests of the scalar rules (T-SQL behaviour the helpers reproduce)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kredex.functions import exprs as X
from kredex.params import RunParams, ParameterError, round_to_minute, single_value


def one(spark, col, data, schema):
    return spark.createDataFrame(data, schema).select(col.alias("r")).collect()


def test_codes_compare_by_their_collation(spark):
    codes = [(" ",), ("",), ("F",), ("F ",), ("f ",), (None,)]
    for collation, lower in (("UTF8_BINARY_RTRIM", False), ("UTF8_LCASE_RTRIM", True)):
        typed = f"c string collate {collation}"
        assert [r.r for r in one(spark, X.is_code("c", ""), codes, typed)] == [True, True, False, False, False, None]
        assert [r.r for r in one(spark, X.is_code("c", "F", "H"), codes, typed)] == [False, False, True, True, lower, None]
        rows = one(spark, X.modality_text("c"), [(" ",), ("F ",), ("H",), ("C",), ("Z",), ("h",), (None,)], typed)
        assert [r.r for r in rows] == ["Al Vencimiento", "Cuota Fija", "Decreciente", "Irregular", "",
                                       "Decreciente" if lower else "", ""]


def test_rate_type_contains_by_collation(spark):
    from kredex.plans.columns import rate_type
    data = [("PRESTAMO COLABORADORES 1",), ("Prestamo Colaboradores",), ("COLABORADOR",), (None,)]
    for collation, second in (("UTF8_BINARY_RTRIM", "Fija"), ("UTF8_LCASE_RTRIM", "Variable")):
        rows = one(spark, rate_type(), data, f"producto string collate {collation}")
        assert [r.r for r in rows] == ["Variable", second, "Fija", "Fija"]


def test_unknown_collation(spark):
    from kredex.sources.collation import CollatedTables
    with pytest.raises(ValueError, match="unknown collation"):
        CollatedTables({}, "UNICODE_CI")


def test_day_diff_counts_midnights(spark):
    data = [(dt.datetime(2018, 10, 30, 23, 59, 59), dt.datetime(2018, 10, 31, 0, 0, 0)),
            (dt.datetime(2018, 10, 31, 0, 0), dt.datetime(2018, 10, 31, 23, 0))]
    rows = one(spark, X.day_diff("a", "b"), data, "a timestamp_ntz, b timestamp_ntz")
    assert [r.r for r in rows] == [1, 0]


def test_sentinel_date_blanked_and_null_kept(spark):
    data = [(dt.datetime(1900, 1, 1, 13, 5),), (dt.datetime(2018, 1, 2),), (None,)]
    rows = one(spark, X.sentinel_blank("d"), data, "d timestamp_ntz")
    assert [r.r for r in rows] == ["", "02/01/2018", None]


def test_grade_else_is_zero_not_blank(spark):
    rows = one(spark, X.grade_to_class("g"), [("A",), ("E",), ("Z",), (None,)], "g string")
    assert [r.r for r in rows] == [1, 5, 0, 0]


def test_two_step_rate_rounding(spark):
    rows = one(spark, X.rate_to_sink("r"), [(Decimal("0.00495"),)], "r decimal(15,5)")
    assert rows[0].r == Decimal("0.01")
    rows = one(spark, F.col("r").cast("decimal(15,2)"), [(Decimal("0.00495"),)], "r decimal(15,5)")
    assert rows[0].r == Decimal("0.00")


def test_effective_annual_rate(spark):
    rows = one(spark, X.effective_annual_rate("r"), [(Decimal("12"),), (None,)], "r decimal(15,4)")
    assert rows[0].r == Decimal("12.6825")
    assert rows[1].r is None


def test_quote_id_null_gives_empty_quotes(spark):
    rows = one(spark, X.quote_id("x"), [(123,), (None,)], "x bigint")
    assert [r.r for r in rows] == ['"123"', '""']


def test_len_ignores_trailing_blanks(spark):
    rows = one(spark, X.nonblank_or_empty("x"), [("  ",), (None,), ("ab ",)], "x string")
    assert [r.r for r in rows] == ["", "", "ab "]


def test_fx_factor_null_currency_takes_rate(spark):
    rows = one(spark, X.fx_factor("m", F.lit(Decimal("32.1234")).cast("decimal(8,4)")),
               [(1,), (2,), (None,)], "m int")
    assert [r.r for r in rows] == [Decimal("1.0000"), Decimal("32.1234"), Decimal("32.1234")]


def test_single_value_raises_only_when_used(spark):
    df = spark.createDataFrame([(1, 5, 2), (2, 7, 1)], "k int, v int, n int")
    ok = df.where("k = 2").select(X.single_value(F.col("v"), F.col("n"), "x").alias("r")).collect()
    assert ok[0].r == 7
    with pytest.raises(Exception, match="more than 1 value"):
        df.select(X.single_value(F.col("v"), F.col("n"), "x").alias("r")).collect()


def test_parameter_reads(spark):
    one_row = spark.createDataFrame([(dt.datetime(2018, 10, 31, 10, 0, 29, 999000),)], "fechaproceso timestamp_ntz")
    maestro = spark.createDataFrame([("1-0-0", 1), ("0-9-0", 0)], "id_maestrounico string, estado int")
    p = RunParams.resolve(one_row, maestro, tc="32.1234")
    assert p.cutoff == dt.datetime(2018, 10, 31, 10, 1)
    assert p.version == "1-0-0" and p.tc == Decimal("32.1234")
    two = spark.createDataFrame([(1,), (2,)], "fechaproceso int")
    with pytest.raises(ParameterError):
        single_value(two, "fechaproceso")
    assert round_to_minute(dt.datetime(2018, 1, 1, 0, 0, 29)) == dt.datetime(2018, 1, 1, 0, 0)


def test_padded_codes(spark):
    from pyspark.sql import functions as F

    from kredex.functions import exprs as X
    from kredex.plans.columns import person_type_col
    rows = spark.createDataFrame([("A ", "J ", "INDIVIDUAL"), ("E", "J", "INDIVIDUAL "), ("", "N", "INDIVIDUAL")],
                                 "g string collate UTF8_BINARY_RTRIM, tipo_persona string collate UTF8_BINARY_RTRIM, "
                                 "tipo_prestamo string collate UTF8_BINARY_RTRIM") \
        .withColumn("coord_document", F.lit(None).cast("string")).withColumn("coord_client", F.lit(None).cast("bigint"))
    got = [tuple(r) for r in rows.select(X.grade_to_class("g"), person_type_col()).collect()]
    assert got == [(1, "Juridica"), (5, "Juridica"), (0, "Natural")]
