"""The result as a catalog table: declared limits, default, partitions."""

import pytest
from pyspark.sql import functions as F

from kredex.plans import sink
from kredex.schemas import GENERATED, RESULT_COLUMNS
from test_publish import CUT, RUN, result


@pytest.fixture
def table(spark, tmp_path):
    name = sink.create(spark, f"{tmp_path}/result")
    yield name
    spark.sql(f"DROP TABLE {name}")


def good(spark, keys, **kw):
    return result(spark, keys, bad=lambda k: False, **kw)


def test_declared_columns(spark, table):
    got = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE {table}").collect()}
    for name, kind, limit in RESULT_COLUMNS:
        assert got[name] == (f"varchar({limit})" if limit else kind), name
    shown = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    assert "DEFAULT current_timestamp()" in shown and "PARTITIONED BY (Interno_FechaCorte, Interno_ControlVersion)" in shown


def test_default_fills_the_column_left_out(spark, table):
    sink.insert(good(spark, range(5)).drop(GENERATED), table)
    rows = spark.table(table).collect()
    assert len(rows) == 5 and len({r[GENERATED] for r in rows}) == 1 and rows[0][GENERATED] is not None
    assert {(r.Interno_FechaCorte, r.Interno_ControlVersion) for r in rows} == {(CUT, RUN.version)}


def test_positions_follow_the_list(spark, table):
    rows = good(spark, [7])
    sink.insert(rows.select(*reversed(rows.columns)), table)      # order of the rows' columns does not matter
    back = spark.table(table).select(*[c for c in rows.columns if c != GENERATED]).collect()
    assert back == rows.drop(GENERATED).collect()


@pytest.mark.parametrize("column,value,error", [
    ("Sector", "repeat('s', 51)", "EXCEED_LIMIT_LENGTH"),
    ("Saldo_principal", "cast(12345678901234 as decimal(38,2))", "NUMERIC_VALUE_OUT_OF_RANGE|CAST_OVERFLOW"),
    ("Plazo", "'soon'", "INCOMPATIBLE_DATA_FOR_TABLE|CANNOT_SAFELY_CAST")])
def test_rows_out_of_limits_fail_the_statement(spark, table, column, value, error):
    sink.insert(good(spark, [1]), table)
    with pytest.raises(Exception, match=error):
        sink.insert(good(spark, [2, 3]).withColumn(column, F.expr(value)), table)
    assert spark.table(table).count() == 1
    sink.insert(good(spark, [2]).withColumn("Sector", F.repeat(F.lit("s"), F.lit(50))), table)
    assert spark.table(table).count() == 2


def test_limits_follow_the_schema():
    types = sink.column_types()
    assert types["Sector"] == "VARCHAR(50)" and types["Descripcion_garantia"] == "STRING"
    assert types["Deuda_total"] == "DECIMAL(38,2)" and types["Interno_FechaCorte"] == "TIMESTAMP_NTZ"
