"""Coded columns compare by one run parameter."""

import datetime as dt
import re
import tempfile

import pytest

from kredex.operators import facts
from kredex.params import RunParams
from kredex.plans.extract import build_extract
from kredex.sources.collation import CASE_INSENSITIVE, CASE_SENSITIVE, CODED, CollatedTables, collated
from kredex.sources.tables import INPUT_SCHEMAS, TableSource
from test_micro_fixture import CUT, fixture_tables, write_fixture


@pytest.fixture(scope="module")
def root(spark):
    root = tempfile.mkdtemp(prefix="kredex-collation-") + "/src"
    write_fixture(spark, root)
    return root


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_coded_column_is_a_source_column():
    for table, columns in CODED.items():
        for c in columns:
            assert re.search(rf"\b{c} string", INPUT_SCHEMAS[table]), (table, c)


@pytest.mark.parametrize("collation,wanted", [(CASE_INSENSITIVE, {"P", "p", "A", "a", "I", "i", "S", "s"}),
                                              (CASE_SENSITIVE, {"P", "A", "I", "S"})])
def test_kind_filter_reaches_the_scan(spark, root, collation, wanted):
    src = TableSource(spark, root, cutoff=dt.date(2018, 10, 31), collation=collation)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scans = [line for line in plan_of(facts.history_facts(src["historia"])).split("\n") if "PushedFilters" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(scans) == 1
    assert set(re.findall(r"StringStartsWith\(tipomov,(\w)\)", scans[0])) == wanted
    assert "EqualTo(tz_lock,0)" in scans[0]


def test_rules_hold_no_trimming(spark, root):
    """The comparison rule is the columns' own: nothing is trimmed or folded."""
    src = TableSource(spark, root, cutoff=dt.date(2018, 10, 31), collation=CASE_INSENSITIVE)
    p = RunParams(cutoff=CUT, tc=None, version="1")
    old = spark.conf.get("spark.sql.maxPlanStringLength", None)
    spark.conf.set("spark.sql.maxPlanStringLength", "100000000")
    text = build_extract(src, p)._jdf.queryExecution().optimizedPlan().toString()
    if old:
        spark.conf.set("spark.sql.maxPlanStringLength", old)
    assert "rtrim(" not in text and "lower(" not in text and "collate(" in text


def other_case(rows, column):
    return [{**r, column: None if r[column] is None else r[column].swapcase() + "  "} for r in rows]


def test_case_and_padding_of_the_whole_report(spark):
    """Every code in the other case and padded: the same report where case
    does not count, another one where it does."""
    tables = fixture_tables()
    changed = dict(tables)
    for name, columns in CODED.items():
        for c in columns:
            changed[name] = other_case(changed[name], c)

    def report(rows, collation):
        base = {n: spark.createDataFrame([tuple(r.get(c.split()[0]) for c in INPUT_SCHEMAS[n].split(", ")) for r in t],
                                         INPUT_SCHEMAS[n]) for n, t in rows.items()}
        base |= {n: base[n].where("fecha = date '2018-10-31'").drop("fecha") for n in ("universe", "miembros")}
        base["saldos_garantia"] = base["saldos"]
        p = RunParams(cutoff=CUT, tc="32.1234", version="1", collation=collation)
        keys = ("Cod_Credito", "Tipo_persona", "Num_Identificacion", "Modalidad", "Saldo_interes", "Tasa_vigente",
                "Clasificacion", "Clasificacion_Cliente", "Tipo_tasa", "Monto_Ult_Pago_Int")
        out = build_extract(CollatedTables(base, collation), p).select(*keys)
        return sorted(map(tuple, out.collect()), key=str)

    same = report(tables, CASE_INSENSITIVE)
    assert report(changed, CASE_INSENSITIVE) == same
    assert report(tables, CASE_SENSITIVE) == same
    cased = report(changed, CASE_SENSITIVE)
    assert len(cased) == len(same) and cased != same
    assert {r[3] for r in cased} <= {"", "Al Vencimiento"} and {r[6] for r in cased} == {0}


def test_collated_tables_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "P ", 0)], "saldos_jts_oid int, tipomov string, tz_lock int")
    out = collated("historia", df, CASE_SENSITIVE)
    assert out.columns == df.columns and out.schema["tipomov"].dataType.simpleString() == f"string collate {CASE_SENSITIVE}"
    assert collated("gastos", df, CASE_SENSITIVE) is df
