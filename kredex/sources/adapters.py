"""Loan-shaped views over the shared test tables.

The engine works on the portfolio domain (balances, schedules, movement
history, collateral, ...). The shared test data is a TPC-H-like star schema,
so every domain table is defined here as a projection of it. Each view is a
list of ``(column, expression)`` pairs over one source relation; the same
expression text is used by the Spark adapter (``selectExpr``) and by the
DuckDB oracle (a CTE), so both engines see identical inputs. Where the two
SQL dialects differ, a Spark-only expression overrides the shared one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test adapter: the cutoff date and the cutoff FX rate.
CUTOFF = "1998-06-30"
CUTOFF_TC = "32.1234"
CONTROL_VERSION = "1-0-0"

DEC2 = "decimal(15,2)"
DEC4 = "decimal(15,4)"


@dataclass(frozen=True)
class View:
    name: str
    source: str                      # FROM clause over shared table names
    columns: list[tuple[str, str]]   # (column, shared SQL expression)
    spark_override: dict[str, str] = field(default_factory=dict)
    where: str | None = None
    group_by: str | None = None


def _v(name, source, cols, **kw) -> View:
    return View(name, source, cols, **kw)


VIEWS: dict[str, View] = {}


def _add(view: View) -> None:
    VIEWS[view.name] = view


_add(_v("saldos", "orders", [
    ("jts_oid", "o_orderkey"),
    ("moneda", "cast(1 + o_orderkey % 3 as int)"),
    ("c1620", "o_orderdate"),
    ("c1677", "case when o_orderkey % 16 = 5 then 'f' when o_orderkey % 16 = 9 then 'h  ' when o_orderkey % 16 = 14 then 'c' when o_orderkey % 8 = 7 then 'C ' when o_orderkey % 8 = 6 then 'Z' when o_orderstatus = 'O' then 'F ' when o_orderstatus = 'P' then 'H' else '' end"),
    ("c1632", f"cast(12 + o_orderkey % 24 as {DEC4})"),
    ("c1633", f"cast(15 + o_orderkey % 24 as {DEC4})"),
    ("c1704", "o_orderkey"),
    ("c1803", "o_custkey"),
    ("tz_lock", "case when o_orderkey % 50 = 49 then 1 else 0 end"),
]))

# The universe snapshot. Columns past the documented core are descriptive
# fields the extract passes through; they get simple deterministic values.
_add(_v("universe", "orders join customer on o_custkey = c_custkey", [
    ("jts_oid", "o_orderkey"),
    ("nro_prestamo", "o_orderkey"),
    ("codigo_cliente", "o_custkey"),
    ("nombre_cliente", "c_name"),
    ("tipo_prestamo", "case when o_orderpriority = '5-LOW' and o_orderkey % 5 = 2 then 'Grupo Solidario  ' when o_orderpriority = '5-LOW' then 'GRUPO SOLIDARIO' else 'INDIVIDUAL' end"),
    ("tipo_persona", "case when c_mktsegment = 'MACHINERY' and c_custkey % 3 = 1 then 'j ' when c_mktsegment = 'MACHINERY' then 'J' else 'N' end"),
    ("numero_ruc", "concat('J', cast(c_custkey as varchar(20)))"),
    ("numero_documento", "concat('D', cast(c_custkey as varchar(20)))"),
    ("codigo_moneda", "cast(1 + o_orderkey % 3 as int)"),
    ("saldo_mo", f"cast(o_totalprice as {DEC2})"),
    ("saldo_mn", f"cast(cast(o_totalprice as {DEC2}) * 2 as {DEC2})"),
    ("situacion_prestamo", "case when o_orderstatus = 'F' and o_orderkey % 6 = 1 then 'SANEADO' when o_orderstatus = 'F' then 'Saneado' when o_orderstatus = 'P' and o_orderkey % 6 = 2 then 'cobro judicial ' when o_orderstatus = 'P' then 'Cobro Judicial' else 'Vigente' end"),
    ("codigo_estado", "case when o_orderstatus = 'F' and o_orderkey % 4 = 3 then 'c' when o_orderstatus = 'F' then 'C ' when o_orderstatus = 'P' and o_orderkey % 4 = 1 then 'e ' when o_orderstatus = 'P' then 'E' else 'A' end"),
    ("producto", "case when c_mktsegment = 'HOUSEHOLD' and c_custkey % 2 = 1 then 'PRESTAMO COLABORADORES 2' when c_mktsegment = 'HOUSEHOLD' then 'Prestamo Colaboradores 1' else c_mktsegment end"),
    ("tasa_interes", f"cast(12 + o_orderkey % 24 as {DEC4})"),
    ("intereses_saneados_mn", f"cast(o_orderkey % 1000 as {DEC2})"),
    ("devengado_int_cte_mn", f"cast(o_orderkey % 700 as {DEC2})"),
    ("cantidad_cuotas", "7"),
    ("cuotas_pagadas", "cast(o_orderkey % 7 as int)"),
    ("cantidad_cuotas_vencidas", "cast(o_orderkey % 5 as int)"),
    ("fecha_desembolso", "o_orderdate"),
    ("fecha_empeso_mora_capital", "case when o_orderstatus = 'O' then timestamp '1900-01-01 00:00:00' else o_orderdate end"),
    ("clasificacion_prestamo", "concat(substring(case when o_orderkey % 7 = 3 then 'abcdez' else 'ABCDEZ' end, cast(1 + o_orderkey % 6 as int), 1), case when o_orderkey % 4 = 0 then '  ' else '' end)"),
    ("calificacion_utilizada", "concat(substring(case when o_orderkey % 7 = 4 then 'abcdez' else 'ABCDEZ' end, cast(1 + o_orderkey % 5 as int), 1), case when o_orderkey % 3 = 0 then ' ' else '' end)"),
    # descriptive pass-through fields
    ("descripcion_tipo_credito", "case when o_orderpriority = '1-URGENT' then 'COMERCIAL' else 'CONSUMO' end"),
    ("producto_agrupador", "c_mktsegment"),
    ("sector", "case when o_orderkey % 211 = 5 then 'ZONA DE RESERVA NATURAL CON NOMBRE MAS LARGO QUE CINCUENTA LETRAS' when c_nationkey % 2 = 0 then 'URBANO' else 'RURAL' end"),
    ("frecuencia_pago", "case when o_orderkey % 4 = 0 then 'TRIMESTRAL' else 'MENSUAL' end"),
    ("tipo_garantia", "case when o_orderkey % 5 = 0 then ' ' when o_orderkey % 5 = 1 then 'PRENDARIA' else 'FIDUCIARIA' end"),
    ("desc_sucursal_prestamo", "concat('SUCURSAL ', cast(c_nationkey as varchar(20)))"),
    ("analista", "concat('ANALISTA ', cast(o_custkey % 17 as varchar(20)))"),
    ("rubro_contable", "cast(1300 + o_orderkey % 9 as decimal(15,0))"),
    ("importe_desembolso_mo", f"cast(cast(o_totalprice as {DEC2}) * cast(1.5 as decimal(2,1)) as {DEC2})"),
    ("mto_ult_pago_capital", f"cast(o_orderkey % 250 as {DEC2})"),
    ("interes_moratorio_mn", f"cast(o_orderkey % 40 as {DEC2})"),
    ("provision_mn", f"cast(cast(o_totalprice as {DEC2}) * cast(0.01 as decimal(3,2)) as {DEC2})"),
    ("fecha_vencimiento", "case when o_orderkey % 11 = 0 then null else o_orderdate + interval 720 day end"),
    ("fecha_1erpago_pactado", "o_orderdate + interval 30 day"),
    ("fecha_empeso_mora_interes", "case when o_orderkey % 3 = 0 then timestamp '1900-01-01 00:00:00' when o_orderkey % 3 = 1 then null else o_orderdate end"),
    ("cantidad_cuotas_pactadas", "cast(7 as int)"),
], spark_override={
    "fecha_empeso_mora_capital": "case when o_orderstatus = 'O' then timestamp_ntz '1900-01-01 00:00:00' else o_orderdate end",
    "fecha_empeso_mora_interes": "case when o_orderkey % 3 = 0 then timestamp_ntz '1900-01-01 00:00:00' when o_orderkey % 3 = 1 then null else o_orderdate end",
}))

_add(_v("plan_pagos", "lineitem", [
    ("saldo_jts_oid", "l_orderkey"),
    ("numero_cuota", "l_linenumber"),
    ("c2302", "case when l_partkey % 23 = 0 then null else l_shipdate end"),
    ("c2304", f"cast(l_extendedprice as {DEC2})"),
    ("c2305", f"cast(l_quantity as {DEC2})"),
    ("c2309", f"case when l_linestatus = 'O' then cast(l_extendedprice as {DEC2}) else cast(0 as {DEC2}) end"),
    ("c2310", f"case when l_returnflag = 'R' then cast(l_quantity as {DEC2}) else cast(0 as {DEC2}) end"),
    ("tz_lock", "case when l_partkey % 40 = 39 then 1 else 0 end"),
]))

_add(_v("plan_pagos_original", "lineitem", [
    ("saldos_jts_oid", "l_orderkey"),
    ("numero_cuota", "l_linenumber"),
    ("capital", f"case when l_linenumber = 1 and l_linestatus = 'O' then cast(0 as {DEC2}) else cast(l_extendedprice as {DEC2}) end"),
    ("intereses", f"cast(l_quantity as {DEC2})"),
    ("fecha_vencimiento", "l_shipdate"),
    ("tz_lock", "case when l_partkey % 40 = 39 then 1 else 0 end"),
]))

_add(_v("gastos", "lineitem", [
    ("saldos_jts_oid", "l_orderkey"),
    ("numero_cuota", "l_linenumber"),
    ("importe_gastos", f"cast(l_quantity as {DEC2})"),
]))

# Movement history of most loans: one disbursement per order by construction,
# as the report reads its rate as a single value, and payments and rate changes
# from the order's lines. Kinds are blank-padded for some rows.
_add(_v("historia_orden", "orders", [
    ("saldos_jts_oid", "o_orderkey"),
    ("tipomov", "case o_orderkey % 6 when 0 then 'A' when 1 then 'A ' when 2 then 'I' when 3 then 'a' when 4 then 'i  ' else 'I ' end"),
    ("fechavalor", "o_orderdate"),
    ("capitalpagado", f"cast(0 as {DEC2})"),
    ("interespagado", f"cast(0 as {DEC2})"),
    ("tasainteres", f"cast(10 + o_orderkey % 21 as {DEC4})"),
    ("tasamora", f"cast(10 + o_orderkey % 21 + o_orderkey % 3 as {DEC4})"),
    ("movimiento", "o_orderkey"),
    ("tz_lock", "case when o_orderkey % 31 = 30 then 1 else 0 end"),
]))
_add(_v("historia_linea", "lineitem", [
    ("saldos_jts_oid", "l_orderkey"),
    ("tipomov", "case when l_returnflag = 'A' and l_suppkey % 3 = 0 then 's' when l_returnflag = 'A' then 'S' when l_returnflag = 'R' then 'P' when l_suppkey % 3 = 1 then 'p ' else 'P ' end"),
    ("fechavalor", "case when l_partkey % 19 = 0 then null else l_shipdate end"),
    ("capitalpagado", f"case when l_returnflag = 'R' then cast(l_extendedprice as {DEC2}) else cast(0 as {DEC2}) end"),
    ("interespagado", f"case when l_returnflag = 'N' or l_linenumber = 2 then cast(l_quantity as {DEC2}) else cast(0 as {DEC2}) end"),
    ("tasainteres", f"cast(l_partkey % 30 as {DEC4})"),
    ("tasamora", f"cast(l_partkey % 30 + l_partkey % 4 as {DEC4})"),
    ("movimiento", "1000000000 + l_partkey"),
    ("tz_lock", "case when l_partkey % 25 = 24 then 1 else 0 end"),
]))
# Movements of few loans with many disbursements each: for the latest-rate
# queries, which do not read the single disbursement.
_add(_v("historia_raw", "events", [
    ("saldos_jts_oid", "user_id"),
    ("tipomov", "case event_type when 'purchase' then 'P' when 'click' then 'P' when 'signup' then 'a ' when 'view' then 'S' else 'I' end"),
    ("fechavalor", "date_trunc('day', ts)"),
    ("capitalpagado", f"case when event_type = 'purchase' then cast(value as {DEC2}) else cast(0 as {DEC2}) end"),
    ("interespagado", f"case when event_type = 'click' then cast(value as {DEC2}) else cast(0 as {DEC2}) end"),
    ("tasainteres", f"cast(event_id % 30 as {DEC4})"),
    ("tasamora", f"cast(event_id % 30 + event_id % 4 as {DEC4})"),
    ("movimiento", "event_id"),
    ("tz_lock", "case when event_id % 25 = 24 then 1 else 0 end"),
], spark_override={"fechavalor": "cast(cast(ts as date) as timestamp_ntz)"}))

_add(_v("relacion_garantia", "lineitem", [
    ("nrosolicitud", "l_orderkey"),
    ("nrogarantia", "l_partkey"),
    ("tz_lock", "case when l_suppkey % 20 = 19 then 1 else 0 end"),
]))

_add(_v("garantias", "part join orders on p_partkey = o_orderkey", [
    ("nrogarantia", "p_partkey"),
    ("gar_moneda", "cast(1 + p_partkey % 4 as int)"),
    ("gar_fecha", "o_orderdate"),
    ("descripcion", "case when p_partkey % 7 = 0 then concat(p_name, ' | lote ', cast(p_partkey as varchar(20))) else p_name end"),
    ("tz_lock", "case when p_partkey % 45 = 44 then 1 else 0 end"),
]))

_add(_v("saldos_garantia", "part", [
    ("cuenta", "p_partkey"),
    ("c9314", "case when p_size > 40 then 5 else 1 end"),
    ("c1604", f"cast(-p_retailprice as {DEC2})"),
    ("tz_lock", "case when p_partkey % 35 = 34 then 1 else 0 end"),
]))

_add(_v("tipo_cambio", "orders", [
    ("fecha", "cast(o_orderdate as date)"),
    ("tipo_cambio", "cast(30 + (min(o_orderkey) % 500) * 0.01 as decimal(8,4))"),
], where="o_orderkey % 19 <> 7", group_by="o_orderdate"))

_add(_v("devengamiento", "orders", [
    ("saldo_jts_oid", "o_orderkey"),
    ("fecha", "case when o_orderkey % 3 = 0 then timestamp '1998-05-31 00:00:00' else timestamp '1998-06-30 00:00:00' end"),
    ("interes_deveng_vigente_cont", f"cast(o_orderkey % 900 as {DEC2})"),
    ("interes_deveng_vencido_cont", f"case when o_orderkey % 4 = 0 then null else cast(o_orderkey % 300 as {DEC2}) end"),
    ("mora_tasa_int_deveng_venc_cont", f"cast(o_orderkey % 20 as {DEC2})"),
    ("mora_tasa_int_deveng_vige_cont", f"cast(o_orderkey % 10 as {DEC2})"),
], spark_override={
    "fecha": "case when o_orderkey % 3 = 0 then timestamp_ntz '1998-05-31 00:00:00' else timestamp_ntz '1998-06-30 00:00:00' end",
}))

_add(_v("monedas", "region", [
    ("c6399", "r_regionkey"),
    ("c6400", "r_name"),
], where="r_regionkey between 1 and 3"))

_add(_v("solicitudes", "orders", [
    ("c5000", "o_orderkey"),
    ("c5231", "case when o_orderkey % 9 = 0 then null else o_orderdate end"),
], where="o_orderkey % 97 <> 0"))

_add(_v("clientes", "customer", [("c0902", "c_custkey")], where="c_custkey % 53 <> 52"))

_add(_v("miembros", "orders", [
    ("saldo_jts_oid", "o_orderkey"),
    ("cod_cliente_m", "o_custkey + case when o_custkey % 3 = 0 then 1 else 0 end"),
    ("nro_prestamo", "o_orderkey"),
], where="o_orderpriority = '5-LOW'"))

_add(_v("relacion_grupo", "customer", [
    ("c3198", "c_custkey"),
    ("c3199", "c_custkey + case when c_custkey % 3 = 0 then 1 else 0 end"),
    ("c3201", "case when c_custkey % 6 = 0 then 'N' when c_custkey % 6 = 1 then 's' else 'S' end"),
    ("c3210", "case when c_custkey % 10 = 0 then 'AC  ' when c_custkey % 10 = 4 then 'ac' when c_custkey % 10 = 1 then 'BA' else 'AC' end"),
    ("tz_lock", "case when c_custkey % 33 = 32 then 1 else 0 end"),
]))

_add(_v("documento", "customer", [
    ("idpersona", "c_custkey"),
    ("nrodocumento", "concat('C', cast(c_custkey as varchar(20)))"),
    ("tipodoc", "'CED'"),
    ("estado", "case when c_custkey % 13 = 12 then 'I' when c_custkey % 13 = 5 then 'a ' else 'A' end"),
    ("principal", "case when c_custkey % 17 = 16 then 'N' when c_custkey % 17 = 3 then 's' else 'S' end"),
]))

# One-row parameter tables of the run.
_add(_v("parametros", "region", [
    ("fechaproceso", f"timestamp '{CUTOFF} 00:00:00'"),
], where="r_regionkey = 0",
   spark_override={"fechaproceso": f"timestamp_ntz '{CUTOFF} 00:00:00'"}))

_add(_v("maestro", "region", [
    ("id_maestrounico", f"'{CONTROL_VERSION}'"),
    ("estado", "1"),
], where="r_regionkey = 0"))

SHARED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

# SQL for the derived views, shared by both engines.
DERIVED_SQL = {
    "historia": "select * from historia_orden union all select * from historia_linea",
    # some persons have two main documents: the coordinator lookup fans out
    "persona_documento": """
        select * from documento
        union all select idpersona, concat('X', nrodocumento), tipodoc, estado, principal
        from documento where idpersona % 29 = 0""",
    "garantia_texto": """
        select r.nrosolicitud as nro_prestamo, g.nrogarantia as orden, g.descripcion
        from relacion_garantia r join garantias g on r.nrogarantia = g.nrogarantia
        where r.tz_lock = 0 and g.tz_lock = 0""",
}
DERIVED_DEPS = {
    "historia": ("historia_orden", "historia_linea"),
    "persona_documento": ("documento",),
    "garantia_texto": ("relacion_garantia", "garantias"),
}


def _select_sql(view: View, spark: bool = False) -> str:
    cols = ",\n       ".join(
        f"{(view.spark_override.get(c) if spark else None) or e} as {c}"
        for c, e in view.columns)
    sql = f"select {cols}\nfrom {view.source}"
    if view.where:
        sql += f"\nwhere {view.where}"
    if view.group_by:
        sql += f"\ngroup by {view.group_by}"
    return sql


def view_sql(name: str) -> str:
    """SQL text of one adapter view (DuckDB dialect)."""
    if name in DERIVED_SQL:
        return DERIVED_SQL[name]
    return _select_sql(VIEWS[name])


def with_clause(names: list[str] | tuple[str, ...]) -> str:
    """``WITH`` clause defining the named views and their dependencies, in
    dependency order, for an oracle query."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for d in DERIVED_DEPS.get(n, ()):
            visit(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    return "with " + ",\n".join(f"{n} as ({view_sql(n)})" for n in ordered) + "\n"


class TestWorld:
    """Domain tables of the engine, built by Spark from the shared parquet
    tables of one scale-factor directory. Views are lazy and cached per
    instance; nothing is collected."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One shared-table read per world: the file listing and footer read
        happen once, and views over the same table share the scan's plan."""
        key = f"@{name}"
        if key not in self._cache:
            self._cache[key] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[key]

    def _source(self, view: View) -> DataFrame:
        if view.source == "orders join customer on o_custkey = c_custkey":
            return self.table("orders").join(
                self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        if view.source == "part join orders on p_partkey = o_orderkey":
            return self.table("part").join(
                self.table("orders"), F.col("p_partkey") == F.col("o_orderkey"))
        return self.table(view.source)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def _build(self, name: str) -> DataFrame:
        if name == "historia":
            return self["historia_orden"].unionByName(self["historia_linea"])
        if name == "persona_documento":
            one = self["documento"]
            second = one.where("idpersona % 29 = 0").withColumn("nrodocumento", F.expr("concat('X', nrodocumento)"))
            return one.unionByName(second)
        if name == "garantia_texto":
            r = self["relacion_garantia"].where("tz_lock = 0")
            g = self["garantias"].where("tz_lock = 0")
            return r.join(g, "nrogarantia").select(
                F.col("nrosolicitud").alias("nro_prestamo"),
                F.col("nrogarantia").alias("orden"), "descripcion")
        view = VIEWS[name]
        df = self._source(view)
        if view.where:
            df = df.where(view.where)
        exprs = [F.expr(view.spark_override.get(c) or e).alias(c)
                 for c, e in view.columns]
        if view.group_by:
            # first column: the grouping key as a date; the rest: aggregates
            key_col, _ = view.columns[0]
            return (df.groupBy(view.group_by)
                    .agg(*exprs[1:])
                    .select(F.to_date(F.col(view.group_by)).alias(key_col),
                            *[c for c, _ in view.columns[1:]]))
        return df.select(*exprs)
