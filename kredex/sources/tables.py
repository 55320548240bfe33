"""Readers of the portfolio's source tables.

Each table is read from Parquet with an explicit schema (no inference), so
column pruning and filter pushdown reach the scan. The universe and
group-member relations are dated snapshots: one folder partitioned by
``fecha`` whose cutoff partition is selected by partition pruning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collation import collated

D2 = "decimal(15,2)"
D4 = "decimal(15,4)"

# Column types chosen for the source tables (the report's sources declare
# none; these follow the sink types and the way each column is used).
INPUT_SCHEMAS: dict[str, str] = {
    "parametros": "fechaproceso timestamp_ntz",
    "maestro": "id_maestrounico string, estado int",
    "saldos": (f"jts_oid bigint, moneda int, c1620 timestamp_ntz, c1677 string, c1632 {D4}, "
               f"c1633 {D4}, c1604 {D2}, c1704 bigint, c1803 bigint, c9314 int, cuenta bigint, "
               "tz_lock int"),
    "universe": (
        "fecha date, jts_oid bigint, codigo_cliente bigint, nro_prestamo bigint, "
        "nombre_cliente string, tipo_prestamo string, tipo_persona string, numero_ruc string, "
        "numero_documento string, descripcion_tipo_credito string, producto_agrupador string, "
        "producto string, sector string, frecuencia_pago string, situacion_prestamo string, "
        "codigo_estado string, tipo_garantia string, clasificacion_prestamo string, "
        "calificacion_utilizada string, desc_sucursal_prestamo string, analista string, "
        f"rubro_contable decimal(15,0), importe_desembolso_mo {D2}, saldo_mn {D2}, "
        f"saldo_mo {D2}, intereses_saneados_mn {D2}, devengado_int_cte_mn {D2}, "
        f"mto_ult_pago_capital {D2}, interes_moratorio_mn {D2}, provision_mn {D2}, "
        f"tasa_interes {D4}, codigo_moneda int, fecha_desembolso timestamp_ntz, "
        "fecha_vencimiento timestamp_ntz, fecha_1erpago_pactado timestamp_ntz, "
        "fecha_empeso_mora_capital timestamp_ntz, fecha_empeso_mora_interes timestamp_ntz, "
        "cantidad_cuotas int, cantidad_cuotas_pactadas int, cuotas_pagadas int, "
        "cantidad_cuotas_vencidas int"),
    "miembros": "fecha date, saldo_jts_oid bigint, cod_cliente_m bigint, nro_prestamo bigint",
    "solicitudes": "c5000 bigint, c5231 timestamp_ntz",
    "clientes": "c0902 bigint",
    "monedas": "c6399 int, c6400 string",
    "historia": (f"saldos_jts_oid bigint, tipomov string, fechavalor timestamp_ntz, "
                 f"interespagado {D2}, capitalpagado {D2}, tasainteres {D4}, tasamora {D4}, "
                 "movimiento bigint, tz_lock int"),
    "plan_pagos": (f"saldo_jts_oid bigint, numero_cuota int, c2302 timestamp_ntz, c2304 {D2}, "
                   f"c2305 {D2}, c2309 {D2}, c2310 {D2}, tz_lock int"),
    "plan_pagos_original": (f"saldos_jts_oid bigint, numero_cuota int, capital {D2}, "
                            f"intereses {D2}, fecha_vencimiento timestamp_ntz, tz_lock int"),
    "gastos": f"saldos_jts_oid bigint, numero_cuota int, importe_gastos {D2}",
    "relacion_garantia": "nrosolicitud bigint, nrogarantia bigint, tz_lock int",
    "garantias": ("nrogarantia bigint, gar_moneda int, gar_fecha timestamp_ntz, "
                  "descripcion string, tz_lock int"),
    "relacion_grupo": "c3198 bigint, c3199 bigint, c3201 string, c3210 string, tz_lock int",
    "persona_documento": ("idpersona bigint, nrodocumento string, tipodoc string, "
                          "estado string, principal string"),
    "devengamiento": (f"saldo_jts_oid bigint, fecha timestamp_ntz, "
                      f"interes_deveng_vigente_cont {D2}, interes_deveng_vencido_cont {D2}, "
                      f"mora_tasa_int_deveng_venc_cont {D2}, mora_tasa_int_deveng_vige_cont {D2}"),
    "tipo_cambio": "fecha date, tipo_cambio decimal(8,4)",
    "garantia_texto": "nro_prestamo bigint, orden int, descripcion string",
}

DATED = ("universe", "miembros")


class TableSource(Mapping):
    """The source tables of one run, read lazily from ``root/<table>``.

    ``saldos_garantia`` (collateral balance rows) is the balance table
    itself; the dated snapshots are cut at the cutoff date. ``devengamiento``
    (accruals) may be stored by ``fecha`` too: the report's date filter is then
    a partition filter, and a run reads only its own day. With ``collation`` the
    coded columns compare by it; without, tables are as stored.
    """

    def __init__(self, spark: SparkSession, root: str, cutoff: dt.date | None = None,
                 paths: dict[str, str] | None = None, collation: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.cutoff = cutoff
        self.paths = paths or {}
        self.collation = collation
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return self.paths.get(name, f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(INPUT_SCHEMAS[name]).parquet(self.path(name))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name == "saldos_garantia":
                df = self.read("saldos")
            elif name in DATED:
                df = snapshot(self.read(name), self.cutoff)
            else:
                df = self.read(name)
            self._cache[name] = df if self.collation is None else collated(name, df, self.collation)
        return self._cache[name]

    def __iter__(self):
        return iter(list(INPUT_SCHEMAS) + ["saldos_garantia"])

    def __len__(self) -> int:
        return len(INPUT_SCHEMAS) + 1


def snapshot(df: DataFrame, cutoff: dt.date | None) -> DataFrame:
    """The rows of a dated relation at ``cutoff`` (a partition filter)."""
    if cutoff is None:
        raise ValueError("a dated snapshot needs the cutoff date")
    if isinstance(cutoff, dt.datetime):
        cutoff = cutoff.date()
    return df.where(F.col("fecha") == F.lit(cutoff)).drop("fecha")
