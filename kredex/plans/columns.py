"""Column rules of the report over the joined loan spine.

Each function returns a Spark ``Column`` for one report column (or one
shared piece of several); the registered queries and the full extract use
the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import exprs as X


def disbursement_rate_col():
    return X.single_value(F.col("disbursement_rate"),
                          F.coalesce(F.col("disbursement_rows"), F.lit(0)),
                          "disbursement rate")


def instalment_col():
    """T5: earliest pending instalment while some are still current, the
    latest one when all remaining are overdue (NULL counters: earliest)."""
    remaining = F.col("cantidad_cuotas") - F.col("cuotas_pagadas")
    return (F.when(remaining <= F.col("cantidad_cuotas_vencidas"), F.col("last_pending_amount"))
            .otherwise(F.col("first_pending_amount")))


def id_number_col():
    group = X.is_code("tipo_prestamo", X.GROUP_LOAN)
    return (F.when(group, F.col("coord_document"))
            .when(X.is_code("tipo_persona", X.LEGAL_PERSON), F.col("numero_ruc"))
            .otherwise(F.col("numero_documento")))


def person_type_col():
    group = X.is_code("tipo_prestamo", X.GROUP_LOAN)
    coord_type = F.when(F.col("coord_document").isNotNull() | F.col("coord_client").isNotNull(),
                        F.lit(X.PERSON_NATURAL))
    return (F.when(group, coord_type)
            .when(~group & X.is_code("tipo_persona", X.LEGAL_PERSON), F.lit(X.PERSON_LEGAL))
            .otherwise(F.lit(X.PERSON_NATURAL)))


def currency_col():
    return X.single_value(F.col("currency_name"), F.coalesce("currency_rows", F.lit(0)),
                          "currency name")


def client_class_col():
    return (F.when(X.is_code("situacion_prestamo", X.WRITTEN_OFF), F.lit(X.WRITTEN_OFF_CLIENT_CLASS))
            .otherwise(X.grade_to_class("calificacion_utilizada")))


def interest_balance_col():
    return (F.when(X.is_code("situacion_prestamo", X.WRITTEN_OFF), F.col("intereses_saneados_mn"))
            .otherwise(F.col("devengado_int_cte_mn")))


def current_interest(f):
    return F.coalesce(F.col("interes_deveng_vigente_cont") * f, F.lit(0)).cast("decimal(24,2)")


def overdue_interest(f):
    z = F.lit(0)
    parts = (F.coalesce("interes_deveng_vencido_cont", z)
             + (F.coalesce("mora_tasa_int_deveng_venc_cont", z)
                + F.coalesce("mora_tasa_int_deveng_vige_cont", z)))
    return (F.when(X.is_code("situacion_prestamo", X.WRITTEN_OFF), F.col("intereses_saneados_mn"))
            .otherwise(parts * f)).cast("decimal(26,2)")


def rate_type():
    """Containment by the column's collation, as ``LIKE '%x%'`` there."""
    return (F.when(F.col("producto").contains(X.VARIABLE_RATE_PRODUCT), F.lit(X.RATE_VARIABLE))
            .otherwise(F.lit(X.RATE_FIXED)))


def date_exprs() -> dict[str, Column]:
    """C19-C21, C23, C26, C27."""
    return {"fecha_aprobacion": X.fmt_date(F.coalesce("c5231", "fecha_desembolso")),
            "fecha_desembolso": X.fmt_date_or_blank("fecha_desembolso"),
            "fecha_vencimiento": X.fmt_date("fecha_vencimiento"),
            "fecha_primer_pago": X.fmt_date("fecha_1erpago_pactado"),
            "fecha_ingreso_mora_ppal": X.sentinel_blank("fecha_empeso_mora_capital"),
            "fecha_ingreso_mora_int": X.sentinel_blank("fecha_empeso_mora_interes")}


def date_cols() -> list[Column]:
    return [v.alias(k) for k, v in date_exprs().items()]
