"""Fused per-child-table aggregates.

The report reads each child table many times through correlated lookups
(latest payment, next due date, days past due, ...). Here every child table
is read once and folded into one row per key by a single ``groupBy``; each
lookup becomes one conditional aggregate of that row. All aggregates used
(``sum/min/max/count/max_by/min_by``) combine partially on the map side, so a
key holding a large share of the rows is reduced per task before the shuffle
and never gathered raw in one task.

Greatest-per-group lookups (``TOP 1 ... ORDER BY``) use ``max_by`` with a
condition on the *key*: rows failing the lookup's filter get a NULL key and are
skipped. Keys are flat: date and tie-break packed into one number, which a hash
aggregate can hold and combine on the map side, so a lookup needs one level per
loan and one exchange. Only the sum of the latest payment date has a date level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.collation import padded
from .skew import ROWS_PER_TASK

LOAN = "jts_oid"


def valid(df: DataFrame) -> DataFrame:
    """Rows not locked for update (``TZ_LOCK = 0``)."""
    return df.where(F.col("tz_lock") == 0)


def no_date() -> Column:
    """Ranks a NULL date below every date, as SQL Server's order does."""
    return F.expr("timestamp_ntz '0001-01-01 00:00:00'")


def _when(cond: Column, value: Column | str) -> Column:
    return F.when(cond, F.col(value) if isinstance(value, str) else value)


# --------------------------------------------------------------------------
# Current repayment schedule: one pass, eight lookups.
# --------------------------------------------------------------------------

def schedule_facts(plan_pagos: DataFrame, cutoff: Column) -> DataFrame:
    """Per loan, from valid schedule rows:

    * ``max_due``                       latest due date (term)
    * ``principal_current/overdue``     outstanding principal due on/after or
                                        before the cutoff (NULL when none)
    * ``next_principal_due/next_interest_due``  earliest due date with
                                        principal / interest outstanding
    * ``oldest_overdue_principal/interest``  earliest overdue due date with
                                        principal / interest outstanding
    * ``first_pending/last_pending``    capital + interest of the earliest /
                                        latest instalment with anything
                                        outstanding (ties: smaller amount
                                        first)
    """
    due = F.col("c2302")
    cap, intr = F.col("c2309") > 0, F.col("c2310") > 0
    overdue = due < cutoff
    pending = (F.col("c2309") + F.col("c2310")) > 0
    amount = F.col("c2304") + F.col("c2305")
    # (due date, amount) as one number, so that the first and the last pending
    # instalment are a plain min and max; a NULL amount gives way to others of
    # its date
    place = instant(due).cast("decimal(18,0)") * F.expr(f"cast({AMOUNTS} as decimal(20,0))")
    cents = ((amount * 100).cast("bigint") + ZERO_AMOUNT).cast("decimal(20,0)")
    first = F.min(F.col("place") + F.coalesce("cents", F.lit(NO_AMOUNT_LAST).cast("decimal(20,0)")))
    last = F.max(F.col("place") + F.coalesce("cents", F.lit(0).cast("decimal(20,0)")))
    rows = valid(plan_pagos).select("saldo_jts_oid", "c2302", "c2309", "c2310", _when(pending, place).alias("place"),
                                    _when(pending, cents).alias("cents"))
    facts = (rows.groupBy(F.col("saldo_jts_oid").alias(LOAN))
             .agg(F.max(due).alias("max_due"),
                  F.sum(_when(cap & (due >= cutoff), "c2309")).alias("principal_current"),
                  F.sum(_when(cap & overdue, "c2309")).alias("principal_overdue"),
                  F.min(_when(cap, due)).alias("next_principal_due"),
                  F.min(_when(intr, due)).alias("next_interest_due"),
                  F.min(_when(cap & overdue, due)).alias("oldest_overdue_principal"),
                  F.min(_when(intr & overdue, due)).alias("oldest_overdue_interest"),
                  first.alias("first_pending"), last.alias("last_pending")))
    return (facts.withColumns({f"{x}_pending_amount": _amount(F.col(f"{x}_pending")) for x in ("first", "last")})
            .drop("first_pending", "last_pending"))


#: Room of an amount, in hundredths, in a packed (date, amount) number.
AMOUNTS = 10 ** 19
ZERO_AMOUNT = 5 * 10 ** 17
NO_AMOUNT_LAST = 9 * 10 ** 18


def _amount(packed: Column) -> Column:
    part = (packed % F.expr(f"cast({AMOUNTS} as decimal(20,0))")).cast("decimal(20,0)")
    return F.when(part.between(1, NO_AMOUNT_LAST - 1), ((part - ZERO_AMOUNT).cast("decimal(18,0)") / 100).cast("decimal(16,2)"))


def instant(t: Column) -> Column:
    """A timestamp as microseconds since the year 1, from 1 on; a NULL is 0 (it
    ranks below every date, as SQL Server's order has it)."""
    day = F.datediff(F.to_date(t), F.lit("0001-01-01").cast("date")).cast("bigint")
    seconds = (F.hour(t) * 3600 + F.minute(t) * 60).cast("bigint")
    micros = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return F.coalesce((day * 86_400 + seconds) * 1_000_000 + micros + 1, F.lit(0).cast("bigint"))


# --------------------------------------------------------------------------
# Movement history: one pass, seven lookups.
# --------------------------------------------------------------------------

def history_facts(historia: DataFrame) -> DataFrame:
    """Per loan, from valid movements:

    * ``last_principal_payment`` / ``last_interest_payment``  latest value
      date of a payment ('P') with principal / interest > 0
    * ``interest_paid_last_date``  total interest paid on the latest
      interest-payment value date
    * ``disbursement_rate`` + ``disbursement_rows``  rate of the
      disbursement ('A' or 'I') row and how many such rows exist
    * ``current_rate``  rate of the latest rate-bearing movement: a
      disbursement, or an 'S' movement with a positive rate
    * ``current_spread``  late-rate minus rate of the latest disbursement or
      'S' movement with a positive spread

    Latest = greatest (value date, movement id).
    """
    # the kind is compared once a row, by its column's collation
    code = F.when(F.col("tipomov") == "P", 1).when(F.col("tipomov").isin("A", "I"), 2).when(F.col("tipomov") == "S", 3)
    # (value date, movement id) as one number: a flat key keeps the aggregate a
    # hash aggregate, a NULL of either ranks below every value
    movement = F.coalesce(F.col("movimiento").cast("bigint"), F.lit(-(1 << 63)))
    order = (instant(F.col("fechavalor")).cast("decimal(18,0)") * F.expr(f"cast({1 << 64} as decimal(20,0))")
             + movement.cast("decimal(20,0)") + F.expr(f"cast({1 << 63} as decimal(20,0))"))
    h = (valid(historia).withColumn("kind", code)
         .select("saldos_jts_oid", "kind", "fechavalor", "interespagado", "capitalpagado", "tasainteres",
                 (F.col("tasamora") - F.col("tasainteres")).alias("spread"), _when(F.col("kind") > 1, order).alias("place")))
    pay, disb, spread = F.col("kind") == 1, F.col("kind") == 2, F.col("spread")
    interest = pay & (F.col("interespagado") > 0)
    rate_cand = disb | ((F.col("kind") == 3) & (F.col("tasainteres") > 0))
    spread_cand = disb | ((F.col("kind") == 3) & (spread > 0))
    # only interest payments need a date level (the sum of the latest date);
    # all other movements of a loan are one row of the first level
    per_date = (
        h.groupBy(F.col("saldos_jts_oid").alias(LOAN),
                  F.when(interest, F.coalesce("fechavalor", no_date())).alias("paid_on"))
        .agg(F.sum(_when(interest, "interespagado")).alias("interest"),
             F.max(_when(pay & (F.col("capitalpagado") > 0), "fechavalor")).alias("principal_day"),
             F.count(_when(disb, F.lit(1))).alias("disb_rows"),
             F.max(_when(disb, "tasainteres")).alias("disb_rate"),
             F.max_by("tasainteres", _when(rate_cand, "place")).alias("rate"),
             F.max_by(spread, _when(spread_cand, "place")).alias("spread")))
    day = F.col("paid_on")
    return (
        per_date.groupBy(LOAN)
        .agg(F.max("principal_day").alias("last_principal_payment"),
             F.max(F.nullif(day, no_date())).alias("last_interest_payment"),
             F.max_by("interest", day).alias("interest_paid_last_date"),
             F.sum("disb_rows").alias("disbursement_rows"),
             F.max("disb_rate").alias("disbursement_rate"),
             # no interest payment bears a rate: one row of the loan has it
             F.max("rate").alias("current_rate"),
             F.max("spread").alias("current_spread")))


# --------------------------------------------------------------------------
# Original schedule: grace period.
# --------------------------------------------------------------------------

def original_schedule_facts(plan_original: DataFrame) -> DataFrame:
    """Per loan: ``first_capital_due`` (earliest due date of a valid
    instalment after the first that repays capital; a NULL due date ranks
    first) and ``interest_only_first`` (1 when instalment 1 repays interest
    only, lock flag not considered, as in the reference)."""
    n = F.col("numero_cuota")
    later_capital = (F.col("tz_lock") == 0) & (F.col("capital") > 0) & (n > 1)
    io_first = (n == 1) & (F.col("capital") == 0) & (F.col("intereses") > 0)
    return (plan_original.where(io_first | later_capital)
            .groupBy(F.col("saldos_jts_oid").alias(LOAN))
            .agg(F.min(_when(later_capital, F.coalesce("fecha_vencimiento", no_date()))).alias("first_capital"),
                 F.max(_when(io_first, F.lit(1))).alias("interest_only_first"))
            .select(LOAN, F.nullif("first_capital", no_date()).alias("first_capital_due"),
                    F.col("first_capital").isNotNull().alias("has_later_capital"),
                    "interest_only_first"))


def grace_days(facts_prefix: str = "") -> Column:
    """Days from disbursement to the first capital instalment, when the first
    instalment is interest only; 0 otherwise."""
    from ..functions.exprs import day_diff
    io = F.col(f"{facts_prefix}interest_only_first") == 1
    days = F.when(io, day_diff(F.col("fecha_desembolso"), F.col(f"{facts_prefix}first_capital_due")))
    return F.coalesce(days, F.lit(0))


# --------------------------------------------------------------------------
# Client totals over the whole universe (before any spine filter).
# --------------------------------------------------------------------------

def client_facts(universe: DataFrame, tc: Column) -> DataFrame:
    """Per client: number of loans and total debt in local currency (foreign
    balances at the cutoff rate). One ``groupBy`` for both."""
    debt = (F.when(F.col("codigo_moneda") != 1, F.col("saldo_mo") * tc)
            .otherwise(F.col("saldo_mn")))
    return (universe.groupBy("codigo_cliente")
            .agg(F.count("codigo_cliente").alias("loans_per_client"),
                 F.sum(debt).alias("client_debt")))


# --------------------------------------------------------------------------
# Collateral value per credit application.
# --------------------------------------------------------------------------

def collateral_value(relacion: DataFrame, garantias: DataFrame,
                     saldos_garantia: DataFrame, fx_rates: DataFrame,
                     tc: Column) -> DataFrame:
    """Per application (``nrosolicitud``): sum over its collaterals of the
    negated collateral balance, converted by currency: 1 as is, 2 at the rate
    of the collateral's date, 3 at the cutoff rate, others NULL.

    The value is first summed per collateral (garantia x balance rows, with
    the dated rate from the rate table), then per application:
    a sum over the three-way join equals the sum of per-collateral sums, and
    the large relation is joined to one row per collateral.
    """
    g = valid(garantias).select("nrogarantia", "gar_moneda", "gar_fecha")
    # one balance row per collateral: summed before the join (partial
    # aggregation), so a collateral with many balance rows is no hot join key
    bal = (valid(saldos_garantia).where(F.col("c9314") == 1)
           .groupBy(F.col("cuenta").alias("nrogarantia")).agg(F.sum("c1604").alias("c1604")))
    from ..functions.fx import rate_by_date
    rated = rate_by_date(g.join(bal, "nrogarantia"), "gar_fecha", fx_rates, out="_fx_rate",
                         used=F.col("gar_moneda") == 2)
    neg = -F.col("c1604")
    value = (F.when(F.col("gar_moneda") == 1, neg)
             .when(F.col("gar_moneda") == 2, neg * F.col("_fx_rate"))
             .when(F.col("gar_moneda") == 3, neg * tc))
    per_collateral = rated.groupBy("nrogarantia").agg(F.sum(value).alias("v"))
    # a collateral pledged to many applications is split over salts
    from .skew import split_hot_keys
    pledged = split_hot_keys(valid(relacion).select("nrosolicitud", "nrogarantia"),
                             per_collateral, ["nrogarantia"], "inner", id_cols=["nrosolicitud"])
    return (pledged.groupBy("nrosolicitud")
            .agg(F.sum("v").alias("collateral_value")))


# --------------------------------------------------------------------------
# Collateral description per loan.
# --------------------------------------------------------------------------

def collateral_text(texts: DataFrame, sep: str = "; ", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per loan number: collateral descriptions joined by ``sep`` in
    (order, description) order, a loan with very many of them in ranges
    (``ordered_text.py``). Loans without collateral have no row; the report shows
    '' for them."""
    from .ordered_text import ordered_concat
    return ordered_concat(texts, "nro_prestamo", "orden", "descripcion", sep, "collateral_description", rows_per_task)


# --------------------------------------------------------------------------
# Group-loan coordinator.
# --------------------------------------------------------------------------

def coordinator(loans: DataFrame, miembros: DataFrame, relacion_grupo: DataFrame,
                persona_documento: DataFrame) -> DataFrame:
    """(loan, group client) of ``loans`` -> coordinator's main document.

    A member row counts for a loan only if the member coordinates the loan's
    own client, so the loans' (loan, client) pairs meet the members first and
    the relations on (person, client) together: the rows stay linear in the
    members, however many groups one person belongs to. Several rows per loan
    are possible (the lookup fans out, as in the reference). Trailing blanks of
    a code never count, on plain columns either.
    """
    rel = (padded(valid(relacion_grupo), "c3201", "c3210")
           .where((F.col("c3201") == "S") & (F.col("c3210") == "AC"))
           .select("c3198", "c3199"))
    doc = (padded(persona_documento, "estado", "principal")
           .where((F.col("estado") == "A") & (F.col("principal") == "S"))
           .select(F.col("idpersona").alias("c3199"), "nrodocumento"))
    of_loan = loans.select(LOAN, F.col("codigo_cliente").alias("c3198"))
    members = miembros.select(F.col("saldo_jts_oid").alias(LOAN), F.col("cod_cliente_m").alias("c3199"))
    return (members.join(of_loan, LOAN).join(rel, ["c3199", "c3198"]).join(doc, "c3199")
            .select(LOAN, F.col("c3198").alias("coord_client"),
                    F.col("nrodocumento").alias("coord_document")))


# --------------------------------------------------------------------------
# Smaller lookups.
# --------------------------------------------------------------------------

def first_instalment_fees(gastos: DataFrame) -> DataFrame:
    return (gastos.where(F.col("numero_cuota") == 1)
            .groupBy(F.col("saldos_jts_oid").alias(LOAN))
            .agg(F.sum("importe_gastos").alias("fees_first_instalment")))


def accruals_at(devengamiento: DataFrame, cutoff: Column) -> DataFrame:
    """Accrual rows dated exactly at the cutoff (may be several per loan)."""
    return (devengamiento.where(F.col("fecha") == cutoff)
            .select(F.col("saldo_jts_oid").alias(LOAN),
                    "interes_deveng_vigente_cont", "interes_deveng_vencido_cont",
                    "mora_tasa_int_deveng_venc_cont", "mora_tasa_int_deveng_vige_cont"))


def currency_names(monedas: DataFrame) -> DataFrame:
    """Currency code -> name, with the number of rows per code so a
    duplicated code can fail the scalar lookup only where it is used."""
    return (monedas.groupBy(F.col("c6399").alias("currency_code"))
            .agg(F.max("c6400").alias("currency_name"),
                 F.count(F.lit(1)).alias("currency_rows")))


__all__ = [
    "LOAN", "valid", "schedule_facts", "history_facts",
    "original_schedule_facts", "grace_days", "client_facts",
    "collateral_value", "collateral_text", "coordinator",
    "first_instalment_fees", "accruals_at", "currency_names",
]
