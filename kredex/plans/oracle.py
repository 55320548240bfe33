"""DuckDB SQL of the registered queries, written from the rules of SURVEY §2.

Every rule is one relation of ``RULES``: one row per loan (or per client,
application, ...), set-based, with ranks for the "latest row" rules. A query
names its columns over the relations it needs; ``statement`` adds them and the
test-data views they read as CTEs. The Spark side shares none of this text.
"""

from __future__ import annotations

import re

from ..schemas import EXPORT_NAMES, KEY, RESULT_COLUMNS, TEXT_LIMITS
from ..sources.adapters import CUTOFF_TC, DERIVED_SQL, VIEWS, with_clause

RATE = f"cast({CUTOFF_TC} as decimal(8,4))"

RULES: dict[str, str] = {
    # the run's day and version
    "run": """select (select fechaproceso from parametros) as cut,
                     (select id_maestrounico from maestro where estado = 1) as version""",
    # loans of the report: unlocked balance rows with their universe row
    "loan": """select b.jts_oid as loan, b.moneda as ccy, b.c1620 as opened, b.c1677 as mode_code,
                      b.c1632 as plain_rate, b.c1633 as plain_late_rate, b.c1704 as request,
                      b.c1803 as holder,
                      u.* exclude (jts_oid) replace (
                          CODE(codigo_estado) as codigo_estado, CODE(clasificacion_prestamo) as clasificacion_prestamo,
                          CODE(calificacion_utilizada) as calificacion_utilizada, CODE(tipo_prestamo) as tipo_prestamo,
                          CODE(tipo_persona) as tipo_persona, CODE(situacion_prestamo) as situacion_prestamo,
                          CODE(producto) as producto),
                      case when b.moneda = 1 then cast(1 as decimal(8,4)) else """ + RATE + """ end as to_local
               from saldos b join universe u using (jts_oid) where b.tz_lock = 0""",
    "client": f"""select codigo_cliente, count(codigo_cliente) as loans,
                         sum(case when codigo_moneda <> 1 then saldo_mo * {RATE} else saldo_mn end) as debt
                  from universe group by codigo_cliente""",
    # current schedule
    "due": """select saldo_jts_oid as loan, max(c2302) as last_day,
                     sum(c2309) filter (c2309 > 0 and c2302 >= cut) as principal_open,
                     sum(c2309) filter (c2309 > 0 and c2302 < cut) as principal_late,
                     min(c2302) filter (c2309 > 0) as principal_next,
                     min(c2302) filter (c2310 > 0) as interest_next,
                     min(c2302) filter (c2309 > 0 and c2302 < cut) as principal_oldest,
                     min(c2302) filter (c2310 > 0 and c2302 < cut) as interest_oldest
              from plan_pagos, run where tz_lock = 0 group by saldo_jts_oid""",
    "pending": """select saldo_jts_oid as loan, c2304 + c2305 as amount,
                         row_number() over (partition by saldo_jts_oid
                                            order by c2302 nulls first, c2304 + c2305) as from_first,
                         row_number() over (partition by saldo_jts_oid
                                            order by c2302 desc nulls last, c2304 + c2305 desc) as from_last
                  from plan_pagos where tz_lock = 0 and c2309 + c2310 > 0""",
    "instalment": """select l.loan, p.amount
                     from loan l join pending p on p.loan = l.loan
                      and 1 = case when l.cantidad_cuotas - l.cuotas_pagadas <= l.cantidad_cuotas_vencidas
                                   then p.from_last else p.from_first end""",
    # original schedule
    "grace": """select o.saldos_jts_oid as loan, min(o.fecha_vencimiento) as first_capital,
                       bool_or(o.fecha_vencimiento is null) as undated
                from plan_pagos_original o
                where o.tz_lock = 0 and o.capital > 0 and o.numero_cuota > 1
                  and o.saldos_jts_oid in (select saldos_jts_oid from plan_pagos_original
                                           where numero_cuota = 1 and capital = 0 and intereses > 0)
                group by o.saldos_jts_oid""",
    "fee": """select saldos_jts_oid as loan, sum(importe_gastos) as fees
              from gastos where numero_cuota = 1 group by saldos_jts_oid""",
    # movement history
    "payment": """select saldos_jts_oid as loan, max(fechavalor) filter (capitalpagado > 0) as principal_day,
                         max(fechavalor) filter (interespagado > 0) as interest_day
                  from historia where CODE(tipomov) = LIT('P') and tz_lock = 0 group by saldos_jts_oid""",
    "interest_by_day": """select saldos_jts_oid as loan, fechavalor, sum(interespagado) as paid,
                                 row_number() over (partition by saldos_jts_oid
                                                    order by fechavalor desc nulls last) as back
                          from historia where CODE(tipomov) = LIT('P') and tz_lock = 0 and interespagado > 0
                          group by saldos_jts_oid, fechavalor""",
    "disbursed": """select saldos_jts_oid as loan, max(tasainteres) as rate
                    from historia where CODE(tipomov) in (LIT('A'), LIT('I')) and tz_lock = 0 group by saldos_jts_oid""",
    "latest_rate": """select saldos_jts_oid as loan, tasainteres as rate
                      from HISTORY where tz_lock = 0 and (CODE(tipomov) in (LIT('A'), LIT('I')) or (CODE(tipomov) = LIT('S') and tasainteres > 0))
                      qualify row_number() over (partition by saldos_jts_oid
                          order by fechavalor desc nulls last, movimiento desc nulls last) = 1""",
    "latest_spread": """select saldos_jts_oid as loan, tasamora - tasainteres as spread
                        from HISTORY where tz_lock = 0
                          and (CODE(tipomov) in (LIT('A'), LIT('I')) or (CODE(tipomov) = LIT('S') and tasamora - tasainteres > 0))
                        qualify row_number() over (partition by saldos_jts_oid
                            order by fechavalor desc nulls last, movimiento desc nulls last) = 1""",
    "accrual": """select saldo_jts_oid as loan, interes_deveng_vigente_cont as running,
                         coalesce(interes_deveng_vencido_cont, 0) + coalesce(mora_tasa_int_deveng_venc_cont, 0)
                         + coalesce(mora_tasa_int_deveng_vige_cont, 0) as late
                  from devengamiento, run where fecha = cut""",
    # collateral
    "worth": f"""select g.nrogarantia, sum(case g.gar_moneda when 1 then -b.c1604
                                                when 2 then -b.c1604 * f.tipo_cambio
                                                when 3 then -b.c1604 * {RATE} end) as value
                 from garantias g
                 join saldos_garantia b on b.cuenta = g.nrogarantia
                 left join tipo_cambio f on f.fecha = cast(g.gar_fecha as date)
                 where g.tz_lock = 0 and b.tz_lock = 0 and b.c9314 = 1 group by g.nrogarantia""",
    "pledge": """select r.nrosolicitud as request, sum(w.value) as value
                 from relacion_garantia r join worth w using (nrogarantia)
                 where r.tz_lock = 0 group by r.nrosolicitud""",
    "pledge_text": """select nro_prestamo, string_agg(descripcion, '; ' order by orden, descripcion) as words
                      from garantia_texto group by nro_prestamo""",
    # group coordinator
    "leader": """select m.saldo_jts_oid as loan, r.c3198 as of_client, d.nrodocumento as document
                 from relacion_grupo r
                 join miembros m on m.cod_cliente_m = r.c3199
                 join persona_documento d on d.idpersona = r.c3199
                 where r.tz_lock = 0 and CODE(r.c3201) = LIT('S') and CODE(r.c3210) = LIT('AC')
                   and CODE(d.estado) = LIT('A') and CODE(d.principal) = LIT('S')""",
}


def day(x: str) -> str:
    return f"strftime({x}, '%d/%m/%Y')"


def days(a: str, b: str) -> str:
    return f"cast(cast({b} as date) - cast({a} as date) as integer)"


def dated(x: str) -> str:
    """A day, blank for the 1900-01-01 placeholder."""
    return f"case cast({x} as date) when date '1900-01-01' then '' else {day(x)} end"


def yearly(rate: str) -> str:
    return f"(power(1 + (({rate} / 100) / 12), 12) - 1) * 100"


def grade(x: str) -> str:
    return f"coalesce(list_position([LIT('A'), LIT('B'), LIT('C'), LIT('D'), LIT('E')], {x}), 0)"


WRITTEN_OFF = "l.situacion_prestamo = LIT('Saneado')"
GROUP = "l.tipo_prestamo = LIT('GRUPO SOLIDARIO')"
FROM_HISTORY = "l.codigo_estado in (LIT('C'), LIT('E'))"

# name: (expression, relations it needs); l is the loan
COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "client": ("l.codigo_cliente", ()),
    "id": (f"case when {GROUP} then leader.document when l.tipo_persona = LIT('J') then l.numero_ruc else l.numero_documento end",
           ("leader",)),
    "person": (f"case when {GROUP} then case when leader.loan is not null then 'Natural' end "
               "when l.tipo_persona = LIT('J') then 'Juridica' else 'Natural' end", ("leader",)),
    "loans": ("cast(client.loans as integer)", ("client",)),
    "debt": ("client.debt", ("client",)),
    "currency": ("monedas.c6400", ("monedas",)),
    "interest_balance": (f"case when {WRITTEN_OFF} then l.intereses_saneados_mn else l.devengado_int_cte_mn end", ()),
    "last_interest": ("coalesce(interest_by_day.paid, 0)", ("interest_by_day",)),
    "approved": (day("coalesce(solicitudes.c5231, l.fecha_desembolso)"), ("solicitudes",)),
    "disbursed_day": (f"coalesce({day('l.fecha_desembolso')}, '')", ()),
    "expires": (day("l.fecha_vencimiento"), ()),
    "first_payment": (day("l.fecha_1erpago_pactado"), ()),
    "late_principal_since": (dated("l.fecha_empeso_mora_capital"), ()),
    "late_interest_since": (dated("l.fecha_empeso_mora_interes"), ()),
    "term": (days("l.opened", "due.last_day"), ("due",)),
    "principal_day": (f"coalesce({day('payment.principal_day')}, '')", ("payment",)),
    "interest_day": (f"coalesce({day('payment.interest_day')}, '')", ("payment",)),
    "mode": ("coalesce(map {LIT('F'): 'Cuota Fija', LIT('H'): 'Decreciente', '': 'Al Vencimiento', LIT('C'): 'Irregular'}"
             "[CODE(l.mode_code)], '')", ()),
    "grace": (f"coalesce(case when not grace.undated then {days('l.fecha_desembolso', 'grace.first_capital')} end, 0)",
              ("grace",)),
    "rate_kind": ("if(contains(l.producto, LIT('COLABORADORES')), 'Variable', 'Fija')", ()),
    "contract_rate": (f"case when {WRITTEN_OFF} or l.situacion_prestamo = LIT('Cobro Judicial') then disbursed.rate "
                      "else l.plain_rate end", ("disbursed",)),
    "rate": (f"case when {FROM_HISTORY} then latest_rate.rate else l.plain_rate end", ("latest_rate",)),
    "yearly_rate": (f"case when {WRITTEN_OFF} then {yearly('disbursed.rate')} else {yearly('l.tasa_interes')} end",
                    ("disbursed",)),
    "spread": (f"case when {FROM_HISTORY} then latest_spread.spread else l.plain_late_rate - l.plain_rate end",
               ("latest_spread",)),
    "pledge_text": ("coalesce(pledge_text.words, '')", ("pledge_text",)),
    "pledge": ("coalesce(pledge.value, 0)", ("pledge",)),
    "instalment": ("instalment.amount", ("instalment",)),
    "instalment_fees": ("instalment.amount + coalesce(fee.fees, 0)", ("instalment", "fee")),
    "principal_open": ("coalesce(due.principal_open, 0) * l.to_local", ("due",)),
    "principal_late": ("coalesce(due.principal_late, 0) * l.to_local", ("due",)),
    "interest_running": ("coalesce(accrual.running * l.to_local, 0)", ("accrual",)),
    "interest_late": (f"case when {WRITTEN_OFF} then l.intereses_saneados_mn else coalesce(accrual.late, 0) * l.to_local end",
                      ("accrual",)),
    "principal_next": (f"coalesce({day('due.principal_next')}, '')", ("due",)),
    "interest_next": (f"coalesce({day('due.interest_next')}, '')", ("due",)),
    "principal_past": (f"coalesce({days('due.principal_oldest', 'run.cut')}, 0)", ("due", "run")),
    "interest_past": (f"coalesce({days('due.interest_oldest', 'run.cut')}, 0)", ("due", "run")),
    "class": (grade("l.clasificacion_prestamo"), ()),
    "client_class": (f"case when {WRITTEN_OFF} then 5 else {grade('l.calificacion_utilizada')} end", ()),
    "fees": ("fee.fees", ("fee",)),
    "number": ("l.nro_prestamo", ()),
    "cut": ("run.cut", ("run",)),
    "version": ("run.version", ("run",)),
}

# how a relation meets the loan (default: left join on the loan)
JOINS = {
    "client": "join client on client.codigo_cliente = l.codigo_cliente",
    "run": "cross join run",
    "monedas": "left join monedas on monedas.c6399 = l.ccy",
    "solicitudes": "join solicitudes on solicitudes.c5000 = l.request",
    "clientes": "join clientes on clientes.c0902 = l.holder",
    "interest_by_day": "left join interest_by_day on interest_by_day.loan = l.loan and interest_by_day.back = 1",
    "leader": "left join leader on leader.loan = l.loan and leader.of_client = l.codigo_cliente",
    "pledge": "left join pledge on pledge.request = l.request",
    "pledge_text": "left join pledge_text on pledge_text.nro_prestamo = l.nro_prestamo",
}


def over_loans(columns: dict[str, str], also: tuple[str, ...] = ()) -> str:
    """Select of ``{output name: column or expression with {column}}``."""
    needed: list[str] = list(also)
    out = []
    for name, text in columns.items():
        text = text if "{" in text else "{" + text + "}" if text in COLUMNS else text
        for used in re.findall(r"\{(\w+)\}", text):
            needed += [r for r in COLUMNS[used][1] if r not in needed]
            text = text.replace("{" + used + "}", f"({COLUMNS[used][0]})")
        out.append(f"{text} as {name}")
    joins = [JOINS.get(r, f"left join {r} on {r}.loan = l.loan") for r in dict.fromkeys(needed)]
    return "select " + ",\n       ".join(out) + "\nfrom loan l\n" + "\n".join(joins)


def statement(body: str, history: str = "historia", ctes: tuple[tuple[str, str], ...] = ()) -> str:
    """``body`` preceded by the views, rules and further CTEs it uses."""
    used: list[str] = []
    views: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b[a-z_]\w*\b", text):
            if word in RULES and word not in used and re.search(rf"\b(?:from|join|,)\s+{word}\b", text):
                visit(RULES[word].replace("HISTORY", history))
                used.append(word)
            elif (word in VIEWS or word in DERIVED_SQL) and word not in views:
                views.append(word)

    for text in (*[c[1] for c in ctes], body):
        visit(text)
    rules = [f"{r} as ({RULES[r].replace('HISTORY', history)})" for r in dict.fromkeys(used)]
    more = [f"{n} as materialized ({t})" for n, t in ctes]
    parts = ([with_clause(views)[len("with "):].rstrip()] if views else []) + rules + more
    return "with " + ",\n".join(parts) + "\n" + body + "\n"


def dec(x: str, t: str) -> str:
    return f"cast({x} as decimal({t}))"


# Query name -> select over the loans.
LOAN_QUERIES: dict[str, str] = {
    "days_past_due": over_loans({"cod_credito": "number", "dias_mora_principal": "principal_past",
                                 "dias_mora_intereses": "interest_past"}),
    "spine_join": over_loans({"cod_credito": "number", "cod_cliente": "client", "fecha_aprobacion": "approved"}, ("clientes",)),
    "client_loan_count": over_loans({"cod_credito": "number", "cod_cliente": "client", "no_creditos": "loans"}),
    "client_total_debt_fx": over_loans({"cod_credito": "number", "cod_cliente": "client",
                                        "deuda_total": dec("{debt}", "38,2")}),
    "first_instalment_fees": over_loans({"cod_credito": "number", "importe_gastos": dec("{fees}", "38,2")}),
    "last_payment_dates": over_loans({"cod_credito": "number", "fecha_ultimo_pago_ppal": "principal_day",
                                      "fecha_ultimo_pago_int": "interest_day"}),
    "bucketed_loan_facts": over_loans({
        "cod_credito": "number", "dias_mora_principal": "principal_past", "dias_mora_intereses": "interest_past",
        "monto_ult_pago_int": dec("{last_interest}", "38,2"), "tasa_vigente": dec("{rate}", "15,4")}),
    "interest_paid_on_last_date": over_loans({"cod_credito": "number", "monto_ult_pago_int": dec("{last_interest}", "38,2")}),
    "disbursement_rate_single": over_loans({"cod_credito": "number", "tasa_contractual": dec("{contract_rate}", "15,4")}),
    "effective_annual_rate": over_loans({"cod_credito": "number", "tasa_efectiva_vigente": dec("{yearly_rate}", "15,4")}),
    "rate_type_like": over_loans({"cod_credito": "number", "tipo_tasa": "rate_kind"}),
    "schedule_term_days": over_loans({"cod_credito": "number", "plazo": "term"}),
    "principal_current_overdue": over_loans({"cod_credito": "number", "principal_corriente": dec("{principal_open}", "24,2"),
                                             "principal_vencido": dec("{principal_late}", "38,2")}),
    "next_due_dates": over_loans({"cod_credito": "number", "fecha_prox_pago_ppal": "principal_next",
                                  "fecha_prox_pago_int": "interest_next"}),
    "instalment_conditional_topk": over_loans({"cod_credito": "number", "monto_cuota": dec("{instalment}", "16,2")}),
    "instalment_plus_fees": over_loans({"cod_credito": "number", "cuota_total": dec("{instalment_fees}", "38,2")}),
    "grace_days": over_loans({"cod_credito": "number", "dias_gracia": "grace"}),
    "accrual_at_cutoff": over_loans({"cod_credito": "number", "interes_cte_vgte": dec("{interest_running}", "24,2"),
                                     "interes_cte_vcdo": dec("{interest_late}", "26,2")}),
    "collateral_value_fx_by_date": over_loans({"cod_credito": "number", "valor_garantia": dec("{pledge}", "38,2")}),
    "collateral_description_concat": over_loans({"cod_credito": "number", "descripcion_garantia": "pledge_text"}),
    "group_coordinator": over_loans({"cod_credito": "number", "num_identificacion": "id", "tipo_persona": "person"}),
    "currency_lookup": over_loans({"cod_credito": "number", "moneda": "currency"}),
    "risk_grade_map": over_loans({"cod_credito": "number", "clasificacion": "cast({class} as integer)",
                                  "clasificacion_cliente": "cast({client_class} as integer)"}),
    "modality_map": over_loans({"cod_credito": "number", "modalidad": "mode"}),
    "written_off_interest": over_loans({"cod_credito": "number", "saldo_interes": dec("{interest_balance}", "15,2")}),
    "date_sentinel_format": over_loans({
        "cod_credito": "number", "fecha_aprobacion": "approved", "fecha_desembolso": "disbursed_day",
        "fecha_vencimiento": "expires", "fecha_primer_pago": "first_payment",
        "fecha_ingreso_mora_ppal": "late_principal_since", "fecha_ingreso_mora_int": "late_interest_since"}),
    "decimal_two_step_round": over_loans({
        "cod_credito": "number", "tasa_4": dec(yearly("l.tasa_interes"), "15,4"),
        "tasa_sink": dec(dec(yearly("l.tasa_interes"), "15,4"), "15,2"), "tasa_one_step": dec(yearly("l.tasa_interes"), "15,2")}),
}

# The result columns: source column of the loan, or a rule.
RESULT: dict[str, str] = {
    "Cod_Cliente": "client", "Nombre_Cliente": "l.nombre_cliente", "Num_Identificacion": "id", "Tipo_persona": "person",
    "No_Creditos": "loans", "Deuda_total": "debt", "Cod_Credito": "number", "Tipo_Credito": "l.descripcion_tipo_credito",
    "Tipo_Producto": "l.producto_agrupador", "Sector": "l.sector", "Fuente_Fin": "'Fondos Propios'",
    "Codigo_MUC": "l.rubro_contable", "Monto_Original": "l.importe_desembolso_mo", "Moneda": "currency",
    "Saldo_principal": "l.saldo_mn", "Saldo_interes": "interest_balance", "Monto_Ult_Pago_Ppal": "l.mto_ult_pago_capital",
    "Monto_Ult_Pago_Int": "last_interest", "Fecha_Aprobacion": "approved", "Fecha_Desembolso": "disbursed_day",
    "Fecha_Vencimiento": "expires", "Plazo": "term", "Fecha_primer_pago": "first_payment",
    "Fecha_ultimo_pago_ppal": "principal_day", "Fecha_ultimo_pago_int": "interest_day",
    "Fecha_ingreso_mora_ppal": "late_principal_since", "Fecha_ingreso_mora_int": "late_interest_since",
    "Frecuencia_pago_ppal": "l.frecuencia_pago", "Frecuencia_pago_int": "l.frecuencia_pago",
    "Cuotas_programadas": "l.cantidad_cuotas_pactadas", "Cuotas_pagadas": "l.cuotas_pagadas",
    "Cuotas_vencidas": "l.cantidad_cuotas_vencidas", "Modalidad": "mode", "Dias_gracia": "grace", "Tipo_tasa": "rate_kind",
    "Tasa_contractual": "contract_rate", "Tasa_vigente": "rate", "Tasa_efectiva_vigente": "yearly_rate", "Tasa_mora": "spread",
    "Tipo_garantia": "l.tipo_garantia", "Descripcion_garantia": "pledge_text", "Valor_garantia": "pledge",
    "Monto_cuota": "instalment", "Cuota_total": "instalment_fees", "Principal_corriente": "principal_open",
    "Principal_vencido": "principal_late", "Interes_Cte_Vgte": "interest_running", "Interes_Cte_Vcdo": "interest_late",
    "Interes_moratorio": "l.interes_moratorio_mn", "Fecha_prox_pago_ppal": "principal_next",
    "Fecha_prox_pago_int": "interest_next", "Dias_mora_principal": "principal_past", "Dias_mora_intereses": "interest_past",
    "Clasificacion": "class", "Clasificacion_Cliente": "client_class", "Provision": "l.provision_mn",
    "Sucursal": "l.desc_sucursal_prestamo", "Asesor_Credito": "l.analista", "Interno_FechaCorte": "cut",
    "Interno_ControlVersion": "version",
}
TYPES = {c: t for c, t, _ in RESULT_COLUMNS}
SQL_TYPES = {"int": "integer", "string": "varchar"}
TWO_STEP = ("Tasa_contractual", "Tasa_vigente", "Tasa_efectiva_vigente", "Tasa_mora")


def _typed(name: str) -> str:
    x = RESULT[name]
    x = "{" + x + "}" if x in COLUMNS else x
    t = TYPES[name]
    if t.startswith("decimal"):
        return f"cast({dec(x, '15,4')} as {t})" if name in TWO_STEP else f"cast({x} as {t})"
    return f"cast({x} as {SQL_TYPES[t]})" if t in SQL_TYPES else x


EXTRACT = over_loans({c: _typed(c) for c in RESULT}, ("solicitudes", "clientes"))
# dq_decimal_range scales the provision of every thirteenth loan out of range
SCALED = "if(l.nro_prestamo % 13 = 0, cast(l.provision_mn as decimal(38,2)) * 100000000000000, cast(l.provision_mn as decimal(38,2)))"
RAW_DECIMALS = over_loans({c: SCALED if c == "Provision" else RESULT[c] for c in RESULT if TYPES[c].startswith("decimal")},
                          ("solicitudes", "clientes", "leader"))
EXTRACT_CTE = (("extract", EXTRACT),)


def _exported(source: str) -> str:
    out = []
    for c in EXPORT_NAMES:
        if c in ("Cod_Cliente", "Num_Identificacion", "Cod_Credito", "Codigo_MUC"):
            out.append(f"'\"' || coalesce(cast({c} as varchar), '') || '\"' as {c}")
        elif c == "Tipo_garantia":
            out.append(f"if(trim(coalesce({c}, ''), ' ') = '', '', {c}) as {c}")
        elif c == "Descripcion_garantia":
            out.append(f"if(trim(coalesce({c}, ''), ' ') = '', '', replace({c}, '|', '')) as {c}")
        else:
            out.append(c)
    return f"select {', '.join(out)} from {source}"


def _counted(conditions: dict[str, str], source: str, value: str) -> str:
    """(column_name, value) with the number of rows of each condition."""
    sums = ", ".join(f"count(*) filter ({cond}) as {c}" for c, cond in conditions.items())
    return (f"select column_name, {value} from (unpivot (select {sums} from {source}) "
            f"on columns(*) into name column_name value {value})")


REASONS = " union all ".join(
    [f"select {KEY}, 'null {c}' as reason from extract where {c} is null" for c in RESULT]
    + [f"select {KEY}, 'length {c}' from extract where length({c}) > {n}" for c, n in TEXT_LIMITS.items()]
    + [f"select {KEY}, 'duplicate key' from extract qualify count(*) over (partition by {KEY}) > 1"])


def compared(sql: str, case_sensitive: bool) -> str:
    """``CODE(x)``, a coded column, and ``LIT('x')``, a code, as the source
    database compares them: no trailing blanks, case counting or not."""
    column = r"rtrim(\1)" if case_sensitive else r"lower(rtrim(\1))"
    sql = re.sub(r"CODE\(([\w.]+)\)", column, sql)
    return re.sub(r"LIT\(('[^']*')\)", lambda m: m[1] if case_sensitive else m[1].lower(), sql)


def statements(case_sensitive: bool = False) -> dict[str, str]:
    return {name: compared(sql, case_sensitive) for name, sql in _statements().items()}


def _statements() -> dict[str, str]:
    out = {name: statement(body) for name, body in LOAN_QUERIES.items()}
    # the two latest-rate queries read every disbursement row
    out["current_rate_latest_movement"] = statement(
        over_loans({"cod_credito": "number", "tasa_vigente": dec("{rate}", "15,4")}), "historia_raw")
    out["late_rate_spread_latest"] = statement(
        over_loans({"cod_credito": "number", "tasa_mora": dec("{spread}", "15,4")}), "historia_raw")
    out["params_cutoff"] = statement(f"""select saldo_jts_oid, {day('cut')} as fecha_corte, f.tipo_cambio as tc,
       version as control_version, count(*) as cuotas_vencidas
from plan_pagos cross join run left join tipo_cambio f on f.fecha = cast(cut as date)
where tz_lock = 0 and c2302 < cut group by all""")
    out["fx_asof_rate"] = statement(f"""select saldo_jts_oid, numero_cuota, {day('c2302')} as fecha,
       (select max_by(tipo_cambio, fecha) from tipo_cambio f where f.fecha <= d) as tipo_cambio
from (select saldo_jts_oid, numero_cuota, c2302, cast(c2302 as date) as d from plan_pagos)""")
    out["portfolio_extract"] = statement("select * from extract", ctes=EXTRACT_CTE)
    out["export_projection"] = statement(_exported("extract"), ctes=EXTRACT_CTE)
    out["dq_null_counts"] = statement(_counted({c: f"{c} is null" for c in RESULT}, "extract", "null_count"), ctes=EXTRACT_CTE)
    out["dq_duplicate_keys"] = statement(f"select {KEY}, count(*) as n from extract group by {KEY} having n > 1",
                                         ctes=EXTRACT_CTE)
    limits = ", ".join(f"'{c}': {n}" for c, n in TEXT_LIMITS.items())
    over = _counted({c: f"length({c}) > {n}" for c, n in TEXT_LIMITS.items()}, "extract", "over_limit")
    out["dq_length_range"] = statement(
        f"select column_name, cast(map {{{limits}}}[column_name] as integer) as max_length, over_limit from ({over})",
        ctes=EXTRACT_CTE)
    fits = {c: f"{c} is not null and try_cast({c} as {'decimal(15,4)' if c in TWO_STEP else TYPES[c]}) is null"
            for c in RESULT if TYPES[c].startswith("decimal")}
    out["dq_decimal_range"] = statement(_counted(fits, "raw", "out_of_range"), ctes=(("raw", RAW_DECIMALS),))
    out["dq_quarantine"] = statement(REASONS, ctes=EXTRACT_CTE)
    good = f"(select * from extract where {KEY} not in (select {KEY} from ({REASONS})))"
    out["publish_partition_overwrite"] = statement(_exported(good), ctes=EXTRACT_CTE)
    out["sink_table_insert"] = statement(
        f"select {KEY}, Sector, Tasa_mora, Interno_FechaCorte, Interno_ControlVersion, true as generated, "
        f"(select count(*) > 0 from extract where length(Sector) > {TEXT_LIMITS['Sector']}) as over_long_refused from {good}",
        ctes=EXTRACT_CTE)
    failed = f"{KEY} in (select {KEY} from ({REASONS}))"
    out["publish_rerun"] = statement(
        f"select {KEY}, Interno_ControlVersion as version, if({failed}, 'rejects', 'result') as shown_in "
        f"from extract where {KEY} % 2 = 0", ctes=EXTRACT_CTE)
    as_text = ", ".join(f"coalesce(cast({c} as varchar), '') as {c}" for c in EXPORT_NAMES)
    out["export_text_round_trip"] = statement(f"select {as_text} from ({_exported('extract')})", ctes=EXTRACT_CTE)
    out["generated_at_default"] = statement("select count(*) as n, count(*) as n_set, 1 as n_values from extract",
                                            ctes=EXTRACT_CTE)
    out["universe_snapshot"] = statement(
        "select jts_oid, nro_prestamo, codigo_cliente, saldo_mn, situacion_prestamo from universe")
    out["member_snapshot"] = statement("select saldo_jts_oid, cod_cliente_m, nro_prestamo from miembros")
    return out
