"""Golden micro-fixture in the portfolio's own schema (cutoff 2018-10-31).

Fourteen loans, each exercising one branch of the report; the whole batch
job runs on them (explicit-schema reads, dated snapshots, checks, partition
publish, text export) and the values are checked against hand computation.
"""

import datetime as dt
import glob
import os
import tempfile
from decimal import Decimal as D

import pytest

from kredex.plans.job import run_extract
from kredex.plans.publish import published as table, read_partition, rejected as rejected_rows
from kredex.sources.tables import INPUT_SCHEMAS

CUT = dt.datetime(2018, 10, 31)


def T(y, m, d):
    return dt.datetime(y, m, d)


def universe_row(n, **kw):
    r = dict(fecha=CUT.date(), jts_oid=n, codigo_cliente=100 + n, nro_prestamo=1000 + n,
             nombre_cliente=f"Cliente {n}", tipo_prestamo="INDIVIDUAL", tipo_persona="N",
             numero_ruc=f"R{n}", numero_documento=f"D{n}", descripcion_tipo_credito="CONSUMO",
             producto_agrupador="P", producto="PRESTAMO", sector="URBANO",
             frecuencia_pago="MENSUAL", situacion_prestamo="Vigente", codigo_estado="A",
             tipo_garantia="FIDUCIARIA", clasificacion_prestamo="A", calificacion_utilizada="A",
             desc_sucursal_prestamo="S1", analista="AN", rubro_contable=D(1301),
             importe_desembolso_mo=D("1000.00"), saldo_mn=D("500.00"), saldo_mo=D("500.00"),
             intereses_saneados_mn=D("10.00"), devengado_int_cte_mn=D("20.00"),
             mto_ult_pago_capital=D("30.00"), interes_moratorio_mn=D("0.00"),
             provision_mn=D("5.00"), tasa_interes=D("12.0000"), codigo_moneda=1,
             fecha_desembolso=T(2018, 1, 15), fecha_vencimiento=T(2019, 1, 15),
             fecha_1erpago_pactado=T(2018, 2, 15), fecha_empeso_mora_capital=T(2018, 5, 1),
             fecha_empeso_mora_interes=T(2018, 5, 2), cantidad_cuotas=12,
             cantidad_cuotas_pactadas=12, cuotas_pagadas=9, cantidad_cuotas_vencidas=0)
    r.update(kw)
    return r


def saldo_row(n, **kw):
    r = dict(jts_oid=n, moneda=1, c1620=T(2018, 1, 15), c1677="F", c1632=D("12.0000"),
             c1633=D("15.0000"), c1604=D("0.00"), c1704=5000 + n, c1803=100 + n, c9314=5,
             cuenta=None, tz_lock=0)
    r.update(kw)
    return r


def sched(n, due, cap, intr, cap_out, int_out, lock=0, cuota=1):
    return dict(saldo_jts_oid=n, numero_cuota=cuota, c2302=due, c2304=D(cap), c2305=D(intr),
                c2309=D(cap_out), c2310=D(int_out), tz_lock=lock)


def hist(n, kind, day, rate="0", late="0", cap="0", intr="0", mov=0, lock=0):
    return dict(saldos_jts_oid=n, tipomov=kind, fechavalor=day, interespagado=D(intr),
                capitalpagado=D(cap), tasainteres=D(rate), tasamora=D(late), movimiento=mov,
                tz_lock=lock)


def fixture_tables(saneado_12=False):
    u = [universe_row(n) for n in range(1, 16)]
    s = [saldo_row(n) for n in range(1, 16)]
    # 1, 2, 13: one client; 2 in currency 2; 13 locked but counted
    for n in (1, 2, 13):
        u[n - 1]["codigo_cliente"] = 201
        s[n - 1]["c1803"] = 201
    u[1].update(codigo_moneda=2, saldo_mo=D("100.00"), cantidad_cuotas_vencidas=2)
    s[1]["moneda"] = 2
    u[12]["saldo_mn"] = D("1000.00")
    s[12]["tz_lock"] = 1
    # 3: legal person, rate history state C
    u[2].update(tipo_persona="J", codigo_estado="C")
    # 4: written off
    u[3].update(situacion_prestamo="Saneado", intereses_saneados_mn=D("77.00"))
    # 5, 6: group loans with / without coordinator
    u[4]["tipo_prestamo"] = "GRUPO SOLIDARIO"
    u[5]["tipo_prestamo"] = "GRUPO SOLIDARIO"
    # 7: all remaining instalments overdue
    u[6]["cantidad_cuotas_vencidas"] = 3
    # 10: nothing outstanding, unknown grade
    u[9]["clasificacion_prestamo"] = "Z"
    # 11: placeholder arrears date, blank modality
    u[10]["fecha_empeso_mora_capital"] = T(1900, 1, 1)
    s[10]["c1677"] = " "
    # 15: a rate whose effective annual rate overflows decimal(15,4)
    u[14]["tasa_interes"] = D("9999.0000")
    # 12: two disbursement rows
    if saneado_12:
        u[11]["situacion_prestamo"] = "Saneado"
    # an older snapshot that the cutoff must not read
    u.append(universe_row(1, fecha=dt.date(2018, 9, 30), nombre_cliente="OLD"))

    # collateral balance rows live in the balance table (kind 1)
    for g in (91, 92, 93, 94):
        s.append(saldo_row(900 + g, c9314=1, cuenta=g, c1604=D("-100.00")))

    plan = [
        sched(1, T(2018, 10, 15), "100", "12", "0", "0"),
        sched(1, T(2018, 11, 15), "100", "10", "100", "10"),
        sched(1, T(2018, 12, 15), "100", "8", "100", "8"),
        sched(2, T(2018, 8, 31), "100", "5", "100", "5"),
        sched(2, T(2018, 9, 30), "100", "5", "100", "5"),
        sched(2, T(2018, 7, 31), "999", "9", "999", "9", lock=1),
        sched(7, T(2018, 9, 15), "50", "5", "50", "5"),
        sched(7, T(2018, 10, 15), "60", "6", "60", "6"),
        sched(7, T(2018, 10, 31), "70", "7", "70", "7"),
        sched(8, T(2018, 11, 15), "100", "10", "100", "10"),
        sched(10, T(2018, 5, 15), "100", "10", "0", "0"),
    ] + [sched(n, T(2018, 11, 30), "100", "10", "100", "10") for n in (3, 4, 5, 6, 9, 11, 12, 13, 14, 15)]
    history = [
        hist(3, "A", T(2018, 1, 15), rate="10", late="13", mov=1),
        hist(3, "S", T(2018, 5, 1), rate="11", late="15", mov=2),
        hist(3, "S", T(2018, 7, 1), rate="0", late="2", mov=3),
        hist(4, "A", T(2018, 1, 15), rate="24", late="30", mov=4),
        hist(12, "A", T(2018, 1, 15), rate="20", mov=5),
        hist(12, "I", T(2018, 2, 15), rate="21", mov=6),
        hist(14, "P", T(2018, 9, 1), intr="20", mov=7),
        hist(14, "P", T(2018, 10, 1), intr="5", mov=8),
        hist(14, "P", T(2018, 10, 1), intr="7", cap="50", mov=9),
        hist(14, "P", T(2018, 10, 5), intr="99", mov=10, lock=1),
    ]
    original = [
        dict(saldos_jts_oid=8, numero_cuota=1, capital=D("0"), intereses=D("10"),
             fecha_vencimiento=T(2018, 2, 15), tz_lock=0),
        dict(saldos_jts_oid=8, numero_cuota=2, capital=D("100"), intereses=D("9"),
             fecha_vencimiento=T(2018, 3, 15), tz_lock=0),
        dict(saldos_jts_oid=8, numero_cuota=3, capital=D("100"), intereses=D("8"),
             fecha_vencimiento=T(2018, 4, 15), tz_lock=0),
    ]
    return {
        "parametros": [dict(fechaproceso=CUT)],
        "maestro": [dict(id_maestrounico="1-0-0", estado=1), dict(id_maestrounico="0-9", estado=0)],
        "universe": u,
        "saldos": s,
        "miembros": [dict(fecha=CUT.date(), saldo_jts_oid=5, cod_cliente_m=301, nro_prestamo=1005)],
        "solicitudes": [dict(c5000=5000 + n, c5231=T(2018, 1, 10)) for n in range(1, 16)],
        "clientes": [dict(c0902=c) for c in list(range(101, 116)) + [201]],
        "monedas": [dict(c6399=1, c6400="CORDOBA"), dict(c6399=2, c6400="DOLAR")],
        "historia": history,
        "plan_pagos": plan,
        "plan_pagos_original": original,
        "gastos": [dict(saldos_jts_oid=8, numero_cuota=1, importe_gastos=D("3.50")),
                   dict(saldos_jts_oid=8, numero_cuota=1, importe_gastos=D("1.50")),
                   dict(saldos_jts_oid=8, numero_cuota=2, importe_gastos=D("9.99"))],
        "relacion_garantia": [dict(nrosolicitud=5009, nrogarantia=g, tz_lock=0) for g in (91, 92, 93, 94)],
        "garantias": [dict(nrogarantia=g, gar_moneda=g - 90, gar_fecha=T(2018, 3, 1),
                           descripcion=f"G{g}", tz_lock=0) for g in (91, 92, 93, 94)],
        "relacion_grupo": [dict(c3198=105, c3199=301, c3201="S", c3210="AC", tz_lock=0)],
        "persona_documento": [dict(idpersona=301, nrodocumento="DOC301", tipodoc="CED",
                                   estado="A", principal="S")],
        "devengamiento": [
            dict(saldo_jts_oid=1, fecha=CUT, interes_deveng_vigente_cont=D("3.00"),
                 interes_deveng_vencido_cont=None, mora_tasa_int_deveng_venc_cont=D("1.00"),
                 mora_tasa_int_deveng_vige_cont=D("2.00")),
            dict(saldo_jts_oid=2, fecha=CUT, interes_deveng_vigente_cont=D("1.00"),
                 interes_deveng_vencido_cont=D("1.00"), mora_tasa_int_deveng_venc_cont=None,
                 mora_tasa_int_deveng_vige_cont=None),
            # 12: two accrual rows at the cutoff: the lookup fans out
            dict(saldo_jts_oid=12, fecha=CUT, interes_deveng_vigente_cont=D("1.00"),
                 interes_deveng_vencido_cont=None, mora_tasa_int_deveng_venc_cont=None,
                 mora_tasa_int_deveng_vige_cont=None),
            dict(saldo_jts_oid=12, fecha=CUT, interes_deveng_vigente_cont=D("2.00"),
                 interes_deveng_vencido_cont=None, mora_tasa_int_deveng_venc_cont=None,
                 mora_tasa_int_deveng_vige_cont=None),
            dict(saldo_jts_oid=1, fecha=T(2018, 9, 30), interes_deveng_vigente_cont=D("50.00"),
                 interes_deveng_vencido_cont=None, mora_tasa_int_deveng_venc_cont=None,
                 mora_tasa_int_deveng_vige_cont=None),
        ],
        "tipo_cambio": [dict(fecha=dt.date(2018, 3, 1), tipo_cambio=D("30.0000")),
                        dict(fecha=CUT.date(), tipo_cambio=D("32.1234"))],
        "garantia_texto": [dict(nro_prestamo=1009, orden=2, descripcion="AUTO"),
                           dict(nro_prestamo=1009, orden=1, descripcion="CASA"),
                           dict(nro_prestamo=1011, orden=1, descripcion="LOTE|A")],
    }


def write_fixture(spark, root, **kw):
    for name, rows in fixture_tables(**kw).items():
        schema = INPUT_SCHEMAS[name]
        cols = [c.split()[0] for c in schema.split(", ")]
        data = [tuple(r.get(c) for c in cols) for r in rows]
        df = spark.createDataFrame(data, schema)
        w = df.write.mode("overwrite")
        if name in ("universe", "miembros", "devengamiento"):
            w = w.partitionBy("fecha")
        w.parquet(f"{root}/{name}")


@pytest.fixture(scope="module")
def published(spark):
    work = tempfile.mkdtemp(prefix="kredex-fixture-")
    root = f"{work}/src"
    write_fixture(spark, root)
    out, rej, exp = f"{work}/result", f"{work}/rejects", f"{work}/export"
    p = run_extract(spark, root, out, policy="quarantine", reject_path=rej, export_path=exp)
    rows = {int(r["Cod_Credito"]) - 1000: r.asDict()
            for r in read_partition(spark, out, p.cutoff, p.version).collect()}
    rejected = {int(r["Cod_Credito"]) - 1000: r["reasons"]
                for r in rejected_rows(spark, out).collect()}
    return dict(p=p, rows=rows, rejected=rejected, export=exp, root=root, work=work)


def test_params(published):
    p = published["p"]
    assert p.cutoff == CUT and p.version == "1-0-0" and p.tc == D("32.1234")


def test_locked_loan_absent_and_group_without_coordinator_rejected(published):
    got = set(published["rows"]) | set(published["rejected"])
    assert got == set(range(1, 16)) - {13}
    assert 6 in published["rejected"]
    assert "null Num_Identificacion" in published["rejected"][6]


def test_client_totals_count_locked_loan(published):
    r = published["rows"][1]
    assert r["No_Creditos"] == 3
    assert r["Deuda_total"] == D("500.00") + D("3212.34") + D("1000.00")


def test_current_loan(published):
    r = published["rows"][1]
    assert r["Principal_corriente"] == D("200.00") and r["Principal_vencido"] == D("0.00")
    assert (r["Dias_mora_principal"], r["Dias_mora_intereses"]) == (0, 0)
    assert r["Fecha_prox_pago_ppal"] == "15/11/2018"
    assert r["Monto_cuota"] == D("110.00") and r["Plazo"] == 334
    assert r["Interes_Cte_Vgte"] == D("3.00") and r["Interes_Cte_Vcdo"] == D("3.00")
    assert r["Nombre_Cliente"] == "Cliente 1" and r["Moneda"] == "CORDOBA"
    assert r["Fecha_Aprobacion"] == "10/01/2018" and r["Fuente_Fin"] == "Fondos Propios"


def test_foreign_currency_overdue(published):
    r = published["rows"][2]
    assert r["Principal_vencido"] == D("6424.68")
    assert (r["Dias_mora_principal"], r["Dias_mora_intereses"]) == (61, 61)
    assert r["Monto_cuota"] == D("105.00")
    assert r["Interes_Cte_Vgte"] == D("32.12") and r["Interes_Cte_Vcdo"] == D("32.12")


def test_rate_history(published):
    r = published["rows"][3]
    assert r["Tasa_vigente"] == D("11.00")     # the later 'S' row has rate 0
    assert r["Tasa_mora"] == D("2.00")         # its spread is positive
    assert r["Tasa_contractual"] == D("12.00")
    assert (r["Num_Identificacion"], r["Tipo_persona"]) == ("R3", "Juridica")


def test_written_off(published):
    r = published["rows"][4]
    assert r["Saldo_interes"] == D("77.00") and r["Interes_Cte_Vcdo"] == D("77.00")
    assert r["Tasa_contractual"] == D("24.00")
    assert r["Tasa_efectiva_vigente"] == D("26.82")
    assert r["Clasificacion_Cliente"] == 5


def test_group_coordinator(published):
    r = published["rows"][5]
    assert (r["Num_Identificacion"], r["Tipo_persona"]) == ("DOC301", "Natural")


def test_all_overdue_takes_latest_pending(published):
    r = published["rows"][7]
    assert r["Monto_cuota"] == D("77.00")
    assert r["Principal_corriente"] == D("70.00") and r["Principal_vencido"] == D("110.00")
    assert r["Dias_mora_principal"] == 46


def test_grace_and_fees(published):
    r = published["rows"][8]
    assert r["Dias_gracia"] == 59
    assert r["Monto_cuota"] == D("110.00") and r["Cuota_total"] == D("115.00")


def test_collateral(published):
    r = published["rejected"].get(9) or published["rows"].get(9)
    rows = published["rows"]
    assert 9 in rows, published["rejected"].get(9)
    assert rows[9]["Valor_garantia"] == D("6312.34")
    assert rows[9]["Descripcion_garantia"] == "CASA; AUTO"


def test_nothing_outstanding(published):
    assert 10 in published["rejected"]          # no instalment: NULL Monto_cuota
    assert "null Monto_cuota" in published["rejected"][10]


def test_placeholder_date_and_blank_modality(published):
    r = published["rows"][11]
    assert r["Fecha_ingreso_mora_ppal"] == "" and r["Modalidad"] == "Al Vencimiento"


def test_two_disbursements_fine_when_not_read(published):
    assert 12 in published["rows"] or 12 in published["rejected"]


def test_fanned_out_lookup_rejected_as_duplicate_key(published):
    # two accrual rows at the cutoff give loan 12 two result rows (as the
    # reference's lateral lookup would); the unique-key check rejects both
    assert 12 not in published["rows"]
    assert "duplicate key" in published["rejected"][12]


def test_interest_on_last_payment_date(published):
    r = published["rows"][14]
    assert r["Monto_Ult_Pago_Int"] == D("12.00")
    assert r["Fecha_ultimo_pago_int"] == "01/10/2018"
    assert r["Fecha_ultimo_pago_ppal"] == "01/10/2018"


def test_export_text(published, spark):
    files = glob.glob(os.path.join(published["export"], "part-*"))
    text = "".join(open(f).read() for f in files)
    lines = [l for l in text.splitlines() if l]
    header = open(glob.glob(published["export"] + ".header/part-*")[0]).read().splitlines()
    assert len(header) == 1 and len(header[0].split("|")) == 58
    body = lines
    assert not any(l.startswith("Cod_Cliente|") for l in body)
    assert len(body) == len(published["rows"])
    assert any(l.startswith('"111"|') and "|LOTEA|" in l for l in body)


def test_decimal_out_of_range_is_rejected(published):
    assert "range Tasa_efectiva_vigente" in published["rejected"][15]


def test_strict_policy_keeps_old_partition(spark, published):
    out = f"{published['work']}/strict"
    # strict: the NULL coordinator id fails the checks, and the overflowing
    # rate fails its cast, as the reference's insert would
    with pytest.raises(Exception):
        run_extract(spark, published["root"], out, policy="strict")
    assert not os.path.exists(out) or not glob.glob(f"{out}/**/*.parquet", recursive=True)


def test_written_off_with_two_disbursements_fails(spark):
    work = tempfile.mkdtemp(prefix="kredex-fixture-")
    write_fixture(spark, f"{work}/src", saneado_12=True)
    with pytest.raises(Exception, match="more than 1 value"):
        run_extract(spark, f"{work}/src", f"{work}/out", policy="quarantine", reject_path=f"{work}/rej")


def _small(spark, run, keys):
    """Result-like rows: odd keys pass, even keys have a NULL."""
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(k, None if k % 2 == 0 else "x") for k in keys], "Cod_Credito int, Sector string")
    return (rows.withColumn("Cod_Credito", F.col("Cod_Credito").cast("decimal(15,0)"))
            .withColumn("Interno_FechaCorte", run.cutoff_col).withColumn("Interno_ControlVersion", run.version_col))


def test_rerun_replaces_its_partition_even_by_nothing(spark, published):
    from dataclasses import replace

    from kredex.plans.publish import publish
    run = published["p"]
    other = replace(run, version="other")
    out, rej = f"{published['work']}/rerun", f"{published['work']}/rerun-rejects"

    def go(r, keys):
        publish(_small(spark, r, keys), out, r, policy="quarantine", reject_path=rej)

    def shown():
        return [sorted((str(x.Interno_ControlVersion), int(x.Cod_Credito)) for x in rows.collect())
                for rows in (table(spark, out), rejected_rows(spark, out))]

    v = run.version
    go(other, range(100, 104))
    rest = [[("other", 101), ("other", 103)], [("other", 100), ("other", 102)]]
    go(run, range(8))
    assert shown() == [sorted([(v, 1), (v, 3), (v, 5), (v, 7)] + rest[0]), sorted([(v, 0), (v, 2), (v, 4), (v, 6)] + rest[1])]
    go(run, [1, 3])                      # no rejects any more
    assert shown() == [sorted([(v, 1), (v, 3)] + rest[0]), rest[1]]
    go(run, [2, 4])                      # only rejects
    assert shown() == [rest[0], sorted([(v, 2), (v, 4)] + rest[1])]
    go(run, [])
    assert shown() == rest


def test_quarantine_needs_a_reject_path(spark, published):
    from kredex.plans.job import main
    from kredex.plans.publish import publish
    run = published["p"]
    with pytest.raises(ValueError, match="rejected rows"):
        publish(_small(spark, run, [1, 2]), f"{published['work']}/none", run, policy="quarantine")
    with pytest.raises(SystemExit):
        main(["--root", "x", "--out", "y", "--policy", "quarantine"])


def test_strict_error_counts_every_reason(spark, published):
    from kredex.operators.quality import QualityError
    from kredex.plans.publish import publish
    run = published["p"]
    with pytest.raises(QualityError, match="null Sector: 30"):
        publish(_small(spark, run, range(60)), f"{published['work']}/strict2", run)


def test_rejected_decimals_keep_their_raw_value(published, spark):
    rows = rejected_rows(spark, f"{published['work']}/result").where("size(raw_values) > 0").collect()
    assert any(v.startswith("Tasa_efectiva_vigente=") and float(v.split("=")[1]) > 1e11 for r in rows for v in r["raw_values"])


def test_shared_folder_setting_is_respected(spark, monkeypatch):
    from kredex import session
    assert session.shared_folder(spark)

    class Away:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})
        sparkContext = type("S", (), {
            "getConf": staticmethod(lambda: Away.conf), "master": "spark://host:7077",
            "_jsc": type("J", (), {"sc": staticmethod(lambda: type("X", (), {"getCheckpointDir": staticmethod(
                lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))}))})})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Away)


def test_command_line_job(spark, capsys):
    from kredex.plans.job import main
    work = tempfile.mkdtemp(prefix="kredex-cli-")
    write_fixture(spark, f"{work}/src")
    main(["--root", f"{work}/src", "--out", f"{work}/out", "--policy", "quarantine",
          "--rejects", f"{work}/rej", "--export", f"{work}/exp", "--tc", "32.1234"])
    assert "published cutoff 2018-10-31 version 1-0-0" in capsys.readouterr().out
    assert glob.glob(f"{work}/out/runs/*/*.parquet") and glob.glob(f"{work}/rej/runs/*/*.parquet")
    assert read_partition(spark, f"{work}/out", CUT, "1-0-0").count() > 0
    assert glob.glob(f"{work}/exp/part-*")
