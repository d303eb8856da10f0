"""L: totals, alerts and reconciliation."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.functions.shape import ratio
from retail_analytics.operators import clients as cl, demand as dm, totals as tt
from retail_analytics.plans import g_clients as g, h_demand as h
from retail_analytics.plans.registry import query

SUM = "t AS (SELECT sucursal, sum(cantidades_total) bultos, sum(subtotal_neto) neto, count(DISTINCT id_cliente) clientes FROM l WHERE fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-30' GROUP BY 1), r AS (SELECT *, neto/bultos precio_medio FROM t)"


@query("l1_total_row", f="bultos neto precio_medio", i="clientes", sql=SUM + " SELECT * FROM r UNION ALL SELECT 'TOTAL GENERAL', sum(bultos), sum(neto), NULL, sum(neto)/sum(bultos) FROM r")
def _(s):
    t = s.lineas.filter("fecha_comprobante between '2001-06-01' and '2001-06-30'").groupBy("sucursal").agg(
        F.sum("cantidades_total").alias("bultos"), F.sum("subtotal_neto").alias("neto"), F.count_distinct("id_cliente").alias("clientes"))
    t = t.withColumn("precio_medio", ratio("neto", "bultos"))
    return tt.total_row(t, "sucursal", ["bultos", "neto"], {"precio_medio": ratio(F.sum("neto"), F.sum("bultos"))})


@query("l2_alerts", f="monto", i="orden", sql=g.CHU + ", " + h.SPC2.replace(h.INV + ", ", h.INV + ", ", 1) + """ SELECT 'alta' severidad, 'Cliente recuperable de alto valor' titulo, cliente||': '||recencia_dias||' dias sin comprar' detalle, neto_12m monto, 2 orden FROM cz WHERE estado='Recuperable' AND accionable AND neto_12m>200000
UNION ALL SELECT 'critica','Sucursal cerrada con clientes perdidos', sucursal||': '||count(*)||' clientes', sum(neto_12m), 1 FROM cz WHERE sucursal_cerrada AND estado='Perdido' GROUP BY sucursal
UNION ALL SELECT 'media','Quiebre simultaneo en varias sucursales', strftime(fecha,'%Y-%m-%d')||': '||count(DISTINCT sucursal)||' sucursales', sum(bultos), 3 FROM bq GROUP BY fecha HAVING count(DISTINCT sucursal)>=2""")
def _(s):
    c = g.churn(s)
    ev = dm.company_events(dm.anomalies(h.days(s), sigmas=2.0)[0], 2)
    lost = c.filter("sucursal_cerrada and estado = 'Perdido'").groupBy("sucursal").agg(F.count(F.lit(1)).alias("n"), F.sum("neto_12m").alias("neto"))
    return tt.alerts([
        tt.alert(c, (F.col("estado") == "Recuperable") & F.col("accionable") & (F.col("neto_12m") > 200000), "alta", "Cliente recuperable de alto valor",
                 F.concat("cliente", F.lit(": "), "recencia_dias", F.lit(" dias sin comprar")), F.col("neto_12m")),
        tt.alert(lost, F.lit(True), "critica", "Sucursal cerrada con clientes perdidos", F.concat("sucursal", F.lit(": "), "n", F.lit(" clientes")), F.col("neto")),
        tt.alert(ev, F.lit(True), "media", "Quiebre simultaneo en varias sucursales",
                 F.concat(F.date_format("fecha", "yyyy-MM-dd"), F.lit(": "), "sucursales_en_alerta", F.lit(" sucursales")), F.col("bultos"))])


@query("l3_reconciliation", f="medida_a medida_b brecha pct_brecha", sql=g.BRI + """, a AS (SELECT sum(htls_actual) medida_a FROM br), b AS (SELECT sum(cantidad_total_htls) medida_b FROM ln WHERE id_documento='FCVTA' AND fecha_comprobante BETWEEN '2000-07-01' AND '2001-06-30')
SELECT *, medida_b-medida_a brecha, abs(medida_b-medida_a)/medida_a pct_brecha FROM a CROSS JOIN b""")
def _(s):
    bridge = cl.bridge_base(g.lines(s), g.A12, g.PREV, g.CUT)
    series = h.series(s).filter("mes >= '2000-07-01'")
    return tt.reconcile(bridge, series, "htls_actual", "hectolitros")
