"""G: client base."""
from __future__ import annotations

from retail_analytics.functions.grid import shared
from retail_analytics.operators import clients as cl, cohorts, filters as fl
from retail_analytics.plans.registry import query

A12, A24, PREV, CUT = "2000-06-28", "1999-06-28", "1999-06-27", "2001-06-30"
COUNTERS = [10, 20, 30]
NON = ["LARGE"]
# analytics universe: invoices and returns, not voided, merchandise or unknown category
LN = "ln AS (SELECT * FROM l WHERE id_documento IN ('FCVTA','DVVTA') AND NOT anulado AND (generico IS NULL OR generico NOT IN ('LARGE')))"
RFM = LN + f""", rb AS (SELECT id_cliente, date_diff('day', max(fecha_comprobante) FILTER (id_documento='FCVTA'), DATE '{CUT}') recencia_dias,
 count(DISTINCT CASE WHEN id_documento='FCVTA' THEN (id_documento,letra,serie,nro_doc,id_sucursal) END) frecuencia, count(DISTINCT CASE WHEN id_documento='FCVTA' THEN fecha_comprobante END) dias_compra,
 count(DISTINCT CASE WHEN id_documento='FCVTA' THEN date_trunc('month',fecha_comprobante) END) meses_activos, sum(subtotal_neto) monetario_neto, sum(facturacion_neta) monetario_bruto, sum(descuentos) descuento, sum(cantidad_total_htls) htls, sum(cantidades_total) bultos
 FROM ln WHERE fecha_comprobante>'{A12}' AND fecha_comprobante<='{CUT}' GROUP BY 1 HAVING max(fecha_comprobante) FILTER (id_documento='FCVTA') IS NOT NULL)"""
FB = "monetario_neto monetario_bruto descuento htls bultos"
NAMES = """, nm AS (SELECT c.id_cliente, coalesce(nullif(trim(fantasia),''),razon_social,'SIN NOMBRE') cliente, coalesce(descripcion,'SIN SUCURSAL') sucursal, coalesce(des_canal_mkt,'SIN CANAL') canal,
 coalesce(des_subcanal_mkt,'SIN SUBCANAL') subcanal, coalesce(localidad,'SIN LOCALIDAD') localidad, coalesce(des_personal_fv1,'SIN ASIGNAR') preventista FROM cli c LEFT JOIN suc USING (id_sucursal))"""


def lines(s):
    return fl.working_lines(s.lineas, NON, keep_null_category=True)


def rfm(s):
    return cl.rfm_base(lines(s), A12, CUT)


@query("g1_rfm_base", f=FB, sql=RFM + NAMES + " SELECT rb.*, cliente, sucursal, canal, subcanal, localidad, preventista FROM rb LEFT JOIN nm USING (id_cliente)")
def _(s):
    return cl.with_names(rfm(s), s.cliente, s.sucursal)


def score(col: str, asc: bool) -> str:
    o = "" if asc else " DESC"
    return f"greatest(least(ceil((rank() OVER (ORDER BY {col}{o})+(count(*) OVER (PARTITION BY {col})-1)/2.0::DOUBLE)/count(*) OVER ()*5),5),1)::BIGINT"


SEG = " ".join(f"WHEN score_r BETWEEN {a} AND {b} AND score_f BETWEEN {c} AND {d} THEN '{lab}'" for a, b, c, d, lab in cl.SEGMENTS)
SCORED = RFM + f""", sc AS (SELECT *, {score('recencia_dias', False)} score_r, {score('frecuencia', True)} score_f, {score('monetario_neto', True)} score_m FROM rb),
sg AS (SELECT *, score_r||''||score_f||''||score_m celda_rfm, CASE {SEG} ELSE 'Sin clasificar' END segmento, id_cliente IN (10,20,30) es_mostrador FROM sc)"""


def scored(s):
    return cl.rfm_score(rfm(s), COUNTERS)


@query("g2_rfm_segments", f=FB, sql=SCORED + " SELECT * FROM sg")
def _(s):
    return scored(s)


@query("g3_rfm_summary", f="neto bruto descuento recencia_mediana frecuencia_mediana pct_clientes pct_neto ticket_medio", sql=SCORED + """, b AS (SELECT * FROM sg UNION ALL SELECT * REPLACE ('TOTAL GENERAL' AS segmento) FROM sg)
SELECT segmento, count(*) clientes, sum(monetario_neto) neto, sum(monetario_bruto) bruto, sum(descuento) descuento, median(recencia_dias) recencia_mediana, median(frecuencia) frecuencia_mediana,
count(*)/(SELECT count(*) FROM sg) pct_clientes, sum(monetario_neto)/(SELECT sum(monetario_neto) FROM sg) pct_neto, sum(monetario_neto)/count(*) ticket_medio FROM b GROUP BY 1""")
def _(s):
    return cl.rfm_summary(scored(s))


RHY = LN + f""", dy AS (SELECT DISTINCT id_cliente, fecha_comprobante f FROM ln WHERE id_documento='FCVTA' AND fecha_comprobante>'{A24}' AND fecha_comprobante<='{CUT}'),
gp AS (SELECT id_cliente, f, date_diff('day', lag(f) OVER (PARTITION BY id_cliente ORDER BY f), f)::DOUBLE gap FROM dy),
pf AS (SELECT id_cliente, count(*) dias_compra_24m, avg(gap) gap_medio, stddev_samp(gap) gap_desvio, quantile_cont(gap,0.5) gap_p50, quantile_cont(gap,0.9) gap_p90, max(gap) gap_max, date_diff('day',max(f),DATE '{CUT}') recencia_dias FROM gp GROUP BY 1 HAVING count(*)>=4),
n12 AS (SELECT id_cliente, sum(subtotal_neto) neto_12m FROM ln WHERE fecha_comprobante>'{A12}' AND fecha_comprobante<='{CUT}' GROUP BY 1),
rh AS (SELECT pf.*, coalesce(neto_12m,0) neto_12m FROM pf LEFT JOIN n12 USING (id_cliente))"""
FR = "gap_medio gap_desvio gap_p50 gap_p90 gap_max neto_12m"


def rhythm(s):
    return cl.rhythm(lines(s), A12, A24, CUT)


@query("g4_purchase_rhythm", f=FR, sql=RHY + " SELECT * FROM rh")
def _(s):
    return rhythm(s)


CHU = RHY + NAMES + """, c0 AS (SELECT rh.*, cliente, sucursal, canal, subcanal, localidad, preventista FROM rh LEFT JOIN nm USING (id_cliente)),
ch AS (SELECT *, recencia_dias-gap_p90 exceso_dias, CASE WHEN gap_p90>0 THEN recencia_dias/gap_p90 END ratio, CASE WHEN gap_medio>0 THEN coalesce(gap_desvio,0)/gap_medio END cv_ritmo,
 CASE WHEN gap_p90 IS NULL OR gap_p90<=0 THEN 'Sin ritmo medible' WHEN recencia_dias<=gap_p90 THEN 'Al dia' WHEN recencia_dias/gap_p90<=3 THEN 'Recuperable' ELSE 'Perdido' END estado, sucursal IN ('NATION_9') sucursal_cerrada, id_cliente IN (10,20,30) es_mostrador FROM c0),
cz AS (SELECT *, NOT sucursal_cerrada AND NOT es_mostrador accionable, CASE WHEN NOT sucursal_cerrada AND NOT es_mostrador AND estado IN ('Recuperable','Perdido') THEN 0 ELSE 1 END::BIGINT orden FROM ch)"""


def churn(s):
    return cl.churn(cl.with_names(rhythm(s), s.cliente, s.sucursal), ["NATION_9"], COUNTERS)


@query("g5_churn", f=FR + " exceso_dias ratio cv_ritmo", i="orden", sql=CHU + " SELECT * FROM cz")
def _(s):
    return churn(s)


@query("g5_churn_total", f="neto_12m gap_p90_mediano recencia_mediana", i="dias_compra_24m", sql=CHU + """ SELECT count(*) clientes, sum(neto_12m) neto_12m, sum(dias_compra_24m) dias_compra_24m, count(*) FILTER (estado<>'Al dia') atrasados,
median(gap_p90) gap_p90_mediano, median(recencia_dias) recencia_mediana FROM cz""")
def _(s):
    return cl.churn_total(churn(s))


COH = LN + f""", ac AS (SELECT id_cliente, date_trunc('month',fecha_comprobante)::DATE mes, sum(subtotal_neto) neto FROM ln WHERE id_documento='FCVTA' AND fecha_comprobante<='{CUT}' GROUP BY 1,2),
co AS (SELECT *, min(mes) OVER (PARTITION BY id_cliente) mes_cohorte FROM ac), ed AS (SELECT mes_cohorte, date_diff('month',mes_cohorte,mes) mes_n, count(DISTINCT id_cliente) clientes, sum(neto) neto FROM co WHERE mes_cohorte>='1995-06-01' GROUP BY 1,2)"""


def edges(s):
    return cl.cohort_edges(lines(s), CUT, "1995-06-01")


@query("g6_cohort_edges", f="neto", sql=COH + " SELECT * FROM ed")
def _(s):
    return edges(s)


@query("g7_retention", f="retencion", i="clientes tamano", sql=COH + f""", sz AS (SELECT mes_cohorte, clientes tamano FROM ed WHERE mes_n=0),
gr AS (SELECT mes_cohorte, tamano, unnest(generate_series(0, least(date_diff('month',mes_cohorte,DATE '2001-06-01'),(SELECT max(mes_n) FROM ed)))) mes_n FROM sz),
g AS (SELECT gr.mes_cohorte, gr.mes_n, tamano, coalesce(clientes,0) clientes FROM gr LEFT JOIN ed USING (mes_cohorte, mes_n))
SELECT 'cohorte' nivel, mes_cohorte, mes_n, sum(clientes) clientes, sum(tamano) tamano, sum(clientes)/sum(tamano) retencion FROM g GROUP BY 2,3 UNION ALL SELECT 'promedio', NULL, mes_n, sum(clientes), sum(tamano), sum(clientes)/sum(tamano) FROM g GROUP BY 3""")
def _(s):
    return cl.retention(shared(cohorts.retention_counts(lines(s), CUT, "1995-06-01")), CUT)


BRI = LN + f""", bb AS (SELECT id_cliente, {', '.join(f"coalesce(sum({c}) FILTER (fecha_comprobante>'{A12}'),0) {n}_actual, coalesce(sum({c}) FILTER (fecha_comprobante>'{PREV}' AND fecha_comprobante<='{A12}'),0) {n}_previo" for n, c in (('neto', 'subtotal_neto'), ('bruto', 'facturacion_neta'), ('htls', 'cantidad_total_htls')))},
 count(*) FILTER (fecha_comprobante<='{PREV}') lineas_historicas FROM ln WHERE fecha_comprobante<='{CUT}' GROUP BY 1), br AS (SELECT * FROM bb WHERE neto_actual<>0 OR neto_previo<>0 OR htls_actual<>0 OR htls_previo<>0)"""


@query("g8_bridge_base", f="neto_actual neto_previo bruto_actual bruto_previo htls_actual htls_previo", sql=BRI + " SELECT * FROM br")
def _(s):
    return cl.bridge_base(lines(s), A12, PREV, CUT)


@query("g9_growth_bridge", f="htls_previo htls_actual neto_previo neto_actual delta_htls delta_neto pct_delta_htls pct_delta_neto", sql=BRI + """, m AS (SELECT *, CASE WHEN NOT (neto_previo<>0 OR htls_previo<>0) AND (neto_actual<>0 OR htls_actual<>0) THEN CASE WHEN lineas_historicas=0 THEN 'Nuevos' ELSE 'Reactivados' END
 WHEN NOT (neto_actual<>0 OR htls_actual<>0) THEN 'Perdidos' WHEN CASE WHEN htls_actual<>htls_previo THEN htls_actual-htls_previo ELSE neto_actual-neto_previo END>0 THEN 'Upsell' ELSE 'Downsell' END movimiento FROM br),
b AS (SELECT * FROM m UNION ALL SELECT * REPLACE ('TOTAL GENERAL' AS movimiento) FROM m), t AS (SELECT movimiento, count(*) clientes, sum(htls_previo) htls_previo, sum(htls_actual) htls_actual, sum(neto_previo) neto_previo, sum(neto_actual) neto_actual FROM b GROUP BY 1),
d AS (SELECT *, htls_actual-htls_previo delta_htls, neto_actual-neto_previo delta_neto FROM t) SELECT d.*, delta_htls/(SELECT delta_htls FROM d WHERE movimiento='TOTAL GENERAL') pct_delta_htls, delta_neto/(SELECT delta_neto FROM d WHERE movimiento='TOTAL GENERAL') pct_delta_neto FROM d""")
def _(s):
    return cl.bridge(cl.bridge_base(lines(s), A12, PREV, CUT))


ART = LN + f""", ab AS (SELECT id_articulo, coalesce(des_articulo,'SIN DESCRIPCION') articulo, coalesce(generico,'SIN GENERICO') generico, coalesce(marca,'SIN MARCA') marca, coalesce(proveedor,'SIN PROVEEDOR') proveedor, sum(subtotal_neto) neto, sum(facturacion_neta) bruto,
 sum(descuentos) descuento, sum(cantidad_total_htls) htls, sum(cantidades_total) bultos, count(DISTINCT id_cliente) clientes FROM ln WHERE fecha_comprobante>'{A12}' AND fecha_comprobante<='{CUT}' GROUP BY ALL)"""


def articles(s):
    return cl.article_base(lines(s), A12, CUT)


@query("g10_article_base", f="neto bruto descuento htls bultos", sql=ART + " SELECT * FROM ab")
def _(s):
    return articles(s)


@query("g10_top_articles", f="neto pct_neto pct_acumulado bruto htls", sql=ART + """, t AS (SELECT id_articulo, articulo, neto, neto/sum(neto) OVER () pct_neto, bruto, htls, clientes n, row_number() OVER (ORDER BY round(neto,6) DESC, id_articulo) puesto FROM ab)
SELECT id_articulo, articulo, neto, pct_neto, sum(pct_neto) OVER (ORDER BY puesto) pct_acumulado, bruto, htls, n, puesto FROM t UNION ALL SELECT NULL, 'TOTAL GENERAL', sum(neto), 1, 1, sum(bruto), sum(htls), count(*), NULL FROM ab""")
def _(s):
    return cl.top_articles(articles(s))


def series(s):
    return cl.concentration_series(rfm(s), articles(s))


SER = RFM + ", " + ART.split(", ", 1)[1] + """, se AS (SELECT 'Clientes' universo, id_cliente id, unnest(['Neto','Hectolitros']) medida, unnest([monetario_neto, htls]) valor FROM rb UNION ALL
 SELECT 'Articulos', id_articulo, unnest(['Neto','Hectolitros']), unnest([neto, htls]) FROM ab), sx AS (SELECT *, greatest(valor,0) x FROM se WHERE valor IS NOT NULL),
sr AS (SELECT *, row_number() OVER u i, sum(x) OVER (PARTITION BY universo, medida ORDER BY x DESC, id DESC ROWS UNBOUNDED PRECEDING) cd, count(*) OVER w n, sum(x) OVER w t FROM sx WINDOW u AS (PARTITION BY universo, medida ORDER BY x, id), w AS (PARTITION BY universo, medida))"""


@query("g11_concentration", f="gini hhi pct_80 n_efectivo n_80 " + " ".join(f"top_{k}" for k in cl.TOPS), sql=SER + f""", c AS (SELECT universo, medida, max(n) n, count(*) FILTER (valor>1e-9) n_positivos, 2*sum(i*x)/(max(n)*max(t))-(max(n)+1.0::DOUBLE)/max(n) gini, sum(pow(x/t*100,2)) hhi,
 least(count(*) FILTER (cd/t<0.8)+1,max(n))/max(n) pct_80, {', '.join(f'sum(x) FILTER (n-i+1<={k})/max(t) top_{k}' for k in cl.TOPS)} FROM sr GROUP BY 1,2) SELECT *, 10000.0/hhi n_efectivo, ceil(pct_80*n) n_80 FROM c""")
def _(s):
    return cl.concentration_table(series(s))


@query("g11_lorenz_table", f="clientes articulos", sql=SER + """, ca AS (SELECT universo, i, n, sum(x) OVER (PARTITION BY universo ORDER BY i)/t c, (sum(x) OVER (PARTITION BY universo ORDER BY i)-x)/t c0 FROM sr WHERE medida='Neto'),
p AS (SELECT unnest(generate_series(1,100)) punto), j AS (SELECT universo, punto, c0+(punto*n/100.0::DOUBLE-(i-1))*(c-c0) v FROM p JOIN ca ON punto*n>100*(i-1) AND punto*n<=100*i)
SELECT punto, max(v) FILTER (universo='Clientes') clientes, max(v) FILTER (universo='Articulos') articulos FROM j GROUP BY 1 UNION ALL SELECT 0, 0, 0""")
def _(s):
    return cl.lorenz_table(series(s))
