"""K: logistics."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.operators import filters as fl, logistics as lg
from retail_analytics.plans.g_clients import COUNTERS, NON
from retail_analytics.plans.registry import query

SINCE, CUT = "2000-06-28", "2001-05-31"
HI = f"""en AS (SELECT id_sucursal, id_fletero_carga, date_diff('day',min(fecha_pedido),min(fecha_entrega)) lead_dias, sum(subtotal_neto) neto, sum(cantidades_total) bultos FROM fv WHERE id_documento='FCVTA' AND NOT anulado AND fecha_comprobante BETWEEN '{SINCE}' AND '{CUT}'
 GROUP BY id_documento, letra, serie, nro_doc, id_sucursal, id_fletero_carga), hi AS (SELECT en.id_sucursal, descripcion sucursal, id_fletero_carga, lead_dias, count(*) entregas, sum(bultos) bultos, sum(neto) neto FROM en JOIN suc USING (id_sucursal) WHERE lead_dias BETWEEN 0 AND 60 GROUP BY ALL)"""


def hist(s):
    return lg.lead_histogram(s.ventas, s.sucursal, SINCE, CUT)


@query("k1_lead_histogram", f="bultos neto", sql=HI + " SELECT * FROM hi")
def _(s):
    return hist(s)


SLA = HI + """, d AS (SELECT * FROM hi WHERE id_fletero_carga NOT IN (0,33)), x AS (SELECT 'Sucursal' nivel, sucursal entidad, sucursal, lead_dias, entregas, bultos, neto FROM d UNION ALL SELECT 'Fletero', 'Fletero '||id_fletero_carga, sucursal, lead_dias, entregas, bultos, neto FROM d
 UNION ALL SELECT 'TOTAL','TOTAL GENERAL','TOTAL GENERAL',lead_dias,entregas,bultos,neto FROM d), ex AS (SELECT nivel, entidad, sucursal, lead_dias l, unnest(range(entregas)) FROM x), q AS (SELECT nivel, entidad, sucursal, quantile_disc(l,0.5)::DOUBLE lead_p50, quantile_disc(l,0.9)::DOUBLE lead_p90 FROM ex GROUP BY 1,2,3),
t AS (SELECT nivel, entidad, sucursal, sum(entregas) entregas, sum(CASE WHEN lead_dias<=1 THEN entregas ELSE 0 END) ok, sum(lead_dias*entregas)/sum(entregas) lead_medio, sum(bultos) bultos, sum(neto) neto, nivel='Fletero' AND sum(entregas)<12 muestra_chica FROM x GROUP BY 1,2,3),
u AS (SELECT *, ok/entregas otif, sum(ok) FILTER (NOT muestra_chica) OVER (PARTITION BY nivel)/sum(entregas) FILTER (NOT muestra_chica) OVER (PARTITION BY nivel) tasa_red FROM t), v AS (SELECT *, CASE WHEN NOT muestra_chica THEN otif-tasa_red END br, CASE WHEN NOT muestra_chica THEN (otif-tasa_red)/sqrt(tasa_red*(1-tasa_red)/entregas) END zz FROM u),
sl AS (SELECT nivel, entidad, sucursal, entregas, otif, lead_medio, bultos, neto, muestra_chica, tasa_red, CASE WHEN nivel='TOTAL' THEN 0 ELSE br END brecha, CASE WHEN nivel<>'TOTAL' THEN zz END z, coalesce(abs(zz)>1.959963985,false) significativo, CASE WHEN nivel='TOTAL' THEN 'Red completa' WHEN muestra_chica OR abs(zz)<=1.959963985 THEN 'Sin evidencia (muestra chica)' WHEN abs(br)<0.05 THEN 'Significativo pero sin impacto practico'
 WHEN br<0 THEN 'Rezagado significativo' ELSE 'Mejor que la red' END veredicto FROM v)"""


def sla(s):
    return lg.service_level(hist(s), [0, 33], 12)


@query("k2_service_level", f="otif lead_medio bultos neto tasa_red brecha z lead_p50 lead_p90", i="entregas", sql=SLA + " SELECT sl.*, lead_p50, lead_p90 FROM sl JOIN q USING (nivel, entidad, sucursal)")
def _(s):
    return sla(s)


# the whole history, so that some carrier of the small data is a laggard
@query("k7_worst_laggard", f="brecha z", sql=SLA.replace(SINCE, "1995-01-01").replace("sum(entregas)<12", "sum(entregas)<30") + " SELECT nivel, entidad, brecha, z FROM sl WHERE veredicto='Rezagado significativo' ORDER BY brecha, entidad LIMIT 1")
def _(s):
    h = lg.lead_histogram(s.ventas, s.sucursal, "1995-01-01", CUT)
    return lg.worst_laggard(lg.service_level(h, [0, 33], 30))


@query("k7_month_alignment", f="bultos", sql="SELECT date_trunc('month',fecha_comprobante)::DATE mes, sum(cantidades_total) bultos FROM fv WHERE fecha_comprobante BETWEEN '2000-07-01' AND '2001-05-31' GROUP BY 1")
def _(s):
    from datetime import date

    from retail_analytics.operators import calendar as cal
    a = cal.month_start_from(date(2000, 6, 28))
    return fl.dates(s.ventas, str(a), str(cal.last_full_month(date(2001, 6, 20)))).groupBy(F.trunc("fecha_comprobante", "MM").alias("mes")).agg(F.sum("cantidades_total").alias("bultos"))


LB = f"lb AS (SELECT * FROM l WHERE NOT anulado AND id_documento IN ('FCVTA','DVVTA') AND fecha_comprobante BETWEEN '{SINCE}' AND '{CUT}' AND generico IS NOT NULL AND generico<>'LARGE')"
M5 = "count(*) n_lineas, count(*) FILTER (cantidades_rechazo>0) n_rechazo, coalesce(sum(cantidades_rechazo) FILTER (cantidades_rechazo>0),0) bultos_rechazo, coalesce(sum(-subtotal_neto) FILTER (cantidades_rechazo>0),0) valor_rechazo, coalesce(sum(subtotal_neto) FILTER (coalesce(cantidades_rechazo,0)=0),0) neto_facturado"
RM = LB + f""", nc AS (SELECT id_cliente, max(nullif(trim(fantasia),'')) FILTER (regexp_matches(trim(fantasia),'[A-Za-z0-9]')) f, max(nullif(trim(razon_social),'')) r, max(nullif(trim(des_subcanal_mkt),'')) sc FROM cli GROUP BY 1),
rm AS (SELECT 'Sucursal' dimension, sucursal entidad, id_sucursal::VARCHAR id_entidad, {M5} FROM lb GROUP BY 2,3 UNION ALL SELECT 'Fletero','Fletero '||id_fletero_carga, id_fletero_carga::VARCHAR, {M5} FROM lb WHERE id_fletero_carga NOT IN (0,33) GROUP BY 2,3
 UNION ALL SELECT 'Cliente', coalesce(nc.f, nc.r||' ['||lb.id_cliente||']', 'CLIENTE '||lb.id_cliente), lb.id_cliente::VARCHAR, {M5} FROM lb LEFT JOIN nc USING (id_cliente) GROUP BY 2,3 UNION ALL SELECT 'Articulo', des_articulo, id_articulo::VARCHAR, {M5} FROM lb GROUP BY 2,3
 UNION ALL SELECT 'Subcanal', coalesce(nc.sc,'SIN SUBCANAL'), NULL, {M5} FROM lb LEFT JOIN nc USING (id_cliente) GROUP BY 2 UNION ALL SELECT 'Dia de semana', ({lg.DAYS})[isodow(fecha_comprobante)], isodow(fecha_comprobante)::VARCHAR, {M5} FROM lb GROUP BY 2,3)"""
FM = "bultos_rechazo valor_rechazo neto_facturado"


def metrics(s):
    v = fl.dates(fl.working_lines(s.lineas, NON, keep_null_category=False), SINCE, CUT)
    return lg.rejection_metrics(v, s.cliente, s.articulo, s.sucursal)


@query("k3_rejection_metrics", f=FM, i="n_lineas n_rechazo", sql=RM + " SELECT * FROM rm")
def _(s):
    return metrics(s)


@query("k4_rejection_table", f=FM + " tasa tasa_red brecha z share pareto", i="n_lineas n_rechazo", sql=RM + """, b AS (SELECT *, sum(n_rechazo) OVER (PARTITION BY dimension)/sum(n_lineas) OVER (PARTITION BY dimension) tasa_red, sum(greatest(valor_rechazo,0)) OVER (PARTITION BY dimension) t, row_number() OVER (PARTITION BY dimension ORDER BY valor_rechazo DESC) o,
 sum(valor_rechazo) OVER (PARTITION BY dimension ORDER BY valor_rechazo DESC RANGE UNBOUNDED PRECEDING) cu FROM rm), z AS (SELECT *, n_rechazo/n_lineas tasa, n_rechazo/n_lineas-tasa_red brecha, (n_rechazo/n_lineas-tasa_red)/sqrt(tasa_red*(1-tasa_red)/n_lineas) z, dimension IN ('Cliente','Articulo') lo FROM b),
h AS (SELECT dimension, entidad, n_lineas, n_rechazo, bultos_rechazo, valor_rechazo, neto_facturado, tasa, tasa_red, brecha, z, abs(z)>1.959963985 AND NOT (lo AND n_lineas<20) significativo, CASE WHEN lo AND n_lineas<20 THEN 'Sin evidencia (muestra chica)' WHEN abs(z)<=1.959963985 THEN 'Sin evidencia (muestra chica)'
 WHEN abs(brecha)<0.02 THEN 'Significativo pero sin impacto practico' WHEN brecha>=0 THEN 'Rechazo alto (significativo)' ELSE 'Rechazo bajo (significativo)' END veredicto, valor_rechazo/t share, CASE WHEN dimension<>'Dia de semana' THEN cu/t END pareto,
 CASE WHEN dimension='Sucursal' AND entidad='NATION_9' THEN 'Sucursal cerrada' WHEN dimension='Cliente' AND id_entidad IN ('10','20','30') THEN 'Cliente mostrador' ELSE '' END nota, lo AND o>40 tail FROM z)
SELECT * EXCLUDE (tail), tail cola FROM h UNION ALL SELECT dimension, 'RESTO ('||count(*)||' entidades)', sum(n_lineas), sum(n_rechazo), sum(bultos_rechazo), sum(valor_rechazo), sum(neto_facturado), sum(n_rechazo)/sum(n_lineas), NULL, NULL, NULL, false, 'Cola agregada', sum(share), 1, '', false FROM h WHERE tail GROUP BY 1
UNION ALL SELECT 'TOTAL','TOTAL GENERAL',sum(n_lineas),sum(n_rechazo),sum(bultos_rechazo),sum(valor_rechazo),sum(neto_facturado),sum(n_rechazo)/sum(n_lineas),sum(n_rechazo)/sum(n_lineas),0,NULL,false,'Red completa',1,1,'',false FROM rm WHERE dimension='Sucursal'""")
def _(s):
    return lg.rejection_table(metrics(s), COUNTERS, ["NATION_9"], 20)


M4 = "coalesce(sum(cantidades_total) FILTER (id_documento='FCVTA'),0) bultos_bruto, coalesce(sum(abs(cantidades_total)) FILTER (id_documento='DVVTA'),0) bultos_dev, coalesce(sum(facturacion_neta) FILTER (id_documento='FCVTA'),0) bruto_pesos, coalesce(sum(abs(facturacion_neta)) FILTER (id_documento='DVVTA'),0) dev_pesos"


@query("k5_return_rates", f="bultos_bruto bultos_dev bruto_pesos dev_pesos tasa_bultos tasa_valor z_robusto", sql=LB + f""", d AS (SELECT 'Generico' dimension, generico entidad, {M4} FROM lb GROUP BY 2 UNION ALL SELECT 'Marca', marca, {M4} FROM lb GROUP BY 2 UNION ALL SELECT 'Sucursal', sucursal, {M4} FROM lb GROUP BY 2
 UNION ALL SELECT 'Mes', strftime(fecha_comprobante,'%Y-%m'), {M4} FROM lb GROUP BY 2 UNION ALL SELECT 'TOTAL','TOTAL GENERAL',{M4} FROM lb UNION ALL SELECT 'Articulo', des_articulo||' ['||marca||']', {M4} FROM lb GROUP BY 2),
r AS (SELECT *, CASE WHEN bultos_bruto>0 THEN bultos_dev/bultos_bruto END tasa_bultos, CASE WHEN bruto_pesos>0 THEN dev_pesos/bruto_pesos END tasa_valor FROM d), a AS (SELECT *, bultos_bruto<50 bajo_piso FROM r WHERE dimension='Articulo'), md AS (SELECT median(tasa_bultos) m FROM a WHERE NOT bajo_piso), ma AS (SELECT median(abs(tasa_bultos-m))*1.4826 k FROM a, md WHERE NOT bajo_piso),
z AS (SELECT a.*, CASE WHEN NOT bajo_piso THEN CASE WHEN k=0 THEN 0 ELSE (tasa_bultos-m)/k END END z_robusto FROM a, md, ma)
SELECT *, coalesce(abs(z_robusto)>=3.5,false) outlier, '' nota FROM z UNION ALL SELECT r.*, false, NULL, false, CASE WHEN entidad='NATION_9' THEN 'Sucursal cerrada' WHEN dimension='Mes' AND entidad='2000-06' THEN 'Mes incompleto' ELSE '' END FROM r WHERE dimension<>'Articulo'""")
def _(s):
    v = fl.dates(fl.working_lines(s.lineas, NON, keep_null_category=False), SINCE, CUT)
    return lg.return_rates(v, 50, closed=["NATION_9"], partial_month="2000-06")


RT = f"""fa AS (SELECT sucursal, id_sucursal, id_ruta, id_cliente, fecha_comprobante, nro_doc, sum(cantidades_total) bultos, sum(subtotal_neto) neto, sum(facturacion_neta) bruto, count(*) lineas, max(des_personal_fv1) p FROM l WHERE NOT anulado AND id_documento='FCVTA' AND generico IS NOT NULL AND generico<>'LARGE' AND fecha_comprobante BETWEEN '{SINCE}' AND '{CUT}' AND id_ruta IS NOT NULL
 GROUP BY sucursal, id_sucursal, id_ruta, id_cliente, fecha_comprobante, id_documento, letra, serie, nro_doc), ro AS (SELECT sucursal, id_sucursal, id_ruta, max(p) preventista, count(*) visitas, count(DISTINCT id_cliente) clientes, count(DISTINCT fecha_comprobante) dias_activos, count(DISTINCT CASE WHEN id_cliente IN (10,20,30) THEN id_cliente END) clientes_mostrador,
 sum(bultos) bultos, sum(neto) neto, sum(bruto) bruto, avg(lineas) lineas_x_visita, median(bultos) mediana_bultos_visita, count(*)<5 pocas_visitas FROM fa GROUP BY 1,2,3)"""


def routes(s):
    v = fl.dates(fl.working_lines(s.lineas, NON, keep_null_category=False, documents=["FCVTA"]), SINCE, CUT)
    return lg.routes(v, COUNTERS, 5)


@query("k6_routes", f="bultos neto bruto lineas_x_visita mediana_bultos_visita", sql=RT + " SELECT * FROM ro")
def _(s):
    return routes(s)


@query("k6_route_table", f="bultos neto bruto lineas_x_visita mediana_bultos_visita drop_size neto_por_visita:2", i="visitas clientes clientes_mostrador", sql=RT + """, d AS (SELECT *, bultos/visitas drop_size, neto/visitas neto_por_visita FROM ro), e AS (SELECT *, CASE WHEN pocas_visitas THEN 'Sin evidencia (muestra chica)' WHEN drop_size<=(SELECT quantile_cont(drop_size,0.25) FROM d WHERE NOT pocas_visitas) THEN 'Baja densidad (cuartil inferior)' ELSE 'Normal' END densidad, sucursal||' / '||id_ruta clave, CASE WHEN sucursal='NATION_9' THEN 'Sucursal cerrada' ELSE '' END nota FROM d)
SELECT * FROM e UNION ALL BY NAME SELECT 'TOTAL GENERAL' clave, sum(visitas) visitas, sum(clientes) clientes, sum(bultos) bultos, sum(neto) neto, sum(bruto) bruto, sum(clientes_mostrador) clientes_mostrador, sum(bultos)/sum(visitas) drop_size, sum(neto)/sum(visitas) neto_por_visita FROM e""")
def _(s):
    return lg.route_table(routes(s), ["NATION_9"])
