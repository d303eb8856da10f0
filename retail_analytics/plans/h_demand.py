"""H: demand."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.functions.grid import shared
from retail_analytics.functions.shape import slug
from retail_analytics.operators import demand as dm, filters as fl
from retail_analytics.plans.g_clients import A12, COUNTERS, CUT, NON
from retail_analytics.plans.registry import query
from retail_analytics.plans.sqltext import names, smoothed_sql

INV = "iv AS (SELECT * FROM l WHERE id_documento='FCVTA' AND NOT anulado AND (generico IS NULL OR generico NOT IN ('LARGE')))"
MS = INV + ", ms AS (SELECT date_trunc('month',fecha_comprobante)::DATE mes, coalesce(trim(generico),'SIN CLASIFICAR') generico, sum(cantidades_total) bultos, sum(cantidad_total_htls) hectolitros, count(*) lineas, count(DISTINCT id_cliente) clientes FROM iv WHERE fecha_comprobante<='2001-06-30' GROUP BY 1,2)"


def inv(s):
    return dm.invoices(s.lineas, NON)


def series(s, cut=CUT):
    return dm.monthly_series(inv(s), cut)


@query("h1_monthly_series", f="bultos hectolitros", sql=MS + " SELECT * FROM ms")
def _(s):
    return series(s)


@query("h1_open_month_dropped", f="bultos hectolitros", sql=MS + " SELECT * FROM ms WHERE mes<'2001-06-01'")
def _(s):
    return series(s, "2001-06-20")


CATS = ["ECONOMY", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("h2_wide_series", f=names(CATS, "bultos", "htl") + " bultos_total htl_total", sql=MS + f""", f AS (SELECT unnest([strftime(mes,'%Y-%m'),'TOTAL GENERAL']) fila, generico, bultos, hectolitros FROM ms)
SELECT fila, {', '.join(f"sum(bultos) FILTER (generico='{c}') bultos_{slug(c)}, sum(hectolitros) FILTER (generico='{c}') htl_{slug(c)}" for c in CATS)}, sum(bultos) bultos_total, sum(hectolitros) htl_total FROM f GROUP BY 1""")
def _(s):
    return dm.wide_series(shared(series(s)), CATS)


BM = INV + """, bm AS (SELECT marca, date_trunc('month',fecha_comprobante)::DATE mes, sum(cantidades_total) bultos FROM iv WHERE fecha_comprobante<='2001-06-30' GROUP BY 1,2),
sp AS (SELECT min(mes) a, max(mes) b FROM bm), gr AS (SELECT marca, unnest(generate_series((SELECT a FROM sp),(SELECT b FROM sp),INTERVAL 1 MONTH))::DATE mes FROM (SELECT DISTINCT marca FROM bm)),
c AS (SELECT gr.marca, gr.mes, bultos, date_diff('month',(SELECT a FROM sp),gr.mes) paso FROM gr LEFT JOIN bm USING (marca, mes))"""


def brand_months(s):
    v = inv(s).filter(f"fecha_comprobante <= '{CUT}'")
    return v.groupBy("marca", F.trunc("fecha_comprobante", "MM").alias("mes")).agg(F.sum("cantidades_total").alias("bultos"))


@query("h2_complete_months", f="bultos", sql=BM + " SELECT * FROM c")
def _(s):
    return dm.complete_months(brand_months(s), ["marca"], ["bultos"])


@query("h3_live_series", f="bultos", sql=BM + """, v AS (SELECT *, CASE WHEN bultos>0 THEN bultos END v, CASE WHEN bultos>0 THEN paso END p FROM c), z AS (SELECT *, min(p) OVER w a0, max(p) OVER w b0, last_value(v IGNORE NULLS) OVER o v0, last_value(p IGNORE NULLS) OVER o p0,
 first_value(v IGNORE NULLS) OVER n v1, first_value(p IGNORE NULLS) OVER n p1 FROM v WINDOW w AS (PARTITION BY marca), o AS (PARTITION BY marca ORDER BY paso ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY marca ORDER BY paso ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT marca, mes, paso-a0 paso, coalesce(v, v0+(v1-v0)*(paso-p0)/(p1-p0)) bultos FROM z WHERE paso BETWEEN a0 AND b0""")
def _(s):
    return dm.live_series(brand_months(s), ["marca"])


SEA = MS + """, tt AS (SELECT mes, generico, bultos FROM ms UNION ALL SELECT mes, 'TOTAL GENERAL', sum(bultos) FROM ms GROUP BY 1), mp AS (SELECT *, date_diff('month',min(mes) OVER (),mes) paso, count(*) OVER (PARTITION BY generico) n FROM tt),
t AS (SELECT *, CASE WHEN paso>=6 AND paso<=n-7 THEN (avg(bultos) OVER (PARTITION BY generico ORDER BY paso ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)+avg(bultos) OVER (PARTITION BY generico ORDER BY paso ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING))/2 END tr FROM mp),
k AS (SELECT generico, month(mes) m, avg(bultos/tr) x FROM t GROUP BY 1,2), e AS (SELECT generico, m, x/avg(x) OVER (PARTITION BY generico) i FROM k), r AS (SELECT t.generico, bultos/(tr*i) res, i FROM t JOIN e ON e.generico=t.generico AND e.m=month(mes) WHERE tr IS NOT NULL),
sg AS (SELECT generico, greatest(least(1-var_pop(res)/var_pop(res+i),1),0) fuerza_estacional, stddev_pop(res) desvio_residual FROM r GROUP BY 1),
se AS (SELECT e.generico, (SELECT max(n) FROM t WHERE t.generico=e.generico) meses, (SELECT max(n) FROM t WHERE t.generico=e.generico)<24 serie_corta, """ + ", ".join(f"max(i) FILTER (m={k + 1}) indice_{x.lower()}" for k, x in enumerate(dm.MONTHS)) + f""", max(i) indice_pico, min(i) indice_valle, max(i)/min(i) amplitud,
 ({dm.MONTHS})[arg_max(m,i)] mes_pico, ({dm.MONTHS})[arg_min(m,i)] mes_valle FROM e GROUP BY 1),
sx AS (SELECT se.*, fuerza_estacional, desvio_residual, CASE WHEN desvio_residual>0.35 THEN 'No: ruido residual' ELSE 'Si' END legible FROM se JOIN sg USING (generico))"""
FI = " ".join(f"indice_{x.lower()}" for x in dm.MONTHS) + " indice_pico indice_valle amplitud fuerza_estacional desvio_residual"


def live(s):
    return shared(dm.live_series(dm.with_total(series(s)), ["generico"]))


@query("h4_seasonality", f=FI, sql=SEA + " SELECT * FROM sx")
def _(s):
    return dm.seasonality(live(s))


@query("h5_season_alert", f="indice_referencia bultos_referencia indice variacion bultos_esperados", i="orden", sql=SEA + f""", n AS (SELECT sx.generico, indice_jun ir, bultos br, desvio_residual dr, unnest([1,2,3]) orden, unnest(['Jul','Ago','Sep']) mes, unnest([indice_jul,indice_ago,indice_sep]) indice FROM sx JOIN tt ON tt.generico=sx.generico AND tt.mes='2001-06-01'),
v AS (SELECT *, indice/ir-1 variacion FROM n) SELECT generico, ir indice_referencia, br bultos_referencia, orden, mes, indice, variacion, br*indice/ir bultos_esperados, CASE WHEN dr>0.35 THEN 'Sin lectura: ruido residual' WHEN br<1000 THEN 'Sin lectura: volumen de referencia'
 WHEN variacion>=0.20 THEN 'Pico: reforzar stock y cobranza' WHEN variacion>=0.05 THEN 'Sube' WHEN variacion<=-0.20 THEN 'Valle: bajar compra' WHEN variacion<=-0.05 THEN 'Baja' ELSE 'Estable' END lectura FROM v""")
def _(s):
    v = live(s)
    return dm.season_alert(dm.seasonality(v).filter("not serie_corta"), 6, v.filter("mes = '2001-06-01'").select("generico", "bultos"))


@query("h6_forecast", f="bultos limite_inferior limite_superior mape_hw mape_naive", digits=3, sql=MS + """, tt AS (SELECT mes, generico, bultos FROM ms UNION ALL SELECT mes, 'TOTAL GENERAL', sum(bultos) FROM ms GROUP BY 1),
s0 AS (SELECT generico, list(bultos ORDER BY mes) y, list(mes ORDER BY mes) ms, len(list(bultos)) n, sum(bultos) tot FROM tt GROUP BY 1), s1 AS (SELECT *, CASE WHEN n<29 THEN 'pocos meses utiles' WHEN tot<50000 THEN 'volumen bajo el piso' END why FROM s0),
ct AS (SELECT generico, unnest(range(greatest(25,n-12),n+1)) t, y full_y, n FROM s1 WHERE why IS NULL), sr AS (SELECT {'c': generico, 't': t} k, full_y[1:t] y FROM ct)
SELECT * FROM (WITH RECURSIVE """ + smoothed_sql("sr", 3) + """, o AS (SELECT ct.*, full_y[t+1] act, full_y[t-11] nv, lev, tr, sea FROM ct JOIN best ON best.k.c=ct.generico AND best.k.t=ct.t),
e AS (SELECT generico, avg(abs((act-(lev+tr+sea[1]))/act)) FILTER (act<>0)*100 mape_hw, avg(abs((act-nv)/act)) FILTER (act<>0)*100 mape_naive, stddev_samp(act-(lev+tr+sea[1])) sh, stddev_samp(act-nv) sn FROM o WHERE t<n GROUP BY 1),
f AS (SELECT s1.*, e.* EXCLUDE (generico), l.lev, l.tr, l.sea, coalesce(mape_hw<mape_naive, mape_hw IS NOT NULL) hw FROM s1 LEFT JOIN e USING (generico) LEFT JOIN (SELECT * FROM o WHERE t=n) l USING (generico)),
g AS (SELECT * REPLACE (coalesce(why, CASE WHEN CASE WHEN hw THEN mape_hw ELSE mape_naive END>40 OR CASE WHEN hw THEN mape_hw ELSE mape_naive END IS NULL THEN 'serie no pronosticable' END) AS why) FROM f),
p AS (SELECT *, unnest(range(1,7)) h FROM g WHERE why IS NULL), q AS (SELECT *, greatest(CASE WHEN hw THEN lev+h*tr+sea[(h-1)%12+1] ELSE y[n-12+h] END,0) pt, 1.96*nullif(CASE WHEN hw THEN sh ELSE sn END,0)*sqrt(h) w FROM p),
r AS (SELECT generico, ms[n] m0, h, pt bultos, CASE WHEN w IS NOT NULL THEN greatest(pt-w,0) END limite_inferior, pt+w limite_superior, hw, mape_hw, mape_naive FROM q)
SELECT generico, CASE WHEN hw THEN 'Holt-Winters' ELSE 'Naive estacional' END modelo, mape_hw, mape_naive, NULL::VARCHAR descarte, (m0 + to_months(h::INTEGER))::DATE mes, 'Pronostico' tipo, bultos, limite_inferior, limite_superior FROM r
UNION ALL SELECT generico, CASE WHEN hw THEN 'Holt-Winters' ELSE 'Naive estacional' END, mape_hw, mape_naive, NULL, unnest(ms), 'Historico', unnest(y), NULL, NULL FROM g WHERE why IS NULL
UNION ALL SELECT generico, NULL, NULL, NULL, why, NULL, 'Descarte', NULL, NULL, NULL FROM g WHERE why IS NOT NULL)""", d="mes")
def _(s):
    return dm.forecast(live(s))


DU = INV + ", du AS (SELECT fecha_comprobante fecha, coalesce(trim(sucursal),'SIN SUCURSAL') sucursal, sum(cantidades_total) bultos FROM iv GROUP BY 1,2)"
DL = DU + f""", dd AS (SELECT *, (isodow(fecha)-1)::BIGINT dia_semana, ({dm.DAYS})[isodow(fecha)] dia FROM du WHERE isodow(fecha)<>7 AND bultos>0 AND fecha NOT IN (SELECT fecha FROM feriados))"""


def daily(s):
    return dm.daily_units(inv(s))


def days(s):
    return dm.delivery_days(daily(s), s.feriados)


@query("h7_delivery_days", f="bultos", sql=DL + " SELECT * FROM dd")
def _(s):
    return days(s)


@query("h8_days_without_invoice", sql=DL + """, sp AS (SELECT sucursal, min(fecha) a, max(fecha) b, count(*) observados FROM dd GROUP BY 1), x AS (SELECT sucursal, observados, unnest(generate_series(a,b,INTERVAL 1 DAY))::DATE fecha FROM sp),
h AS (SELECT sucursal, observados, count(*) habiles FROM x WHERE isodow(fecha)<>7 AND fecha NOT IN (SELECT fecha FROM feriados) GROUP BY 1,2) SELECT *, greatest(habiles-observados,0) sin_factura FROM h""")
def _(s):
    return dm.days_without_invoice(days(s).select("fecha", "sucursal", "bultos"), s.feriados)


SPC = DL + """, lv AS (SELECT *, ln(bultos) v FROM dd), me AS (SELECT sucursal, dia_semana, dia, count(*) observaciones, count(*)<20 muestra_chica, CASE WHEN count(*)>=20 THEN median(v) END c, CASE WHEN count(*)>=20 THEN stddev_pop(v) END sd FROM lv GROUP BY 1,2,3),
ma AS (SELECT sucursal, dia_semana, median(abs(v-c))*1.4826 e FROM lv JOIN me USING (sucursal, dia_semana) GROUP BY 1,2), lm AS (SELECT me.*, CASE WHEN e>0 THEN e ELSE sd END sc FROM me JOIN ma USING (sucursal, dia_semana)),
zz AS (SELECT lv.fecha, lv.sucursal, lv.dia, bultos, observaciones, muestra_chica, exp(c) centro, exp(c-3*sc) limite_inf, exp(c+3*sc) limite_sup, CASE WHEN sc>0 THEN (v-c)/sc END z FROM lv JOIN lm USING (sucursal, dia_semana)),
bq AS (SELECT fecha, sucursal, dia, bultos, limite_inf, limite_sup, z, CASE WHEN z>0 THEN 'Alta' ELSE 'Baja' END direccion FROM zz WHERE abs(z)>3)"""


@query("h9_anomalies", f="bultos limite_inf limite_sup z", sql=SPC + " SELECT * FROM bq")
def _(s):
    return dm.anomalies(shared(days(s)))[0]


@query("h9_control_limits", f="centro limite_inf limite_sup", sql=SPC + " SELECT sucursal, dia, observaciones, muestra_chica, centro, limite_inf, limite_sup, count(*) FILTER (abs(z)>3) quiebres FROM zz GROUP BY ALL")
def _(s):
    return dm.anomalies(shared(days(s)))[1]


# two sigmas and two branches, so that the small data has events
SPC2 = SPC.replace("c-3*sc", "c-2*sc").replace("c+3*sc", "c+2*sc").replace("abs(z)>3", "abs(z)>2")


@query("h10_company_events", f="bultos", sql=SPC2 + """ SELECT fecha, count(DISTINCT sucursal) sucursales_en_alerta, string_agg(DISTINCT sucursal, ', ' ORDER BY sucursal) sucursales, sum(bultos) bultos, count(*) FILTER (direccion='Alta') altas, count(*) FILTER (direccion='Baja') bajas,
CASE WHEN count(*) FILTER (direccion='Alta')>=count(*) FILTER (direccion='Baja') THEN 'Alta' ELSE 'Baja' END direccion FROM bq GROUP BY 1 HAVING count(DISTINCT sucursal)>=2""")
def _(s):
    return dm.company_events(dm.anomalies(shared(days(s)), sigmas=2.0)[0], 2)


@query("h11_counter_share", f="bultos participacion", sql=INV + ", t AS (SELECT CASE WHEN id_cliente IN (10,20,30) THEN 'Mostrador' ELSE 'Clientes' END tipo_cuenta, sum(cantidades_total) bultos FROM iv GROUP BY 1) SELECT *, bultos/sum(bultos) OVER () participacion FROM t")
def _(s):
    return dm.counter_share(inv(s), COUNTERS)


@query("h11_returned_share", f="facturados devueltos pct_devuelto", sql="""t AS (SELECT sum(cantidades_total) FILTER (id_documento='FCVTA') facturados, sum(cantidades_total) FILTER (id_documento='DVVTA') devueltos FROM l WHERE NOT anulado AND (generico IS NULL OR generico<>'LARGE') AND fecha_comprobante>'2000-06-28' AND fecha_comprobante<='2001-06-30')
SELECT *, abs(devueltos)/facturados pct_devuelto FROM t""")
def _(s):
    v = fl.working_lines(s.lineas, NON, keep_null_category=True)
    return dm.returned_share(v.filter(f"fecha_comprobante > '{A12}' and fecha_comprobante <= '{CUT}'"))


@query("h11_year_over_year_volume", f="ultimos previos variacion", sql=MS + ", m AS (SELECT mes, sum(hectolitros) h FROM ms GROUP BY 1), t AS (SELECT sum(h) FILTER (mes>='2000-07-01') ultimos, sum(h) FILTER (mes>='1999-07-01' AND mes<'2000-07-01') previos FROM m) SELECT *, ultimos/previos-1 variacion FROM t")
def _(s):
    return dm.year_over_year_volume(series(s))


# two categories are cut to start late
@query("h12_structural_breaks", f="resto_antes resto_despues", sql=MS + """, x AS (SELECT * FROM ms WHERE NOT (generico='PROMO' AND mes<'1997-03-01') AND NOT (generico='SMALL' AND mes<'1999-01-01')), b AS (SELECT generico, min(mes) inicio FROM x GROUP BY 1), g AS (SELECT b.*, (SELECT min(mes) FROM x) inicio_serie FROM b)
SELECT g.generico, inicio, inicio_serie, sum(bultos) FILTER (x.mes<inicio) resto_antes, sum(bultos) FILTER (x.mes>=inicio) resto_despues FROM g JOIN x ON x.generico<>g.generico WHERE inicio>inicio_serie GROUP BY 1,2,3""")
def _(s):
    x = series(s).filter("not (generico = 'PROMO' and mes < '1997-03-01') and not (generico = 'SMALL' and mes < '1999-01-01')")
    return dm.structural_breaks(x)
