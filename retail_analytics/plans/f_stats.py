"""F: statistics helpers on the data of the star."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.functions.grid import shared
from retail_analytics.functions import ordered
from retail_analytics.operators import filters as fl, stats as st
from retail_analytics.plans.g_clients import A12, CUT, LN, lines
from retail_analytics.plans.registry import query
from retail_analytics.plans.sqltext import erf_sql, smoothed_sql

YEAR = f"fecha_comprobante>'{A12}' AND fecha_comprobante<='{CUT}'"
# client x branch: net, units, lines, returned lines, discount rate
CB = LN + f""", cb AS (SELECT id_sucursal, id_cliente, sum(subtotal_neto) neto, count(*) lineas, count(*) FILTER (id_documento='DVVTA') devueltas, round(sum(abs(descuentos))/sum(abs(facturacion_neta)),6) tasa FROM ln WHERE {YEAR} GROUP BY 1,2)"""


def clients(s):
    w = lines(s).filter(f"fecha_comprobante > '{A12}' and fecha_comprobante <= '{CUT}'")
    return shared(w.groupBy("id_sucursal", "id_cliente").agg(
        F.sum("subtotal_neto").alias("neto"), F.count(F.lit(1)).alias("lineas"), F.count_if(F.col("id_documento") == "DVVTA").alias("devueltas"),
        F.round(F.sum(F.abs("descuentos")) / F.sum(F.abs("facturacion_neta")), 6).alias("tasa")))


@query("f1_p_values", f="z p_valor", sql=CB + """, b AS (SELECT id_sucursal, sum(devueltas) x, sum(lineas) n FROM cb GROUP BY 1), r AS (SELECT *, (sum(x) OVER ())/(sum(n) OVER ()) p FROM b), z AS (SELECT id_sucursal, (x/n-p)/sqrt(p*(1-p)/n) z FROM r)
SELECT id_sucursal, z, 2*(1-0.5*(1+""" + erf_sql("abs(z)/sqrt(2)") + """)) p_valor FROM z""")
def _(s):
    b = clients(s).groupBy("id_sucursal").agg(F.sum("devueltas").alias("x"), F.sum("lineas").alias("n"))
    v = st.verdict(b, "x", "n", 0.02, False, "alto", "bajo")
    return v.select("id_sucursal", "z", st.two_sided_p(F.col("z")).alias("p_valor"))


@query("f2_robust_z", digits=6, f="tasa mediana z_robusto", sql=CB + """, m AS (SELECT id_sucursal, median(tasa) mediana FROM cb GROUP BY 1), d AS (SELECT id_sucursal, median(abs(tasa-mediana)) mad FROM cb JOIN m USING (id_sucursal) GROUP BY 1)
SELECT id_sucursal, id_cliente, tasa, mediana, CASE WHEN mad=0 THEN 0 ELSE (tasa-mediana)/(1.4826*mad) END z_robusto FROM cb JOIN m USING (id_sucursal) JOIN d USING (id_sucursal)""")
def _(s):
    return st.robust_z(clients(s).select("id_sucursal", "id_cliente", "tasa"), "tasa", ["id_sucursal"])


@query("f3_coefficient_of_variation", f="cv", sql=LN + """, m AS (SELECT generico, marca, date_trunc('month',fecha_comprobante) mes, sum(cantidades_total) b FROM ln GROUP BY ALL) SELECT generico, marca, stddev_pop(b)/abs(nullif(avg(b),0)) cv FROM m GROUP BY 1,2""")
def _(s):
    m = lines(s).groupBy("generico", "marca", F.trunc("fecha_comprobante", "MM").alias("mes")).agg(F.sum("cantidades_total").alias("b"))
    return m.groupBy("generico", "marca").agg(st.cv(F.col("b")).alias("cv"))


RK = CB + """, x AS (SELECT *, greatest(neto,0) x FROM cb), r AS (SELECT *, row_number() OVER (PARTITION BY id_sucursal ORDER BY x, id_cliente) i, count(*) OVER w n, sum(x) OVER w t,
 sum(x) OVER (PARTITION BY id_sucursal ORDER BY x DESC, id_cliente DESC ROWS UNBOUNDED PRECEDING) cd, sum(x) OVER (PARTITION BY id_sucursal ORDER BY x, id_cliente ROWS UNBOUNDED PRECEDING) ca FROM x WINDOW w AS (PARTITION BY id_sucursal))"""


@query("f4_gini", f="gini", sql=RK + " SELECT id_sucursal, 2*sum(i*x)/(max(n)*nullif(max(t),0))-(max(n)+1.0::DOUBLE)/max(n) gini FROM r GROUP BY 1")
def _(s):
    return st.concentration(clients(s), ["id_sucursal"], "neto", "id_cliente", [1]).select("id_sucursal", "gini")


@query("f5_lorenz_curve", f="acumulado", sql=RK + """, p AS (SELECT unnest(generate_series(1,20)) punto) SELECT id_sucursal, punto, (ca-x+(punto*n/20.0::DOUBLE-(i-1))*x)/t acumulado FROM p JOIN r ON punto*n>20*(i-1) AND punto*n<=20*i
UNION ALL SELECT DISTINCT id_sucursal, 0, 0 FROM r""")
def _(s):
    return st.lorenz(clients(s), "neto", "id_cliente", ["id_sucursal"], points=21)


@query("f6_concentration", f="hhi pct_80 top_3", sql=RK + " SELECT id_sucursal, sum(pow(x/t*100,2)) hhi, least(count(*) FILTER (cd/t<0.8)+1,max(n))/max(n) pct_80, sum(x) FILTER (n-i+1<=3)/max(t) top_3 FROM r GROUP BY 1")
def _(s):
    return st.concentration(clients(s), ["id_sucursal"], "neto", "id_cliente", [3]).select("id_sucursal", "hhi", "pct_80", "top_3")


@query("f7_quantile_score", sql=CB + """ SELECT id_cliente, lineas, greatest(least(ceil((rank() OVER (ORDER BY lineas)+(count(*) OVER (PARTITION BY lineas)-1)/2.0::DOUBLE)/count(*) OVER ()*5),5),1)::BIGINT puntaje,
greatest(least(ceil((rank() OVER (ORDER BY lineas DESC)+(count(*) OVER (PARTITION BY lineas)-1)/2.0::DOUBLE)/count(*) OVER ()*5),5),1)::BIGINT puntaje_inverso FROM cb""")
def _(s):
    return ordered.quantile_scores(clients(s).select("id_cliente", "lineas"), [("lineas", "puntaje", True), ("lineas", "puntaje_inverso", False)])


@query("f8_proportion_test", f="tasa_red tasa brecha z", i="x n", sql=CB + """, b AS (SELECT id_sucursal, sum(devueltas) x, sum(lineas) n FROM cb GROUP BY 1), r AS (SELECT *, (sum(x) OVER ())/(sum(n) OVER ()) tasa_red FROM b),
z AS (SELECT *, x/n tasa, x/n-tasa_red brecha, (x/n-tasa_red)/sqrt(tasa_red*(1-tasa_red)/n) z FROM r)
SELECT *, abs(z)>1.959963985 significativo, CASE WHEN abs(z)<=1.959963985 THEN 'Sin evidencia (muestra chica)' WHEN abs(brecha)<0.02 THEN 'Significativo pero sin impacto practico' WHEN brecha>=0 THEN 'alto' ELSE 'bajo' END veredicto FROM z""")
def _(s):
    b = clients(s).groupBy("id_sucursal").agg(F.sum("devueltas").alias("x"), F.sum("lineas").alias("n"))
    return st.verdict(b, "x", "n", 0.02, False, "alto", "bajo")


CHI = """o AS (SELECT des_canal_mkt, generico, greatest(sum(cantidades_total),0) o FROM l WHERE fecha_comprobante BETWEEN '2000-07-01' AND '2001-06-30' GROUP BY 1,2), rr AS (SELECT des_canal_mkt, sum(o) r FROM o GROUP BY 1 HAVING sum(o)>0),
cc AS (SELECT generico, sum(o) c FROM o GROUP BY 1 HAVING sum(o)>0), q AS (SELECT rr.des_canal_mkt, cc.generico, coalesce(o.o,0) observado, r*c/(SELECT sum(o) FROM o) esperado FROM rr CROSS JOIN cc LEFT JOIN o ON o.des_canal_mkt=rr.des_canal_mkt AND o.generico=cc.generico),
x AS (SELECT *, (observado-esperado)/sqrt(esperado) residuo FROM q)"""


@query("f1_chi_square_tail", f="estadistico v_cramer p_valor", i="gl", sql=CHI + """, c AS (SELECT sum(residuo*residuo) estadistico, (count(DISTINCT des_canal_mkt)-1)*(count(DISTINCT generico)-1) gl, sqrt(sum(residuo*residuo)/(sum(observado)*(least(count(DISTINCT des_canal_mkt),count(DISTINCT generico))-1))) v_cramer FROM x),
h AS (SELECT *, (pow(estadistico/gl,1/3.0::DOUBLE)-(1-2.0::DOUBLE/(9*gl)))/sqrt(2.0::DOUBLE/(9*gl)) w FROM c) SELECT estadistico, gl, v_cramer, 1-(0.5+0.5*sign(w)*""" + erf_sql("abs(w)/sqrt(2)") + """) p_valor FROM h""")
def _(s):
    r = st.chi_square(fl.dates(s.lineas, "2000-07-01", CUT), "des_canal_mkt", "generico", "cantidades_total")
    return st.chi_square_test(r, "des_canal_mkt", "generico")


@query("f9_chi_square_residuals", f="observado esperado residuo", sql=CHI + " SELECT * FROM x")
def _(s):
    return st.chi_square(fl.dates(s.lineas, "2000-07-01", CUT), "des_canal_mkt", "generico", "cantidades_total")


@query("f9_cramers_v", f="estadistico v_cramer", sql=CHI + " SELECT sum(residuo*residuo) estadistico, (count(DISTINCT des_canal_mkt)-1)*(count(DISTINCT generico)-1) gl, sqrt(sum(residuo*residuo)/(sum(observado)*(least(count(DISTINCT des_canal_mkt),count(DISTINCT generico))-1))) v_cramer FROM x")
def _(s):
    r = st.chi_square(fl.dates(s.lineas, "2000-07-01", CUT), "des_canal_mkt", "generico", "cantidades_total")
    return st.chi_square_test(r, "des_canal_mkt", "generico", p_value=False)


@query("f10_regression", f="pendiente ordenada r2 error t", sql="""g AS (SELECT id_sucursal, count(*) n, regr_sxx(y,x) xx, regr_syy(y,x) yy, regr_sxy(y,x) xy, avg(x) ax, avg(y) ay FROM (SELECT id_sucursal, cantidades_total x, facturacion_neta y FROM fv) GROUP BY 1),
p AS (SELECT *, xy/xx b FROM g) SELECT id_sucursal, n, b pendiente, ay-b*ax ordenada, 1-(yy-b*xy)/yy r2, sqrt((yy-b*xy)/(n-2)/xx) error, b/sqrt((yy-b*xy)/(n-2)/xx) t FROM p""")
def _(s):
    return st.ols(s.ventas, "cantidades_total", "facturacion_neta", ["id_sucursal"])


MS = LN + ", ms AS (SELECT generico, date_trunc('month',fecha_comprobante)::DATE mes, sum(cantidades_total) b FROM ln WHERE id_documento='FCVTA' AND fecha_comprobante<='2001-06-30' GROUP BY 1,2), mp AS (SELECT *, date_diff('month',DATE '1995-01-01',mes) paso FROM ms)"


def monthly(s):
    v = lines(s).filter(f"id_documento = 'FCVTA' and fecha_comprobante <= '{CUT}'")
    m = v.groupBy("generico", F.trunc("fecha_comprobante", "MM").alias("mes")).agg(F.sum("cantidades_total").alias("b"))
    return m.withColumn("paso", F.months_between("mes", F.lit("1995-01-01").cast("date")).cast("long"))


DEC = MS + """, t AS (SELECT *, count(*) OVER (PARTITION BY generico) n, (avg(b) OVER (PARTITION BY generico ORDER BY paso ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)+avg(b) OVER (PARTITION BY generico ORDER BY paso ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING))/2 tr FROM mp),
u AS (SELECT *, CASE WHEN paso>=6 AND paso<=n-7 THEN tr END tendencia FROM t), k AS (SELECT generico, paso%12 p, avg(b/tendencia) m FROM u GROUP BY 1,2), kk AS (SELECT *, m/avg(m) OVER (PARTITION BY generico) estacional FROM k),
dc AS (SELECT u.generico, u.mes, u.b, u.paso, tendencia, estacional, b/(tendencia*estacional) residuo FROM u JOIN kk ON kk.generico=u.generico AND kk.p=u.paso%12)"""


@query("f11_seasonal_decomposition", f="b tendencia estacional residuo", sql=DEC + " SELECT * FROM dc")
def _(s):
    return st.seasonal_decompose(monthly(s), ["generico"], "paso", "b")


@query("f11_seasonal_strength", f="fuerza_estacional desvio_residual", sql=DEC + " SELECT generico, greatest(least(1-var_pop(residuo)/var_pop(residuo+estacional),1),0) fuerza_estacional, stddev_pop(residuo) desvio_residual FROM dc WHERE residuo IS NOT NULL GROUP BY 1")
def _(s):
    return st.seasonal_strength(st.seasonal_decompose(monthly(s), ["generico"], "paso", "b"), ["generico"])


@query("f12_holt_winters", f="pronostico inferior superior alpha beta gamma sse:-3 mape", i="paso", sql=MS + """, sr AS (SELECT generico k, list(b ORDER BY paso) y FROM mp GROUP BY 1) SELECT * FROM (WITH RECURSIVE """ + smoothed_sql("sr", 5) + """,
p AS (SELECT *, unnest(range(1,7)) h, sqrt(sse/greatest(len(y)-15,1)) sd FROM best), v AS (SELECT *, lev+h*tr+sea[(h-1)%12+1] f, 1.96*sd*sqrt(1+coalesce(list_sum(list_transform(range(1,h), lambda j: pow(a*(1+j*b),2))),0)) w FROM p)
SELECT k generico, h paso, f pronostico, f-w inferior, f+w superior, a alpha, b beta, g gamma, sse, pct/hits*100 mape FROM v)""")
def _(s):
    return st.holt_winters_by(monthly(s), "generico", "paso", "b")


@query("f13_control_limits", f="centro escala limite_inf limite_sup", sql=MS + """, c AS (SELECT generico, count(*) observaciones, median(b) centro, stddev_pop(b) sd FROM ms GROUP BY 1), d AS (SELECT generico, median(abs(b-centro))*1.4826 e FROM ms JOIN c USING (generico) GROUP BY 1),
x AS (SELECT generico, observaciones, centro, CASE WHEN e>0 THEN e ELSE sd END escala FROM c JOIN d USING (generico)) SELECT *, centro-3*escala limite_inf, centro+3*escala limite_sup FROM x""")
def _(s):
    return st.control_limits(monthly(s), ["generico"], "b")


RULES = """bk AS (SELECT DISTINCT nro_doc basket, marca item, (id_cliente%2)::BIGINT grp FROM l WHERE id_documento='FCVTA' AND NOT anulado), nb AS (SELECT grp, count(DISTINCT basket) n FROM bk GROUP BY 1), f AS (SELECT grp, item, count(*) f FROM bk GROUP BY 1,2),
k AS (SELECT bk.* FROM bk JOIN f USING (grp, item) JOIN nb USING (grp) WHERE f>=0.003*n),
pr AS (SELECT a.grp, a.item antecedente, b.item consecuente, count(*) baskets FROM k a JOIN k b ON a.grp=b.grp AND a.basket=b.basket AND a.item<>b.item GROUP BY 1,2,3),
ru AS (SELECT pr.grp, antecedente, consecuente, baskets/n soporte, fa.f/n soporte_antecedente, fb.f/n soporte_consecuente, baskets/fa.f confianza, (baskets/fa.f)/(fb.f/n) lift, baskets/n-(fa.f/n)*(fb.f/n) leverage, CASE WHEN baskets<fa.f THEN (1-fb.f/n)/(1-baskets/fa.f) END conviccion, baskets
 FROM pr JOIN nb USING (grp) JOIN f fa ON fa.grp=pr.grp AND fa.item=antecedente JOIN f fb ON fb.grp=pr.grp AND fb.item=consecuente)"""
FRULE = "soporte soporte_antecedente soporte_consecuente confianza lift leverage conviccion"


@query("f14_association_rules", f=FRULE, digits=6, sql=RULES + " SELECT * FROM ru WHERE soporte>=0.003 AND lift>=0.9")
def _(s):
    b = s.lineas.filter("id_documento = 'FCVTA' and not anulado").select(F.col("nro_doc").alias("basket"), F.col("marca").alias("item"), (F.col("id_cliente") % 2).alias("grp"))
    return st.association_rules(b, ["grp"], "basket", "item", 0.003, 0.9)


MG = """mg AS (SELECT id_sucursal, greatest(-2.0,least(2.0,round((precio_unitario_neto-precio_compra_neto)/precio_unitario_neto,3)))::DOUBLE m, count(*) w FROM l WHERE id_documento='FCVTA' AND NOT anulado GROUP BY 1,2), ex AS (SELECT id_sucursal, m, unnest(range(w)) FROM mg)"""


def margins(s):
    v = s.ventas_costo.filter("id_documento = 'FCVTA' and not anulado")
    m = F.round((F.col("precio_unitario_neto") - F.col("precio_compra_neto")) / F.col("precio_unitario_neto"), 3)
    return v.groupBy("id_sucursal", F.greatest(F.lit(-2.0), F.least(F.lit(2.0), m)).alias("m")).agg(F.count(F.lit(1)).alias("w"))


@query("f15_weighted_percentiles", f="p05:6 p50:6 p95:6", sql=MG + " SELECT id_sucursal, quantile_cont(m,0.05) p05, quantile_cont(m,0.5) p50, quantile_cont(m,0.95) p95 FROM ex GROUP BY 1")
def _(s):
    return ordered.quantiles(shared(margins(s)), "m", {"p05": .05, "p50": .5, "p95": .95}, ["id_sucursal"], "w")


@query("f16_weighted_mad", f="mediana mad", sql=MG + ", md AS (SELECT id_sucursal, median(m) mediana FROM ex GROUP BY 1) SELECT id_sucursal, any_value(mediana) mediana, median(abs(m-mediana)) mad FROM ex JOIN md USING (id_sucursal) GROUP BY 1")
def _(s):
    return ordered.median_mad(shared(margins(s)), "m", ["id_sucursal"], "w")


@query("f17_nearest_rank", f="p50 p90", sql="d AS (SELECT id_sucursal, date_diff('day',fecha_pedido,fecha_entrega)::DOUBLE v FROM fv) SELECT id_sucursal, quantile_disc(v,0.5) p50, quantile_disc(v,0.9) p90 FROM d GROUP BY 1")
def _(s):
    d = s.ventas.groupBy("id_sucursal", F.datediff("fecha_entrega", "fecha_pedido").cast("double").alias("v")).agg(F.count(F.lit(1)).alias("w"))
    return ordered.quantiles(shared(d), "v", {"p50": .5, "p90": .9}, ["id_sucursal"], "w", nearest=True)


@query("f18_seasonal_naive", f="mape", sql=MS + ", n AS (SELECT *, lag(b,12) OVER (PARTITION BY generico ORDER BY paso) p FROM mp) SELECT generico, count(*) meses, avg(abs((b-p)/b))*100 mape FROM n WHERE p IS NOT NULL AND b<>0 GROUP BY 1")
def _(s):
    from pyspark.sql import Window as W
    n = monthly(s).withColumn("p", F.lag("b", 12).over(W.partitionBy("generico").orderBy("paso"))).filter("p is not null and b <> 0")
    return n.groupBy("generico").agg(F.count(F.lit(1)).alias("meses"), (F.avg(F.abs((F.col("b") - F.col("p")) / F.col("b"))) * 100).alias("mape"))
