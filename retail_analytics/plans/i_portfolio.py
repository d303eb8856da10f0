"""I: portfolio and channels."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.operators import filters as fl, portfolio as pf, stats as st
from retail_analytics.plans.f_stats import FRULE
from retail_analytics.plans.registry import query

CUR, LONG, CUT, PREV = "2000-06-28", "1999-06-28", "2001-06-30", "1999-06-26"
NON = ["LARGE"]
LP = "lp AS (SELECT * FROM l WHERE id_documento IN ('FCVTA','DVVTA') AND NOT anulado AND generico IS NOT NULL AND generico NOT IN ('LARGE'))"
SM = LP + f", sm AS (SELECT id_articulo, date_trunc('month',fecha_comprobante)::DATE mes, fecha_comprobante>='{CUR}' ventana_actual, sum(cantidades_total) bultos, sum(subtotal_neto) neto FROM lp WHERE fecha_comprobante BETWEEN '{LONG}' AND '{CUT}' GROUP BY ALL)"


def lines(s):
    return fl.working_lines(s.lineas, NON, keep_null_category=False)


def months(s):
    return pf.sku_months(lines(s), CUR, LONG, CUT)


@query("i1_sku_months", f="bultos neto", sql=SM + " SELECT * FROM sm")
def _(s):
    return months(s)


ABC = SM + """, cu AS (SELECT id_articulo, sum(neto) neto_12m, sum(bultos) bultos_12m, count(DISTINCT mes) meses_con_venta_12m FROM sm WHERE ventana_actual GROUP BY 1),
ab AS (SELECT *, neto_12m/sum(neto_12m) OVER () participacion, sum(neto_12m) OVER (ORDER BY round(neto_12m,6) DESC, id_articulo ROWS UNBOUNDED PRECEDING)/sum(neto_12m) OVER () participacion_acum FROM cu),
ac AS (SELECT *, CASE WHEN participacion_acum<=0.8+1e-9 THEN 'A' WHEN participacion_acum<=0.95+1e-9 THEN 'B' ELSE 'C' END clase_abc FROM ab)"""


@query("i2_abc", f="neto_12m participacion participacion_acum", digits=7, sql=ABC + " SELECT id_articulo, neto_12m, participacion, participacion_acum, clase_abc FROM ac")
def _(s):
    cur = months(s).filter("ventana_actual").groupBy("id_articulo").agg(F.sum("neto").alias("neto_12m"))
    return pf.abc(cur, "neto_12m")


CV = """, mv AS (SELECT id_articulo, mes, sum(bultos) b FROM sm WHERE mes BETWEEN '1999-07-01' AND '2001-06-01' GROUP BY 1,2), mf AS (SELECT id_articulo, min(mes) a FROM mv GROUP BY 1),
mg AS (SELECT id_articulo, unnest(generate_series(a, DATE '2001-06-01', INTERVAL 1 MONTH))::DATE mes FROM mf), mz AS (SELECT mg.id_articulo, mg.mes, coalesce(b,0) b FROM mg LEFT JOIN mv USING (id_articulo, mes)),
cv AS (SELECT id_articulo, count(*) meses_ventana, count(*) FILTER (b>0) meses_con_venta, CASE WHEN count(*)>=2 THEN stddev_pop(b)/abs(nullif(avg(b),0)) END cv FROM mz GROUP BY 1)"""


@query("i3_monthly_cv", f="cv", sql=SM + CV + " SELECT *, CASE WHEN cv IS NULL THEN 'N/D' WHEN cv<0.5 THEN 'X' WHEN cv<1 THEN 'Y' ELSE 'Z' END clase_xyz FROM cv")
def _(s):
    m = months(s).filter("mes between '1999-07-01' and '2001-06-01'")
    return pf.monthly_cv(m, "2001-06-01").withColumn("clase_xyz", pf.xyz(F.col("cv")))


TAB = ABC + CV + """, ax AS (SELECT ac.*, coalesce(meses_ventana,0) meses_ventana, coalesce(meses_con_venta,0) meses_con_venta, cv, CASE WHEN cv IS NULL THEN 'N/D' WHEN cv<0.5 THEN 'X' WHEN cv<1 THEN 'Y' ELSE 'Z' END clase_xyz, a.des_articulo, a.generico, a.marca
 FROM ac LEFT JOIN cv USING (id_articulo) LEFT JOIN art a USING (id_articulo)), tb AS (SELECT *, clase_abc||CASE WHEN clase_xyz='N/D' THEN ' ' ELSE '' END||clase_xyz celda FROM ax)"""


def table(s):
    return pf.abc_xyz(months(s), s.articulo, ("1999-07-01", "2001-06-01"))


@query("i4_abc_xyz", f="neto_12m bultos_12m participacion participacion_acum cv", digits=6, sql=TAB + " SELECT * FROM tb")
def _(s):
    return table(s)


@query("i4_nine_box", f="neto pct_skus pct_neto", sql=TAB + " SELECT celda, clase_abc, clase_xyz, count(*) skus, sum(neto_12m) neto, count(*)/sum(count(*)) OVER () pct_skus, sum(neto_12m)/sum(sum(neto_12m)) OVER () pct_neto FROM tb GROUP BY 1,2,3")
def _(s):
    return pf.nine_box(table(s))


CC0 = LP + f", cg AS (SELECT coalesce(des_subcanal_mkt,'SIN SUBCANAL') subcanal, generico, sum(cantidades_total) bultos, sum(subtotal_neto) neto FROM lp WHERE fecha_comprobante BETWEEN '{CUR}' AND '{CUT}' GROUP BY 1,2)"
TAIL = CC0 + """, w AS (SELECT subcanal, sum(bultos)/(SELECT sum(bultos) FROM cg) p FROM cg GROUP BY 1), tl AS (SELECT CASE WHEN p<0.06 THEN 'OTROS SUBCANALES' ELSE subcanal END subcanal, generico, bultos FROM cg JOIN w USING (subcanal)),
ct AS (SELECT subcanal, generico, greatest(sum(bultos),0) v FROM tl GROUP BY 1,2)"""
CATS = ["ECONOMY", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def channel(s):
    return pf.channel_category(fl.dates(lines(s), CUR, CUT))


def tail(s):
    return pf.collapse_tail(channel(s), "subcanal", "bultos", 0.06, "OTROS SUBCANALES")


@query("i5_contingency", f=" ".join(f"v_{c}" for c in CATS) + " total", sql=TAIL + f", f AS (SELECT unnest([subcanal,'TOTAL GENERAL']) subcanal, generico, v FROM ct) SELECT subcanal, {', '.join(f'''coalesce(sum(v) FILTER (generico='{c}'),0) v_{c}''' for c in CATS)}, sum(v) total FROM f GROUP BY 1 HAVING sum(v)>0")
def _(s):
    return pf.contingency(tail(s), "subcanal", "generico", "bultos", CATS)


@query("i5_residual_table", f=" ".join(f"r_{c}" for c in CATS), sql=TAIL + f""", rr AS (SELECT subcanal, sum(v) r FROM ct GROUP BY 1), cc AS (SELECT generico, sum(v) c FROM ct GROUP BY 1), x AS (SELECT rr.subcanal, cc.generico, coalesce(v,0) o, r*c/(SELECT sum(v) FROM ct) e FROM rr CROSS JOIN cc LEFT JOIN ct ON ct.subcanal=rr.subcanal AND ct.generico=cc.generico),
y AS (SELECT subcanal, generico, (o-e)/sqrt(e) z FROM x UNION ALL SELECT 'TOTAL GENERAL (chi2)', generico, pow((o-e)/sqrt(e),2) FROM x) SELECT subcanal, {', '.join(f'''sum(z) FILTER (generico='{c}') r_{c}''' for c in CATS)} FROM y GROUP BY 1""")
def _(s):
    return pf.residual_table(st.chi_square(tail(s), "subcanal", "generico", "bultos"), "subcanal", "generico", CATS)


FY = "bultos_actual bultos_previo neto_actual delta_bultos pct_bultos pct_clientes bultos_cliente_actual bultos_cliente_previo pct_bultos_cliente"


@query("i6_channel_yoy", f=FY, sql=LP + f""", t AS (SELECT coalesce(des_subcanal_mkt,'SIN SUBCANAL') subcanal, coalesce(sum(cantidades_total) FILTER (fecha_comprobante>='{CUR}'),0) bultos_actual, coalesce(sum(cantidades_total) FILTER (fecha_comprobante<'{CUR}'),0) bultos_previo,
 count(DISTINCT id_cliente) FILTER (fecha_comprobante>='{CUR}') clientes_actual, count(DISTINCT id_cliente) FILTER (fecha_comprobante<'{CUR}') clientes_previo, coalesce(sum(subtotal_neto) FILTER (fecha_comprobante>='{CUR}'),0) neto_actual FROM lp WHERE fecha_comprobante BETWEEN '{PREV}' AND '{CUT}' GROUP BY 1),
u AS (SELECT *, bultos_actual-bultos_previo delta_bultos, (bultos_actual-bultos_previo)/nullif(bultos_previo,0) pct_bultos, clientes_actual-clientes_previo delta_clientes, (clientes_actual-clientes_previo)/nullif(clientes_previo,0) pct_clientes, bultos_actual/nullif(clientes_actual,0) bultos_cliente_actual, bultos_previo/nullif(clientes_previo,0) bultos_cliente_previo FROM t)
SELECT *, (bultos_cliente_actual-bultos_cliente_previo)/nullif(bultos_cliente_previo,0) pct_bultos_cliente FROM u""")
def _(s):
    return pf.channel_yoy(lines(s), CUR, PREV, CUT)


PEN = LP + """, cl AS (SELECT id_cliente, coalesce(des_subcanal_mkt,'SIN SUBCANAL') subcanal, generico, sum(subtotal_neto) neto, sum(cantidades_total) bultos FROM lp WHERE fecha_comprobante BETWEEN '2000-12-28' AND '2001-06-30' GROUP BY 1,2,3 HAVING sum(cantidades_total)>0),
ba AS (SELECT subcanal, count(DISTINCT id_cliente) clientes_activos, count(DISTINCT id_cliente)<20 muestra_chica FROM cl GROUP BY 1), ce AS (SELECT subcanal, generico, count(DISTINCT id_cliente) compradores, median(neto) neto_mediano, sum(neto) neto_total FROM cl GROUP BY 1,2),
p0 AS (SELECT ba.subcanal, g.generico, clientes_activos, muestra_chica, coalesce(compradores,0) compradores, clientes_activos-coalesce(compradores,0) no_compradores, coalesce(compradores,0)/clientes_activos penetracion, CASE WHEN compradores>=5 AND NOT muestra_chica THEN neto_mediano END neto_mediano, coalesce(neto_total,0) neto_total
 FROM ba CROSS JOIN (SELECT DISTINCT generico FROM cl) g LEFT JOIN ce ON ce.subcanal=ba.subcanal AND ce.generico=g.generico), pe AS (SELECT *, no_compradores*neto_mediano oportunidad FROM p0)"""
FP = "penetracion neto_mediano neto_total oportunidad"


def cc(s):
    return pf.client_category(fl.dates(lines(s), "2000-12-28", CUT))


@query("i7_penetration", digits=6, f=FP, sql=PEN + " SELECT * FROM pe")
def _(s):
    return pf.penetration(cc(s))


@query("i7_white_space", digits=6, f=FP, sql=PEN + " SELECT *, row_number() OVER (ORDER BY neto_mediano DESC, subcanal, generico) rank_conversion, rank() OVER (ORDER BY oportunidad DESC) rank_oportunidad FROM pe WHERE oportunidad>0 AND no_compradores>0")
def _(s):
    return pf.white_space(pf.penetration(cc(s)))


@query("i8_client_gaps", digits=6, f="penetracion valor_estimado", sql=PEN + """ SELECT c.id_cliente, c.subcanal, pe.generico, penetracion, neto_mediano valor_estimado FROM (SELECT DISTINCT id_cliente, subcanal FROM cl) c JOIN pe ON pe.subcanal=c.subcanal
WHERE penetracion>=0.3 AND neto_mediano IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cl x WHERE x.id_cliente=c.id_cliente AND x.generico=pe.generico)""")
def _(s):
    c = cc(s)
    return pf.client_gaps(c, pf.penetration(c))


def _rules(item, level, sup, lift):
    return f"""bs AS (SELECT DISTINCT l.id_sucursal||'|'||id_documento||'|'||letra||'|'||serie||'|'||nro_doc factura, coalesce(v.id_fuerza_ventas,-1) fv, {item} item FROM l LEFT JOIN ven v ON v.id_vendedor=l.id_vendedor AND v.id_sucursal=l.id_sucursal
 WHERE NOT anulado AND id_documento='FCVTA' AND generico IS NOT NULL AND generico<>'LARGE'), nb AS (SELECT fv, count(DISTINCT factura) n FROM bs GROUP BY 1), nk AS (SELECT * FROM nb), f AS (SELECT fv, item, count(*) f FROM bs GROUP BY 1,2),
k AS (SELECT bs.* FROM bs JOIN f USING (fv, item) JOIN nb USING (fv) WHERE f>={sup}*n), pr AS (SELECT a.fv, a.item antecedente, b.item consecuente, count(*) baskets FROM k a JOIN k b ON a.fv=b.fv AND a.factura=b.factura AND a.item<>b.item GROUP BY 1,2,3),
ru AS (SELECT CASE pr.fv WHEN 1 THEN 'FV1 - Preventa' WHEN 4 THEN 'FV4 - Autoventa' ELSE 'Sin fuerza de ventas asignada' END fuerza, '{level}' nivel, antecedente, consecuente, baskets/nk.n soporte, fa.f/nk.n soporte_antecedente, fb.f/nk.n soporte_consecuente, baskets/fa.f confianza, (baskets/fa.f)/(fb.f/nk.n) lift,
 baskets/nk.n-(fa.f/nk.n)*(fb.f/nk.n) leverage, CASE WHEN baskets<fa.f THEN (1-fb.f/nk.n)/(1-baskets/fa.f) END conviccion, baskets, nb.n facturas_fuerza, nb.n<500 muestra_chica FROM pr JOIN nk USING (fv) JOIN nb USING (fv) JOIN f fa ON fa.fv=pr.fv AND fa.item=antecedente JOIN f fb ON fb.fv=pr.fv AND fb.item=consecuente)
SELECT * FROM ru WHERE soporte>={sup} AND lift>={lift}"""


def bask(s):
    return pf.baskets(fl.working_lines(s.lineas, NON, False, documents=["FCVTA"]), s.vendedor)


@query("i9_category_rules", f=FRULE, digits=6, sql=_rules("generico", "Generico", 0.01, 0.5))
def _(s):
    return pf.basket_rules(bask(s), "generico", "Generico", min_lift=0.5)


@query("i9_brand_rules", f=FRULE, digits=6, sql=_rules("marca", "Marca", 0.002, 0.8))
def _(s):
    return pf.basket_rules(bask(s), "marca", "Marca", min_support=0.002, min_lift=0.8)


# the cut of the life cycle lies early, so that some SKUs are new
LC = LP + ", lc AS (SELECT id_articulo, min(fecha_comprobante) primera_venta, max(fecha_comprobante) ultima_venta, sum(cantidades_total) bultos_historia, sum(subtotal_neto) neto_historia FROM lp WHERE fecha_comprobante<='1995-12-31' GROUP BY 1)"


def life(s):
    return pf.life_cycle(lines(s), "1995-12-31")


@query("i10_life_cycle", f="bultos_historia neto_historia", sql=LC + " SELECT * FROM lc")
def _(s):
    return life(s)


LAU = LC + ", la AS (SELECT lc.*, a.des_articulo, a.generico, a.marca, (date_diff('day',primera_venta,DATE '1995-12-31')+1)/30.4375::DOUBLE meses_vivo FROM lc JOIN art a USING (id_articulo) WHERE primera_venta>DATE '1995-08-31')"


@query("i10_launches", f="bultos_historia neto_historia meses_vivo bultos_por_mes neto_por_mes", sql=LAU + " SELECT *, bultos_historia/meses_vivo bultos_por_mes, neto_historia/meses_vivo neto_por_mes FROM la")
def _(s):
    return pf.launches(life(s), s.articulo, "1995-12-31", NON, 4)


@query("i10_ramp", f="bultos bultos_por_sku", i="skus_expuestos", sql=LAU + """, mm AS (SELECT id_articulo, date_trunc('month',fecha_comprobante)::DATE mes, sum(cantidades_total) b FROM lp WHERE fecha_comprobante<='1996-06-30' GROUP BY 1,2), r AS (SELECT id_articulo, date_trunc('month',primera_venta)::DATE x FROM la),
v AS (SELECT date_diff('month',x,mes) mes_n, sum(b) bultos, count(DISTINCT id_articulo) skus_con_venta FROM mm JOIN r USING (id_articulo) WHERE mes>=x GROUP BY 1) SELECT v.*, (SELECT count(*) FROM r WHERE date_diff('month',x,DATE '1996-06-01')>=mes_n) skus_expuestos,
bultos/(SELECT count(*) FROM r WHERE date_diff('month',x,DATE '1996-06-01')>=mes_n) bultos_por_sku FROM v""")
def _(s):
    m = lines(s).filter("fecha_comprobante <= '1996-06-30'").groupBy("id_articulo", F.trunc("fecha_comprobante", "MM").alias("mes")).agg(F.sum("cantidades_total").alias("bultos"))
    return pf.ramp(m, pf.launches(life(s), s.articulo, "1995-12-31", NON, 4), "1996-06-01")


@query("i11_channel_category", f="bultos neto", sql=CC0 + " SELECT * FROM cg")
def _(s):
    return channel(s)


@query("i11_client_category", f="bultos neto", sql=PEN + " SELECT * FROM cl")
def _(s):
    return cc(s)


