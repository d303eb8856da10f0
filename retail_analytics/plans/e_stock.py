"""E: stock."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.functions.shape import slug
from retail_analytics.operators import calendar as cal, stock as st
from retail_analytics.plans.c0_calendar import DAYS
from retail_analytics.plans.registry import query
from retail_analytics.plans.sqltext import names, wide as W

BR = [f"NATION_{k}" for k in range(25)]
SNAP = """sn AS (SELECT s.id_articulo, a.generico, a.marca, a.des_articulo, d.des_sucursal sucursal, sum(cant_bultos) cant_bultos, sum(cantidad_total_htls) cant_htls
 FROM stock s JOIN art a USING (id_articulo) JOIN dep d USING (id_deposito) WHERE date_stock=(SELECT max(date_stock) FROM stock) GROUP BY ALL)"""
SALES = """vm AS (SELECT l.id_sucursal, sucursal, id_articulo, sum(cantidades_total) venta_bultos, sum(cantidad_total_htls) venta_htls FROM l
 WHERE fecha_comprobante>='2001-06-01' AND fecha_comprobante<'2001-07-01' GROUP BY ALL)"""


def snap(s):
    return st.snapshot(s.stock, s.articulo, s.deposito)


def hl(s):
    """Sales lines with the volume of the SKU."""
    return s.ventas.join(s.articulo.select("id_articulo", "factor_hectolitros"), "id_articulo", "left").withColumn(
        "cantidad_total_htls", F.col("cantidades_total") * F.col("factor_hectolitros"))


def sales(s):
    return st.month_sales(hl(s), s.sucursal, "2001-06-01", "2001-07-01")


@query("e1_snapshot", f="cant_bultos cant_htls", sql=SNAP + " SELECT * FROM sn")
def _(s):
    return snap(s)


@query("e2_month_sales", f="venta_bultos venta_htls", sql=SALES + " SELECT * FROM vm")
def _(s):
    return sales(s)


@query("e3_snapshot_matrix", f=names(BR, "s"), sql=SNAP + f" SELECT generico, marca, des_articulo, {W('sucursal', BR, {'s': 'cant_bultos'})} FROM sn GROUP BY 1,2,3")
def _(s):
    return st.matrix(snap(s), BR)


UNI = SNAP + ", " + SALES + """, un AS (SELECT sn.id_articulo, des_articulo, generico, marca, sn.sucursal, coalesce(cant_bultos,0) stock_bultos, coalesce(cant_htls,0) stock_htls, coalesce(venta_bultos,0) venta_bultos, coalesce(venta_htls,0) venta_htls
 FROM sn LEFT JOIN vm ON vm.sucursal=sn.sucursal AND vm.id_articulo=sn.id_articulo WHERE upper(generico)<>'LARGE'),
u AS (SELECT *, CASE WHEN stock_bultos<=0 AND venta_bultos<>0 THEN 'quiebre' WHEN stock_bultos>0 AND venta_bultos<=0 THEN 'dormant' ELSE 'normal' END estado FROM un WHERE stock_bultos<>0 OR venta_bultos<>0)"""


def universe(s):
    return st.stock_universe(snap(s), sales(s), [" large "])


@query("e4_stock_universe", f="stock_bultos stock_htls venta_bultos venta_htls", sql=UNI + " SELECT * FROM u")
def _(s):
    return universe(s)


@query("e4_unmatched_sales", sql=SNAP + ", " + SALES + """, v2 AS (SELECT sucursal, id_articulo FROM vm UNION ALL SELECT CASE WHEN id_articulo%3<>0 THEN sucursal END, id_articulo+1000000 FROM vm WHERE id_articulo%7=0)
SELECT count(*) sin_stock, count(*) FILTER (sucursal IS NULL) sin_sucursal FROM v2 WHERE NOT EXISTS (SELECT 1 FROM sn WHERE sn.sucursal=v2.sucursal AND sn.id_articulo=v2.id_articulo)""")
def _(s):
    v = sales(s)           # sales of SKUs that the stock doesn't know, some of unknown branches, are added
    more = v.filter("id_articulo % 7 = 0").withColumns({"sucursal": F.when(F.col("id_articulo") % 3 != 0, F.col("sucursal")), "id_articulo": F.col("id_articulo") + 1_000_000})
    return st.unmatched_sales(snap(s), v.unionByName(more))


B3 = ["NATION_1", "NATION_2", "NATION_3"]


@query("e5_wide_sheet", f=names([*B3, "total"], "stock", "venta", "pedido", "alcance"), sql=UNI + f""",
s4 AS (SELECT id_articulo, des_articulo, generico, marca, sucursal, sum(stock_bultos) stock, sum(venta_bultos) venta FROM u GROUP BY ALL UNION ALL SELECT id_articulo, des_articulo, generico, marca, 'total', sum(stock_bultos), sum(venta_bultos) FROM u GROUP BY ALL),
o AS (SELECT *, greatest(venta/17.0::DOUBLE*15-stock,0) pedido, stock/nullif(venta/17.0::DOUBLE,0) alcance FROM s4)
SELECT id_articulo, des_articulo, generico, marca, {W('sucursal', [*B3, 'total'], {'stock': 'stock', 'venta': 'venta', 'pedido': 'pedido'})}, {W('sucursal', [*B3, 'total'], {'alcance': 'alcance'}, zero=False)} FROM o GROUP BY 1,2,3,4""")
def _(s):
    return st.wide_sheet(universe(s), B3, 17)


@query("e6_days_elapsed", i="dias", sql=DAYS + " SELECT greatest(count(*) FILTER (habil AND fecha<='2001-06-20'),1) dias, (SELECT max(date_stock) FROM stock) corte FROM h WHERE mes='2001-06-01'")
def _(s):
    from retail_analytics.functions.grid import with_scalars
    r = cal.run_rate(s.spark, "2001-06-01", "2001-06-20", s.feriados, "2001-06-20")
    return with_scalars(r.select(F.greatest("dias_transcurridos", F.lit(1)).alias("dias")), s.stock.agg(F.max("date_stock").alias("corte")))


def view(s):
    r = cal.run_rate(s.spark, "2001-06-01", "2001-06-30", s.feriados, "2001-06-20")
    days = r.select(F.col("dias_habiles").alias("habiles_mes"), F.col("dias_transcurridos").alias("habiles_transcurridos"))
    return st.stock_out_view(s.stock, s.deposito, hl(s), s.articulo, s.sucursal, days, "2001-06-20")


VIEW = DAYS + """, dd AS (SELECT count(*) FILTER (habil) m, count(*) FILTER (habil AND fecha<='2001-06-20') t FROM h WHERE mes='2001-06-01'),
sh AS (SELECT d.id_sucursal, s.id_articulo, sum(cant_bultos) b, sum(cantidad_total_htls) hh FROM stock s JOIN dep d USING (id_deposito) WHERE date_stock=(SELECT max(date_stock) FROM stock) GROUP BY ALL),
vm AS (SELECT id_sucursal, id_articulo, sum(cantidades_total) b, sum(cantidad_total_htls) hh FROM l WHERE fecha_comprobante>='2001-06-01' AND fecha_comprobante<'2001-07-01' GROUP BY ALL),
ac AS (SELECT DISTINCT id_sucursal, id_articulo FROM fv WHERE fecha_comprobante>=DATE '2001-06-20'-INTERVAL 3 YEAR),
g AS (SELECT c.descripcion sucursal, sh.id_articulo, a.des_articulo, a.generico, a.marca, sh.b stock_hoy_bultos, sh.hh stock_hoy_htls, coalesce(vm.b,0) venta_mes_bultos, coalesce(vm.hh,0) venta_mes_htls, dd.t dias_habiles_transcurridos, coalesce(vm.b,0)/nullif(dd.t,0) venta_diaria_bultos, dd.m
 FROM sh LEFT JOIN vm USING (id_sucursal, id_articulo) JOIN suc c USING (id_sucursal) JOIN art a USING (id_articulo) CROSS JOIN dd
 WHERE sh.id_articulo IN (SELECT id_articulo FROM ac) AND (sh.b<>0 OR EXISTS (SELECT 1 FROM ac WHERE ac.id_sucursal=sh.id_sucursal AND ac.id_articulo=sh.id_articulo))),
vq AS (SELECT * EXCLUDE (m), venta_diaria_bultos*m tendencia_bultos, greatest(venta_diaria_bultos*15-stock_hoy_bultos,0) pedido_sugerido_bultos, CASE WHEN stock_hoy_bultos<=0 THEN 'ROJO' WHEN venta_diaria_bultos IS NULL OR venta_diaria_bultos<=0 THEN 'VERDE'
 WHEN stock_hoy_bultos/venta_diaria_bultos<15 THEN 'ROJO' WHEN stock_hoy_bultos/venta_diaria_bultos<=30 THEN 'AMARILLO' ELSE 'VERDE' END estado_semaforo FROM g)"""


@query("e7_stock_out_view", f="stock_hoy_bultos stock_hoy_htls venta_mes_bultos venta_mes_htls venta_diaria_bultos tendencia_bultos pedido_sugerido_bultos", sql=VIEW + " SELECT * FROM vq")
def _(s):
    return view(s)


REACH = "count(*) pares, sum(stock_hoy_bultos) stock, sum(venta_mes_bultos) venta_mes, sum(venta_diaria_bultos) venta_diaria, sum(pedido_sugerido_bultos) pedido, sum(stock_hoy_bultos)/nullif(sum(venta_diaria_bultos),0) alcance_dias"
FR = "stock venta_mes venta_diaria pedido alcance_dias"


@query("e8_reach_by_branch_category", f=FR, sql=VIEW + f" SELECT sucursal, generico, {REACH} FROM vq GROUP BY 1,2")
def _(s):
    return st.reach_by(view(s), ["sucursal", "generico"])


@query("e19_view_by_light", f=FR, sql=VIEW + f" SELECT estado_semaforo, {REACH} FROM vq GROUP BY 1")
def _(s):
    return st.reach_by(view(s), ["estado_semaforo"])


# every 31st SKU has no category here, so that the relabelling has something to do
VAL = SNAP + """, s9 AS (SELECT * REPLACE (CASE WHEN id_articulo%31<>0 THEN generico END AS generico) FROM sn),
va AS (SELECT s.id_articulo, s.des_articulo, coalesce(s.generico,'SIN CLASIFICAR') generico, coalesce(s.marca,'SIN MARCA') marca, s.sucursal, coalesce(cant_bultos,0) cant_bultos, coalesce(precio_base,0) precio_base, coalesce(precio_final,0) precio_final,
 coalesce(cant_bultos,0)*coalesce(precio_base,0) valorizado, coalesce(cant_bultos,0)*coalesce(precio_final,0) valorizado_final FROM s9 s LEFT JOIN precios USING (id_articulo) WHERE s.generico IS NULL OR s.generico<>'LARGE')"""


def snap9(s):
    return snap(s).withColumn("generico", F.when(F.col("id_articulo") % 31 != 0, F.col("generico")))


def valued(s):
    return st.valuation(snap9(s), s.precios, ["LARGE"])


@query("e9_valuation", f="cant_bultos precio_base precio_final valorizado valorizado_final", sql=VAL + " SELECT * FROM va")
def _(s):
    return valued(s)


@query("e10_article_valuation_matrix", f=names(BR, "bultos", "valor") + " total_bultos total_valor", sql=VAL + f""" SELECT id_articulo, des_articulo, generico, marca, {W('sucursal', BR, {'bultos': 'cant_bultos', 'valor': 'valorizado'})},
sum(cant_bultos) total_bultos, sum(valorizado) total_valor FROM va GROUP BY 1,2,3,4""")
def _(s):
    return st.valuation_matrix(valued(s), BR)


@query("e10_category_valuation_matrix", f=names(BR, "valor") + " total", sql=VAL + f", w AS (SELECT generico, {W('sucursal', BR, {'valor': 'valorizado'})} FROM va GROUP BY 1) SELECT *, {'+'.join('valor_' + slug(b) for b in BR)} total FROM w")
def _(s):
    return st.category_matrix(valued(s), BR)


@query("e11_branch_valuation", f="bultos valorizado pct_capital valor_por_bulto", sql=VAL + """ SELECT sucursal, sum(cant_bultos) bultos, sum(valorizado) valorizado, count(DISTINCT CASE WHEN cant_bultos<>0 THEN id_articulo END) articulos_con_stock,
sum(valorizado)/(SELECT sum(valorizado) FROM va) pct_capital, coalesce(sum(valorizado)/nullif(sum(cant_bultos),0),0) valor_por_bulto FROM va GROUP BY 1""")
def _(s):
    return st.branch_summary(valued(s))


@query("e12_capital_abc", f="bultos valorizado pct_total pct_acumulado", digits=6, sql=VAL + """, t AS (SELECT id_articulo, des_articulo, generico, marca, sum(cant_bultos) bultos, sum(valorizado) valorizado FROM va GROUP BY ALL HAVING sum(valorizado)>0),
c AS (SELECT *, valorizado/sum(valorizado) OVER () pct_total, sum(valorizado) OVER (ORDER BY round(valorizado,6) DESC, id_articulo ROWS UNBOUNDED PRECEDING)/sum(valorizado) OVER () pct_acumulado FROM t)
SELECT *, CASE WHEN pct_acumulado<=0.80+1e-9 THEN 'A' WHEN pct_acumulado<=0.95+1e-9 THEN 'B' ELSE 'C' END clase FROM c""")
def _(s):
    return st.capital_abc(valued(s))


@query("e13_control_frames", f="bultos valorizado", sql=VAL + """ SELECT 'sin_precio' control, id_articulo, des_articulo, generico, NULL::VARCHAR sucursal, sum(cant_bultos) bultos, sum(valorizado) valorizado FROM va WHERE precio_base=0 AND cant_bultos<>0 GROUP BY ALL
UNION ALL SELECT 'negativo', id_articulo, des_articulo, generico, sucursal, sum(cant_bultos), sum(valorizado) FROM va WHERE cant_bultos<0 GROUP BY ALL
UNION ALL SELECT 'sin_clasificar', id_articulo, des_articulo, generico, NULL, sum(cant_bultos), sum(valorizado) FROM va WHERE generico='SIN CLASIFICAR' GROUP BY ALL
UNION ALL SELECT 'excluido', NULL, NULL, generico, NULL, sum(cant_bultos), NULL FROM s9 WHERE generico='LARGE' GROUP BY ALL""")
def _(s):
    return st.control_frames(snap9(s), valued(s), ["LARGE"])


DEP = [("central", 0), ("norte", 5), ("sur", 105)]


@query("e14_listed_snapshot", f=names([d for d, _ in DEP], "d"), sql=f"""x AS (SELECT id_articulo, c, cant_bultos FROM stock JOIN (VALUES ('central',0),('norte',5),('sur',105)) d(c,id_deposito) USING (id_deposito)
 WHERE date_stock=(SELECT max(date_stock) FROM stock) AND id_articulo IN (SELECT id_articulo FROM art WHERE generico='PROMO')) SELECT id_articulo, {W('c', [d for d, _ in DEP], {'d': 'cant_bultos'})} FROM x GROUP BY 1""")
def _(s):
    dep = s.spark.createDataFrame([(i, n) for n, i in DEP], "id_deposito long, columna string")
    return st.listed_snapshot(s.stock, s.articulo.filter("generico = 'PROMO'"), dep, [d for d, _ in DEP])


@query("e14_all_articles_snapshot", f=names([d for d, _ in DEP], "d"), sql=f"""x AS (SELECT id_articulo, c, cant_bultos FROM stock JOIN (VALUES ('central',0),('norte',5),('sur',105)) d(c,id_deposito) USING (id_deposito)
 WHERE date_stock=(SELECT max(date_stock) FROM stock) AND id_articulo IN (SELECT id_articulo FROM art)) SELECT id_articulo, {W('c', [d for d, _ in DEP], {'d': 'cant_bultos'})} FROM x GROUP BY 1""")
def _(s):
    dep = s.spark.createDataFrame([(i, n) for n, i in DEP], "id_deposito long, columna string")
    return st.listed_snapshot(s.stock, s.articulo, dep, [d for d, _ in DEP])


# supplier list derived from the SKUs: same text, extended, foreign words, reordered words
def supplier(s):
    k, n = F.col("p_partkey"), F.col("p_name")
    desc = (F.when(k % 5 == 0, n).when(k % 5 == 1, F.concat(n, F.lit(" ñ 12 pack"))).when(k % 5 == 2, "blue bolt gear x")
            .when(k % 5 == 3, F.concat(F.split(n, " ")[1], F.lit("-special"))).otherwise("zzz qqq"))
    return s.raw("part").select(k.alias("cod"), desc.alias("desc"))


def dual(s):
    """SKU descriptions where every 44th says DUAL."""
    return s.articulo.withColumn("des_articulo", F.when(F.col("id_articulo") % 44 == 4, F.lit("dual kit")).otherwise(F.col("des_articulo")))


SUPP = """sp AS (SELECT p_partkey cod, CASE p_partkey%5 WHEN 0 THEN p_name WHEN 1 THEN p_name||' ñ 12 pack' WHEN 2 THEN 'blue bolt gear x' WHEN 3 THEN split_part(p_name,' ',2)||'-special' ELSE 'zzz qqq' END "desc" FROM part),
tk AS (SELECT id_articulo, d des_articulo, list_sort(list_distinct(list_filter(string_split_regex(regexp_replace(replace(upper(d),'Ñ','N'),'[^A-Z0-9]',' ','g'),'\\s+'), lambda x: length(x)>=2))) a
 FROM (SELECT id_articulo, CASE WHEN id_articulo%44=4 THEN 'dual kit' ELSE des_articulo END d FROM art)),
st AS (SELECT cod, "desc", list_sort(list_distinct(list_filter(string_split_regex(regexp_replace(replace(upper("desc"),'Ñ','N'),'[^A-Z0-9]',' ','g'),'\\s+'), lambda x: length(x)>=2))) t FROM sp),
cd AS (SELECT cod, t, esquema, TRY_CAST(p||cod::VARCHAR AS BIGINT) id_articulo FROM st CROSS JOIN (VALUES ('40','40'),('400','400'),('pelado','')) k(esquema,p)),
jj AS (SELECT c.cod, c.esquema, c.id_articulo, k.des_articulo, coalesce(len(list_intersect(c.t,k.a))::DOUBLE/nullif(len(list_distinct(list_concat(c.t,k.a))),0),0) j FROM cd c JOIN tk k USING (id_articulo)),
bs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cod ORDER BY j DESC, id_articulo DESC, esquema DESC, des_articulo DESC) r FROM jj) WHERE r=1 AND (j>0 OR contains(upper(des_articulo),'DUAL'))),
mt AS (SELECT st.cod, st."desc", st.t, bs.id_articulo, bs.esquema, bs.j similitud FROM st LEFT JOIN bs USING (cod))"""


@query("e15_code_match", f="similitud", sql=SUPP + ' SELECT cod, "desc", id_articulo, esquema, similitud FROM mt')
def _(s):
    return st.match_codes(supplier(s), dual(s))


@query("e15_closest_article", f="closest_sim", sql=SUPP + """, un AS (SELECT * FROM mt WHERE id_articulo IS NULL),
ds AS (SELECT a, min(id_articulo) i, arg_min(des_articulo,id_articulo) d FROM tk GROUP BY a), qs AS (SELECT DISTINCT t FROM un),
pr AS (SELECT t, i, d, len(list_intersect(t,a))::DOUBLE/len(list_distinct(list_concat(t,a))) j FROM qs CROSS JOIN ds), bp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY j DESC, i) r FROM pr WHERE j>0) WHERE r=1)
SELECT un.cod, un."desc", bp.i closest_id, bp.d closest_desc, coalesce(bp.j,0) closest_sim FROM un LEFT JOIN bp ON un.t=bp.t""")
def _(s):
    m = st.match_codes(supplier(s), dual(s)).filter("id_articulo is null").select("cod", "desc")
    return st.closest_article(m, dual(s))


@query("e15_match_checks", sql=SUPP + """ SELECT count(id_articulo) con_match, count(*) FILTER (id_articulo IS NULL) sin_match, count(DISTINCT id_articulo) ids, (SELECT count(*) FROM sp) total,
count(id_articulo)+count(*) FILTER (id_articulo IS NULL)=(SELECT count(*) FROM sp) cierra, count(DISTINCT id_articulo)=count(id_articulo) sin_repetidos FROM mt""")
def _(s):
    sup = supplier(s)
    return st.match_checks(sup, st.match_codes(sup, dual(s)))


COV = """cut AS (SELECT max(date_stock) d FROM stock WHERE date_stock<='2001-06-30'), sk AS (SELECT d.id_sucursal, s.id_articulo, sum(cant_bultos) stock_bultos FROM stock s JOIN dep d USING (id_deposito) WHERE date_stock=(SELECT d FROM cut) GROUP BY ALL),
fl AS (SELECT * FROM fv WHERE id_documento='FCVTA' AND NOT anulado AND fecha_comprobante<=(SELECT d FROM cut)),
ve AS (SELECT id_sucursal, id_articulo, sum(cantidades_total) bultos_60d, count(DISTINCT fecha_comprobante) ndias FROM fl WHERE fecha_comprobante>(SELECT d FROM cut)-60 GROUP BY ALL),
vi AS (SELECT id_articulo, sum(cantidades_total) bultos_12m FROM fl WHERE fecha_comprobante>(SELECT d FROM cut)-365 GROUP BY ALL),
co AS (SELECT id_articulo, avg(precio_compra_neto) costo FROM l WHERE fecha_comprobante>='2000-07-01' AND precio_compra_neto>0 AND id_documento='FCVTA' AND NOT anulado GROUP BY 1),
pa AS (SELECT sk.id_sucursal, sk.id_articulo, c.descripcion sucursal, a.des_articulo articulo, a.generico, a.marca, stock_bultos, coalesce(bultos_60d,0) bultos_60d, coalesce(ndias,0) ndias, coalesce(bultos_12m,0) bultos_12m, costo
 FROM sk JOIN suc c USING (id_sucursal) LEFT JOIN art a USING (id_articulo) LEFT JOIN ve USING (id_sucursal, id_articulo) LEFT JOIN vi USING (id_articulo) LEFT JOIN co USING (id_articulo) WHERE stock_bultos<>0 OR coalesce(bultos_60d,0)>0),
cb0 AS (SELECT *, CASE WHEN bultos_60d>0 AND ndias>0 THEN bultos_60d/ndias END velocidad FROM pa), cb1 AS (SELECT *, CASE WHEN velocidad>0 THEN stock_bultos/velocidad END dias_cobertura, stock_bultos*costo valor_costo, generico IS NOT NULL AND generico<>'LARGE' es_mercaderia FROM cb0),
cb AS (SELECT *, CASE WHEN velocidad>0 AND dias_cobertura<7 THEN 'QUIEBRE' WHEN velocidad>0 AND dias_cobertura>90 THEN 'SOBRESTOCK' WHEN velocidad>0 THEN 'NORMAL' WHEN bultos_12m>0 THEN 'STOCK MUERTO' ELSE 'SIN MOVIMIENTO' END estado,
 CASE WHEN stock_bultos<0 THEN 'stock negativo' WHEN costo IS NULL THEN 'sin costo' ELSE '' END nota FROM cb1)"""


def cover(s):
    p = st.cover_pairs(s.stock, s.deposito, s.ventas, s.ventas_costo, s.articulo, s.sucursal, "2001-06-30", "2000-07-01")
    return st.cover(p, ["LARGE"])


@query("e16_days_of_cover", f="stock_bultos bultos_60d bultos_12m costo velocidad dias_cobertura valor_costo", sql=COV + " SELECT * FROM cb")
def _(s):
    return cover(s)


@query("e17_cover_summary", digits=2, f="stock_bultos bultos_60d velocidad dias_cobertura valor_costo peso", i="orden", sql=COV + """ SELECT estado, sucursal, id_articulo, stock_bultos, bultos_60d, velocidad, dias_cobertura, valor_costo,
list_position(['QUIEBRE','SOBRESTOCK','STOCK MUERTO','NORMAL','SIN MOVIMIENTO'],estado) orden, CASE WHEN estado='QUIEBRE' THEN coalesce(velocidad,0) ELSE coalesce(valor_costo,0) END peso FROM cb WHERE es_mercaderia
UNION ALL SELECT 'TOTAL','TOTAL GENERAL',NULL,sum(stock_bultos),sum(bultos_60d),sum(velocidad),sum(stock_bultos)/nullif(sum(velocidad),0),sum(valor_costo),99,NULL FROM cb WHERE es_mercaderia""")
def _(s):
    return st.cover_summary(cover(s))


# SKUs that were never sold are added to the stock, with known attributes
DEAD = """st2 AS (SELECT * FROM stock UNION ALL SELECT date_stock, id_deposito, id_articulo+1000000, cant_bultos, cantidad_total_htls FROM stock WHERE id_articulo%50=0), ar2 AS (SELECT id_articulo, des_articulo, generico, marca FROM art UNION ALL SELECT id_articulo+1000000, des_articulo, generico, marca FROM art WHERE id_articulo%50=0),
as0 AS (SELECT id_articulo, sum(cant_bultos) stock_bultos, count(DISTINCT CASE WHEN cant_bultos>0 THEN id_deposito END) depositos FROM st2 WHERE date_stock=(SELECT max(date_stock) FROM stock) GROUP BY 1 HAVING sum(cant_bultos)>0),
lf AS (SELECT id_articulo, max(fecha_comprobante) ultima_venta FROM fv WHERE NOT anulado AND id_documento IN ('FCVTA','DVVTA') AND fecha_comprobante<='2001-06-30' GROUP BY 1),
pp AS (SELECT id_articulo, sum(subtotal_neto)/nullif(sum(cantidades_total),0) precio_neto_medio FROM fv WHERE NOT anulado AND id_documento='FCVTA' GROUP BY 1),
dj AS (SELECT s.*, a.des_articulo, a.generico, a.marca, ultima_venta, date_diff('day',ultima_venta,DATE '2001-06-30') dias_sin_venta, precio_neto_medio, stock_bultos*precio_neto_medio valor_neto, CASE WHEN ultima_venta IS NULL THEN 'Nunca vendido' ELSE 'Sin rotacion' END estado
 FROM as0 s LEFT JOIN ar2 a USING (id_articulo) LEFT JOIN lf USING (id_articulo) LEFT JOIN pp USING (id_articulo) WHERE ultima_venta IS NULL OR date_diff('day',ultima_venta,DATE '2001-06-30')>90)"""


def dead(s, filtered):
    live = s.ventas.filter("not anulado")
    life = live.filter("id_documento in ('FCVTA','DVVTA') and fecha_comprobante <= '2001-06-30'").groupBy("id_articulo").agg(F.max("fecha_comprobante").alias("ultima_venta"))
    price = live.filter("id_documento = 'FCVTA'").groupBy("id_articulo").agg(
        F.try_divide(F.sum("subtotal_neto"), F.sum("cantidades_total")).alias("precio_neto_medio"))
    def with_unsold(df):
        return df.unionByName(df.filter("id_articulo % 50 = 0").withColumn("id_articulo", F.col("id_articulo") + 1_000_000))
    return st.dead_stock(st.article_stock(with_unsold(s.stock)), life, with_unsold(s.articulo), price, "2001-06-30", ["LARGE"], filtered=filtered)


@query("e18_dead_stock", f="stock_bultos precio_neto_medio valor_neto", sql=DEAD + " SELECT * FROM dj WHERE generico IS NOT NULL AND generico<>'LARGE'")
def _(s):
    return dead(s, True)


@query("e18_dead_stock_naive", f="stock_bultos precio_neto_medio valor_neto", sql=DEAD + " SELECT * FROM dj")
def _(s):
    return dead(s, False)
