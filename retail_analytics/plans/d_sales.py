"""D: sales reports."""
from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from retail_analytics.functions.shape import slug
from retail_analytics.operators import calendar as cal, coverage as cv, filters as fl, sales as sl
from retail_analytics.plans.b_filters import SUP_CTE, ZONES, supervisor_map
from retail_analytics.plans.c0_calendar import DAYS
from retail_analytics.plans.registry import query
from retail_analytics.plans.sqltext import COBL, JUNE, M0, M1, cov, names, wide as W

S3 = "sum(cantidades_total) cantidad, sum(cantidad_total_htls) cantidad_htls, sum(subtotal_neto) monto"
F3 = "cantidad cantidad_htls monto"
M3 = ("cantidad", "cantidad_htls", "monto")


def rng(s, a=M0, b=M1):
    return fl.dates(s.lineas, a, b)


@query("d1_daily_sales", f=F3, sql=f"SELECT sucursal, generico, marca, fecha_comprobante fecha, {S3} FROM l WHERE {JUNE} GROUP BY ALL")
def _(s):
    return sl.by_date(rng(s), ["sucursal", "generico", "marca"])


@query("d2_daily_sales_by_route", f=F3 + " descuentos", sql=f"SELECT sucursal, generico, marca, fecha_comprobante fecha, id_ruta, {S3}, sum(descuentos) descuentos FROM l WHERE {JUNE} AND generico IN ('PROMO','SMALL') GROUP BY ALL")
def _(s):
    return sl.by_date(fl.in_values(rng(s), "generico", ["PROMO", "SMALL"]), ["sucursal", "generico", "marca", "id_ruta"], (*M3, "descuentos"))


@query("d3_same_months_last_year", f=F3, sql=f"SELECT sucursal, generico, marca, {S3} FROM l WHERE fecha_comprobante BETWEEN '2000-05-01' AND '2000-06-30' GROUP BY ALL")
def _(s):
    a, b = cal.same_months_last_year(date(2001, 5, 10), date(2001, 6, 20))
    return sl.summary(rng(s, str(a), str(b)), ["sucursal", "generico", "marca"])


@query("d4_sales_summary", f=F3, sql=f"SELECT sucursal, generico, marca, {S3} FROM l GROUP BY ALL")
def _(s):
    return sl.summary(s.lineas, ["sucursal", "generico", "marca"])


SPLIT = "CASE WHEN generico='PROMO' AND marca IN ('Brand#1','Brand#2') THEN marca WHEN generico='PROMO' THEN 'PROMO (sin Brand#1, Brand#2)' ELSE generico END generico"
BASE_W = "generico IS NOT NULL AND generico IN ('PROMO','SMALL','LARGE') AND NOT (generico IN ('SMALL') AND id_documento='PRVTA')"
ARGS = dict(categories=["PROMO", "SMALL", "LARGE"], no_quotes=["SMALL"], splits={"PROMO": ["Brand#1", "Brand#2"]})


@query("d5_monthly_base", f="cantidad", sql=f"SELECT sucursal, {SPLIT}, id_ruta, sum(cantidades_total) cantidad FROM l WHERE {JUNE} AND {BASE_W} GROUP BY ALL")
def _(s):
    return sl.monthly_base(rng(s), **ARGS)


@query("d6_daily_base", f="cantidad", sql=f"SELECT sucursal, {SPLIT}, id_ruta, fecha_comprobante fecha, sum(cantidades_total) cantidad FROM l WHERE {JUNE} AND {BASE_W} GROUP BY ALL")
def _(s):
    return sl.monthly_base(rng(s), daily=True, **ARGS)


@query("d6_previous_month_base", f="cantidad", sql=f"SELECT sucursal, {SPLIT}, id_ruta, sum(cantidades_total) cantidad FROM l WHERE fecha_comprobante BETWEEN '2001-05-01' AND '2001-05-31' AND {BASE_W} GROUP BY ALL")
def _(s):
    a, b = cal.previous_month(date(2001, 6, 20))
    return sl.monthly_base(rng(s, str(a), str(b)), **ARGS)


@query("d7_client_articles", f="cantidad", sql=f"""SELECT sucursal, id_ruta, id_vendedor, des_vendedor vendedor, id_cliente, coalesce(fantasia,razon_social) cliente, marca, calibre, id_articulo, des_articulo, sum(cantidades_total) cantidad
FROM l LEFT JOIN ven v USING (id_vendedor, id_sucursal) WHERE fecha_comprobante BETWEEN '2001-01-01' AND '2001-06-30' AND id_articulo<100 GROUP BY ALL HAVING sum(cantidades_total)>0""")
def _(s):
    return sl.client_articles(rng(s, "2001-01-01"), s.vendedor, list(range(100)))


@query("d8_brand_history", f="cantidad descuentos", i="anio mes", sql="""SELECT year(fecha_comprobante) anio, month(fecha_comprobante) mes, marca, id_lista_precio, sum(cantidades_total) cantidad, sum(descuentos) descuentos
FROM l WHERE generico='PROMO' AND id_documento<>'PRVTA' GROUP BY ALL""")
def _(s):
    return sl.history(s.lineas.filter("generico = 'PROMO'"), ["marca", "id_lista_precio"])


@query("d8_quote_history", f="cantidad", i="anio mes", sql="SELECT year(fecha_comprobante) anio, month(fecha_comprobante) mes, sum(cantidades_total) cantidad FROM l WHERE generico='PROMO' AND id_documento='PRVTA' GROUP BY ALL")
def _(s):
    return sl.history(s.lineas.filter("generico = 'PROMO'"), [], quotes=True, measures=("cantidad",))


@query("d9_brand_volume", f="cantidad", sql="SELECT marca, sum(cantidades_total) cantidad FROM l WHERE generico='PROMO' AND id_sucursal=1 AND fecha_comprobante BETWEEN '2001-01-01' AND '2001-06-30' GROUP BY 1")
def _(s):
    return sl.summary(rng(s, "2001-01-01").filter("generico = 'PROMO' and id_sucursal = 1"), ["marca"], ("cantidad",))


@query("d10_rep_client", f="bultos", sql="SELECT des_vendedor vendedor, id_cliente, sum(cantidades_total) bultos FROM l JOIN ven v USING (id_vendedor, id_sucursal) WHERE marca='Brand#3' AND fecha_comprobante BETWEEN '2001-01-01' AND '2001-06-30' GROUP BY ALL")
def _(s):
    return sl.rep_client(rng(s, "2001-01-01").filter("marca = 'Brand#3'"), s.vendedor)


FLAV = "CASE WHEN des_articulo ILIKE '%NEGR%' THEN 'NEGRA' WHEN des_articulo ILIKE '%ROJA%' THEN 'ROJA' WHEN des_articulo ILIKE '%BLANC%' OR des_articulo ILIKE '%RUBIA%' OR des_articulo ILIKE '%RUB %' OR des_articulo ILIKE '%BCA%' THEN 'BLANCA (rubia)' ELSE 'OTRO' END"


@query("d11_client_size", f="cantidad", sql="SELECT id_cliente, id_sucursal, sucursal, id_ruta, calibre, sum(cantidades_total) cantidad FROM l WHERE marca='Brand#3' AND fecha_comprobante BETWEEN '2001-01-01' AND '2001-06-30' GROUP BY ALL")
def _(s):
    return sl.summary(rng(s, "2001-01-01").filter("marca = 'Brand#3'"), ["id_cliente", "id_sucursal", "sucursal", "id_ruta", "calibre"], ("cantidad",))


@query("d11_client_flavour_size_month", f="cantidad", sql=f"SELECT id_cliente, id_sucursal, {FLAV} sabor, calibre, strftime(fecha_comprobante,'%Y-%m') mes, sum(cantidades_total) cantidad FROM l WHERE marca='Brand#3' AND fecha_comprobante BETWEEN '2001-01-01' AND '2001-06-30' GROUP BY ALL")
def _(s):
    return sl.summary(rng(s, "2001-01-01").filter("marca = 'Brand#3'"), ["id_cliente", "id_sucursal", fl.flavour().alias("sabor"), "calibre",
                      F.date_format("fecha_comprobante", "yyyy-MM").alias("mes")], ("cantidad",))


@query("d12_article_daily", f="bultos", sql="SELECT id_articulo, id_sucursal, fecha_comprobante fecha, sum(cantidades_total) bultos FROM fv GROUP BY 1,2,3")
def _(s):
    return sl.daily_articles(s.ventas)


@query("d12_article_daily_report", f="bultos", i="dias_con_venta", sql=DAYS + """, v AS (SELECT fecha_comprobante fecha, sum(cantidades_total) b FROM fv WHERE fecha_comprobante BETWEEN '2001-01-01' AND '2001-06-30' GROUP BY 1),
j AS (SELECT d.fecha, CASE WHEN b>0 THEN b END bultos FROM d LEFT JOIN v USING (fecha) WHERE d.fecha<='2001-06-30')
SELECT strftime(fecha,'%Y-%m-%d') dia, dayofweek(fecha)=0 domingo, bultos, NULL dias_con_venta FROM j UNION ALL SELECT 'TOTAL', false, coalesce(sum(bultos),0), count(bultos) FROM j""")
def _(s):
    v = fl.dates(s.ventas, "2001-01-01", M1)
    v = v.groupBy(F.col("fecha_comprobante").alias("fecha")).agg(F.sum("cantidades_total").alias("bultos"))
    return sl.daily_report(v, cal.days(s.spark, "2001-01-01", M1, s.feriados))


def _d13(force, route, who):
    return f"""SELECT l.id_sucursal||' - '||sucursal sucursal, fecha_comprobante fecha, v.des_vendedor vendedor, {route} ruta, {who} des_ruta, marca, generico, id_articulo, des_articulo, sum(cantidades_total) cantidad
FROM l LEFT JOIN ven v ON l.id_vendedor=v.id_vendedor AND l.id_sucursal=v.id_sucursal AND v.id_fuerza_ventas={force} WHERE {JUNE} AND NOT anulado GROUP BY ALL"""


@query("d13_descriptive_fv1", f="cantidad", sql=_d13(1, "id_ruta", "des_personal_fv1"))
def _(s):
    return sl.descriptive(rng(s), s.vendedor, 1)


@query("d13_descriptive_fv4", f="cantidad", sql=_d13(4, "id_ruta_fv4", "des_personal_fv4"))
def _(s):
    return sl.descriptive(rng(s), s.vendedor, 4)


H14 = """c14 AS (SELECT id_cliente, id_sucursal FROM cli),
h14 AS (SELECT id_cliente, id_sucursal, coalesce(nullif(trim(fantasia),''),nullif(trim(razon_social),''),id_cliente::VARCHAR) nombre_cliente, generico, {key} row_key,
 strftime(fecha_comprobante,'%Y-%m') mes, sum({qty}) bultos FROM l SEMI JOIN c14 USING (id_cliente, id_sucursal) WHERE fecha_comprobante BETWEEN '2000-07-01' AND '2001-06-30' AND {where} GROUP BY ALL)"""


@query("d14_client_history", f="bultos", sql=H14.format(key="id_articulo||' - '||des_articulo", qty="cantidades_con_cargo", where="TRUE") + " SELECT * FROM h14")
def _(s):
    return sl.client_history(rng(s, "2000-07-01"), s.cliente, charged_only=True)


@query("d14_client_brand_history", f="bultos", sql=H14.format(key="marca", qty="cantidades_total", where="marca IN ('Brand#1','Brand#2')") + " SELECT * FROM h14")
def _(s):
    return sl.client_history(rng(s, "2000-07-01"), s.cliente, brands=["Brand#1", "Brand#2"])


@query("d15_brand_universe", sql="SELECT DISTINCT generico, marca FROM art WHERE generico IN ('PROMO','SMALL') AND marca IS NOT NULL AND marca<>''")
def _(s):
    return sl.brand_universe(s.articulo, ["PROMO", "SMALL"])


M16 = [f"2000-{m:02d}" for m in range(7, 13)] + [f"2001-{m:02d}" for m in range(1, 7)]


def _d16():
    ms = W("mes", M16, {"m": "bultos"})
    tot = "+".join(f"m_{slug(m)}" for m in M16)
    y = [f"{'+'.join('m_' + slug(m) for m in M16 if m[:4] == yy)} total_{yy}" for yy in ("2000", "2001")]
    return H14.format(key="marca", qty="cantidades_total", where="TRUE") + f""",
s AS (SELECT generico, row_key marca, mes, bultos FROM h14 UNION ALL SELECT DISTINCT generico, marca, NULL, 0 FROM art WHERE generico IN ('PROMO','SMALL','LARGE')),
w AS (SELECT 'marca' nivel, generico, marca, {ms} FROM s GROUP BY 2,3 UNION ALL SELECT 'generico', generico, NULL, {ms} FROM s GROUP BY 2 UNION ALL SELECT 'general', NULL, NULL, {ms} FROM s),
t AS (SELECT *, {tot} total, {', '.join(y)} FROM w), b AS (SELECT generico, total b FROM t WHERE nivel='generico')
SELECT t.*, row_number() OVER (ORDER BY nivel='general', b.b DESC NULLS LAST, t.generico, nivel='generico', total DESC, marca) orden FROM t LEFT JOIN b ON t.generico=b.generico"""


@query("d16_grouped_history", f=names(M16, "m") + " total total_2000 total_2001", i="orden", sql=_d16())
def _(s):
    h = sl.client_history(rng(s, "2000-07-01"), s.cliente, by_brand=True)
    return sl.grouped_history(h, M16, sl.brand_universe(s.articulo, ["PROMO", "SMALL", "LARGE"]))


QCATS = ["PROMO", "SMALL", "LARGE"]
Q17 = "q17 AS (SELECT sucursal, generico, year(fecha_comprobante) anio, quarter(fecha_comprobante) trimestre, sum(cantidades_total) cantidad FROM l WHERE generico IN ('PROMO','SMALL','LARGE') GROUP BY ALL)"


@query("d17_quarterly_sales", f="cantidad", i="anio trimestre", sql=Q17 + " SELECT * FROM q17")
def _(s):
    return sl.quarterly(s.lineas, QCATS)


@query("d18_quarter_dashboard", f="total pct_categoria pct_multi anio_anterior variacion", sql=Q17 + """,
t AS (SELECT sucursal, coalesce(sum(cantidad) FILTER (anio=2001 AND trimestre=2),0) total, coalesce(sum(cantidad) FILTER (anio=2001 AND trimestre=2 AND generico='PROMO'),0) c,
 coalesce(sum(cantidad) FILTER (anio=2001 AND trimestre=2 AND generico IN ('SMALL','LARGE')),0) m, coalesce(sum(cantidad) FILTER (anio=2000 AND trimestre=2),0) anio_anterior FROM q17 GROUP BY 1)
SELECT sucursal, total, c/nullif(total,0) pct_categoria, m/nullif(total,0) pct_multi, anio_anterior, (total-anio_anterior)/nullif(anio_anterior,0) variacion FROM t""")
def _(s):
    return sl.quarter_dashboard(sl.quarterly(s.lineas, QCATS), 2001, 2, "PROMO", ["SMALL", "LARGE"])


SUBD = "sd AS (SELECT id_cliente, coalesce(fantasia,'') fantasia, coalesce(razon_social,'') razon_social, generico, marca, des_articulo, sum(cantidades_total) cantidad FROM l WHERE id_ruta=9 AND fecha_comprobante BETWEEN '2001-01-01' AND '2001-06-30' GROUP BY ALL)"
LEVELS = ["id_cliente", "fantasia", "razon_social", "generico", "marca"]


@query("d19_sub_distributors", f="cantidad", sql=SUBD + " SELECT * FROM sd")
def _(s):
    return sl.sub_distributors(rng(s, "2001-01-01"), 9)


@query("d19_sub_distributor_origin", f="bultos htls", sql="""SELECT CASE WHEN id_lista_precio=1 THEN 'CASA CENTRAL' ELSE sucursal END origen, razon_social, fantasia, generico, marca, sum(cantidades_total) bultos, sum(cantidad_total_htls) htls
FROM l WHERE fecha_comprobante BETWEEN '2001-04-01' AND '2001-06-30' AND generico IN ('PROMO','SMALL') AND (id_lista_precio=1 OR (id_lista_precio=2 AND sucursal IN ('NATION_3','NATION_5'))) GROUP BY ALL""")
def _(s):
    return sl.sub_distributor_origin(rng(s, "2001-04-01"), ["PROMO", "SMALL"], 1, 2, ["NATION_3", "NATION_5"], "CASA CENTRAL")


def _d20():
    parts = []
    for i, lv in enumerate(LEVELS):
        sel = ", ".join(c if j <= i else f"NULL::VARCHAR {c}" for j, c in enumerate(LEVELS))
        parts.append(f"SELECT '{lv}' nivel, {sel}, sum(cantidad) cantidad FROM sd GROUP BY ALL")
    return SUBD + " " + " UNION ALL ".join(parts)


@query("d20_hierarchy_totals", f="cantidad", sql=_d20())
def _(s):
    return sl.hierarchy_totals(sl.sub_distributors(rng(s, "2001-01-01"), 9), LEVELS, "cantidad")


DAYS21 = [f"2001-06-{d:02d}" for d in range(1, 21)]
D20 = "fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-20'"


def factor(s):
    return cal.run_rate(s.spark, M0, M1, s.feriados, "2001-06-20")


FACT = DAYS + ", fa AS (SELECT count(*) FILTER (habil)::DOUBLE/count(*) FILTER (habil AND fecha<='2001-06-20') factor FROM h WHERE mes='2001-06-01')"
D21F = [f"d_{slug(d)}" for d in DAYS21] + ("total_marca monto_marca desc_marca tend_marca cant_generico monto_generico desc_generico tend_generico cupo_generico cupo_marca cob_generico cob_marca "
        "cupo_cob_generico cupo_cob_marca mmaa tend_vs_cupo_generico cob_vs_cupo_generico desc_pct_generico tend_vs_cupo_marca var_mmaa cob_vs_cupo_marca desc_pct_marca").split()


def _d21(measure, col):
    first = "cant_generico tend_generico monto_generico desc_generico desc_pct_generico cob_generico cupo_cob_generico cob_vs_cupo_generico cupo_generico tend_vs_cupo_generico".split()
    days = ", ".join(f"coalesce(sum({col}) FILTER (fecha_comprobante='{d}'),0) d_{slug(d)}" for d in DAYS21)
    qg = "q.cupo" if measure == "cantidad" else "CASE WHEN bg>0 THEN q.cupo*cant_generico/bg END"
    qm = "qm.cupo" if measure == "cantidad" else "CASE WHEN b>0 THEN qm.cupo*total_marca/b END"
    rest = "sucursal generico marca orden total_marca monto_marca desc_marca tend_marca cupo_marca cob_marca cupo_cob_marca mmaa tend_vs_cupo_marca var_mmaa cob_vs_cupo_marca desc_pct_marca".split() + [f"d_{slug(d)}" for d in DAYS21]
    return FACT + f""", {COBL}, v AS (SELECT sucursal, generico, marca, {days}, sum({col}) total_marca, sum(cantidades_total) b, sum(subtotal_neto) monto_marca, sum(descuentos) desc_marca FROM l WHERE {D20} GROUP BY 1,2,3),
a AS (SELECT DISTINCT generico, marca FROM art), g AS (SELECT s.descripcion sucursal, a.generico, a.marca, {', '.join(f'coalesce(d_{slug(d)},0) d_{slug(d)}' for d in DAYS21)},
 coalesce(total_marca,0) total_marca, coalesce(b,0) b, coalesce(monto_marca,0) monto_marca, coalesce(desc_marca,0) desc_marca FROM suc s CROSS JOIN a LEFT JOIN v ON v.sucursal=s.descripcion AND v.generico=a.generico AND v.marca=a.marca),
t AS (SELECT g.*, total_marca*factor tend_marca, sum(total_marca) OVER c cant_generico, sum(b) OVER c bg, sum(monto_marca) OVER c monto_generico, sum(desc_marca) OVER c desc_generico, sum(total_marca) OVER c * factor tend_generico,
 row_number() OVER (PARTITION BY sucursal, generico ORDER BY monto_marca DESC, marca) orden FROM g CROSS JOIN fa WINDOW c AS (PARTITION BY sucursal, generico)),
q AS (SELECT * FROM (SELECT des_s sucursal, generico concepto, sum(cupo) cupo FROM (SELECT *, regexp_replace(sucursal,'^\\d+ - ','') des_s FROM cupos) z WHERE periodo='2001-06' GROUP BY 1,2 UNION ALL SELECT descripcion, 'Brand#3', 50.0+id_sucursal FROM suc) WHERE cupo>0),
cq AS (SELECT * FROM (SELECT descripcion sucursal, coalesce(marca,generico) concepto, sum(cupo) cupo FROM cupos_cob JOIN suc USING (id_sucursal) GROUP BY 1,2) WHERE cupo>0),
cg AS (SELECT ds_sucursal, generico, clientes::DOUBLE cob FROM {cov('ds_sucursal, generico', "(SELECT * FROM cobl WHERE periodo='2001-06-01' AND id_fuerza_ventas=1)")}),
cm AS (SELECT ds_sucursal, marca, clientes::DOUBLE cob FROM {cov('ds_sucursal, marca', "(SELECT * FROM cobl WHERE periodo='2001-06-01' AND id_fuerza_ventas=1)")}),
ly AS (SELECT sucursal, generico, marca, sum({col}) mmaa FROM l WHERE fecha_comprobante BETWEEN '2000-06-01' AND '2000-06-30' GROUP BY ALL HAVING sum({col})>0),
u AS (SELECT t.*, {qg} cupo_generico, {qm} cupo_marca, cg.cob cob_generico, cm.cob cob_marca, k.cupo cupo_cob_generico, km.cupo cupo_cob_marca, ly.mmaa FROM t LEFT JOIN q ON q.sucursal=t.sucursal AND q.concepto=t.generico
 LEFT JOIN q qm ON qm.sucursal=t.sucursal AND qm.concepto=t.marca LEFT JOIN cq k ON k.sucursal=t.sucursal AND k.concepto=t.generico LEFT JOIN cq km ON km.sucursal=t.sucursal AND km.concepto=t.marca
 LEFT JOIN cg ON cg.ds_sucursal=t.sucursal AND cg.generico=t.generico LEFT JOIN cm ON cm.ds_sucursal=t.sucursal AND cm.marca=t.marca LEFT JOIN ly ON ly.sucursal=t.sucursal AND ly.generico=t.generico AND ly.marca=t.marca),
x AS (SELECT *, tend_generico/nullif(cupo_generico,0) tend_vs_cupo_generico, cob_generico/nullif(cupo_cob_generico,0) cob_vs_cupo_generico, nullif(desc_generico,0)/nullif(monto_generico,0) desc_pct_generico,
 tend_marca/nullif(cupo_marca,0) tend_vs_cupo_marca, total_marca/mmaa var_mmaa, cob_marca/nullif(cupo_cob_marca,0) cob_vs_cupo_marca, nullif(desc_marca,0)/nullif(monto_marca,0) desc_pct_marca FROM u)
SELECT {', '.join(rest)}, {', '.join(f'CASE WHEN orden=1 THEN {c} END {c}' for c in first)} FROM x"""


def matrix(s, measure):
    d = sl.by_date(rng(s, M0, "2001-06-20"), ["sucursal", "generico", "marca"], ("cantidad", "cantidad_htls", "monto", "descuentos"))
    br = s.sucursal.select(F.col("descripcion").alias("sucursal"))
    bare = F.regexp_replace("sucursal", r"^\d+ - ", "").alias("sucursal")
    q = s.cupos.filter("periodo = '2001-06'").groupBy(bare, F.col("generico").alias("concepto")).agg(F.sum("cupo").alias("cupo"))
    q = q.unionByName(s.sucursal.select(F.col("descripcion").alias("sucursal"), F.lit("Brand#3").alias("concepto"), (F.col("id_sucursal") + 50).cast("double").alias("cupo")))
    cq = fl.repair_swapped(s.cupos_cobertura).join(s.sucursal, "id_sucursal").groupBy(F.col("descripcion").alias("sucursal"), "concepto").agg(F.sum("cupo").alias("cupo"))
    june = cv.force_lines(rng(s)).filter("id_fuerza_ventas = 1").withColumnRenamed("ds_sucursal", "sucursal")
    cg = cv.coverage(june, ["sucursal", "generico"], names=("cobertura", "v"))
    cm = cv.coverage(june, ["sucursal", "marca"], names=("cobertura", "v"))
    ly = sl.summary(rng(s, "2000-06-01", "2000-06-30"), ["sucursal", "generico", "marca"], (measure,)).withColumnRenamed(measure, "mmaa")
    return sl.daily_matrix(d, br, s.articulo.select("generico", "marca").distinct(), DAYS21, factor(s), measure, q, cg, cm, cq, ly)


@query("d21_daily_matrix", f=" ".join(D21F), i="orden", sql=_d21("cantidad", "cantidades_total"))
def _(s):
    return matrix(s, "cantidad")


@query("d24_daily_matrix_volume", f=" ".join(D21F), i="orden", sql=_d21("cantidad_htls", "cantidad_total_htls"))
def _(s):
    return matrix(s, "cantidad_htls")


@query("d22_compact_sales", f="cantidad monto tend_marca cant_generico tend_generico monto_generico", i="orden", sql=FACT + f""", v AS (SELECT sucursal, generico, marca, sum(cantidades_total) cantidad, sum(subtotal_neto) monto FROM l WHERE {D20} GROUP BY ALL),
t AS (SELECT v.*, cantidad*factor tend_marca, factor, row_number() OVER (PARTITION BY sucursal, generico ORDER BY monto DESC, marca) orden, sum(cantidad) OVER c cg, sum(monto) OVER c mg FROM v CROSS JOIN fa WINDOW c AS (PARTITION BY sucursal, generico))
SELECT sucursal, generico, marca, cantidad, monto, tend_marca, orden, CASE WHEN orden=1 THEN cg END cant_generico, CASE WHEN orden=1 THEN cg*factor END tend_generico, CASE WHEN orden=1 THEN mg END monto_generico FROM t""")
def _(s):
    return sl.compact(sl.summary(rng(s, M0, "2001-06-20"), ["sucursal", "generico", "marca"], ("cantidad", "monto")), factor(s))


@query("d23_complete_grid", f="cantidad", sql=f"""v AS (SELECT sucursal, generico, marca, sum(cantidades_total) cantidad FROM l WHERE {D20} GROUP BY ALL)
SELECT s.descripcion sucursal, a.generico, a.marca, coalesce(v.cantidad,0) cantidad FROM suc s CROSS JOIN (SELECT DISTINCT generico, marca FROM art) a LEFT JOIN v ON v.sucursal=s.descripcion AND v.generico=a.generico AND v.marca=a.marca""")
def _(s):
    v = sl.summary(rng(s, M0, "2001-06-20"), ["sucursal", "generico", "marca"], ("cantidad",))
    return sl.complete(v, s.sucursal.select(F.col("descripcion").alias("sucursal")), s.articulo.select("generico", "marca").distinct(), ["cantidad"])


@query("d25_quotas", f="cupo", sql="SELECT regexp_replace(sucursal,'^\\d+ - ','') sucursal, id_ruta, generico, sum(cupo) cupo FROM cupos WHERE periodo='2001-06' GROUP BY ALL")
def _(s):
    return sl.quotas(s.cupos, "2001-06")


@query("d25_provider_quotas", f="cupo", sql="SELECT regexp_replace(sucursal,'^\\d+ - ','') sucursal, id_ruta, generico, sum(cupo) cupo FROM cupos WHERE periodo='2001-06' AND proveedor='PROV 1' GROUP BY ALL")
def _(s):
    return sl.quotas(s.cupos, "2001-06", "PROV 1")


WIN = {"n1": ("2001-06-18", "2001-06-18"), "n2": ("2001-06-16", "2001-06-16"), "mes": (M0, "2001-06-20"), "ma": ("2001-05-01", "2001-05-31"), "aa": ("2000-06-01", "2000-06-30")}
F26 = "vtas_n1 vtas_n2 total_ventas mmaa ma tendencia objetivo tend_vs_obj"


def _d26():
    w = {k: f"fecha_comprobante BETWEEN '{a}' AND '{b}'" for k, (a, b) in WIN.items()}
    c = ", ".join(f"coalesce(sum(cantidades_total) FILTER ({w[k]}),0) {n}" for n, k in (("vtas_n1", "n1"), ("vtas_n2", "n2"), ("total_ventas", "mes"), ("mmaa", "aa"), ("ma", "ma")))
    return FACT + f""", v AS (SELECT sucursal, generico, {c} FROM l WHERE {' OR '.join(w.values())} GROUP BY 1,2),
g AS (SELECT * FROM (SELECT DISTINCT sucursal FROM v) CROSS JOIN (SELECT DISTINCT generico FROM v WHERE generico IS NOT NULL)),
q AS (SELECT regexp_replace(sucursal,'^\\d+ - ','') sucursal, generico, sum(cupo) objetivo FROM cupos WHERE periodo='2001-06' GROUP BY 1,2),
t AS (SELECT g.sucursal, g.generico, {', '.join(f'coalesce({n},0) {n}' for n in F26.split()[:5])}, coalesce(total_ventas,0)*factor tendencia, objetivo FROM g LEFT JOIN v USING (sucursal, generico) LEFT JOIN q USING (sucursal, generico) CROSS JOIN fa)
SELECT *, CASE WHEN objetivo>0 THEN tendencia/objetivo END tend_vs_obj FROM t"""


def summary26(s):
    q = sl.quotas(s.cupos, "2001-06").groupBy("sucursal", "generico").agg(F.sum("cupo").alias("cupo"))
    return sl.monthly_summary(s.lineas, WIN, q, factor(s))


@query("d26_monthly_summary", f=F26, sql=_d26())
def _(s):
    return summary26(s)


FAM = ["NATION_1", "NATION_2", "NATION_3"]


@query("d27_sheet_subtotals", f="total_ventas ma", i="orden", sql=f"""d AS (SELECT * FROM ({'WITH ' + _d26()})),
p AS (SELECT *, CASE WHEN sucursal IN ('NATION_1','NATION_2','NATION_3') THEN 1 WHEN sucursal='NATION_9' THEN 3 ELSE 2 END p FROM d)
SELECT sucursal, generico, total_ventas, ma, CASE p WHEN 1 THEN list_position(['NATION_1','NATION_2','NATION_3'],sucursal) WHEN 2 THEN 200 ELSE 400 END orden FROM p
UNION ALL SELECT 'SUBTOTAL CASA CENTRAL', generico, sum(total_ventas), sum(ma), 100 FROM p WHERE p=1 GROUP BY generico UNION ALL SELECT 'SUCURSALES SIN DIRECTA', generico, sum(total_ventas), sum(ma), 300 FROM p WHERE p=2 GROUP BY generico
UNION ALL SELECT 'TOTAL SIN SMK', generico, sum(total_ventas), sum(ma), 500 FROM p GROUP BY generico""")
def _(s):
    d = summary26(s).select("sucursal", "generico", "total_ventas", "ma")
    return sl.sheet_with_subtotals(d, FAM, "NATION_9", ["total_ventas", "ma"])


def view(s):
    h = s.feriados.select(F.col("fecha").alias("_h"), F.lit(True).alias("_x"))
    lines = s.lineas.join(h, F.col("fecha_comprobante") == F.col("_h"), "left")
    lines = lines.withColumn("habil", (F.dayofweek("fecha_comprobante") != 1) & F.col("_x").isNull())
    c = cal.month_calendar(s.spark, "1995-01-01", "2001-12-31", s.feriados, "2001-06-20")
    return sl.summary_view(lines, s.cupos, c, "2001-06-20", ZONES, "NATION_1", 8, ["PROMO"], [z[0] for z in ZONES])


ZC = ("CASE WHEN id_ruta=8 AND sucursal<>'NATION_1' THEN 'DIRECTA SUCURSALES' WHEN sucursal='NATION_1' AND id_ruta IN (2,3) THEN 'VALLE' WHEN sucursal='NATION_1' AND id_ruta=5 THEN 'PUNA' "
      "WHEN sucursal='NATION_4' AND id_ruta IN (0,9) THEN 'SUBDIST' ELSE sucursal END")
VIEW = f"""cd AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))::DATE f),
dias AS (SELECT date_trunc('month',f)::DATE periodo, count(*) FILTER (w) tot, count(*) FILTER (w AND f<='2001-06-20') tr FROM (SELECT f, dayofweek(f)<>0 AND f NOT IN (SELECT fecha FROM feriados) w FROM cd) GROUP BY 1),
ba AS (SELECT date_trunc('month',fecha_comprobante)::DATE periodo, {ZC} sucursal, generico, marca, fecha_comprobante fecha, cantidades_total q, cantidad_total_htls h FROM l WHERE generico IS NOT NULL AND sucursal IS NOT NULL AND NOT (generico='PROMO' AND id_documento='PRVTA')),
dt AS (SELECT periodo, sucursal, generico, marca, fecha, sum(q) q, sum(h) h FROM ba WHERE fecha<=least(DATE '2001-06-20', last_day(periodo)) AND dayofweek(fecha)<>0 AND fecha NOT IN (SELECT fecha FROM feriados) GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY periodo, sucursal, generico, marca ORDER BY fecha DESC) rn FROM dt),
ag AS (SELECT a.*, coalesce(r1.q,0) n1, coalesce(r1.h,0) n1h, coalesce(r2.q,0) n2, coalesce(r2.h,0) n2h FROM (SELECT periodo, sucursal, generico, marca, sum(q) tq, sum(h) th FROM ba GROUP BY ALL) a
 LEFT JOIN rk r1 ON r1.periodo=a.periodo AND r1.sucursal=a.sucursal AND r1.generico=a.generico AND r1.marca=a.marca AND r1.rn=1 LEFT JOIN rk r2 ON r2.periodo=a.periodo AND r2.sucursal=a.sucursal AND r2.generico=a.generico AND r2.marca=a.marca AND r2.rn=2),
cu AS (SELECT (periodo||'-01')::DATE periodo, {ZC} sucursal, generico, sum(cupo) objetivo FROM (SELECT * REPLACE (regexp_replace(sucursal,'^\\d+ - ','') AS sucursal) FROM cupos) GROUP BY ALL),
j AS (SELECT a.*, y.tq yq, y.th yh, m.tq mq, m.th mh, c.objetivo, d.tot, d.tr, c.objetivo*(sum(a.th) OVER w/nullif(sum(a.tq) OVER w,0)) oh FROM ag a JOIN dias d ON d.periodo=a.periodo
 LEFT JOIN ag y ON y.periodo=a.periodo-INTERVAL 1 YEAR AND y.sucursal=a.sucursal AND y.generico=a.generico AND y.marca=a.marca LEFT JOIN ag m ON m.periodo=a.periodo-INTERVAL 1 MONTH AND m.sucursal=a.sucursal AND m.generico=a.generico AND m.marca=a.marca
 LEFT JOIN cu c ON c.periodo=a.periodo AND c.sucursal=a.sucursal AND c.generico=a.generico WINDOW w AS (PARTITION BY a.periodo, a.sucursal, a.generico)),
lo AS (SELECT periodo, sucursal, generico, marca, 'BULTOS' medida, n1 vtas_n1, n2 vtas_n2, tq total_ventas, yq mmaa, mq ma, objetivo o, tot, tr FROM j UNION ALL SELECT periodo, sucursal, generico, marca, 'HTLS', n1h, n2h, th, yh, mh, oh, tot, tr FROM j),
lt AS (SELECT *, total_ventas*(tot::DOUBLE/nullif(tr,0)) tendencia, row_number() OVER (PARTITION BY periodo, sucursal, generico, medida ORDER BY marca NULLS LAST) rn FROM lo),
vw AS (SELECT strftime(periodo,'%Y-%m') periodo, sucursal, CASE WHEN sucursal IN ('NATION_1','VALLE','PUNA','SUBDIST') THEN 'CASA CENTRAL' WHEN sucursal='DIRECTA SUCURSALES' THEN 'DIRECTA' ELSE 'INTERIOR' END grupo, generico, marca, medida, vtas_n1, vtas_n2, total_ventas, tendencia, mmaa, ma,
 CASE WHEN rn=1 THEN o END objetivo, CASE WHEN rn=1 THEN sum(tendencia) OVER (PARTITION BY periodo, sucursal, generico, medida)/nullif(o,0) END tend_vs_obj FROM lt)"""


@query("d28_summary_view", digits=8, f="vtas_n1 vtas_n2 total_ventas tendencia mmaa ma objetivo tend_vs_obj", sql=VIEW + " SELECT * FROM vw")
def _(s):
    return view(s)


@query("d29_view_metric", digits=8, f="total_ventas tendencia objetivo mmaa ma pct_objetivo var_mmaa var_ma", sql=VIEW + """, m AS (SELECT periodo, grupo, generico, medida, sum(total_ventas) total_ventas, sum(tendencia) tendencia, sum(objetivo) objetivo, sum(mmaa) mmaa, sum(ma) ma FROM vw GROUP BY ALL)
SELECT *, tendencia/nullif(objetivo,0) pct_objetivo, tendencia/nullif(mmaa,0) var_mmaa, tendencia/nullif(ma,0) var_ma FROM m""")
def _(s):
    return sl.view_metric(view(s), ["periodo", "grupo", "generico", "medida"])


LISTS = [(0, "MAYORISTA"), (1, "MINORISTA"), (2, "ESPECIAL")]
LP = "CASE id_lista_precio WHEN 0 THEN 'MAYORISTA' WHEN 1 THEN 'MINORISTA' WHEN 2 THEN 'ESPECIAL' END"


def lists(s):
    return s.spark.createDataFrame(LISTS, "id_lista_precio long, lista_precio string")


@query("d30_discounts", f="importe_sin_desc bonificacion_pesos", sql=f"""SELECT CASE WHEN id_sucursal=1 AND id_ruta IN (2,3) THEN 'VALLE' ELSE id_sucursal||' - '||sucursal END lugar, generico, marca, {LP} lista_precio,
sum(subtotal_neto+descuentos) importe_sin_desc, sum(descuentos) bonificacion_pesos FROM l WHERE {JUNE} AND generico IN ('PROMO','SMALL') GROUP BY ALL""")
def _(s):
    return sl.discounts(fl.in_values(rng(s), "generico", ["PROMO", "SMALL"]), [2, 3], "VALLE", 1, lists(s))


REJ = "sum(CASE WHEN cantidades_total>0 THEN cantidades_total ELSE 0 END) vendidos, abs(sum(CASE WHEN cantidades_total<0 THEN cantidades_total ELSE 0 END)) rechazados"
FR = "vendidos rechazados pct_rechazo"
PCT = "coalesce(rechazados/nullif(vendidos,0),0) pct_rechazo"


def reps(s):
    v = s.vendedor.filter("id_fuerza_ventas = 1").select("id_vendedor", "id_sucursal", F.col("des_vendedor").alias("vendedor"))
    return rng(s).filter("generico in ('PROMO','SMALL','LARGE')").join(v, ["id_vendedor", "id_sucursal"])


RB = f"rb AS (SELECT l.*, v.des_vendedor vendedor FROM l JOIN ven v USING (id_vendedor, id_sucursal) WHERE v.id_fuerza_ventas=1 AND {JUNE} AND generico IN ('PROMO','SMALL','LARGE'))"


@query("d31_rep_rejections", f=FR, sql=f"{RB}, t AS (SELECT vendedor, {REJ} FROM rb GROUP BY 1) SELECT *, {PCT} FROM t WHERE vendidos>0")
def _(s):
    return sl.rejections(reps(s), ["vendedor"])


@query("d31_client_rejections", f=FR, sql=f"t AS (SELECT id_cliente, fantasia, razon_social, des_personal_fv1, generico, {REJ} FROM l WHERE {JUNE} GROUP BY ALL) SELECT *, {PCT} FROM t")
def _(s):
    return sl.rejections(rng(s), ["id_cliente", "fantasia", "razon_social", "des_personal_fv1", "generico"], only_sold=False)


@query("d32_rejection_rollup", f=FR, sql=f"""{RB}, {SUP_CTE}, t AS (SELECT s.supervisor, {REJ} FROM rb r JOIN sup s ON s.id_vendedor=r.id_vendedor AND s.id_sucursal=r.id_sucursal GROUP BY 1 UNION ALL SELECT 'JEFE', {REJ} FROM rb)
SELECT *, {PCT} FROM t""")
def _(s):
    t = sl.rejections(reps(s), ["vendedor"], only_sold=False)
    return sl.rejection_rollup(fl.with_supervisor(t, supervisor_map(s)), "JEFE")


GR = {"PROMO": ["PROMO"], "MULTI": ["SMALL", "LARGE"]}


@query("d32_rejection_pivot", f=names(GR, "vendidos", "rechazados", "pct"), sql=f"""{RB}, t AS (SELECT vendedor, CASE WHEN generico='PROMO' THEN 'PROMO' ELSE 'MULTI' END g, {REJ} FROM rb GROUP BY ALL),
w AS (SELECT vendedor, {W('g', list(GR), {'vendidos': 'vendidos', 'rechazados': 'rechazados'})} FROM t GROUP BY 1) SELECT *, coalesce(rechazados_PROMO/nullif(vendidos_PROMO,0),0) pct_PROMO, coalesce(rechazados_MULTI/nullif(vendidos_MULTI,0),0) pct_MULTI FROM w""")
def _(s):
    return sl.rejection_pivot(sl.rejections(reps(s), ["vendedor", "generico"], only_sold=False), "vendedor", GR)


@query("d33_incentive_base", f="cantidad", sql=f"""SELECT CASE WHEN sucursal='NATION_1' AND id_ruta IN (2,3) THEN 'VALLE' WHEN sucursal='NATION_1' AND id_ruta=5 THEN 'PUNA' WHEN sucursal='NATION_4' AND id_ruta IN (0,9) THEN 'SUBDIST' ELSE sucursal END lugar,
id_cliente, generico, marca, {LP} lista_precio, sum(cantidades_total) cantidad FROM l WHERE {JUNE} AND NOT anulado AND generico IN ('PROMO','SMALL') GROUP BY ALL""")
def _(s):
    df = fl.map_label(rng(s).filter("not anulado and generico in ('PROMO','SMALL')"), lists(s), "id_lista_precio", "lista_precio")
    return sl.summary(df, [fl.zone_name(ZONES).alias("lugar"), "id_cliente", "generico", "marca", "lista_precio"], ("cantidad",))


CATG = ["PROMO", "SMALL", "GHOST"]
GRID = "grd AS (SELECT descripcion sucursal, CASE WHEN id_sucursal%6<>0 THEN zona END zona, generico FROM suc CROSS JOIN (VALUES ('PROMO'),('SMALL'),('GHOST')) t(generico))"


def grid34(s):
    b = s.sucursal.select(F.col("descripcion").alias("sucursal"), F.when(F.col("id_sucursal") % 6 != 0, F.col("zona")).alias("zona"))
    return b.withColumn("generico", F.explode(F.array(*[F.lit(c) for c in CATG])))


@query("d34_reference_volume", f="valor total_zona participacion", sql=f"""{GRID}, v AS (SELECT sucursal, generico, sum(cantidades_total) valor FROM l WHERE {JUNE} GROUP BY 1,2), t AS (SELECT g.*, coalesce(valor,0) valor FROM grd g LEFT JOIN v USING (sucursal, generico))
SELECT *, sum(valor) OVER (PARTITION BY zona, generico) total_zona, coalesce(valor/nullif(sum(valor) OVER (PARTITION BY zona, generico),0),0) participacion FROM t""")
def _(s):
    v = sl.summary(rng(s), ["sucursal", "generico"], ("cantidad",)).withColumnRenamed("cantidad", "valor")
    return sl.reference_block(grid34(s), v, "generico")


@query("d34_reference_coverage", f="participacion", i="valor total_zona", sql=f"""{GRID}, v AS (SELECT sucursal, generico, clientes valor FROM {cov('sucursal, generico', f'(SELECT * FROM l WHERE {JUNE})')}), t AS (SELECT g.*, coalesce(valor,0) valor FROM grd g LEFT JOIN v USING (sucursal, generico))
SELECT *, sum(valor) OVER (PARTITION BY zona, generico) total_zona, coalesce(valor/nullif(sum(valor) OVER (PARTITION BY zona, generico),0),0) participacion FROM t""")
def _(s):
    v = cv.coverage(rng(s), ["sucursal", "generico"]).withColumnRenamed("clientes", "valor")
    return sl.reference_block(grid34(s), v, "generico")


@query("d35_wholesale_split", f="volumen_sucursal mayorista_sucursal volumen_zona mayorista_zona pct_mayo_zona pct_participacion pct_mayo_sucursal", sql=f"""{GRID},
v AS (SELECT sucursal, generico, sum(cantidades_total) a, sum(CASE WHEN id_lista_precio IN (0,2) THEN cantidades_total ELSE 0 END) b FROM l WHERE {JUNE} GROUP BY 1,2),
t AS (SELECT g.*, coalesce(a,0) volumen_sucursal, coalesce(b,0) mayorista_sucursal FROM grd g LEFT JOIN v USING (sucursal, generico)),
z AS (SELECT *, sum(volumen_sucursal) OVER w volumen_zona, sum(mayorista_sucursal) OVER w mayorista_zona FROM t WINDOW w AS (PARTITION BY zona, generico))
SELECT *, coalesce(mayorista_zona/nullif(volumen_zona,0),0) pct_mayo_zona, coalesce(mayorista_sucursal/nullif(mayorista_zona,0),0) pct_participacion, coalesce(mayorista_sucursal/nullif(volumen_sucursal,0),0) pct_mayo_sucursal FROM z""")
def _(s):
    v = fl.map_label(rng(s), lists(s), "id_lista_precio", "lista_precio")
    return sl.wholesale_split(grid34(s), sl.summary(v, ["sucursal", "generico", "lista_precio"], ("cantidad",)), ["MAYORISTA", "ESPECIAL"])


@query("d36_client_pivot", f="cantidad", sql=f"SELECT id_cliente, generico, marca, sucursal, zona, sum(cantidades_total) cantidad FROM l WHERE {JUNE} GROUP BY ALL")
def _(s):
    return sl.summary(rng(s), ["id_cliente", "generico", "marca", "sucursal", "zona"], ("cantidad",))


@query("d36_client_list", sql=f"SELECT DISTINCT id_cliente, sucursal FROM l WHERE {JUNE}")
def _(s):
    return rng(s).select("id_cliente", "sucursal").distinct()


B3 = ["Brand#1", "Brand#2", "Brand#3"]
ID37 = ["sucursal", "id_ruta", "id_cliente"]
C37 = f"c37 AS (SELECT sucursal, id_ruta, id_cliente, marca, calibre, sum(cantidades_total) cantidad FROM l WHERE fecha_comprobante BETWEEN '2001-01-01' AND '2001-06-30' AND marca IN ('Brand#1','Brand#2','Brand#3') GROUP BY ALL HAVING sum(cantidades_total)>0)"


def c37(s):
    return rng(s, "2001-01-01").filter(F.col("marca").isin(B3)).groupBy(*ID37, "marca", "calibre").agg(F.sum("cantidades_total").alias("cantidad")).filter("cantidad > 0")


def _d37(rule: str) -> str:
    return f"{C37}, w AS (SELECT sucursal, id_ruta, id_cliente, {W('marca', B3, {'m': 'cantidad'})}, sum(cantidad) FILTER (calibre::INT<=10) g1, sum(cantidad) FILTER (calibre::INT>10 AND calibre::INT<=20) g2 FROM c37 GROUP BY 1,2,3) SELECT * EXCLUDE (g1,g2), ({rule})::BIGINT cumple FROM w"


@query("d37_compliance_total", f=names(B3, "m"), sql=_d37("m_Brand_1+m_Brand_2+m_Brand_3>=40"))
def _(s):
    return sl.compliance(c37(s), ID37, B3, ">= 40")


@query("d37_compliance_every_brand", f=names(B3, "m"), sql=_d37("m_Brand_1>5 AND m_Brand_2>5 AND m_Brand_3>5"))
def _(s):
    return sl.compliance(c37(s), ID37, B3, "todas_marcas > 5")


@query("d37_compliance_any_size", f=names(B3, "m"), sql=_d37("coalesce(g1,0)>=30 OR coalesce(g2,0)>=20"))
def _(s):
    rule = {"chico": {"calibres": [str(k) for k in range(11)], "criterio": ">= 30"}, "medio": {"calibres": [str(k) for k in range(11, 21)], "criterio": ">= 20"}}
    return sl.compliance(c37(s), ID37, B3, rule)


@query("d38_year_grid", f=names(range(1, 13), "m"), i="anio", sql=f"h AS (SELECT year(fecha_comprobante) anio, month(fecha_comprobante) mes, marca, sum(cantidades_total) cantidad FROM l WHERE generico='PROMO' AND id_documento<>'PRVTA' GROUP BY ALL) SELECT anio, marca, {W('mes', range(1, 13), {'m': 'cantidad'})} FROM h GROUP BY 1,2")
def _(s):
    return sl.year_grid(sl.history(s.lineas.filter("generico = 'PROMO'"), ["marca"]), ["marca"], "cantidad")


@query("d39_converted_year", f="bultos kg", i="coberturas", sql="""x AS (SELECT unnest([strftime(fecha_comprobante,'%Y-%m'),'TOTAL']) mes, id_sucursal, id_cliente, cantidades_total b, cantidades_total*coalesce(factor_hectolitros,0) k FROM l WHERE marca='Brand#3' AND NOT anulado AND year(fecha_comprobante)=2000),
n AS (SELECT mes, id_sucursal, id_cliente, sum(b) b, sum(k) k FROM x GROUP BY ALL) SELECT mes, sum(b) bultos, sum(k) kg, count(*) FILTER (b>0) coberturas FROM n GROUP BY 1""")
def _(s):
    v = rng(s, "2000-01-01", "2000-12-31").filter("marca = 'Brand#3' and not anulado").groupBy(
        F.date_format("fecha_comprobante", "yyyy-MM").alias("mes"), "id_articulo", "id_cliente", "id_sucursal").agg(F.sum("cantidades_total").alias("bultos"))
    return sl.converted_year(v, s.articulo.select("id_articulo", F.col("factor_hectolitros").alias("factor")), 2000)


@query("d40_route_grid", sql="SELECT ruta, preventista, generico FROM (SELECT DISTINCT id_ruta_fv1 ruta, des_personal_fv1 preventista FROM cli WHERE NOT anulado AND id_sucursal=1 AND id_ruta_fv1 IS NOT NULL) CROSS JOIN (SELECT DISTINCT generico FROM art)")
def _(s):
    return sl.route_grid(s.cliente, 1, s.articulo.select("generico").distinct())


W41 = {"p1": ("2000-04-01", "2000-04-30"), "p2": ("2000-06-01", "2000-06-30"), "p3": ("2001-04-01", "2001-04-30"), "p4": ("2001-06-01", "2001-06-30")}
F41 = names(W41, "bultos", "bonif")


def _d41(keys):
    w = {k: f"fecha_comprobante BETWEEN '{a}' AND '{b}'" for k, (a, b) in W41.items()}
    c = ", ".join(f"coalesce(sum(cantidades_total) FILTER ({x}),0) bultos_{k}, coalesce(sum(cantidades_total*bonificacion/100.0::DOUBLE) FILTER ({x} AND bonificacion>0),0) bonif_{k}" for k, x in w.items())
    return f"SELECT {keys}, {c} FROM l WHERE generico='PROMO' AND ({' OR '.join(w.values())}) GROUP BY ALL"


@query("d41_period_comparison", f=F41, sql=_d41("id_cliente, id_sucursal"))
def _(s):
    return sl.period_columns(s.lineas.filter("generico = 'PROMO'"), W41, ["id_cliente", "id_sucursal"])


@query("d41_period_comparison_articles", f=F41, sql=_d41("id_cliente, id_sucursal, id_articulo, des_articulo, marca"))
def _(s):
    return sl.period_columns(s.lineas.filter("generico = 'PROMO'"), W41, ["id_cliente", "id_sucursal", "id_articulo", "des_articulo", "marca"])


@query("d41_period_comparison_brands", f=F41, sql=_d41("id_cliente, id_sucursal, marca"))
def _(s):
    return sl.period_columns(s.lineas.filter("generico = 'PROMO'"), W41, ["id_cliente", "id_sucursal", "marca"])


@query("d41_period_totals", f="bultos bonif", sql="c AS (" + _d41("id_cliente, id_sucursal") + ") " + " UNION ALL ".join(
    f"SELECT '{p}' periodo, sum(bultos_{p}) bultos, sum(bonif_{p}) bonif, count(*) FILTER (bultos_{p}<>0) clientes FROM c" for p in W41).replace("SELECT 'p1'", "SELECT 'p1'", 1))
def _(s):
    return sl.period_totals(sl.period_columns(s.lineas.filter("generico = 'PROMO'"), W41, ["id_cliente", "id_sucursal"]), list(W41))


@query("d42_article_list_years", f="cantidad", i="anio mes clientes", sql="""n AS (SELECT year(fecha_comprobante) anio, month(fecha_comprobante) mes, id_sucursal, id_cliente, sum(cantidades_total) b FROM fv WHERE id_articulo<300 AND fecha_comprobante BETWEEN '2000-01-01' AND '2001-06-30' GROUP BY ALL),
y AS (SELECT anio, id_sucursal, id_cliente, sum(b) b FROM n GROUP BY ALL) SELECT 'mes' nivel, anio, mes, sum(b) cantidad, count(*) FILTER (b>0) clientes FROM n GROUP BY ALL UNION ALL SELECT 'anio', anio, NULL, sum(b), count(*) FILTER (b>0) FROM y GROUP BY ALL""")
def _(s):
    return sl.article_list_years(fl.dates(s.ventas, "2000-01-01", M1), list(range(300)))
