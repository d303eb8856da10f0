"""B: projections, filters, predicates and derived dimensions."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.operators import filters as fl
from retail_analytics.plans.registry import query

M0, M1 = "2001-06-01", "2001-06-30"
JUNE = f"fecha_comprobante BETWEEN '{M0}' AND '{M1}'"
ZONES = [("VALLE", "NATION_1", [2, 3]), ("PUNA", "NATION_1", [5]), ("SUBDIST", "NATION_4", [0, 9])]
ZONE_CASE = ("CASE WHEN sucursal='NATION_1' AND id_ruta IN (2,3) THEN 'VALLE' WHEN sucursal='NATION_1' AND id_ruta=5 THEN 'PUNA' "
             "WHEN sucursal='NATION_4' AND id_ruta IN (0,9) THEN 'SUBDIST' ELSE sucursal END")


def total(df, *keys):
    return df.groupBy(*keys).agg(F.sum("cantidades_total").alias("cantidad"), F.count(F.lit(1)).alias("lineas"))


def q(keys: str, where: str = "TRUE", src: str = "l") -> str:
    return f"SELECT {keys}, sum(cantidades_total) cantidad, count(*) lineas FROM {src} WHERE {JUNE} AND ({where}) GROUP BY ALL"


def june(s):
    return fl.dates(s.lineas, M0, M1)


@query("b1_in_filter", f="cantidad", sql=q("generico,marca", "generico IN ('PROMO','SMALL') AND marca IN ('Brand#1','Brand#2','Brand#3')"))
def _(s):
    df = fl.in_values(june(s), "generico", ["PROMO", "SMALL"])
    df = fl.in_values(df, "id_articulo", None)
    brands = s.articulo.filter("marca in ('Brand#1','Brand#2','Brand#3')").select("marca").distinct()
    return total(fl.in_table(df, "marca", brands), "generico", "marca")


@query("b2_period_list", f="cupo", sql="SELECT periodo, sum(cupo) cupo FROM cupos WHERE periodo IN ('2001-06','2001-07') GROUP BY 1")
def _(s):
    return fl.period(s.cupos, "periodo", ["2001-06", "2001-07"]).groupBy("periodo").agg(F.sum("cupo").alias("cupo"))


@query("b2_period_range", f="cupo", sql="SELECT periodo, sum(cupo) cupo FROM cupos WHERE periodo BETWEEN '2001-05' AND '2001-06' GROUP BY 1")
def _(s):
    return fl.period(s.cupos, "periodo", desde="2001-05", hasta="2001-06").groupBy("periodo").agg(F.sum("cupo").alias("cupo"))


@query("b3_branch_filter", f="cantidad", sql=q("sucursal", "sucursal IN ('NATION_1','NATION_4')"))
def _(s):
    return total(fl.in_values(june(s), "sucursal", ["NATION_1", "NATION_4"]), "sucursal")


@query("b4_exclude_routes", f="cantidad",
       sql=q("id_sucursal,id_ruta", "NOT ((id_sucursal=1 AND coalesce(id_ruta,-1)=2) OR (id_sucursal=4 AND coalesce(id_ruta,-1)=0) OR coalesce(id_ruta,-1)=7)"))
def _(s):
    return total(fl.exclude_routes(june(s), [(1, 2), (4, 0), (None, 7)]), "id_sucursal", "id_ruta")


@query("b5_route_zone", f="cantidad", sql=q("id_ruta", "id_sucursal=1 AND id_ruta IN (1,2,3,4) AND id_ruta NOT IN (3)"))
def _(s):
    return total(fl.route_zone(june(s).filter("id_sucursal = 1"), [1, 2, 3, 4], [3]), "id_ruta")


@query("b5_empty_route_zone", i="lineas", sql="SELECT count(*) lineas FROM l WHERE FALSE")
def _(s):
    return fl.route_zone(june(s), []).agg(F.count(F.lit(1)).alias("lineas"))


@query("b6_conditional_quotes", f="cantidad", sql=q("generico,id_documento", "NOT (generico IN ('PROMO','LARGE') AND id_documento='PRVTA')"))
def _(s):
    return total(fl.drop_quotes(june(s), ["PROMO", "LARGE"]), "generico", "id_documento")


@query("b7_brand_split", f="cantidad", sql=q("""CASE WHEN generico='PROMO' AND marca IN ('Brand#1','Brand#2') THEN marca
WHEN generico='PROMO' THEN 'PROMO (sin Brand#1, Brand#2)' WHEN generico='LARGE' AND marca='Brand#9' THEN marca
WHEN generico='LARGE' THEN 'LARGE (sin Brand#9)' ELSE generico END AS categoria"""))
def _(s):
    return total(june(s).withColumn("categoria", fl.split_brands({"PROMO": ["Brand#1", "Brand#2"], "LARGE": ["Brand#9"]})),
                 "categoria")


@query("b8_virtual_zones", f="cantidad monto", sql=f"""SELECT {ZONE_CASE} sucursal, generico, sum(cantidades_total) cantidad,
sum(subtotal_neto) monto FROM l WHERE {JUNE} GROUP BY 1,2""")
def _(s):
    base = june(s).groupBy("sucursal", "generico", "id_ruta").agg(
        F.sum("cantidades_total").alias("cantidad"), F.sum("subtotal_neto").alias("monto"))
    return fl.apply_zones(base, ZONES, ["cantidad", "monto"])


@query("b9_expand_branches", sql="""SELECT sucursal FROM (VALUES ('NATION_1'),('NATION_2')) b(sucursal)
UNION SELECT zona FROM (VALUES ('VALLE','NATION_1'),('PUNA','NATION_1'),('SUBDIST','NATION_4')) z(zona,real)
WHERE real IN ('NATION_1','NATION_2')""")
def _(s):
    b = s.sucursal.filter("descripcion in ('NATION_1','NATION_2')").select(F.col("descripcion").alias("sucursal"))
    z = s.spark.createDataFrame([(n, r) for n, r, _ in ZONES], "zona string, sucursal_real string")
    return fl.expand_branches(b, z)


@query("b10_direct_sales", f="cantidad", sql=q("CASE WHEN id_ruta=9 AND sucursal<>'NATION_1' THEN 'DIRECTA SUCURSALES' ELSE sucursal END AS sucursal"))
def _(s):
    return total(june(s).withColumn("sucursal", fl.direct_sales("NATION_1", direct_route=9)), "sucursal")


@query("b11_flavour", f="cantidad", sql=q("""CASE WHEN x ILIKE '%NEGR%' THEN 'NEGRA' WHEN x ILIKE '%ROJA%' THEN 'ROJA'
WHEN x ILIKE '%BLANC%' OR x ILIKE '%RUBIA%' OR x ILIKE '%RUB %' OR x ILIKE '%BCA%' THEN 'BLANCA (rubia)' ELSE 'OTRO' END AS sabor""",
    src="""(SELECT *, replace(replace(replace(replace(des_articulo,'blue','Negra'),'red','roja'),'hot','rub 1'),'old','bca') x FROM l) t"""))
def _(s):
    text = F.col("des_articulo")
    for a, b in (("blue", "Negra"), ("red", "roja"), ("hot", "rub 1"), ("old", "bca")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return total(june(s).withColumn("x", text).withColumn("sabor", fl.flavour("x")), "sabor")


@query("b12_package_size", i="n", sql=r"""t AS (SELECT upper(trim(des_articulo||CASE id_articulo%5 WHEN 0 THEN ' 0'||(300+id_articulo%7)||' x 24 vnr' WHEN 1 THEN
  ' 1500*6' WHEN 2 THEN ' lata 473 cc' WHEN 3 THEN ' 4730' ELSE '' END)) x FROM art)
SELECT CASE WHEN regexp_matches(x,'(\d+)\s*[*X]\s*\d+') THEN regexp_extract(x,'(\d+)\s*[*X]\s*\d+',1)::BIGINT||'cc'
WHEN regexp_extract(x,'\b(300|330|473|500|575|600|710|1000|1200|1350|1500|2000|2250|2500)\b',1)<>'' THEN
regexp_extract(x,'\b(300|330|473|500|575|600|710|1000|1200|1350|1500|2000|2250|2500)\b',1)||'cc' ELSE 'OTRO' END envase, count(*) n FROM t GROUP BY 1""")
def _(s):
    k = F.col("id_articulo")
    tail = (F.when(k % 5 == 0, F.concat(F.lit(" 0"), 300 + k % 7, F.lit(" x 24 vnr"))).when(k % 5 == 1, " 1500*6")
            .when(k % 5 == 2, " lata 473 cc").when(k % 5 == 3, " 4730").otherwise(""))
    t = s.articulo.withColumn("x", F.concat("des_articulo", tail))
    return t.groupBy(fl.package_size("x").alias("envase")).agg(F.count(F.lit(1)).alias("n"))


@query("b13_quota_category", f="cantidad", sql=q("""CASE WHEN generico='PROMO' THEN CASE WHEN marca IN ('Brand#1','Brand#2') THEN 'CASA'
WHEN marca IN ('Brand#3','Brand#4') THEN upper(marca) WHEN marca IN ('Brand#5') THEN 'MULTI' END WHEN generico='SMALL' THEN 'AGUA'
WHEN des_articulo ILIKE '%bolt%' THEN 'AMARGO' WHEN generico='LARGE' THEN 'VINOS' WHEN upper(marca)='BRAND#7' THEN 'R' END AS categoria"""))
def _(s):
    cat = fl.quota_category("PROMO", ["BRAND#1", "BRAND#2"], "CASA", ["BRAND#3", "BRAND#4"], ["BRAND#5"], "MULTI",
                            {"SMALL": "AGUA"}, F.col("des_articulo").ilike("%bolt%"), "AMARGO", {"LARGE": "VINOS"},
                            {"BRAND#7": "R"})
    return total(june(s).withColumn("categoria", cat), "categoria")


@query("b14_promo_tier", i="n", sql="""t AS (SELECT ['MVB TOTAL','PLAN (ESC.) BASE','EXTRA TASA 2','mvb menor'][(nro_doc%4+1)::INT] x FROM fv)
SELECT CASE WHEN contains(x,'MVB') THEN 'MVB' WHEN contains(x,'(ESC.)') THEN 'ESC' WHEN contains(x,'EXTRA TASA') THEN 'EXTRA TASA' ELSE 'OTRAS' END tier, count(*) n FROM t GROUP BY 1""")
def _(s):
    x = F.element_at(F.array(F.lit("MVB TOTAL"), F.lit("PLAN (ESC.) BASE"), F.lit("EXTRA TASA 2"), F.lit("mvb menor")),
                     (F.col("nro_doc") % 4 + 1).cast("int"))
    return s.ventas.withColumn("x", x).groupBy(fl.promo_tier("x").alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query("b15_rep_rename", i="n", sql="""SELECT CASE WHEN upper(trim(des_vendedor))='SUPPLIER#000000003/NATION_2' THEN 'NUEVO NOMBRE' ELSE trim(des_vendedor) END vendedor,
count(*) n FROM ven GROUP BY 1""")
def _(s):
    ren = s.vendedor.filter("id_vendedor = 3 and id_sucursal = 2").select(
        F.concat(F.lit(" "), F.lower("des_vendedor")).alias("viejo"), F.lit("NUEVO NOMBRE").alias("actual"))
    reps = s.vendedor.select(F.concat("des_vendedor", F.lit(" ")).alias("vendedor"))
    return fl.rename_reps(reps, ren).groupBy("vendedor").agg(F.count(F.lit(1)).alias("n"))


def supervisor_map(s):
    """Supervisor of a rep = region of its branch; every fourth rep has none, the tenth is listed twice."""
    v = s.vendedor.join(s.sucursal, "id_sucursal").filter("id_vendedor % 4 <> 0")
    one = v.select(F.lower("des_vendedor").alias("vendedor"), F.col("zona").alias("supervisor"), F.lit(1).alias("orden"))
    two = v.filter("id_vendedor = 10").select(F.upper("des_vendedor").alias("vendedor"), F.lit("ASIA").alias("supervisor"),
                                              F.lit(2).alias("orden"))
    return one.unionByName(two)


SUP_CTE = """sup AS (SELECT v.id_vendedor, v.id_sucursal, v.des_vendedor, CASE WHEN id_vendedor=10 THEN 'ASIA' WHEN id_vendedor%4<>0 THEN s.zona
  ELSE 'Sin Supervisor' END supervisor FROM ven v JOIN suc s USING (id_sucursal))"""


@query("b16_supervisor", f="cantidad", sql=SUP_CTE + f"""SELECT supervisor, count(*) lineas, sum(cantidades_total) cantidad
FROM fv JOIN sup USING (id_vendedor, id_sucursal) WHERE {JUNE} GROUP BY 1""")
def _(s):
    v = s.vendedor.select("id_vendedor", "id_sucursal", F.col("des_vendedor").alias("vendedor"))
    df = fl.dates(s.ventas, M0, M1).join(v, ["id_vendedor", "id_sucursal"])
    return total(fl.with_supervisor(df, supervisor_map(s)), "supervisor")


@query("b16_supervisor_duplicates", i="n", sql="""SELECT upper(des_vendedor) vendedor, 2 n FROM ven JOIN suc s USING (id_sucursal)
WHERE id_vendedor=10 AND s.zona<>'ASIA'""")
def _(s):
    return fl.supervisor_duplicates(supervisor_map(s))


@query("b17_prefixed_label", i="lineas", sql=f"""SELECT id_sucursal||' - '||sucursal etiqueta, CASE WHEN id_sucursal%3<>0 THEN zona END supervisor, count(*) lineas
FROM l WHERE {JUNE} GROUP BY 1,2""")
def _(s):
    key = F.when(F.col("id_sucursal") % 2 == 0, F.concat("id_sucursal", F.lit(" - "), "descripcion")).otherwise(F.col("descripcion"))
    m = s.sucursal.filter("id_sucursal % 3 <> 0").select(key.alias("clave"), F.col("zona").alias("supervisor"))
    df = june(s).select(F.concat("id_sucursal", F.lit(" - "), "sucursal").alias("etiqueta"))
    return fl.by_label(df, m, "etiqueta", "clave", "supervisor").groupBy("etiqueta", "supervisor").agg(
        F.count(F.lit(1)).alias("lineas"))


@query("b18_client_name", sql="""SELECT id_cliente, coalesce(nullif(trim(fantasia),''),nullif(trim(razon_social),''),id_cliente::VARCHAR) nombre,
coalesce(CASE WHEN regexp_matches(trim(fantasia),'[A-Za-z0-9]') THEN nullif(trim(fantasia),'') END,nullif(trim(razon_social),''),id_cliente::VARCHAR) nombre_legible FROM cli""")
def _(s):
    return s.cliente.select("id_cliente", fl.client_name().alias("nombre"),
                            fl.client_name(need_alnum=True).alias("nombre_legible"))


@query("b19_document_key", i="lineas", sql=f"""SELECT id_documento||letra||lpad(serie::VARCHAR,4,'0')||lpad(nro_doc::VARCHAR,8,'0') comprobante, count(*) lineas
FROM fv WHERE {JUNE} AND NOT anulado GROUP BY 1""")
def _(s):
    return fl.dates(s.ventas, M0, M1).filter("not anulado").groupBy(fl.document_key().alias("comprobante")).agg(
        F.count(F.lit(1)).alias("lineas"))


@query("b20_swapped_columns", f="cupo", sql="""SELECT tipo_apertura, coalesce(marca,generico) concepto, sum(cupo) cupo FROM cupos_cob
WHERE coalesce(marca,generico) IS NOT NULL GROUP BY 1,2""")
def _(s):
    return fl.repair_swapped(s.cupos_cobertura).groupBy("tipo_apertura", "concepto").agg(F.sum("cupo").alias("cupo"))


@query("b21_price_list_label", i="n", sql="""SELECT CASE id_lista_precio WHEN 0 THEN 'MAYORISTA' WHEN 1 THEN 'MINORISTA' WHEN 2 THEN 'ESPECIAL' END lista_precio, count(*) n FROM cli GROUP BY 1""")
def _(s):
    names = s.spark.createDataFrame([(0, "MAYORISTA"), (1, "MINORISTA"), (2, "ESPECIAL")],
                                    "id_lista_precio long, lista_precio string")
    return fl.map_label(s.cliente, names, "id_lista_precio", "lista_precio").groupBy("lista_precio").agg(
        F.count(F.lit(1)).alias("n"))


@query("b22_partition_check", sql=f"""m AS (SELECT descripcion sucursal, zona supervisor FROM suc WHERE id_sucursal%6<>0
  UNION ALL SELECT descripcion, 'JEFE' FROM suc WHERE id_sucursal<9),
t AS (SELECT x.sucursal, count(DISTINCT supervisor) n FROM (SELECT DISTINCT sucursal FROM l WHERE {JUNE}) x LEFT JOIN m ON x.sucursal=m.sucursal GROUP BY 1)
SELECT sucursal, CASE WHEN n>1 THEN 'repetida' ELSE 'huerfana' END problema FROM t WHERE n<>1""")
def _(s):
    a = s.sucursal.filter("id_sucursal % 6 <> 0").select(F.col("descripcion").alias("sucursal"), F.col("zona").alias("supervisor"))
    b = s.sucursal.filter("id_sucursal < 9").select(F.col("descripcion").alias("sucursal"), F.lit("JEFE").alias("supervisor"))
    return fl.partition_check(june(s), a.unionByName(b))


@query("b23_missing_factor", sql="""SELECT id_articulo, des_articulo, marca FROM art WHERE generico='PROMO'
AND (factor_hectolitros IS NULL OR factor_hectolitros=0)""")
def _(s):
    return fl.missing_factor(s.articulo, "PROMO")


@query("b23_sold_without_factor", sql=f"""SELECT id_articulo FROM fv WHERE {JUNE} GROUP BY 1
HAVING sum(cantidades_total)<>0 AND id_articulo%29=0""")
def _(s):
    return fl.sold_without_factor(fl.dates(s.ventas, M0, M1), s.articulo.filter("factor_hectolitros is not null"))
