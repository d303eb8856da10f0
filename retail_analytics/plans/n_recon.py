"""N: commercial actions and reconciliation."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.operators import filters as fl, recon as rc
from retail_analytics.plans.a_sources import PROMO_CTE, promo_source
from retail_analytics.plans.registry import query
from retail_analytics.plans.sqltext import wide as W
from retail_analytics.sources import contracts as ct

M0, M1 = "2001-06-01", "2001-06-30"
KEY = "id_documento||letra||lpad(serie::VARCHAR,4,'0')||lpad(nro_doc::VARCHAR,8,'0')"
LI = f"""li AS (SELECT id id_linea, fecha_comprobante fecha, id_cliente, razon_social, id_sucursal||' - '||sucursal sucursal, id_articulo, des_articulo, marca, generico, abs(precio_unitario_bruto) precio, bonificacion/100.0::DOUBLE bonific,
 cantidades_total cantidad, facturacion_neta facturacion, descuentos, {KEY} comprobante FROM l WHERE NOT anulado AND fecha_comprobante BETWEEN '{M0}' AND '{M1}')"""
FL = "precio:8 bonific cantidad facturacion descuentos"
ORD = "cantidad DESC NULLS LAST, precio DESC NULLS LAST, id_linea, bonific DESC NULLS LAST"


def lines(s):
    return rc.line_extract(fl.dates(s.lineas, M0, M1))


@query("n1_line_extract", f=FL, sql=LI + " SELECT * FROM li")
def _(s):
    return lines(s)


# a coarser key (client, category) has many lines and several prices per key
TE = LI + f""", te AS (SELECT fecha, id_cliente, id_articulo, c cantidad, f facturacion, d descuentos, precio, bonific, id_linea, razon_social, sucursal, des_articulo, marca, generico, precios, bonificaciones FROM (SELECT *, sum(cantidad) OVER w c, sum(facturacion) OVER w f, sum(descuentos) OVER w d,
 row_number() OVER (PARTITION BY fecha, id_cliente, id_articulo ORDER BY {ORD}) r FROM li WINDOW w AS (PARTITION BY fecha, id_cliente, id_articulo)) x JOIN (SELECT fecha, id_cliente, id_articulo, count(DISTINCT precio) precios, count(DISTINCT bonific) bonificaciones FROM li GROUP BY 1,2,3) n USING (fecha, id_cliente, id_articulo) WHERE r=1)"""


def ternas(s):
    return rc.collapse(lines(s), rc.TERNA)


@query("n2_collapse", f=FL, sql=TE + " SELECT * FROM te")
def _(s):
    return ternas(s)


@query("n2_multi_price", f="precio_min:8 precio_max:8 precio_elegido:8 bonific_elegido", sql=LI + f""", p AS (SELECT id_cliente, generico, precio, bonific, row_number() OVER (PARTITION BY id_cliente, generico ORDER BY {ORD}) r FROM li), a AS (SELECT id_cliente, generico, count(DISTINCT precio) precios, count(DISTINCT bonific) bonificaciones, min(precio) precio_min, max(precio) precio_max FROM li GROUP BY 1,2)
SELECT a.*, p.precio precio_elegido, p.bonific bonific_elegido FROM a JOIN p USING (id_cliente, generico) WHERE r=1 AND (precios>1 OR bonificaciones>1)""")
def _(s):
    return rc.multi_price(lines(s), ["id_cliente", "generico"])


DP = f"dp AS (SELECT comprobante, id_articulo, precio precio_comprobante FROM (SELECT *, row_number() OVER (PARTITION BY comprobante, id_articulo ORDER BY {ORD}) r FROM li) WHERE r=1)"


@query("n3_document_price", f="precio_comprobante:8", sql=LI + ", " + DP + " SELECT * FROM dp")
def _(s):
    return rc.document_price(lines(s))


# every fourth client also exists in the branch before its own
CB = "cb AS (SELECT id_cliente, arg_min(id_sucursal||' - '||des_sucursal, id_sucursal) sucursal FROM (SELECT id_cliente, id_sucursal, des_sucursal FROM cli WHERE NOT anulado UNION ALL SELECT id_cliente, id_sucursal-1, 'COPIA' FROM cli WHERE NOT anulado AND id_cliente%4=0) GROUP BY 1)"


@query("n4_client_branch", sql=CB + " SELECT * FROM cb")
def _(s):
    copy = s.cliente.filter("id_cliente % 4 = 0").withColumn("id_sucursal", F.col("id_sucursal") - 1).withColumn("des_sucursal", F.lit("COPIA"))
    return rc.client_branch(s.cliente.unionByName(copy))


def promo(s):
    """Promo lines where the free goods carry no rate."""
    p = ct.promo_lines(promo_source(s))
    return p.withColumn("Descuento %", F.when(F.col("Cantidad Sin Cargo") == 0, F.col("Descuento %")))


def enriched(s):
    """Lines of clients that no branch knows are added to the promo lines."""
    li, p = lines(s), promo(s)
    unknown = p.filter(F.col("`Cod. Cliente`").cast("long") % 19 == 0).withColumn("Cod. Cliente", (F.col("`Cod. Cliente`").cast("long") + 10_000_000).cast("string"))
    sup = s.sucursal.select(F.when(F.col("id_sucursal") % 2 == 0, F.concat("id_sucursal", F.lit(" - "), "descripcion"))
                                                          .otherwise(F.col("descripcion")).alias("clave"), "zona")
    return rc.enrich(p.unionByName(unknown), rc.client_branch(s.cliente), rc.collapse(li, rc.TERNA), sup, rc.document_price(li))


EN = TE + ", " + DP + ", " + PROMO_CTE + """, w1 AS (SELECT * FROM prl UNION ALL SELECT * REPLACE (("Cod. Cliente"::BIGINT+10000000)::VARCHAR AS "Cod. Cliente") FROM prl WHERE "Cod. Cliente"::BIGINT%19=0), w2 AS (SELECT * REPLACE (CASE WHEN "Cantidad Sin Cargo"=0 THEN "Descuento %" END AS "Descuento %") FROM w1),
c5 AS (SELECT id_cliente, id_sucursal||' - '||des_sucursal suc FROM cli WHERE NOT anulado), sv AS (SELECT id_sucursal||' - '||descripcion lab, zona FROM suc),
en0 AS (SELECT w2.*, c5.suc "SUCURSAL", w2."Fecha"||"Cod. Cliente"||"Artículo Distribuidora" "CONCAT", te.precio "PRECIO FINAL", dp.precio_comprobante "PRECIO COMPROBANTE", sv.zona "ZONA",
 CASE WHEN contains("Descripción Acción",'MVB') THEN 'MVB' WHEN contains("Descripción Acción",'(ESC.)') THEN 'ESC' WHEN contains("Descripción Acción",'EXTRA TASA') THEN 'EXTRA TASA' ELSE 'OTRAS' END mvb, w2."Cantidad"*te.precio "Total2",
 w2."Cantidad"*te.precio*(coalesce(w2."Descuento %",0)/100.0::DOUBLE)+w2."Cantidad Sin Cargo"*te.precio "Descuento", CASE WHEN w2."Descuento %" IS NULL THEN 'SIN CARGO' ELSE 'Descuentos' END "Tipo Descuento"
 FROM w2 LEFT JOIN c5 ON c5.id_cliente="Cod. Cliente"::BIGINT LEFT JOIN te ON te.fecha=w2."Fecha"::DATE AND te.id_cliente="Cod. Cliente"::BIGINT AND te.id_articulo="Artículo Distribuidora"::BIGINT LEFT JOIN dp ON dp.comprobante=trim(w2."Comprobante") AND dp.id_articulo="Artículo Distribuidora"::BIGINT LEFT JOIN sv ON sv.lab=c5.suc)"""
COLS = {"comprobante": "Comprobante", "cliente": "Cod. Cliente", "articulo": "Artículo Distribuidora", "sucursal": "SUCURSAL", "clave": "CONCAT", "precio_final": "PRECIO FINAL", "precio_comprobante": "PRECIO COMPROBANTE",
        "zona": "ZONA", "tier": "mvb", "total2": "Total2", "descuento": "Descuento", "tipo": "Tipo Descuento"}


@query("n5_promo_enrichment", f="precio_final:8 precio_comprobante:8 total2 descuento", sql=EN + " SELECT " + ", ".join(f'"{c}" {n}' for n, c in COLS.items()) + " FROM en0")
def _(s):
    return enriched(s).select(*[F.col(f"`{c}`").alias(n) for n, c in COLS.items()])


@query("n5_unresolved", sql=EN + """ SELECT 'sucursal' motivo, "Cod. Cliente" cliente, count(*) lineas FROM en0 WHERE "SUCURSAL" IS NULL GROUP BY 2 UNION ALL SELECT 'precio', "Cod. Cliente", count(*) FROM en0 WHERE "PRECIO FINAL" IS NULL GROUP BY 2""")
def _(s):
    return rc.unresolved(enriched(s))


NS = ["sucursal", "id_articulo", "generico"]
PIV = TE + ", pv AS (SELECT sucursal, id_articulo, generico, sum(facturacion) facturacion, sum(descuentos) descuentos, sum(descuentos)/nullif(sum(facturacion),0) campo1 FROM te GROUP BY 1,2,3)"


@query("n6_net_sales_pivot", f="facturacion descuentos campo1", sql=PIV + " SELECT * FROM pv UNION ALL SELECT 'TOTAL GENERAL', NULL, NULL, sum(facturacion), sum(descuentos), sum(descuentos)/sum(facturacion) FROM pv")
def _(s):
    return rc.net_sales_pivot(ternas(s), NS)


@query("n7_action_pivot", f="descuento", sql=EN + """, p AS (SELECT "SUCURSAL" sucursal, "Acción" accion, mvb tier, coalesce(sum("Descuento"),0) descuento FROM en0 GROUP BY 1,2,3) SELECT * FROM p UNION ALL SELECT 'TOTAL GENERAL', NULL, NULL, sum(descuento) FROM p""")
def _(s):
    return rc.discount_pivot(enriched(s), {"sucursal": "SUCURSAL", "accion": "Acción", "tier": "mvb"})


@query("n7_client_date_pivot", f="descuento", sql=EN + """, p AS (SELECT "Fecha" fecha, "SUCURSAL" sucursal, "Cod. Cliente" cliente, coalesce(sum("Descuento"),0) descuento FROM en0 GROUP BY 1,2,3) SELECT * FROM p UNION ALL SELECT 'TOTAL GENERAL', NULL, NULL, sum(descuento) FROM p""")
def _(s):
    return rc.discount_pivot(enriched(s), {"fecha": "Fecha", "sucursal": "SUCURSAL", "cliente": "Cod. Cliente"})


B5 = [f"Brand#{k}" for k in range(1, 6)]


@query("n8_action_category", f=" ".join(f"d_Brand_{k}" for k in range(1, 6)), sql=EN + f""", p AS (SELECT "Acción" accion, {W('"Marca"', B5, {'d': '"Descuento"'})} FROM en0 GROUP BY 1) SELECT * FROM p UNION ALL SELECT 'TOTAL GENERAL', {', '.join(f'sum(d_Brand_{k})' for k in range(1, 6))} FROM p""")
def _(s):
    return rc.action_category(enriched(s), {"accion": "Acción"}, "Marca", B5)


# the backup frame lacks some keys, has others and drifts on a few
DA = """da AS (SELECT sucursal, id_cliente, fecha, sum(facturacion) facturacion, sum(descuentos) descuentos FROM li GROUP BY 1,2,3), db AS (SELECT CASE WHEN id_cliente%31=0 THEN 'OTRA' ELSE sucursal END sucursal, id_cliente, fecha, facturacion*CASE WHEN id_cliente%7=0 THEN 1.01 ELSE 1 END facturacion, descuentos FROM da WHERE id_cliente%11<>0
 UNION ALL SELECT 'TOTAL GENERAL', 0, DATE '2001-06-05', 1.0, 1.0), sc AS (SELECT coalesce(a.sucursal,b.sucursal) sucursal, coalesce(a.id_cliente,b.id_cliente) id_cliente, coalesce(a.fecha,b.fecha) fecha, a.facturacion fa, b.facturacion fb, a.descuentos xa, b.descuentos xb, CASE WHEN b.fecha IS NULL THEN 'base-only' WHEN a.fecha IS NULL THEN 'backup-only' ELSE 'both' END presencia
 FROM (SELECT * FROM da WHERE fecha<='2001-06-25') a FULL JOIN (SELECT * FROM db WHERE sucursal<>'TOTAL GENERAL' AND fecha<='2001-06-25') b ON a.sucursal=b.sucursal AND a.id_cliente=b.id_cliente AND a.fecha=b.fecha),
df AS (SELECT sucursal, id_cliente, fecha, presencia, 'facturacion' columna, fa base, fb backup, coalesce(fa,0)-coalesce(fb,0) delta FROM sc UNION ALL SELECT sucursal, id_cliente, fecha, presencia, 'descuentos', xa, xb, coalesce(xa,0)-coalesce(xb,0) FROM sc),
d9 AS (SELECT * FROM df WHERE abs(delta)>0.01), dc AS (SELECT *, CASE WHEN id_cliente%7=0 AND columna='facturacion' THEN 'precio viejo' WHEN id_cliente%31=0 THEN 'sucursal vieja' END motivo FROM d9)"""


def diff(s):
    a = lines(s).groupBy("sucursal", "id_cliente", "fecha").agg(F.sum("facturacion").alias("facturacion"), F.sum("descuentos").alias("descuentos"))
    c = F.col("id_cliente")
    b = a.filter(c % 11 != 0).select(F.when(c % 31 == 0, "OTRA").otherwise(F.col("sucursal")).alias("sucursal"), "id_cliente", "fecha",
                                     (F.col("facturacion") * F.when(c % 7 == 0, 1.01).otherwise(1.0)).alias("facturacion"), "descuentos")
    tot = s.spark.sql("SELECT 'TOTAL GENERAL' AS sucursal, 0L AS id_cliente, DATE'2001-06-05' AS fecha, 1.0D AS facturacion, 1.0D AS descuentos")
    return rc.frame_diff(a, b.unionByName(tot), ["sucursal", "id_cliente", "fecha"], ["facturacion", "descuentos"], 0.01, "fecha", M0, "2001-06-25")


def classified(s):
    c = F.col("id_cliente")
    return rc.classify(diff(s), [("precio viejo", (c % 7 == 0) & (F.col("columna") == "facturacion")), ("sucursal vieja", c % 31 == 0)])


@query("n9_frame_diff", f="base backup delta", sql=LI + ", " + DA + " SELECT * FROM d9")
def _(s):
    return diff(s)


@query("n10_classified_deltas", f="base backup delta", sql=LI + ", " + DA + " SELECT *, CASE WHEN motivo IS NULL THEN 'real-divergence' ELSE 'baseline-defect' END clase FROM dc")
def _(s):
    return classified(s)


VA = """rf AS (SELECT fecha, id_cliente, id_articulo, precio*CASE WHEN id_articulo%5=0 THEN 1.1 ELSE 1 END ref_precio, bonific+CASE WHEN id_articulo%5=1 THEN 0.02 ELSE 0 END ref_bonific FROM te WHERE id_articulo%13<>0),
vp AS (SELECT te.fecha, te.id_cliente, te.id_articulo, precio, bonific, ref_precio, ref_bonific, CASE WHEN ref_precio IS NULL THEN 'missing' WHEN abs(precio-ref_precio)>0.01 THEN 'precio' WHEN abs(bonific-ref_bonific)>0.01 THEN 'bonific' END motivo FROM te LEFT JOIN rf USING (fecha, id_cliente, id_articulo))"""


def mismatches(s):
    t = ternas(s)
    a = F.col("id_articulo")
    ref = t.filter(a % 13 != 0).select(*rc.TERNA, (F.col("precio") * F.when(a % 5 == 0, 1.1).otherwise(1.0)).alias("precio"), (F.col("bonific") + F.when(a % 5 == 1, 0.02).otherwise(0.0)).alias("bonific"))
    return rc.validate_prices(t, ref, 0.01)


@query("n11_price_validation", f="precio:8 bonific ref_precio:8 ref_bonific", sql=TE + ", " + VA + " SELECT * FROM vp WHERE motivo IS NOT NULL")
def _(s):
    return mismatches(s)


@query("n12_diff_summary", sql=TE + ", " + VA + ", " + DA + " SELECT CASE WHEN motivo IS NULL THEN 'real-divergence' ELSE 'baseline-defect' END concepto, count(*) n FROM dc GROUP BY 1 UNION ALL SELECT 'total_deltas', count(*) FROM dc UNION ALL SELECT 'terna_mismatches', count(*) FROM vp WHERE motivo IS NOT NULL")
def _(s):
    return rc.diff_summary(classified(s), mismatches(s))


@query("n13_timing_class", sql=EN + """ SELECT "Fecha", "Comprobante", "Cod. Cliente" cliente, "Artículo Distribuidora" articulo, CASE WHEN "Fecha"='2001-06-30' THEN 'Desfasaje de carga (dia en curso)' ELSE 'REVISAR (dia cerrado)' END clasificacion FROM en0 WHERE "PRECIO FINAL" IS NULL""")
def _(s):
    return rc.timing_class(enriched(s), M1)


# the ternas of the test data rarely mix documents, so the comparison runs on the coarser client x day price
@query("n13_price_comparison", f="precio_terna:8 precio_comprobante:8 delta:6", sql=EN + """, k AS (SELECT fecha, id_cliente, max(precio) mp FROM te GROUP BY 1,2), x AS (SELECT en0.*, mp FROM en0 JOIN k ON k.fecha=en0."Fecha"::DATE AND k.id_cliente="Cod. Cliente"::BIGINT)
SELECT "Comprobante", "Cod. Cliente" cliente, "Artículo Distribuidora" articulo, mp precio_terna, "PRECIO COMPROBANTE" precio_comprobante, mp-"PRECIO COMPROBANTE" delta FROM x WHERE "PRECIO COMPROBANTE" IS NOT NULL AND abs(mp-"PRECIO COMPROBANTE")>0.01""")
def _(s):
    top = ternas(s).groupBy(F.col("fecha").cast("string").alias("Fecha"), F.col("id_cliente").cast("string").alias("_c")).agg(F.max("precio").alias("_p"))
    e = enriched(s).withColumn("_c", F.col("`Cod. Cliente`")).join(top, ["Fecha", "_c"]).withColumn("PRECIO FINAL", F.col("_p"))
    return rc.price_comparison(e, 0.01)


@query("n13_branch_reconciliation", f="facturacion desc_ventas desc_promo delta", sql=EN + """, a AS (SELECT trim(regexp_replace(sucursal,'^\\d+\\s*-\\s*','')) sucursal, sum(facturacion) facturacion, sum(descuentos) desc_ventas FROM te GROUP BY 1), b AS (SELECT trim(regexp_replace("SUCURSAL",'^\\d+\\s*-\\s*','')) sucursal, sum("Descuento") desc_promo FROM en0 WHERE "SUCURSAL" IS NOT NULL GROUP BY 1),
t AS (SELECT coalesce(a.sucursal,b.sucursal) sucursal, coalesce(facturacion,0) facturacion, coalesce(desc_ventas,0) desc_ventas, coalesce(desc_promo,0) desc_promo, coalesce(desc_ventas,0)-coalesce(desc_promo,0) delta FROM a FULL JOIN b ON a.sucursal=b.sucursal),
u AS (SELECT * FROM t UNION ALL SELECT 'TOTAL GENERAL', sum(facturacion), sum(desc_ventas), sum(desc_promo), sum(delta) FROM t) SELECT *, CASE WHEN abs(delta)<=5000 THEN 'SI' ELSE 'NO' END dentro FROM u""")
def _(s):
    return rc.branch_reconciliation(ternas(s), enriched(s), 5000.0)


@query("n14_sales_mix", f="facturacion descuentos", sql=PIV + " SELECT 'generico' nivel, NULL::VARCHAR sucursal, generico, sum(facturacion) facturacion, sum(descuentos) descuentos, count(*) articulos FROM pv GROUP BY 3 UNION ALL SELECT 'sucursal', sucursal, NULL, sum(facturacion), sum(descuentos), count(*) FROM pv GROUP BY 2 UNION ALL SELECT 'ambos', sucursal, generico, sum(facturacion), sum(descuentos), count(*) FROM pv GROUP BY 2,3")
def _(s):
    p = ternas(s).groupBy(*NS).agg(F.sum("facturacion").alias("facturacion"), F.sum("descuentos").alias("descuentos"))
    return rc.sales_mix(p)


@query("n14_promo_dashboard", f="importe descuento", sql=EN + ", " + "z AS (" + " UNION ALL ".join(f"""SELECT '{k}' nivel, {e} valor, coalesce(sum("Total2"),0) importe, coalesce(sum("Descuento"),0) descuento, count(*) operaciones FROM en0 GROUP BY 2""" for k, e in (
    ("accion", '"Acción"'), ("cliente", '"Cod. Cliente"'), ("fecha", '"Fecha"'), ("dia", "(isodow(\"Fecha\"::DATE)-1)::VARCHAR"), ("tipo", '"Tipo Descuento"'))) + ") SELECT * FROM z")
def _(s):
    return rc.promo_dashboard(enriched(s))


@query("n14_quality_counters", sql=EN + """ SELECT count(*) filas, count(*) FILTER ("ZONA" IS NULL OR "ZONA"='') sin_zona, count(*) FILTER ("Marca" IS NULL OR "Marca"='') sin_marca, count(*) FILTER ("Calibre" IS NULL OR "Calibre"='') sin_calibre FROM en0""")
def _(s):
    return rc.quality_counters(enriched(s))


# purchases derived from the sales lines: the movement code follows the line, some products and clients are broken
PU = """pu AS (SELECT ['C1','C2','DV','XX','ZZ'][(nro_doc%5+1)::INT] cod_movimiento, CASE WHEN nro_doc%23=0 THEN 'sin codigo' WHEN nro_doc%29=0 THEN 'abc - x' ELSE id_articulo||' - '||des_articulo END producto, CASE WHEN nro_doc%31<>0 THEN id_cliente END id_cliente, abs(facturacion_neta) importe FROM l WHERE fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-30'),
sg AS (SELECT * FROM (VALUES ('C1',1.0::DOUBLE,'suma'),('C2',1.0,'Suma '),('DV',-1.0,'suma'),('XX',1.0,'no')) t(cod_movimiento,signo,marca)), bc AS (SELECT id_cliente, des_sucursal sucursal FROM cli WHERE id_cliente%41<>0),
pj AS (SELECT pu.*, signo, marca, CASE WHEN contains(producto,'-') THEN TRY_CAST(trim(split_part(producto,'-',1)) AS BIGINT) END id_articulo FROM pu LEFT JOIN sg USING (cod_movimiento)),
pg AS (SELECT pj.*, a.generico, bc.sucursal, CASE WHEN signo IS NULL THEN 'codigo sin signo' WHEN lower(trim(pj.marca))<>'suma' THEN 'codigo no suma' WHEN pj.id_articulo IS NULL THEN 'producto sin articulo' WHEN pj.id_cliente IS NULL THEN 'sin cliente' WHEN a.generico IS NULL OR bc.sucursal IS NULL THEN 'sin generico o sucursal' END motivo
 FROM pj LEFT JOIN art a ON a.id_articulo=pj.id_articulo LEFT JOIN bc ON bc.id_cliente=pj.id_cliente), dz AS (SELECT sucursal, generico, sum(descuentos) descuentos FROM l WHERE fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-30' GROUP BY 1,2),
zs AS (SELECT descripcion sucursal, zona FROM suc WHERE id_sucursal<>24), rt AS (SELECT generico, zona, CASE WHEN zona='ASIA' THEN 0.0 ELSE 0.01*length(zona) END::DOUBLE tasa FROM (VALUES ('PROMO'),('SMALL')) g(generico) CROSS JOIN (SELECT DISTINCT zona FROM zs))"""


def purchases(s):
    k = F.col("nro_doc")
    v = fl.dates(s.lineas, M0, M1)
    p = v.select(F.element_at(F.array(*[F.lit(x) for x in ("C1", "C2", "DV", "XX", "ZZ")]), (k % 5 + 1).cast("int")).alias("cod_movimiento"),
                 F.when(k % 23 == 0, "sin codigo").when(k % 29 == 0, "abc - x").otherwise(F.concat("id_articulo", F.lit(" - "), "des_articulo")).alias("producto"),
                 F.when(k % 31 != 0, F.col("id_cliente")).alias("id_cliente"), F.abs("facturacion_neta").alias("importe"))
    signs = s.spark.createDataFrame([("C1", 1.0, "suma"), ("C2", 1.0, "Suma "), ("DV", -1.0, "suma"), ("XX", 1.0, "no")], "cod_movimiento string, signo double, marca string")
    br = s.cliente.filter("id_cliente % 41 <> 0").select("id_cliente", F.col("des_sucursal").alias("sucursal"))
    return rc.signed_purchases(p, signs, br, s.articulo)


def rate_inputs(s):
    d = fl.dates(s.lineas, M0, M1).groupBy("sucursal", "generico").agg(F.sum("descuentos").alias("descuentos"))
    z = s.sucursal.filter("id_sucursal <> 24").select(F.col("descripcion").alias("sucursal"), "zona")
    r = z.select("zona").distinct().withColumn("generico", F.explode(F.array(F.lit("PROMO"), F.lit("SMALL"))))
    return d, z, r.withColumn("tasa", F.when(F.col("zona") == "ASIA", 0.0).otherwise(0.01 * F.length("zona")))


@query("n15_signed_purchases", f="total", sql=PU + " SELECT coalesce(motivo,'entra') motivo, count(*) filas, sum(CASE WHEN motivo IS NULL THEN signo*importe END) total FROM pg GROUP BY 1")
def _(s):
    return purchases(s).groupBy(F.coalesce("motivo", F.lit("entra")).alias("motivo")).agg(F.count(F.lit(1)).alias("filas"), F.sum("total").alias("total"))


RMO = PU + """, cz AS (SELECT generico, zona, sum(signo*importe) compras FROM pg JOIN zs USING (sucursal) WHERE motivo IS NULL GROUP BY 1,2), dd AS (SELECT generico, zona, sum(descuentos) descuentos FROM dz JOIN zs USING (sucursal) GROUP BY 1,2),
m0 AS (SELECT rt.generico, rt.zona, tasa, coalesce(compras,0) compras, coalesce(descuentos,0) descuentos FROM rt LEFT JOIN cz USING (generico, zona) LEFT JOIN dd USING (generico, zona)), m1 AS (SELECT *, compras*tasa tasa_generada, compras*tasa-descuentos diferencia, coalesce((compras*tasa-descuentos)/nullif(tasa,0),0) compra_necesaria FROM m0)"""


@query("n15_rate_model", f="tasa compras descuentos tasa_generada diferencia compra_necesaria", sql=RMO + " SELECT * FROM m1 UNION ALL BY NAME SELECT generico, 'TOTAL '||generico zona, sum(compras) compras, sum(descuentos) descuentos, sum(tasa_generada) tasa_generada, sum(diferencia) diferencia, sum(compra_necesaria) compra_necesaria FROM m1 GROUP BY 1")
def _(s):
    d, z, r = rate_inputs(s)
    return rc.rate_model(purchases(s), d, r, z)


@query("n15_rate_opening", f="compras descuentos", sql=PU + """, o AS (SELECT zs.sucursal, zs.zona, g.generico, coalesce((SELECT sum(signo*importe) FROM pg WHERE motivo IS NULL AND pg.sucursal=zs.sucursal AND pg.generico=g.generico),0) compras, coalesce((SELECT sum(descuentos) FROM dz WHERE dz.sucursal=zs.sucursal AND dz.generico=g.generico),0) descuentos FROM zs CROSS JOIN (SELECT DISTINCT generico FROM rt) g)
SELECT * FROM o UNION ALL SELECT 'TOTAL '||generico, '', generico, sum(compras), sum(descuentos) FROM o GROUP BY generico""")
def _(s):
    d, z, r = rate_inputs(s)
    return rc.rate_opening(purchases(s), d, r.select("generico").distinct(), z)


@query("n16_channel_discount", f="descuento", sql=EN + """, cn AS (SELECT id_cliente, CASE id_lista_precio WHEN 0 THEN 'MAYORISTA' WHEN 1 THEN 'MINORISTA' END canal FROM cli WHERE id_lista_precio<2), x AS (SELECT coalesce(canal,'SIN CANAL') canal, "Marca" generico, "Descuento" d FROM en0 LEFT JOIN cn ON cn.id_cliente="Cod. Cliente"::BIGINT WHERE "Razón Social" IS NOT NULL)
SELECT 'canal' nivel, canal, NULL::VARCHAR generico, coalesce(sum(d),0) descuento, count(*) lineas FROM x GROUP BY 2 UNION ALL SELECT 'canal_generico', canal, generico, coalesce(sum(d),0), count(*) FROM x GROUP BY 2,3""")
def _(s):
    lists = s.cliente.filter("id_lista_precio < 2").select("id_cliente", F.when(F.col("id_lista_precio") == 0, "MAYORISTA").otherwise("MINORISTA").alias("canal"))
    return rc.channel_discount(enriched(s), lists, "Marca")


MET = "me AS (SELECT sucursal, sum(facturacion_neta) facturacion, sum(descuentos) descuentos, sum(cantidades_total) bultos, sum(cantidad_total_htls) htls, count(DISTINCT id_cliente) clientes, count(DISTINCT id_articulo) articulos FROM l WHERE NOT anulado AND fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-30' GROUP BY 1)"
MC = ["facturacion", "descuentos", "bultos", "htls", "clientes", "articulos"]


@query("n17_branch_metrics", f="facturacion descuentos bultos htls", sql=MET + " SELECT * FROM me")
def _(s):
    return rc.branch_metrics(fl.dates(s.lineas, M0, M1))


@query("n17_correlations", f="r", sql=MET + " " + " UNION ALL ".join(f"SELECT '{a}' a, '{b}' b, corr({a},{b}) r FROM me" for i, a in enumerate(MC) for b in MC[i + 1:]))
def _(s):
    return rc.correlations(rc.branch_metrics(fl.dates(s.lineas, M0, M1)), MC)
