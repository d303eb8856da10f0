"""A: scans, sources, sinks and contracts."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from retail_analytics.operators import filters as fl, lookups
from retail_analytics.plans.registry import query
from retail_analytics.sources import checked, contracts as ct, incremental, quarantine, sinks

M0, M1 = "2001-06-01", "2001-06-30"


@query("a1_parameterised_scan", f="monto", i="lineas", sql="""
SELECT id_sucursal, sum(subtotal_neto) monto, count(*) lineas FROM fv
WHERE fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-30' AND id_documento='FCVTA' GROUP BY 1""")
def _(s):
    s.ventas.createOrReplaceTempView("fact_ventas")
    return ct.scan(s.spark, """SELECT id_sucursal, sum(subtotal_neto) AS monto, count(*) AS lineas FROM fact_ventas
        WHERE fecha_comprobante BETWEEN :desde AND :hasta AND id_documento = :doc GROUP BY 1""",
                   desde=M0, hasta=M1, doc="FCVTA")


@query("a2_branches", sql="SELECT DISTINCT descripcion sucursal, id_sucursal FROM suc")
def _(s):
    return s.sucursal.select(F.col("descripcion").alias("sucursal"), "id_sucursal").distinct().orderBy("sucursal")


@query("a3_article_lookup", sql="SELECT id_articulo, generico, marca, des_articulo FROM art WHERE generico IS NOT NULL")
def _(s):
    return s.articulo.filter("generico is not null").select("id_articulo", "generico", "marca", "des_articulo")


@query("a3_active_clients", sql="""SELECT id_cliente, id_sucursal, fantasia, razon_social, id_ruta_fv1, localidad
FROM cli WHERE NOT anulado AND id_sucursal=7""")
def _(s):
    return s.cliente.filter("not anulado and id_sucursal = 7").select(
        "id_cliente", "id_sucursal", "fantasia", "razon_social", "id_ruta_fv1", "localidad")


RAW = ["id", "fecha_comprobante", "id_sucursal", "id_vendedor", "id_cliente", "id_articulo", "id_documento",
       "anulado", "cantidades_total", "bonificacion", "facturacion_neta", "subtotal_neto"]


@query("a4_fact_dump", f="cantidades_total bonificacion facturacion_neta subtotal_neto",
       sql=f"SELECT {', '.join(RAW)} FROM fv WHERE fecha_comprobante BETWEEN '{M0}' AND '{M1}' AND id_sucursal=7")
def _(s):
    return fl.dates(s.ventas, M0, M1).filter("id_sucursal = 7").select(*RAW)


@query("a5_contract_check", i="n", sql="""
SELECT 'sin valor' problema, 'cupo' columna, count(*) n FROM cupos WHERE periodo='2001-06' AND cupo IS NULL HAVING count(*)>0
UNION ALL SELECT 'sin valor','generico',count(*) FROM cupos WHERE periodo='2001-06' AND generico IS NULL HAVING count(*)>0""")
def _(s):
    return ct.check_contract(s.cupos, ["periodo", "sucursal", "id_ruta", "generico", "cupo"], ["cupo", "generico"],
                             F.col("periodo") == "2001-06")


@query("a5_contract_zero_rows", i="n", sql="SELECT 'sin filas' problema, NULL::VARCHAR columna, 0 n")
def _(s):
    return ct.check_contract(s.cupos, ["periodo", "cupo"], ["cupo"], F.col("periodo") == "1990-01")


def promo_source(s):
    """Promo export derived from the discounted lines, with one column the contract does not know."""
    p = s.lineas.filter("descuentos <> 0 and not anulado and fecha_comprobante between '2001-06-01' and '2001-06-30'")
    # a third of the lines states a document the sales do not know, so its price stays unresolved
    return p.select(
        F.col("fecha_comprobante").cast("string").alias("Fecha"), fl.document_key().alias("Comprobante"),
        F.col("des_canal_mkt").alias("Agrupaciones"), F.col("id_cliente").cast("string").alias("Cod. Cliente"),
        F.col("razon_social").alias("Razón Social"), F.col("localidad").alias("Dirección"),
        F.col("id_articulo").cast("string").alias("Artículo CMQ"), F.col("des_articulo").alias("Descripción"),
        F.col("marca").alias("Marca"), F.col("calibre").alias("Calibre"), F.col("cantidades_con_cargo").alias("Cantidad"),
        F.col("precio_unitario_bruto").alias("Precio Neto SF"), F.col("facturacion_neta").alias("Total"),
        F.col("cantidades_sin_cargo").alias("Cantidad Sin Cargo"), F.col("bonificacion").alias("Descuento %"),
        F.col("descuentos").alias("Descuento $ sobre PN SF"), F.lit(50.0).alias("Participación CMQ"),
        (F.col("descuentos") * 0.5).alias("Monto A Acreditar"), (F.col("nro_doc") % 40).cast("string").alias("Acción"),
        F.element_at(F.array(F.lit("MVB TOTAL"), F.lit("PLAN (ESC.) BASE"), F.lit("EXTRA TASA 2"), F.lit("mvb menor")),
                     (F.col("nro_doc") % 4 + 1).cast("int")).alias("Descripción Acción"),
        F.when(F.col("id_articulo") % 3 != 0, F.col("id_articulo")).otherwise(F.col("id_articulo") + 100000000)
         .cast("string").alias("Artículo Distribuidora"), F.lit("x").alias("Sobrante"))


PROMO_CTE = """prl AS (SELECT fecha_comprobante::VARCHAR "Fecha", id_documento||letra||lpad(serie::VARCHAR,4,'0')||lpad(nro_doc::VARCHAR,8,'0') "Comprobante",
  des_canal_mkt "Agrupaciones", id_cliente::VARCHAR "Cod. Cliente", razon_social "Razón Social", localidad "Dirección",
  id_articulo::VARCHAR "Artículo CMQ", des_articulo "Descripción", marca "Marca", calibre "Calibre", cantidades_con_cargo "Cantidad",
  precio_unitario_bruto "Precio Neto SF", facturacion_neta "Total", cantidades_sin_cargo "Cantidad Sin Cargo", bonificacion "Descuento %",
  descuentos "Descuento $ sobre PN SF", 50.0::DOUBLE "Participación CMQ", descuentos*0.5 "Monto A Acreditar", (nro_doc%40)::VARCHAR "Acción",
  ['MVB TOTAL','PLAN (ESC.) BASE','EXTRA TASA 2','mvb menor'][(nro_doc%4+1)::INT] "Descripción Acción",
  (CASE WHEN id_articulo%3<>0 THEN id_articulo ELSE id_articulo+100000000 END)::VARCHAR "Artículo Distribuidora"
  FROM l WHERE descuentos<>0 AND NOT anulado AND fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-30')"""


@query("a6_promo_lines", sql=PROMO_CTE + """SELECT * REPLACE (round("Cantidad",4)+0.0::DOUBLE AS "Cantidad",
round("Precio Neto SF",8)+0.0::DOUBLE AS "Precio Neto SF", round("Total",4)+0.0::DOUBLE AS "Total",
round("Cantidad Sin Cargo",4)+0.0::DOUBLE AS "Cantidad Sin Cargo", round("Descuento %",4)+0.0::DOUBLE AS "Descuento %",
round("Descuento $ sobre PN SF",4)+0.0::DOUBLE AS "Descuento $ sobre PN SF", round("Monto A Acreditar",6)+0.0::DOUBLE AS "Monto A Acreditar") FROM prl""")
def _(s):
    return ct.promo_lines(promo_source(s)).select(*[
        F.round(F.col(f"`{c}`"), {"Monto A Acreditar": 6, "Precio Neto SF": 8}.get(c, 4)).alias(c) if c in ct.PROMO_NUMBERS else F.col(f"`{c}`") for c in ct.PROMO_COLUMNS])


@query("a7_text_repair", sql="""SELECT id_articulo, CASE id_articulo%3 WHEN 0 THEN des_articulo||' ñandú' WHEN 1 THEN
des_articulo||' ñandú €' ELSE des_articulo||' ñu' END des_articulo, marca FROM art""")
def _(s):
    k = F.col("id_articulo") % 3
    broken = F.when(k == 0, " Ã±andÃº").when(k == 1, " ñandú €").otherwise(" ñu")
    return ct.repair_all_text(s.articulo.select("id_articulo", F.concat("des_articulo", broken).alias("des_articulo"),
                                                "marca"))


def raw_prices(s):
    """Price export as text: some prices missing or no number, some ids listed twice."""
    k = F.col("p_partkey")
    one = s.raw("part").select(
        F.when(k % 401 == 0, "s/c").otherwise(k.cast("string")).alias("id"),
        F.when(k % 101 == 0, "n/d").when(k % 53 != 0, F.col("p_retailprice").cast("string")).alias("base"),
        F.col("p_size").cast("string").alias("final"))
    return one.unionByName(one.filter(F.col("id").try_cast("long") % 307 == 0))


PRICE_CTE = """lp0 AS (SELECT CASE WHEN p_partkey%401=0 THEN 's/c' ELSE p_partkey::VARCHAR END id,
  CASE WHEN p_partkey%101=0 THEN 'n/d' WHEN p_partkey%53<>0 THEN p_retailprice::VARCHAR END base, p_size::VARCHAR final FROM part),
lp AS (SELECT * FROM lp0 UNION ALL SELECT * FROM lp0 WHERE TRY_CAST(id AS BIGINT)%307=0)"""


@query("a8_price_list", f="precio_base precio_final", sql=PRICE_CTE + """
SELECT TRY_CAST(id AS BIGINT) id_articulo, coalesce(max(TRY_CAST(base AS DOUBLE)),0) precio_base, coalesce(max(TRY_CAST(final AS DOUBLE)),0) precio_final FROM lp WHERE TRY_CAST(id AS BIGINT) IS NOT NULL
GROUP BY 1 HAVING count(*)=1 AND bool_and((base IS NULL OR base='' OR TRY_CAST(base AS DOUBLE) IS NOT NULL) AND (final IS NULL OR final='' OR TRY_CAST(final AS DOUBLE) IS NOT NULL))""")
def _(s):
    return ct.price_list(raw_prices(s))


@query("a8_price_list_problems", i="n", sql=PRICE_CTE + """
SELECT 'id invalido' problema, id valor, count(*) n FROM lp WHERE TRY_CAST(id AS BIGINT) IS NULL GROUP BY 2
UNION ALL SELECT 'base no numerico', base, count(*) FROM lp WHERE base IS NOT NULL AND TRY_CAST(base AS DOUBLE) IS NULL GROUP BY 2
UNION ALL SELECT 'id repetido', id, count(*) FROM lp WHERE TRY_CAST(id AS BIGINT) IS NOT NULL GROUP BY 2 HAVING count(*)>1""")
def _(s):
    return ct.price_list_problems(raw_prices(s))


@query("a9_source_freshness", sql="SELECT greatest(date_diff('day', max(l_shipdate)::DATE, DATE '2001-08-15'),0) dias, greatest(date_diff('day', max(l_shipdate)::DATE, DATE '2001-08-15'),0)>30 vencida FROM lineitem", i="dias")
def _(s):
    return ct.freshness(s.raw("lineitem"), "2001-08-15", loaded="l_shipdate").select("dias", "vencida")


@query("a10_latest_sale", sql="SELECT max(fecha_comprobante) fecha FROM fv WHERE NOT anulado")
def _(s):
    return ct.latest_date(s.ventas, "fecha_comprobante", "anulado")


@query("a10_latest_snapshot", sql="SELECT max(date_stock) fecha FROM stock")
def _(s):
    return ct.latest_date(s.stock, "date_stock")


@query("a11_optional_table", i="clientes", sql="""SELECT s.descripcion sucursal, NULL::VARCHAR periodo, 0 clientes FROM suc s""")
def _(s):
    cob = ct.table_or_empty(s.spark, "cob_subdivision_agua", "sucursal string, periodo string, clientes long")
    b = s.sucursal.select(F.col("descripcion").alias("sucursal"))
    return b.join(cob, "sucursal", "left").withColumn("clientes", F.coalesce("clientes", F.lit(0)))


@query("a12_materialised_summary", f="cantidad monto", sql="""SELECT sucursal, generico, date_trunc('month',fecha_comprobante)::DATE mes,
sum(cantidades_total) cantidad, sum(subtotal_neto) monto FROM l GROUP BY 1,2,3""")
def _(s):
    df = (s.lineas.groupBy("sucursal", "generico", F.trunc("fecha_comprobante", "MM").alias("mes"))
          .agg(F.sum("cantidades_total").alias("cantidad"), F.sum("subtotal_neto").alias("monto")))
    path = sinks.refresh(df, f"{sinks.shared_dir(s.spark)}/resumen")
    sinks.publish_view(s.spark, "resumen_mensual", path)
    return s.spark.table("resumen_mensual")


@query("a13_output_per_branch", f="cantidad", sql="""SELECT id_sucursal::BIGINT id_sucursal, generico, sum(cantidades_total) cantidad
FROM l WHERE fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-30' GROUP BY 1,2""", i="id_sucursal")
def _(s):
    df = (fl.dates(s.lineas, M0, M1).groupBy("id_sucursal", "generico").agg(F.sum("cantidades_total").alias("cantidad")))
    path = sinks.split_output(df, "id_sucursal", f"{sinks.shared_dir(s.spark)}/por-sucursal-{uuid.uuid4().hex}")
    return s.spark.read.parquet(path)


@query("a14_client_sales", f="cantidades_total subtotal_neto", sql="""x AS (SELECT f.fecha_comprobante, f.id, f.id_articulo, a.des_articulo,
  f.cantidades_total, f.subtotal_neto FROM fv f LEFT JOIN art a USING (id_articulo)
  WHERE f.id_cliente=899 AND strftime(f.fecha_comprobante,'%Y-%m')='1998-10')
SELECT *, (SELECT count(*)>500 FROM x) truncado FROM x""")
def _(s):
    return lookups.client_sales(s.ventas, s.articulo, 899, "1998-10")


@query("a14_branch_clients", sql="""x AS (SELECT id_cliente, fantasia, anulado FROM cli WHERE id_sucursal=3)
SELECT *, (SELECT count(*)>500 FROM x) truncado FROM x""")
def _(s):
    return lookups.branch_clients(s.cliente, 3)


@query("a14_category_articles", sql="""x AS (SELECT id_articulo, des_articulo, marca FROM art WHERE generico='PROMO')
SELECT *, (SELECT count(*)>500 FROM x) truncado FROM x""")
def _(s):
    return lookups.category_articles(s.articulo, "PROMO")


@query("a14_article_sales", f="cantidades_total subtotal_neto", sql="""x AS (SELECT f.fecha_comprobante, f.id, s.descripcion sucursal,
  f.cantidades_total, f.subtotal_neto FROM fv f LEFT JOIN suc s USING (id_sucursal)
  WHERE f.id_articulo=15 AND f.fecha_comprobante BETWEEN '2000-01-01' AND '2001-06-30')
SELECT *, (SELECT count(*)>500 FROM x) truncado FROM x""")
def _(s):
    return lookups.article_sales(s.ventas, s.sucursal, 15, "2000-01-01", M1)


# the same client id in two branches does not exist in the test data, so every third one is copied to the next branch
@query("a15_resolve_client", sql="""c2 AS (SELECT id_cliente, id_sucursal, fantasia, razon_social FROM cli UNION ALL
  SELECT id_cliente, id_sucursal+1, fantasia, razon_social FROM cli WHERE id_cliente%3=0),
ids AS (SELECT id_cliente+CASE WHEN id_cliente%10=0 THEN 100000000 ELSE 0 END id_cliente,
  CASE WHEN id_cliente%2=0 THEN id_sucursal END id_sucursal FROM cli),
m AS (SELECT ids.id_cliente, ids.id_sucursal, count(c2.id_cliente) n, min(c2.id_sucursal) hs,
  arg_min(coalesce(nullif(trim(fantasia),''),nullif(trim(razon_social),''),c2.id_cliente::VARCHAR), c2.id_sucursal) nom
  FROM ids LEFT JOIN c2 ON ids.id_cliente=c2.id_cliente AND (ids.id_sucursal IS NULL OR ids.id_sucursal=c2.id_sucursal) GROUP BY 1,2)
SELECT id_cliente, id_sucursal, CASE WHEN n=1 THEN hs END sucursal_hallada, CASE WHEN n=1 THEN nom END nombre,
  CASE WHEN n=0 THEN 'no existe' WHEN n>1 THEN 'ambiguo' ELSE 'ok' END estado FROM m""")
def _(s):
    copies = s.cliente.filter("id_cliente % 3 = 0").withColumn("id_sucursal", F.col("id_sucursal") + 1)
    c = s.cliente.unionByName(copies)
    ids = s.cliente.select((F.col("id_cliente") + F.when(F.col("id_cliente") % 10 == 0, 100000000).otherwise(0))
                           .alias("id_cliente"), F.when(F.col("id_cliente") % 2 == 0, F.col("id_sucursal")).alias("id_sucursal"))
    return lookups.resolve_client(c, ids)


def monthly_source(s, root: str, extra: bool) -> str:
    """The sales lines as a table partitioned by month; the lines of odd documents of June 2001 come with a later load."""
    path = f"{root}/lineas"
    v = s.lineas.select("sucursal", "generico", F.date_format("fecha_comprobante", "yyyy-MM").alias("mes"), "cantidades_total", "subtotal_neto", "nro_doc")
    late = (F.col("mes") == "2001-06") & (F.col("nro_doc") % 2 == 1)
    v.filter(late if extra else ~late).repartition("mes").write.mode("append").partitionBy("mes").parquet(path)
    return path


@query("a12_incremental_summary", f="cantidad monto", sql="""SELECT sucursal, generico, strftime(fecha_comprobante,'%Y-%m') mes,
sum(cantidades_total) cantidad, sum(subtotal_neto) monto FROM l GROUP BY 1,2,3""")
def _(s):
    """Built over all months, then refreshed after a late load: only the month it touched is computed again."""
    root = f"{sinks.shared_dir(s.spark)}/incremental-{uuid.uuid4().hex}"
    table = incremental.MonthlyTable(s.spark, f"{root}/resumen", lambda v: v.groupBy("sucursal", "generico", "mes").agg(
        F.sum("cantidades_total").alias("cantidad"), F.sum("subtotal_neto").alias("monto")))
    table.refresh(monthly_source(s, root, extra=False))
    table.refresh(monthly_source(s, root, extra=True))
    return table.read()


PRICES = StructType([StructField("id_articulo", LongType()), StructField("precio_base", DoubleType()), StructField("precio_final", DoubleType())])


def price_files(s) -> str:
    """The price list as delimited files, with short and long lines, a header again, words for numbers and missing prices."""
    k = F.col("p_partkey")
    base, final = F.round("p_retailprice", 2).cast("string"), F.round(F.col("p_retailprice") + 10, 2).cast("string")
    line = (F.when(k % 31 == 0, F.concat_ws(",", k, base)).when(k % 37 == 0, F.concat_ws(",", k, base, final, F.lit("x")))
            .when(k % 41 == 0, F.concat_ws(",", k, F.lit("consultar"), final)).when(k % 43 == 0, F.concat_ws(",", k, F.lit(""), final))
            .when(k % 47 == 0, "id_articulo,precio_base,precio_final").when(k % 53 == 0, F.concat_ws(",", k, F.lit("-1.0"), final))
            .otherwise(F.concat_ws(",", k, base, final)))
    path = f"{sinks.shared_dir(s.spark)}/precios-{uuid.uuid4().hex}"
    # every file starts with the header
    rows = s.raw("part").select(line.alias("value"), F.pmod(F.xxhash64("p_partkey"), F.lit(4)).alias("parte"), F.lit(1).alias("orden"))
    head = s.spark.range(4).select(F.lit(",".join(PRICES.names)).alias("value"), F.col("id").alias("parte"), F.lit(0).alias("orden"))
    rows.unionByName(head).repartition(4, "parte").sortWithinPartitions("parte", "orden").drop("orden").write.partitionBy("parte").text(path)
    return f"{path}/parte=*"


@query("a8_price_quarantine", f="precio_base:2 precio_final:2", sql="""p AS (SELECT p_partkey k, round(p_retailprice,2) b, round(p_retailprice+10,2) f FROM part),
r AS (SELECT *, CASE WHEN k%31=0 THEN 'faltan columnas' WHEN k%37=0 THEN 'sobran columnas' WHEN k%41=0 THEN 'tipo invalido: precio_base' WHEN k%43=0 THEN 'falta precio_base' WHEN k%47=0 THEN 'encabezado repetido' WHEN k%53=0 THEN 'precio no positivo' END motivo FROM p)
SELECT CASE WHEN k%47=0 AND motivo='encabezado repetido' THEN NULL ELSE k END id_articulo, CASE WHEN motivo IN ('tipo invalido: precio_base','falta precio_base','encabezado repetido') THEN NULL WHEN motivo='precio no positivo' THEN -1.0 ELSE b END precio_base,
 CASE WHEN motivo IN ('faltan columnas','encabezado repetido') THEN NULL ELSE f END precio_final, motivo FROM r""")
def _(s):
    fine = (F.col("precio_base") > 0) & (F.col("precio_final") > 0)
    rows = quarantine.read_all(s.spark, price_files(s), PRICES, ["precio_base"], checks={"precio no positivo": fine})
    good, bad = quarantine.split(rows, f"{sinks.shared_dir(s.spark)}/precios-{uuid.uuid4().hex}")
    return good.withColumn("motivo", F.lit(None).cast("string")).unionByName(bad.drop(quarantine.RAW))


@query("a5_contract_on_write", f="valor:2", sql="""SELECT unnest(['filas','sin_cupo','sin_generico']) metrica, unnest([count(*), count(*) FILTER (cupo IS NULL), count(*) FILTER (generico IS NULL)])::DOUBLE valor FROM cupos WHERE periodo='2001-06'""")
def _(s):
    found = checked.write_checked(s.cupos.filter("periodo = '2001-06'"), f"{sinks.shared_dir(s.spark)}/cupos-{uuid.uuid4().hex}",
                                  checked.contract_metrics(["cupo", "generico"]), {"con filas": lambda m: m["filas"] > 0})
    return checked.as_rows(s.spark, found)


@query("l3_reconciliation_on_write", f="valor:2", sql="""x AS (SELECT id_sucursal, sum(facturacion_neta-descuentos) a, sum(subtotal_neto) b FROM fv GROUP BY 1)
SELECT unnest(['total_a','total_b','diferencia']) metrica, unnest([sum(a), sum(b), round(sum(a)-sum(b),2)]) valor FROM x""")
def _(s):
    df = s.ventas.groupBy("id_sucursal").agg(F.sum(F.col("facturacion_neta") - F.col("descuentos")).alias("por_partes"), F.sum("subtotal_neto").alias("neto"))
    found = checked.write_checked(df, f"{sinks.shared_dir(s.spark)}/conciliacion-{uuid.uuid4().hex}", checked.reconcile_metrics("por_partes", "neto"),
                                  {"concilia": lambda m: abs(m["diferencia"]) < 1.0})
    return checked.as_rows(s.spark, found)
