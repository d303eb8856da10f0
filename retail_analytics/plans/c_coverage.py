"""C: coverage."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from retail_analytics.operators import coverage as cv, filters as fl, lookups
from retail_analytics.functions.shape import slug, wide, yoy
from retail_analytics.plans.registry import query
from retail_analytics.sources import layout, sinks
from retail_analytics.star import enrich
from retail_analytics.plans.sqltext import COBL, JUNE, M0, M1, cov, names, wide as W

CC = "clientes_compradores"
T = (CC, "volumen_total")


def june(s):
    return fl.dates(s.lineas_cliente, M0, M1)


def cob(s, name, a=M0, b=M1):
    return cv.coverage_table(fl.dates(s.lineas_cliente, a, b), name)


def cob_sql(name: str, where: str) -> str:
    return f"(SELECT * RENAME (clientes AS {CC}, volumen AS volumen_total) FROM {cov(', '.join(cv.TABLES[name]), f'(SELECT * FROM cobl WHERE {where})')})"


JUN_P = "periodo='2001-06-01'"


# all cuts over the whole history
ALL_COLS = ["periodo", "id_fuerza_ventas", "id_sucursal", "ds_sucursal", "id_vendedor", "id_ruta", "generico", "marca", "id_lista_precio"]


def _c1():
    parts = []
    for name, cols in cv.TABLES.items():
        sel = ", ".join(c if c in cols else f"NULL::{'VARCHAR' if c in ('generico', 'marca') else 'BIGINT'} {c}" for c in ALL_COLS)
        parts.append(f"SELECT '{name}' tabla, {sel}, clientes {CC}, volumen volumen_total FROM {cov(', '.join(cols), 'cobl')}")
    return COBL + " " + " UNION ALL ".join(parts)


@query("c1_coverage_tables", f="volumen_total", sql=_c1())
def _(s):
    return cv.coverage_tables(s.lineas_cliente)


GROUPS = [("Brand#1", "SABORIZADAS"), ("Brand#2", "SABORIZADAS"), ("Brand#2", "MINERAL"), ("Brand#3", "MINERAL")]
GRP_CTE = "grp AS (SELECT * FROM (VALUES ('Brand#1','SABORIZADAS'),('Brand#2','SABORIZADAS'),('Brand#2','MINERAL'),('Brand#3','MINERAL')) g(marca,subdivision))"


@query("c1_subdivision_coverage", f="volumen_total", sql=f"""{COBL}, {GRP_CTE} SELECT * RENAME (clientes AS {CC}, volumen AS volumen_total) FROM
{cov('periodo, id_fuerza_ventas, id_sucursal, subdivision', '(SELECT * FROM cobl JOIN grp USING (marca))')}""")
def _(s):
    g = s.spark.createDataFrame(GROUPS, "marca string, subdivision string")
    return cv.group_coverage(s.lineas_cliente, g, "marca", "subdivision", ["periodo", "id_fuerza_ventas", "id_sucursal"])


SKUS = [(i, "SKUS A" if i % 2 else "SKUS B") for i in range(1, 60)] + [(7, "SKUS C"), (8, "SKUS C")]
SKU_CTE = "gsk AS (SELECT * FROM (VALUES " + ",".join(f"({i},'{n}')" for i, n in SKUS) + ") g(id_articulo,grupo))"


@query("c1_article_group_coverage", f="volumen_total", sql=f"""{COBL}, {SKU_CTE} SELECT * RENAME (clientes AS {CC}, volumen AS volumen_total) FROM
{cov('periodo, id_fuerza_ventas, id_sucursal, grupo', '(SELECT * FROM cobl JOIN gsk USING (id_articulo))')}""")
def _(s):
    g = s.spark.createDataFrame(SKUS, "id_articulo long, grupo string")
    return cv.group_coverage(s.lineas_cliente, g, "id_articulo", "grupo", ["periodo", "id_fuerza_ventas", "id_sucursal"])


def _dump_sql(level: str) -> str:
    where = "periodo BETWEEN '2001-05-01' AND '2001-06-01' AND id_fuerza_ventas=1"
    return f"{COBL} SELECT * FROM {cob_sql(f'cob_preventista_{level}', where)} WHERE ds_sucursal IN ('NATION_1','NATION_7')"


@query("a4_category_coverage_dump", f="volumen_total", sql=_dump_sql("generico"))
def _(s):
    return cv.dump(cob(s, "cob_preventista_generico", "2001-05-01"), "2001-05-01", "2001-06-01", 1, ["NATION_1", "NATION_7"])


@query("a4_brand_coverage_dump", f="volumen_total", sql=_dump_sql("marca"))
def _(s):
    return cv.dump(cob(s, "cob_preventista_marca", "2001-05-01"), "2001-05-01", "2001-06-01", 1, ["NATION_1", "NATION_7"])


@query("a14_month_coverage", f="volumen_total", sql=f"""{COBL}, c AS (SELECT periodo, ds_sucursal sucursal, generico, sum({CC}) {CC}, sum(volumen_total) volumen_total FROM {cob_sql('cob_sucursal_generico', JUN_P)}
 WHERE ds_sucursal IN ('NATION_2','NATION_3') GROUP BY 1,2,3) SELECT *, (SELECT count(*)>500 FROM c) truncado FROM c""", i=CC)
def _(s):
    return lookups.month_coverage(cob(s, "cob_sucursal_generico"), "2001-06", ["NATION_2", "NATION_3"])


@query("d25_coverage_quotas", f="cupo", sql="""SELECT descripcion sucursal, id_ruta, coalesce(marca,generico) concepto, sum(cupo) cupo FROM cupos_cob JOIN suc USING (id_sucursal)
WHERE periodo='2001-06' AND coalesce(marca,generico) IS NOT NULL GROUP BY 1,2,3""")
def _(s):
    return cv.coverage_quotas(s.cupos_cobertura, s.sucursal, "2001-06")


@query("c2_rep_category_coverage", f="volumen_total", sql=f"""{COBL} SELECT c.periodo, c.ds_sucursal sucursal, c.id_vendedor, v.des_vendedor vendedor, c.id_ruta, c.generico, c.{CC}, c.volumen_total
FROM {cob_sql('cob_preventista_generico', JUN_P + ' AND id_fuerza_ventas=1')} c LEFT JOIN ven v ON c.id_vendedor=v.id_vendedor AND c.id_sucursal=v.id_sucursal""")
def _(s):
    return cv.rep_coverage(cob(s, "cob_preventista_generico"), s.vendedor, "generico")


@query("c2_rep_brand_coverage", f="volumen_total", sql=f"""{COBL} SELECT c.periodo, c.ds_sucursal sucursal, c.id_vendedor, v.des_vendedor vendedor, c.id_ruta, c.marca, c.{CC}, c.volumen_total
FROM {cob_sql('cob_preventista_marca', JUN_P + ' AND id_fuerza_ventas=1')} c LEFT JOIN ven v ON c.id_vendedor=v.id_vendedor AND c.id_sucursal=v.id_sucursal
WHERE c.ds_sucursal IN ('NATION_1','NATION_2','NATION_3')""")
def _(s):
    c = fl.in_values(cob(s, "cob_preventista_marca"), "ds_sucursal", ["NATION_1", "NATION_2", "NATION_3"])
    return cv.rep_coverage(c, s.vendedor, "marca")


@query("c3_branch_category_coverage", f="volumen_total", i=CC, sql=f"""{COBL} SELECT periodo, ds_sucursal, generico, sum({CC}) {CC}, sum(volumen_total) volumen_total
FROM {cob_sql('cob_preventista_generico', "periodo>='2001-04-01' AND periodo<='2001-06-01' AND id_fuerza_ventas=1")} GROUP BY 1,2,3""")
def _(s):
    c = cob(s, "cob_preventista_generico", "2001-04-01").filter("id_fuerza_ventas = 1")
    return cv.roll_up(c, ["periodo", "ds_sucursal", "generico"])


@query("c3_branch_brand_coverage", f="volumen_total", sql=f"""{COBL} SELECT periodo, ds_sucursal, marca, {CC}, volumen_total FROM {cob_sql('cob_sucursal_marca', JUN_P + ' AND id_fuerza_ventas=1')}""")
def _(s):
    return cob(s, "cob_sucursal_marca").filter("id_fuerza_ventas = 1").select("periodo", "ds_sucursal", "marca", *T)


@query("c4_category_brand_coverage", sql=f"""{COBL} SELECT marca, {CC} cobertura FROM {cob_sql('cob_sucursal_marca', JUN_P + ' AND id_fuerza_ventas=1 AND id_sucursal=1')}
WHERE marca IN (SELECT DISTINCT marca FROM art WHERE generico='PROMO')""")
def _(s):
    c = cob(s, "cob_sucursal_marca").filter("id_fuerza_ventas = 1 and id_sucursal = 1")
    return cv.category_brand_coverage(c, s.articulo, "PROMO").select("marca", F.col(CC).alias("cobertura"))


@query("c5_category_scalar", i="cobertura sin_filas", sql=f"""{COBL}, c AS (SELECT * FROM {cob_sql('cob_sucursal_generico', JUN_P + ' AND id_fuerza_ventas=1 AND id_sucursal=1')})
SELECT (SELECT coalesce(sum({CC}),0) FROM c WHERE generico='PROMO') cobertura, 0 sin_filas""")
def _(s):
    c = cob(s, "cob_sucursal_generico").filter("id_fuerza_ventas = 1 and id_sucursal = 1")
    one = cv.category_scalar(c.filter("generico = 'PROMO'"))
    return cv.with_scalars(one, cv.category_scalar(c.filter("generico = 'NADA'"), "sin_filas"))


@query("c6_zone_coverage", i="cobertura", sql=f"""{COBL}, c AS (SELECT * FROM {cob_sql('cob_preventista_marca', JUN_P + ' AND id_fuerza_ventas=1 AND id_sucursal=1 AND id_ruta IN (1,2,3,4,5) AND id_ruta<>3')}),
g AS (SELECT * FROM {cob_sql('cob_preventista_generico', JUN_P + ' AND id_fuerza_ventas=1 AND id_sucursal=1 AND id_ruta IN (1,2,3,4,5) AND id_ruta<>3')})
SELECT marca, sum({CC}) cobertura FROM c WHERE marca IN (SELECT marca FROM art WHERE generico='PROMO') GROUP BY 1
UNION ALL SELECT 'TOTAL PROMO', coalesce(sum({CC}),0) FROM g WHERE generico='PROMO'""")
def _(s):
    def zone(name):
        return fl.route_zone(cob(s, name).filter("id_fuerza_ventas = 1 and id_sucursal = 1"), [1, 2, 3, 4, 5], [3])
    m = cv.category_brand_coverage(cv.roll_up(zone("cob_preventista_marca"), ["marca"]), s.articulo, "PROMO")
    t = cv.category_scalar(zone("cob_preventista_generico").filter("generico = 'PROMO'"))
    return m.select("marca", F.col(CC).alias("cobertura")).unionByName(t.select(F.lit("TOTAL PROMO").alias("marca"), "cobertura"))


CUT = ", ".join(cv.CUSTOM)


@query("c7_custom_brand_coverage", f="volumen_total", sql=f"""{COBL} SELECT * RENAME (clientes AS {CC}, volumen AS volumen_total) FROM
{cov(CUT, f"(SELECT * FROM cobl WHERE {JUN_P} AND upper(marca) IN ('BRAND#1','BRAND#2','BRAND#3') AND des_articulo ILIKE '%ed%')")}""")
def _(s):
    return cv.custom_coverage(june(s), M0, ["Brand#1", "brand#2", "BRAND#3", "brand#1"], text="ED")


@query("c7_custom_article_coverage", f="volumen_total", sql=f"""{COBL} SELECT * RENAME (clientes AS {CC}, volumen AS volumen_total) FROM
{cov(CUT, f"(SELECT * FROM cobl WHERE {JUN_P} AND id_articulo BETWEEN 20 AND 80)")}""")
def _(s):
    return cv.custom_coverage(june(s), M0, articles=list(range(20, 81)))


YEAR = "fecha_comprobante BETWEEN '2000-07-01' AND '2001-06-30'"


@query("c8_all_brands_coverage", f="volumen_total", sql=f"""{COBL}, m AS (SELECT {CUT}, id_cliente, marca, sum(cantidades_total) q FROM cobl
 WHERE periodo='2000-03-01' AND marca IN ('Brand#1','Brand#2') GROUP BY ALL HAVING sum(cantidades_total)>0),
v AS (SELECT {CUT}, id_cliente, sum(q) q FROM m GROUP BY ALL HAVING count(DISTINCT marca)=2)
SELECT {CUT}, count(*) {CC}, sum(q) volumen_total FROM v GROUP BY ALL""")
def _(s):
    return cv.custom_coverage(fl.dates(s.lineas_cliente, "2000-03-01", "2000-03-31"), "2000-03-01", ["Brand#1", "Brand#2"], all_brands=True)


@query("c9_union_coverage", sql=f"""n AS (SELECT id_cliente, id_sucursal, sucursal, id_ruta ruta, des_personal_fv1 vendedor, sum(cantidades_total) q FROM l
 WHERE {JUNE} AND NOT anulado AND marca IN ('Brand#1','Brand#2','Brand#3') GROUP BY ALL)
SELECT CASE WHEN id_sucursal=1 AND ruta IN (2,3) THEN 'VALLE' ELSE id_sucursal||' - '||sucursal END lugar, vendedor, ruta, count(*) clientes
FROM n WHERE q>0 GROUP BY 1,2,3""")
def _(s):
    return cv.union_coverage(june(s), ["Brand#1", "Brand#2", "Brand#3"], [2, 3], "VALLE", 1)


@query("c10_article_set_coverage", sql=f"SELECT id_sucursal, clientes FROM {cov('id_sucursal', f'(SELECT * FROM fv WHERE {JUNE} AND NOT anulado AND id_articulo<200)')}")
def _(s):
    return cv.article_coverage(fl.dates(s.ventas, M0, M1), list(range(200)))


TARGET_SQL = {"PREMIUM": "marca IN ('Brand#1','Brand#2')", "CHICOS": "generico='SMALL'", "RED": "des_articulo ILIKE '%red%'"}


@query("c11_target_coverage", sql=" UNION ALL ".join(
    f"SELECT des_personal_fv1, objetivo, clientes FROM {cov('des_personal_fv1, objetivo', f'(SELECT *, {chr(39)}{n}{chr(39)} objetivo FROM l WHERE {JUNE} AND id_lista_precio=1 AND ({p}))')}"
    for n, p in TARGET_SQL.items()))
def _(s):
    targets = {"PREMIUM": F.col("marca").isin("Brand#1", "Brand#2"), "CHICOS": F.col("generico") == "SMALL",
               "RED": F.col("des_articulo").ilike("%red%")}
    return cv.target_coverage(june(s).filter("id_lista_precio = 1"), targets, ["des_personal_fv1"])


@query("c12_rep_universe", sql="SELECT DISTINCT des_personal_fv1 vendedor FROM cli WHERE id_sucursal=1 AND id_lista_precio=3 AND des_personal_fv1 IS NOT NULL AND des_personal_fv1<>'DIRECTA'")
def _(s):
    return cv.rep_universe(s.cliente, 1, 3, ["DIRECTA"])


OUT = [(1, 2), (None, 7)]
OUT_SQL = "NOT ((id_sucursal=1 AND coalesce(id_ruta,-1)=2) OR coalesce(id_ruta,-1)=7)"


def cm_sql(keys: str, where: str) -> str:
    return f"""(SELECT l.id_sucursal, v.des_sucursal, {keys}, l.id_cliente, strftime(fecha_comprobante,'%Y-%m') mes, sum(cantidades_total) bultos, sum(cantidad_total_htls) hectolitros
 FROM l JOIN ven v ON l.id_vendedor=v.id_vendedor AND l.id_sucursal=v.id_sucursal WHERE NOT l.anulado AND v.id_fuerza_ventas=1 AND {where} GROUP BY ALL)"""


@query("c13_client_brand_month", f="bultos hectolitros", sql=f"SELECT * FROM {cm_sql('marca', JUNE + ' AND ' + OUT_SQL.replace('id_sucursal', 'l.id_sucursal'))}")
def _(s):
    return cv.client_month(june(s), s.vendedor, routes_out=OUT)


@query("c13_client_article_month", f="bultos hectolitros", sql=f"SELECT * FROM {cm_sql('id_articulo', JUNE)}")
def _(s):
    return cv.client_month(june(s), s.vendedor, keys=("id_articulo",))


ROLL_SQL = f"(SELECT id_sucursal, des_sucursal, count(*) padron FROM cli WHERE NOT anulado AND {OUT_SQL.replace('id_ruta', 'id_ruta_fv1')} GROUP BY 1,2)"


@query("c14_active_roll", sql=f"SELECT * FROM {ROLL_SQL}")
def _(s):
    return cv.active_roll(s.cliente, OUT)


Q2 = "fecha_comprobante BETWEEN '2001-04-01' AND '2001-06-30'"
MONTHS = ["2001-04", "2001-05", "2001-06"]
MA = [*MONTHS, "acum"]


def q2(s, keys=("marca",)):
    return cv.client_month(fl.dates(s.lineas_cliente, "2001-04-01", M1), s.vendedor, keys=keys)


CONCEPTS = [("Brand#1", "B1", "marca"), ("Brand#2", "B2", "marca"), ("Brand#3", "B3", "marca"), ("Brand#1", "GRUPO", "grupo"),
            ("Brand#2", "GRUPO", "grupo"), *[(f"Brand#{k}", "TOTAL AGUAS", "total") for k in (1, 2, 3)]]
CON_CTE = "con AS (SELECT * FROM (VALUES " + ",".join(str(c) for c in CONCEPTS) + ") c(marca,fila,tipo))"
SX = f"s0 AS (SELECT * FROM {cm_sql('marca', Q2)})"


def _c15():
    mes = "(SELECT *, unnest([mes,'acum']) m2 FROM (SELECT s0.*, fila FROM s0 JOIN con USING (marca)))"
    return f"""{SX}, {CON_CTE}, r AS (SELECT id_sucursal, des_sucursal sucursal, padron, false es_total_general FROM {ROLL_SQL}
 UNION ALL SELECT NULL,'TOTAL GENERAL',sum(padron),true FROM {ROLL_SQL}),
c AS (SELECT id_sucursal, false tg, fila, m2, clientes FROM {cov('id_sucursal, fila, m2', mes, 'bultos', having=False)}
 UNION ALL SELECT NULL, true, fila, m2, clientes FROM {cov('fila, m2', mes, 'bultos', having=False)}),
w AS (SELECT id_sucursal, tg, fila, {W('m2', MA, {'cob': 'clientes'})} FROM c GROUP BY 1,2,3),
g AS (SELECT r.*, k.fila, k.tipo, {', '.join(f'coalesce(cob_{slug(m)},0) cob_{slug(m)}' for m in MA)} FROM r CROSS JOIN (SELECT DISTINCT fila, tipo FROM con) k
 LEFT JOIN w ON w.id_sucursal IS NOT DISTINCT FROM r.id_sucursal AND w.tg=r.es_total_general AND w.fila=k.fila)
SELECT g.*, b.cob_acum base, CASE WHEN b.cob_acum>0 THEN g.cob_acum/b.cob_acum ELSE 0 END pct_acum, CASE WHEN g.padron>0 THEN g.cob_acum/g.padron ELSE 0 END pct_padron
FROM g JOIN g b ON b.fila='TOTAL AGUAS' AND b.id_sucursal IS NOT DISTINCT FROM g.id_sucursal AND b.es_total_general=g.es_total_general"""


@query("c15_concept_table", f="pct_acum pct_padron", i="padron base " + names(MA, "cob"), sql=_c15())
def _(s):
    con = s.spark.createDataFrame(CONCEPTS, "marca string, fila string, tipo string")
    return cv.concept_table(q2(s), cv.active_roll(s.cliente, OUT), con, "TOTAL AGUAS", MONTHS)


DIMF, DIMI = names(MA, "bultos", "hl"), names(MA, "cob")


def dim_sql(level: str, cols: dict[str, str]) -> str:
    """One level of the dimension table; ``cols`` maps every output key to its expression or NULL."""
    keys = ", ".join(c for c, e in cols.items() if e != "NULL")
    keys = f"{keys}, " if keys else ""
    sel = ", ".join(f"{c}" if e != "NULL" else f"NULL::{'BIGINT' if c.startswith('id_') else 'VARCHAR'} {c}" for c, e in cols.items())
    x = f"(SELECT {keys}m2, count(*) FILTER (n>0) clientes, sum(n) volumen, sum(h) hectolitros FROM (SELECT {keys}m2, id_sucursal xs, id_cliente xc, sum(bultos) n, sum(hectolitros) h FROM sx GROUP BY ALL) GROUP BY ALL)"
    grp = f"GROUP BY {keys[:-2]}" if keys else ""
    return f"SELECT '{level}' nivel, {sel}, {W('m2', MA, cv.MEASURES)} FROM {x} {grp}"


SXM = SX + ", sx AS (SELECT *, unnest([mes,'acum']) m2 FROM s0)"


@query("c16_branch_table", f=DIMF + " pct_padron", i=DIMI + " padron", sql=f"""{SXM}, t AS ({dim_sql('fila', {'id_sucursal': 'x', 'des_sucursal': 'x'})} UNION ALL {dim_sql('total', {'id_sucursal': 'NULL', 'des_sucursal': 'NULL'})}),
r AS (SELECT id_sucursal, padron FROM {ROLL_SQL}), t2 AS (SELECT t.*, CASE WHEN nivel='total' THEN (SELECT sum(padron) FROM r WHERE id_sucursal IN (SELECT id_sucursal FROM s0)) ELSE coalesce(r.padron,0) END padron FROM t LEFT JOIN r USING (id_sucursal))
SELECT *, CASE WHEN padron>0 THEN cob_acum/padron ELSE 0 END pct_padron FROM t2""")
def _(s):
    sales = q2(s)
    t = cv.dimension_table(sales, ["id_sucursal", "des_sucursal"], MONTHS, total=True)
    return cv.with_roll(t, cv.active_roll(s.cliente, OUT), sales, MONTHS)


@query("c17_brand_table_total", f=DIMF, i=DIMI, sql=f"{SXM} {dim_sql('fila', {'marca': 'x'})} UNION ALL {dim_sql('total', {'marca': 'NULL'})}")
def _(s):
    return cv.dimension_table(q2(s), ["marca"], MONTHS, total=True)


@query("c18_universe_blocks", f=DIMF, i=DIMI, sql=f"""{SXM}, f AS ({dim_sql('fila', {'des_sucursal': 'x', 'marca': 'x'})}),
g AS (SELECT 'fila' nivel, * FROM (SELECT DISTINCT des_sucursal FROM s0) CROSS JOIN (SELECT DISTINCT marca FROM s0))
SELECT g.nivel, g.des_sucursal, g.marca, {', '.join(f'coalesce({c},0) {c}' for c in (DIMF + ' ' + DIMI).split())} FROM g LEFT JOIN f USING (des_sucursal, marca)
UNION ALL SELECT nivel, des_sucursal, marca, {', '.join((DIMF + ' ' + DIMI).split())} FROM ({dim_sql('bloque', {'des_sucursal': 'x', 'marca': 'NULL'})})""")
def _(s):
    return cv.universe_blocks(q2(s), MONTHS)


@query("c19_supervisor_blocks", f=DIMF + " pct_padron", i=DIMI + " padron", sql=f"""s00 AS (SELECT * FROM {cm_sql('marca', Q2)}),
s0 AS (SELECT s00.*, coalesce(CASE WHEN su.id_sucursal%4<>0 THEN su.zona END,'SIN SUPERVISOR') supervisor FROM s00 JOIN suc su USING (id_sucursal)),
sx AS (SELECT *, unnest([mes,'acum']) m2 FROM s0), t AS ({dim_sql('fila', {'supervisor': 'x', 'des_sucursal': 'x'})} UNION ALL {dim_sql('bloque', {'supervisor': 'x', 'des_sucursal': 'NULL'})}),
r0 AS (SELECT r.*, coalesce(CASE WHEN su.id_sucursal%4<>0 THEN su.zona END,'SIN SUPERVISOR') supervisor FROM {ROLL_SQL} r JOIN suc su USING (id_sucursal) WHERE id_sucursal IN (SELECT id_sucursal FROM s0)),
r AS (SELECT 'fila' nivel, supervisor, des_sucursal, padron FROM r0 UNION ALL SELECT 'bloque', supervisor, NULL, sum(padron) FROM r0 GROUP BY 2)
SELECT t.*, coalesce(r.padron,0) padron, CASE WHEN r.padron>0 THEN cob_acum/r.padron ELSE 0 END pct_padron FROM t LEFT JOIN r
 ON t.nivel=r.nivel AND t.supervisor=r.supervisor AND t.des_sucursal IS NOT DISTINCT FROM r.des_sucursal""")
def _(s):
    m = s.sucursal.filter("id_sucursal % 4 <> 0").select(F.col("descripcion").alias("sucursal"), F.col("zona").alias("supervisor"))
    return cv.supervisor_blocks(q2(s), cv.active_roll(s.cliente, OUT), m, MONTHS)


BRANDS = [f"Brand#{k}" for k in range(1, 26)]


@query("c20_brand_matrix", f=names(BRANDS, "m") + " total", sql=f"{SX}, w AS (SELECT des_sucursal, {W('marca', BRANDS, {'m': 'bultos'})} FROM s0 GROUP BY 1) SELECT *, {'+'.join('m_' + slug(b) for b in BRANDS)} total FROM w")
def _(s):
    return cv.brand_matrix(q2(s), BRANDS)


# -- sizes: p_size in four classes plus OTRO
SIZE = "CASE WHEN calibre::INT<=10 THEN '300' WHEN calibre::INT<=20 THEN '473' WHEN calibre::INT<=30 THEN '1000' WHEN calibre::INT<=40 THEN '2250' ELSE 'OTRO' END"
SIZES = ["300", "473", "1000", "2250"]


def sizes(s, a=M0, b=M1):
    n = F.col("calibre").cast("int")
    cal = F.when(n <= 10, "300").when(n <= 20, "473").when(n <= 30, "1000").when(n <= 40, "2250").otherwise("OTRO")
    return fl.dates(s.lineas_cliente, a, b).filter("not anulado").withColumn("calibre", cal).withColumnRenamed("cantidades_total", "bultos")


SZ = f"sz AS (SELECT * REPLACE ({SIZE} AS calibre), cantidades_total bultos FROM l WHERE {JUNE} AND NOT anulado)"
ROLL0 = "(SELECT id_sucursal, des_sucursal, count(*) padron FROM cli WHERE NOT anulado GROUP BY 1,2)"
S5 = [*SIZES, "OTRO", "total"]


@query("c21_size_by_branch", f=names(S5, "vol", "pct"), i=names(S5, "cob") + " padron", sql=f"""{SZ}, c AS (SELECT id_sucursal, false tg, calibre, clientes, volumen FROM {cov('id_sucursal, calibre', 'sz', 'bultos')}
UNION ALL SELECT id_sucursal, false, 'total', clientes, volumen FROM {cov('id_sucursal', 'sz', 'bultos')}
UNION ALL SELECT NULL, true, calibre, clientes, volumen FROM {cov('calibre', 'sz', 'bultos')} UNION ALL SELECT NULL, true, 'total', clientes, volumen FROM {cov('', 'sz', 'bultos')}),
w AS (SELECT id_sucursal, tg, {W('calibre', S5, {'cob': 'clientes', 'vol': 'volumen'})} FROM c GROUP BY 1,2),
h AS (SELECT id_sucursal, des_sucursal sucursal, padron, false es_total_general FROM {ROLL0} UNION ALL SELECT NULL,'TOTAL GENERAL',sum(padron),true FROM {ROLL0})
SELECT h.*, {', '.join(f'coalesce({p}_{z},0) {p}_{z}' for p in ('cob', 'vol') for z in S5)}, {', '.join(f'CASE WHEN padron>0 THEN coalesce(cob_{z},0)/padron ELSE 0 END pct_{z}' for z in S5)}
FROM h LEFT JOIN w ON h.id_sucursal IS NOT DISTINCT FROM w.id_sucursal AND h.es_total_general=w.tg""")
def _(s):
    return cv.size_by_branch(sizes(s), cv.active_roll(s.cliente), [*SIZES, "OTRO"])


@query("c21_size_summary", f="pct_penetracion pct_padron bultos pct_mix drop_size", sql=f"""{SZ}, t AS (SELECT * FROM {cov('', 'sz', 'bultos')}), p AS (SELECT sum(padron) p FROM {ROLL0}),
a AS (SELECT calibre, count(DISTINCT id_articulo) articulos FROM sz GROUP BY 1), c AS (SELECT * FROM {cov('calibre', 'sz', 'bultos')}),
x AS (SELECT a.calibre, articulos, coalesce(clientes,0) cobertura, coalesce(volumen,0) bultos FROM a LEFT JOIN c USING (calibre)
 UNION ALL SELECT 'TOTAL', (SELECT count(DISTINCT id_articulo) FROM sz), clientes, volumen FROM t)
SELECT x.calibre, articulos, cobertura, cobertura/t.clientes pct_penetracion, cobertura/p.p pct_padron, bultos, bultos/t.volumen pct_mix, coalesce(bultos/nullif(cobertura,0),0) drop_size FROM x CROSS JOIN t CROSS JOIN p""")
def _(s):
    return cv.size_summary(sizes(s), cv.active_roll(s.cliente))


IDENT = ["id_sucursal", "sucursal", "id_cliente", "fantasia", "id_ruta", "des_personal_fv1"]
S5B = [*SIZES, "OTRO"]


@query("c22_client_sizes", f=names(S5B, "cal") + " total_bultos", i="calibres_comprados", sql=f"""{SZ}, w AS (SELECT {', '.join(IDENT)}, {W('calibre', S5B, {'cal': 'bultos'})} FROM sz GROUP BY ALL)
SELECT *, {'+'.join(f'cal_{z}' for z in S5B)} total_bultos, {'+'.join(f'(cal_{z}>0)::INT' for z in S5B)} calibres_comprados FROM w WHERE {'+'.join(f'cal_{z}' for z in S5B)}>0""")
def _(s):
    return cv.client_sizes(sizes(s), IDENT, S5B)


@query("c23_size_brand_matrix", sql=f"""{SZ}, z AS (SELECT *, unnest(CASE WHEN calibre='OTRO' THEN ['TOTAL'] ELSE [calibre,'TOTAL'] END) fila FROM sz),
y AS (SELECT *, unnest(list_filter([CASE WHEN marca IN ('Brand#1','Brand#2','Brand#3') THEN marca END, CASE WHEN marca IN ('Brand#1','Brand#2') THEN 'TOTAL AGUA' WHEN marca='Brand#3' THEN 'TOTAL ISO' END,'TOTAL'], lambda x: x IS NOT NULL)) columna FROM z)
SELECT fila, columna, clientes FROM {cov('fila, columna', 'y', 'bultos', having=False)}""")
def _(s):
    return cv.size_brand_matrix(sizes(s), {"AGUA": ["Brand#1", "Brand#2"], "ISO": ["Brand#3"]})


PER = "CASE WHEN fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-30' THEN 'actual' WHEN fecha_comprobante BETWEEN '2001-05-01' AND '2001-05-31' THEN 'anterior' WHEN fecha_comprobante BETWEEN '2000-06-01' AND '2000-06-30' THEN 'anio' END"
SZP = f"szp AS (SELECT * REPLACE ({SIZE} AS calibre), cantidades_total bultos, {PER} periodo FROM l WHERE NOT anulado AND {PER} IS NOT NULL)"


def sizes_periods(s):
    a = [("actual", M0, M1), ("anterior", "2001-05-01", "2001-05-31"), ("anio", "2000-06-01", "2000-06-30")]
    out = [sizes(s, x, y).withColumn("periodo", F.lit(n)) for n, x, y in a]
    return out[0].unionByName(out[1]).unionByName(out[2])


def cells(df, *keys):
    """Client grain: units per client and the given keys."""
    return df.groupBy(*dict.fromkeys([*keys, *cv.CLIENT])).agg(F.sum("bultos").alias("bultos"))


P3 = ["actual", "anterior", "anio"]
C24 = """cl AS (SELECT {k}calibre, id_sucursal xs, id_cliente xc, periodo, sum(bultos) bultos FROM szp GROUP BY ALL HAVING sum(bultos)>0),
d AS (SELECT DISTINCT {k}unnest([calibre,'TOTAL']) detalle, xs, xc, periodo FROM cl),
t AS (SELECT {k}detalle, count(*) FILTER (periodo='actual') cob_actual, count(*) FILTER (periodo='anterior') cob_anterior, count(*) FILTER (periodo='anio') cob_anio FROM d GROUP BY ALL)
SELECT *, cob_actual-cob_anterior var_anterior, cob_actual-cob_anio var_anio FROM t"""


@query("c24_period_comparison", sql=SZP + ", " + C24.format(k=""))
def _(s):
    return cv.period_comparison(cells(sizes_periods(s), "calibre", "periodo"), [], P3)


@query("c24_period_comparison_by_zone", sql=SZP + ", " + C24.format(k="sucursal, "))
def _(s):
    return cv.period_comparison(cells(sizes_periods(s), "sucursal", "calibre", "periodo"), ["sucursal"], P3)


Y12 = [f"2000-{m:02d}" for m in range(1, 13)]
FLAV = "CASE WHEN des_articulo ILIKE '%red%' THEN 'ROJA' WHEN des_articulo ILIKE '%blue%' THEN 'NEGRA' ELSE 'OTRO' END"


def flavours(df):
    f = F.when(F.col("des_articulo").ilike("%red%"), "ROJA").when(F.col("des_articulo").ilike("%blue%"), "NEGRA").otherwise("OTRO")
    return df.withColumn("sabor", f).withColumn("mes", F.date_format("fecha_comprobante", "yyyy-MM"))


def _c25():
    Y = [*Y12, "anio"]
    src = f"(SELECT sucursal, sabor, calibre, id_sucursal, id_cliente, unnest([mes,'anio']) mes FROM fl0)"
    lv = {"celda": "sucursal, sabor, calibre", "sucursal": "sucursal", "total": ""}
    parts = []
    for n, k in lv.items():
        sel = ", ".join(c if c in k.split(", ") else f"NULL::VARCHAR {c}" for c in ("sucursal", "sabor", "calibre"))
        kk = f"{k}, " if k else ""
        parts.append(f"SELECT '{n}' nivel, {sel}, {W('mes', Y, {'cob': 'c'})} FROM (SELECT {kk}mes, count(DISTINCT (id_sucursal,id_cliente)) c FROM {src} GROUP BY ALL) {'GROUP BY ' + k if k else ''}")
    return f"""fl0 AS (SELECT sucursal, {FLAV} sabor, {SIZE} calibre, id_sucursal, id_cliente, strftime(fecha_comprobante,'%Y-%m') mes FROM l
 WHERE NOT anulado AND year(fecha_comprobante)=2000 GROUP BY ALL HAVING sum(cantidades_total)>0) """ + " UNION ALL ".join(parts)


@query("c25_monthly_year_coverage", i=names([*Y12, "anio"], "cob"), sql=_c25())
def _(s):
    df = cells(flavours(sizes(s, "2000-01-01", "2000-12-31")), "sucursal", "sabor", "calibre", "mes")
    return cv.monthly_year_coverage(df, 2000, ["sabor", "calibre"])


BLOCKS = [{"sabor": "ROJA", "calibre": "300", "meses": ["2001-05", "2001-06"]}, {"sabor": "NEGRA", "calibre": "473", "meses": ["2001-06"]},
          {"sabor": "ROJA", "calibre": "300", "meses": ["2001-04"]}]


@query("c26_rep_blocks", sql=f"""b AS (SELECT * FROM (VALUES (0,'ROJA','300','2001-05'),(0,'ROJA','300','2001-06'),(1,'NEGRA','473','2001-06'),(2,'ROJA','300','2001-04')) t(bloque,sabor,calibre,mes)),
f AS (SELECT sucursal, des_personal_fv1 preventista, {FLAV} sabor, {SIZE} calibre, id_sucursal xs, id_cliente xc, strftime(fecha_comprobante,'%Y-%m') mes FROM l WHERE NOT anulado AND {Q2} GROUP BY ALL HAVING sum(cantidades_total)>0),
j AS (SELECT f.*, b.bloque::BIGINT bloque FROM f JOIN b USING (sabor, calibre, mes))
SELECT 'vendedor' nivel, sucursal, preventista, bloque, mes, count(DISTINCT (xs,xc)) clientes FROM j GROUP BY ALL
UNION ALL SELECT 'total', NULL, NULL, bloque, mes, count(DISTINCT (xs,xc)) FROM j GROUP BY ALL""")
def _(s):
    df = flavours(sizes(s, "2001-04-01", M1)).withColumnRenamed("des_personal_fv1", "preventista")
    return cv.rep_blocks(cells(df, "sucursal", "preventista", "sabor", "calibre", "mes"), BLOCKS, ["sucursal", "preventista"])


P2 = [f"{z}_{p}" for z in SIZES for p in ("actual", "anterior")]


@query("c27_client_detail", f=" ".join(f"cal_{x}" for x in P2), sql=f"""{SZP} SELECT id_cliente, id_sucursal, sucursal, des_personal_fv1,
{', '.join(f"coalesce(sum(CASE WHEN calibre='{z}' AND periodo='{p}' THEN bultos END),0) cal_{z}_{p}" for z in SIZES for p in ('actual', 'anterior'))}
FROM szp WHERE periodo IN ('actual','anterior') GROUP BY ALL""")
def _(s):
    return cv.client_period_sizes(sizes_periods(s), ["id_cliente", "id_sucursal", "sucursal", "des_personal_fv1"], SIZES, ["actual", "anterior"])


@query("c28_incentive_coverage", sql=f"""d AS (SELECT * FROM (VALUES ('ROJA','300'),('NEGRA','473')) c(sabor,calibre) CROSS JOIN (VALUES ('2001-05'),('2001-06'),('2001-07')) m(mes)),
f AS (SELECT des_personal_fv1 preventista, {FLAV} sabor, {SIZE} calibre, id_sucursal, id_cliente, strftime(fecha_comprobante,'%Y-%m') mes, cantidades_total bultos FROM l
 WHERE NOT anulado AND fecha_comprobante BETWEEN '2001-05-01' AND '2001-06-30'), s2 AS (SELECT f.* FROM f SEMI JOIN d USING (sabor,calibre,mes)),
c AS (SELECT 'vendedor' nivel, preventista, sabor, calibre, mes, clientes FROM {cov('preventista, sabor, calibre, mes', 's2', 'bultos', 20, False)}
 UNION ALL SELECT 'total', NULL, sabor, calibre, mes, clientes FROM {cov('sabor, calibre, mes', 's2', 'bultos', 20, False)}),
h AS (SELECT DISTINCT 'vendedor' nivel, preventista FROM s2 UNION ALL SELECT 'total', NULL)
SELECT h.nivel, h.preventista, d.sabor, d.calibre, d.mes, CASE WHEN d.mes<='2001-06' THEN coalesce(c.clientes,0) END clientes FROM h CROSS JOIN d
LEFT JOIN c ON c.nivel=h.nivel AND c.preventista IS NOT DISTINCT FROM h.preventista AND c.sabor=d.sabor AND c.calibre=d.calibre AND c.mes=d.mes""")
def _(s):
    df = flavours(sizes(s, "2001-05-01", M1)).withColumnRenamed("des_personal_fv1", "preventista")
    return cv.incentive_coverage(df, "preventista", [("ROJA", "300"), ("NEGRA", "473")], ["2001-05", "2001-06", "2001-07"], M1, 20.0)


def rep_clients(s, brands):
    from retail_analytics.plans.b_filters import supervisor_map
    v = s.vendedor.select("id_vendedor", "id_sucursal", F.col("des_vendedor").alias("vendedor"))
    df = fl.dates(s.lineas_cliente, "2001-05-01", M1).filter(F.col("marca").isin(brands))
    df = df.join(v, ["id_vendedor", "id_sucursal"]).withColumn("periodo", F.date_format("fecha_comprobante", "yyyyMM"))
    df = df.groupBy("vendedor", "id_cliente", "periodo").agg(F.sum("cantidades_total").alias("bultos"))
    return fl.with_supervisor(df, supervisor_map(s))


def _c29():
    from retail_analytics.plans.b_filters import SUP_CTE
    P = ["200105", "200106"]

    def src(brands):
        return f"""(SELECT supervisor, des_vendedor vendedor, id_cliente, strftime(fecha_comprobante,'%Y%m') periodo, sum(cantidades_total) bultos FROM l
 JOIN sup USING (id_vendedor, id_sucursal) WHERE fecha_comprobante BETWEEN '2001-05-01' AND '2001-06-30' AND marca IN ({brands}) GROUP BY ALL)"""

    def lv(cte):
        return " UNION ALL ".join(f"SELECT '{n}' nivel, {k} periodo, sum(bultos) bultos, count(DISTINCT CASE WHEN bultos>0 THEN id_cliente END) cobertura FROM {cte} GROUP BY ALL"
                                  for n, k in (("vendedor", "supervisor, vendedor,"), ("supervisor", "supervisor, NULL::VARCHAR vendedor,"), ("total", "NULL::VARCHAR supervisor, NULL::VARCHAR vendedor,")))
    return f"""{SUP_CTE}, a AS {src("'Brand#1','Brand#2','Brand#3','Brand#4'")}, b AS {src("'Brand#5','Brand#6'")}, la AS ({lv('a')}), lb AS ({lv('b')}),
wa AS (SELECT nivel, supervisor, vendedor, {W('periodo', P, {'bultos': 'bultos', 'cobertura': 'cobertura'})} FROM la GROUP BY 1,2,3),
wb AS (SELECT nivel, supervisor, vendedor, {W('periodo', P, {'objetivo': 'round(cobertura*0.35)'})} FROM lb GROUP BY 1,2,3)
SELECT wa.*, coalesce(objetivo_200105,0) objetivo_200105, coalesce(objetivo_200106,0) objetivo_200106 FROM wa LEFT JOIN wb ON wa.nivel=wb.nivel
 AND wa.supervisor IS NOT DISTINCT FROM wb.supervisor AND wa.vendedor IS NOT DISTINCT FROM wb.vendedor"""


@query("c29_rep_period_report", f="bultos_200105 bultos_200106", i="cobertura_200105 cobertura_200106 objetivo_200105 objetivo_200106", sql=_c29())
def _(s):
    a = rep_clients(s, ["Brand#1", "Brand#2", "Brand#3", "Brand#4"])
    return cv.rep_period_report(a, rep_clients(s, ["Brand#5", "Brand#6"]), ["200105", "200106"], 0.35)


@query("c30_volume_and_coverage", f="bultos_200105 bultos_200106", i="cobertura_200105 cobertura_200106", sql=f"""{COBL}, v AS (SELECT marca, strftime(fecha_comprobante,'%Y%m') periodo, sum(cantidades_total) bultos FROM l
 WHERE generico='PROMO' AND id_sucursal=1 AND fecha_comprobante BETWEEN '2001-05-01' AND '2001-06-30' GROUP BY 1,2),
c AS (SELECT marca, strftime(periodo,'%Y%m') periodo, {CC} cobertura FROM {cob_sql('cob_sucursal_marca', "periodo IN ('2001-05-01','2001-06-01') AND id_fuerza_ventas=1 AND id_sucursal=1")} WHERE marca IN (SELECT marca FROM art WHERE generico='PROMO')),
b AS (SELECT marca, periodo, bultos, NULL::BIGINT cobertura FROM v UNION ALL SELECT marca, periodo, NULL, cobertura FROM c)
SELECT marca, {W('periodo', ['200105', '200106'], {'bultos': 'bultos', 'cobertura': 'cobertura'})} FROM b GROUP BY 1""")
def _(s):
    v = fl.dates(s.lineas_cliente, "2001-05-01", M1).filter("generico = 'PROMO' and id_sucursal = 1").groupBy(
        "marca", F.date_format("fecha_comprobante", "yyyyMM").alias("periodo")).agg(F.sum("cantidades_total").alias("bultos"))
    c = cob(s, "cob_sucursal_marca", "2001-05-01").filter("id_fuerza_ventas = 1 and id_sucursal = 1")
    c = cv.category_brand_coverage(c, s.articulo, "PROMO").select("marca", F.date_format("periodo", "yyyyMM").alias("periodo"), F.col(CC).alias("cobertura"))
    return cv.volume_and_coverage(v, c, ["200105", "200106"])


@query("c31_quota_sheet", i="cob_200105 cob_200106", sql=f"""{COBL}, c AS (SELECT marca, strftime(periodo,'%Y%m') periodo, {CC} cobertura FROM {cob_sql('cob_sucursal_marca', "periodo IN ('2001-05-01','2001-06-01') AND id_fuerza_ventas=1 AND id_sucursal=4")}
 WHERE marca IN (SELECT marca FROM art WHERE generico='SMALL')), u AS (SELECT DISTINCT marca FROM art WHERE generico='SMALL'),
x AS (SELECT * FROM c UNION ALL SELECT marca, NULL, NULL FROM u) SELECT marca, {W('periodo', ['200105', '200106'], {'cob': 'cobertura'})} FROM x GROUP BY 1""")
def _(s):
    c = cob(s, "cob_sucursal_marca", "2001-05-01").filter("id_fuerza_ventas = 1 and id_sucursal = 4")
    c = cv.category_brand_coverage(c, s.articulo, "SMALL").select("marca", F.date_format("periodo", "yyyyMM").alias("periodo"), F.col(CC).alias("cobertura"))
    return cv.quota_sheet(c, cv.brands_of(s.articulo, "SMALL"), ["200105", "200106"])


@query("c32_period_pivot", i=names(MONTHS, "cob"), sql=f"""{COBL}, c AS (SELECT * FROM {cob_sql('cob_preventista_generico', "periodo BETWEEN '2001-04-01' AND '2001-06-01' AND id_fuerza_ventas=1")})
SELECT coalesce(id_ruta,-1) id_ruta, ds_sucursal, generico, {W("strftime(periodo,'%Y-%m')", MONTHS, {'cob': CC})} FROM c GROUP BY 1,2,3""")
def _(s):
    c = cob(s, "cob_preventista_generico", "2001-04-01").filter("id_fuerza_ventas = 1")
    return cv.period_pivot(c, ["id_ruta", "ds_sucursal", "generico"], MONTHS)


def hist(s, name):
    return cv.coverage_table(fl.dates(s.lineas_cliente, "1999-01-01", "2001-12-31"), name)


H3 = "year(periodo) IN (1999,2000,2001)"


def ysql(name: str, keys: str, extra: str = "TRUE") -> str:
    return f"(SELECT year(periodo) anio, month(periodo) mes, {keys}, sum({CC}) clientes FROM {cob_sql(name, H3 + ' AND id_fuerza_ventas=1 AND ' + extra)} GROUP BY ALL)"


@query("c33_yearly_route_coverage", i="anio mes clientes", sql=f"{COBL} SELECT * FROM {ysql('cob_preventista_marca', 'id_ruta, marca', 'id_sucursal=1')}")
def _(s):
    return cv.yearly(hist(s, "cob_preventista_marca").filter("id_sucursal = 1"), ["id_ruta", "marca"], [1999, 2000, 2001], 1)


@query("c33_yearly_branch_coverage", i="anio mes clientes", sql=f"{COBL} SELECT * FROM {ysql('cob_sucursal_generico', 'generico')}")
def _(s):
    return cv.yearly(hist(s, "cob_sucursal_generico"), ["generico"], [1999, 2000, 2001], 1)


@query("c33_yearly_subdivision_coverage", i="anio mes clientes", sql=f"""{COBL}, {GRP_CTE}, c AS (SELECT * FROM {cov('periodo, id_fuerza_ventas, id_sucursal, subdivision', '(SELECT * FROM cobl JOIN grp USING (marca))')})
SELECT year(periodo) anio, month(periodo) mes, id_sucursal, subdivision, sum(clientes) clientes FROM c WHERE id_fuerza_ventas=1 AND {H3} GROUP BY ALL""")
def _(s):
    g = s.spark.createDataFrame(GROUPS, "marca string, subdivision string")
    c = cv.group_coverage(s.lineas_cliente, g, "marca", "subdivision", ["periodo", "id_fuerza_ventas", "id_sucursal"])
    return cv.yearly(c, ["id_sucursal", "subdivision"], [1999, 2000, 2001], 1)


def routes_and_inland(s):
    r = cv.yearly(hist(s, "cob_preventista_marca").filter("id_sucursal = 1"), ["id_ruta", "marca"], [1999, 2000, 2001], 1)
    i = cv.yearly(hist(s, "cob_sucursal_marca").filter("id_sucursal in (4, 5, 6)"), ["marca"], [1999, 2000, 2001], 1)
    return cv.reassign_routes(r, i, [2, 3], "marca")


@query("c34_reassign_routes", i="anio mes clientes", sql=f"""{COBL}, r AS (SELECT * FROM {ysql('cob_preventista_marca', 'id_ruta, marca', 'id_sucursal=1')}), i AS (SELECT * FROM {ysql('cob_sucursal_marca', 'marca', 'id_sucursal IN (4,5,6)')})
SELECT 'ciudad' destino, anio, mes, marca, sum(clientes) clientes FROM r WHERE id_ruta NOT IN (2,3) OR id_ruta IS NULL GROUP BY ALL
UNION ALL SELECT 'interior', anio, mes, marca, sum(clientes) FROM (SELECT anio,mes,marca,clientes FROM i UNION ALL SELECT anio,mes,marca,clientes FROM r WHERE id_ruta IN (2,3)) GROUP BY ALL""")
def _(s):
    city, inland = routes_and_inland(s)
    c = city.groupBy("anio", "mes", "marca").agg(F.sum("clientes").alias("clientes")).withColumn("destino", F.lit("ciudad"))
    return c.unionByName(inland.withColumn("destino", F.lit("interior")))


@query("c35_mixed_years", i="mes clientes", sql=f"""{COBL}, b AS (SELECT * FROM {ysql('cob_sucursal_marca', 'marca')})
SELECT mes, marca, clientes FROM b WHERE (anio=2001 AND mes<=5) OR (anio=2000 AND mes>5)""")
def _(s):
    return cv.mixed_years(cv.yearly(hist(s, "cob_sucursal_marca"), ["marca"], [1999, 2000, 2001], 1), 2001, 5)


ZONE_CTE = f"""r AS (SELECT * FROM {ysql('cob_preventista_generico', 'id_ruta, generico', 'id_sucursal=1 AND id_ruta NOT IN (2,3)')}),
b AS (SELECT * FROM {ysql('cob_sucursal_generico', 'id_sucursal, generico')}), zn AS (SELECT id_sucursal, CASE WHEN id_sucursal=1 THEN 'CAPITAL' ELSE zona END zona FROM suc),
zs AS (SELECT zona, anio, mes, generico, sum(clientes) clientes FROM (SELECT zona, anio, mes, generico, clientes FROM b JOIN zn USING (id_sucursal) WHERE zona<>'CAPITAL' OR anio>=2000
 UNION ALL SELECT 'CAPITAL', anio, mes, generico, clientes FROM r WHERE anio<2000) GROUP BY ALL)"""


def zone_series(s):
    r = cv.yearly(hist(s, "cob_preventista_generico").filter("id_sucursal = 1 and id_ruta not in (2, 3)"), ["id_ruta", "generico"], [1999, 2000, 2001], 1)
    b = cv.yearly(hist(s, "cob_sucursal_generico"), ["id_sucursal", "generico"], [1999, 2000, 2001], 1)
    z = s.sucursal.select("id_sucursal", F.when(F.col("id_sucursal") == 1, "CAPITAL").otherwise(F.col("zona")).alias("zona"))
    return cv.zone_series(r, b, z, "CAPITAL", 2000, "generico")


@query("c36_zone_series", i="anio mes clientes", sql=f"{COBL}, {ZONE_CTE} SELECT * FROM zs")
def _(s):
    return zone_series(s)


GRID = [f"{y}_{m:02d}" for y in (1999, 2000, 2001) for m in range(1, 13)]


@query("c37_zone_month_matrix", i=names(GRID, "c"), sql=f"{COBL}, {ZONE_CTE} SELECT zona, {W('anio||' + chr(39) + '_' + chr(39) + '||lpad(mes::VARCHAR,2,' + chr(39) + '0' + chr(39) + ')', GRID, {'c': 'clientes'})} FROM zs WHERE generico='PROMO' GROUP BY 1")
def _(s):
    return cv.month_matrix(zone_series(s).filter("generico = 'PROMO'"), [1999, 2000, 2001])


CATS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("c37_zone_year_matrix", i="anio " + names(CATS, "c"), sql=f"{COBL}, {ZONE_CTE} SELECT zona, anio, {W('generico', CATS, {'c': 'clientes'})} FROM zs GROUP BY 1,2")
def _(s):
    return wide(zone_series(s), ["zona", "anio"], "generico", CATS, {"c": "clientes"})


@query("c38_top_brands", i="clientes orden", sql=f"""{COBL}, b AS (SELECT marca, sum(clientes) clientes FROM {ysql('cob_sucursal_marca', 'marca')} GROUP BY 1)
SELECT marca, clientes, row_number() OVER (ORDER BY clientes DESC, marca) orden FROM b""")
def _(s):
    return cv.top_brands(cv.yearly(hist(s, "cob_sucursal_marca"), ["marca"], [1999, 2000, 2001], 1))


@query("c38_fixed_brands", i="clientes orden", sql=f"""{COBL}, b AS (SELECT marca, sum(clientes) clientes FROM {ysql('cob_sucursal_marca', 'marca')} GROUP BY 1)
SELECT marca, clientes, CASE marca WHEN 'Brand#7' THEN 1 WHEN 'Brand#3' THEN 2 END orden FROM b WHERE marca IN ('Brand#7','Brand#3')""")
def _(s):
    return cv.top_brands(cv.yearly(hist(s, "cob_sucursal_marca"), ["marca"], [1999, 2000, 2001], 1), ["Brand#7", "Brand#3", "NADA"])


@query("c39_year_on_year", f="variacion", i="mes actual anterior", sql=f"""{COBL}, y AS (SELECT zona, mes, coalesce(sum(clientes) FILTER (anio=2001),0) actual, coalesce(sum(clientes) FILTER (anio=2000),0) anterior
 FROM {ysql('cob_sucursal_generico', 'id_sucursal, generico')} JOIN suc USING (id_sucursal) WHERE anio>=2000 GROUP BY 1,2)
SELECT *, CASE WHEN anterior=0 THEN CASE WHEN actual=0 THEN 0 ELSE 100 END ELSE (actual-anterior)*100.0::DOUBLE/anterior END variacion FROM y""")
def _(s):
    y = cv.yearly(hist(s, "cob_sucursal_generico"), ["id_sucursal", "generico"], [2000, 2001], 1).join(s.sucursal, "id_sucursal")
    y = y.groupBy("zona", "mes").agg(F.coalesce(F.sum(F.when(F.col("anio") == 2001, F.col("clientes"))), F.lit(0)).alias("actual"),
                                     F.coalesce(F.sum(F.when(F.col("anio") == 2000, F.col("clientes"))), F.lit(0)).alias("anterior"))
    return y.withColumn("variacion", yoy("actual", "anterior"))


Q40 = """q40 AS (SELECT sucursal, year(fecha_comprobante) anio, quarter(fecha_comprobante) trimestre, id_cliente, sum(cantidades_total) bultos,
 sum(CASE WHEN coalesce(bonificacion,0)<100 THEN cantidades_total ELSE 0 END) bultos_sin_regalos, sum(CASE WHEN generico='SMALL' THEN cantidades_total ELSE 0 END) bultos_especial,
 sum(CASE WHEN generico='SMALL' AND coalesce(bonificacion,0)<100 THEN cantidades_total ELSE 0 END) bultos_especial_sin_regalos, count(DISTINCT month(fecha_comprobante)) meses_con_compra
 FROM l WHERE generico IN ('PROMO','SMALL','LARGE') AND fecha_comprobante BETWEEN '2000-07-01' AND '2001-06-30' GROUP BY ALL)"""


def q40(s):
    df = fl.dates(s.lineas_cliente, "2000-07-01", M1)
    return cv.quarter_clients(df, ["PROMO", "SMALL", "LARGE"], "SMALL")


@query("c40_quarter_clients", f="bultos bultos_sin_regalos bultos_especial bultos_especial_sin_regalos", i="anio trimestre", sql=f"{Q40} SELECT * FROM q40")
def _(s):
    return q40(s)


@query("c40_quarter_thresholds", i="anio trimestre", sql=f"""{Q40} SELECT sucursal, anio, trimestre, count(*) FILTER (bultos>30) clientes_trimestre, count(*) FILTER (bultos/3>=10) clientes_promedio FROM q40 GROUP BY 1,2,3""")
def _(s):
    return cv.quarter_thresholds(q40(s), "bultos", 30, 10)


@query("c41_coverage_history", i="anio mes clientes", sql=f"""{COBL} SELECT year(periodo) anio, month(periodo) mes, id_lista_precio, sum({CC}) clientes FROM {cob_sql('cob_sucursal_lista_generico', H3 + " AND id_fuerza_ventas=1 AND generico='PROMO' AND ds_sucursal=(SELECT descripcion FROM suc WHERE id_sucursal=1)")} GROUP BY ALL""")
def _(s):
    branch = s.sucursal.filter("id_sucursal = 1").select("descripcion").scalar()
    c = hist(s, "cob_sucursal_lista_generico").filter((F.col("ds_sucursal") == branch) & (F.col("generico") == "PROMO"))
    return cv.yearly(c, ["id_lista_precio"], [1999, 2000, 2001], 1)


B42 = f"""b42 AS (SELECT id_cliente, sucursal, generico, marca, sum(cantidades_total) q FROM l WHERE {JUNE} GROUP BY ALL),
n42 AS (SELECT id_cliente, sucursal, {W('generico', ['PROMO', 'SMALL'], {'n': '(q>0)::INT'})} FROM b42 GROUP BY 1,2)"""


@query("c42_brands_per_client", i="n_PROMO n_SMALL", sql=f"{B42} SELECT * FROM n42")
def _(s):
    return cv.brands_per_client(june(s), ["PROMO", "SMALL"])


@query("c42_brands_per_buyer", f="prom_PROMO prom_SMALL", sql=f"{B42} SELECT sucursal, avg(n_PROMO) FILTER (n_PROMO>0) prom_PROMO, avg(n_SMALL) FILTER (n_SMALL>0) prom_SMALL FROM n42 GROUP BY 1")
def _(s):
    return cv.brands_per_buyer(cv.brands_per_client(june(s), ["PROMO", "SMALL"]), ["PROMO", "SMALL"])


# the test brands live under all categories, so the exclusion list is long enough to catch none at brand level but some at SKU-name level
@query("c43_relabelled_rep_coverage", sql=f"""{COBL}, c AS (SELECT * FROM {cob_sql('cob_preventista_marca', JUN_P + ' AND id_fuerza_ventas=1')}),
x AS (SELECT CASE WHEN p_partkey<12 THEN p_brand||'*' ELSE p_brand END marca, CASE WHEN p_partkey<12 THEN 'ENVASE' ELSE p_type END generico FROM part),
e AS (SELECT marca FROM x GROUP BY 1 HAVING bool_and(generico IN ('ENVASE')))
SELECT CASE WHEN c.id_sucursal=1 AND c.id_ruta IN (2,3) THEN 'VALLE' ELSE c.id_sucursal||' - '||c.ds_sucursal END lugar, v.des_vendedor vendedor, c.id_ruta ruta, c.marca concepto, c.{CC} clientes
FROM c LEFT JOIN ven v ON c.id_vendedor=v.id_vendedor AND c.id_sucursal=v.id_sucursal WHERE c.marca NOT IN (SELECT marca FROM e) AND c.marca NOT IN ('Brand#9')""")
def _(s):
    art = s.articulo.select("generico", "marca", "id_articulo")
    art = art.select(F.when(F.col("id_articulo") < 12, F.concat("marca", F.lit("*"))).otherwise(F.col("marca")).alias("marca"),
                     F.when(F.col("id_articulo") < 12, F.lit("ENVASE")).otherwise(F.col("generico")).alias("generico"))
    c = cob(s, "cob_preventista_marca").filter("id_fuerza_ventas = 1")
    c = c.join(cv.exclusive_brands(art, ["ENVASE"]), "marca", "left_anti").filter("marca not in ('Brand#9')")
    return cv.relabelled_rep_coverage(c, s.vendedor, "marca", [2, 3], "VALLE", 1)


@query("c43_exclusive_brands", sql="""x AS (SELECT CASE WHEN p_partkey<12 THEN p_brand||'*' ELSE p_brand END marca, CASE WHEN p_partkey<12 THEN 'ENVASE' ELSE p_type END generico FROM part)
SELECT marca FROM x GROUP BY 1 HAVING bool_and(generico IN ('ENVASE'))""")
def _(s):
    k = F.col("id_articulo") < 12
    art = s.articulo.select(F.when(k, F.concat("marca", F.lit("*"))).otherwise(F.col("marca")).alias("marca"),
                            F.when(k, F.lit("ENVASE")).otherwise(F.col("generico")).alias("generico"))
    return cv.exclusive_brands(art, ["ENVASE"])


@query("c44_coverage_vs_quota", f="objetivo faltan pct", i="pdv", sql=f"""{COBL}, c AS (SELECT id_sucursal, id_ruta, generico concepto, sum({CC}) pdv FROM {cob_sql('cob_preventista_generico', JUN_P + ' AND id_fuerza_ventas=1 AND id_ruta IS NOT NULL')} GROUP BY ALL),
q AS (SELECT id_sucursal, id_ruta, marca concepto, cupo objetivo FROM cupos_cob WHERE tipo_apertura='GENERICO'),
b AS (SELECT *, NULL::DOUBLE objetivo FROM c UNION ALL SELECT id_sucursal, id_ruta, concepto, NULL, objetivo FROM q),
t AS (SELECT 'fila' nivel, id_sucursal, id_ruta, concepto, coalesce(sum(pdv),0) pdv, coalesce(sum(objetivo),0) objetivo FROM b GROUP BY ALL
 UNION ALL SELECT 'total', id_sucursal, NULL, concepto, coalesce(sum(pdv),0), coalesce(sum(objetivo),0) FROM b GROUP BY ALL)
SELECT *, greatest(objetivo-pdv,0) faltan, pdv/nullif(objetivo,0) pct FROM t""")
def _(s):
    c = cob(s, "cob_preventista_generico").filter("id_fuerza_ventas = 1 and id_ruta is not null")
    c = c.groupBy("id_sucursal", "id_ruta", F.col("generico").alias("concepto")).agg(F.sum(CC).alias("pdv"))
    q = fl.repair_swapped(s.cupos_cobertura.filter("tipo_apertura = 'GENERICO'")).select("id_sucursal", "id_ruta", "concepto", F.col("cupo").alias("objetivo"))
    return cv.coverage_vs_quota(c, q, ["id_sucursal", "id_ruta", "concepto"], ["id_sucursal", "concepto"])


@query("c45_attainment", f="meta pct", i="clientes", sql=f"""{COBL}, c AS (SELECT vendedor, generico, clientes FROM {cov('vendedor, generico', '(SELECT * FROM cobl WHERE ' + JUN_P + ' AND id_fuerza_ventas=1)')}),
sv AS (SELECT des_vendedor vendedor, zona supervisor FROM ven JOIN suc USING (id_sucursal)),
j AS (SELECT sv.supervisor, c.vendedor, c.generico objetivo_label, c.clientes, (1+length(c.vendedor)%3+ascii(c.generico)%2)::DOUBLE meta FROM c JOIN sv USING (vendedor)),
t AS (SELECT 'vendedor' nivel, supervisor, vendedor, objetivo_label, sum(clientes) clientes, sum(meta) meta FROM j GROUP BY ALL
 UNION ALL SELECT 'supervisor', supervisor, NULL, objetivo_label, sum(clientes), sum(meta) FROM j GROUP BY ALL UNION ALL SELECT 'total', NULL, NULL, objetivo_label, sum(clientes), sum(meta) FROM j GROUP BY ALL)
SELECT *, clientes/meta pct, CASE WHEN clientes/meta>=1 THEN 'VERDE' WHEN clientes/meta>=0.5 THEN 'AMARILLO' ELSE 'ROJO' END semaforo FROM t""")
def _(s):
    c = cv.coverage(cv.force_lines(june(s)).filter("id_fuerza_ventas = 1"), ["vendedor", "generico"]).withColumnRenamed("generico", "objetivo_label")
    sv = s.vendedor.join(s.sucursal, "id_sucursal").select(F.col("des_vendedor").alias("vendedor"), F.col("zona").alias("supervisor"))
    goals = c.select("vendedor", "objetivo_label", (1 + F.length("vendedor") % 3 + F.ascii("objetivo_label") % 2).cast("double").alias("meta"))
    return cv.attainment(c.join(sv, "vendedor"), goals)


# half of all lines belong to one client, as with counter sales: its lines meet the client table by broadcast, the others by shuffle
@query("c1_coverage_heavy_client", f="volumen", sql="""hv AS (SELECT cantidades_total q, id_cliente, id_sucursal FROM fv UNION ALL SELECT cantidades_total, 14, (SELECT id_sucursal FROM cli WHERE id_cliente=14) FROM fv)
SELECT des_canal_mkt, id_lista_precio, count(DISTINCT hv.id_cliente) clientes, count(*) lineas, sum(q) volumen FROM hv LEFT JOIN cli ON cli.id_cliente=hv.id_cliente AND cli.id_sucursal=hv.id_sucursal GROUP BY 1,2""")
def _(s):
    one = s.cliente.filter("id_cliente = 14").agg(F.max("id_sucursal")).scalar()
    more = s.ventas.withColumns({"id_cliente": F.lit(14).cast("long"), "id_sucursal": one})
    lines = enrich(s.ventas.unionByName(more), s.articulo, s.sucursal, s.cliente, heavy=True)
    by_client = lines.groupBy("des_canal_mkt", "id_lista_precio", "id_cliente").agg(F.count(F.lit(1)).alias("lineas"), F.sum("cantidades_total").alias("volumen"))
    return by_client.groupBy("des_canal_mkt", "id_lista_precio").agg(F.count("id_cliente").alias("clientes"), F.sum("lineas").alias("lineas"), F.sum("volumen").alias("volumen"))


@query("c7_stored_layout_coverage", f="volumen", sql="""pc AS (SELECT id_cliente, id_sucursal, generico, sum(cantidades_total) q FROM l WHERE strftime(fecha_comprobante,'%Y-%m') IN ('2001-05','2001-06') GROUP BY ALL HAVING sum(cantidades_total)>0)
SELECT id_sucursal, generico, count(*) clientes, sum(q) volumen FROM pc GROUP BY 1,2""")
def _(s):
    """The lines are stored by month and client bucket first, then two months of them are read."""
    name = f"lineas_{uuid.uuid4().hex}"
    lines = s.lineas.select("id_cliente", "id_sucursal", "generico", "fecha_comprobante", "cantidades_total")
    stored = layout.store_lines(lines, name, f"{sinks.shared_dir(s.spark)}/{name}")
    return layout.buyers(stored, ["2001-05", "2001-06"], ["id_sucursal", "generico"])
