"""M: quota allocation.  Zones are the branches, history is the May sale, quotas are those of June."""
from __future__ import annotations

from pyspark.sql import functions as F

from retail_analytics.operators import coverage as cv, filters as fl, quota as qt
from retail_analytics.plans.registry import query
from retail_analytics.plans.sqltext import cov

MAY = "fecha_comprobante BETWEEN '2001-05-01' AND '2001-05-31' AND NOT anulado AND id_ruta IS NOT NULL"
# route x category with the branch total of the quota and the May sale as weight
BASE = f"""qz AS (SELECT id_sucursal, generico, sum(cupo) total FROM cupos WHERE periodo='2001-06' GROUP BY 1,2), rz AS (SELECT DISTINCT id_sucursal, id_ruta FROM rutas), hz AS (SELECT id_sucursal, id_ruta, generico, sum(cantidades_total) qty FROM l WHERE {MAY} GROUP BY 1,2,3),
b AS (SELECT q.id_sucursal, q.generico, r.id_ruta, q.total, coalesce(h.qty,0) qty FROM qz q JOIN rz r USING (id_sucursal) LEFT JOIN hz h ON h.id_sucursal=q.id_sucursal AND h.id_ruta=r.id_ruta AND h.generico=q.generico)"""


def may(s):
    return fl.dates(s.lineas, "2001-05-01", "2001-05-31").filter("not anulado and id_ruta is not null")


def base(s):
    q = s.cupos.filter("periodo = '2001-06'").groupBy("id_sucursal", "generico").agg(F.sum("cupo").alias("total"))
    r = s.cliente.filter("id_ruta_fv1 is not null").select("id_sucursal", F.col("id_ruta_fv1").alias("id_ruta")).distinct()
    h = may(s).groupBy("id_sucursal", "id_ruta", "generico").agg(F.sum("cantidades_total").alias("qty"))
    return q.join(r, "id_sucursal").join(h, ["id_sucursal", "id_ruta", "generico"], "left").fillna(0, subset=["qty"])


def last_sql(src: str, by: str, order: str, total: str = "total", w: str = "qty", d: int = 2) -> str:
    """Split with the residue on the last part."""
    return f"""(SELECT * EXCLUDE (s_, n_, l_, p_), CASE WHEN l_ THEN round(({total}-sum(p_) OVER (PARTITION BY {by}))::DECIMAL(28,10),{d})::DOUBLE ELSE p_ END cupo FROM (SELECT *, CASE WHEN l_ THEN 0 ELSE round((CASE WHEN s_>0 THEN {total}*{w}/s_ ELSE {total}/n_ END)::DECIMAL(28,10),{d})::DOUBLE END p_ FROM
 (SELECT *, sum({w}) OVER (PARTITION BY {by}) s_, count(*) OVER (PARTITION BY {by}) n_, row_number() OVER (PARTITION BY {by} ORDER BY {order} DESC)=1 l_ FROM {src})))"""


def large_sql(src: str, by: str, order: list[str], total: str = "total", w: str = "qty", d: int = 2, name: str = "cupo") -> str:
    """Split with the residue on the largest weight."""
    asc, desc = ", ".join(order), ", ".join(f"{o} DESC" for o in order)
    return f"""(SELECT * EXCLUDE (w_, s_, n_, t_, p_), CASE WHEN t_ THEN round((p_+({total}-sum(p_) OVER (PARTITION BY {by})))::DECIMAL(28,10),{d})::DOUBLE ELSE p_ END {name} FROM (SELECT *, round((CASE WHEN s_>0 THEN {total}*w_/s_ ELSE {total}/n_ END)::DECIMAL(28,10),{d})::DOUBLE p_ FROM
 (SELECT *, CASE WHEN sum(w_) OVER (PARTITION BY {by})>0 THEN row_number() OVER (PARTITION BY {by} ORDER BY w_ DESC, {asc})=1 ELSE row_number() OVER (PARTITION BY {by} ORDER BY {desc})=1 END t_, sum(w_) OVER (PARTITION BY {by}) s_, count(*) OVER (PARTITION BY {by}) n_ FROM (SELECT *, greatest(coalesce({w},0),0) w_ FROM {src}))))"""


@query("m1_split_residue_last", f="total qty cupo", sql=BASE + f" SELECT * FROM {last_sql('b', 'id_sucursal, generico', 'id_ruta')}")
def _(s):
    return qt.split_last(base(s), ["id_sucursal", "generico"], "total", "qty", ["id_ruta"])


@query("m2_split_residue_largest", f="total qty cupo", sql=BASE + f" SELECT * FROM {large_sql('b', 'id_sucursal, generico', ['id_ruta'])}")
def _(s):
    return qt.split_largest(base(s), ["id_sucursal", "generico"], "total", "qty", ["id_ruta"])


# coverage in May per route as weight of whole numbers
COVW = f"""cw AS (SELECT id_sucursal, id_ruta, clientes FROM {cov('id_sucursal, id_ruta', f'(SELECT * FROM l WHERE {MAY})')}), ib AS (SELECT r.id_sucursal, 'R'||r.id_ruta ruta, r.id_ruta, coalesce(clientes,0)::DOUBLE peso, 10.0::DOUBLE+r.id_sucursal*1.5::DOUBLE total FROM (SELECT DISTINCT id_sucursal, id_ruta FROM rutas) r LEFT JOIN cw ON cw.id_sucursal=r.id_sucursal AND cw.id_ruta=r.id_ruta)"""


def cov_base(s):
    w = cv.coverage(may(s), ["id_sucursal", "id_ruta"]).select("id_sucursal", "id_ruta", F.col("clientes").cast("double").alias("peso"))
    r = s.cliente.filter("id_ruta_fv1 is not null").select("id_sucursal", F.col("id_ruta_fv1").alias("id_ruta")).distinct()
    j = r.join(w, ["id_sucursal", "id_ruta"], "left").fillna(0, subset=["peso"])
    return j.withColumn("ruta", F.concat(F.lit("R"), "id_ruta")).withColumn("total", 10.0 + F.col("id_sucursal") * 1.5)


@query("m3_split_integers", f="peso total", i="cupo", sql=COVW + """, e AS (SELECT *, round(total)::BIGINT g, sum(peso) OVER w s, count(*) OVER w n FROM ib WINDOW w AS (PARTITION BY id_sucursal)), x AS (SELECT *, CASE WHEN s>0 THEN peso/s*g ELSE floor(g/n) END e FROM e),
f AS (SELECT *, floor(e)::BIGINT f, CASE WHEN s>0 THEN round(e-floor(e),9) ELSE 0 END fr FROM x), k AS (SELECT *, g-sum(f) OVER (PARTITION BY id_sucursal) m, row_number() OVER (PARTITION BY id_sucursal ORDER BY fr DESC, ruta) k FROM f)
SELECT id_sucursal, ruta, id_ruta, peso, total, f+CASE WHEN k<=m THEN 1 ELSE 0 END cupo FROM k""")
def _(s):
    return qt.split_integers(cov_base(s), ["id_sucursal"], "total", "peso", "ruta")


@query("m4_split_with_floor", f="peso total cupo", sql=COVW + f", fb AS (SELECT *, greatest(total-3.0::DOUBLE*count(*) OVER (PARTITION BY id_sucursal),0) xs FROM ib) SELECT * EXCLUDE (xs, y), round(y+3.0::DOUBLE,4) cupo FROM {large_sql('fb', 'id_sucursal', ['id_ruta'], 'xs', 'peso', 4, 'y')}")
def _(s):
    return qt.split_floor(cov_base(s), ["id_sucursal"], "total", "peso", ["id_ruta"], 3.0)


# route x brand of all branches; blocks are halves of the brands
BLK = f"""rt AS (SELECT DISTINCT id_sucursal zona, id_ruta ruta FROM rutas), lb AS (SELECT DISTINCT CASE WHEN length(marca)=7 THEN 'CORTO' ELSE 'LARGO' END bloque, marca etiqueta FROM art UNION ALL SELECT 'LARGO','MARCA NUEVA' UNION ALL SELECT 'NUEVO','X1' UNION ALL SELECT 'NUEVO','X2'),
hi AS (SELECT id_sucursal zona, id_ruta ruta, marca etiqueta, sum(cantidades_total) qty FROM l WHERE {MAY} GROUP BY 1,2,3), qb AS (SELECT zona, bloque, 1001.01::DOUBLE+zona*3.37::DOUBLE cupo_bloque FROM (SELECT DISTINCT zona FROM rt) CROSS JOIN (SELECT DISTINCT bloque FROM lb)),
g AS (SELECT rt.zona, rt.ruta, lb.bloque, lb.etiqueta, cupo_bloque, coalesce(qty,0) qty FROM rt CROSS JOIN lb JOIN qb ON qb.zona=rt.zona AND qb.bloque=lb.bloque LEFT JOIN hi ON hi.zona=rt.zona AND hi.ruta=rt.ruta AND hi.etiqueta=lb.etiqueta),
v AS (SELECT zona, bloque, etiqueta, sum(qty)>0 viva FROM g GROUP BY 1,2,3), mm AS (SELECT zona, bloque, count(*) n, count(*) FILTER (NOT viva) m FROM v GROUP BY 1,2),
p AS (SELECT g.*, viva, m, n, CASE WHEN m=n OR m=0 THEN 0 WHEN round(cupo_bloque*0.0015,2)*m>cupo_bloque*0.25 THEN round(cupo_bloque*0.25/m,2) ELSE round(cupo_bloque*0.0015,2) END piso, sum(CASE WHEN viva THEN qty ELSE 0 END) OVER (PARTITION BY zona, bloque, ruta) pr FROM g JOIN v USING (zona, bloque, etiqueta) JOIN mm USING (zona, bloque)),
pl AS (SELECT *, round(cupo_bloque-piso*m,2) resto, CASE WHEN m=n THEN 0 ELSE qty END pw FROM p), li AS (SELECT * FROM pl WHERE viva OR m=n), de AS (SELECT * FROM pl WHERE NOT viva AND m<>n)"""


def blocks(s):
    r = s.cliente.filter("id_ruta_fv1 is not null").select(F.col("id_sucursal").alias("zona"), F.col("id_ruta_fv1").alias("ruta")).distinct()
    lab = s.articulo.select(F.when(F.length("marca") == 7, "CORTO").otherwise("LARGO").alias("bloque"), F.col("marca").alias("etiqueta")).distinct()
    lab = lab.unionByName(s.spark.createDataFrame([("LARGO", "MARCA NUEVA"), ("NUEVO", "X1"), ("NUEVO", "X2")], "bloque string, etiqueta string"))
    h = may(s).groupBy(F.col("id_sucursal").alias("zona"), F.col("id_ruta").alias("ruta"), F.col("marca").alias("etiqueta")).agg(F.sum("cantidades_total").alias("qty"))
    q = r.select("zona").distinct().withColumn("bloque", F.explode(F.array(F.lit("CORTO"), F.lit("LARGO"), F.lit("NUEVO")))).withColumn("cupo_bloque", 1001.01 + F.col("zona") * 3.37)
    return qt.split_block(r, lab, h, q)


@query("m5_split_block", f="cupo", sql=BLK + f" SELECT zona, bloque, ruta, etiqueta, cupo FROM {large_sql('li', 'zona, bloque', ['ruta', 'etiqueta'], 'resto', 'pw')} UNION ALL SELECT zona, bloque, ruta, etiqueta, cupo FROM {large_sql('de', 'zona, bloque, etiqueta', ['ruta'], 'piso', 'pr')}")
def _(s):
    return blocks(s)


# a rep serves three routes here (client id modulo 30), and one rep per branch has none
REP = f"""rr AS (SELECT DISTINCT id_personal_fv1 id_vendedor, id_sucursal, id_cliente%30 id_ruta FROM cli WHERE NOT anulado), hr AS (SELECT id_sucursal, id_cliente%30 id_ruta, generico categoria, sum(cantidades_total) qty FROM l WHERE {MAY} GROUP BY 1,2,3),
rq AS (SELECT id_ruta id_vendedor, id_sucursal, generico categoria, sum(coalesce(cupo,0)) cupo_vendedor FROM cupos WHERE periodo='2001-06' GROUP BY 1,2,3 UNION ALL SELECT 99, id_sucursal, 'PROMO', 50.0 FROM suc),
j AS (SELECT rq.*, rr.id_ruta, coalesce(qty,0) qty FROM rq LEFT JOIN rr ON rr.id_vendedor=rq.id_vendedor AND rr.id_sucursal=rq.id_sucursal LEFT JOIN hr ON hr.id_sucursal=rq.id_sucursal AND hr.id_ruta=rr.id_ruta AND hr.categoria=rq.categoria),
rs AS (SELECT * FROM {last_sql('j', 'id_vendedor, id_sucursal, categoria', 'id_ruta', 'cupo_vendedor')}),
rd AS (SELECT * EXCLUDE (qty), CASE WHEN id_ruta IS NULL THEN 'SIN RUTA' ELSE 'RUTA '||id_ruta END ruta, CASE WHEN id_ruta IS NULL THEN 'sin ruta' WHEN cupo_vendedor>0 AND sum(qty) OVER (PARTITION BY id_vendedor, id_sucursal, categoria)<=0 THEN 'sin historia' ELSE '' END diagnostico FROM rs)"""


def rep_quotas(s):
    q = s.cupos.filter("periodo = '2001-06'").groupBy(F.col("id_ruta").alias("id_vendedor"), "id_sucursal", F.col("generico").alias("categoria")).agg(
        F.sum(F.coalesce("cupo", F.lit(0.0))).alias("cupo_vendedor"))
    return q.unionByName(s.sucursal.select(F.lit(99).cast("long").alias("id_vendedor"), "id_sucursal", F.lit("PROMO").alias("categoria"), F.lit(50.0).alias("cupo_vendedor")))


def rep_split(s):
    r = qt.rep_routes(s.cliente.withColumn("id_ruta_fv1", F.col("id_cliente") % 30))
    h = may(s).groupBy("id_sucursal", (F.col("id_cliente") % 30).alias("id_ruta"), F.col("generico").alias("categoria")).agg(F.sum("cantidades_total").alias("qty"))
    return qt.rep_quotas_to_routes(rep_quotas(s), r, h)


@query("m6_rep_quotas_to_routes", f="cupo_vendedor cupo", sql=REP + " SELECT * FROM rd")
def _(s):
    return rep_split(s)


CQ = f"""cr AS (SELECT id_sucursal, id_ruta, generico, clientes::DOUBLE peso FROM {cov('id_sucursal, id_ruta, generico', f'(SELECT * FROM l WHERE {MAY})')}), cz AS (SELECT id_sucursal, marca generico, sum(cupo) total FROM cupos_cob WHERE tipo_apertura='GENERICO' GROUP BY 1,2),
cb AS (SELECT z.id_sucursal, z.generico, r.id_ruta, total, coalesce(peso,0) peso FROM cz z JOIN (SELECT DISTINCT id_sucursal, id_ruta FROM rutas) r USING (id_sucursal) LEFT JOIN cr ON cr.id_sucursal=z.id_sucursal AND cr.id_ruta=r.id_ruta AND cr.generico=z.generico)"""


def coverage_quota(s):
    w = cv.coverage(may(s), ["id_sucursal", "id_ruta", "generico"]).select("id_sucursal", "id_ruta", "generico", F.col("clientes").cast("double").alias("peso"))
    z = fl.repair_swapped(s.cupos_cobertura.filter("tipo_apertura = 'GENERICO'")).groupBy("id_sucursal", F.col("concepto").alias("generico")).agg(F.sum("cupo").alias("total"))
    r = s.cliente.filter("id_ruta_fv1 is not null").select("id_sucursal", F.col("id_ruta_fv1").alias("id_ruta")).distinct()
    return z.join(r, "id_sucursal").join(w, ["id_sucursal", "id_ruta", "generico"], "left").fillna(0, subset=["peso"])


@query("m7_coverage_quotas", f="total peso cupo", sql=CQ + f", fx AS (SELECT *, greatest(total-count(*) OVER (PARTITION BY id_sucursal, generico),0) xs FROM cb WHERE generico IN ('PROMO','SMALL')), nf AS (SELECT * FROM cb WHERE generico NOT IN ('PROMO','SMALL')) SELECT * EXCLUDE (xs, y), round(y+1.0::DOUBLE,4) cupo FROM {large_sql('fx', 'id_sucursal, generico', ['id_ruta'], 'xs', 'peso', 4, 'y')} UNION ALL BY NAME SELECT * FROM {large_sql('nf', 'id_sucursal, generico', ['id_ruta'], 'total', 'peso', 4)}")
def _(s):
    b = coverage_quota(s)
    by = ["id_sucursal", "generico"]
    with_floor = qt.split_floor(b.filter("generico in ('PROMO','SMALL')"), by, "total", "peso", ["id_ruta"], 1.0)
    return with_floor.unionByName(qt.split_largest(b.filter("generico not in ('PROMO','SMALL')"), by, "total", "peso", ["id_ruta"], digits=4))


@query("m8_category_floor", f="cupo", sql="""mg AS (SELECT marca, min(generico) generico FROM art GROUP BY 1), br AS (SELECT id_sucursal zona, id_ruta ruta, mg.generico, max(cupo) m FROM cupos_cob c JOIN mg ON mg.marca=c.generico WHERE tipo_apertura='MARCA' GROUP BY 1,2,3),
ca AS (SELECT id_sucursal zona, id_ruta ruta, marca generico, cupo FROM cupos_cob WHERE tipo_apertura='GENERICO') SELECT zona, ruta, generico, CASE WHEN m>cupo+1e-9 THEN round(m,4) ELSE cupo END cupo FROM ca LEFT JOIN br USING (zona, ruta, generico)""")
def _(s):
    c = s.cupos_cobertura
    cat = c.filter("tipo_apertura = 'GENERICO'").select(F.col("id_sucursal").alias("zona"), F.col("id_ruta").alias("ruta"), F.col("marca").alias("generico"), "cupo")
    of = s.articulo.groupBy("marca").agg(F.min("generico").alias("_g"))
    br = c.filter("tipo_apertura = 'MARCA'").drop("marca").withColumnRenamed("generico", "marca").join(of, "marca").select(
        F.col("id_sucursal").alias("zona"), F.col("id_ruta").alias("ruta"), F.col("_g").alias("generico"), "cupo")
    return qt.category_floor(cat, br)


@query("m9_route_zone", i="clientes_zona", sql="""z AS (SELECT id_sucursal, id_ruta_fv4 ruta, CASE WHEN id_ruta_fv1 IN (2,3,4,5) THEN 'VALLE' WHEN id_ruta_fv1=9 THEN 'SUBDIST' ELSE 'CENTRO' END zona, count(*) c FROM cli WHERE NOT anulado AND id_ruta_fv4 IS NOT NULL GROUP BY 1,2,3),
r AS (SELECT *, row_number() OVER (PARTITION BY id_sucursal, ruta ORDER BY c DESC, list_position(['CENTRO','VALLE','SUBDIST'],zona)) k FROM z) SELECT id_sucursal, ruta, zona, c clientes_zona FROM r WHERE k=1""")
def _(s):
    r1 = F.col("id_ruta_fv1")
    zone = F.when(r1.isin(2, 3, 4, 5), "VALLE").when(r1 == 9, "SUBDIST").otherwise("CENTRO")
    return qt.route_zone_by_majority(s.cliente.filter("not anulado"), "id_ruta_fv4", zone, ["CENTRO", "VALLE", "SUBDIST"])


# zone quota over route x brand pairs in one pass, then one rep's one-off sale of Brand#2 is spread over all reps
ZR = f"""zr AS (SELECT DISTINCT id_sucursal zona, id_ruta ruta, 'P'||(id_ruta%4) preventista FROM rutas), zh AS (SELECT id_sucursal zona, id_ruta ruta, marca categoria, sum(cantidades_total) qty FROM l WHERE {MAY} AND marca IN ('Brand#1','Brand#2','Brand#3') GROUP BY 1,2,3), zq AS (SELECT id_sucursal zona, 500.0::DOUBLE+id_sucursal*7.3::DOUBLE cupo_zona FROM suc),
zp AS (SELECT zr.*, m.categoria, coalesce(qty,0) qty, cupo_zona FROM zr CROSS JOIN (VALUES ('Brand#1'),('Brand#2'),('Brand#3')) m(categoria) JOIN zq USING (zona) LEFT JOIN zh ON zh.zona=zr.zona AND zh.ruta=zr.ruta AND zh.categoria=m.categoria),
zv AS (SELECT * FROM {large_sql('zp', 'zona', ['ruta', 'categoria'], 'cupo_zona')})"""


def zone_values(s):
    r = s.cliente.filter("id_ruta_fv1 is not null").select(F.col("id_sucursal").alias("zona"), F.col("id_ruta_fv1").alias("ruta")).distinct()
    r = r.withColumn("preventista", F.concat(F.lit("P"), F.col("ruta") % 4)).withColumn("categoria", F.explode(F.array(*[F.lit(f"Brand#{k}") for k in (1, 2, 3)])))
    h = may(s).filter("marca in ('Brand#1','Brand#2','Brand#3')").groupBy(F.col("id_sucursal").alias("zona"), F.col("id_ruta").alias("ruta"), F.col("marca").alias("categoria")).agg(F.sum("cantidades_total").alias("qty"))
    q = s.sucursal.select(F.col("id_sucursal").alias("zona"), (500.0 + F.col("id_sucursal") * 7.3).alias("cupo_zona"))
    p = r.join(h, ["zona", "ruta", "categoria"], "left").fillna(0, subset=["qty"]).join(q, "zona")
    return qt.split_largest(p, ["zona"], "cupo_zona", "qty", ["ruta", "categoria"]), q, h.withColumnRenamed("categoria", "marca")


@query("m10_zone_split", f="qty cupo_zona cupo", sql=ZR + " SELECT * FROM zv")
def _(s):
    return zone_values(s)[0]


@query("m10_redistribution", f="qty cupo_zona cupo", sql=ZR + f""", mi AS (SELECT zr.zona, zr.ruta, coalesce(qty,0) q FROM zr LEFT JOIN zh ON zh.zona=zr.zona AND zh.ruta=zr.ruta AND zh.categoria='Brand#2' WHERE preventista='P2'),
am AS (SELECT a.zona, round(cupo_zona*b/z,2) monto FROM (SELECT zona, sum(q) b FROM mi GROUP BY 1) a JOIN (SELECT zona, sum(qty) z FROM zv GROUP BY 1) t USING (zona) JOIN zq USING (zona) WHERE b>0 AND z>0), mo AS (SELECT mi.*, monto FROM mi JOIN am USING (zona)),
re AS (SELECT DISTINCT zr.zona, preventista, monto, 1.0::DOUBLE uno FROM zr JOIN am USING (zona)), rs AS (SELECT zona, preventista, c FROM {large_sql('re', 'zona', ['preventista'], 'monto', 'uno', 2, 'c')}), ri AS (SELECT zr.zona, zr.ruta, zr.preventista, c, 1.0::DOUBLE uno FROM zr JOIN rs USING (zona, preventista)),
mv AS (SELECT zona, ruta, sum(d) d FROM (SELECT zona, ruta, -d d FROM {large_sql('mo', 'zona', ['ruta'], 'monto', 'q', 2, 'd')} UNION ALL SELECT zona, ruta, d FROM {large_sql('ri', 'zona, preventista', ['ruta'], 'c', 'uno', 2, 'd')}) GROUP BY 1,2)
SELECT zv.* REPLACE (round(cupo+CASE WHEN categoria='Brand#1' THEN coalesce(d,0) ELSE 0 END,2) AS cupo) FROM zv LEFT JOIN mv ON mv.zona=zv.zona AND mv.ruta=zv.ruta""")
def _(s):
    v, q, h = zone_values(s)
    return qt.redistribute(v, h, q, "P2", "Brand#2", "Brand#1")


@query("m11_closure", f="esperado suma diferencia", sql=REP + """, s AS (SELECT id_vendedor, id_sucursal, categoria, sum(cupo) suma FROM rd WHERE id_ruta IS NULL OR id_ruta<>7 GROUP BY 1,2,3)
SELECT rq.id_vendedor, rq.id_sucursal, rq.categoria, cupo_vendedor esperado, suma, abs(coalesce(suma,0)-cupo_vendedor) diferencia FROM rq LEFT JOIN s USING (id_vendedor, id_sucursal, categoria) WHERE abs(coalesce(suma,0)-cupo_vendedor)>0.02""")
def _(s):
    rows = rep_split(s).filter("id_ruta is null or id_ruta <> 7")      # one route is left out, so that it does not close
    return qt.closure(rows, rep_quotas(s), ["id_vendedor", "id_sucursal", "categoria"], "cupo", "cupo_vendedor")


# each branch gets a rep who left, and one branch has only such reps
LEA = f"""l0 AS (SELECT id_sucursal, preventista, generico categoria, sum(coalesce(cupo,0)) cupo FROM cupos WHERE periodo='2001-06' GROUP BY 1,2,3), le AS (SELECT * FROM l0 UNION ALL SELECT id_sucursal, 'BAJA '||id_sucursal, categoria, 0.1*sum(cupo) FROM l0 GROUP BY 1,3 UNION ALL SELECT 999, preventista, categoria, cupo FROM l0 WHERE id_sucursal=5),
al AS (SELECT DISTINCT id_sucursal, des_personal_fv1 preventista FROM cli WHERE NOT anulado AND id_ruta_fv1 IS NOT NULL),
we AS (SELECT id_sucursal, des_personal_fv1 preventista, generico categoria, sum(cantidades_total) qty FROM l WHERE {MAY} GROUP BY 1,2,3), lt AS (SELECT id_sucursal, categoria, round(sum(cupo),2) t FROM le GROUP BY 1,2),
lj AS (SELECT al.id_sucursal, al.preventista, lt.categoria, t, coalesce(qty,0) qty FROM al JOIN lt USING (id_sucursal) LEFT JOIN we ON we.id_sucursal=al.id_sucursal AND we.preventista=al.preventista AND we.categoria=lt.categoria)"""


@query("m12_redistribute_leavers", f="cupo", sql=LEA + f" SELECT id_sucursal, preventista, categoria, cupo FROM {large_sql('lj', 'id_sucursal, categoria', ['preventista'], 't')} UNION ALL SELECT id_sucursal, preventista, categoria, cupo FROM le WHERE id_sucursal NOT IN (SELECT id_sucursal FROM al)")
def _(s):
    q = s.cupos.filter("periodo = '2001-06'").groupBy("id_sucursal", "preventista", F.col("generico").alias("categoria")).agg(F.sum(F.coalesce("cupo", F.lit(0.0))).alias("cupo"))
    left = q.groupBy("id_sucursal", F.concat(F.lit("BAJA "), "id_sucursal").alias("preventista"), "categoria").agg((F.sum("cupo") * 0.1).alias("cupo"))
    q = q.unionByName(left).unionByName(q.filter("id_sucursal = 5").withColumn("id_sucursal", F.lit(999).cast("long")))
    alive = s.cliente.filter("not anulado and id_ruta_fv1 is not null").select("id_sucursal", F.col("des_personal_fv1").alias("preventista")).distinct()
    w = may(s).groupBy("id_sucursal", F.col("des_personal_fv1").alias("preventista"), F.col("generico").alias("categoria")).agg(F.sum("cantidades_total").alias("qty"))
    return qt.redistribute_leavers(q, alive, w)


MAP = {"cerveza": ("CERVEZAS", "INDIVIDUAL"), "agua": ("AGUAS", "AGUAS"), "vino": ("VINOS", "FINOS")}


def sheet(s):
    """Wide quota sheet with subtotal rows and, on some routes, cells without a value."""
    q = s.cupos.filter("periodo = '2001-06'")
    w = q.groupBy("id_sucursal", "sucursal", F.col("id_ruta").cast("string").alias("codigo"), "preventista").agg(
        F.sum(F.when(F.col("generico") == "PROMO", F.col("cupo"))).alias("cerveza"), F.sum(F.when(F.col("generico") == "SMALL", F.col("cupo"))).alias("agua"),
        F.sum(F.when(F.col("generico") == "LARGE", F.col("cupo"))).alias("vino"))
    sub = w.groupBy("id_sucursal", "sucursal").agg(*[F.sum(c).alias(c) for c in ("cerveza", "agua", "vino")]).withColumn("codigo", F.lit("TOTAL")).withColumn("preventista", F.lit(None).cast("string"))
    return w.unionByName(sub)


LNG = "SELECT id_sucursal, sucursal, preventista, id_ruta, CASE generico WHEN 'PROMO' THEN 'CERVEZAS' WHEN 'SMALL' THEN 'AGUAS' ELSE 'VINOS' END generico, CASE generico WHEN 'PROMO' THEN 'INDIVIDUAL' WHEN 'SMALL' THEN 'AGUAS' ELSE 'FINOS' END desagregado, cupo FROM cupos WHERE periodo='2001-06' AND generico IN ('PROMO','SMALL','LARGE')"


@query("m13_wide_to_long", f="cupo", sql=LNG + " AND cupo IS NOT NULL")
def _(s):
    long = qt.wide_to_long(sheet(s), ["id_sucursal", "sucursal", "preventista"], MAP).filter("cupo is not null")
    return qt.require_values(long)


@query("m13_uncomputed_cells", sql=f"x AS ({LNG} AND cupo IS NULL) SELECT generico, desagregado, count(*) celdas, min(id_ruta) primera_ruta FROM x GROUP BY 1,2")
def _(s):
    return qt.uncomputed(qt.wide_to_long(sheet(s), ["id_sucursal", "sucursal", "preventista"], MAP))


@query("m14_fixed_rows", f="cupo", i="id_ruta", sql="SELECT DISTINCT 93 id_ruta, 'SUB DISTRIBUIDOR' preventista, coalesce(marca,generico) etiqueta, 'SUB DISTRIBUIDORES' zona, 6.0 cupo FROM cupos_cob WHERE id_sucursal=1")
def _(s):
    lab = fl.repair_swapped(s.cupos_cobertura.filter("id_sucursal = 1")).select(F.col("concepto").alias("etiqueta"))
    return qt.fixed_rows(lab, 93, "SUB DISTRIBUIDOR", "SUB DISTRIBUIDORES", 6.0)
