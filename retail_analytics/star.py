"""Star schema of the library and the adapter that derives it from the TPC-H-like test tables.

Operators only see the star tables (ids are unique inside a branch, measures are doubles); in production the
same names are tables partitioned by month.  ``STAR_CTE`` states the same mapping once more in SQL, as the
prefix of every DuckDB oracle.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from retail_analytics.functions.grid import complete_grid, cross_grid
from retail_analytics.functions.joins import WHOLE_FILE, join_catalogue
from retail_analytics.functions.skew import fits_broadcast, join_heavy


class Star:
    """Lazy star-schema tables read from ``sf_dir``; nothing is executed here."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- dimensions -------------------------------------------------------------------------------
    @cached_property
    def sucursal(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").cast("long").alias("id_sucursal"),
            F.col("n_name").alias("descripcion"), F.col("r_name").alias("zona"))

    @cached_property
    def articulo(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id_articulo"), F.col("p_name").alias("des_articulo"),
            F.col("p_brand").alias("marca"), F.col("p_type").alias("generico"),
            F.col("p_size").cast("string").alias("calibre"),
            F.concat(F.lit("PROV "), F.col("p_partkey") % 3).alias("proveedor"),
            F.when(F.col("p_partkey") % 29 != 0, F.col("p_size") / 1000.0).alias("factor_hectolitros"))

    @cached_property
    def cliente(self) -> DataFrame:
        c, n, k = self.raw("customer"), self.raw("nation"), F.col("c_custkey")

        def rep(mod: int):
            return F.concat(F.lit("Supplier#"), F.lpad((k % mod).cast("string"), 9, "0"), F.lit("/"), F.col("n_name"))

        return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
            k.alias("id_cliente"), F.col("c_nationkey").cast("long").alias("id_sucursal"),
            F.col("n_name").alias("des_sucursal"),
            F.when(k % 11 == 0, "  ").when(k % 13 == 0, "---").otherwise(F.col("c_name")).alias("fantasia"),
            F.when(k % 17 != 0, F.upper("c_name")).alias("razon_social"),
            F.when(k % 37 != 0, k % 10).alias("id_ruta_fv1"), (k % 7).alias("id_ruta_fv4"),
            (k % 5).alias("id_lista_precio"),
            (k % 10).alias("id_personal_fv1"), rep(10).alias("des_personal_fv1"),
            (k % 7).alias("id_personal_fv4"), rep(7).alias("des_personal_fv4"),
            F.col("c_mktsegment").alias("des_canal_mkt"),
            F.concat("c_mktsegment", F.lit("-"), k % 3).alias("des_subcanal_mkt"),
            F.concat(F.lit("LOC "), k % 20).alias("localidad"),
            (F.col("c_acctbal") < 0).alias("anulado"))

    @cached_property
    def vendedor(self) -> DataFrame:
        s = self.raw("supplier").select("s_suppkey", "s_name")
        n = self.raw("nation").select(F.col("n_nationkey").cast("long").alias("id_sucursal"),
                                      F.col("n_name").alias("des_sucursal"))
        return complete_grid(s, n).select(
            F.col("s_suppkey").alias("id_vendedor"), "id_sucursal", "des_sucursal",
            F.concat("s_name", F.lit("/"), "des_sucursal").alias("des_vendedor"),
            F.when((F.col("s_suppkey") + F.col("id_sucursal")) % 5 == 0, 4).otherwise(1).cast("long")
             .alias("id_fuerza_ventas"))

    @cached_property
    def deposito(self) -> DataFrame:
        """One depot per branch, a second one (id + 100) for every fifth branch."""
        extra = F.when(F.col("id_sucursal") % 5 == 0, F.array(F.lit(0), F.lit(100))).otherwise(F.array(F.lit(0)))
        return (self.sucursal.withColumn("_d", F.explode(extra))
                .select((F.col("id_sucursal") + F.col("_d")).cast("long").alias("id_deposito"), "id_sucursal",
                        F.col("descripcion").alias("des_sucursal")))

    # -- facts ------------------------------------------------------------------------------------
    @cached_property
    def ventas(self) -> DataFrame:
        """Document lines; the accounting columns come with it and are pruned when unused."""
        lines, orders = self.raw("lineitem"), self.raw("orders")
        two = self.raw("customer").select("c_custkey", "c_nationkey").schema       # the client dimension is not part of the lines
        cust = self.spark.read.schema(two).parquet(f"{self.sf_dir}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")
        placed = join_catalogue(orders, cust, "o_custkey", unpacked=WHOLE_FILE)
        j = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        k, ret = F.col("l_orderkey"), F.col("l_returnflag") == "R"
        fecha = F.to_date("o_orderdate")
        j = j.withColumn("_s", F.when(ret, -1.0).otherwise(1.0))
        qty, gross = F.col("_s") * F.col("l_quantity"), F.col("_s") * F.col("l_extendedprice")
        free = (F.col("l_linenumber") == 1) & (k % 13 == 0)
        return j.select(
            (k * 10 + F.col("l_linenumber")).alias("id"), fecha.alias("fecha_comprobante"),
            fecha.alias("fecha_pedido"), F.date_add(fecha, (k % 7 - 1).cast("int")).alias("fecha_entrega"),
            F.col("c_nationkey").cast("long").alias("id_sucursal"), F.col("l_suppkey").alias("id_vendedor"),
            F.col("o_custkey").alias("id_cliente"), F.col("l_partkey").alias("id_articulo"),
            F.when(ret, "DVVTA").when(k % 97 == 0, "PRVTA").otherwise("FCVTA").alias("id_documento"),
            F.lit("A").alias("letra"), (k % 9 + 1).alias("serie"), k.alias("nro_doc"),
            (k % 101 == 0).alias("anulado"),
            F.when(free, 0.0).otherwise(qty).alias("cantidades_con_cargo"),
            F.when(free, qty).otherwise(0.0).alias("cantidades_sin_cargo"),
            qty.alias("cantidades_total"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("precio_unitario_bruto"),
            (F.col("l_discount") * 100).alias("bonificacion"), (gross * F.col("l_discount")).alias("descuentos"),
            gross.alias("facturacion_neta"), (gross - gross * F.col("l_discount")).alias("subtotal_neto"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")).alias("precio_unitario_neto"),
            (k % 12).alias("id_fletero_carga"),
            F.when(ret, F.col("l_quantity")).otherwise(0.0).alias("cantidades_rechazo"))

    @cached_property
    def ventas_costo(self) -> DataFrame:
        """Accounting lines: sales plus the purchase price of the SKU."""
        p = self.raw("part").select(F.col("p_partkey").alias("id_articulo"),
                                    F.col("p_retailprice").alias("precio_compra_neto"))
        return self.ventas.join(p, "id_articulo")

    @cached_property
    def stock(self) -> DataFrame:
        """Two snapshots of SKU x depot; quantities by closed arithmetic so that zero and negatives occur."""
        day = F.explode(F.array(F.lit("2001-06-15").cast("date"), F.lit("2001-06-30").cast("date")))
        cells = self.deposito.select("id_deposito").withColumn("date_stock", day)
        qty = ((F.col("p_partkey") * 7 + F.col("id_deposito") * 13 + F.dayofmonth("date_stock")) % 50 - 2).cast("double")
        return cross_grid(self.raw("part").select("p_partkey", "p_size"), cells).select(
            "date_stock", "id_deposito", F.col("p_partkey").alias("id_articulo"), qty.alias("cant_bultos"),
            F.when(F.col("p_partkey") % 29 != 0, qty * F.col("p_size") / 1000.0).alias("cantidad_total_htls"))

    @cached_property
    def precios(self) -> DataFrame:
        """Price list; every 23rd SKU has no price."""
        return self.raw("part").filter(F.col("p_partkey") % 23 != 0).select(
            F.col("p_partkey").alias("id_articulo"), F.col("p_retailprice").alias("precio_base"),
            (F.col("p_retailprice") * 1.21).alias("precio_final"))

    @cached_property
    def _rutas(self) -> DataFrame:
        return (self.cliente.filter("id_ruta_fv1 is not null")
                .groupBy("id_sucursal", "des_sucursal", F.col("id_ruta_fv1").alias("id_ruta"))
                .agg(F.min("des_personal_fv1").alias("preventista")))

    @cached_property
    def cupos(self) -> DataFrame:
        """Quota per route x category for the months 2001-05 and 2001-06."""
        g = complete_grid(self._rutas, self.articulo.select("generico").distinct())
        code = F.ascii("generico")
        return g.withColumn("periodo", F.explode(F.array(F.lit("2001-05"), F.lit("2001-06")))).select(
            "periodo", F.concat(F.lit("PROV "), F.col("id_ruta") % 3).alias("proveedor"), "id_sucursal",
            F.concat("id_sucursal", F.lit(" - "), "des_sucursal").alias("sucursal"), "id_ruta", "preventista",
            "generico", F.concat("generico", F.lit("/"), F.col("id_ruta") % 2).alias("desagregado"),
            F.when((F.col("id_ruta") + F.col("id_sucursal")) % 11 != 0,
                   ((F.col("id_sucursal") * 31 + F.col("id_ruta") * 17 + code) % 90).cast("double")).alias("cupo"))

    @cached_property
    def cupos_cobertura(self) -> DataFrame:
        """Coverage quota with the swap the load has: the category sits in ``marca`` and the brand in ``generico``."""
        code = (F.col("id_sucursal") * 7 + F.col("id_ruta") * 5)
        gen = complete_grid(self._rutas, self.articulo.select("generico").distinct()).select(
            F.lit("GENERICO").alias("tipo_apertura"), "id_sucursal", "id_ruta", "preventista",
            F.col("generico").alias("marca"), F.lit(None).cast("string").alias("generico"),
            ((code + F.ascii("generico")) % 9).cast("double").alias("cupo"))
        mar = complete_grid(self._rutas, self.articulo.select("marca").distinct()).select(
            F.lit("MARCA").alias("tipo_apertura"), "id_sucursal", "id_ruta", "preventista",
            F.lit(None).cast("string").alias("marca"), F.col("marca").alias("generico"),
            ((code + F.length("marca")) % 7).cast("double").alias("cupo"))
        return gen.unionByName(mar).withColumn("periodo", F.lit("2001-06"))

    @cached_property
    def feriados(self) -> DataFrame:
        """Holidays of the test calendar: a weekday, a Saturday and a Sunday of June 2001, and two more."""
        days = ["2001-06-20", "2001-06-16", "2001-06-17", "2001-05-25", "2001-01-01"]
        return self.spark.sql("SELECT explode(array(" + ",".join(f"DATE'{d}'" for d in days) + ")) AS fecha")

    # -- joined helper ----------------------------------------------------------------------------
    @cached_property
    def lineas(self) -> DataFrame:
        """Sales lines left-joined to article, branch and client (composite key); unused columns are pruned."""
        return enrich(self.ventas, self.articulo, self.sucursal, self.cliente)

    @cached_property
    def lineas_cliente(self) -> DataFrame:
        """``lineas`` for reports that use client columns: where the client table is too large to be broadcast, counter-sale
        clients, which hold a large share of the lines, don't go to one task."""
        if fits_broadcast(self.raw("customer")):
            return self.lineas
        return enrich(self.ventas, self.articulo, self.sucursal, self.cliente, heavy=True)


def enrich(ventas: DataFrame, articulo: DataFrame, sucursal: DataFrame, cliente: DataFrame, heavy: bool = False) -> DataFrame:
    """Left joins of the sales lines to the three dimensions; client on the composite (id, branch) key.

    ``dropDuplicates`` on the client key states that it is unique: a client row cannot multiply a sale, and the
    optimiser removes the whole join (and its shuffle of the facts) where no client column is used.  Where it is
    used, the aggregate has the partitioning and order the sort-merge join needs anyway.  With ``heavy`` the lines of
    clients that hold a large share of them are not shuffled for it.
    """
    cliente = cliente.dropDuplicates(["id_cliente", "id_sucursal"])
    cli = cliente.drop("des_sucursal").withColumnsRenamed({"id_ruta_fv1": "id_ruta", "anulado": "cliente_anulado"})
    out = (ventas.join(articulo, "id_articulo", "left")
           .join(sucursal.withColumnRenamed("descripcion", "sucursal"), "id_sucursal", "left"))
    key = ["id_cliente", "id_sucursal"]
    out = join_heavy(out, cli, key) if heavy else out.join(cli, key, "left")
    return out.withColumn("cantidad_total_htls", F.col("cantidades_total") * F.col("factor_hectolitros"))


# Same mapping in SQL (DuckDB).  suc/art/cli/ven/dep/fv/stock/precios/cupos/cupos_cob are the star tables,
# ``l`` is fv joined to article, branch and client.
STAR_CTE = """
suc AS (SELECT n_nationkey::BIGINT id_sucursal, n_name descripcion, r_name zona FROM nation JOIN region ON n_regionkey=r_regionkey),
art AS (SELECT p_partkey id_articulo, p_name des_articulo, p_brand marca, p_type generico, p_size::VARCHAR calibre,
  'PROV '||(p_partkey%3) proveedor, CASE WHEN p_partkey%29<>0 THEN p_size/1000.0::DOUBLE END factor_hectolitros,
  p_retailprice FROM part),
cli AS (SELECT c_custkey id_cliente, c_nationkey::BIGINT id_sucursal, n_name des_sucursal,
  CASE WHEN c_custkey%11=0 THEN '  ' WHEN c_custkey%13=0 THEN '---' ELSE c_name END fantasia,
  CASE WHEN c_custkey%17<>0 THEN upper(c_name) END razon_social,
  CASE WHEN c_custkey%37<>0 THEN c_custkey%10 END id_ruta_fv1, c_custkey%7 id_ruta_fv4, c_custkey%5 id_lista_precio,
  c_custkey%10 id_personal_fv1, 'Supplier#'||lpad((c_custkey%10)::VARCHAR,9,'0')||'/'||n_name des_personal_fv1,
  c_custkey%7 id_personal_fv4, 'Supplier#'||lpad((c_custkey%7)::VARCHAR,9,'0')||'/'||n_name des_personal_fv4,
  c_mktsegment des_canal_mkt, c_mktsegment||'-'||(c_custkey%3) des_subcanal_mkt, 'LOC '||(c_custkey%20) localidad,
  c_acctbal<0 anulado FROM customer LEFT JOIN nation ON c_nationkey=n_nationkey),
ven AS (SELECT s_suppkey id_vendedor, n_nationkey::BIGINT id_sucursal, n_name des_sucursal, s_name||'/'||n_name des_vendedor,
  (CASE WHEN (s_suppkey+n_nationkey)%5=0 THEN 4 ELSE 1 END)::BIGINT id_fuerza_ventas FROM supplier CROSS JOIN nation),
dep AS (SELECT id_sucursal id_deposito, id_sucursal, descripcion des_sucursal FROM suc
  UNION ALL SELECT id_sucursal+100, id_sucursal, descripcion FROM suc WHERE id_sucursal%5=0),
fv AS (SELECT l_orderkey*10+l_linenumber id, o_orderdate::DATE fecha_comprobante, o_orderdate::DATE fecha_pedido,
  o_orderdate::DATE + (l_orderkey%7-1)::INT fecha_entrega, c_nationkey::BIGINT id_sucursal, l_suppkey id_vendedor,
  o_custkey id_cliente, l_partkey id_articulo,
  CASE WHEN l_returnflag='R' THEN 'DVVTA' WHEN l_orderkey%97=0 THEN 'PRVTA' ELSE 'FCVTA' END id_documento,
  'A' letra, l_orderkey%9+1 serie, l_orderkey nro_doc, l_orderkey%101=0 anulado,
  CASE WHEN l_linenumber=1 AND l_orderkey%13=0 THEN 0.0::DOUBLE ELSE sgn*l_quantity END cantidades_con_cargo,
  CASE WHEN l_linenumber=1 AND l_orderkey%13=0 THEN sgn*l_quantity ELSE 0.0::DOUBLE END cantidades_sin_cargo,
  sgn*l_quantity cantidades_total, l_extendedprice/l_quantity precio_unitario_bruto, l_discount*100 bonificacion,
  sgn*l_extendedprice*l_discount descuentos, sgn*l_extendedprice facturacion_neta,
  sgn*l_extendedprice-sgn*l_extendedprice*l_discount subtotal_neto,
  l_extendedprice*(1-l_discount)/l_quantity precio_unitario_neto, l_orderkey%12 id_fletero_carga,
  CASE WHEN l_returnflag='R' THEN l_quantity ELSE 0.0::DOUBLE END cantidades_rechazo
  FROM (SELECT *, CASE WHEN l_returnflag='R' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END sgn FROM lineitem) x
  JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey),
l AS (SELECT fv.*, a.des_articulo, a.marca, a.generico, a.calibre, a.proveedor, a.factor_hectolitros,
  a.p_retailprice precio_compra_neto, s.descripcion sucursal, s.zona, c.fantasia, c.razon_social, c.id_ruta_fv1 id_ruta,
  c.id_ruta_fv4, c.id_lista_precio, c.id_personal_fv1, c.des_personal_fv1, c.id_personal_fv4, c.des_personal_fv4,
  c.des_canal_mkt, c.des_subcanal_mkt, c.localidad, c.anulado cliente_anulado,
  fv.cantidades_total*a.factor_hectolitros cantidad_total_htls
  FROM fv LEFT JOIN art a ON fv.id_articulo=a.id_articulo LEFT JOIN suc s ON fv.id_sucursal=s.id_sucursal
  LEFT JOIN cli c ON fv.id_cliente=c.id_cliente AND fv.id_sucursal=c.id_sucursal),
stock AS (SELECT d::DATE date_stock, id_deposito, p_partkey id_articulo,
  ((p_partkey*7+id_deposito*13+day(d::DATE))%50-2)::DOUBLE cant_bultos,
  CASE WHEN p_partkey%29<>0 THEN ((p_partkey*7+id_deposito*13+day(d::DATE))%50-2)*p_size/1000.0::DOUBLE END cantidad_total_htls
  FROM part CROSS JOIN dep CROSS JOIN (VALUES ('2001-06-15'),('2001-06-30')) t(d)),
precios AS (SELECT p_partkey id_articulo, p_retailprice precio_base, p_retailprice*1.21 precio_final FROM part WHERE p_partkey%23<>0),
rutas AS (SELECT id_sucursal, des_sucursal, id_ruta_fv1 id_ruta, min(des_personal_fv1) preventista FROM cli
  WHERE id_ruta_fv1 IS NOT NULL GROUP BY 1,2,3),
cupos AS (SELECT periodo, 'PROV '||(id_ruta%3) proveedor, id_sucursal, id_sucursal||' - '||des_sucursal sucursal, id_ruta,
  preventista, generico, generico||'/'||(id_ruta%2) desagregado,
  CASE WHEN (id_ruta+id_sucursal)%11<>0 THEN ((id_sucursal*31+id_ruta*17+ascii(generico))%90)::DOUBLE END cupo
  FROM rutas CROSS JOIN (SELECT DISTINCT generico FROM art) g CROSS JOIN (VALUES ('2001-05'),('2001-06')) t(periodo)),
cupos_cob AS (SELECT '2001-06' periodo, 'GENERICO' tipo_apertura, id_sucursal, id_ruta, preventista, generico marca,
  NULL::VARCHAR generico, ((id_sucursal*7+id_ruta*5+ascii(generico))%9)::DOUBLE cupo
  FROM rutas CROSS JOIN (SELECT DISTINCT generico FROM art) g
  UNION ALL SELECT '2001-06','MARCA',id_sucursal,id_ruta,preventista,NULL,marca,((id_sucursal*7+id_ruta*5+length(marca))%7)::DOUBLE
  FROM rutas CROSS JOIN (SELECT DISTINCT marca FROM art) g),
feriados AS (SELECT unnest([DATE '2001-06-20', DATE '2001-06-16', DATE '2001-06-17', DATE '2001-05-25', DATE '2001-01-01']) fecha)"""
