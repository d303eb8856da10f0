"""Commercial actions: line extract, grain collapse, promo enrichment, pivots, frame diff, rate model, metrics."""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from retail_analytics.functions.checksums import differing_ranges, only_ranges
from retail_analytics.functions.grid import complete_grid, shared
from retail_analytics.functions.shape import append_total, grouping_sets, ratio, slug, wide
from retail_analytics.operators import filters as fl

# -- fixed values -------------------------------------------------------------------------------------------------
TOTAL = "TOTAL GENERAL"
FREE, DISCOUNT = "SIN CARGO", "Descuentos"
LAG, REVIEW = "Desfasaje de carga (dia en curso)", "REVISAR (dia cerrado)"
DEFECT, DIVERGENCE = "baseline-defect", "real-divergence"
# -----------------------------------------------------------------------------------------------------------------
TERNA = ["fecha", "id_cliente", "id_articulo"]
PICKED = ["precio", "bonific", "id_linea", "razon_social", "sucursal", "des_articulo", "marca", "generico"]
SUMS = ["cantidad", "facturacion", "descuentos"]


def line_extract(lines: DataFrame) -> DataFrame:
    """Sales lines with labels, price without sign and rate as a fraction; voided lines are out."""
    return lines.filter(~F.col("anulado")).select(
        F.col("id").alias("id_linea"), F.col("fecha_comprobante").alias("fecha"), "id_cliente", "razon_social",
        F.concat("id_sucursal", F.lit(" - "), "sucursal").alias("sucursal"), "id_articulo", "des_articulo", "marca", "generico",
        F.abs("precio_unitario_bruto").alias("precio"), (F.col("bonificacion") / 100.0).alias("bonific"), F.col("cantidades_total").alias("cantidad"),
        F.col("facturacion_neta").alias("facturacion"), "descuentos", fl.document_key().alias("comprobante"))


def _winner(cols: list[str]) -> Column:
    """Whole winning row: largest quantity, largest price, smallest line id, then the largest rate; NULLs lose.

    ``max`` of a struct is a partial aggregate, so a key with a third of the lines is reduced before the shuffle.
    """
    return F.max(F.struct(F.col("cantidad").alias("_1"), F.col("precio").alias("_2"), (-F.col("id_linea")).alias("_3"), F.col("bonific").alias("_4"),
                          F.struct(*cols).alias("row")))["row"]


def collapse(lines: DataFrame, key: list[str], picked: list[str] | None = None) -> DataFrame:
    """One row per key: sums of the additive columns, the winning line's values for the rest, number of prices and rates."""
    p = [c for c in (picked or PICKED) if c not in key]
    t = lines.groupBy(*key).agg(*[F.sum(c).alias(c) for c in SUMS], _winner(p).alias("_r"), F.count_distinct("precio").alias("precios"),
                                F.count_distinct("bonific").alias("bonificaciones"))
    return t.select(*key, *SUMS, *[F.col(f"_r.{c}").alias(c) for c in p], "precios", "bonificaciones")


def multi_price(lines: DataFrame, key: list[str]) -> DataFrame:
    """Keys with several prices or rates, the candidates and the pick."""
    t = lines.groupBy(*key).agg(F.count_distinct("precio").alias("precios"), F.count_distinct("bonific").alias("bonificaciones"), F.min("precio").alias("precio_min"),
                                F.max("precio").alias("precio_max"), _winner(["precio", "bonific"]).alias("_r"))
    t = t.filter("precios > 1 or bonificaciones > 1")
    return t.select(*key, "precios", "bonificaciones", "precio_min", "precio_max", F.col("_r.precio").alias("precio_elegido"), F.col("_r.bonific").alias("bonific_elegido"))


def document_price(lines: DataFrame) -> DataFrame:
    """Price per (document, SKU) by the same pick."""
    return lines.groupBy("comprobante", "id_articulo").agg(_winner(["precio"])["precio"].alias("precio_comprobante"))


def client_branch(cliente: DataFrame) -> DataFrame:
    """Branch label of each client id; the lowest branch wins."""
    return cliente.filter(~F.col("anulado")).groupBy("id_cliente").agg(
        F.min_by(F.concat("id_sucursal", F.lit(" - "), "des_sucursal"), "id_sucursal").alias("sucursal"))


def enrich(promo: DataFrame, branches: DataFrame, prices: DataFrame, supervisors: DataFrame, doc_prices: DataFrame) -> DataFrame:
    """Promo lines with branch, key, exact price (NULL if none), tier, zone, Total2, discount and type.

    ``prices`` (fecha, id_cliente, id_articulo, precio), ``supervisors`` (clave, zona), ``doc_prices`` (comprobante,
    id_articulo, precio_comprobante).
    """
    client, art = F.col("`Cod. Cliente`").try_cast("long"), F.col("Artículo Distribuidora").try_cast("long")
    d = promo.withColumn("_f", F.col("Fecha").try_cast("date")).withColumn("_c", client).withColumn("_a", art)
    d = d.join(branches.select(F.col("id_cliente").alias("_c"), F.col("sucursal").alias("SUCURSAL")), "_c", "left")
    d = d.withColumn("CONCAT", F.concat_ws("", "Fecha", "`Cod. Cliente`", "Artículo Distribuidora"))
    p = prices.select(F.col("fecha").alias("_f"), F.col("id_cliente").alias("_c"), F.col("id_articulo").alias("_a"), F.col("precio").alias("PRECIO FINAL"))
    d = d.join(p, ["_f", "_c", "_a"], "left")
    dp = doc_prices.select(F.col("comprobante").alias("_doc"), F.col("id_articulo").alias("_a"), F.col("precio_comprobante").alias("PRECIO COMPROBANTE"))
    d = d.withColumn("_doc", F.trim("Comprobante")).join(dp, ["_doc", "_a"], "left")
    d = fl.by_label(d, supervisors, "SUCURSAL", "clave", "zona").withColumnRenamed("zona", "ZONA")
    price, pct = F.col("PRECIO FINAL"), F.col("Descuento %")
    zero = F.lit(0.0)
    d = d.withColumn("mvb", F.coalesce(fl.promo_tier("Descripción Acción"), F.lit(fl.PROMO_DEFAULT)))
    d = d.withColumn("Total2", F.coalesce("Cantidad", zero) * price)
    d = d.withColumn("Descuento", F.col("Total2") * (F.coalesce(pct, zero) / 100.0) + F.coalesce(F.col("Cantidad Sin Cargo"), zero) * price)
    return d.withColumn("Tipo Descuento", F.when(pct.isNull(), FREE).otherwise(DISCOUNT)).drop("_f", "_c", "_a", "_doc")


def unresolved(enriched: DataFrame) -> DataFrame:
    """Promo lines without branch or without price, per client and reason."""
    why = F.filter(F.array(F.when(F.col("SUCURSAL").isNull(), "sucursal"), F.when(F.col("PRECIO FINAL").isNull(), "precio")), lambda x: x.isNotNull())
    return enriched.withColumn("motivo", F.explode(why)).groupBy("motivo", F.col("`Cod. Cliente`").alias("cliente")).agg(F.count(F.lit(1)).alias("lineas"))


# -- pivots ---------------------------------------------------------------------------------------------------------
def net_sales_pivot(ternas: DataFrame, rows: list[str]) -> DataFrame:
    """Net sales, discounts and their ratio of group sums, with the TOTAL (ratio of the grand sums)."""
    t = ternas.groupBy(*rows).agg(F.sum("facturacion").alias("facturacion"), F.sum("descuentos").alias("descuentos"))
    t = t.withColumn("campo1", ratio("descuentos", "facturacion"))
    return append_total(t, rows[0], ["facturacion", "descuentos"], {"campo1": ratio(F.sum("descuentos"), F.sum("facturacion"))})


def discount_pivot(promo: DataFrame, rows: dict[str, str]) -> DataFrame:
    """Discount by the given row fields (name -> column) with the TOTAL; unresolved prices add nothing."""
    t = promo.groupBy(*[F.col(f"`{c}`").alias(n) for n, c in rows.items()]).agg(F.coalesce(F.sum("Descuento"), F.lit(0.0)).alias("descuento"))
    return append_total(t, next(iter(rows)), ["descuento"])


def action_category(promo: DataFrame, rows: dict[str, str], column: str, values: list[str]) -> DataFrame:
    """Action x category with a fixed set of columns, zero filled, and the TOTAL."""
    p = promo.select(*[F.col(f"`{c}`").alias(n) for n, c in rows.items()], F.col(f"`{column}`").alias("_c"), "Descuento")
    w = wide(p, list(rows), "_c", values, {"d": "Descuento"}, 0.0)
    return append_total(w, next(iter(rows)), [f"d_{slug(v)}" for v in values])


# -- diff -----------------------------------------------------------------------------------------------------------
def frame_diff(base: DataFrame, backup: DataFrame, keys: list[str], values: list[str], tolerance: float, date: str | None = None,
               since: str | None = None, until: str | None = None) -> DataFrame:
    """Value cells of two keyed frames that differ by more than the tolerance, with the side they live on.

    The TOTAL row and rows out of the period are left out; a missing value counts 0 in the delta.  Checksums per key range tell
    where the frames differ, and only rows of such ranges are compared cell by cell: equal frames cost two scans.
    """
    def scope(d: DataFrame) -> DataFrame:
        d = d.filter(F.coalesce(F.col(keys[0]).cast("string") != TOTAL, F.lit(True)))
        if date and since and until:
            d = d.filter(F.col(date).between(F.lit(since).cast("date"), F.lit(until).cast("date")))
        return d
    pack = [F.struct(*[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)]).alias("_v")]
    a = shared(scope(base).select(*keys, *pack).withColumnRenamed("_v", "_a"))
    b = shared(scope(backup).select(*keys, *pack).withColumnRenamed("_v", "_b"))
    found = differing_ranges(a.withColumnRenamed("_a", "_v"), b.withColumnRenamed("_b", "_v"), keys)
    a, b = only_ranges(a, keys, found), only_ranges(b, keys, found)
    both = a.select(*keys, "_a", F.lit(None).cast(b.schema["_b"].dataType).alias("_b")).unionByName(
        b.select(*keys, F.lit(None).cast(a.schema["_a"].dataType).alias("_a"), "_b"))
    j = both.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))            # NULL-safe full outer join in one shuffle
    side = F.when(F.col("_b").isNull(), "base-only").when(F.col("_a").isNull(), "backup-only").otherwise("both")
    cells = F.array(*[F.struct(F.lit(v).alias("columna"), F.col(f"_a.v{i}").alias("base"), F.col(f"_b.v{i}").alias("backup")) for i, v in enumerate(values)])
    t = j.select(*keys, side.alias("presencia"), F.inline(cells))
    return t.withColumn("delta", F.coalesce("base", F.lit(0.0)) - F.coalesce("backup", F.lit(0.0))).filter(F.abs("delta") > tolerance)


def classify(deltas: DataFrame, evidence: list[tuple[str, Column]]) -> DataFrame:
    """Reason of each delta: the first predicate that holds makes it a known defect of the base, else it is real."""
    why = fl.first_rule([(p, r) for r, p in evidence])
    return deltas.withColumn("motivo", why).withColumn("clase", F.when(F.col("motivo").isNull(), DIVERGENCE).otherwise(DEFECT))


def validate_prices(generated: DataFrame, reference: DataFrame, tolerance: float) -> DataFrame:
    """Keys whose pick disagrees with the reference: missing, then price, then rate."""
    r = reference.select(*TERNA, F.col("precio").alias("ref_precio"), F.col("bonific").alias("ref_bonific"), F.lit(True).alias("_r"))
    j = generated.select(*TERNA, "precio", "bonific").join(r, TERNA, "left")

    def gap(a: str, b: str) -> Column:
        return F.abs(F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0))) > tolerance
    why = F.when(F.col("_r").isNull(), "missing").when(gap("precio", "ref_precio"), "precio").when(gap("bonific", "ref_bonific"), "bonific")
    return j.withColumn("motivo", why).filter("motivo is not null").drop("_r")


def diff_summary(classified: DataFrame, mismatches: DataFrame) -> DataFrame:
    """Counts of the report."""
    a = classified.groupBy(F.col("clase").alias("concepto")).agg(F.count(F.lit(1)).alias("n"))
    b = classified.agg(F.lit("total_deltas").alias("concepto"), F.count(F.lit(1)).alias("n"))
    c = mismatches.agg(F.lit("terna_mismatches").alias("concepto"), F.count(F.lit(1)).alias("n"))
    return a.unionByName(b).unionByName(c)


def timing_class(enriched: DataFrame, until: str) -> DataFrame:
    """Lines without a price: expected load lag on the last day of the window, else to review."""
    d = enriched.filter(F.col("PRECIO FINAL").isNull())
    same = F.coalesce(F.col("Fecha").try_cast("date") == F.lit(until).cast("date"), F.lit(False))
    return d.select("Fecha", "Comprobante", F.col("`Cod. Cliente`").alias("cliente"), F.col("Artículo Distribuidora").alias("articulo"),
                    F.when(same, LAG).otherwise(REVIEW).alias("clasificacion"))


def price_comparison(enriched: DataFrame, tolerance: float) -> DataFrame:
    """Lines where both prices exist and differ."""
    d = enriched.filter(F.col("PRECIO FINAL").isNotNull() & F.col("PRECIO COMPROBANTE").isNotNull())
    return d.select("Comprobante", F.col("`Cod. Cliente`").alias("cliente"), F.col("Artículo Distribuidora").alias("articulo"), F.col("PRECIO FINAL").alias("precio_terna"),
                    F.col("PRECIO COMPROBANTE").alias("precio_comprobante"), (F.col("PRECIO FINAL") - F.col("PRECIO COMPROBANTE")).alias("delta")) \
            .filter(F.abs("delta") > tolerance)


def branch_reconciliation(ternas: DataFrame, enriched: DataFrame, tolerance: float) -> DataFrame:
    """Net sales and discounts of both sides per branch (label without id), delta and whether it is within tolerance."""
    bare = F.trim(F.regexp_replace("_s", r"^\d+\s*-\s*", ""))
    a = ternas.withColumn("_s", F.col("sucursal")).groupBy(bare.alias("sucursal")).agg(F.sum("facturacion").alias("facturacion"), F.sum("descuentos").alias("desc_ventas"))
    b = enriched.withColumn("_s", F.col("SUCURSAL")).filter("_s is not null").groupBy(bare.alias("sucursal")).agg(F.sum("Descuento").alias("desc_promo"))
    t = a.join(b, "sucursal", "full").fillna(0, subset=["facturacion", "desc_ventas", "desc_promo"]).withColumn("delta", F.col("desc_ventas") - F.col("desc_promo"))
    t = append_total(t, "sucursal", ["facturacion", "desc_ventas", "desc_promo", "delta"])
    return t.withColumn("dentro", F.when(F.abs("delta") <= tolerance, "SI").otherwise("NO"))


# -- dashboards -----------------------------------------------------------------------------------------------------
def sales_mix(pivot: DataFrame) -> DataFrame:
    """Mix by category, branch and both, from the net-sales pivot."""
    return grouping_sets(pivot, {"generico": ["generico"], "sucursal": ["sucursal"], "ambos": ["sucursal", "generico"]},
                         [F.sum("facturacion").alias("facturacion"), F.sum("descuentos").alias("descuentos"), F.count(F.lit(1)).alias("articulos")])


def promo_dashboard(enriched: DataFrame) -> DataFrame:
    """Discount, amount and operations by action, client, day, weekday and type in one pass."""
    d = enriched.select(F.col("Acción").alias("accion"), F.col("`Cod. Cliente`").alias("cliente"), F.col("Fecha").alias("fecha"),
                        (F.weekday(F.col("Fecha").try_cast("date"))).cast("string").alias("dia"), F.col("Tipo Descuento").alias("tipo"), "Total2", "Descuento")
    g = grouping_sets(d, {k: [k] for k in ("accion", "cliente", "fecha", "dia", "tipo")}, [
        F.coalesce(F.sum("Total2"), F.lit(0.0)).alias("importe"), F.coalesce(F.sum("Descuento"), F.lit(0.0)).alias("descuento"), F.count(F.lit(1)).alias("operaciones")])
    return g.select("nivel", F.coalesce("accion", "cliente", "fecha", "dia", "tipo").alias("valor"), "importe", "descuento", "operaciones")


def quality_counters(enriched: DataFrame) -> DataFrame:
    blank = {"sin_zona": "ZONA", "sin_marca": "Marca", "sin_calibre": "Calibre"}
    return enriched.agg(F.count(F.lit(1)).alias("filas"), *[F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(n) for n, c in blank.items()])


# -- rate model -----------------------------------------------------------------------------------------------------
def signed_purchases(purchases: DataFrame, signs: DataFrame, branches: DataFrame, articles: DataFrame) -> DataFrame:
    """Purchases of the period with sign, branch and category, and why a row stays out.

    ``purchases`` (cod_movimiento, producto 'SKU-text', id_cliente, importe); ``signs`` (cod_movimiento, signo, marca).
    """
    d = purchases.join(signs, "cod_movimiento", "left").withColumn("id_articulo", F.when(F.contains("producto", F.lit("-")), F.trim(F.split("producto", "-")[0]).try_cast("long")))
    d = d.join(articles.select("id_articulo", "generico"), "id_articulo", "left").join(branches, "id_cliente", "left")
    why = (F.when(F.col("signo").isNull(), "codigo sin signo").when(F.lower(F.trim("marca")) != "suma", "codigo no suma")
           .when(F.col("id_articulo").isNull(), "producto sin articulo").when(F.col("id_cliente").isNull(), "sin cliente")
           .when(F.col("generico").isNull() | F.col("sucursal").isNull(), "sin generico o sucursal"))
    return d.withColumn("motivo", why).withColumn("total", F.when(F.col("motivo").isNull(), F.col("signo") * F.col("importe")))


def rate_model(signed: DataFrame, discounts: DataFrame, rates: DataFrame, zones: DataFrame) -> DataFrame:
    """Per (category, zone): discounts, purchases, generated = purchases x rate, difference, purchase needed; block totals.

    ``discounts`` (sucursal, generico, descuentos), ``rates`` (generico, zona, tasa), ``zones`` (sucursal, zona).
    """
    c = signed.filter("motivo is null").join(zones, "sucursal").groupBy("generico", "zona").agg(F.sum("total").alias("compras"))
    d = discounts.join(zones, "sucursal").groupBy("generico", "zona").agg(F.sum("descuentos").alias("descuentos"))
    t = rates.join(c, ["generico", "zona"], "left").join(d, ["generico", "zona"], "left").fillna(0, subset=["compras", "descuentos"])
    t = t.withColumn("tasa_generada", F.col("compras") * F.col("tasa")).withColumn("diferencia", F.col("tasa_generada") - F.col("descuentos"))
    t = t.withColumn("compra_necesaria", ratio("diferencia", "tasa", 0))
    m = ["descuentos", "compras", "tasa_generada", "diferencia", "compra_necesaria"]
    tot = t.groupBy("generico").agg(*[F.sum(x).alias(x) for x in m]).withColumn("zona", F.concat(F.lit("TOTAL "), "generico")).withColumn("tasa", F.lit(None).cast("double"))
    return t.unionByName(tot)


def rate_opening(signed: DataFrame, discounts: DataFrame, categories: DataFrame, zones: DataFrame) -> DataFrame:
    """The same figures per branch: every branch of the map, zero filled, with the category total."""
    c = signed.filter("motivo is null").groupBy("generico", "sucursal").agg(F.sum("total").alias("compras"))
    d = discounts.groupBy("generico", "sucursal").agg(F.sum("descuentos").alias("descuentos"))
    g = complete_grid(zones, categories).join(c, ["generico", "sucursal"], "left").join(d, ["generico", "sucursal"], "left").fillna(0, subset=["compras", "descuentos"])
    tot = g.groupBy("generico").agg(F.sum("compras").alias("compras"), F.sum("descuentos").alias("descuentos"))
    return g.unionByName(tot.withColumn("sucursal", F.concat(F.lit("TOTAL "), "generico")).withColumn("zona", F.lit("")))


def channel_discount(enriched: DataFrame, lists: DataFrame, category: str) -> DataFrame:
    """Discount by channel and by channel x category; clients without a channel are shown as such."""
    d = enriched.filter(F.col("`Razón Social`").isNotNull()).withColumn("id_cliente", F.col("`Cod. Cliente`").try_cast("long"))
    d = d.join(lists.select("id_cliente", "canal"), "id_cliente", "left").withColumn("canal", F.coalesce("canal", F.lit("SIN CANAL")))
    d = d.select("canal", F.col(f"`{category}`").alias("generico"), "Descuento")
    return grouping_sets(d, {"canal": ["canal"], "canal_generico": ["canal", "generico"]}, [F.coalesce(F.sum("Descuento"), F.lit(0.0)).alias("descuento"), F.count(F.lit(1)).alias("lineas")])


def branch_metrics(lines: DataFrame) -> DataFrame:
    """Sales metrics per branch."""
    return lines.filter(~F.col("anulado")).groupBy("sucursal").agg(
        F.sum("facturacion_neta").alias("facturacion"), F.sum("descuentos").alias("descuentos"), F.sum("cantidades_total").alias("bultos"),
        F.sum("cantidad_total_htls").alias("htls"), F.count_distinct("id_cliente").alias("clientes"), F.count_distinct("id_articulo").alias("articulos"))


def correlations(metrics: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair of metrics, as rows."""
    pairs = list(combinations(cols, 2))
    one = metrics.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)])))


