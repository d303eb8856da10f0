"""Logistics: service level, rejections, returns and route economics."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retail_analytics.functions.grid import shared, with_scalars
from retail_analytics.functions.ordered import quantiles, running
from retail_analytics.functions.shape import append_total, grouping_sets, ratio
from retail_analytics.operators import filters as fl, stats as st

# -- fixed values -------------------------------------------------------------------------------------------------
SENTINELS = [0, 33]
MIN_DELIVERIES, GAP_SERVICE, GAP_REJECTION = 200, 0.05, 0.02
LEAD_MIN, LEAD_MAX = 0, 60
MIN_LINES_REJECTION, MIN_UNITS_RETURN, Z_OUTLIER, TOP = 300, 3000, 3.5, 40
MIN_VISITS = 200
LAGGARD = "Rezagado significativo"
SMALL = "Sin evidencia (muestra chica)"
TOTAL, REST = "TOTAL GENERAL", "RESTO"
DAYS = ["Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo"]
LONG_DIMENSIONS = ["Cliente", "Articulo"]
# -----------------------------------------------------------------------------------------------------------------


# -- service level --------------------------------------------------------------------------------------------------
def lead_histogram(lines: DataFrame, sucursal: DataFrame, since: str, until: str) -> DataFrame:
    """Deliveries per (branch, carrier, lead days) at invoice grain; only plausible leads.

    The lead takes 61 values, so everything after this works on a small histogram.
    """
    v = fl.dates(lines, since, until).filter("id_documento = 'FCVTA' and not anulado and fecha_pedido is not null and fecha_entrega is not null")
    e = v.groupBy("id_documento", "letra", "serie", "nro_doc", "id_sucursal", "id_fletero_carga").agg(
        F.datediff(F.min("fecha_entrega"), F.min("fecha_pedido")).cast("long").alias("lead_dias"), F.sum("subtotal_neto").alias("neto"), F.sum("cantidades_total").alias("bultos"))
    h = e.filter(F.col("lead_dias").between(LEAD_MIN, LEAD_MAX)).groupBy("id_sucursal", "id_fletero_carga", "lead_dias").agg(
        F.count(F.lit(1)).alias("entregas"), F.sum("bultos").alias("bultos"), F.sum("neto").alias("neto"))
    return h.join(sucursal.select("id_sucursal", F.col("descripcion").alias("sucursal")), "id_sucursal")


def nearest_rank(hist: DataFrame, by: list[str], value: str, weight: str, probs: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles of a bounded histogram: one array per group, walked once."""
    g = hist.groupBy(*by, value).agg(F.sum(weight).alias("_w")).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_w").alias("w")))).alias("_h"), F.sum("_w").alias("_t"))

    def at(p: float) -> Column:
        step = F.aggregate("_h", F.struct(F.lit(0).cast("long").alias("c"), F.lit(None).cast("long").alias("r")),
                           lambda a, x: F.struct((a["c"] + x["w"]).alias("c"), F.when(a["r"].isNull() & ((a["c"] + x["w"]) >= F.col("_t") * p), x["v"]).otherwise(a["r"]).alias("r")))
        return step["r"].cast("double")
    return g.select(*by, *[at(p).alias(n) for n, p in probs.items()])


def service_level(hist: DataFrame, sentinels: list[int] | None = None, min_deliveries: int = MIN_DELIVERIES) -> DataFrame:
    """Service level by branch and by carrier with the verdict against the network, and the TOTAL.

    Sentinel carriers leave before the base rate; carriers with few deliveries keep their row, flagged and without verdict.
    """
    sent = SENTINELS if sentinels is None else sentinels
    d = hist.filter(~F.coalesce(F.col("id_fletero_carga").isin(sent), F.lit(False)))
    carrier = F.concat(F.lit("Fletero "), F.col("id_fletero_carga"))
    cell = F.explode(F.array(F.struct(F.lit("Sucursal").alias("nivel"), F.col("sucursal").alias("entidad"), F.col("sucursal").alias("suc")),
                             F.struct(F.lit("Fletero").alias("nivel"), carrier.alias("entidad"), F.col("sucursal").alias("suc")),
                             F.struct(F.lit("TOTAL").alias("nivel"), F.lit(TOTAL).alias("entidad"), F.lit(TOTAL).alias("suc"))))
    x = d.withColumn("_c", cell).select("_c.nivel", "_c.entidad", "_c.suc", "lead_dias", "entregas", "bultos", "neto")
    key = ["nivel", "entidad", "suc"]
    t = x.groupBy(*key).agg(F.sum("entregas").alias("entregas"), F.sum(F.when(F.col("lead_dias") <= 1, F.col("entregas")).otherwise(0)).alias("_ok"),
                            ratio(F.sum(F.col("lead_dias") * F.col("entregas")), F.sum("entregas")).alias("lead_medio"), F.sum("bultos").alias("bultos"), F.sum("neto").alias("neto"))
    t = t.join(nearest_rank(x, key, "lead_dias", "entregas", {"lead_p50": 0.5, "lead_p90": 0.9}), key)
    t = t.withColumn("muestra_chica", (F.col("nivel") == "Fletero") & (F.col("entregas") < min_deliveries))
    t = t.withColumn("_s", F.when(~F.col("muestra_chica"), F.col("_ok"))).withColumn("_n", F.when(~F.col("muestra_chica"), F.col("entregas")))
    t = st.verdict(t, "_s", "_n", GAP_SERVICE, True, LAGGARD, "Mejor que la red", ["nivel"]).drop("tasa", "_s", "_n")
    t = t.withColumn("otif", ratio("_ok", "entregas"))
    tot = F.col("nivel") == "TOTAL"
    t = t.withColumn("veredicto", F.when(tot, "Red completa").otherwise(F.col("veredicto"))).withColumn("z", F.when(~tot, F.col("z")))
    return t.withColumn("brecha", F.when(tot, 0.0).otherwise(F.col("brecha"))).drop("_ok").withColumnRenamed("suc", "sucursal")


def worst_laggard(table: DataFrame) -> DataFrame:
    """The laggard with the largest negative gap, branch or carrier."""
    cols = ["nivel", "entidad", "brecha", "z"]
    return table.filter(F.col("veredicto") == LAGGARD).agg(F.min_by(F.struct(*cols), F.struct("brecha", "entidad")).alias("_r")).filter("_r is not null").select("_r.*")


# -- rejections -----------------------------------------------------------------------------------------------------
REJ = ["n_lineas", "n_rechazo", "bultos_rechazo", "valor_rechazo", "neto_facturado"]


def rejection_metrics(lines: DataFrame, cliente: DataFrame, articulo: DataFrame, sucursal: DataFrame, sentinels: list[int] | None = None) -> DataFrame:
    """Rejection counts and amounts over six dimensions from one scan.

    Lines are first added up per (branch, carrier, client, SKU, weekday), then spread over the six dimensions and
    added up again with map-side partials; names join at entity grain.
    """
    sent = SENTINELS if sentinels is None else sentinels
    rej = F.col("cantidades_rechazo") > 0
    fine = lines.groupBy("id_sucursal", "id_fletero_carga", "id_cliente", "id_articulo", (F.weekday("fecha_comprobante") + 1).cast("long").alias("dow")).agg(
        F.count(F.lit(1)).alias("n_lineas"), F.count_if(rej).alias("n_rechazo"), F.sum(F.when(rej, F.col("cantidades_rechazo")).otherwise(0.0)).alias("bultos_rechazo"),
        F.sum(F.when(rej, -F.col("subtotal_neto")).otherwise(0.0)).alias("valor_rechazo"),
        F.sum(F.when(F.coalesce("cantidades_rechazo", F.lit(0.0)) == 0, F.col("subtotal_neto")).otherwise(0.0)).alias("neto_facturado"))
    dims = {"Sucursal": "id_sucursal", "Fletero": "id_fletero_carga", "Cliente": "id_cliente", "Articulo": "id_articulo", "Dia de semana": "dow"}
    cell = F.explode(F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(c).alias("id")) for k, c in dims.items()]))
    t = fine.withColumn("_c", cell).select("_c.dimension", "_c.id", *REJ).filter((F.col("dimension") != "Fletero") | ~F.coalesce(F.col("id").isin(sent), F.lit(False)))
    t = shared(t.groupBy("dimension", "id").agg(*[F.sum(c).alias(c) for c in REJ]))
    c = cliente.groupBy("id_cliente").agg(F.max(F.when(F.col("fantasia").rlike(r"\p{Alnum}"), fl.blank_to_null("fantasia"))).alias("_f"),
                                          F.max(fl.blank_to_null("razon_social")).alias("_r"), F.max(fl.blank_to_null("des_subcanal_mkt")).alias("subcanal"))
    name = F.coalesce("_f", F.concat("_r", F.lit(" ["), "id_cliente", F.lit("]")), F.concat(F.lit("CLIENTE "), "id_cliente"))
    labels = {
        "Sucursal": sucursal.select(F.col("id_sucursal").alias("_k"), F.col("descripcion").alias("entidad")),
        "Articulo": articulo.select(F.col("id_articulo").alias("_k"), F.col("des_articulo").alias("entidad")),
        "Cliente": c.select(F.col("id_cliente").alias("_k"), name.alias("entidad"))}
    out = None
    for d in dims:
        p = t.filter(F.col("dimension") == d)
        if d in labels:
            p = p.join(labels[d], F.col("id") == F.col("_k"), "left" if d == "Cliente" else "inner").drop("_k")
            if d == "Cliente":
                p = p.withColumn("entidad", F.coalesce("entidad", F.concat(F.lit("CLIENTE "), "id")))
        elif d == "Fletero":
            p = p.withColumn("entidad", F.concat(F.lit("Fletero "), "id"))
        else:
            p = p.withColumn("entidad", F.element_at(F.array(*[F.lit(x) for x in DAYS]), F.col("id").cast("int")))
        p = p.select("dimension", "entidad", F.col("id").cast("string").alias("id_entidad"), *REJ)
        out = p if out is None else out.unionByName(p)
    sub = t.filter("dimension = 'Cliente'").join(c.select(F.col("id_cliente").alias("_k"), "subcanal"), F.col("id") == F.col("_k"), "left")
    sub = sub.groupBy(F.coalesce("subcanal", F.lit("SIN SUBCANAL")).alias("entidad")).agg(*[F.sum(x).alias(x) for x in REJ])
    return out.unionByName(sub.select(F.lit("Subcanal").alias("dimension"), "entidad", F.lit(None).cast("string").alias("id_entidad"), *REJ))


def rejection_table(long: DataFrame, counters: list[int], closed: list[str], min_lines: int = MIN_LINES_REJECTION, top: int = TOP) -> DataFrame:
    """Rate against the network inside each dimension, share of the rejected value, Pareto, and a RESTO row for the tail.

    Base rate, share and Pareto come from the whole dimension; small entities keep their row and lose the verdict.  The
    entities after the first ``top`` keep their rows too, flagged ``cola``; the RESTO row adds them up.
    """
    d = shared(st.verdict(long, "n_rechazo", "n_lineas", GAP_REJECTION, False, "Rechazo alto (significativo)", "Rechazo bajo (significativo)", ["dimension"]))
    long_dim = F.col("dimension").isin(LONG_DIMENSIONS)
    small = long_dim & (F.col("n_lineas") < min_lines)
    d = d.withColumn("veredicto", F.when(small, SMALL).otherwise(F.col("veredicto"))).withColumn("significativo", F.col("significativo") & ~small)
    d = d.withColumn("_x", F.greatest("valor_rechazo", F.lit(0.0))).withColumn("_one", F.lit(1)).withColumn("_h", F.xxhash64("entidad", "id_entidad"))
    r = running(d, "valor_rechazo", {"_c": "valor_rechazo", "_o": "_one"}, ["dimension"], "_h", descending=True)
    tot = d.groupBy("dimension").agg(F.sum("_x").alias("_t"))
    r = r.join(tot, "dimension").withColumn("share", ratio("valor_rechazo", "_t"))
    r = r.withColumn("pareto", F.when(F.col("dimension") != "Dia de semana", ratio("_c", "_t")))
    r = r.withColumn("_tail", long_dim & (F.col("_o") > top) & (F.col("_o_total") > top))
    note = (F.when((F.col("dimension") == "Sucursal") & F.col("entidad").isin(closed or [""]), "Sucursal cerrada")
            .when((F.col("dimension") == "Cliente") & F.col("id_entidad").isin([str(x) for x in counters]), "Cliente mostrador").otherwise(""))
    cols = ["dimension", "entidad", *REJ, "tasa", "tasa_red", "brecha", "z", "significativo", "veredicto", "share", "pareto", "nota", "cola"]
    head = r.withColumn("nota", note).withColumn("cola", F.col("_tail")).select(*cols)
    null = F.lit(None).cast("double")
    rest = r.filter("_tail").groupBy("dimension").agg(F.count(F.lit(1)).alias("_k"), *[F.sum(c).alias(c) for c in REJ], F.sum("share").alias("share"))
    rest = rest.select("dimension", F.concat(F.lit(f"{REST} ("), "_k", F.lit(" entidades)")).alias("entidad"), *REJ, ratio("n_rechazo", "n_lineas").alias("tasa"),
                       null.alias("tasa_red"), null.alias("brecha"), null.alias("z"), F.lit(False).alias("significativo"), F.lit("Cola agregada").alias("veredicto"),
                       "share", F.lit(1.0).alias("pareto"), F.lit("").alias("nota"), F.lit(False).alias("cola"))
    t = long.filter("dimension = 'Sucursal'").agg(*[F.sum(c).alias(c) for c in REJ])
    rate = ratio("n_rechazo", "n_lineas")
    t = t.select(F.lit("TOTAL").alias("dimension"), F.lit(TOTAL).alias("entidad"), *REJ, rate.alias("tasa"), rate.alias("tasa_red"), F.lit(0.0).alias("brecha"), null.alias("z"),
                 F.lit(False).alias("significativo"), F.lit("Red completa").alias("veredicto"), F.lit(1.0).alias("share"), F.lit(1.0).alias("pareto"), F.lit("").alias("nota"), F.lit(False).alias("cola"))
    return head.unionByName(rest).unionByName(t)


# -- returns --------------------------------------------------------------------------------------------------------
RET = ["bultos_bruto", "bultos_dev", "bruto_pesos", "dev_pesos"]


def return_rates(lines: DataFrame, min_units: float = MIN_UNITS_RETURN, z_cut: float = Z_OUTLIER, closed: list[str] | None = None,
                 partial_month: str | None = None) -> DataFrame:
    """Returns as a share of the own gross sale by category, brand, branch, month and SKU.

    SKUs from ``min_units`` on get a robust z; the others keep their row, flagged ``bajo_piso``.
    """
    inv = F.col("id_documento") == "FCVTA"
    m = [F.sum(F.when(inv, F.col("cantidades_total"))).alias("bultos_bruto"), F.sum(F.when(~inv, F.abs("cantidades_total"))).alias("bultos_dev"),
         F.sum(F.when(inv, F.col("facturacion_neta"))).alias("bruto_pesos"), F.sum(F.when(~inv, F.abs("facturacion_neta"))).alias("dev_pesos")]
    brand = F.coalesce(fl.blank_to_null("marca"), F.lit("SIN MARCA"))
    v = lines.select("generico", brand.alias("marca"), "sucursal", F.date_format("fecha_comprobante", "yyyy-MM").alias("mes"),
                     F.concat("des_articulo", F.lit(" ["), brand, F.lit("]")).alias("articulo"), "id_documento", "cantidades_total", "facturacion_neta")
    sets = {"Generico": ["generico"], "Marca": ["marca"], "Sucursal": ["sucursal"], "Mes": ["mes"], "Articulo": ["articulo"], "TOTAL": []}
    g = grouping_sets(v, sets, m, label="dimension").fillna(0, subset=RET)
    g = g.select("dimension", F.coalesce("generico", "marca", "sucursal", "mes", "articulo", F.lit(TOTAL)).alias("entidad"), *RET)
    g = g.withColumn("tasa_bultos", F.when(F.col("bultos_bruto") > 0, F.col("bultos_dev") / F.col("bultos_bruto")))
    g = shared(g.withColumn("tasa_valor", F.when(F.col("bruto_pesos") > 0, F.col("dev_pesos") / F.col("bruto_pesos"))))
    art = g.filter("dimension = 'Articulo'").withColumn("bajo_piso", F.col("bultos_bruto") < min_units)
    art = art.withColumn("_r", F.when(~F.col("bajo_piso"), F.col("tasa_bultos")))
    med = art.agg(F.percentile("_r", 0.5).alias("_m"))                       # counters per distinct rate, map-side
    mad = with_scalars(art.select("_r"), med).agg(F.percentile(F.abs(F.col("_r") - F.col("_m")), 0.5).alias("_d"))
    art = with_scalars(with_scalars(art, med), mad)
    scale = F.coalesce(F.col("_d"), F.lit(0.0)) * st.MAD_TO_SIGMA
    z = F.when(~F.col("bajo_piso"), F.when(scale == 0, 0.0).otherwise((F.col("_r") - F.col("_m")) / scale))
    art = art.withColumn("z_robusto", z).withColumn("outlier", F.coalesce(F.abs("z_robusto") >= z_cut, F.lit(False))).drop("_r", "_m", "_d")
    rest = g.filter("dimension <> 'Articulo'").withColumn("bajo_piso", F.lit(False)).withColumn("z_robusto", F.lit(None).cast("double")).withColumn("outlier", F.lit(False))
    note = (F.when(F.col("entidad").isin(closed or [""]), "Sucursal cerrada")
            .when((F.col("dimension") == "Mes") & (F.col("entidad") == F.lit(partial_month)), "Mes incompleto").otherwise(""))
    return rest.unionByName(art).withColumn("nota", note)


# -- routes ---------------------------------------------------------------------------------------------------------
def routes(lines: DataFrame, counters: list[int], min_visits: int = MIN_VISITS) -> DataFrame:
    """Visits (invoices), clients, active days, units, mean and median drop per (branch, route); few visits are flagged."""
    key = ["sucursal", "id_sucursal", "id_ruta"]
    inv = lines.filter("id_ruta is not null").groupBy(*key, "id_cliente", "fecha_comprobante", "id_documento", "letra", "serie", "nro_doc").agg(
        F.sum("cantidades_total").alias("bultos"), F.sum("subtotal_neto").alias("neto"), F.sum("facturacion_neta").alias("bruto"),
        F.count(F.lit(1)).alias("lineas"), F.max("des_personal_fv1").alias("preventista"))
    t = inv.groupBy(*key).agg(F.max("preventista").alias("preventista"), F.count(F.lit(1)).alias("visitas"), F.count_distinct("id_cliente").alias("clientes"),
                              F.count_distinct("fecha_comprobante").alias("dias_activos"), F.count_distinct(F.when(F.col("id_cliente").isin(counters), F.col("id_cliente"))).alias("clientes_mostrador"),
                              F.sum("bultos").alias("bultos"), F.sum("neto").alias("neto"), F.sum("bruto").alias("bruto"), F.avg("lineas").alias("lineas_x_visita"))
    t = t.withColumn("pocas_visitas", F.col("visitas") < min_visits)
    return t.join(quantiles(inv, "bultos", {"mediana_bultos_visita": 0.5}, key), key)


def route_table(r: DataFrame, closed: list[str]) -> DataFrame:
    """Drop size, low-density quartile of the routes with enough visits and the TOTAL with ratios of sums."""
    d = shared(r.withColumn("drop_size", ratio("bultos", "visitas")).withColumn("neto_por_visita", ratio("neto", "visitas")))
    d = with_scalars(d, quantiles(d.filter("not pocas_visitas"), "drop_size", {"_p25": 0.25}))
    d = d.withColumn("densidad", F.when(F.col("pocas_visitas"), SMALL).when(F.col("drop_size") <= F.col("_p25"), "Baja densidad (cuartil inferior)").otherwise("Normal")).drop("_p25")
    d = d.withColumn("clave", F.concat("sucursal", F.lit(" / "), "id_ruta")).withColumn("nota", F.when(F.col("sucursal").isin(closed or [""]), "Sucursal cerrada").otherwise(""))
    return append_total(d, "clave", ["visitas", "clientes", "bultos", "neto", "bruto", "clientes_mostrador"],
                        {"drop_size": ratio(F.sum("bultos"), F.sum("visitas")), "neto_por_visita": ratio(F.sum("neto"), F.sum("visitas"))})
