"""Portfolio: ABC/XYZ, channel mix, white space, market basket, product life cycle."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from retail_analytics.functions.grid import complete_grid, shared, with_scalars
from retail_analytics.functions.ordered import quantiles, running
from retail_analytics.functions.shape import ratio, wide
from retail_analytics.operators import stats as st

# -- fixed values -------------------------------------------------------------------------------------------------
ABC_CUTS, XYZ_CUTS, TOL = (0.80, 0.95), (0.50, 1.00), 1e-9
MIN_BUYERS, MIN_CLIENTS, GAP_PENETRATION = 5, 20, 0.30
TAIL_SHARE = 0.001
BASKET_SUPPORT, BASKET_LIFT, MIN_INVOICES = 0.01, 1.05, 500
FORCE_LABELS = {1: "FV1 - Preventa", 4: "FV4 - Autoventa", -1: "Sin fuerza de ventas asignada"}
MONTH_DAYS = 30.4375
# -----------------------------------------------------------------------------------------------------------------


def sku_months(lines: DataFrame, current_from: str, long_from: str, until: str) -> DataFrame:
    """Units and net per SKU and month with the flag of the current window."""
    f = F.col("fecha_comprobante")
    v = lines.filter(f.between(F.lit(long_from).cast("date"), F.lit(until).cast("date")))
    return v.groupBy("id_articulo", F.trunc("fecha_comprobante", "MM").alias("mes"), (f >= F.lit(current_from).cast("date")).alias("ventana_actual")) \
            .agg(F.sum("cantidades_total").alias("bultos"), F.sum("subtotal_neto").alias("neto"))


def abc(df: DataFrame, value: str, ident: str = "id_articulo") -> DataFrame:
    """ABC by cumulative share of the value, cuts inclusive; everything is C when the total is not positive."""
    # the order uses the value to 1e-6 (sums of doubles differ in the last bits from run to run)
    d = df.withColumn("_v", F.round(F.coalesce(value, F.lit(0.0)), 6)).withColumn("_x", F.coalesce(value, F.lit(0.0)))
    r = running(d, "_v", {"_c": "_x"}, ident=ident, descending=True)
    ok = F.col("_c_total") > 0
    r = r.withColumn("participacion", F.when(ok, F.col("_x") / F.col("_c_total")).otherwise(0.0))
    r = r.withColumn("participacion_acum", F.when(ok, F.col("_c") / F.col("_c_total")))
    a = F.col("participacion_acum")
    cls = F.when(a <= ABC_CUTS[0] + TOL, "A").when(a <= ABC_CUTS[1] + TOL, "B").otherwise("C")
    return r.withColumn("clase_abc", cls).drop("_v", "_x", "_c", "_c_total")


def monthly_cv(months: DataFrame, last_month: str) -> DataFrame:
    """CV of the monthly units per SKU from its first month on, later months without a row counting 0.

    Needs no grid: the zeros enter through the number of months.  NULL below two months.
    """
    m = months.groupBy("id_articulo", "mes").agg(F.sum("bultos").alias("b"))
    n = F.months_between(F.lit(last_month).cast("date"), F.min("mes")).cast("long") + 1
    t = m.groupBy("id_articulo").agg(n.alias("meses_ventana"), F.count_if(F.col("b") > 0).alias("meses_con_venta"),
                                     F.sum("b").alias("_s"), F.sum(F.col("b") * F.col("b")).alias("_q"))
    mean = F.col("_s") / F.col("meses_ventana")
    var = F.greatest(F.col("_q") / F.col("meses_ventana") - mean * mean, F.lit(0.0))
    return t.withColumn("cv", F.when(F.col("meses_ventana") >= 2, ratio(F.sqrt(var), F.abs(mean)))).drop("_s", "_q")


def xyz(cv):
    return F.when(cv.isNull(), "N/D").when(cv < XYZ_CUTS[0], "X").when(cv < XYZ_CUTS[1], "Y").otherwise("Z")


def abc_xyz(months: DataFrame, articulo: DataFrame, cv_months: tuple[str, str]) -> DataFrame:
    """SKU table with ABC on the net of the current window and XYZ on the complete months of the long window."""
    m = shared(months)
    cur = m.filter("ventana_actual").groupBy("id_articulo").agg(
        F.sum("neto").alias("neto_12m"), F.sum("bultos").alias("bultos_12m"), F.count_distinct("mes").alias("meses_con_venta_12m"))
    a, b = cv_months
    v = monthly_cv(m.filter(F.col("mes").between(F.lit(a).cast("date"), F.lit(b).cast("date"))), b)
    t = abc(shared(cur), "neto_12m").join(v, "id_articulo", "left").fillna(0, subset=["meses_ventana", "meses_con_venta"])
    t = t.withColumn("clase_xyz", xyz(F.col("cv")))
    sep = F.when(F.col("clase_xyz") == "N/D", " ").otherwise("")
    return t.withColumn("celda", F.concat("clase_abc", sep, "clase_xyz")).join(
        articulo.select("id_articulo", "des_articulo", "generico", "marca"), "id_articulo", "left")


def nine_box(table: DataFrame) -> DataFrame:
    """SKUs and net per cell with their shares."""
    t = table.groupBy("celda", "clase_abc", "clase_xyz").agg(F.count(F.lit(1)).alias("skus"), F.sum("neto_12m").alias("neto"))
    t = with_scalars(t, t.agg(F.sum("skus").alias("_s"), F.sum("neto").alias("_n")))
    return t.withColumn("pct_skus", ratio("skus", "_s")).withColumn("pct_neto", ratio("neto", "_n")).drop("_s", "_n")


# -- channels -------------------------------------------------------------------------------------------------------
def collapse_tail(df: DataFrame, col: str, value: str, share: float = TAIL_SHARE, label: str = "OTROS") -> DataFrame:
    """Members below a share of the total become one; nothing changes when the total is not positive."""
    m = df.groupBy(col).agg(F.sum(value).alias("_w"))
    m = with_scalars(m, df.agg(F.sum(value).alias("_t")))
    small = m.filter((F.col("_t") > 0) & (F.col("_w") / F.col("_t") < share)).select(F.col(col).alias("_k"))
    j = df.join(small, F.col(col) == F.col("_k"), "left")
    return j.withColumn(col, F.when(F.col("_k").isNotNull(), F.lit(label)).otherwise(F.col(col))).drop("_k")


def contingency(df: DataFrame, row: str, col: str, value: str, cols: list[str]) -> DataFrame:
    """Contingency table with TOTAL column and TOTAL GENERAL row; net returns count 0."""
    t = df.groupBy(row, col).agg(F.greatest(F.sum(value), F.lit(0.0)).alias("_v"))
    t = t.withColumn(row, F.explode(F.array(row, F.lit("TOTAL GENERAL"))))
    w = wide(t, [row], col, cols, {"v": "_v"})
    return w.join(t.groupBy(row).agg(F.sum("_v").alias("total")), row).filter("total > 0")


def residual_table(res: DataFrame, row: str, col: str, cols: list[str]) -> DataFrame:
    """Pearson residuals side by side, with the chi-square contribution of each column as the closing row."""
    rows = wide(res, [row], col, cols, {"r": "residuo"}, fill=None)
    sq = res.select(F.lit("TOTAL GENERAL (chi2)").alias(row), col, (F.col("residuo") * F.col("residuo")).alias("residuo"))
    return rows.unionByName(wide(sq, [row], col, cols, {"r": "residuo"}, fill=None))


def channel_yoy(lines: DataFrame, current_from: str, previous_from: str, until: str, channel: str = "des_subcanal_mkt") -> DataFrame:
    """Channel growth between two windows of equal length: units, clients, units per client and their changes."""
    f = F.col("fecha_comprobante")
    v = lines.filter(f.between(F.lit(previous_from).cast("date"), F.lit(until).cast("date")))
    now = f >= F.lit(current_from).cast("date")

    def tot(c, cond):
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0.0))
    t = v.groupBy(F.coalesce(channel, F.lit("SIN SUBCANAL")).alias("subcanal")).agg(
        tot("cantidades_total", now).alias("bultos_actual"), tot("cantidades_total", ~now).alias("bultos_previo"),
        F.count_distinct(F.when(now, F.col("id_cliente"))).alias("clientes_actual"),
        F.count_distinct(F.when(~now, F.col("id_cliente"))).alias("clientes_previo"), tot("subtotal_neto", now).alias("neto_actual"))
    t = (t.withColumn("delta_bultos", F.col("bultos_actual") - F.col("bultos_previo")).withColumn("pct_bultos", ratio("delta_bultos", "bultos_previo"))
          .withColumn("delta_clientes", F.col("clientes_actual") - F.col("clientes_previo")).withColumn("pct_clientes", ratio("delta_clientes", "clientes_previo"))
          .withColumn("bultos_cliente_actual", ratio("bultos_actual", "clientes_actual")).withColumn("bultos_cliente_previo", ratio("bultos_previo", "clientes_previo")))
    return t.withColumn("pct_bultos_cliente", ratio(F.col("bultos_cliente_actual") - F.col("bultos_cliente_previo"), "bultos_cliente_previo"))


def channel_category(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.coalesce("des_subcanal_mkt", F.lit("SIN SUBCANAL")).alias("subcanal"), "generico").agg(
        F.sum("cantidades_total").alias("bultos"), F.sum("subtotal_neto").alias("neto"))


def client_category(lines: DataFrame) -> DataFrame:
    """Client x category with positive net units."""
    return lines.groupBy("id_cliente", F.coalesce("des_subcanal_mkt", F.lit("SIN SUBCANAL")).alias("subcanal"), "generico").agg(
        F.sum("subtotal_neto").alias("neto"), F.sum("cantidades_total").alias("bultos")).filter("bultos > 0")


def penetration(cc: DataFrame, min_buyers: int = MIN_BUYERS, min_clients: int = MIN_CLIENTS) -> DataFrame:
    """Penetration of each category in each channel on the complete grid, median spend of the buyers, opportunity.

    Channels with few clients keep their rows, flagged, without a median and an opportunity.
    """
    c = cc
    base = c.groupBy("subcanal").agg(F.count_distinct("id_cliente").alias("clientes_activos")).withColumn("muestra_chica", F.col("clientes_activos") < min_clients)
    cells = c.groupBy("subcanal", "generico").agg(F.count_distinct("id_cliente").alias("compradores"), F.sum("neto").alias("neto_total"))
    cells = cells.join(quantiles(c, "neto", {"neto_mediano": 0.5}, ["subcanal", "generico"]), ["subcanal", "generico"], "left")
    g = complete_grid(base, c.select("generico").distinct()).join(cells, ["subcanal", "generico"], "left").fillna(0, subset=["compradores", "neto_total"])
    g = g.withColumn("no_compradores", F.col("clientes_activos") - F.col("compradores")).withColumn("penetracion", F.col("compradores") / F.col("clientes_activos"))
    g = g.withColumn("neto_mediano", F.when((F.col("compradores") >= min_buyers) & ~F.col("muestra_chica"), F.col("neto_mediano")))
    return g.withColumn("oportunidad", F.col("no_compradores") * F.col("neto_mediano"))


def white_space(pen: DataFrame) -> DataFrame:
    """Cells with an opportunity, ranked by money per conversion and by total opportunity (channels x categories)."""
    d = pen.filter("oportunidad > 0 and no_compradores > 0")
    return (d.withColumn("rank_conversion", F.row_number().over(W.orderBy(F.desc("neto_mediano"), "subcanal", "generico")).cast("long"))
            .withColumn("rank_oportunidad", F.rank().over(W.orderBy(F.desc("oportunidad"))).cast("long")))


def client_gaps(cc: DataFrame, pen: DataFrame, threshold: float = GAP_PENETRATION) -> DataFrame:
    """Per client the categories its channel buys and the client does not, with the estimated value."""
    cells = pen.filter((F.col("penetracion") >= threshold) & F.col("neto_mediano").isNotNull()).select("subcanal", "generico", "penetracion", F.col("neto_mediano").alias("valor_estimado"))
    per = cells.groupBy("subcanal").agg(F.collect_list(F.struct("generico", "penetracion", "valor_estimado")).alias("_c"))   # categories of a channel
    have = cc.groupBy("id_cliente", "subcanal").agg(F.collect_set("generico").alias("_g"))                                   # categories of a client
    miss = F.filter("_c", lambda x: ~F.array_contains("_g", x["generico"]))
    return have.join(per, "subcanal").select("id_cliente", "subcanal", F.inline(miss))


# -- market basket --------------------------------------------------------------------------------------------------
def baskets(lines: DataFrame, reps: DataFrame) -> DataFrame:
    """Distinct (invoice, sales force, category, brand); the force comes from the rep on the composite key."""
    r = reps.select("id_vendedor", "id_sucursal", "id_fuerza_ventas")
    inv = F.concat_ws("|", "id_sucursal", "id_documento", "letra", "serie", "nro_doc")
    return lines.join(r, ["id_vendedor", "id_sucursal"], "left").select(
        inv.alias("factura"), F.coalesce("id_fuerza_ventas", F.lit(-1)).cast("long").alias("id_fuerza_ventas"), "generico", "marca").distinct()


def basket_rules(b: DataFrame, item: str, level: str, min_support: float = BASKET_SUPPORT, min_lift: float = BASKET_LIFT,
                 min_invoices: int = MIN_INVOICES) -> DataFrame:
    """Association rules inside each sales force; forces with few invoices are flagged."""
    r = st.association_rules(b, ["id_fuerza_ventas"], "factura", item, min_support, min_lift, min_invoices)
    label = F.concat(F.lit("FV"), F.col("id_fuerza_ventas"))
    for k, v in FORCE_LABELS.items():
        label = F.when(F.col("id_fuerza_ventas") == k, F.lit(v)).otherwise(label)
    return r.withColumn("fuerza", label).withColumn("nivel", F.lit(level)).drop("id_fuerza_ventas")


# -- life cycle -----------------------------------------------------------------------------------------------------
def life_cycle(lines: DataFrame, until: str) -> DataFrame:
    """First and last sale and totals per SKU over the whole history."""
    return lines.filter(F.col("fecha_comprobante") <= F.lit(until).cast("date")).groupBy("id_articulo").agg(
        F.min("fecha_comprobante").alias("primera_venta"), F.max("fecha_comprobante").alias("ultima_venta"),
        F.sum("cantidades_total").alias("bultos_historia"), F.sum("subtotal_neto").alias("neto_historia"))


def launches(life: DataFrame, articulo: DataFrame, until: str, non_merchandise: list[str], months: int = 12) -> DataFrame:
    """SKUs whose first sale ever lies inside the window, per month alive."""
    cut = F.lit(until).cast("date")
    d = life.filter(F.col("primera_venta") > F.add_months(cut, -months)).join(articulo.select("id_articulo", "des_articulo", "generico", "marca"), "id_articulo", "left")
    d = d.filter(F.col("generico").isNotNull() & ~F.col("generico").isin(non_merchandise))
    d = d.withColumn("meses_vivo", (F.datediff(cut, "primera_venta") + 1) / MONTH_DAYS)
    return d.withColumn("bultos_por_mes", F.col("bultos_historia") / F.col("meses_vivo")).withColumn("neto_por_mes", F.col("neto_historia") / F.col("meses_vivo"))


def ramp(months: DataFrame, cohort: DataFrame, last_month: str) -> DataFrame:
    """Units per exposed SKU by months since launch; a SKU is exposed in the months its age has reached."""
    first = cohort.select("id_articulo", F.trunc("primera_venta", "MM").alias("_l"))
    m = months.join(first, "id_articulo").withColumn("mes_n", F.months_between("mes", "_l").cast("long")).filter("mes_n >= 0")
    vol = m.groupBy("mes_n").agg(F.sum("bultos").alias("bultos"), F.count_distinct("id_articulo").alias("skus_con_venta"))
    age = F.months_between(F.lit(last_month).cast("date"), "_l").cast("long")
    ages = first.groupBy(age.alias("edad")).agg(F.count(F.lit(1)).alias("_n"))          # one row per age in months
    months_ = vol.select("mes_n").withColumn("_n", F.lit(0)).unionByName(ages.select(F.col("edad").alias("mes_n"), "_n"))
    up = W.orderBy(F.desc("mes_n")).rangeBetween(W.unboundedPreceding, 0)                # one row per age: months, not SKUs
    exposed = months_.groupBy("mes_n").agg(F.sum("_n").alias("_n")).withColumn("skus_expuestos", F.sum("_n").over(up)).drop("_n")
    t = vol.join(exposed, "mes_n", "left").fillna(0, subset=["skus_expuestos"])
    return t.withColumn("bultos_por_sku", ratio("bultos", "skus_expuestos"))


