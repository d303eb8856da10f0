"""Sales reports: sums over the star, run-rate projections, fixed grids, hierarchies and period comparisons."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from retail_analytics.functions.grid import complete_grid, with_scalars
from retail_analytics.functions.joins import join_null_safe
from retail_analytics.functions.shape import grouping_sets, ratio, slug, wide
from retail_analytics.operators import filters as fl

QTY = "cantidades_total"
MEASURES = {"cantidad": QTY, "cantidad_htls": "cantidad_total_htls", "monto": "subtotal_neto", "descuentos": "descuentos"}


def summary(lines: DataFrame, keys: list, measures: tuple[str, ...] = ("cantidad", "cantidad_htls", "monto")) -> DataFrame:
    """Sums of the named measures per key (report measure -> fact column as in ``MEASURES``)."""
    return lines.groupBy(*keys).agg(*[F.sum(MEASURES[m]).alias(m) for m in measures])


def by_date(lines: DataFrame, keys: list[str], measures: tuple[str, ...] = ("cantidad", "cantidad_htls", "monto")) -> DataFrame:
    return summary(lines, [*keys, F.col("fecha_comprobante").alias("fecha")], measures)


def monthly_base(lines: DataFrame, categories: list[str] | None = None, no_quotes: list[str] | None = None,
                 splits: dict[str, list[str]] | None = None, daily: bool = False) -> DataFrame:
    """Sales by branch, category (brands split out) and route, optionally by day; quotes dropped per category."""
    df = fl.in_values(lines.filter("generico is not null"), "generico", categories)
    df = fl.drop_quotes(df, no_quotes).withColumn("generico", fl.split_brands(splits))
    keys = ["sucursal", "generico", "id_ruta"]
    return by_date(df, keys, ("cantidad",)) if daily else summary(df, keys, ("cantidad",))


def client_articles(lines: DataFrame, reps: DataFrame, articles: list[int]) -> DataFrame:
    """Client x SKU sales with a positive net, with route and invoicing rep (composite key)."""
    r = reps.select("id_vendedor", "id_sucursal", F.col("des_vendedor").alias("vendedor"))
    df = lines.filter(F.col("id_articulo").isin(articles)).join(r, ["id_vendedor", "id_sucursal"], "left")
    keys = ["sucursal", "id_ruta", "id_vendedor", "vendedor", "id_cliente", "marca", "calibre", "id_articulo", "des_articulo"]
    name = F.coalesce("fantasia", "razon_social").alias("cliente")
    return df.groupBy(*keys, name).agg(F.sum(QTY).alias("cantidad")).filter("cantidad > 0")


def history(lines: DataFrame, keys: list[str], quotes: bool = False, measures=("cantidad", "descuentos")) -> DataFrame:
    """Year x month history, without quotes or of quotes only."""
    doc = F.col("id_documento") == fl.QUOTE_DOCUMENT
    df = lines.filter(doc if quotes else ~doc)
    return summary(df, [F.year("fecha_comprobante").cast("long").alias("anio"),
                        F.month("fecha_comprobante").cast("long").alias("mes"), *keys], measures)


def rep_client(ventas_art: DataFrame, reps: DataFrame) -> DataFrame:
    """Units per rep and client; the rep join is on the composite key, ids repeat between branches."""
    r = reps.select("id_vendedor", "id_sucursal", F.col("des_vendedor").alias("vendedor"))
    return ventas_art.join(r, ["id_vendedor", "id_sucursal"]).groupBy("vendedor", "id_cliente").agg(F.sum(QTY).alias("bultos"))


def daily_article(ventas: DataFrame, article: int, branch: int) -> DataFrame:
    """Daily units of one SKU in one branch."""
    v = ventas.filter((F.col("id_articulo") == article) & (F.col("id_sucursal") == branch))
    return v.groupBy(F.col("fecha_comprobante").alias("fecha")).agg(F.sum(QTY).alias("bultos"))


def daily_articles(ventas: DataFrame) -> DataFrame:
    """Daily units of every SKU in every branch: the series that :func:`daily_article` takes one of."""
    return ventas.groupBy("id_articulo", "id_sucursal", F.col("fecha_comprobante").alias("fecha")).agg(F.sum(QTY).alias("bultos"))


def daily_report(series: DataFrame, days: DataFrame) -> DataFrame:
    """One row per calendar day with its units (blank when not positive), plus the TOTAL row with the days sold."""
    s = days.select("fecha").join(series, "fecha", "left").withColumn("bultos", F.when(F.col("bultos") > 0, F.col("bultos")))
    rows = s.select(F.date_format("fecha", "yyyy-MM-dd").alias("dia"), (F.dayofweek("fecha") == 1).alias("domingo"), "bultos",
                    F.lit(None).cast("long").alias("dias_con_venta"))
    total = s.agg(F.lit("TOTAL").alias("dia"), F.lit(False).alias("domingo"), F.coalesce(F.sum("bultos"), F.lit(0.0)).alias("bultos"),
                  F.count("bultos").alias("dias_con_venta"))
    return rows.unionByName(total)


def descriptive(lines: DataFrame, reps: DataFrame, force: int) -> DataFrame:
    """Nine-key sales pivot source; the force picks route columns and sits inside the rep join."""
    route, who = ("id_ruta", "des_personal_fv1") if force == 1 else ("id_ruta_fv4", "des_personal_fv4")
    r = reps.filter(F.col("id_fuerza_ventas") == force).select("id_vendedor", "id_sucursal", F.col("des_vendedor").alias("vendedor"))
    j = lines.filter(~F.col("anulado")).join(r, ["id_vendedor", "id_sucursal"], "left")
    return j.groupBy(F.concat("id_sucursal", F.lit(" - "), "sucursal").alias("sucursal"), F.col("fecha_comprobante").alias("fecha"),
                     "vendedor", F.col(route).alias("ruta"), F.col(who).alias("des_ruta"), "marca", "generico", "id_articulo",
                     "des_articulo").agg(F.sum(QTY).alias("cantidad"))


def client_history(lines: DataFrame, clients: DataFrame, by_brand: bool = False, brands: list[str] | None = None,
                   articles: list[int] | None = None, charged_only: bool = False) -> DataFrame:
    """Monthly history of a client list (composite keys); the row is the brand or 'id - SKU'."""
    df = lines.join(clients.select("id_cliente", "id_sucursal"), ["id_cliente", "id_sucursal"], "left_semi")
    if not by_brand:
        df = fl.in_values(fl.in_values(df, "marca", brands), "id_articulo", articles)
    key = F.col("marca") if by_brand or brands is not None else F.concat("id_articulo", F.lit(" - "), "des_articulo")
    qty = "cantidades_con_cargo" if charged_only else QTY
    return df.groupBy("id_cliente", "id_sucursal", fl.client_name().alias("nombre_cliente"), "generico", key.alias("row_key"),
                      F.date_format("fecha_comprobante", "yyyy-MM").alias("mes")).agg(F.sum(qty).alias("bultos"))


def brand_universe(articulo: DataFrame, categories: list[str]) -> DataFrame:
    return articulo.filter(F.col("generico").isin(categories) & F.col("marca").isNotNull() & (F.col("marca") != "")) \
                   .select("generico", "marca").distinct()


def grouped_history(sales: DataFrame, months: list[str], universe: DataFrame | None = None) -> DataFrame:
    """Category blocks with brands, subtotals and TOTAL GENERAL; brands never bought show zeros.

    ``orden`` gives the reading order: categories by total, brands by total inside, subtotal last, grand total at
    the end.  Year totals appear when the months span several years.
    """
    s = sales.select("generico", F.col("row_key").alias("marca"), "mes", "bultos").filter(F.col("mes").isin(months))
    if universe is not None:
        s = s.unionByName(universe.select("generico", "marca", F.lit(None).cast("string").alias("mes"), F.lit(0.0).alias("bultos")))
    g = grouping_sets(s, {"marca": ["generico", "marca", "mes"], "generico": ["generico", "mes"], "general": ["mes"]},
                      [F.sum("bultos").alias("bultos")])
    w = wide(g, ["nivel", "generico", "marca"], "mes", months, {"m": "bultos"})
    cols = {m: F.col(f"m_{slug(m)}") for m in months}
    w = w.withColumn("total", reduce(lambda a, b: a + b, cols.values()))
    years = sorted({m[:4] for m in months})
    if len(years) > 1:
        for y in years:
            w = w.withColumn(f"total_{y}", reduce(lambda a, b: a + b, [c for m, c in cols.items() if m[:4] == y]))
    # report grain (categories x brands): the ordering window sees dimension rows only
    block = F.max(F.when(F.col("nivel") == "generico", F.col("total"))).over(W.partitionBy("generico"))
    order = W.orderBy((F.col("nivel") == "general").asc(), F.col("_b").desc(), "generico", (F.col("nivel") == "generico").asc(),
                      F.col("total").desc(), "marca")
    return w.withColumn("_b", block).withColumn("orden", F.row_number().over(order).cast("long")).drop("_b")


def quarterly(lines: DataFrame, categories: list[str]) -> DataFrame:
    """Sales by branch, category and quarter."""
    return summary(fl.in_values(lines, "generico", categories), [
        "sucursal", "generico", F.year("fecha_comprobante").cast("long").alias("anio"),
        F.quarter("fecha_comprobante").cast("long").alias("trimestre")], ("cantidad",))


def quarter_dashboard(q: DataFrame, year: int, quarter: int, category: str, multi: list[str]) -> DataFrame:
    """Per branch: quarter total, share of a category and of a group, same quarter last year and its change."""
    cur = (F.col("anio") == year) & (F.col("trimestre") == quarter)
    prev = (F.col("anio") == year - 1) & (F.col("trimestre") == quarter)

    def tot(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("cantidad"))), F.lit(0.0))

    t = q.groupBy("sucursal").agg(tot(cur).alias("total"), tot(cur & (F.col("generico") == category)).alias("_c"),
                                  tot(cur & F.col("generico").isin(multi)).alias("_m"), tot(prev).alias("anio_anterior"))
    return t.select("sucursal", "total", ratio("_c", "total").alias("pct_categoria"), ratio("_m", "total").alias("pct_multi"),
                    "anio_anterior", ratio(F.col("total") - F.col("anio_anterior"), "anio_anterior").alias("variacion")) \
            .orderBy(F.desc("total"), "sucursal")


def sub_distributors(lines: DataFrame, route: int) -> DataFrame:
    """Sales of the route of sub-distributors along the client and article hierarchy."""
    return lines.filter(F.col("id_ruta") == route).groupBy(
        "id_cliente", F.coalesce("fantasia", F.lit("")).alias("fantasia"), F.coalesce("razon_social", F.lit("")).alias("razon_social"),
        "generico", "marca", "des_articulo").agg(F.sum(QTY).alias("cantidad"))


def sub_distributor_origin(lines: DataFrame, categories: list[str], hq_list: int, inland_list: int, branches: list[str],
                           hq_label: str) -> DataFrame:
    """Sales of two price lists: one is the headquarters, the other counts for the named branches only."""
    inland = (F.col("id_lista_precio") == inland_list) & (F.col("sucursal").isin(branches) if branches else F.lit(False))
    df = lines.filter(F.col("generico").isin(categories) if categories else F.lit(False))
    df = df.filter((F.col("id_lista_precio") == hq_list) | inland)
    origin = F.when(F.col("id_lista_precio") == hq_list, hq_label).otherwise(F.col("sucursal"))
    return df.groupBy(origin.alias("origen"), "razon_social", "fantasia", "generico", "marca").agg(
        F.sum(QTY).alias("bultos"), F.sum("cantidad_total_htls").alias("htls"))


def hierarchy_totals(df: DataFrame, levels: list[str], measure: str) -> DataFrame:
    """Totals at every prefix of the hierarchy, labelled by the last level of the prefix."""
    sets = {lv: levels[:i + 1] for i, lv in enumerate(levels)}
    return grouping_sets(df, sets, [F.sum(measure).alias(measure)])


def complete(df: DataFrame, first: DataFrame, second: DataFrame, fill: list[str]) -> DataFrame:
    """All combinations of two dimensions with zeros where there is no data."""
    g = complete_grid(first, second)
    return join_null_safe(g, df, g.columns).fillna(0, subset=fill)


def quota_in_unit(quota: Column, sold_unit: Column, sold_units: Column, is_units: bool) -> Column:
    """Quota loaded in units, converted by the sold mix; NULL when nothing was sold."""
    if is_units:
        return quota
    return F.when(sold_units > 0, quota * sold_unit / sold_units)


def daily_matrix(daily: DataFrame, branches: DataFrame, articles: DataFrame, days: list[str], factor: DataFrame,
                 measure: str = "cantidad", quota: DataFrame | None = None, cov_cat: DataFrame | None = None,
                 cov_brand: DataFrame | None = None, cov_quota: DataFrame | None = None, last_year: DataFrame | None = None) -> DataFrame:
    """Daily matrix: complete branch x (category, brand) grid, one column per day, brand and category totals.

    Category figures stand only in the first row of the category (highest amount, brand as tie-break).
    ``quota``/``cov_quota`` are (sucursal, concepto, cupo) whose concept is a category or a brand; ``cov_*`` carry
    ``cobertura``; ``last_year`` carries ``mmaa`` per (sucursal, generico, marca).
    """
    keys, cat = ["sucursal", "generico", "marca"], ["sucursal", "generico"]
    m = F.col(measure)
    sold = daily.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("fecha") == F.lit(d).cast("date"), m)), F.lit(0.0)).alias(f"d_{slug(d)}") for d in days],
        F.sum(m).alias("total_marca"), F.sum("cantidad").alias("_bultos"), F.sum("monto").alias("monto_marca"),
        F.sum("descuentos").alias("desc_marca"))
    g = complete_grid(branches.select("sucursal"), articles.select("generico", "marca"))
    t = join_null_safe(g, sold, keys).fillna(0, subset=[c for c in sold.columns if c not in keys])
    t = with_scalars(t, factor.select("factor")).withColumn("tend_marca", F.col("total_marca") * F.col("factor"))
    c = W.partitionBy(*cat)                                # a category of one branch: its brands
    for out, src in (("cant_generico", "total_marca"), ("_bultos_g", "_bultos"), ("monto_generico", "monto_marca"), ("desc_generico", "desc_marca")):
        t = t.withColumn(out, F.sum(src).over(c))
    t = t.withColumn("orden", F.row_number().over(c.orderBy(F.col("monto_marca").desc(), "marca")).cast("long"))
    t = t.withColumn("tend_generico", F.col("cant_generico") * F.col("factor"))

    def look(df, table, key, value, name):
        if table is None:
            return df.withColumn(name, F.lit(None).cast("double"))
        r = table.select("sucursal", F.col(key[0]).alias(key[1]), F.col(value).cast("double").alias(name))
        return df.join(r, ["sucursal", key[1]], "left")

    pos = quota.filter("cupo > 0") if quota is not None else None
    cpos = cov_quota.filter("cupo > 0") if cov_quota is not None else None
    t = look(t, pos, ("concepto", "generico"), "cupo", "_qg")
    t = look(t, pos, ("concepto", "marca"), "cupo", "_qm")
    t = look(t, cpos, ("concepto", "generico"), "cupo", "cupo_cob_generico")
    t = look(t, cpos, ("concepto", "marca"), "cupo", "cupo_cob_marca")
    t = look(t, cov_cat, ("generico", "generico"), "cobertura", "cob_generico")
    t = look(t, cov_brand, ("marca", "marca"), "cobertura", "cob_marca")
    if last_year is not None:
        t = t.join(last_year.filter("mmaa > 0").select(*keys, "mmaa"), keys, "left")
    else:
        t = t.withColumn("mmaa", F.lit(None).cast("double"))
    units = measure == "cantidad"
    t = t.withColumn("cupo_generico", quota_in_unit(F.col("_qg"), F.col("cant_generico"), F.col("_bultos_g"), units)) \
         .withColumn("cupo_marca", quota_in_unit(F.col("_qm"), F.col("total_marca"), F.col("_bultos"), units))
    t = (t.withColumn("tend_vs_cupo_generico", ratio("tend_generico", "cupo_generico"))
         .withColumn("cob_vs_cupo_generico", ratio("cob_generico", "cupo_cob_generico"))
         .withColumn("desc_pct_generico", ratio(F.nullif("desc_generico", F.lit(0.0)), "monto_generico"))
         .withColumn("tend_vs_cupo_marca", ratio("tend_marca", "cupo_marca")).withColumn("var_mmaa", ratio("total_marca", "mmaa"))
         .withColumn("cob_vs_cupo_marca", ratio("cob_marca", "cupo_cob_marca"))
         .withColumn("desc_pct_marca", ratio(F.nullif("desc_marca", F.lit(0.0)), "monto_marca")))
    first = ["cant_generico", "tend_generico", "monto_generico", "desc_generico", "desc_pct_generico", "cob_generico",
             "cupo_cob_generico", "cob_vs_cupo_generico", "cupo_generico", "tend_vs_cupo_generico"]
    for name in first:
        t = t.withColumn(name, F.when(F.col("orden") == 1, F.col(name)))
    return t.drop("factor", "_bultos", "_bultos_g", "_qg", "_qm")


def compact(sales: DataFrame, factor: DataFrame) -> DataFrame:
    """Brand rows with trend; category totals only in the first row of the category."""
    c = W.partitionBy("sucursal", "generico")
    t = with_scalars(sales, factor.select("factor")).withColumn("tend_marca", F.col("cantidad") * F.col("factor"))
    t = t.withColumn("orden", F.row_number().over(c.orderBy(F.col("monto").desc(), "marca")).cast("long"))
    one = F.col("orden") == 1
    return (t.withColumn("cant_generico", F.when(one, F.sum("cantidad").over(c)))
            .withColumn("tend_generico", F.when(one, F.sum("cantidad").over(c) * F.col("factor")))
            .withColumn("monto_generico", F.when(one, F.sum("monto").over(c))).drop("factor", "cantidad_htls"))


def quotas(cupos: DataFrame, period: str, provider: str | None = None) -> DataFrame:
    """Quota by branch (prefix stripped), route and category."""
    q = cupos.filter(F.col("periodo") == period)
    if provider:
        q = q.filter(F.col("proveedor") == provider)
    return q.groupBy(F.regexp_replace("sucursal", r"^\d+ - ", "").alias("sucursal"), "id_ruta", "generico").agg(F.sum("cupo").alias("cupo"))


def monthly_summary(lines: DataFrame, windows: dict[str, tuple[str, str]], quota: DataFrame | None, factor: DataFrame) -> DataFrame:
    """Branch x category: two days, total, trend, last year, last month, target and attainment on the full grid.

    ``windows`` maps n1, n2, mes, ma, aa to date ranges; one pass of conditional sums replaces a join per period.
    """
    f = F.col("fecha_comprobante")
    names = {"vtas_n1": "n1", "vtas_n2": "n2", "total_ventas": "mes", "mmaa": "aa", "ma": "ma"}
    inside = {n: f.between(F.lit(a).cast("date"), F.lit(b).cast("date")) for n, (a, b) in windows.items()}
    df = lines.filter(reduce(lambda a, b: a | b, inside.values()))
    t = df.groupBy("sucursal", "generico").agg(*[
        F.coalesce(F.sum(F.when(inside[w], F.col(QTY))), F.lit(0.0)).alias(n) for n, w in names.items()])
    g = complete_grid(t.select("sucursal").distinct(), t.filter("generico is not null").select("generico").distinct())
    t = join_null_safe(g, t, ["sucursal", "generico"]).fillna(0, subset=list(names))
    t = with_scalars(t, factor.select("factor")).withColumn("tendencia", F.col("total_ventas") * F.col("factor")).drop("factor")
    if quota is None:
        return t.withColumn("objetivo", F.lit(None).cast("double")).withColumn("tend_vs_obj", F.lit(None).cast("double"))
    t = t.join(quota.select("sucursal", "generico", F.col("cupo").alias("objetivo")), ["sucursal", "generico"], "left")
    return t.withColumn("tend_vs_obj", F.when(F.col("objetivo") > 0, F.col("tendencia") / F.col("objetivo")))


def sheet_with_subtotals(df: DataFrame, hq_family: list[str], direct: str, measures: list[str]) -> DataFrame:
    """Ordered sheet per category: headquarters family, its subtotal, branches, subtotal without direct, direct, total."""
    part = F.when(F.col("sucursal").isin(hq_family), 1).when(F.col("sucursal") == direct, 3).otherwise(2)
    d = df.withColumn("_p", part)
    sums = [F.sum(m).alias(m) for m in measures]
    rows = d.withColumn("orden", F.when(F.col("_p") == 1, F.array_position(F.array(*[F.lit(x) for x in hq_family]), F.col("sucursal")))
                        .when(F.col("_p") == 2, 200).otherwise(400).cast("long")).drop("_p")
    subs = []
    for label, cond, pos in (("SUBTOTAL CASA CENTRAL", F.col("_p") == 1, 100), ("SUCURSALES SIN DIRECTA", F.col("_p") == 2, 300),
                             ("TOTAL SIN SMK", F.lit(True), 500)):
        subs.append(d.filter(cond).groupBy("generico").agg(*sums).withColumn("sucursal", F.lit(label)).withColumn("orden", F.lit(pos).cast("long")))
    return reduce(lambda a, b: a.unionByName(b), [rows, *subs])


HQ_GROUP = "CASA CENTRAL"


def summary_view(lines: DataFrame, cupos: DataFrame, calendar: DataFrame, as_of: str, zones: list[fl.Zone], hq: str,
                 direct_route: int, no_quotes: list[str], zone_labels: list[str], direct: str = "DIRECTA SUCURSALES") -> DataFrame:
    """Monthly summary as a derived table, one row per month, branch, category, brand and measure.

    Last and second-last working day with sales, total, trend, last year, last month and the target, which stands
    on one brand row only so that sums over brands stay right.  ``calendar`` is (mes, dias_totales,
    dias_transcurridos) with the holidays of ``cal.days``; ``lines`` carry ``habil``.
    """
    place = fl.zone_name([*zones])
    name = F.when((F.col("id_ruta") == direct_route) & (F.col("sucursal") != hq), F.lit(direct)).otherwise(place)
    base = fl.drop_quotes(lines.filter("generico is not null and sucursal is not null"), no_quotes).select(
        F.trunc("fecha_comprobante", "MM").alias("periodo"), name.alias("sucursal"), "generico", "marca",
        F.col("fecha_comprobante").alias("fecha"), "habil", F.col(QTY).alias("q"), F.col("cantidad_total_htls").alias("h"))
    keys = ["periodo", "sucursal", "generico", "marca"]
    cap = F.least(F.lit(as_of).cast("date"), F.last_day("periodo"))
    daily = base.groupBy(*keys, "fecha", "habil").agg(F.sum("q").alias("q"), F.sum("h").alias("h"))
    rank = F.row_number().over(W.partitionBy(*keys, F.col("_work")).orderBy(F.desc("fecha")))   # at most 31 days
    daily = daily.withColumn("_work", F.col("habil") & (F.col("fecha") <= cap)).withColumn("_r", rank)

    def day(n: int, c: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_work") & (F.col("_r") == n), F.col(c))), F.lit(0.0))

    agg = daily.groupBy(*keys).agg(F.sum("q").alias("total_q"), F.sum("h").alias("total_h"), day(1, "q").alias("n1_q"), day(1, "h").alias("n1_h"),
                                   day(2, "q").alias("n2_q"), day(2, "h").alias("n2_h"))

    # every month row also stands for the next month and the same month of the next year: one more sum, no self join
    own = ["total_q", "total_h", "n1_q", "n1_h", "n2_q", "n2_h"]
    moved = agg.withColumn("_k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(12)))).withColumn("periodo", F.add_months("periodo", F.col("_k")))

    def at(k: int, c: str) -> Column:
        return F.sum(F.when(F.col("_k") == k, F.col(c)))

    agg = (moved.groupBy(*keys).agg(*[at(0, c).alias(c) for c in own], *[at(k, f"total_{x}").alias(f"{tag}_{x}") for k, tag in ((12, "aa"), (1, "ma")) for x in "qh"],
                                    F.count_if(F.col("_k") == 0).alias("_own")).filter("_own > 0").drop("_own"))
    branch = F.regexp_replace("sucursal", r"^\d+ - ", "")
    q = cupos.filter("generico is not null").withColumn("sucursal", branch)
    q = q.withColumn("sucursal", F.when((F.col("id_ruta") == direct_route) & (F.col("sucursal") != hq), F.lit(direct))
                     .otherwise(fl.zone_name([*zones])))
    q = q.groupBy(F.to_date(F.concat("periodo", F.lit("-01"))).alias("periodo"), "sucursal", "generico").agg(F.sum("cupo").alias("objetivo"))
    t = (agg.join(q, ["periodo", "sucursal", "generico"], "left")
         .join(calendar.withColumnRenamed("mes", "periodo"), "periodo"))
    c = W.partitionBy("periodo", "sucursal", "generico")
    mix = ratio(F.sum("total_h").over(c), F.sum("total_q").over(c))
    t = t.withColumn("_oh", F.col("objetivo") * mix)
    cols = ["vtas_n1", "vtas_n2", "total_ventas", "mmaa", "ma", "objetivo_full"]

    def pack(label: str, x: str, goal: str) -> Column:
        src = [f"n1_{x}", f"n2_{x}", f"total_{x}", f"aa_{x}", f"ma_{x}", goal]
        return F.struct(F.lit(label).alias("medida"), *[F.col(a).alias(b) for a, b in zip(src, cols)])

    t = t.withColumn("_m", F.explode(F.array(pack("BULTOS", "q", "objetivo"), pack("HTLS", "h", "_oh"))))
    t = t.select(*keys, "dias_totales", "dias_transcurridos", "_m.*")
    t = t.withColumn("tendencia", F.col("total_ventas") * F.try_divide(F.col("dias_totales").cast("double"), F.nullif("dias_transcurridos", F.lit(0))))
    c = W.partitionBy("periodo", "sucursal", "generico", "medida")
    first = F.row_number().over(c.orderBy(F.col("marca").asc_nulls_last())) == 1
    group = F.when(F.col("sucursal").isin([hq, *zone_labels]), HQ_GROUP).when(F.col("sucursal") == direct, "DIRECTA").otherwise("INTERIOR")
    return t.select(F.date_format("periodo", "yyyy-MM").alias("periodo"), "sucursal", group.alias("grupo"), "generico", "marca", "medida",
                    "vtas_n1", "vtas_n2", "total_ventas", "tendencia", "mmaa", "ma", F.when(first, F.col("objetivo_full")).alias("objetivo"),
                    F.when(first, ratio(F.sum("tendencia").over(c), "objetivo_full")).alias("tend_vs_obj"))


def view_metric(view: DataFrame, keys: list[str]) -> DataFrame:
    """Attainment at any grouping as a ratio of sums."""
    return view.groupBy(*keys).agg(F.sum("total_ventas").alias("total_ventas"), F.sum("tendencia").alias("tendencia"),
                                   F.sum("objetivo").alias("objetivo"), F.sum("mmaa").alias("mmaa"), F.sum("ma").alias("ma")) \
        .withColumn("pct_objetivo", ratio("tendencia", "objetivo")).withColumn("var_mmaa", ratio("tendencia", "mmaa")) \
        .withColumn("var_ma", ratio("tendencia", "ma"))


def discounts(lines: DataFrame, routes: list[int], zone: str, hq: int, labels: DataFrame) -> DataFrame:
    """Amount before discount and discount by branch (zone cut out), category, brand and price list label."""
    place = F.when((F.col("id_sucursal") == hq) & F.col("id_ruta").isin(routes), F.lit(zone)) \
             .otherwise(F.concat("id_sucursal", F.lit(" - "), "sucursal"))
    df = fl.map_label(lines, labels, "id_lista_precio", "lista_precio")
    return df.groupBy(place.alias("lugar"), "generico", "marca", "lista_precio").agg(
        F.sum(F.col("subtotal_neto") + F.col("descuentos")).alias("importe_sin_desc"), F.sum("descuentos").alias("bonificacion_pesos"))


def rejections(lines: DataFrame, keys: list[str], only_sold: bool = True) -> DataFrame:
    """Sold = sum of the positive quantities, rejected = absolute sum of the negative ones, and the rate."""
    q = F.col(QTY)
    t = lines.groupBy(*keys).agg(F.sum(F.when(q > 0, q).otherwise(0.0)).alias("vendidos"),
                                 F.abs(F.sum(F.when(q < 0, q).otherwise(0.0))).alias("rechazados"))
    t = t.filter("vendidos > 0") if only_sold else t
    return t.withColumn("pct_rechazo", ratio("rechazados", "vendidos", 0))


def rejection_rollup(by_rep: DataFrame, boss: str) -> DataFrame:
    """Rejections per supervisor and an overall row, rates from the sums."""
    t = grouping_sets(by_rep, {"supervisor": ["supervisor"], "total": []}, [F.sum("vendidos").alias("vendidos"), F.sum("rechazados").alias("rechazados")])
    name = F.when(F.col("nivel") == "total", F.lit(boss)).otherwise(F.col("supervisor"))
    return t.withColumn("supervisor", name).drop("nivel").withColumn("pct_rechazo", ratio("rechazados", "vendidos", 0))


def rejection_pivot(by_category: DataFrame, row: str, groups: dict[str, list[str]]) -> DataFrame:
    """Sold, rejected and rate per category group side by side."""
    g = fl.first_rule([(F.col("generico").isin(v), k) for k, v in groups.items()])
    w = wide(by_category.withColumn("_g", g), [row], "_g", list(groups), {"vendidos": "vendidos", "rechazados": "rechazados"})
    for k in groups:
        w = w.withColumn(f"pct_{slug(k)}", ratio(f"rechazados_{slug(k)}", f"vendidos_{slug(k)}", 0))
    return w


def reference_block(grid: DataFrame, values: DataFrame, concept: str) -> DataFrame:
    """Fixed branch x concept grid with its value, the zone total and the share of it (0 in an empty zone).

    ``grid`` is (sucursal, zona, concept), ``values`` (sucursal, concept, valor).
    """
    t = grid.join(values.select("sucursal", concept, "valor"), ["sucursal", concept], "left").fillna(0, subset=["valor"])
    tot = t.groupBy("zona", concept).agg(F.sum("valor").alias("total_zona"))
    return join_null_safe(t, tot, ["zona", concept]).withColumn("participacion", ratio("valor", "total_zona", 0))


def wholesale_split(grid: DataFrame, sales: DataFrame, lists: list[str]) -> DataFrame:
    """Wholesale share of the zone, of the branch, and the branch's share of its zone's wholesale volume."""
    v = sales.groupBy("sucursal", "generico").agg(F.sum("cantidad").alias("volumen_sucursal"),
                                                  F.sum(F.when(F.col("lista_precio").isin(lists), F.col("cantidad")).otherwise(0.0)).alias("mayorista_sucursal"))
    t = grid.join(v, ["sucursal", "generico"], "left").fillna(0, subset=["volumen_sucursal", "mayorista_sucursal"])
    z = t.groupBy("zona", "generico").agg(F.sum("volumen_sucursal").alias("volumen_zona"), F.sum("mayorista_sucursal").alias("mayorista_zona"))
    t = join_null_safe(t, z, ["zona", "generico"])
    return (t.withColumn("pct_mayo_zona", ratio("mayorista_zona", "volumen_zona", 0))
            .withColumn("pct_participacion", ratio("mayorista_sucursal", "mayorista_zona", 0))
            .withColumn("pct_mayo_sucursal", ratio("mayorista_sucursal", "volumen_sucursal", 0)))


OPERATORS = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b,
             "==": lambda a, b: a == b, "!=": lambda a, b: a != b}


def condition(text: str, value: Column) -> Column:
    """'>= 0.25' as a predicate; only the listed operators exist."""
    t = text.strip()
    for op in (">=", "<=", "==", "!=", ">", "<"):
        if t.startswith(op):
            return OPERATORS[op](value, F.lit(float(t[len(op):])))
    raise ValueError(f"unknown rule {text!r}")


def compliance(sales: DataFrame, ident: list[str], brands: list[str], rule: str | dict) -> DataFrame:
    """Brand totals per client and the flag by rule: '>= x' on the total, 'todas_marcas >= x' on every brand, or
    {'grupo': {'calibres': [...], 'criterio': '>= x'}} where one size group is enough."""
    groups = rule if isinstance(rule, dict) else {}
    extra = [F.sum(F.when(F.col("calibre").isin(g["calibres"]), F.col("cantidad"))).alias(f"g_{slug(n)}") for n, g in groups.items()]
    present = [F.max(F.col("calibre").isin(g["calibres"])).alias(f"p_{slug(n)}") for n, g in groups.items()]
    tot = [F.coalesce(F.sum(F.when(F.col("marca") == b, F.col("cantidad"))), F.lit(0.0)).alias(f"m_{slug(b)}") for b in brands]
    t = sales.groupBy(*ident).agg(*tot, *extra)
    cols = [F.col(f"m_{slug(b)}") for b in brands]
    if groups:
        t = with_scalars(t, sales.agg(*present))   # a group nobody sold decides nothing
        hit = reduce(lambda a, b: a | b, [F.col(f"p_{slug(n)}") & condition(g["criterio"], F.coalesce(f"g_{slug(n)}", F.lit(0.0)))
                                          for n, g in groups.items()])
    elif rule.strip().startswith("todas_marcas"):
        hit = reduce(lambda a, b: a & b, [condition(rule.replace("todas_marcas", ""), c) for c in cols])
    else:
        hit = condition(rule, reduce(lambda a, b: a + b, cols))
    return t.select(*ident, *cols, hit.cast("long").alias("cumple"))


def year_grid(df: DataFrame, dim: list[str], value: str) -> DataFrame:
    """Year x dimension rows with the twelve months, zero filled."""
    return wide(df, ["anio", *dim], "mes", list(range(1, 13)), {"m": value})


def converted_year(sales: DataFrame, factors: DataFrame, year: int) -> DataFrame:
    """Units, converted units (factor per SKU, before the sum) and coverage per month and over the year."""
    s = sales.filter(F.col("mes").startswith(str(year))).join(factors, "id_articulo", "left")
    s = s.withColumn("_kg", F.col("bultos") * F.coalesce("factor", F.lit(0.0))).withColumn("mes", F.explode(F.array("mes", F.lit("TOTAL"))))
    net = s.groupBy("mes", "id_sucursal", "id_cliente").agg(F.sum("bultos").alias("bultos"), F.sum("_kg").alias("kg"))
    return net.groupBy("mes").agg(F.sum("bultos").alias("bultos"), F.sum("kg").alias("kg"), F.count_if(F.col("bultos") > 0).alias("coberturas"))


def route_grid(cliente: DataFrame, branch: int, categories: DataFrame) -> DataFrame:
    """Routes of a branch x categories."""
    r = cliente.filter(~F.col("anulado") & (F.col("id_sucursal") == branch) & F.col("id_ruta_fv1").isNotNull()).select(
        F.col("id_ruta_fv1").alias("ruta"), F.col("des_personal_fv1").alias("preventista")).distinct()
    return complete_grid(r, categories)


def period_columns(lines: DataFrame, windows: dict[str, tuple[str, str]], keys: list[str]) -> DataFrame:
    """Units and bonus units (quantity x rate / 100, positive rates) per period side by side, in one scan."""
    f, q = F.col("fecha_comprobante"), F.col(QTY)
    inside = {n: f.between(F.lit(a).cast("date"), F.lit(b).cast("date")) for n, (a, b) in windows.items()}
    df = lines.filter(reduce(lambda a, b: a | b, inside.values()))
    bonus = F.when(F.col("bonificacion") > 0, q * F.col("bonificacion") / 100.0)
    aggs = []
    for n, c in inside.items():
        aggs += [F.coalesce(F.sum(F.when(c, q)), F.lit(0.0)).alias(f"bultos_{n}"), F.coalesce(F.sum(F.when(c, bonus)), F.lit(0.0)).alias(f"bonif_{n}")]
    return df.groupBy(*keys).agg(*aggs)


def period_totals(clients: DataFrame, windows: list[str]) -> DataFrame:
    """Totals and clients with units per period."""
    parts = [F.struct(F.lit(n).alias("periodo"), F.col(f"bultos_{n}").alias("bultos"), F.col(f"bonif_{n}").alias("bonif")) for n in windows]
    return clients.select(F.inline(F.array(*parts))).groupBy("periodo").agg(
        F.sum("bultos").alias("bultos"), F.sum("bonif").alias("bonif"), F.count_if(F.col("bultos") != 0).alias("clientes"))


def article_list_years(ventas: DataFrame, articles: list[int]) -> DataFrame:
    """Volume and coverage of an SKU list by year and month, and per year counted again (mes NULL)."""
    v = ventas.filter(F.col("id_articulo").isin(articles))
    fine = v.groupBy(F.year("fecha_comprobante").cast("long").alias("anio"), F.month("fecha_comprobante").cast("long").alias("mes"),
                     "id_sucursal", "id_cliente").agg(F.sum(QTY).alias("b"))
    net = grouping_sets(fine, {"mes": ["anio", "mes"], "anio": ["anio"]}, [F.sum("b").alias("b")], ["id_sucursal", "id_cliente"])
    return net.groupBy("nivel", "anio", "mes").agg(F.sum("b").alias("cantidad"), F.count_if(F.col("b") > 0).alias("clientes"))
