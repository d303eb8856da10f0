"""Stock: snapshots, cover, stock-outs, valuation, dead stock and supplier-code matching."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from retail_analytics.functions.grid import with_scalars
from retail_analytics.functions.joins import join_catalogue
from retail_analytics.functions.ordered import running
from retail_analytics.functions.shape import grouping_sets, ratio, slug, wide

# -- fixed values ---------------------------------------------------------------------------------------------
COVER_OUT_DAYS, COVER_OVER_DAYS, DEAD_STOCK_DAYS = 7, 90, 90
ORDER_DAYS, RED_DAYS, AMBER_DAYS = 15, 15, 30
ABC_CUTS, EPS = (0.80, 0.95), 1e-9
UNCLASSIFIED, NO_BRAND = "SIN CLASIFICAR", "SIN MARCA"
# -------------------------------------------------------------------------------------------------------------


def latest(stock: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rows of the newest snapshot (not after ``as_of``)."""
    s = stock.filter(F.col("date_stock") <= F.lit(as_of).cast("date")) if as_of else stock
    return s.filter(F.col("date_stock") == s.agg(F.max("date_stock").alias("d")).scalar())


def snapshot(stock: DataFrame, articulo: DataFrame, deposito: DataFrame, date: str | None = None) -> DataFrame:
    """Stock of one day by SKU x branch, depots added up."""
    s = stock.filter(F.col("date_stock") == F.lit(date).cast("date")) if date else latest(stock)
    s = (s.join(deposito.select("id_deposito", F.col("des_sucursal").alias("sucursal")), "id_deposito")
         .groupBy("id_articulo", "sucursal").agg(F.sum("cant_bultos").alias("cant_bultos"), F.sum("cantidad_total_htls").alias("cant_htls")))
    return join_catalogue(s, articulo.select("id_articulo", "des_articulo", "generico", "marca"), "id_articulo")


def month_sales(ventas: DataFrame, sucursal: DataFrame, desde: str, hasta: str) -> DataFrame:
    """Sales by branch x SKU in the half-open window [desde, hasta)."""
    f = F.col("fecha_comprobante")
    v = ventas.filter((f >= F.lit(desde).cast("date")) & (f < F.lit(hasta).cast("date")))
    v = v.groupBy("id_sucursal", "id_articulo").agg(F.sum("cantidades_total").alias("venta_bultos"),
                                                    F.sum("cantidad_total_htls").alias("venta_htls"))
    return v.join(sucursal.select("id_sucursal", F.col("descripcion").alias("sucursal")), "id_sucursal", "left")


def matrix(snap: DataFrame, branches: list[str], value: str = "cant_bultos") -> DataFrame:
    """SKU x branch matrix, every branch a column, NULL attributes kept."""
    return wide(snap, ["generico", "marca", "des_articulo"], "sucursal", branches, {"s": value})


def _excluded(names: list[str]):
    return F.upper(F.trim("generico")).isin([n.strip().upper() for n in names])


def stock_universe(snap: DataFrame, sales: DataFrame, excluded: list[str] | None = None) -> DataFrame:
    """Pairs with stock or sales and their state: quiebre, dormant or normal."""
    s = snap.filter(F.coalesce(~_excluded(excluded), F.lit(True))) if excluded else snap
    v = sales.select("sucursal", "id_articulo", "venta_bultos", "venta_htls")
    j = s.withColumnsRenamed({"cant_bultos": "stock_bultos", "cant_htls": "stock_htls"}).join(v, ["sucursal", "id_articulo"], "left")
    j = j.fillna(0, subset=["stock_bultos", "stock_htls", "venta_bultos", "venta_htls"])
    j = j.filter((F.col("stock_bultos") != 0) | (F.col("venta_bultos") != 0))
    state = F.when((F.col("stock_bultos") <= 0) & (F.col("venta_bultos") != 0), "quiebre") \
             .when((F.col("stock_bultos") > 0) & (F.col("venta_bultos") <= 0), "dormant").otherwise("normal")
    return j.withColumn("estado", state)


def unmatched_sales(snap: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales rows without a stock row, and those of an unknown branch."""
    lost = sales.join(snap.select("sucursal", "id_articulo"), ["sucursal", "id_articulo"], "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("sin_stock"), F.count_if(F.col("sucursal").isNull()).alias("sin_sucursal"))


def with_order_and_reach(df: DataFrame, days_sold: int, days_stock: int = ORDER_DAYS) -> DataFrame:
    """Suggested order max(v/d*k - stock, 0) and reach stock/(v/d)."""
    rate = F.col("venta") / F.lit(float(days_sold))
    return (df.withColumn("pedido", F.greatest(rate * days_stock - F.col("stock"), F.lit(0.0)))
            .withColumn("alcance", ratio(F.col("stock"), rate)))


def wide_sheet(universe: DataFrame, branches: list[str], days_sold: int, days_stock: int = ORDER_DAYS) -> DataFrame:
    """One row per SKU: stock, sales, order and reach per branch and in total."""
    keys = ["id_articulo", "des_articulo", "generico", "marca"]
    u = universe.select("id_articulo", *[F.coalesce(c, F.lit("")).alias(c) for c in keys[1:]], "sucursal",
                        F.col("stock_bultos").alias("stock"), F.col("venta_bultos").alias("venta"))
    t = grouping_sets(u, {"suc": [*keys, "sucursal"], "total": keys}, [F.sum("stock").alias("stock"), F.sum("venta").alias("venta")])
    t = with_order_and_reach(t.withColumn("sucursal", F.coalesce("sucursal", F.lit("total"))), days_sold, days_stock)
    w = wide(t, keys, "sucursal", [*branches, "total"], {"stock": "stock", "venta": "venta", "pedido": "pedido"})
    r = wide(t, ["id_articulo"], "sucursal", [*branches, "total"], {"alcance": "alcance"}, fill=None)
    return w.join(r, "id_articulo")


def stock_out_view(stock: DataFrame, deposito: DataFrame, ventas: DataFrame, articulo: DataFrame, sucursal: DataFrame,
                   days: DataFrame, as_of: str) -> DataFrame:
    """Latest snapshot against the month's sales: rate, trend, suggested order and traffic light.

    Universe: SKUs sold in the last three years that have stock or were ever sold by the branch in that time.
    ``days`` is one row (habiles_mes, habiles_transcurridos).
    """
    cut, f = F.lit(as_of).cast("date"), F.col("fecha_comprobante")
    s = latest(stock).join(deposito.select("id_deposito", "id_sucursal"), "id_deposito").groupBy("id_sucursal", "id_articulo").agg(
        F.sum("cant_bultos").alias("stock_hoy_bultos"), F.sum("cantidad_total_htls").alias("stock_hoy_htls"))
    month = (f >= F.trunc(cut, "MM")) & (f < F.add_months(F.trunc(cut, "MM"), 1))
    # one pass over three years: the pair exists = the branch sells it
    pair = ventas.filter((f >= F.add_months(cut, -36))).groupBy("id_sucursal", "id_articulo").agg(
        F.sum(F.when(month, F.col("cantidades_total"))).alias("venta_mes_bultos"),
        F.sum(F.when(month, F.col("cantidad_total_htls"))).alias("venta_mes_htls"), F.lit(True).alias("_par"))
    live = pair.select("id_articulo").distinct()
    g = (s.join(pair, ["id_sucursal", "id_articulo"], "left").join(live, "id_articulo", "left_semi")
         .filter((F.col("stock_hoy_bultos") != 0) | F.col("_par"))
         .join(sucursal.select("id_sucursal", F.col("descripcion").alias("sucursal")), "id_sucursal")
         .join(articulo.select("id_articulo", "des_articulo", "generico", "marca"), "id_articulo"))
    g = with_scalars(g.fillna(0, subset=["venta_mes_bultos", "venta_mes_htls"]), days)
    rate = ratio("venta_mes_bultos", "habiles_transcurridos")
    g = g.withColumn("venta_diaria_bultos", rate).withColumn("tendencia_bultos", F.col("venta_diaria_bultos") * F.col("habiles_mes"))
    d, st = F.col("venta_diaria_bultos"), F.col("stock_hoy_bultos")
    reach = F.try_divide(st, d)
    light = (F.when(st <= 0, "ROJO").when(d.isNull() | (d <= 0), "VERDE").when(reach < RED_DAYS, "ROJO")
             .when(reach <= AMBER_DAYS, "AMARILLO").otherwise("VERDE"))
    return g.select("sucursal", "id_articulo", "des_articulo", "generico", "marca", "stock_hoy_bultos", "stock_hoy_htls",
                    "venta_mes_bultos", "venta_mes_htls", F.col("habiles_transcurridos").alias("dias_habiles_transcurridos"),
                    "venta_diaria_bultos", "tendencia_bultos", F.greatest(d * ORDER_DAYS - st, F.lit(0.0)).alias("pedido_sugerido_bultos"),
                    light.alias("estado_semaforo"))


def reach_by(view: DataFrame, keys: list[str]) -> DataFrame:
    """Days of reach at any grouping as a ratio of sums."""
    t = view.groupBy(*keys).agg(F.count(F.lit(1)).alias("pares"), F.sum("stock_hoy_bultos").alias("stock"), F.sum("venta_mes_bultos").alias("venta_mes"),
                                F.sum("venta_diaria_bultos").alias("venta_diaria"), F.sum("pedido_sugerido_bultos").alias("pedido"))
    return t.withColumn("alcance_dias", ratio("stock", "venta_diaria"))


def valuation(snap: DataFrame, prices: DataFrame, excluded: list[str] | None = None) -> DataFrame:
    """Stock valued at two prices; a missing price counts 0, a missing category gets a label, only categories exclude."""
    s = snap.filter(F.coalesce(~_excluded(excluded), F.lit(True))) if excluded else snap
    j = join_catalogue(s, prices.select("id_articulo", "precio_base", "precio_final"), "id_articulo", "left")
    j = j.fillna(0, subset=["cant_bultos", "precio_base", "precio_final"]).fillna({"generico": UNCLASSIFIED, "marca": NO_BRAND})
    return j.drop("cant_htls").withColumn("valorizado", F.col("cant_bultos") * F.col("precio_base")) \
            .withColumn("valorizado_final", F.col("cant_bultos") * F.col("precio_final"))


def valuation_matrix(universe: DataFrame, branches: list[str], value: str = "valorizado") -> DataFrame:
    """SKU x branch: units and money, with totals."""
    keys = ["id_articulo", "des_articulo", "generico", "marca"]
    w = wide(universe, keys, "sucursal", branches, {"bultos": "cant_bultos", "valor": value})
    total = universe.groupBy("id_articulo").agg(F.sum("cant_bultos").alias("total_bultos"), F.sum(value).alias("total_valor"))
    return w.join(total, "id_articulo").orderBy(F.desc("total_valor"), "id_articulo")


def category_matrix(universe: DataFrame, branches: list[str]) -> DataFrame:
    """Category x branch money with the total."""
    w = wide(universe, ["generico"], "sucursal", branches, {"valor": "valorizado"})
    return w.withColumn("total", reduce(lambda a, b: a + b, [F.col(f"valor_{slug(b)}") for b in branches]))


def branch_summary(universe: DataFrame) -> DataFrame:
    """Units, SKUs with stock, money, share of the capital and value per unit, per branch."""
    t = universe.groupBy("sucursal").agg(F.sum("cant_bultos").alias("bultos"), F.sum("valorizado").alias("valorizado"),
                                         F.count_distinct(F.when(F.col("cant_bultos") != 0, F.col("id_articulo"))).alias("articulos_con_stock"))
    t = with_scalars(t, universe.agg(F.sum("valorizado").alias("_t")))
    return t.withColumn("pct_capital", ratio("valorizado", "_t", 0)).withColumn("valor_por_bulto", ratio("valorizado", "bultos", 0)).drop("_t")


def capital_abc(universe: DataFrame) -> DataFrame:
    """ABC by cumulative share of immobilised capital; SKUs without positive capital take no part."""
    t = universe.groupBy("id_articulo", "des_articulo", "generico", "marca").agg(
        F.sum("cant_bultos").alias("bultos"), F.sum("valorizado").alias("valorizado")).filter("valorizado > 0")
    # the order uses the value to 1e-6: sums of doubles differ in the last bits from run to run, ties must stay ties
    r = running(t.withColumn("_v", F.round("valorizado", 6)), "_v", {"_c": "valorizado"}, ident="id_articulo", descending=True)
    r = r.withColumn("pct_total", ratio("valorizado", "_c_total")).withColumn("pct_acumulado", ratio("_c", "_c_total")).drop("_c", "_c_total", "_v")
    a = F.col("pct_acumulado")
    return r.withColumn("clase", F.when(a <= ABC_CUTS[0] + EPS, "A").when(a <= ABC_CUTS[1] + EPS, "B").otherwise("C"))


def control_frames(snap: DataFrame, universe: DataFrame, excluded: list[str]) -> DataFrame:
    """Diagnostics in one frame (control, id_articulo, des_articulo, generico, sucursal, bultos, valorizado)."""
    art = ["id_articulo", "des_articulo", "generico"]

    def pack(df: DataFrame, label: str, keys: list[str]) -> DataFrame:
        g = df.groupBy(*keys).agg(F.sum("cant_bultos").alias("bultos"), F.sum("valorizado").alias("valorizado"))
        missing = [c for c in [*art, "sucursal"] if c not in keys]
        for c in missing:
            g = g.withColumn(c, F.lit(None).cast("long" if c == "id_articulo" else "string"))
        return g.select(F.lit(label).alias("control"), *art, "sucursal", "bultos", "valorizado")

    u = universe
    out = snap.filter(_excluded(excluded)).withColumn("valorizado", F.lit(None).cast("double"))
    return reduce(lambda a, b: a.unionByName(b), [
        pack(u.filter("precio_base = 0 and cant_bultos <> 0"), "sin_precio", art),
        pack(u.filter("cant_bultos < 0"), "negativo", [*art, "sucursal"]),
        pack(u.filter(F.col("generico") == UNCLASSIFIED), "sin_clasificar", art),
        pack(out, "excluido", ["generico"])])


def listed_snapshot(stock: DataFrame, articles: DataFrame, depots: DataFrame, columns: list[str]) -> DataFrame:
    """Latest stock of a listed SKU set with one column per mapped depot; ``depots`` is (id_deposito, columna)."""
    s = wide(latest(stock).join(F.broadcast(depots), "id_deposito"), ["id_articulo"], "columna", columns, {"d": "cant_bultos"})
    return join_catalogue(s, articles.select("id_articulo"), "id_articulo", "left_semi")


# -- supplier codes ------------------------------------------------------------------------------------------------
CANDIDATE_SCHEMES = [("40", "40"), ("400", "400"), ("pelado", "")]   # fixed values: scheme -> id prefix
ALWAYS_ACCEPT = "DUAL"


def tokens(col: str):
    """Significant tokens of a description: upper case, Ñ as N, alphanumeric, two characters or more."""
    t = F.regexp_replace(F.replace(F.upper(F.coalesce(F.col(col), F.lit(""))), F.lit("Ñ"), F.lit("N")), "[^A-Z0-9]", " ")
    return F.array_sort(F.array_distinct(F.filter(F.split(t, r"\s+"), lambda x: F.length(x) >= 2)))


def jaccard(a: str, b: str):
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b))), F.lit(0.0))


def match_codes(supplier: DataFrame, articulo: DataFrame) -> DataFrame:
    """Supplier codes (cod, desc) matched to SKUs: three candidate ids, best description overlap, accepted when it
    is positive or the SKU says DUAL.  Unmatched codes keep NULL."""
    ids = F.explode(F.array(*[F.struct(F.lit(n).alias("esquema"), F.concat(F.lit(p), F.col("cod").cast("string")).try_cast("long")
                                       .alias("id_articulo")) for n, p in CANDIDATE_SCHEMES]))
    c = supplier.withColumn("_t", tokens("desc")).withColumn("_c", ids).select("cod", "_t", "_c.*")
    a = articulo.select("id_articulo", "des_articulo", tokens("des_articulo").alias("_a"))
    best = (join_catalogue(c, a, "id_articulo").withColumn("_j", jaccard("_t", "_a")).groupBy("cod")
            .agg(F.max(F.struct("_j", "id_articulo", "esquema", "des_articulo")).alias("_b")))
    ok = (F.col("_b._j") > 0) | F.upper("_b.des_articulo").contains(ALWAYS_ACCEPT)
    return supplier.join(best.filter(ok), "cod", "left").select(
        "cod", "desc", F.col("_b.id_articulo").alias("id_articulo"), F.col("_b.esquema").alias("esquema"), F.col("_b._j").alias("similitud"))


def closest_article(unmatched: DataFrame, articulo: DataFrame) -> DataFrame:
    """Closest SKU of each unmatched code by token Jaccard, lowest id among equals; NULL when nothing overlaps.

    Works on distinct token sets.  The overlap through the rarest token gives a lower bound s; a set that reaches
    s shares one of the n - ceil(s n) + 1 rarest tokens, so only those are joined: exact, and frequent tokens
    rarely produce pairs.
    """
    art = articulo.filter("des_articulo is not null").select("id_articulo", "des_articulo", tokens("des_articulo").alias("a"))
    sets = art.filter(F.size("a") > 0).groupBy("a").agg(F.min_by(F.struct("id_articulo", "des_articulo"), "id_articulo").alias("art"))
    inverted = sets.withColumn("tok", F.explode("a"))
    freq = inverted.groupBy("tok").agg(F.count(F.lit(1)).alias("f"))
    q = unmatched.select(tokens("desc").alias("t")).distinct().filter(F.size("t") > 0)
    # known tokens of each query set, rarest first; unknown tokens cannot match but count in the size of the set
    known = q.select("t", F.explode("t").alias("tok")).join(freq, "tok").groupBy("t").agg(
        F.sort_array(F.collect_list(F.struct("f", "tok"))).alias("k"))      # a description has a handful of tokens
    first = known.withColumn("tok", F.col("k")[0]["tok"]).join(inverted, "tok").groupBy("t", "k").agg(F.max(jaccard("t", "a")).alias("s"))
    need = F.ceil(F.col("s") * F.size("t") - 1e-9)
    keep = F.greatest(F.size("t") - need + 1 - (F.size("t") - F.size("k")), F.lit(1))
    probe = first.withColumn("tok", F.explode(F.slice("k", F.lit(1), keep.cast("int")))).select("t", "s", F.col("tok.tok").alias("tok"))
    pairs = probe.join(inverted, "tok").select("t", "a", "art").distinct().withColumn("j", jaccard("t", "a"))
    best = pairs.groupBy("t").agg(F.max(F.struct("j", -F.col("art.id_articulo"))).alias("b"), F.max_by("art", F.struct("j", -F.col("art.id_articulo"))).alias("art"))
    return unmatched.withColumn("t", tokens("desc")).join(best, "t", "left").select(
        "cod", "desc", F.col("art.id_articulo").alias("closest_id"), F.col("art.des_articulo").alias("closest_desc"),
        F.coalesce(F.col("b.j"), F.lit(0.0)).alias("closest_sim"))


def match_checks(supplier: DataFrame, matched: DataFrame) -> DataFrame:
    """Every code is either matched or not, and matched ids do not repeat."""
    t = matched.agg(F.count("id_articulo").alias("con_match"), F.count_if(F.col("id_articulo").isNull()).alias("sin_match"),
                    F.count_distinct("id_articulo").alias("ids"))
    t = with_scalars(t, supplier.agg(F.count(F.lit(1)).alias("total")))
    return t.withColumn("cierra", F.col("con_match") + F.col("sin_match") == F.col("total")) \
            .withColumn("sin_repetidos", F.col("ids") == F.col("con_match"))


# -- days of cover -------------------------------------------------------------------------------------------------
def cover_pairs(stock: DataFrame, deposito: DataFrame, ventas: DataFrame, costs: DataFrame, articulo: DataFrame, sucursal: DataFrame,
                as_of: str, cost_from: str, window: int = 60) -> DataFrame:
    """Branch x SKU: stock, sales of the last ``window`` days with the days sold, sales of 12 months of the SKU, cost."""
    s0 = stock.filter(F.col("date_stock") <= F.lit(as_of).cast("date"))
    cut = s0.agg(F.max("date_stock").alias("d")).scalar()
    s = s0.filter(F.col("date_stock") == cut).join(deposito.select("id_deposito", "id_sucursal"), "id_deposito") \
          .groupBy("id_sucursal", "id_articulo").agg(F.sum("cant_bultos").alias("stock_bultos"))
    f = F.col("fecha_comprobante")
    live = ventas.filter((F.col("id_documento") == "FCVTA") & ~F.col("anulado") & (f <= cut))
    recent = live.filter(f > F.date_sub(cut, window))
    v = recent.groupBy("id_sucursal", "id_articulo").agg(F.sum("cantidades_total").alias("bultos_60d"),
                                                         F.count_distinct("fecha_comprobante").alias("ndias"))
    y = live.filter(f > F.date_sub(cut, 365)).groupBy("id_articulo").agg(F.sum("cantidades_total").alias("bultos_12m"))
    c = costs.filter((f >= F.lit(cost_from).cast("date")) & (F.col("precio_compra_neto") > 0) & (F.col("id_documento") == "FCVTA") & ~F.col("anulado"))
    c = c.groupBy("id_articulo").agg(F.avg("precio_compra_neto").alias("costo"))
    j = (s.join(sucursal.select("id_sucursal", F.col("descripcion").alias("sucursal")), "id_sucursal")
         .join(articulo.select("id_articulo", F.col("des_articulo").alias("articulo"), "generico", "marca"), "id_articulo", "left")
         .join(v, ["id_sucursal", "id_articulo"], "left").join(y, "id_articulo", "left").join(c, "id_articulo", "left"))
    j = j.fillna(0, subset=["bultos_60d", "ndias", "bultos_12m"])
    return j.filter((F.col("stock_bultos") != 0) | (F.col("bultos_60d") > 0))


def cover(pairs: DataFrame, non_merchandise: list[str], out_days: float = COVER_OUT_DAYS, over_days: float = COVER_OVER_DAYS) -> DataFrame:
    """Days of cover over the days with sale, state, capital at cost and a note on the odd rows."""
    p = pairs.withColumn("velocidad", F.when((F.col("bultos_60d") > 0) & (F.col("ndias") > 0), F.col("bultos_60d") / F.col("ndias")))
    p = p.withColumn("dias_cobertura", F.when(F.col("velocidad") > 0, F.col("stock_bultos") / F.col("velocidad")))
    p = p.withColumn("valor_costo", F.col("stock_bultos") * F.col("costo"))
    p = p.withColumn("es_mercaderia", F.col("generico").isNotNull() & F.coalesce(~F.col("generico").isin(non_merchandise), F.lit(True)))
    turns = F.coalesce(F.col("velocidad") > 0, F.lit(False))
    state = (F.when(turns & (F.col("dias_cobertura") < out_days), "QUIEBRE").when(turns & (F.col("dias_cobertura") > over_days), "SOBRESTOCK")
             .when(turns, "NORMAL").when(F.col("bultos_12m") > 0, "STOCK MUERTO").otherwise("SIN MOVIMIENTO"))
    note = F.when(F.col("stock_bultos") < 0, "stock negativo").when(F.col("costo").isNull(), "sin costo").otherwise("")
    return p.withColumn("estado", state).withColumn("nota", note)


STATE_ORDER = ["QUIEBRE", "SOBRESTOCK", "STOCK MUERTO", "NORMAL", "SIN MOVIMIENTO"]


def cover_summary(c: DataFrame) -> DataFrame:
    """Merchandise rows with urgency keys, and a TOTAL row whose cover is a ratio of sums."""
    m = c.filter("es_mercaderia")
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in STATE_ORDER]), F.col("estado")), F.lit(0)), F.lit(len(STATE_ORDER) + 1))
    weight = F.when(F.col("estado") == "QUIEBRE", F.coalesce("velocidad", F.lit(0.0))).otherwise(F.coalesce("valor_costo", F.lit(0.0)))
    cols = ["estado", "sucursal", "id_articulo", "stock_bultos", "bultos_60d", "velocidad", "dias_cobertura", "valor_costo"]
    rows = m.select(*cols, rank.cast("long").alias("orden"), weight.alias("peso"))
    t = m.agg(F.sum("stock_bultos").alias("stock_bultos"), F.sum("bultos_60d").alias("bultos_60d"), F.sum("velocidad").alias("velocidad"),
              F.sum("valor_costo").alias("valor_costo"))
    t = t.select(F.lit("TOTAL").alias("estado"), F.lit("TOTAL GENERAL").alias("sucursal"), F.lit(None).cast("long").alias("id_articulo"),
                 "stock_bultos", "bultos_60d", "velocidad", F.when(F.col("velocidad") > 0, F.col("stock_bultos") / F.col("velocidad")).alias("dias_cobertura"),
                 "valor_costo", F.lit(99).cast("long").alias("orden"), F.lit(None).cast("double").alias("peso"))
    return rows.unionByName(t)


def article_stock(stock: DataFrame) -> DataFrame:
    """Positive stock per SKU of the latest snapshot and the depots that hold it."""
    return latest(stock).groupBy("id_articulo").agg(
        F.sum("cant_bultos").alias("stock_bultos"),
        F.count_distinct(F.when(F.col("cant_bultos") > 0, F.col("id_deposito"))).alias("depositos")).filter("stock_bultos > 0")


def dead_stock(stock: DataFrame, life: DataFrame, articulo: DataFrame, prices: DataFrame, as_of: str, non_merchandise: list[str],
               days: int = DEAD_STOCK_DAYS, filtered: bool = True) -> DataFrame:
    """SKUs with stock and no sale for more than ``days`` or never; ``filtered=False`` gives the naive list."""
    j = stock.join(articulo.select("id_articulo", "des_articulo", "generico", "marca"), "id_articulo", "left")
    if filtered:
        j = j.filter(F.col("generico").isNotNull() & ~F.col("generico").isin(non_merchandise))
    j = j.join(life.select("id_articulo", "ultima_venta"), "id_articulo", "left")
    j = j.withColumn("dias_sin_venta", F.datediff(F.lit(as_of).cast("date"), "ultima_venta").cast("long"))
    j = j.filter(F.col("ultima_venta").isNull() | (F.col("dias_sin_venta") > days)).join(prices, "id_articulo", "left")
    return j.withColumn("valor_neto", F.col("stock_bultos") * F.col("precio_neto_medio")) \
            .withColumn("estado", F.when(F.col("ultima_venta").isNull(), "Nunca vendido").otherwise("Sin rotacion"))
