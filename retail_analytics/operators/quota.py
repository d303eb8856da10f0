"""Quota allocation: exact splits over routes, reps and labels.

Splits run on quota grain (routes, reps and labels of one zone), so a window holds the members of one zone.
"""
from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window as W, functions as F

from retail_analytics.functions.grid import complete_grid
from retail_analytics.functions.joins import join_null_safe

# -- fixed values -------------------------------------------------------------------------------------------------
TOLERANCE = 0.02
NO_ROUTE = "SIN RUTA"
LABEL_FLOOR_SHARE, LABEL_FLOOR_MAX = 0.0015, 0.25
# -----------------------------------------------------------------------------------------------------------------


def split_last(df: DataFrame, by: list[str], total: str, weight: str, order: list[str], name: str = "cupo", digits: int = 2) -> DataFrame:
    """Proportional split; the last part takes the residue; even parts when the weights add up to nothing."""
    w = W.partitionBy(*by)
    s, n, last = F.sum(weight).over(w), F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(*[F.desc(c) for c in order])) == 1
    d = df.withColumn("_s", s).withColumn("_n", n).withColumn("_l", last)
    part = F.round(F.when(F.col("_s") > 0, F.col(total) * F.col(weight) / F.col("_s")).otherwise(F.col(total) / F.col("_n")), digits)
    d = d.withColumn("_p", F.when(F.col("_l"), 0.0).otherwise(part))
    rest = F.round(F.col(total) - F.sum("_p").over(w), digits)
    return d.withColumn(name, F.when(F.col("_l"), rest).otherwise(F.col("_p"))).drop("_s", "_n", "_l", "_p")


def split_largest(df: DataFrame, by: list[str], total: str, weight: str, order: list[str], name: str = "cupo", digits: int = 2) -> DataFrame:
    """Proportional split; negative weights count 0, the residue goes to the largest weight (first of equals);
    even parts with the residue on the last when nothing has weight."""
    w = W.partitionBy(*by)
    d = df.withColumn("_w", F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(0.0)))
    d = d.withColumn("_s", F.sum("_w").over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
    first = F.row_number().over(w.orderBy(F.desc("_w"), *order)) == 1
    last = F.row_number().over(w.orderBy(*[F.desc(c) for c in order])) == 1
    d = d.withColumn("_t", F.when(F.col("_s") > 0, first).otherwise(last))
    d = d.withColumn("_p", F.round(F.when(F.col("_s") > 0, F.col(total) * F.col("_w") / F.col("_s")).otherwise(F.col(total) / F.col("_n")), digits))
    rest = F.col(total) - F.sum("_p").over(w)
    return d.withColumn(name, F.when(F.col("_t"), F.round(F.col("_p") + rest, digits)).otherwise(F.col("_p"))).drop("_w", "_s", "_n", "_t", "_p")


def split_integers(df: DataFrame, by: list[str], total: str, weight: str, key: str, name: str = "cupo") -> DataFrame:
    """Largest remainder: whole numbers that add up to the rounded total, ties by name; even when there is no history."""
    w = W.partitionBy(*by)
    d = df.withColumn("_g", F.round(total).cast("long")).withColumn("_s", F.sum(weight).over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
    exact = F.when(F.col("_s") > 0, F.col(weight) / F.col("_s") * F.col("_g")).otherwise(F.floor(F.col("_g") / F.col("_n")).cast("double"))
    d = d.withColumn("_e", exact).withColumn("_f", F.floor("_e").cast("long"))
    d = d.withColumn("_m", F.col("_g") - F.sum("_f").over(w))
    # the fraction to 1e-9, so that equal shares tie and the name decides
    frac = F.when(F.col("_s") > 0, F.round(F.col("_e") - F.col("_f"), 9)).otherwise(0.0)
    rank = F.row_number().over(w.orderBy(F.desc("_r"), key))
    d = d.withColumn("_r", frac).withColumn("_k", rank)
    return d.withColumn(name, F.col("_f") + F.when(F.col("_k") <= F.col("_m"), 1).otherwise(0)).drop("_g", "_s", "_n", "_e", "_f", "_m", "_r", "_k")


def split_floor(df: DataFrame, by: list[str], total: str, weight: str, order: list[str], floor: float, name: str = "cupo", digits: int = 4) -> DataFrame:
    """Every route gets the floor, the excess goes by weight; a quota too small rises to floor x routes."""
    n = F.count(F.lit(1)).over(W.partitionBy(*by))
    d = df.withColumn("_x", F.greatest(F.col(total) - floor * n, F.lit(0.0)))
    return split_largest(d, by, "_x", weight, order, "_y", digits).withColumn(name, F.round(F.col("_y") + floor, digits)).drop("_x", "_y")


def split_block(routes: DataFrame, labels: DataFrame, history: DataFrame, quotas: DataFrame, floor_share: float = LABEL_FLOOR_SHARE,
                floor_max: float = LABEL_FLOOR_MAX) -> DataFrame:
    """Quota of a (zone, block) over route x label pairs in one pass.

    Labels sold in the zone share by history; unsold labels get a capped floor out of the same quota, spread over
    the routes by their weight in the block.  ``routes`` (zona, ruta), ``labels`` (bloque, etiqueta), ``history``
    (zona, ruta, etiqueta, qty), ``quotas`` (zona, bloque, cupo_bloque).
    """
    g = complete_grid(routes, labels).join(quotas, ["zona", "bloque"]).join(history, ["zona", "ruta", "etiqueta"], "left").fillna(0, subset=["qty"])
    blk, lab = W.partitionBy("zona", "bloque"), W.partitionBy("zona", "bloque", "etiqueta")
    g = g.withColumn("_viva", F.sum("qty").over(lab) > 0).withColumn("_i", F.dense_rank().over(blk.orderBy("etiqueta")))
    g = g.withColumn("_n", F.max("_i").over(blk)).withColumn("_m", F.size(F.collect_set(F.when(~F.col("_viva"), F.col("etiqueta"))).over(blk)))
    q = F.col("cupo_bloque")
    floor = F.round(q * floor_share, 2)
    floor = F.when(floor * F.col("_m") > q * floor_max, F.round(q * floor_max / F.nullif("_m", F.lit(0)), 2)).otherwise(floor)
    g = g.withColumn("_piso", F.when(F.col("_m") == F.col("_n"), 0.0).when(F.col("_m") > 0, floor).otherwise(0.0))
    g = g.withColumn("_resto", F.round(q - F.col("_piso") * F.col("_m"), 2))
    g = g.withColumn("_pr", F.sum(F.when(F.col("_viva"), F.col("qty")).otherwise(0.0)).over(W.partitionBy("zona", "bloque", "ruta")))
    none = F.col("_m") == F.col("_n")                                  # nothing sold: even parts over all pairs
    pairs = g.withColumn("_pw", F.when(none, 0.0).otherwise(F.col("qty")))
    live = split_largest(pairs.filter(F.col("_viva") | none), ["zona", "bloque"], "_resto", "_pw", ["ruta", "etiqueta"])
    dead = split_largest(pairs.filter(~F.col("_viva") & ~none), ["zona", "bloque", "etiqueta"], "_piso", "_pr", ["ruta"])
    keep = ["zona", "bloque", "ruta", "etiqueta", "cupo"]
    return live.select(*keep).unionByName(dead.select(*keep))


def rep_routes(cliente: DataFrame) -> DataFrame:
    """Routes of each rep from its active clients (composite key)."""
    return cliente.filter(~F.col("anulado") & F.col("id_ruta_fv1").isNotNull()).select(
        F.col("id_personal_fv1").alias("id_vendedor"), "id_sucursal", F.col("id_ruta_fv1").alias("id_ruta")).distinct()


def rep_quotas_to_routes(quotas: DataFrame, routes: DataFrame, history: DataFrame) -> DataFrame:
    """Rep quota per category to its routes by history; a rep without routes keeps one witness row.

    ``quotas`` (id_vendedor, id_sucursal, categoria, cupo_vendedor), ``history`` (id_sucursal, id_ruta, categoria, qty).
    """
    j = quotas.join(routes, ["id_vendedor", "id_sucursal"], "left").join(history, ["id_sucursal", "id_ruta", "categoria"], "left").fillna(0, subset=["qty"])
    s = split_last(j, ["id_vendedor", "id_sucursal", "categoria"], "cupo_vendedor", "qty", ["id_ruta"])
    label = F.when(F.col("id_ruta").isNull(), F.lit(NO_ROUTE)).otherwise(F.concat(F.lit("RUTA "), "id_ruta"))
    hist = F.sum("qty").over(W.partitionBy("id_vendedor", "id_sucursal", "categoria"))
    flag = F.when(F.col("id_ruta").isNull(), "sin ruta").when((F.col("cupo_vendedor") > 0) & (hist <= 0), "sin historia").otherwise("")
    return s.withColumn("ruta", label).withColumn("diagnostico", flag).drop("qty")


def category_floor(categories: DataFrame, brands: DataFrame) -> DataFrame:
    """Category quota raised to the largest of its brands on the same route (a floor, not a sum)."""
    top = brands.groupBy("zona", "ruta", "generico").agg(F.max("cupo").alias("_m"))
    return categories.join(top, ["zona", "ruta", "generico"], "left").withColumn(
        "cupo", F.when(F.col("_m") > F.col("cupo") + 1e-9, F.round("_m", 4)).otherwise(F.col("cupo"))).drop("_m")


def route_zone_by_majority(clients: DataFrame, route: str, zone: Column, order: list[str]) -> DataFrame:
    """Zone of a route by the majority of its clients; the first of ``order`` wins a tie."""
    t = clients.filter(F.col(route).isNotNull()).groupBy("id_sucursal", F.col(route).alias("ruta"), zone.alias("zona")).agg(F.count(F.lit(1)).alias("clientes"))
    pos = F.array_position(F.array(*[F.lit(z) for z in order]), F.col("zona"))
    return t.groupBy("id_sucursal", "ruta").agg(F.max_by("zona", F.struct("clientes", -pos)).alias("zona"), F.max("clientes").alias("clientes_zona"))


def redistribute(values: DataFrame, by_brand: DataFrame, quotas: DataFrame, rep: str, brand: str, category: str) -> DataFrame:
    """Move the quota a brand's one-off sales gave a rep evenly to all reps of the zone; the zone total stays.

    ``values`` (zona, ruta, preventista, categoria, qty, cupo), ``by_brand`` (zona, ruta, marca, qty), ``quotas``
    (zona, cupo_zona).  The move is a union of signed adjustments that are added up.
    """
    origin = values.select("zona", "ruta", "preventista").distinct().filter(F.col("preventista") == rep)
    mine = origin.join(by_brand.filter(F.col("marca") == brand).select("zona", "ruta", F.col("qty").alias("_q")), ["zona", "ruta"], "left").fillna(0, subset=["_q"])
    amount = mine.groupBy("zona").agg(F.sum("_q").alias("_b")).join(values.groupBy("zona").agg(F.sum("qty").alias("_z")), "zona").join(quotas, "zona")
    amount = amount.filter("_b > 0 and _z > 0").select("zona", F.round(F.col("cupo_zona") * F.col("_b") / F.col("_z"), 2).alias("_monto"))
    out = split_largest(mine.join(amount, "zona"), ["zona"], "_monto", "_q", ["ruta"], "_d").select("zona", "ruta", (-F.col("_d")).alias("_d"))
    routes = values.select("zona", "ruta", "preventista").distinct().join(amount, "zona").withColumn("_one", F.lit(1.0))
    reps = split_largest(routes.select("zona", "preventista", "_monto", "_one").distinct(), ["zona"], "_monto", "_one", ["preventista"], "_c")
    into = split_largest(routes.join(reps.select("zona", "preventista", "_c"), ["zona", "preventista"]), ["zona", "preventista"], "_c", "_one", ["ruta"], "_d")
    moves = out.unionByName(into.select("zona", "ruta", "_d")).groupBy("zona", "ruta").agg(F.sum("_d").alias("_d")).withColumn("categoria", F.lit(category))
    j = values.join(moves, ["zona", "ruta", "categoria"], "left")
    return j.withColumn("cupo", F.round(F.col("cupo") + F.coalesce("_d", F.lit(0.0)), 2)).drop("_d")


def closure(rows: DataFrame, quotas: DataFrame, keys: list[str], part: str, total: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Keys whose parts do not add up to the quota."""
    s = rows.groupBy(*keys).agg(F.sum(part).alias("suma"))
    j = join_null_safe(quotas.select(*keys, F.col(total).alias("esperado")), s, keys)
    return j.withColumn("diferencia", F.abs(F.coalesce("suma", F.lit(0.0)) - F.col("esperado"))).filter(F.col("diferencia") > tolerance)


def redistribute_leavers(quotas: DataFrame, alive: DataFrame, weights: DataFrame, digits: int = 2) -> DataFrame:
    """Branch total per category to the reps still active, by weight; the branch total is kept exactly.

    ``quotas`` (id_sucursal, preventista, categoria, cupo), ``alive`` (id_sucursal, preventista), ``weights``
    (id_sucursal, preventista, categoria, qty).  Branches without an active rep keep their rows.
    """
    t = quotas.groupBy("id_sucursal", "categoria").agg(F.round(F.sum("cupo"), digits).alias("_total"))
    j = alive.join(t, "id_sucursal").join(weights, ["id_sucursal", "preventista", "categoria"], "left").fillna(0, subset=["qty"])
    s = split_largest(j, ["id_sucursal", "categoria"], "_total", "qty", ["preventista"], "cupo", digits).select("id_sucursal", "preventista", "categoria", "cupo")
    kept = quotas.join(alive.select("id_sucursal").distinct(), "id_sucursal", "left_anti").select("id_sucursal", "preventista", "categoria", "cupo")
    return s.unionByName(kept)


def wide_to_long(wide: DataFrame, keys: list[str], mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """Quota columns to rows with (generico, desagregado) from the map; a row without a numeric route is no quota."""
    missing = [c for c in mapping if c not in wide.columns]
    if missing:
        raise ValueError(f"quota sheet lacks {missing}")
    cells = F.array(*[F.struct(F.lit(g).alias("generico"), F.lit(d).alias("desagregado"), F.col(c).cast("double").alias("cupo")) for c, (g, d) in mapping.items()])
    return wide.withColumn("id_ruta", F.col("codigo").cast("string").try_cast("long")).filter("id_ruta is not null").select(*keys, "id_ruta", F.inline(cells))


def uncomputed(long: DataFrame) -> DataFrame:
    """Cells without a value; the load must stop when there are any."""
    return long.filter("cupo is null").groupBy("generico", "desagregado").agg(F.count(F.lit(1)).alias("celdas"), F.min("id_ruta").alias("primera_ruta"))


def require_values(long: DataFrame) -> DataFrame:
    """The long quotas, failing the job on a cell without a value (a zero must not be invented)."""
    stop = F.raise_error(F.concat(F.lit("quota without value: route "), F.col("id_ruta").cast("string")))
    return long.withColumn("cupo", F.coalesce("cupo", stop.cast("double")))


def fixed_rows(labels: DataFrame, route: int, rep: str, zone: str, quota: float) -> DataFrame:
    """Same fixed quota for every label of a special route."""
    return labels.distinct().select(F.lit(route).cast("long").alias("id_ruta"), F.lit(rep).alias("preventista"), "etiqueta", F.lit(zone).alias("zona"), F.lit(quota).alias("cupo"))


