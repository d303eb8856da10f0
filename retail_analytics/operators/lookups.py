"""Lookups of one client, one SKU, one month: all rows, with a flag when there are more than ``LIMIT``."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retail_analytics.functions.grid import with_scalars
from retail_analytics.operators.filters import client_name, dates

LIMIT = 500  # fixed value of the lookup contract


def flagged(df: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All rows and whether a display of ``limit`` rows would cut them; the caller cuts."""
    return with_scalars(df, df.agg((F.count(F.lit(1)) > limit).alias("truncado")))


def client_sales(ventas: DataFrame, articulo: DataFrame, client: int, month: str, limit: int = LIMIT) -> DataFrame:
    m = ventas.filter((F.col("id_cliente") == client) & (F.date_format("fecha_comprobante", "yyyy-MM") == month))
    out = m.join(articulo.select("id_articulo", "des_articulo"), "id_articulo", "left").select(
        "fecha_comprobante", "id", "id_articulo", "des_articulo", "cantidades_total", "subtotal_neto")
    return flagged(out, limit)


def branch_clients(cliente: DataFrame, branch: int, limit: int = LIMIT) -> DataFrame:
    return flagged(cliente.filter(F.col("id_sucursal") == branch).select("id_cliente", "fantasia", "anulado"), limit)


def category_articles(articulo: DataFrame, category: str, limit: int = LIMIT) -> DataFrame:
    return flagged(articulo.filter(F.col("generico") == category).select("id_articulo", "des_articulo", "marca"), limit)


def article_sales(ventas: DataFrame, sucursal: DataFrame, article: int, desde: str, hasta: str,
                  limit: int = LIMIT) -> DataFrame:
    v = dates(ventas, desde, hasta).filter(F.col("id_articulo") == article)
    out = v.join(sucursal.withColumnRenamed("descripcion", "sucursal"), "id_sucursal", "left").select(
        "fecha_comprobante", "id", "sucursal", "cantidades_total", "subtotal_neto")
    return flagged(out, limit)


def month_coverage(cob: DataFrame, month: str, branches: list[str] | None = None, limit: int = LIMIT) -> DataFrame:
    """Buying clients and volume of a month (``YYYY-MM``) by branch and category, optionally of some branches."""
    c = cob.filter(F.date_format("periodo", "yyyy-MM") == month)
    c = c.filter(F.col("ds_sucursal").isin(branches)) if branches is not None else c
    out = c.groupBy("periodo", F.col("ds_sucursal").alias("sucursal"), "generico").agg(
        F.sum("clientes_compradores").alias("clientes_compradores"), F.sum("volumen_total").alias("volumen_total"))
    return flagged(out, limit)


def resolve_client(cliente: DataFrame, ids: DataFrame) -> DataFrame:
    """Requested clients (id_cliente, id_sucursal or NULL) with name and state: ok, ambiguo or no existe."""
    c = cliente.select(F.col("id_cliente").alias("_c"), F.col("id_sucursal").alias("_s"),
                       client_name().alias("nombre"))
    j = ids.join(c, (F.col("id_cliente") == F.col("_c"))
                 & (F.col("id_sucursal").isNull() | (F.col("id_sucursal") == F.col("_s"))), "left")
    return (j.groupBy("id_cliente", "id_sucursal")
            .agg(F.count("_c").alias("n"), F.min("_s").alias("sucursal_hallada"), F.min_by("nombre", "_s").alias("nombre"))
            .select("id_cliente", "id_sucursal",
                    F.when(F.col("n") == 1, F.col("sucursal_hallada")).alias("sucursal_hallada"),
                    F.when(F.col("n") == 1, F.col("nombre")).alias("nombre"),
                    F.when(F.col("n") == 0, "no existe").when(F.col("n") > 1, "ambiguo").otherwise("ok").alias("estado")))
