"""Readers with data contracts, text repair and freshness checks."""
from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# -- fixed values: raw columns of the promo-line export, in order -------------------------------------------------
PROMO_COLUMNS = [
    "Fecha", "Comprobante", "Agrupaciones", "Cod. Cliente", "Razón Social", "Dirección", "Artículo CMQ",
    "Descripción", "Marca", "Calibre", "Cantidad", "Precio Neto SF", "Total", "Cantidad Sin Cargo", "Descuento %",
    "Descuento $ sobre PN SF", "Participación CMQ", "Monto A Acreditar", "Acción", "Descripción Acción",
    "Artículo Distribuidora",
]
PROMO_NUMBERS = {"Cantidad", "Precio Neto SF", "Total", "Cantidad Sin Cargo", "Descuento %",
                 "Descuento $ sobre PN SF", "Participación CMQ", "Monto A Acreditar"}
# -------------------------------------------------------------------------------------------------------------------


def scan(spark: SparkSession, sql: str, **params) -> DataFrame:
    """Parameterised SQL scan on registered views; parameters are bound, never pasted."""
    return spark.sql(sql, args=params)


def check_contract(df: DataFrame, required: list[str], not_null: list[str], keep: Column | None = None) -> DataFrame:
    """Problems of a table as rows (problema, columna, n): missing or repeated columns, else gaps and zero rows."""
    spark, names = df.sparkSession, Counter(df.columns)
    schema = "problema string, columna string, n long"
    heads = [("falta", c, 0) for c in required if not names[c]]
    heads += [("repetida", c, names[c]) for c in required if names[c] > 1]
    if heads:
        return spark.createDataFrame(heads, schema)
    body = df.filter(keep) if keep is not None else df
    blank = {c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in not_null}
    one = body.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(b).alias(c) for c, b in blank.items()])
    checks = [F.struct(F.lit("sin filas").alias("problema"), F.lit(None).cast("string").alias("columna"),
                       F.when(F.col("_n") == 0, F.lit(0).cast("long")).alias("n"))]
    checks += [F.struct(F.lit("sin valor").alias("problema"), F.lit(c).alias("columna"),
                        F.when(F.col(c) > 0, F.col(c)).alias("n")) for c in not_null]
    return one.select(F.inline(F.array(*checks))).filter("n is not null")


def promo_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.DoubleType() if c in PROMO_NUMBERS else T.StringType())
                         for c in PROMO_COLUMNS])


def promo_lines(df: DataFrame) -> DataFrame:
    """Exact 21-column contract: extra columns are dropped, a missing one is an error."""
    missing = [c for c in PROMO_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"promo source lacks {missing}")
    return df.select(*[f"`{c}`" for c in PROMO_COLUMNS])


def read_promo_lines(spark: SparkSession, path: str) -> DataFrame:
    """Promo lines from a CSV export; bad rows fail the job."""
    return promo_lines(spark.read.csv(path, header=True, schema=promo_schema(), mode="FAILFAST", enforceSchema=False))


def repair_text(col: str) -> Column:
    """Undo UTF-8 that was read as Latin-1; text that does not survive the round trip is left as it is."""
    raw = F.encode(F.col(col), "ISO-8859-1")
    latin = F.col(col).rlike(r"^[\x00-\xFF]*$")
    return F.when(latin, F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(F.col(col))) \
            .otherwise(F.col(col))


def repair_all_text(df: DataFrame) -> DataFrame:
    """Text repair on every string column."""
    return df.select(*[repair_text(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])


def price_list(df: DataFrame, ident: str = "id", base: str = "base", final: str = "final", strict: bool = False) -> DataFrame:
    """Clean price list: numeric ids listed once, both prices numeric, an empty price counts as 0.

    Rows with a bad id or price and all rows of a repeated id are left out (:func:`price_list_problems` has them), or fail the
    read when ``strict``.  One pass and one shuffle by id.
    """
    missing = [c for c in (ident, base, final) if c not in df.columns]
    if missing:
        raise ValueError(f"price list lacks {missing}")
    key = F.col(ident).cast("string").try_cast("long")
    prices = {n: (F.trim(F.col(c).cast("string")), n) for c, n in ((base, "precio_base"), (final, "precio_final"))}
    good = F.lit(True)
    for text, _ in prices.values():
        good = good & (text.isNull() | (text == "") | text.try_cast("double").isNotNull())
    rows = df.select(key.alias("id_articulo"), *[F.coalesce(t.try_cast("double"), F.lit(0.0)).alias(n) for t, n in prices.values()],
                     good.alias("_good"), F.col(ident).cast("string").alias("_id"))
    t = rows.groupBy("id_articulo", F.when(F.col("id_articulo").isNull(), F.col("_id")).alias("_id")).agg(
        F.max("precio_base").alias("precio_base"), F.max("precio_final").alias("precio_final"), F.count(F.lit(1)).alias("_n"), F.bool_and("_good").alias("_good"))
    ok = F.col("id_articulo").isNotNull() & F.col("_good") & (F.col("_n") == 1)
    if strict:
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad or repeated price list row: "), F.coalesce(F.col("id_articulo").cast("string"), F.col("_id"), F.lit("no id")))).cast("boolean"))
    return t.filter(ok).select("id_articulo", "precio_base", "precio_final")


def price_list_problems(df: DataFrame, ident: str = "id", base: str = "base", final: str = "final") -> DataFrame:
    """Rows (problema, valor, n): ids that are no number, prices that are no number, ids listed twice."""
    def bad(c: str) -> DataFrame:
        hit = df.filter(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull())
        return hit.groupBy(F.col(c).cast("string").alias("valor")).agg(F.count(F.lit(1)).alias("n")) \
                  .select(F.lit(f"{c} no numerico").alias("problema"), "valor", "n")
    no_id = df.filter(F.col(ident).cast("string").try_cast("long").isNull())
    ids = no_id.groupBy(F.col(ident).cast("string").alias("valor")).agg(F.count(F.lit(1)).alias("n")) \
               .select(F.lit("id invalido").alias("problema"), "valor", "n")
    twice = (df.filter(F.col(ident).cast("string").try_cast("long").isNotNull())
             .groupBy(F.col(ident).cast("string").alias("valor"))
             .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("id repetido").alias("problema"), "valor", "n"))
    return ids.union(bad(base)).union(bad(final)).union(twice)


def file_times(source: DataFrame) -> DataFrame:
    """Change time of the files behind a file source, as the column ``cargada``."""
    return source.select(F.col("_metadata.file_modification_time").alias("cargada"))


def freshness(source: DataFrame, now: str, max_days: int = 30, loaded: str = "cargada") -> DataFrame:
    """Age in days of the newest load time of a source, and whether it is over the limit."""
    age = F.greatest(F.datediff(F.lit(now).cast("date"), F.col("actualizada").cast("date")), F.lit(0))
    return source.agg(F.max(loaded).alias("actualizada")).withColumn("dias", age.cast("long")).withColumn("vencida", F.col("dias") > max_days)


def latest_date(df: DataFrame, col: str, void: str | None = None) -> DataFrame:
    """Newest date of a fact or snapshot."""
    return (df if void is None else df.filter(~F.col(void))).agg(F.max(col).alias("fecha"))


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """The catalog table, or an empty frame with its schema when it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)
