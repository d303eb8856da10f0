"""Permissive reads of delimited files: every row comes back, good or with the reason why not."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

RAW, REASON = "_crudo", "motivo"


def read_all(spark: SparkSession, path: str, schema: StructType, required: list[str] = (), sep: str = ",", checks: dict[str, Column] | None = None) -> DataFrame:
    """The rows of delimited files with a header, in the columns of ``schema``, with ``motivo`` (NULL for a good row) and ``_crudo``
    (the line as it stands, for rows that don't parse).

    Reasons, the first that holds: a header line again, too few columns, too many columns, a value of the wrong type (with the
    names of the columns), a required value that is missing, and those of ``checks`` (reason -> condition that a good row meets).
    """
    wide = StructType([*schema.fields, StructField(RAW, StringType())])
    rows = (spark.read.schema(wide).option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
            .option("enforceSchema", True).csv(path))
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField("_more", StringType())])
    parsed = F.from_csv(RAW, texts.simpleString()[7:-1].replace(":", " "), {"sep": sep, "mode": "PERMISSIVE"})
    raw = F.col(RAW)
    # from_csv fills missing columns with NULL; an empty value is NULL too, so the columns are counted by their separators outside quotes
    n = F.length(F.regexp_replace(F.regexp_replace(raw, '"[^"]*"', ""), f"[^{sep}]", "")) + 1
    header = sep.join(schema.names)
    rows = rows.withColumn("_t", F.when(raw.isNotNull(), parsed))
    wrong = F.concat_ws(", ", *[F.when(F.col(f"_t.{f.name}").isNotNull() & F.col(f"`{f.name}`").isNull(), f.name) for f in schema.fields if not isinstance(f.dataType, StringType)])
    why = (F.when(raw == header, "encabezado repetido").when(raw.isNotNull() & (n < len(schema)), "faltan columnas").when(raw.isNotNull() & (n > len(schema)), "sobran columnas")
           .when(raw.isNotNull(), F.concat(F.lit("tipo invalido: "), wrong)))
    for c in required:
        why = why.when(F.col(c).isNull(), F.lit(f"falta {c}"))
    for reason, fine in (checks or {}).items():
        why = why.when(~F.coalesce(fine, F.lit(False)), F.lit(reason))
    return rows.select(*schema.names, why.alias(REASON), RAW)


def split(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows of :func:`read_all`, written by one job (one scan of the files) into two folders and read back."""
    rows.withColumn("estado", F.when(F.col(REASON).isNull(), "bueno").otherwise("malo")).write.partitionBy("estado").parquet(path)
    spark, both = rows.sparkSession, rows.schema
    back = spark.read.schema(StructType([*both.fields, StructField("estado", StringType())])).parquet(path)
    return back.filter("estado = 'bueno'").drop("estado", REASON, RAW), back.filter("estado = 'malo'").drop("estado")
