"""Filters, predicates and derived dimensions: pure column expressions and small map joins."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Zone = tuple[str, str, list[int]]  # (zone name, real branch, routes)

# -- fixed values ---------------------------------------------------------------------------------------------
QUOTE_DOCUMENT = "PRVTA"
SALE_DOCUMENTS = ["FCVTA", "DVVTA"]
DIRECT_ROUTE = 100
KNOWN_SIZES = ["300", "330", "473", "500", "575", "600", "710", "1000", "1200", "1350", "1500", "2000", "2250", "2500"]
FLAVOUR_RULES = [("NEGRA", ["%NEGR%"]), ("ROJA", ["%ROJA%"]),
                 ("BLANCA (rubia)", ["%BLANC%", "%RUBIA%", "%RUB %", "%BCA%"])]
PROMO_TIERS = [("MVB", "MVB"), ("(ESC.)", "ESC"), ("EXTRA TASA", "EXTRA TASA")]
PROMO_DEFAULT = "OTRAS"
# -------------------------------------------------------------------------------------------------------------


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def in_values(df: DataFrame, col: str, values: list | None) -> DataFrame:
    """Optional IN filter; ``None`` or an empty list keeps everything."""
    return df.filter(F.col(col).isin(list(values))) if values else df


def in_table(df: DataFrame, col: str, values: DataFrame) -> DataFrame:
    """IN filter for long lists: left-semi join on the first column of ``values``."""
    return df.join(values.select(F.col(values.columns[0]).alias(col)), col, "left_semi")


def period(df: DataFrame, col: str, values: list | None = None, desde=None, hasta=None) -> DataFrame:
    """Period filter by list or by inclusive range; neither is an error."""
    if values:
        return df.filter(F.col(col).isin(list(values)))
    if desde is not None and hasta is not None:
        return df.filter(F.col(col).between(F.lit(desde), F.lit(hasta)))
    raise ValueError("give either values or desde and hasta")


def dates(df: DataFrame, desde: str, hasta: str, col: str = "fecha_comprobante") -> DataFrame:
    """Inclusive date range (reaches the scan as a pushed filter)."""
    return df.filter(F.col(col).between(F.lit(desde).cast("date"), F.lit(hasta).cast("date")))


def exclude_routes(df: DataFrame, pairs: list[tuple[int | None, int]] | None, branch: str = "id_sucursal",
                   route: str = "id_ruta") -> DataFrame:
    """Drop (branch, route) pairs; branch ``None`` means every branch.  Rows without a route stay."""
    if not pairs:
        return df
    r = F.coalesce(F.col(route), F.lit(-1))
    return df.filter(~_any([(r == x) if b is None else ((F.col(branch) == b) & (r == x)) for b, x in pairs]))


def route_zone(df: DataFrame, included: list[int] | None = None, excluded: list[int] | None = None,
               route: str = "id_ruta") -> DataFrame:
    """Keep a route zone; an empty include list keeps nothing (``None`` keeps all)."""
    if included is not None:
        df = df.filter(F.col(route).isin(included) if included else F.lit(False))
    return df.filter(~F.col(route).isin(excluded)) if excluded else df


def drop_quotes(df: DataFrame, categories: list[str] | None, category: str = "generico",
                document: str = "id_documento") -> DataFrame:
    """Drop quote documents of the given categories only (SQL NULL rules: unknown category and quote is dropped)."""
    if not categories:
        return df
    return df.filter(~(F.col(category).isin(list(categories)) & (F.col(document) == QUOTE_DOCUMENT)))


def split_brands(splits: dict[str, list[str]] | None, category: str = "generico", brand: str = "marca") -> Column:
    """Category where listed brands become their own category and the rest ``X (sin a, b)``."""
    out = F.col(category)
    for cat, brands in (splits or {}).items():
        rest = F.when(F.col(category) == cat, F.lit(f"{cat} (sin {', '.join(brands)})")).otherwise(out)
        out = F.when((F.col(category) == cat) & F.col(brand).isin(list(brands)), F.col(brand)).otherwise(rest)
    return out


def zone_name(zones: list[Zone], branch: str = "sucursal", route: str = "id_ruta") -> Column:
    """Branch name after the virtual zones are cut out of it by route."""
    out = F.col(branch)
    for zone, real, routes in reversed(zones):
        out = F.when((F.col(branch) == real) & F.col(route).isin(list(routes)), F.lit(zone)).otherwise(out)
    return out


def apply_zones(df: DataFrame, zones: list[Zone], measures: list[str], branch: str = "sucursal",
                route: str = "id_ruta") -> DataFrame:
    """Rename branches by zone, drop the route and add the measures up again."""
    keys = [c for c in df.columns if c not in measures and c != route]
    return (df.withColumn(branch, zone_name(zones, branch, route)).groupBy(*keys)
            .agg(*[F.sum(m).alias(m) for m in measures]))


def expand_branches(branches: DataFrame, zones: DataFrame) -> DataFrame:
    """Branch list plus the virtual zones cut out of them; ``zones`` is (zona, sucursal_real)."""
    extra = zones.join(branches, zones["sucursal_real"] == branches["sucursal"], "left_semi")
    return branches.select("sucursal").union(extra.select("zona")).distinct()


def direct_sales(headquarters: str, branch: str = "sucursal", route: str = "id_ruta",
                 direct_route: int = DIRECT_ROUTE, label: str = "DIRECTA SUCURSALES") -> Column:
    """Branch name with the direct-sales route of every branch but the headquarters set apart."""
    hit = (F.col(route) == direct_route) & (F.col(branch) != headquarters)
    return F.when(hit, F.lit(label)).otherwise(F.col(branch))


def flavour(text: str = "des_articulo", rules=tuple(FLAVOUR_RULES), default: str = "OTRO") -> Column:
    """Flavour from the description, first matching rule wins, case-insensitive."""
    out = F.lit(default)
    for label, patterns in reversed(list(rules)):
        out = F.when(_any([F.col(text).ilike(p) for p in patterns]), F.lit(label)).otherwise(out)
    return out


def package_size(text: str = "des_articulo") -> Column:
    """'NNNcc' from 'NNN x 12' / 'NNN*12', else from a known size in the text, else OTRO."""
    t = F.upper(F.trim(F.col(text)))
    by_pack = F.regexp_extract(t, r"(\d+)\s*[*X]\s*\d+", 1)
    by_size = F.regexp_extract(t, rf"\b({'|'.join(KNOWN_SIZES)})\b", 1)
    return (F.when(by_pack != "", F.concat(by_pack.cast("long").cast("string"), F.lit("cc")))
            .when(by_size != "", F.concat(by_size, F.lit("cc"))).otherwise("OTRO"))


def first_rule(rules: list[tuple[Column, Column | str | None]], default: Column | None = None) -> Column:
    """Label of the first rule whose predicate holds."""
    out = default if default is not None else F.lit(None).cast("string")
    for cond, label in reversed(rules):
        out = F.when(cond, label if isinstance(label, Column) else F.lit(label)).otherwise(out)
    return out


def quota_category(beer: str, house: list[str], house_label: str, own: list[str], multi: list[str], multi_label: str,
                   categories_first: dict[str, str], bitter: Column, bitter_label: str,
                   categories_after: dict[str, str], brands: dict[str, str],
                   category: str = "generico", brand: str = "marca") -> Column:
    """Quota label of a sale, first rule wins; NULL takes no part.

    Beer is settled by brand alone (house brands, own brands by name, multi brands, else none); then come whole
    categories, the bitter flag, more categories and single brands.
    """
    g = F.upper(F.trim(F.coalesce(F.col(category), F.lit(""))))
    m = F.upper(F.trim(F.coalesce(F.col(brand), F.lit(""))))
    rules = [((g == beer) & m.isin(house), house_label), ((g == beer) & m.isin(own), m),
             ((g == beer) & m.isin(multi), multi_label), (g == beer, None)]
    rules += [(g == k, v) for k, v in categories_first.items()] + [(bitter, bitter_label)]
    rules += [(g == k, v) for k, v in categories_after.items()] + [(m == k, v) for k, v in brands.items()]
    return first_rule(rules)


def promo_tier(text: str) -> Column:
    """Promo tier by case-sensitive substring, first hit wins, else the default."""
    return first_rule([(F.col(text).contains(n), lab) for n, lab in PROMO_TIERS], F.lit(PROMO_DEFAULT))


def rename_reps(df: DataFrame, renames: DataFrame, name: str = "vendedor") -> DataFrame:
    """Current rep name; ``renames`` is (viejo, actual) matched trimmed and case-insensitive; NULL gives ''."""
    r = renames.select(F.upper(F.trim("viejo")).alias("_k"), "actual")
    clean = F.trim(F.coalesce(F.col(name), F.lit("")))
    return (df.withColumn("_k", F.upper(clean)).join(r, "_k", "left")
            .withColumn(name, F.coalesce("actual", clean)).drop("_k", "actual"))


def with_supervisor(df: DataFrame, mapping: DataFrame, name: str = "vendedor", default: str = "Sin Supervisor") -> DataFrame:
    """Supervisor of a rep, case-insensitive; ``mapping`` is (vendedor, supervisor, orden).

    A rep listed twice takes the last entry; ``duplicates`` of :func:`supervisor_duplicates` reports them.
    """
    m = (mapping.groupBy(F.upper("vendedor").alias("_k")).agg(F.max_by("supervisor", "orden").alias("supervisor")))
    return (df.withColumn("_k", F.upper(name)).join(m, "_k", "left").drop("_k")
            .withColumn("supervisor", F.coalesce("supervisor", F.lit(default))))


def supervisor_duplicates(mapping: DataFrame) -> DataFrame:
    """Reps claimed by more than one supervisor."""
    return (mapping.groupBy(F.upper("vendedor").alias("vendedor")).agg(F.count_distinct("supervisor").alias("n"))
            .filter("n > 1"))


def by_label(df: DataFrame, mapping: DataFrame, label: str, key: str, value: str) -> DataFrame:
    """Look ``label`` up in ``mapping`` as it is, then without its leading 'N - ' prefix."""
    m = mapping.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    bare = F.regexp_replace(label, r"^\s*\d+\s*-\s*", "")
    full = m.withColumnsRenamed({"_k": "_k1", "_v": "_v1"})
    return (df.join(full, F.col(label) == F.col("_k1"), "left").join(m, bare == F.col("_k"), "left")
            .withColumn(value, F.coalesce("_v1", "_v")).drop("_k", "_k1", "_v", "_v1"))


def blank_to_null(col: str) -> Column:
    return F.nullif(F.trim(F.col(col)), F.lit(""))


def client_name(trade: str = "fantasia", legal: str = "razon_social", ident: str = "id_cliente",
                need_alnum: bool = False) -> Column:
    """Display name: trade name, legal name, id.  ``need_alnum`` also refuses filler made of dashes only."""
    t = blank_to_null(trade)
    if need_alnum:
        t = F.when(F.trim(F.col(trade)).rlike(r"\p{Alnum}"), t)
    return F.coalesce(t, blank_to_null(legal), F.col(ident).cast("string"))


def document_key() -> Column:
    """Document number as printed: id + letter + 4-digit series + 8-digit number."""
    return F.concat("id_documento", "letra", F.lpad(F.col("serie").cast("string"), 4, "0"),
                    F.lpad(F.col("nro_doc").cast("string"), 8, "0"))


def repair_swapped(df: DataFrame) -> DataFrame:
    """Coverage quotas with the name read from whichever column carries it; rows without a name are dropped."""
    return df.withColumn("concepto", F.coalesce("marca", "generico")).filter("concepto is not null")


def map_label(df: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Left join to a small label table; unknown ids stay blank."""
    return df.join(mapping.select(key, value), key, "left")


def partition_check(sales: DataFrame, mapping: DataFrame, branch: str = "sucursal") -> DataFrame:
    """Branches with movement that several supervisors claim ('repetida') or none does ('huerfana')."""
    moved = sales.select(branch).distinct()
    n = mapping.groupBy(branch).agg(F.count_distinct("supervisor").alias("n"))
    return (moved.join(n, branch, "left")
            .withColumn("problema", F.when(F.col("n") > 1, "repetida").when(F.col("n").isNull(), "huerfana"))
            .filter("problema is not null").select(branch, "problema"))


def missing_factor(articles: DataFrame, category: str | None = None) -> DataFrame:
    """SKUs whose conversion factor is missing or zero."""
    out = articles.filter(F.col("factor_hectolitros").isNull() | (F.col("factor_hectolitros") == 0))
    return in_values(out, "generico", [category] if category else None).select("id_articulo", "des_articulo", "marca")


def sold_without_factor(sales: DataFrame, factors: DataFrame, qty: str = "cantidades_total") -> DataFrame:
    """SKUs with a non-zero net sale and no entry in the factor table."""
    sold = sales.groupBy("id_articulo").agg(F.sum(qty).alias("_q")).filter("_q <> 0")
    return sold.join(factors.select("id_articulo"), "id_articulo", "left_anti").select("id_articulo")


def working_lines(df: DataFrame, non_merchandise: list[str], keep_null_category: bool, void: bool | None = False,
                  documents: list[str] | None = None) -> DataFrame:
    """Base filter of the analytics families: documents, void flag and merchandise only.

    ``keep_null_category`` keeps lines of SKUs without category; ``void=None`` leaves voided documents in.
    """
    keep = ~F.col("generico").isin(non_merchandise) if non_merchandise else F.lit(True)
    keep = F.coalesce(keep, F.lit(True)) if keep_null_category else (F.col("generico").isNotNull() & keep)
    out = df.filter(F.col("id_documento").isin(documents or SALE_DOCUMENTS)).filter(keep)
    return out if void is None else out.filter(F.col("anulado") == void)
