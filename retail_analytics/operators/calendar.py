"""Working-day calendars and report windows.

Windows are a handful of dates of one run, so they are plain ``datetime`` values; everything that touches a
table (calendars per month, day counts, days with sales) is a DataFrame.
"""
from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retail_analytics.functions.grid import complete_grid


def days(spark: SparkSession, desde: str, hasta: str, holidays: DataFrame) -> DataFrame:
    """One row per day of the range with the working-day flag (Monday to Saturday, no holiday)."""
    d = spark.sql(f"SELECT explode(sequence(DATE'{desde}', DATE'{hasta}')) AS fecha")
    h = holidays.select("fecha", F.lit(True).alias("_f")).distinct()
    work = (F.dayofweek("fecha") != 1) & F.col("_f").isNull()
    return d.join(h, "fecha", "left").select("fecha", F.trunc("fecha", "MM").alias("mes"), work.alias("habil"))


def month_calendar(spark: SparkSession, desde: str, hasta: str, holidays: DataFrame, as_of: str) -> DataFrame:
    """Working days per month: total and elapsed up to ``as_of`` inclusive."""
    a, b = whole_month(date.fromisoformat(desde))[0], whole_month(date.fromisoformat(hasta))[1]
    return (days(spark, str(a), str(b), holidays).groupBy("mes")
            .agg(F.count_if("habil").alias("dias_totales"),
                 F.count_if(F.col("habil") & (F.col("fecha") <= F.lit(as_of).cast("date"))).alias("dias_transcurridos")))


def working_ranks(spark: SparkSession, desde: str, hasta: str, holidays: DataFrame, places: DataFrame | None = None, key: str = "id_sucursal") -> DataFrame:
    """(inicio, rangos), or one such row per ``key`` of ``places``: ``rangos[i]`` is the number of working days up to day i after
    ``inicio``, the day before ``desde``, so the working days between two dates are two lookups.

    ``holidays`` has the days of everybody, and days of one place where it has the column ``key`` with a value.  The arrays
    are bounded by the calendar and the places; they travel with the rows instead of a join with the days.
    """
    one = spark.sql(f"SELECT explode(sequence(DATE'{desde}', DATE'{hasta}')) AS fecha")
    own = key in holidays.columns
    common = (holidays.filter(F.col(key).isNull()) if own else holidays).select("fecha").distinct().withColumn("_f", F.lit(True))
    d = one.join(common, "fecha", "left").withColumn("_w", (F.dayofweek("fecha") != 1) & F.col("_f").isNull())
    by = []
    if places is not None:
        by = [key]
        d = complete_grid(places.select(key).distinct(), d.select("fecha", "_w"))
        if own:
            d = d.join(holidays.filter(F.col(key).isNotNull()).select(key, "fecha").distinct().withColumn("_h", F.lit(True)), [key, "fecha"], "left")
            d = d.withColumn("_w", F.col("_w") & F.col("_h").isNull())
    flags = d.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("fecha", "_w"))), lambda x: x["_w"].cast("int")).alias("_d"))
    sums = F.aggregate("_d", F.array(F.lit(0)), lambda s, w: F.concat(s, F.array(F.element_at(s, -1) + w)))
    return flags.select(*by, F.date_sub(F.lit(desde).cast("date"), 1).alias("inicio"), sums.alias("rangos"))


def rank_of(day: Column) -> Column:
    """Working days up to ``day``, from the columns of :func:`working_ranks`; days outside count as its ends."""
    i = F.datediff(day, F.col("inicio"))
    return F.get("rangos", F.greatest(F.least(i, F.size("rangos") - 1), F.lit(0)))


def working_days_between(a: Column, b: Column) -> Column:
    """Working days after ``a`` up to ``b`` inclusive; negative when ``b`` is before ``a``."""
    return rank_of(b) - rank_of(a)


def run_rate(spark: SparkSession, desde: str, hasta: str, holidays: DataFrame, as_of: str) -> DataFrame:
    """One row: working days of the month of ``hasta``, elapsed inside the window, missing, and the factor."""
    m0, m1 = whole_month(date.fromisoformat(hasta))

    def before(d: date) -> Column:
        return F.lit(str(d - timedelta(days=1))).cast("date")
    first = max(date.fromisoformat(desde), m0)
    seen = working_days_between(before(first), F.greatest(F.lit(min(as_of, hasta)).cast("date"), before(first)))
    return (working_ranks(spark, str(m0), str(m1), holidays)
            .select(working_days_between(before(m0), F.lit(str(m1)).cast("date")).cast("long").alias("dias_habiles"), seen.cast("long").alias("dias_transcurridos"))
            .withColumn("dias_faltantes", F.col("dias_habiles") - F.col("dias_transcurridos"))
            .withColumn("factor", F.coalesce(F.try_divide(F.col("dias_habiles").cast("double"),
                                                          F.col("dias_transcurridos").cast("double")), F.lit(1.0))))


# -- month arithmetic on plain dates ----------------------------------------------------------------------------
def whole_month(d: date) -> tuple[date, date]:
    first = d.replace(day=1)
    return first, (first + timedelta(days=32)).replace(day=1) - timedelta(days=1)


def months_back(d: date, n: int) -> date:
    """First day of the month ``n`` months before the month of ``d``."""
    if n < 0:
        raise ValueError("n must be >= 0")
    k = d.year * 12 + d.month - 1 - n
    return date(k // 12, k % 12 + 1, 1)


def previous_month(d: date) -> tuple[date, date]:
    return whole_month(months_back(d, 1))


def months_spanned(desde: date, hasta: date) -> int:
    """Calendar months touched by an inclusive range; an inverted range is an error."""
    if hasta < desde:
        raise ValueError("inverted range")
    return (hasta.year - desde.year) * 12 + hasta.month - desde.month + 1


def same_months_last_year(desde: date, hasta: date) -> tuple[date, date]:
    """Whole months of the range, one year earlier."""
    return whole_month(months_back(desde, 12))[0], whole_month(months_back(hasta, 12))[1]


def shifted_month_window(desde: date, hasta: date, months: int) -> tuple[date, date]:
    """The same days ``months`` months earlier, clipped to the length of the target month."""
    def move(d: date) -> date:
        a, b = whole_month(months_back(d, months))
        return min(a + timedelta(days=d.day - 1), b)
    return move(desde), move(hasta)


def is_working(d: date, holidays: set[date]) -> bool:
    return d.weekday() != 6 and d not in holidays


def is_first_working_day(d: date, holidays: set[date]) -> bool:
    return is_working(d, holidays) and not any(
        is_working(d.replace(day=k), holidays) for k in range(1, d.day))


def report_window(mode: str, today: date, holidays: set[date], months: int | None = None) -> tuple[date, date]:
    """Window of a report: ``mes_a_hoy`` (inclusive), ``mes_completo`` (end exclusive), ``hoy``, ``ventana_movil``.

    On the first working day of a month the month modes deliver the closed previous month.
    """
    if mode == "hoy":
        return today, today
    if mode == "ventana_movil":
        if not months or months < 1:
            raise ValueError("ventana_movil needs its width in months")
        return months_back(today, months - 1), today
    first = is_first_working_day(today, holidays)
    if mode == "mes_a_hoy":
        return previous_month(today) if first else (today.replace(day=1), today)
    if mode == "mes_completo":
        return (months_back(today, 1), today.replace(day=1)) if first else (today.replace(day=1), today + timedelta(days=1))
    raise ValueError(f"unknown window mode {mode!r}")


def mirror_window(desde: date, hasta: date) -> tuple[date, date, int]:
    """Window of the same length that ends the day before ``desde``, and the length in days."""
    n = (hasta - desde).days + 1
    return desde - timedelta(days=n), desde - timedelta(days=1), n


def last_full_month(hasta: date) -> date:
    """Last day of the last month that is complete at ``hasta``."""
    end = whole_month(hasta)[1]
    return end if end == hasta else hasta.replace(day=1) - timedelta(days=1)


def full_months_before(hasta: date, n: int) -> tuple[date, date]:
    """``n`` whole months that end with the last full month at ``hasta``."""
    end = last_full_month(hasta)
    return months_back(end, n - 1), end


# -- the same rules on columns ------------------------------------------------------------------------------------
def complete_months(spark: SparkSession, desde: str, hasta: str) -> DataFrame:
    """Months that lie entirely inside the range."""
    m = spark.sql(f"SELECT explode(sequence(trunc(DATE'{desde}','MM'), DATE'{hasta}', interval 1 month)) AS mes")
    return m.filter((F.col("mes") >= F.lit(desde).cast("date")) & (F.last_day("mes") <= F.lit(hasta).cast("date")))


def is_closed_month(cut: Column, share: float = 0.95) -> Column:
    """A month counts as closed when at least ``share`` of its calendar days are loaded at ``cut``."""
    return F.dayofmonth(cut) >= F.dayofmonth(F.last_day(cut)) * F.lit(share)


def missing_working_days(spark: SparkSession, cut: str, holidays: DataFrame) -> DataFrame:
    """Working days between the cut and the end of its month."""
    m0, m1 = whole_month(date.fromisoformat(cut))
    return (days(spark, str(m0), str(m1), holidays)
            .agg(F.count_if(F.col("habil") & (F.col("fecha") > F.lit(cut).cast("date"))).alias("dias_faltantes")))


def display_days(desde: date, hasta: date, today: date) -> tuple[date, date]:
    """Current and previous day shown by the summary; a previous day that is a Sunday becomes the Saturday."""
    cur = today if desde <= today <= hasta else hasta
    prev = cur - timedelta(days=1)
    return cur, prev - timedelta(days=1) if prev.weekday() == 6 else prev


def quarters(desde: date, hasta: date) -> list[str]:
    """Quarters 'YYYY-Qn' touched by the range, in order."""
    a, b = (d.year * 4 + (d.month - 1) // 3 for d in (desde, hasta))
    return [f"{k // 4}-Q{k % 4 + 1}" for k in range(a, b + 1)]


def month_start_from(d: date) -> date:
    """The date itself when it opens a month, else the first of the next month."""
    return d if d.day == 1 else whole_month(d)[1] + timedelta(days=1)


def last_sale_days(sales: DataFrame, holidays: DataFrame, n: int = 2, col: str = "fecha_comprobante") -> DataFrame:
    """Last ``n`` working days that have sales, newest first (the limit is the operator: a top-n)."""
    d = sales.select(F.col(col).alias("fecha")).distinct().filter(F.dayofweek("fecha") != 1)
    return d.join(holidays.select("fecha"), "fecha", "left_anti").orderBy(F.desc("fecha")).limit(n)
