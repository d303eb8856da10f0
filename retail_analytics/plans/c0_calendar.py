"""C0: calendars and window resolution."""
from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from retail_analytics.operators import calendar as cal, filters as fl
from retail_analytics.plans.registry import query

AS_OF = date(2001, 6, 20)
HOLIDAYS = {date(2001, 6, 20), date(2001, 6, 16), date(2001, 6, 17), date(2001, 5, 25), date(2001, 1, 1)}
DAYS = """d AS (SELECT unnest(generate_series(DATE '2001-01-01', DATE '2001-12-31', INTERVAL 1 DAY))::DATE fecha),
h AS (SELECT fecha, date_trunc('month',fecha)::DATE mes, (dayofweek(fecha)<>0 AND fecha NOT IN (SELECT fecha FROM feriados)) habil FROM d)"""


def window_total(s, desde, hasta):
    """Sales inside a resolved window, so that the window meets the data."""
    return fl.dates(s.ventas, str(desde), str(hasta)).agg(
        F.lit(str(desde)).alias("desde"), F.lit(str(hasta)).alias("hasta"), F.count(F.lit(1)).alias("lineas"),
        F.coalesce(F.sum("cantidades_total"), F.lit(0.0)).alias("cantidad"))


def wsql(desde: str, hasta: str) -> str:
    return (f"SELECT '{desde}' desde, '{hasta}' hasta, count(*) lineas, coalesce(sum(cantidades_total),0) cantidad "
            f"FROM fv WHERE fecha_comprobante BETWEEN '{desde}' AND '{hasta}'")


@query("c0a_working_days", i="dias_totales dias_transcurridos", f="cantidad", sql=DAYS + """
SELECT mes, count(*) FILTER (habil) dias_totales, count(*) FILTER (habil AND fecha<='2001-06-20') dias_transcurridos,
 (SELECT sum(cantidades_total) FROM fv WHERE date_trunc('month',fecha_comprobante)::DATE=mes) cantidad
FROM h WHERE fecha BETWEEN '2001-04-01' AND '2001-07-31' GROUP BY 1""")
def _(s):
    m = cal.month_calendar(s.spark, "2001-04-10", "2001-07-05", s.feriados, str(AS_OF))
    v = (fl.dates(s.ventas, "2001-04-01", "2001-07-31").groupBy(F.trunc("fecha_comprobante", "MM").alias("mes"))
         .agg(F.sum("cantidades_total").alias("cantidad")))
    return m.join(v, "mes", "left")


@query("c0b_run_rate", f="factor cantidad tendencia", i="dias_habiles dias_transcurridos dias_faltantes", sql=DAYS + """,
r AS (SELECT count(*) FILTER (habil) dias_habiles, count(*) FILTER (habil AND fecha BETWEEN '2001-06-01' AND '2001-06-20') dias_transcurridos
  FROM h WHERE mes='2001-06-01'),
v AS (SELECT sucursal, sum(cantidades_total) cantidad FROM l WHERE fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-20' GROUP BY 1)
SELECT v.*, dias_habiles, dias_transcurridos, dias_habiles-dias_transcurridos dias_faltantes, dias_habiles/dias_transcurridos factor,
 cantidad*(dias_habiles/dias_transcurridos) tendencia FROM v CROSS JOIN r""")
def _(s):
    from retail_analytics.functions.grid import with_scalars
    v = fl.dates(s.lineas, "2001-06-01", str(AS_OF)).groupBy("sucursal").agg(F.sum("cantidades_total").alias("cantidad"))
    r = cal.run_rate(s.spark, "2001-06-01", "2001-06-30", s.feriados, str(AS_OF))
    return with_scalars(v, r).withColumn("tendencia", F.col("cantidad") * F.col("factor"))


@query("c0c_previous_month", f="cantidad", sql=wsql("2001-05-01", "2001-05-31"))
def _(s):
    return window_total(s, *cal.previous_month(AS_OF))


@query("c0c_year_earlier", f="cantidad", sql=wsql("2000-05-01", "2000-06-30"))
def _(s):
    return window_total(s, *cal.same_months_last_year(date(2001, 5, 10), AS_OF))


@query("c0c_shifted_window", f="cantidad", sql=wsql("2001-02-10", "2001-02-28"))
def _(s):
    return window_total(s, *cal.shifted_month_window(date(2001, 3, 10), date(2001, 3, 31), 1))


@query("c0d_moving_window", f="cantidad", sql=wsql("2001-04-01", "2001-06-20"))
def _(s):
    return window_total(s, *cal.report_window("ventana_movil", AS_OF, HOLIDAYS, 3))


@query("c0d_month_to_date", f="cantidad", sql=wsql("2001-05-01", "2001-05-31"))
def _(s):
    return window_total(s, *cal.report_window("mes_a_hoy", date(2001, 6, 1), HOLIDAYS))


@query("c0e_mirror_window", f="cantidad", sql=wsql("1999-06-20", "2000-06-24"))
def _(s):
    a, b, n = cal.mirror_window(date(2000, 6, 25), date(2001, 6, 30))
    assert n == (b - a).days + 1
    return window_total(s, a, b)


@query("c0f_complete_months", i="lineas", sql="""m AS (SELECT unnest(generate_series(DATE '2001-02-01', DATE '2001-05-01', INTERVAL 1 MONTH))::DATE mes)
SELECT mes, count(id) lineas FROM m LEFT JOIN fv ON date_trunc('month',fecha_comprobante)::DATE=mes GROUP BY 1""")
def _(s):
    m = cal.complete_months(s.spark, "2001-01-15", "2001-06-20")
    v = s.ventas.select(F.trunc("fecha_comprobante", "MM").alias("mes"), "id")
    return m.join(v, "mes", "left").groupBy("mes").agg(F.count("id").alias("lineas"))


@query("c0g_closed_month", i="dias_faltantes", sql=DAYS + """,
c AS (SELECT max(fecha_comprobante) corte FROM fv WHERE fecha_comprobante<='2001-06-20')
SELECT corte, day(corte)>=0.95*day(last_day(corte)) cerrado,
 (SELECT count(*) FILTER (habil) FROM h WHERE fecha>'2001-06-20' AND fecha<='2001-06-30') dias_faltantes FROM c""")
def _(s):
    from retail_analytics.functions.grid import with_scalars
    c = s.ventas.filter("fecha_comprobante <= '2001-06-20'").agg(F.max("fecha_comprobante").alias("corte"))
    c = c.withColumn("cerrado", cal.is_closed_month(F.col("corte")))
    return with_scalars(c, cal.missing_working_days(s.spark, "2001-06-20", s.feriados))


@query("c0h_last_full_months", f="cantidad", sql=wsql("2001-03-01", "2001-05-31"))
def _(s):
    return window_total(s, *cal.full_months_before(AS_OF, 3))


@query("c0i_last_sale_days", sql="""SELECT DISTINCT fecha_comprobante fecha FROM fv WHERE fecha_comprobante BETWEEN '2001-06-01' AND '2001-06-20'
AND dayofweek(fecha_comprobante)<>0 AND fecha_comprobante NOT IN (SELECT fecha FROM feriados) ORDER BY 1 DESC LIMIT 2""")
def _(s):
    return cal.last_sale_days(fl.dates(s.ventas, "2001-06-01", str(AS_OF)), s.feriados, 2)


@query("c0i_display_days", f="cantidad", sql="SELECT fecha_comprobante fecha, sum(cantidades_total) cantidad FROM fv WHERE fecha_comprobante IN ('2001-06-18','2001-06-16') GROUP BY 1")
def _(s):
    days = cal.display_days(date(2001, 6, 1), date(2001, 6, 30), date(2001, 6, 18))
    return (s.ventas.filter(F.col("fecha_comprobante").isin(list(days)))
            .groupBy(F.col("fecha_comprobante").alias("fecha")).agg(F.sum("cantidades_total").alias("cantidad")))


# branches of a fifth have a holiday of their own; the gap of a line is the working days from its order to its delivery
@query("c0b_delivery_gaps", i="dias lineas", sql="""b AS (SELECT id_sucursal, unnest(generate_series(DATE '1994-12-01', DATE '2002-03-01', INTERVAL 1 DAY))::DATE fecha FROM suc),
w AS (SELECT * FROM b WHERE dayofweek(fecha)<>0 AND fecha NOT IN (SELECT fecha FROM feriados) AND NOT (id_sucursal%5=0 AND fecha=DATE '2001-06-21')),
r AS (SELECT b.*, count(w.fecha) OVER (PARTITION BY b.id_sucursal ORDER BY b.fecha) n FROM b LEFT JOIN w USING (id_sucursal, fecha))
SELECT f.id_sucursal, e.n-p.n dias, count(*) lineas FROM fv f JOIN r p ON p.id_sucursal=f.id_sucursal AND p.fecha=f.fecha_pedido JOIN r e ON e.id_sucursal=f.id_sucursal AND e.fecha=f.fecha_entrega GROUP BY 1,2""")
def _(s):
    own = s.sucursal.filter("id_sucursal % 5 = 0").select("id_sucursal", F.lit("2001-06-21").cast("date").alias("fecha"))
    holidays = s.feriados.select(F.lit(None).cast("long").alias("id_sucursal"), "fecha").unionByName(own)
    ranks = cal.working_ranks(s.spark, "1994-12-01", "2002-03-01", holidays, s.sucursal)
    # one row per branch: a dimension
    gaps = s.ventas.select("id_sucursal", "fecha_pedido", "fecha_entrega").join(F.broadcast(ranks), "id_sucursal")
    return gaps.groupBy("id_sucursal", cal.working_days_between(F.col("fecha_pedido"), F.col("fecha_entrega")).alias("dias")).agg(F.count(F.lit(1)).alias("lineas"))
