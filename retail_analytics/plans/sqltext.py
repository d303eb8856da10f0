"""Building blocks of the oracle SQL (DuckDB)."""
from __future__ import annotations

from retail_analytics.functions.shape import slug

M0, M1 = "2001-06-01", "2001-06-30"
JUNE = f"fecha_comprobante BETWEEN '{M0}' AND '{M1}'"

COBL = """cobl AS (SELECT date_trunc('month',fecha_comprobante)::DATE periodo, 1::BIGINT id_fuerza_ventas, id_sucursal, sucursal ds_sucursal,
  id_personal_fv1 id_vendedor, id_ruta, des_personal_fv1 vendedor, id_lista_precio, generico, marca, id_articulo, des_articulo, id_cliente, cantidades_total FROM l
UNION ALL SELECT date_trunc('month',fecha_comprobante)::DATE, 4, id_sucursal, sucursal, id_personal_fv4, id_ruta_fv4, des_personal_fv4,
  id_lista_precio, generico, marca, id_articulo, des_articulo, id_cliente, cantidades_total FROM l)"""


def cov(cut: str, src: str, qty: str = "cantidades_total", thr: float = 0, having: bool = True) -> str:
    """Sub-select: clients with a net above the threshold and their volume, per cut."""
    c = f"{cut}, " if cut else ""
    inner = f"SELECT {c}id_sucursal xs, id_cliente xc, sum({qty}) n FROM {src} GROUP BY ALL"
    if having:
        return f"(SELECT {c}count(*) clientes, sum(n) volumen FROM ({inner} HAVING sum({qty})>{thr}) GROUP BY ALL)"
    return f"(SELECT {c}count(*) FILTER (n>{thr}) clientes, sum(n) volumen FROM ({inner}) GROUP BY ALL)"


def wide(col: str, values, measures: dict[str, str], zero: bool = True) -> str:
    """Columns ``<prefix>_<value>`` as filtered sums."""
    out = []
    for p, m in measures.items():
        for v in values:
            lit = f"'{v}'" if isinstance(v, str) else str(v)
            s = f"sum(CASE WHEN {col}={lit} THEN {m} END)"
            out.append(f"coalesce({s},0) {p}_{slug(v)}" if zero else f"{s} {p}_{slug(v)}")
    return ", ".join(out)


def names(values, *prefixes: str) -> str:
    return " ".join(f"{p}_{slug(v)}" for p in prefixes for v in values)


def smoothed_sql(source: str, grid: int) -> str:
    """CTEs of a recursive query: ``best`` (k, y, a, b, g, lev, tr, sea, sse, pct, hits) from ``source`` (k, y)."""
    rates = [0.1 + 0.8 * i / (grid - 1) for i in range(grid)]
    return f"""gr AS (SELECT unnest({rates})::DOUBLE r), st AS (SELECT k, y, x.r a, z.r b, w.r g, list_avg(y[1:12]) lev, (list_avg(y[13:24])-list_avg(y[1:12]))/12 tr FROM {source}, gr x, gr z, gr w WHERE len(y)>24),
hw AS (SELECT k, y, a, b, g, 0 i, lev, tr, list_transform(y[1:12], lambda v: v-lev) sea, 0::DOUBLE sse, 0::DOUBLE pct, 0 hits FROM st
 UNION ALL SELECT k, y, a, b, g, i+1, nl, b*(nl-lev)+(1-b)*tr, list_append(sea[2:12], g*(v-nl)+(1-g)*sea[1]), sse+CASE WHEN i>=12 THEN pow(v-(lev+tr+sea[1]),2) ELSE 0 END, pct+CASE WHEN i>=12 AND v<>0 THEN abs((v-(lev+tr+sea[1]))/v) ELSE 0 END, hits+CASE WHEN i>=12 AND v<>0 THEN 1 ELSE 0 END
 FROM (SELECT *, y[i+1] v, a*(y[i+1]-sea[1])+(1-a)*(lev+tr) nl FROM hw WHERE i<len(y))),
best AS (SELECT DISTINCT ON (k) * FROM hw WHERE i=len(y) ORDER BY k, sse, a, b, g)"""


def erf_sql(x: str) -> str:
    """Error function of a value that is not negative, by the logarithms of its series' terms."""
    terms = "list_sum(list_transform(range(0,121), lambda n: exp(n*ln(2*x*x)-(lgamma(2*n+2)-n*ln(2)-lgamma(n+1)))))"
    return f"(SELECT CASE WHEN x>6 THEN 1 WHEN x=0 THEN 0 ELSE 2/sqrt(pi())*exp(-x*x)*x*{terms} END FROM (SELECT {x} x))"
