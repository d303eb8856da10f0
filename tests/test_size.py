"""What the driver holds: queries over tables whose files are small, but not the rows that they stand for."""
import pytest
from pyspark.sql import functions as F

from retail_analytics.operators import coverage as cv
from retail_analytics.plans import load_all

NATIONS, PARTS, SUPPLIERS, CUSTOMERS, ORDERS = 5, 20_000, 2_000, 300, 600
MOST = 5_000                       # rows of the largest frame that may be broadcast: the dimensions that stay small


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("star")
    made = {
        "region": "SELECT cast(0 as int) r_regionkey, 'REGION_0' r_name",
        "nation": f"SELECT cast(id as int) n_nationkey, concat('NATION_', id) n_name, cast(0 as int) n_regionkey FROM range({NATIONS})",
        "part": f"SELECT id p_partkey, element_at(array('blue bolt gear', 'red nut small', 'iron plate', 'zinc wire'), cast(id % 4 + 1 as int)) p_name, concat('Brand#', id % 3) p_brand, "
                f"element_at(array('PROMO', 'LARGE', 'SMALL'), cast(id % 3 + 1 as int)) p_type, cast(id % 50 + 1 as int) p_size, cast(id % 9 + 1 as double) p_retailprice FROM range({PARTS})",
        "supplier": f"SELECT id s_suppkey, 'Supplier#000000001' s_name, cast(id % {NATIONS} as int) s_nationkey, 1.0D s_acctbal FROM range({SUPPLIERS})",
        "customer": f"SELECT id c_custkey, concat('Customer#', id) c_name, cast(id % {NATIONS} as int) c_nationkey, 1.0D c_acctbal, 'BUILDING' c_mktsegment FROM range({CUSTOMERS})",
        "orders": f"SELECT id o_orderkey, id % {CUSTOMERS} o_custkey, 'O' o_orderstatus, 1.0D o_totalprice, timestamp'2001-06-05 00:00:00' o_orderdate, '1-URGENT' o_orderpriority FROM range({ORDERS})",
        "lineitem": f"SELECT id l_orderkey, id * 7 % {PARTS} l_partkey, id * 3 % {SUPPLIERS} l_suppkey, cast(1 as int) l_linenumber, cast(id % 9 + 1 as double) l_quantity, cast(id % 90 + 200000 as double) l_extendedprice, "
                    f"cast(id % 5 as double) / 50 l_discount, 0.0D l_tax, if(id % 10 = 0, 'R', 'N') l_returnflag, 'F' l_linestatus, timestamp'2001-06-09 00:00:00' l_shipdate FROM range({ORDERS})"}
    for name, sql in made.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def broadcast_rows(node) -> list[int]:
    """Rows of every frame that a plan, as it ran, sent through the driver."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return broadcast_rows(node.executedPlan())
    if "QueryStage" in name:
        return broadcast_rows(node.plan())
    below = [node.children().apply(k) for k in range(node.children().size())] + [node.subqueries().apply(k).child() for k in range(node.subqueries().size())]
    if name == "InMemoryTableScan":
        below.append(node.relation().cacheBuilder().cachedPlan())
    own = [node.metrics().apply("numOutputRows").value()] if name == "BroadcastExchange" else []
    return own + [n for b in below for n in broadcast_rows(b)]


def ran(spark, tables, name, limit) -> tuple[list, list[int]]:
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        df = load_all()[name].run(spark, tables)
        rows = sorted(map(repr, df.collect()))
        return rows, broadcast_rows(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set(key, was)


LARGE = ["e1_snapshot", "e14_all_articles_snapshot", "e15_closest_article", "e9_valuation", "e10_article_valuation_matrix", "e10_category_valuation_matrix", "e11_branch_valuation", "e12_capital_abc", "e13_control_frames", "e3_snapshot_matrix", "e4_unmatched_sales"]
SMALLER = ["j6_discount_outliers"]            # the names of the reps come from a file of 10 KB


@pytest.mark.parametrize("name, limit", [(n, "120k") for n in LARGE] + [(n, "25k") for n in SMALLER])
def test_large_frames_are_not_broadcast(spark, tables, name, limit):
    """Grids made of a small file, and catalogues that unpack to many rows, are shuffled; the rows stay the same."""
    rows, sent = ran(spark, tables, name, limit)
    assert rows and max(sent, default=0) <= MOST
    assert rows == ran(spark, tables, name, "100m")[0]


def test_coverage_tables_shuffle_lines_not_table_rows(spark, tables):
    """All tables come out of one dealing of the lines by month and branch."""
    plan = load_all()["c1_coverage_tables"].run(spark, tables)._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "periodo" in x]
    assert len(dealt) == 1 and "generico" not in dealt[0]


def test_coverage_tables_equal_each_table(spark):
    """Missing clients, reps, categories and branches, and nets that are not positive, count as in the single tables."""
    columns = ("fecha_comprobante string, id_sucursal long, sucursal string, id_cliente long, id_personal_fv1 long, id_ruta long, des_personal_fv1 string, id_personal_fv4 long, "
               "id_ruta_fv4 long, des_personal_fv4 string, id_lista_precio long, generico string, marca string, id_articulo long, des_articulo string, cantidades_total double")
    rows = [(f"2001-0{1 + k % 3}-05" if k % 17 else None, k % 3 if k % 13 else None, f"S{k % 3}" if k % 13 else None, k % 7 if k % 11 else None, k % 2 if k % 5 else None, k % 4, "x", k % 3, k % 2, "y",
             k % 2, f"G{k % 3}" if k % 7 else None, f"M{k % 4}", k, "d", float(k % 6 - 2)) for k in range(400)]
    lines = spark.createDataFrame(rows, columns).withColumn("fecha_comprobante", F.col("fecha_comprobante").cast("date"))
    whole = cv.coverage_tables(lines)
    for name, cut in cv.TABLES.items():
        pick = [*cut, "clientes_compradores", "volumen_total"]
        one, part = cv.coverage_table(lines, name).select(*pick), whole.filter(F.col("tabla") == name)
        others = [c for c in whole.columns if c not in (*pick, "tabla")]
        assert sorted(map(repr, one.collect())) == sorted(map(repr, part.select(*pick).collect())) and part.count() > 0
        assert all(r[c] is None for r in part.select(*others).collect() for c in others)
