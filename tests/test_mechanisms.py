"""Incremental refresh, quarantine, checks on the way, heavy keys, bitmap cohorts and range checksums."""
import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from retail_analytics.functions import checksums, skew
from retail_analytics.operators import clients as cl, cohorts, recon
from retail_analytics.sources import checked, incremental, quarantine


def load(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, "mes string, k string, v double").repartition(1).write.mode(mode).partitionBy("mes").parquet(path)


def summed(df):
    return sorted((r.mes, r.k, r.v) for r in df.collect())


def test_refresh_computes_the_changed_month_alone(spark, tmp_path):
    source, built = f"{tmp_path}/fact", []

    def build(rows):
        built.append({r.mes for r in rows.select("mes").distinct().collect()})
        return rows.groupBy("mes", "k").agg(F.sum("v").alias("v"))

    months = [f"2001-{m:02d}" for m in range(1, 7)]
    load(spark, source, [(m, k, float(i)) for i, m in enumerate(months) for k in "abab"])
    table = incremental.MonthlyTable(spark, f"{tmp_path}/view", build)
    assert table.refresh(source) == months and built == [set(months)]
    before = table.read()
    assert table.refresh(source) == [] and len(built) == 1                      # nothing changed: nothing read
    load(spark, source, [("2001-03", "c", 5.0)])
    assert table.refresh(source) == ["2001-03"] and built[1:] == [{"2001-03"}]
    written = sorted(p.name for v in (tmp_path / "view/data").iterdir() for p in v.iterdir() if p.name.startswith("mes="))
    assert written == sorted([f"mes={m}" for m in months] + ["mes=2001-03"])      # six, then one
    want = sorted((m, k, 2.0 * i) for i, m in enumerate(months) for k in "ab") + [("2001-03", "c", 5.0)]
    assert summed(table.read()) == sorted(want)
    assert summed(before) == sorted(want[:-1])                                    # a reader keeps what it opened


def test_refresh_drops_months_that_left(spark, tmp_path):
    source = f"{tmp_path}/fact"
    load(spark, source, [("2001-01", "a", 1.0), ("2001-02", "a", 2.0)])
    table = incremental.MonthlyTable(spark, f"{tmp_path}/view", lambda r: r.groupBy("mes", "k").agg(F.sum("v").alias("v")))
    table.refresh(source)
    other = f"{tmp_path}/other"
    load(spark, other, [("2001-02", "a", 7.0)])
    assert table.refresh(other) == ["2001-02"] and summed(table.read()) == [("2001-02", "a", 7.0)]


PRICES = StructType([StructField("id", LongType()), StructField("precio", DoubleType()), StructField("texto", StringType())])


def test_quarantine_gives_every_row_back(spark, tmp_path):
    lines = {"a.csv": ["id,precio,texto", "1,2.5,x", '2,3.5,"a,b"', "3,4.5", "id,precio,texto", "x,1.0,y"], "b.csv": ["id,precio,texto", "4,,z", "5,1,2,3", "6,-1,q", "7,abc,", ""]}
    (tmp_path / "in").mkdir()
    for name, rows in lines.items():
        (tmp_path / "in" / name).write_text("\n".join(rows))
    rows = quarantine.read_all(spark, f"{tmp_path}/in", PRICES, ["precio"], checks={"precio no positivo": F.col("precio") > 0})
    good, bad = quarantine.split(rows, f"{tmp_path}/out")
    assert sorted((r.id, r.precio, r.texto) for r in good.collect()) == [(1, 2.5, "x"), (2, 3.5, "a,b")]
    assert {(r.motivo, r._crudo) for r in bad.collect()} == {
        ("faltan columnas", "3,4.5"), ("encabezado repetido", "id,precio,texto"), ("tipo invalido: id", "x,1.0,y"), ("falta precio", None),
        ("sobran columnas", "5,1,2,3"), ("precio no positivo", None), ("tipo invalido: precio", "7,abc,")}


def test_checks_ride_along_with_the_write(spark, tmp_path):
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id") * 1.0).alias("cupo")).mapInArrow(counted, "id long, cupo double")
    found = checked.write_checked(df, f"{tmp_path}/a", checked.contract_metrics(["cupo"]) | checked.closure_metrics("cupo", 4500.0), {"filas": lambda m: m["filas"] == 100})
    assert found == {"filas": 100, "sin_cupo": 10, "suma": 4500.0, "resto": 0.0} and scans.value == 100          # one scan
    with pytest.raises(checked.CheckFailed) as e:
        checked.write_checked(df, f"{tmp_path}/b", checked.reconcile_metrics("id", "cupo"), {"concilia": lambda m: m["diferencia"] == 0})
    assert e.value.failed == ["concilia"] and e.value.metrics["diferencia"] == 450.0


@pytest.fixture
def no_broadcast(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_heavy_client_is_not_shuffled(spark, no_broadcast, how):
    rnd = random.Random(1)
    rows = [(7, 1) if i % 2 else (rnd.choice([None, *range(2000)]), rnd.randint(1, 3)) for i in range(20_000)]
    left = spark.createDataFrame(rows, "id_cliente long, id_sucursal long").withColumn("n", F.monotonically_increasing_id()).repartition(16)
    right = spark.createDataFrame([(c, b, f"{c}/{b}") for c in range(0, 2000, 2) for b in (1, 2)] + [(7, 1, "hot")], "id_cliente long, id_sucursal long, nombre string")
    got = skew.join_heavy(left, right, ["id_cliente", "id_sucursal"], how)
    want = left.join(right, ["id_cliente", "id_sucursal"], how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    if how == "left":
        def tasks(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        per, plain = tasks(got), tasks(want)
        assert per[-1] <= 3 * per[len(per) // 2] and plain[-1] > 3 * plain[len(plain) // 2], (per, plain)


def test_lines_of_a_large_client_table_give_the_same(spark, no_broadcast):
    from retail_analytics.plans import load_all
    run = load_all()["c1_coverage_tables"].run
    hot = sorted(map(str, run(spark, "/root/testdata/sf0.001").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert hot == sorted(map(str, run(spark, "/root/testdata/sf0.001").collect()))


def test_bitmap_cohorts(spark):
    rnd = random.Random(2)
    days = [datetime.date(2000 + m // 12, m % 12 + 1, 5) for m in range(20)]
    rows = [(rnd.randint(0, 70_000) * 1_000_003, rnd.choice(days), 1.0) for _ in range(60_000)]
    lines = spark.createDataFrame(rows, "id_cliente long, fecha_comprobante date, subtotal_neto double").withColumn("id_documento", F.lit("FCVTA"))
    want = {(r.mes_cohorte, r.mes_n): r.clientes for r in cl.cohort_edges(lines, "2001-06-30", "2000-03-01").collect()}
    got_df = cohorts.retention_counts(lines, "2001-06-30", "2000-03-01")
    assert {(r.mes_cohorte, r.mes_n): r.clientes for r in got_df.collect()} == want
    numbers = cohorts.dense_numbers(lines, "id_cliente")
    n = len({r[0] for r in rows})
    assert numbers.agg(F.min("no"), F.max("no"), F.count_distinct("no")).first()[:] == (0, n - 1, n)


def test_equal_frames_are_not_joined(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("j"), (F.col("id") * 1.5).alias("v"))
    same = checksums.differing_ranges(df, df.repartition(7).orderBy(F.desc("v")), ["k", "j"])
    assert same.count() == 0
    other = df.withColumn("v", F.when(F.col("j") == 4321, 0.0).otherwise(F.col("v"))).filter("j <> 17")
    found = checksums.differing_ranges(df, other, ["k", "j"])
    assert 1 <= found.count() <= 2
    assert {17, 4321} <= {r.j for r in checksums.only_ranges(df, ["k", "j"], found).collect()} and checksums.only_ranges(df, ["k", "j"], found).count() < 30
    twice = df.unionByName(df.limit(1)).unionByName(df.limit(1))                # a pair of equal rows more: the exclusive or can't see it
    assert checksums.differing_ranges(df, twice, ["k", "j"]).count() == 1
    diff = recon.frame_diff(df, other, ["k", "j"], ["v"], 0.01)
    assert sorted((r.j, r.presencia) for r in diff.collect()) == [(17, "base-only"), (4321, "both")]
    equal = recon.frame_diff(df, df, ["k", "j"], ["v"], 0.01)
    assert equal.count() == 0


def test_order_stats_against_numpy(spark):
    import numpy as np
    from retail_analytics.functions import ordered
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("one", 1), ("two", 2), ("ties", 400), ("wide", 3000), (None, 999)):
        v = rng.lognormal(0, 3, n).round(3) if g != "ties" else rng.choice([0.0, 0.0, 1.0, -5.0], n)
        rows += [(g, float(x), int(w)) for x, w in zip(v, rng.integers(1, 5, n))]
    df = spark.createDataFrame(rows, "g string, v double, w int").repartition(5)
    got = {r.g: r for r in ordered.median_mad(df, "v", ["g"], "w").collect()}
    for g in {r[0] for r in rows}:
        e = np.repeat([r[1] for r in rows if r[0] == g], [r[2] for r in rows if r[0] == g])
        m = np.median(e)
        assert abs(got[g].mediana - m) < 1e-9 and abs(got[g].mad - np.median(np.abs(e - m))) < 1e-9
    e = np.repeat([r[1] for r in rows], [r[2] for r in rows])
    all_ = ordered.order_stats(df, "v", {"p1": .01, "p99": .99}, weight="w", deviation="mad").first()
    assert abs(all_.p1 - np.percentile(e, 1)) < 1e-9 and abs(all_.mad - np.median(np.abs(e - np.median(e)))) < 1e-9


def test_pairs_are_counted_vertically(spark, monkeypatch):
    from itertools import permutations
    from retail_analytics.operators import stats
    rnd = random.Random(6)
    rows = [(g, b, f"i{rnd.randint(0, 12)}") for g in ("x", None) for b in range(400) for _ in range(rnd.randint(1, 6))]
    df = spark.createDataFrame(rows, "g string, b long, item string").distinct()
    want = {}
    for g, b in {r[:2] for r in rows}:
        for p in permutations(sorted({r[2] for r in rows if r[:2] == (g, b)}), 2):
            want[(g, *p)] = want.get((g, *p), 0) + 1
    for fit in (20_000, 30):                              # one bucket, then many
        monkeypatch.setattr(stats, "BASKETS", fit)
        assert {(r.g, r.a, r.b): r.baskets for r in stats.pair_supports(df, ["g"], "b", "item").collect()} == want
    # one basket of 5,000 items: bits, not 25 million pairs
    big = spark.range(5000).select(F.lit("x").alias("g"), F.lit(-1).cast("long").alias("b"), F.concat(F.lit("r"), "id").alias("item"))
    rules = stats.association_rules(df.filter("g = 'x'").unionByName(big), ["g"], "b", "item", 0.05, 0.0)
    assert rules.count() == len([k for k, n in want.items() if k[0] == "x" and n >= 0.05 * 401])


def test_working_day_ranks(spark):
    from retail_analytics.operators import calendar as cal
    holidays = spark.sql("SELECT CAST(NULL AS BIGINT) id_sucursal, DATE'2001-06-20' fecha UNION ALL SELECT 2, DATE'2001-06-21'")
    ranks = cal.working_ranks(spark, "2001-06-01", "2001-06-30", holidays, spark.range(1, 3).select(F.col("id").alias("id_sucursal")))
    pairs = [("2001-05-31", "2001-06-30"), ("2001-06-19", "2001-06-22"), ("2001-06-22", "2001-06-19"), ("2001-06-16", "2001-06-17"), ("2001-01-01", "2002-01-01")]
    d = ranks.join(spark.createDataFrame(pairs, "a string, b string"))
    got = {(r.id_sucursal, r.a, r.b): r.n for r in d.withColumn("n", cal.working_days_between(F.col("a").cast("date"), F.col("b").cast("date"))).collect()}
    off = {1: {datetime.date(2001, 6, 20)}, 2: {datetime.date(2001, 6, 20), datetime.date(2001, 6, 21)}}
    days = [datetime.date(2001, 6, k) for k in range(1, 31)]
    for k in (1, 2):
        for a, b in pairs:
            x, y = datetime.date.fromisoformat(a), datetime.date.fromisoformat(b)
            n = sum(cal.is_working(d, off[k]) and min(x, y) < d <= max(x, y) for d in days)
            assert got[(k, a, b)] == (n if x <= y else -n)


def test_stored_layout_needs_no_shuffle_on_the_client(spark, no_broadcast, tmp_path):
    import uuid
    from retail_analytics.sources import layout
    rnd = random.Random(8)
    rows = [(rnd.randint(0, 300), rnd.choice("ab"), datetime.date(2001, rnd.randint(1, 6), 3), float(rnd.randint(-2, 5))) for _ in range(5000)]
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    lines = layout.store_lines(spark.createDataFrame(rows, "id_cliente long, generico string, fecha_comprobante date, cantidades_total double"), names[0], f"{tmp_path}/l", 8)
    clients = layout.store_clients(spark.range(301).select(F.col("id").alias("id_cliente"), (F.col("id") % 5).alias("zona")), names[1], f"{tmp_path}/c", 8)
    got = layout.buyers(lines, ["2001-02", "2001-03"], ["generico"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert " IN (2001-02,2001-03)" in plan.split("PartitionFilters: [")[1] and "hashpartitioning(id_cliente" not in plan and plan.count("Exchange hashpartitioning") == 1
    want = {}
    for c, g, d, q in rows:
        if d.month in (2, 3):
            want[(g, c)] = want.get((g, c), 0) + q
    assert {(r.generico, r.clientes, r.volumen) for r in got.collect()} == {
        (g, sum(k[0] == g and q > 0 for k, q in want.items()), sum(q for k, q in want.items() if k[0] == g and q > 0)) for g in "ab"}
    joined = lines.join(clients, "id_cliente").select("id_cliente", "zona", "cantidades_total")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 5000
    layout.drop(spark, *names)


def test_shared_frames_leave_the_storage(spark):
    import gc
    from retail_analytics.plans import load_all
    run, rdds = load_all()["f16_weighted_mad"].run, spark.sparkContext._jsc.getPersistentRDDs
    gc.collect()
    run(spark, "/root/testdata/sf0.001").select("mad").count()                    # the derived frame outlives the first one
    assert len(rdds()) > 0
    before = set(rdds())
    gc.collect()
    df = run(spark, "/root/testdata/sf0.001")
    assert not before & set(rdds()) and df.count() == 25
