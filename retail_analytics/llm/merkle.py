"""Merkle dataset manifest: levels stored as parent-linked node rows, proofs climbed by a recursive query.

Leaves are numbered inside their tree by a range sort, so no tree has to fit into one task.  Each level is a written table of
node rows: the run of child digests, the place in the parent's run and the key of that parent.  A recursive query ascends from
every leaf, appends a row with the siblings of each level and folds the claimed leaf digest.  A node high up is met by many
leaves: it is stored in one copy for each ``SPREAD`` leaves below it, and a leaf meets one of the copies.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W
from pyspark.sql.types import LongType, StructField, StructType

from .common import checkpoint_dir, cut, pick
from .decontaminate import LOWER, UPPER

FAN = 8
SPREAD = 512                        # leaves that meet one stored copy of a node
MAX_BROADCAST_TREES = 200_000       # rows of trees (about 200 bytes each) that are broadcast; more are shuffled
TOP = -1                            # number of the tree over the roots of the others


def encoded(*values: Column) -> Column:
    """What a leaf's digest is taken of: ``-`` for a null, else UTF-8 byte count, ``:`` and the value, one after the other."""
    parts = [v.cast("string") for v in values]
    return F.concat(*(F.when(p.isNull(), "-").otherwise(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p)) for p in parts))


def digest(joined: Column) -> Column:
    """SHA-256 of the lowercase hex text of joined digests, as 32 bytes."""
    return F.unhex(F.sha2(F.lower(F.hex(joined)), 256))


def numbered(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds ``idx``, from 0, in the order of ``order`` inside each value of ``tree`` (null is one), ``n``, the rows of the tree,
    and ``tree_no``, from 0, in the order of the trees.  Rows that tie in all of ``order`` are numbered in any way."""
    keys = [tree, *order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, "tie")
              .sortWithinPartitions(*keys, "tie").withColumn("part", F.spark_partition_id()).drop("tie"))

    def count(batches):
        last, n = None, 0
        for b in batches:
            at = []
            for value in b.column(tree).to_pylist():
                if value != last:
                    last, n = value, 0
                at.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], [*b.schema.names, "at"])

    placed = cut(ranged.mapInArrow(count, StructType([*ranged.schema.fields, StructField("at", LongType())])))
    own = W.partitionBy(tree).orderBy("part")           # parts of a tree: as many as shuffle partitions at most
    cells = cut(placed.groupBy("part", tree).agg(F.count("*").alias("rows"))
                .select(F.col("part").alias("cell"), F.col(tree).alias("mine"), (F.sum("rows").over(own) - F.col("rows")).alias("before"),
                        F.sum("rows").over(W.partitionBy(tree)).alias("n")))
    # The parts are in the order of the trees, so a tree's number is that of the trees which start in earlier parts, and its place
    # among those that start in its own part.
    heads = cells.where("before = 0").select("mine", "cell", F.row_number().over(W.partitionBy("cell").orderBy("mine")).alias("k"))
    starts = heads.groupBy("cell").agg(F.max("k").alias("heads"))                                       # a row for a part
    starts = starts.select(F.col("cell").alias("at_cell"), (F.sum("heads").over(W.orderBy("cell")) - F.col("heads")).alias("earlier"))
    trees = heads.join(F.broadcast(starts), F.col("cell") == F.col("at_cell")).select(F.col("mine").alias("its"), (F.col("earlier") + F.col("k") - 1).alias("tree_no"))
    cells = cut(cells.join(trees, F.col("mine").eqNullSafe(F.col("its"))).drop("its"))
    near = F.broadcast(cells) if cells.count() <= MAX_BROADCAST_TREES else cells
    return (placed.join(near, (F.col("part") == F.col("cell")) & F.col(tree).eqNullSafe(F.col("mine")))
            .withColumn("idx", F.col("at") + F.col("before")).drop("part", "at", "cell", "mine", "before"))


@dataclass
class Manifest:
    """Paths of the written tables: ``leaves`` (tree, n, idx, leaf, claim and the order's columns), ``trees``
    (tree, subroot) and ``nodes``, one a level, none if a lone leaf is the root; and the root's digest in hex."""
    spark: SparkSession
    leaves: str
    trees: str
    nodes: list[str]
    root: str
    n_trees: int
    n_leaves: int


def _linked(level: DataFrame, k: int, trees: int, total: int) -> DataFrame:
    """Adds the place ``pos`` in the parent's run and the parent's key; ``up_copies`` is the number of copies of the parent."""
    inner = F.col("m") > 1
    below = F.least(F.col("n"), F.lit(FAN ** (k + 1)))
    top = F.lit(trees > 1) & (F.col("tree") != TOP)
    up = F.when(inner, F.struct(F.col("tree").alias("tree"), F.lit(k + 1).alias("level"), F.expr(f"idx div {FAN}").alias("idx"),
                                F.ceil(below / SPREAD).alias("copies")))
    up = up.when(top, F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(1).alias("level"), F.expr(f"tree div {FAN}").alias("idx"),
                               F.ceil(F.lit(total) / SPREAD).alias("copies")))
    pos = F.when(inner, F.col("idx") % FAN).when(top, F.col("tree") % FAN).cast("int")
    return (level.withColumn("pos", pos).withColumn("up", up)
            .select(*level.columns, "pos", *(F.col(f"up.{c}").alias(f"up_{c}") for c in ("tree", "level", "idx", "copies"))))


def _levels(level: DataFrame, most: int, trees: int, total: int, base: str) -> list[str]:
    """Writes the levels over ``level`` (tree, n, idx, m nodes in its level, digest) until no tree has two nodes left."""
    paths, k = [], 0
    while most > 1:
        k += 1
        most = -(-most // FAN)
        run = F.aggregate(F.sort_array(F.collect_list(F.struct("idx", "digest"))), F.lit(b""), lambda done, x: F.concat(done, x["digest"]))
        level = (level.where("m > 1").groupBy("tree", "n", F.expr(f"idx div {FAN}").alias("idx"), F.expr(f"(m + {FAN - 1}) div {FAN}").alias("m"))
                 .agg(run.alias("run")).withColumn("digest", digest(F.col("run"))).withColumn("level", F.lit(k)))
        paths.append(f"{base}-{k}")
        _linked(level, k, trees, total).write.parquet(paths[-1])
        level = level.sparkSession.read.parquet(paths[-1])
    return paths


def manifest(rows: DataFrame, tree: str, order: list[str]) -> Manifest:
    """The trees over ``rows``, which have the columns ``leaf`` and ``claim`` (digests of 32 bytes), ``tree`` and those of ``order``.

    Per value of ``tree`` (null is one of them, first) leaves ascend by ``order``; while more than one node remains, each run of
    eight consecutive ones becomes the digest of their joined digests.  The roots, in the order of ``tree``, make a tree likewise.
    Raises a ValueError on an empty table.
    """
    spark = rows.sparkSession
    base = f"{checkpoint_dir(spark)}/merkle-{uuid.uuid4().hex}"
    numbered(rows, tree, order).drop(tree).withColumnRenamed("tree_no", "tree").withColumn("m", F.col("n")).write.parquet(f"{base}-leaves")
    leaves = spark.read.parquet(f"{base}-leaves")
    total, trees, most = leaves.agg(F.count("*"), F.max("tree") + 1, F.max("n")).first()
    if not total:
        raise ValueError("no rows, no manifest")
    paths = _levels(leaves.select("tree", "n", "idx", "m", F.col("leaf").alias("digest")), most, trees, total, f"{base}-node")
    roots = leaves.where("m = 1").select("tree", F.col("leaf").alias("subroot"))
    for p in paths:
        roots = roots.unionByName(spark.read.parquet(p).where("m = 1").select("tree", F.col("digest").alias("subroot")))
    roots.write.parquet(f"{base}-trees")
    roots, tops = spark.read.parquet(f"{base}-trees"), []
    if trees > 1:
        level = roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(total).alias("n"), F.col("tree").alias("idx"), F.lit(trees).alias("m"),
                             F.col("subroot").alias("digest"))
        tops = _levels(level, trees, trees, total, f"{base}-top")
    root = spark.read.parquet(tops[-1]).first()["digest"] if tops else roots.first()["subroot"]
    return Manifest(spark, f"{base}-leaves", f"{base}-trees", paths + tops, root.hex(), trees, total)


CLIMB = """
WITH RECURSIVE climb (tree, idx, up_tree, up_level, up_idx, up_copy, pos, step, folded, siblings) AS (
  SELECT tree, idx, up_tree, up_level, up_idx, idx % up_copies, pos, 0, claim, X'' FROM leaves
  UNION ALL
  SELECT c.tree, c.idx, n.up_tree, n.up_level, n.up_idx, c.idx % n.up_copies, n.pos, c.step + 1,
    unhex(sha2(lower(hex(concat(substring(n.run, 1, 32 * c.pos), c.folded, substring(n.run, 32 * c.pos + 33)))), 256)),
    concat(substring(n.run, 1, 32 * c.pos), substring(n.run, 32 * c.pos + 33))
  FROM climb c JOIN nodes n ON n.tree = c.up_tree AND n.level = c.up_level AND n.idx = c.up_idx AND n.copy = c.up_copy)
SELECT tree, idx, step, folded, siblings FROM climb"""


def unlimited(spark: SparkSession) -> SparkSession:
    """A session like this one in which a recursive query may return any number of rows; the caller's stays as it is."""
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            other.conf.set(name, value)
    other.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return other


def climb(made: Manifest) -> DataFrame:
    """For each leaf (tree, idx): ``proof``, the siblings' digests level by level up to the root, and ``folded``, the root that its
    claim leads to, both lowercase hex.  The rows come from a session of their own, see :func:`unlimited`."""
    spark = unlimited(made.spark)
    leaves = spark.read.parquet(made.leaves)
    if not made.nodes:                                  # a lone leaf
        return leaves.select("tree", "idx", F.lit("").alias("proof"), F.lower(F.hex("claim")).alias("folded"))
    _linked(leaves, 0, made.n_trees, made.n_leaves).createOrReplaceTempView("leaves")
    below = F.when(F.col("tree") == TOP, F.col("n")).otherwise(F.least("n", F.pow(F.lit(FAN), F.col("level")).cast("long")))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(below / SPREAD) - 1))
    nodes = spark.read.parquet(*made.nodes).select("tree", "level", "idx", copy.alias("copy"), "run", "pos", "up_tree", "up_level", "up_idx", "up_copies")
    # Dealt out by the join's keys once, so the steps of the recursion shuffle only the climbing rows.  A checkpoint remembers how
    # its rows are dealt out if the plan was fixed beforehand.
    parts, adaptive = (spark.conf.get(f"spark.sql.{x}") for x in ("shuffle.partitions", "adaptive.enabled"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    cut(nodes.repartition(int(parts), "tree", "level", "idx", "copy")).createOrReplaceTempView("nodes")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    steps = F.transform(F.sort_array(F.collect_list(F.struct("step", "siblings"))), lambda s: F.hex(s["siblings"]))
    return (spark.sql(CLIMB).groupBy("tree", "idx")
            .agg(F.lower(F.array_join(steps, "")).alias("proof"), F.lower(F.hex(F.max_by("folded", "step"))).alias("folded")))


def leaf_rows(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and claim: the digest of the row as it is and of what is claimed it to be, 32 bytes each.  Where 3 divides the unsigned
    crc32 of the decimal doc_id the claim has the text's A-Z lower-cased; a null doc_id claims the truth."""
    own = pick(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    text = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return own.select("doc_id", "lang", *(F.unhex(F.sha2(encoded(*head, t), 256)).alias(name) for name, t in (("leaf", F.col("text")), ("claim", text))))


def verified(rows: DataFrame, tree: str = "lang", order: str = "doc_id") -> DataFrame:
    """Manifest and climb of ``rows`` (order, tree, leaf, claim): order, leaf, subroot, root, proof_sha256, folded_root, verified.

    A null in ``tree`` is a tree of its own, the first; null in ``order`` comes first; rows that share it ascend by leaf, and
    repeated rows are leaves of their own; one leaf alone is its subroot, with an empty proof; no rows give none; other columns
    are dropped.
    """
    rows = cut(rows.select(order, tree, "leaf", "claim"))
    schema = f"{order} {rows.schema[order].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], schema)
    made = manifest(rows, tree, [order, "leaf"])
    climbed = climb(made)
    spark = climbed.sparkSession
    trees = spark.read.parquet(made.trees)
    trees = F.broadcast(trees) if trees.count() <= MAX_BROADCAST_TREES else trees
    return (spark.read.parquet(made.leaves).join(climbed, ["tree", "idx"]).join(trees, "tree")
            .select(order, F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"), F.lit(made.root).alias("root"), F.sha2("proof", 256).alias("proof_sha256"),
                    F.col("folded").alias("folded_root"), (F.col("folded") == made.root).alias("verified")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(leaf_rows(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def sql() -> str:
    cols = ["doc_id", "source", "lang", "n_chars"]

    def enc(text: str) -> str:
        return " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in [*cols, text])
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)), lambda c, b: {bits}), 4294967295)"
    step = f"""sha256(string_agg(CASE WHEN s.idx = c.idx THEN c.folded ELSE s.h END, '' ORDER BY s.idx)),
    c.proof || coalesce(string_agg(CASE WHEN s.idx <> c.idx THEN s.h END, '' ORDER BY s.idx), '')"""
    return f"""
WITH RECURSIVE docs AS (SELECT *, CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS other FROM documents),
hashed AS (SELECT doc_id, lang, sha256({enc("text")}) AS leaf, sha256({enc("other")}) AS claim FROM docs),
leaves AS (SELECT doc_id, leaf, claim, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS m FROM hashed),
level AS (SELECT tree, 0 AS k, idx, m, leaf AS h FROM leaves UNION ALL
  SELECT tree, k + 1, idx // {FAN}, (m + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY idx)) FROM level WHERE m > 1 GROUP BY tree, k, idx // {FAN}, m),
subroots AS (SELECT tree, h, count(*) OVER () AS trees FROM level WHERE m = 1),
top AS (SELECT 0 AS k, tree AS idx, trees AS m, h FROM subroots UNION ALL
  SELECT k + 1, idx // {FAN}, (m + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE m > 1 GROUP BY k, idx // {FAN}, m),
climb AS (SELECT tree, idx AS own, 0 AS k, idx, m, claim AS folded, '' AS proof FROM leaves UNION ALL
  SELECT c.tree, c.own, c.k + 1, c.idx // {FAN}, (c.m + {FAN - 1}) // {FAN}, {step}
  FROM climb c JOIN level s ON s.tree = c.tree AND s.k = c.k AND s.idx // {FAN} = c.idx // {FAN} WHERE c.m > 1
  GROUP BY c.tree, c.own, c.k, c.idx, c.m, c.folded, c.proof),
climb_top AS (SELECT c.tree, c.own, 0 AS k, c.tree AS idx, s.trees AS m, c.folded, c.proof FROM climb c JOIN subroots s USING (tree) WHERE c.m = 1 UNION ALL
  SELECT c.tree, c.own, c.k + 1, c.idx // {FAN}, (c.m + {FAN - 1}) // {FAN}, {step}
  FROM climb_top c JOIN top s ON s.k = c.k AND s.idx // {FAN} = c.idx // {FAN} WHERE c.m > 1
  GROUP BY c.tree, c.own, c.k, c.idx, c.m, c.folded, c.proof)
SELECT l.doc_id, l.leaf, r.h AS subroot, t.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.h AS verified
FROM leaves l JOIN climb_top c ON c.tree = l.tree AND c.own = l.idx AND c.m = 1 JOIN subroots r ON r.tree = l.tree JOIN top t ON t.m = 1"""
