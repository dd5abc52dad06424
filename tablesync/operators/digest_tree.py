"""Tables kept by key range under a tree of digests.

Rows are dealt to leaves by the first bits of a hash of their key.  Every leaf
has a digest (rows, and two sums of 64-bit hashes over all values), and so has
every range of ``2**FAN`` neighbouring nodes above, up to the table: a node's
digest is the sum of its children's.  Two tables, or a table and its source,
are compared from the root down, and only below nodes that differ.

Layout of a table folder::

    data/_batch=<id>/_leaf=<n>/   rows of a leaf, written by one sync
    versions/_v000001/level=<l>/  the tree, and for each leaf the batch that holds it

A sync writes the leaves that differ into a batch of its own and then publishes
a new version of the tree, which is the table's list of folders.  Readers take
the newest version whose job was committed, so they see the state before or
after a sync and nothing between; a sync that dies leaves a batch that no
version names (:func:`vacuum` deletes those).  A table that isn't there is created.

The number of leaves follows from the number of rows.  Rows of a leaf are
rebalanced over as many tasks as they need, so a key that holds a third of the
table is written by many tasks.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import comparable
from tablesync.operators.reconcile import missing_rows
from tablesync.sources import storage

#: Bits of the key hash that a level adds.
FAN = 4
#: Rows that a leaf is meant to hold, and how many times more until a table gets more leaves.
LEAF_ROWS, GROWN = 1 << 20, 8
LEAF, BATCH = "_leaf", "_batch"
_SUM = "decimal(38,0)"


@dataclass(frozen=True)
class Tree:
    """A version's digests (``level, node, n, a, b, batch``) and how its rows are dealt."""

    nodes: DataFrame
    bits: int
    keys: tuple[str, ...]
    schema: T.StructType

    @property
    def levels(self) -> int:
        return -(-self.bits // FAN)


@dataclass(frozen=True)
class Synced:
    """What a sync did: whether it created the table, and the leaves that it wrote anew or emptied."""

    created: bool
    leaves: list[int]
    bits: int


# ------------------------------------------------------------------ digests
def leaf_of(df: DataFrame, keys: Sequence[str], bits: int) -> Column:
    """The first ``bits`` bits of the key's hash (null keys are keys)."""
    return F.shiftrightunsigned(F.xxhash64(*[comparable(df, k) for k in keys]), 64 - bits) if bits else F.lit(0).cast("long")


def leaf_digests(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``node, n, a, b`` of every leaf: one row a leaf and task is shuffled."""
    values = [comparable(df, c) for c in df.columns] + [F.col(f"`{c}`").isNull() for c in df.columns]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(28,0)")).cast(_SUM)
    return df.groupBy(leaf_of(df, keys, bits).alias("node")).agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b"))


def tree_of(leaves: DataFrame, bits: int) -> DataFrame:
    """All levels above leaves (which may have a ``batch``): ``level, node, n, a, b, batch``."""
    levels = -(-bits // FAN)
    if "batch" not in leaves.columns:
        leaves = leaves.withColumn("batch", F.lit(None).cast("string"))
    up = F.explode(F.array(*[F.struct(F.lit(at).alias("level"), F.expr(f"shiftright(node, {bits - min(bits, FAN * at)})").alias("node")) for at in range(levels)])) if levels else None
    out = leaves.select(F.lit(levels).alias("level"), "node", "n", "a", "b", "batch")
    if up is None:
        return out
    above = leaves.select(up.alias("at"), "n", "a", "b").groupBy("at.level", "at.node").agg(F.sum("n").alias("n"), F.sum("a").cast(_SUM).alias("a"), F.sum("b").cast(_SUM).alias("b"))
    return above.withColumn("batch", F.lit(None).cast("string")).unionByName(out)


def coarser(leaves: DataFrame, by: int) -> DataFrame:
    """Leaf digests with ``by`` bits fewer."""
    if not by:
        return leaves
    return leaves.groupBy(F.shiftright("node", by).alias("node")).agg(F.sum("n").alias("n"), F.sum("a").cast(_SUM).alias("a"), F.sum("b").cast(_SUM).alias("b"))


def differing_leaves(one: DataFrame, other: DataFrame, bits: int) -> list[int]:
    """Leaves whose digests differ, found from the root down: a level's digests
    are read only below nodes that differ in the level above."""
    levels = -(-bits // FAN)
    frontier: Optional[DataFrame] = None
    differ: list[int] = []
    for level in range(levels + 1):
        shift = min(bits, FAN * level) - FAN * (level - 1)
        sides = []
        for tree, name in ((one, "x"), (other, "y")):
            own = tree.where(F.col("level") == level)
            if frontier is not None:
                own = own.join(frontier, F.shiftright(own["node"], shift) == frontier["parent"], "left_semi")
            sides.append(own.select("node", F.struct("n", "a", "b").alias(name)))
        both = sides[0].join(sides[1], "node", "full_outer")
        # numbers of nodes: a table's leaves at most, whose folders its readers' drivers list as well
        differ = sorted(r["node"] for r in both.where(~F.col("x").eqNullSafe(F.col("y"))).select("node").collect())
        if not differ:
            break
        frontier = one.sparkSession.createDataFrame([(i,) for i in differ], "parent long")
    return differ


# ------------------------------------------------------------------ storage
def _versions(table_dir: str) -> str:
    return f"{table_dir.rstrip('/')}/versions"


def _folder(table_dir: str, batch: str, leaf: int) -> str:
    return f"{table_dir.rstrip('/')}/data/{BATCH}={batch}/{LEAF}={leaf}"


def read_tree(spark: SparkSession, table_dir: str) -> Optional[Tree]:
    """The newest committed version's tree, None for a table that isn't there."""
    path = storage.current_path(spark, _versions(table_dir))
    if path is None:
        return None
    rows = spark.read.schema("node long, n long, a decimal(38,0), b decimal(38,0), batch string, about string, level int").parquet(path)
    about = json.loads(rows.where("level = -1").first()["about"])
    return Tree(rows.where("level >= 0").drop("about"), about["bits"], tuple(about["keys"]), T.StructType.fromJson(about["schema"]))


def _publish(spark: SparkSession, table_dir: str, leaves: DataFrame, bits: int, keys: Sequence[str], schema: T.StructType) -> None:
    about = json.dumps({"bits": bits, "keys": list(keys), "schema": schema.jsonValue()})
    head = spark.range(1).select(F.lit(-1).alias("level"), *[F.lit(None).cast(t).alias(c) for c, t in (("node", "long"), ("n", "long"), ("a", _SUM), ("b", _SUM), ("batch", "string"))], F.lit(about).alias("about"))
    rows = tree_of(leaves, bits).withColumn("about", F.lit(None).cast("string")).unionByName(head)
    storage.write_version(rows, _versions(table_dir), partition_by=["level"])


def _write(source: DataFrame, table_dir: str, keys: Sequence[str], bits: int, leaves: Optional[list[int]] = None) -> DataFrame:
    """Write the rows of some leaves (None: all) as a batch; the digests of what was written, with their batch."""
    spark, batch = source.sparkSession, uuid.uuid4().hex
    rows = source.withColumn(LEAF, leaf_of(source, keys, bits))
    if leaves is not None:
        wanted = spark.createDataFrame([(i,) for i in leaves], f"{LEAF} long")
        rows = rows.join(wanted, LEAF, "left_semi")
    path = f"{table_dir.rstrip('/')}/data/{BATCH}={batch}"
    rows.hint("rebalance", F.col(LEAF)).write.partitionBy(LEAF).parquet(path)
    written = spark.read.schema(source.schema).parquet(path).select(*[F.col(f"`{c}`") for c in source.columns])
    return leaf_digests(written, keys, bits).withColumn("batch", F.lit(batch))


def read_table(spark: SparkSession, table_dir: str, leaves: Optional[Iterable[int]] = None, bits: Optional[int] = None) -> DataFrame:
    """The table, or only the rows of some ``leaves`` (of ``bits`` bits, by default
    the table's own): no folder but theirs is listed or read."""
    tree = read_tree(spark, table_dir)
    if tree is None:
        raise FileNotFoundError(f"no committed version under {table_dir}")
    own = tree.nodes.where(F.col("level") == tree.levels).where("n > 0").select("node", "batch")
    if leaves is not None:
        wanted = spark.createDataFrame([(i,) for i in leaves], "wanted long")
        own = own.join(wanted, F.shiftright("node", tree.bits - (tree.bits if bits is None else bits)) == F.col("wanted"), "left_semi")
    # a folder a leaf: the table's list of files, which any reader's driver holds
    paths = [_folder(table_dir, r["batch"], r["node"]) for r in own.collect()]
    return spark.read.schema(tree.schema).parquet(*paths) if paths else spark.createDataFrame([], tree.schema)


def bits_for(rows: int, leaf_rows: int) -> int:
    return max(0, (max(1, -(-rows // leaf_rows)) - 1).bit_length())


def nullable(schema: T.StructType) -> T.StructType:
    """A schema as Parquet gives it back."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def sync_tree(spark: SparkSession, source: DataFrame, table_dir: str, keys: Sequence[str], leaf_rows: int = LEAF_ROWS) -> Synced:
    """Bring a table in step with ``source``; a table that isn't there is created.

    The source is read once for its digests; what is held is compared by its stored
    tree alone.  Leaves that differ are written anew from the source, so null
    and repeated keys come out as the source has them; all other files stay.
    """
    tree = read_tree(spark, table_dir)
    schema = nullable(source.schema)
    if tree is not None and (tree.schema != schema or tree.keys != tuple(keys)):
        tree, created = None, False  # other columns: every row is another one
    else:
        created = tree is None
    bits = bits_for(source.count(), leaf_rows) if tree is None else tree.bits
    if tree is not None:
        wanted = storage.held(leaf_digests(source, keys, bits), "tree-leaves")
        if (wanted.agg(F.sum("n")).first()[0] or 0) <= GROWN * leaf_rows << bits:
            differ = differing_leaves(tree_of(wanted, bits), tree.nodes, bits)
            if differ:
                gone = spark.createDataFrame([(i,) for i in differ], "node long")
                kept = tree.nodes.where(F.col("level") == tree.levels).join(gone, "node", "left_anti").select("node", "n", "a", "b", "batch")
                _publish(spark, table_dir, kept.unionByName(_write(source, table_dir, keys, bits, differ)), bits, keys, schema)
            return Synced(False, differ, bits)
        bits = bits_for(source.count(), leaf_rows)
    leaves = storage.held(_write(source, table_dir, keys, bits), "tree-leaves")
    _publish(spark, table_dir, leaves, bits, keys, schema)
    return Synced(created, sorted(r["node"] for r in leaves.select("node").collect()), bits)


def vacuum(spark: SparkSession, table_dir: str) -> list[str]:
    """Delete batches that the current version doesn't name; their names."""
    tree = read_tree(spark, table_dir)
    live = {r["batch"] for r in tree.nodes.select("batch").where("batch is not null").distinct().collect()} if tree else set()
    data = f"{table_dir.rstrip('/')}/data"
    dead = [b for b in storage.children(spark, data) if b.removeprefix(f"{BATCH}=") not in live]
    for b in dead:
        storage.delete(spark, f"{data}/{b}")
    return sorted(dead)


def missing_rows_by_tree(spark: SparkSession, source_dir: str, target_dir: str, exclude: Iterable[str] = (), with_evidence: bool = False) -> DataFrame:
    """:func:`missing_rows` of two tables under trees, by reading their
    differing leaves alone.  They may differ in their number of leaves, not in their keys."""
    s, t = read_tree(spark, source_dir), read_tree(spark, target_dir)
    if s is None or t is None:
        raise FileNotFoundError("both tables need a committed version")
    if s.keys != t.keys:
        raise ValueError(f"tables are dealt by different keys: {s.keys}, {t.keys}")
    if s.schema != t.schema:
        return missing_rows(read_table(spark, source_dir), read_table(spark, target_dir), exclude, with_evidence=with_evidence)
    bits = min(s.bits, t.bits)
    trees = []
    for tree in (s, t):
        own = tree.nodes
        if tree.bits != bits:
            own = tree_of(coarser(own.where(F.col("level") == tree.levels), tree.bits - bits), bits)
        trees.append(own)
    differ = differing_leaves(*trees, bits)
    return missing_rows(read_table(spark, source_dir, differ, bits), read_table(spark, target_dir, differ, bits), exclude, with_evidence=with_evidence)
