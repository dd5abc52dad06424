"""A pass threshold decided early, over blocks in hash order.

Two stored tables under digest trees (:mod:`tablesync.operators.digest_tree`) agree
in all leaves whose digests agree, so only rows of differing leaves can be missing,
and how many those are is known from the tree.  Leaves are read in the order of
the key's hash, which has nothing to do with the rows, in blocks of doubling size,
each leaf once.  After a block the verdict may be

* ``certain``: what is missing is already too much, or would not be too much if all
  that is unread were missing; or
* ``likely``: Wald's sequential probability-ratio test between a rate of missing rows
  ``margin`` below and ``margin`` above the one that the threshold allows has reached
  the stated ``error``.  Rows of a key share a leaf, so the log ratio is divided by how
  much more the leaves read so far differ than independent rows would.

``exact=True`` reads on until the verdict is certain.  A rate between the two of
the test may be called either way only when it is called at all: the test stops late
there, and at the last leaf every verdict is certain.
"""

from __future__ import annotations

import math
from typing import Iterable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators import digest_tree as D
from tablesync.operators.reconcile import presence

#: Leaves before which the test says nothing, as their spread isn't known.
LEAST_LEAVES = 16
SCHEMA = "source_count long, differing_leaves int, leaves_read int, rows_read long, missing_seen long, passed boolean, verdict string"


def log_ratio(leaves: list[tuple[int, int]], rate: float, margin: float) -> float:
    """Log likelihood ratio of a rate above against one below ``rate``, of (rows,
    missing) of leaves, divided by their spread over that of independent rows."""
    low, high = rate * (1 - margin), min(rate * (1 + margin), 1 - (1 - rate) / 2)
    rows, missing = sum(n for n, _ in leaves), sum(m for _, m in leaves)
    ratio = missing * math.log(high / low) + (rows - missing) * math.log((1 - high) / (1 - low))
    own = missing / rows if rows else 0.0
    if not 0 < own < 1:
        own = rate
    spread = sum((m - n * own) ** 2 for n, m in leaves) / (rows * own * (1 - own)) if rows else 1.0
    return ratio / max(1.0, spread)


def _missing_by_leaf(spark: SparkSession, source_dir: str, target_dir: str, leaves: list[int], bits: int, keys: tuple[str, ...], exclude: Iterable[str]) -> dict[int, tuple[int, int]]:
    source, target = (D.read_table(spark, d, leaves, bits) for d in (source_dir, target_dir))
    counts, _ = presence(source.withColumn(D.LEAF, D.leaf_of(source, keys, bits)), target.withColumn(D.LEAF, D.leaf_of(target, keys, bits)), exclude)
    missing = F.coalesce(F.sum(F.when(F.col("target_count") == 0, F.col("source_count"))), F.lit(0))
    # a row a leaf of the block
    return {r[D.LEAF]: (r["n"], r["m"]) for r in counts.groupBy(D.LEAF).agg(F.sum("source_count").alias("n"), missing.alias("m")).collect()}


def sequential_threshold(
    spark: SparkSession, source_dir: str, target_dir: str, threshold: float = 100.0, error: float = 1e-3, margin: float = 0.25, exact: bool = False, exclude: Iterable[str] = (),
) -> DataFrame:
    """One row: whether at least ``threshold`` percent of the source's rows are in
    the target, how that is known, and what was read for it."""
    s, t = D.read_tree(spark, source_dir), D.read_tree(spark, target_dir)
    if s is None or t is None:
        raise FileNotFoundError("both tables need a committed version")
    if s.keys != t.keys or s.schema != t.schema:
        raise ValueError("tables are dealt by different keys or have different columns")
    bits = min(s.bits, t.bits)
    at_leaves = [D.coarser(tree.nodes.where(F.col("level") == tree.levels).select("node", "n", "a", "b"), tree.bits - bits) for tree in (s, t)]
    differ = D.differing_leaves(*[D.tree_of(leaves, bits) for leaves in at_leaves], bits)
    held = spark.createDataFrame([(i,) for i in differ], "node long")
    total = s.nodes.where("level = 0").agg(F.sum("n")).first()[0] or 0
    rows_of = {r["node"]: r["n"] for r in at_leaves[0].join(held, "node", "left_semi").collect()}
    allowed = math.floor(total * (1 - threshold / 100) + 1e-9 * total)
    at_stake = sum(rows_of.values())
    read: list[tuple[int, int]] = []
    missing = rows_read = done = 0
    verdict: Optional[tuple[bool, str]] = None
    while verdict is None:
        if missing > allowed:
            verdict = False, "certain"
        elif missing + at_stake - rows_read <= allowed:
            verdict = True, "certain"
        elif not exact and len(read) >= LEAST_LEAVES and 0 < allowed < at_stake:
            ratio, bound = log_ratio(read, allowed / at_stake, margin), math.log((1 - error) / error)
            if abs(ratio) >= bound:
                verdict = ratio < 0, "likely"
        if verdict is None:
            block = differ[done : 2 * done + 1]
            found = _missing_by_leaf(spark, source_dir, target_dir, block, bits, s.keys, exclude)
            done += len(block)
            read += [found.get(i, (0, 0)) for i in block]
            rows_read, missing = sum(n for n, _ in read), sum(m for _, m in read)
    return spark.createDataFrame([(total, len(differ), done, rows_read, missing, *verdict)], SCHEMA)
