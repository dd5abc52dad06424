"""Operator 11: a Merkle manifest whose parents retain hash states.

H is SHA-256 as lowercase hex over its inputs one after the other, digests as
hex text.  A row's leaf is H of its fields, each ``-`` if null, else the number
of its UTF-8 bytes, ``:`` and the value.  In each group the leaves stand in
order of their key; every 8 neighbours (fewer at the end) become their H, level
by level, until one is left, the group's subroot.  Subroots in order of the
group (null first, by bytes) give the root in the same way.

A hex digest is one block of SHA-256, so a parent keeps, before each child slot,
the 32 bytes of the hash's state there.  A changed leaf is folded up by
resuming the state of its slot with the new digest and the siblings to its
right; those to its left are never read again.

Rows are numbered by one range sort and prefix sums over its parts.  Then
blocks of ``8**LIFT`` neighbours go up ``LIFT`` levels at once, one shuffle of
digests a pass, until every group is one node; groups are the leaves of the top
tree, by the same code.  On the way back each block gets the chain of parents
above it (one row a block), so a task folds a block's rows to the root with
what the block itself holds.  No group, level or chain is ever in one task.

Defined cases: a null key sorts first and is never altered; rows of one key are
ordered by their leaf, and wholly equal rows in any order; a null group is a
group; null fields and empty texts differ; an empty table has no rows and no
root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, partitions_for
from .sha256 import START, absorb, finish, hex_text

#: Children of a parent.
ARITY = 8
#: Levels that a block of neighbours goes up in one task.
LIFT = 4
BLOCK = ARITY**LIFT
#: Bytes of leaf rows in a part of the range sort.
PART_BYTES = 32 << 20
#: Levels beyond a block's own: marks the row with the chain above it.
ABOVE = 1 << 20

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODES = "g long, n long, idx long, digest binary"
_PARENTS = "g long, block long, level int, idx long, n long, children binary, states binary, digest binary, top boolean"
_CHAIN = "g long, idx long, subroot binary, root binary, chain binary"
_ENTRY = 2 + 32 + 32 * ARITY


# ------------------------------------------------------------------ leaves
def field_text(c: Column) -> Column:
    said = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The leaf's 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in fields]).cast("binary"), 256))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def altered_every_third(key: Column) -> Column:
    """Rows that the query alters: 3 divides the crc of the decimal key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 0, F.lit(False))


# ------------------------------------------------------------------ numbering
def numbered(rows: DataFrame, group: str | None, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``idx`` (from 0, in ``order`` inside each ``group``) and the group's
    size ``n``: a range sort, then prefix sums over its parts."""
    keys = ([group] if group else []) + list(order)
    placed = rows.repartitionByRange(partitions_for(rows, PART_BYTES), *keys).sortWithinPartitions(*keys)
    placed = materialise(placed.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    own = [group] if group else []
    spans = placed.groupBy(*own, part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("here"))
    whole = W.partitionBy(*own)
    before = whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select(
        F.col("part").alias("part_"), *[F.col(group).alias("group_") for _ in own], "first",
        F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"), F.sum("here").over(whole).alias("n"),
    )
    on = F.col("part_") == part
    if group:
        on = on & F.col("group_").eqNullSafe(F.col(group))
    out = placed.join(spans, on).withColumn("idx", F.col("at") - F.col("first") + F.col("before"))
    return out.drop("part_", "group_", "first", "before", "at")


# ------------------------------------------------------------------ going up
def height(n: int) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while n > 1:
        n = -(-n // ARITY)
        levels += 1
    return levels


def _bytes(col: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A binary column of one width as (rows, width) bytes."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, width)


def parents_of(children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the parents of neighbouring nodes, and their states before each slot (parents, 8, 32)."""
    n = -(-len(children) // ARITY)
    size = np.minimum(ARITY, len(children) - ARITY * np.arange(n))
    said = hex_text(children)
    states = np.zeros((n, ARITY, 32), np.uint8)
    now = np.tile(START, (n, 1))
    for slot in range(ARITY):
        full = n if size[-1] > slot else n - 1  # only the last parent may have fewer
        states[:full, slot] = now[:full]
        now[:full] = absorb(now[:full], said[slot::ARITY][:full])
    return finish(now, size), states


def _lift(rows: pa.Table) -> pa.Table:
    """All parents inside a block of neighbours."""
    order = np.argsort(rows.column("idx").to_numpy())
    digests = _bytes(rows.column("digest"), 32)[order]
    g, n, idx = rows.column("g")[0].as_py(), rows.column("n")[0].as_py(), int(rows.column("idx").to_numpy()[order[0]])
    block, levels = idx // BLOCK, min(LIFT, height(n))
    out: dict[str, list] = {c.split()[0]: [] for c in _PARENTS.split(", ")}

    def add(level: int, children: np.ndarray, states: np.ndarray, made: np.ndarray) -> None:
        for i in range(len(made)):
            size = len(children[ARITY * i : ARITY * i + ARITY]) if level else 0
            row = (g, block, level, idx + i, n, children[ARITY * i : ARITY * i + ARITY].tobytes() if level else b"", states[i, :size].tobytes() if level else b"", made[i].tobytes(), level == levels)
            for held, value in zip(out.values(), row):
                held.append(value)

    if not levels:
        add(0, digests, digests, digests)
    for level in range(1, levels + 1):
        made, states = parents_of(digests)
        idx, n = idx // ARITY, -(-n // ARITY)
        add(level, digests, states, made)
        digests = made
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
    return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


@dataclass
class Pass:
    """Nodes of one pass by block, and the parents (materialised) that they got."""

    nodes: DataFrame
    parents: DataFrame
    parts: int


def _by_block(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts, "g", "block")


def _parts(df: DataFrame, nodes: int) -> int:
    """Partitions of about 8 blocks of nodes, as their work is arithmetic, not bytes."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, min(100_000, -(-nodes // (8 * BLOCK))))


def climb(nodes: DataFrame, name: str) -> tuple[list[Pass], DataFrame]:
    """Passes from ``nodes`` (``g, n, idx, digest``) up to one node a group."""
    most, count = nodes.agg(F.max("n"), F.count("*")).first()
    passes: list[Pass] = []
    for at in range(max(1, -(-height(most) // LIFT))):
        held = nodes.select(*_NODES.replace(",", "").split()[::2]).withColumn("block", F.expr(f"idx div {BLOCK}"))
        parts = _parts(nodes, count)
        lifted = _by_block(held, parts).groupBy("g", "block").applyInArrow(_lift, _PARENTS)
        parents = materialise(lifted, f"{name}-{at}")
        passes.append(Pass(held, parents, parts))
        nodes = parents.filter("top").select("g", "n", "idx", "digest")
        count = -(-count // BLOCK) + 1
    return passes, nodes


# ------------------------------------------------------------------ and down
class _Family:
    """A block's parents by level, and the chain above it."""

    def __init__(self, rows: pa.Table):
        level = rows.column("level").to_numpy()
        idx = rows.column("idx").to_numpy()
        children, states = rows.column("children").to_pylist(), rows.column("states").to_pylist()
        self.levels: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.subroot = self.root = self.chain = b""
        for at in sorted(set(level.tolist())):
            own = np.flatnonzero(level == at)
            if at == ABOVE:
                i = int(own[0])
                self.chain, self.subroot, self.root = children[i], rows.column("subroot")[i].as_py(), rows.column("root")[i].as_py()
            elif at:
                own = own[np.argsort(idx[own])]
                wide = 32 * ARITY
                kids = np.frombuffer(b"".join(children[i].ljust(wide, b"\0") for i in own), np.uint8).reshape(-1, ARITY, 32)
                kept = np.frombuffer(b"".join(states[i].ljust(wide, b"\0") for i in own), np.uint8).reshape(-1, ARITY, 32)
                self.levels.append((int(idx[own[0]]), kids, kept, np.array([len(children[i]) // 32 for i in own])))

    def above(self) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(slot, size, state, children) of the chain, from below."""
        out = []
        for lo in range(0, len(self.chain), _ENTRY):
            e = np.frombuffer(self.chain[lo : lo + _ENTRY], np.uint8)
            out.append((int(e[0]), int(e[1]), e[2:34], e[34:].reshape(ARITY, 32)))
        return out


def resumed(digests: np.ndarray, slot: np.ndarray, size: np.ndarray, states: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Parents' digests with ``digests`` in place of the child at ``slot``: from the
    state retained there, over the new child and the siblings to its right."""
    now = absorb(states, hex_text(digests))
    for step in range(1, ARITY):
        some = np.flatnonzero(slot + step < size)
        if not len(some):
            break
        now[some] = absorb(now[some], hex_text(children[some, slot[some] + step]))
    return finish(now, size)


def _hand_down(nodes: pa.Table, family: pa.Table, subroots_here: bool) -> pa.Table:
    """The chain of each node of a block: its own parents, then the block's."""
    f = _Family(family)
    g, idx = nodes.column("g").to_pylist(), nodes.column("idx").to_numpy()
    chains = []
    for at in idx.tolist():
        entries = []
        for first, kids, states, size in f.levels:
            at, slot = divmod(at, ARITY)
            i = at - first
            entries.append(bytes([slot, int(size[i])]) + states[i, slot].tobytes() + kids[i].tobytes())
        chains.append(b"".join(entries) + f.chain)
    subroots = nodes.column("digest").to_pylist() if subroots_here else [f.subroot] * len(idx)
    return pa.table([pa.array(g, pa.int64()), pa.array(idx, pa.int64()), pa.array(subroots, pa.binary()), pa.array([f.root] * len(idx), pa.binary()), pa.array(chains, pa.binary())], names=[c.split()[0] for c in _CHAIN.split(", ")])


def _chains_down(nodes: pa.Table, family: pa.Table) -> pa.Table:
    return _hand_down(nodes, family, False)


def _subroots_down(nodes: pa.Table, family: pa.Table) -> pa.Table:
    return _hand_down(nodes, family, True)


def _fold(rows: pa.Table, family: pa.Table) -> pa.Table:
    """Every row of a block folded to the root, and the hash of its siblings."""
    f = _Family(family)
    idx = rows.column("idx").to_numpy()
    leaves = rows.column("digest").to_pylist()
    now = _bytes(pa.array([a or b for a, b in zip(rows.column("altered").to_pylist(), leaves)], pa.binary()), 32)
    own: list[list[bytes]] = [[] for _ in leaves]
    at = idx
    for first, kids, states, size in f.levels:
        at, slot = at // ARITY, at % ARITY
        i = at - first
        now = resumed(now, slot, size[i], states[i, slot], kids[i])
        said = [s[: 64 * n] for s, n in zip((row.tobytes() for row in hex_text(kids)), size.tolist())]
        for proof, p, s in zip(own, i.tolist(), slot.tolist()):
            proof.append(said[p][: 64 * s])
            proof.append(said[p][64 * s + 64 :])
    shared = []
    for slot, size, state, kids in f.above():
        # rows that came out equal go on as one
        seen, back = np.unique(np.ascontiguousarray(now).view("V32").ravel(), return_inverse=True)
        n = len(seen)
        some = np.frombuffer(seen.tobytes(), np.uint8).reshape(n, 32)
        made = resumed(some, np.full(n, slot), np.full(n, size), np.tile(state, (n, 1)), np.broadcast_to(kids, (n, ARITY, 32)))
        now = made[back]
        said = hex_text(kids).tobytes()
        shared.append(said[: 64 * slot] + said[64 * slot + 64 : 64 * size])
    tail = b"".join(shared)
    proofs = [hashlib.sha256(b"".join(p) + tail).digest() for p in own]
    subroot = [f.subroot] * len(leaves)
    out = [rows.column("k"), pa.array(leaves, pa.binary()), pa.array(subroot, pa.binary()), pa.array([f.root] * len(leaves), pa.binary()), pa.array(proofs, pa.binary()), pa.array([d.tobytes() for d in now], pa.binary())]
    return pa.table(out, names=["k", "leaf", "subroot", "root", "proof", "folded"])


def _family(step: Pass, chains: DataFrame) -> DataFrame:
    """Parents of each block beside the chain above it."""
    none = F.lit(None).cast("binary")
    inside = step.parents.filter("level > 0").select("g", "block", "level", "idx", "children", "states", none.alias("subroot"), none.alias("root"))
    above = chains.select("g", F.col("idx").alias("block"), F.lit(ABOVE).alias("level"), F.lit(0).cast("long").alias("idx"), F.col("chain").alias("children"), none.alias("states"), "subroot", "root")
    return _by_block(inside.unionByName(above), step.parts)


def descend(passes: list[Pass], chains: DataFrame, subroots_below: bool = False) -> DataFrame:
    """Chains of the first of ``passes``' nodes from that of the last one's result.
    With ``subroots_below`` the first pass's nodes are subroots."""
    for at in reversed(range(len(passes))):
        step, work = passes[at], _subroots_down if subroots_below and at == 0 else _chains_down
        nodes = _by_block(step.nodes, step.parts)
        chains = nodes.groupBy("g", "block").cogroup(_family(step, chains).groupBy("g", "block")).applyInArrow(work, _CHAIN)
    return chains


# ------------------------------------------------------------------ the operator
@dataclass
class Manifest:
    """A table's tree: leaves by block (with the caller's key and, where it is
    altered, the altered leaf), the passes of each group's tree and of the top tree, and the root."""

    leaves: DataFrame
    groups: list[Pass]
    top: list[Pass]
    root: bytes


def build_manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS, altered: Column | None = None, alter: str = "text") -> Manifest | None:
    """The manifest of ``docs``; rows where ``altered`` holds also get the leaf
    that they have with the field ``alter`` lower-cased.  None for an empty table."""
    columns = [F.col(c) for c in fields]
    changed = [lower_ascii(F.col(c).cast("string")) if c == alter else F.col(c) for c in fields]
    leaves = docs.select(
        F.col(group).cast("string").alias("grp"), F.col(key).alias("k"), leaf_digest(columns).alias("digest"),
        F.when(altered if altered is not None else F.lit(False), leaf_digest(changed)).alias("altered"), F.monotonically_increasing_id().alias("copy"),
    )
    leaves = materialise(leaves, "merkle-leaves")
    rows = numbered(leaves, "grp", ["k", "digest", "copy"], "merkle-order")
    groups = numbered(rows.groupBy("grp").agg(F.max("n").alias("n")).select("grp", F.lit(0).cast("long").alias("one")), None, ["grp"], "merkle-groups")
    groups = groups.select(F.col("grp").alias("grp_"), F.col("idx").alias("g"))
    rows = rows.join(groups, F.col("grp").eqNullSafe(F.col("grp_"))).select("g", "n", "idx", "digest", "altered", "k")
    rows = materialise(rows.withColumn("block", F.expr(f"idx div {BLOCK}")), "merkle-rows")
    if rows.isEmpty():
        return None
    passes, subroots = climb(rows, "merkle-parents")
    n = subroots.count()
    above = subroots.select(F.lit(0).cast("long").alias("g"), F.lit(n).cast("long").alias("n"), F.col("g").alias("idx"), "digest")
    top, root = climb(above, "merkle-top")
    return Manifest(rows, passes, top, bytes(root.first()["digest"]))


def fold_rows(m: Manifest) -> DataFrame:
    """``k``, ``leaf``, ``subroot``, ``root``, ``proof`` (hash of the siblings) and
    ``folded`` (the root that the altered or else the own leaf gives), as bytes."""
    spark = m.leaves.sparkSession
    start = spark.createDataFrame([(0, 0, b"", bytearray(m.root), b"")], _CHAIN)
    # the top tree's nodes are the groups' subroots, and those the blocks of the last pass
    chains = descend(m.top, start, subroots_below=True).select(F.col("idx").alias("g"), F.lit(0).cast("long").alias("idx"), "subroot", "root", "chain")
    chains = descend(m.groups[1:], chains)
    first = m.groups[0]
    leaves = _by_block(m.leaves, first.parts).groupBy("g", "block")
    kind = m.leaves.schema["k"].dataType.simpleString()
    return leaves.cogroup(_family(first, chains).groupBy("g", "block")).applyInArrow(_fold, f"k {kind}, leaf binary, subroot binary, root binary, proof binary, folded binary")


def manifest_report(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS, alter: str = "text") -> DataFrame:
    """Leaf, subroot, root, proof and the root folded from a third of the rows altered."""
    kind = docs.schema[key].dataType.simpleString()
    m = build_manifest(docs, key, group, fields, altered_every_third(F.col(key)), alter)
    if m is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    said = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")}
    return fold_rows(m).select(
        F.col("k").alias("doc_id"), said["leaf"].alias("leaf"), said["subroot"].alias("subroot"), said["root"].alias("root"),
        said["proof"].alias("proof_sha256"), said["folded"].alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
