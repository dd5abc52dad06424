"""Operator 9: shards of near equal bytes by histogram sort.

The sort key is (hash of the text, hash of the id, number of the row), so equal
texts stand side by side.  Keys and sizes are written once to the shared folder.  Then each
round counts the exact bytes of the key ranges that still hold an open
boundary, split by the next bits of the key (at most ``2**BITS`` ranges for
each boundary come to the driver): a boundary is settled when a range starts
within the tolerance of its exact share, else its range is refined.  Ranges of
one text are only refined by id, and rows that are wholly equal by their
number, where such a group is larger than the tolerance.  When all splitters are settled, rows are exchanged once.

Slots: a shard is dealt out over cells by a hash, counts of cells give each
cell its first slot by prefix sum, and rows are numbered inside their cell, so
no task sorts a whole shard.

Law: ``bytes``.  Every shard's bytes differ from an exact share by the
tolerance (a fiftieth of a share, half of it at either end) or the largest
document, whichever is more.

Defined cases: null text has the size 16 and the crc of no bytes; a null id is
a key like others; which of some wholly equal rows goes where isn't fixed; an
empty table gives no rows; other columns are ignored.
Only DataFrame functions run on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

#: Key bits that a round refines by.
BITS = 10
#: A boundary may miss its exact place by this part of a shard.
TOLERANCE = 0.01
#: Rows that are numbered together.
CELL_ROWS = 250_000
LEAST = -(1 << 63)


#: The parts of the key, in order.
KEY = ("th", "ih", "copy")


@dataclass
class _Open:
    """A boundary that isn't settled: it lies among the keys that begin with
    ``fixed`` and whose next part shares ``bits`` bits with ``at``."""

    target: float
    below: int = 0
    fixed: tuple[int, ...] = ()
    at: int = 0
    bits: int = 0

    def range(self) -> tuple:
        return self.fixed, self.at, self.bits


def key_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    said = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(said) + 16).cast("long").alias("size"), F.crc32(said).alias("text_crc32"),
        F.xxhash64(said).alias("th"), F.xxhash64(F.col(key)).alias("ih"), F.monotonically_increasing_id().alias("copy"),
    )


def _range_start(at: int, bits: int) -> int:
    """Least signed 64-bit key whose top bits are ``at`` (signed as well)."""
    return at << (64 - bits)


def _splitter(fixed: tuple[int, ...], start: int) -> tuple[int, ...]:
    """The whole key of the first row that has ``fixed`` and ``start`` or more."""
    return (*fixed, start, *[LEAST] * (len(KEY) - len(fixed) - 1))


def find_splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, ...]]:
    """First keys of the second and all later shards."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    settled: dict[int, tuple[int, ...]] = {}
    waiting = {s: _Open(total * s / shards) for s in range(1, shards)} if total else {}
    slack = tolerance * total / shards
    while waiting:
        ranges = {o.range(): o.below for o in waiting.values()}
        inside, cell = [], []
        for i, (fixed, at, bits) in enumerate(ranges):
            part = F.col(KEY[len(fixed)])
            here = F.lit(True)
            for name, value in zip(KEY, fixed):
                here = here & (F.col(name) == value)
            if bits:
                here = here & (F.shiftright(part, 64 - bits) == at)
            inside.append(F.when(here, F.lit(i)))
            finer = F.struct(F.shiftright(part, 64 - min(64, bits + BITS)).alias("at"), part.alias("value"))
            cell.append(F.when(F.col("range") == i, finer))
        counted = (
            keys.select(*KEY, "size", F.coalesce(*inside).alias("range")).filter(F.col("range").isNotNull())
            .select("range", "size", F.coalesce(*cell).alias("cell")).select("range", "size", "cell.*")
            .groupBy("range", "at").agg(F.sum("size").alias("size"), F.min("value").alias("first"), F.max("value").alias("last"))
            .collect()
        )
        by: dict[int, list] = {}
        for r in counted:
            by.setdefault(r["range"], []).append(r)
        for i, ((fixed, at, bits), below) in enumerate(ranges.items()):
            finer = min(64, bits + BITS)
            cells = sorted(by.get(i, []), key=lambda r: r["at"])
            for s, o in [(s, o) for s, o in waiting.items() if o.range() == (fixed, at, bits)]:
                under, best = below, None
                for place, c in enumerate(cells):
                    if best is None or abs(under - o.target) < best[0]:
                        best = (abs(under - o.target), _splitter(fixed, _range_start(c["at"], finer)))
                    if under + c["size"] >= o.target:
                        break
                    under += c["size"]
                over = abs(under + c["size"] - o.target)
                if over < best[0] and place + 1 < len(cells):
                    best = (over, _splitter(fixed, _range_start(cells[place + 1]["at"], finer)))
                alone = c["first"] == c["last"]
                if best[0] <= slack or (alone and len(fixed) + 1 == len(KEY)):
                    settled[s] = best[1]
                elif alone:
                    waiting[s] = _Open(o.target, under, (*fixed, c["first"]))
                else:
                    waiting[s] = _Open(o.target, under, fixed, c["at"], finer)
        waiting = {s: o for s, o in waiting.items() if s not in settled}
    return [settled[s] for s in sorted(settled)]


def shard_of(splitters: list[tuple[int, ...]]) -> Column:
    """Number of splitters at or below the key."""
    out = F.lit(0)
    for values in splitters:
        reached = F.lit(True)
        for name, value in reversed(list(zip(KEY, values))):
            reached = F.when(F.col(name) == value, reached).otherwise(F.col(name) > value) if value != LEAST else reached
        out = out + reached.cast("int")
    return out


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``."""
    keys = materialise(key_table(docs, key, text), "shard-keys")
    rows = keys.count()
    cells = max(1, -(-rows // (shards * CELL_ROWS)))
    placed = keys.withColumn("shard", shard_of(find_splitters(keys, shards)))
    placed = placed.withColumn("cell", F.pmod(F.xxhash64(*KEY), F.lit(cells)).cast("int"))
    sizes = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    in_cell = W.partitionBy("shard", "cell").orderBy(*KEY)
    numbered = placed.withColumn("row", F.row_number().over(in_cell)).join(first, ["shard", "cell"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.col("row") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
