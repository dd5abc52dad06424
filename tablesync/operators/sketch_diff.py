"""Missing rows by invertible sketches.

:func:`tablesync.operators.reconcile.missing_rows` shuffles both tables.  Two
catalogs that are nearly in step need far less: each row becomes a digest of
128 bits that is added to three cells of a lookup table, with the source's sign
for source rows and the other for target rows.  What is on both sides cancels
out, so the cells hold the difference alone, and their number is chosen from
the size of the difference, not of the tables.

1. :func:`difference_size` estimates how many digests differ: random signs are
   summed in a fixed number of buckets, and the sum of their squares estimates
   the sum of squared differences of copies.
2. :func:`cells_of` builds the lookup table with one ``groupBy(cell)``: copies,
   sums of both halves of the digests and of a check value.  Sums, not exclusive ors, so that
   rows with copies come out as well.
3. :func:`peel` takes, round by round, the cells that hold one digest only
   (sums divided by the copies give a digest whose check value agrees), and
   subtracts it from its other cells.  When no cell is left all are known; when
   cells are left but none is pure, the table was too small: it grows and the
   work is done again.
4. The rows of these digests are fetched from both sides and compared by value
   as ever, so what is reported is what ``missing_rows`` reports.

A task sends at most one row a cell.  Both tasks and cells grow with tables whose
difference does, so where all tasks together would send more than the rows have
digests, the digests move instead, once, with nothing folded before: equal ones
cancel where they meet, and only what is left becomes cells.  Where the difference
is so large that the cells are more than the rows, the plain comparison is used.

Rows are fetched by a join with the digests found, behind a filter of bits that is
broadcast (``FILTER_BITS`` at most), so that few others are shuffled for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Optional

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablesync.functions.columns import comparable
from tablesync.operators.reconcile import NoCommonColumns, apply_filter, common_columns, missing_rows
from tablesync.sources.storage import held

#: Buckets of the estimate; its relative error is about sqrt(2 / BUCKETS).
BUCKETS = 4096
#: Cells for each digest that differs (below 1.23 peeling fails), and at least.
LOAD, LEAST_CELLS = 2.0, 192
HASHES = 3
#: Growth of a table that didn't peel.
GROWTH = 4
#: Size of a cell in digests, as the shuffle stores both.
CELL_DIGESTS = 3
#: Copies of one digest (as a part of all rows) beyond which copies are folded before digests move.
HOT = 1 / 256
#: Bits of the filter for each digest found, and at most (8 MB).
BITS, FILTER_BITS = 16, 1 << 26
_SUM = "decimal(28,0)"


@dataclass(frozen=True)
class Peeled:
    """Digests that differ: ``a``, ``b`` and ``n`` (copies in the source less those in
    the target), the cells that it took, the rounds, and how many tables were too small."""

    keys: DataFrame
    cells: int
    rounds: int
    too_small: int


def row_digest(df: DataFrame, columns: Iterable[str]) -> list[Column]:
    """Two 64-bit hashes over all values and their null flags, as ``a`` and ``b``."""
    columns = list(columns)
    values = [comparable(df, c) for c in columns] + [F.col(f"`{c}`").isNull() for c in columns]
    return [F.xxhash64(F.lit(1), *values).alias("a"), F.xxhash64(F.lit(2), *values).alias("b")]


def signed_digests(source: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    """``a, b`` of all rows; ``n`` is 1 for the source's and -1 for the target's."""
    names = {c.lower(): c for c in target.columns}
    s = source.select(*row_digest(source, columns), F.lit(1).cast("long").alias("n"))
    return s.unionByName(target.select(*row_digest(target, [names[c.lower()] for c in columns]), F.lit(-1).cast("long").alias("n")))


def difference_size(digests: DataFrame) -> tuple[int, int]:
    """An estimate of the sum of n^2 over differing digests (so of their number, or
    more where copies differ), and the number of rows."""
    sign = F.when(F.col("b") >= 0, F.col("n")).otherwise(-F.col("n"))
    buckets = digests.groupBy(F.pmod("a", F.lit(BUCKETS)).alias("bucket")).agg(F.sum(sign).alias("z"), F.count("*").alias("rows"))
    got = buckets.agg(F.sum(F.col("z").cast("decimal(19,0)") * F.col("z").cast("decimal(19,0)")).alias("squares"), F.sum("rows").alias("rows")).first()
    return int(got["squares"] or 0), int(got["rows"] or 0)


def _check(a: Column, b: Column) -> Column:
    return F.xxhash64(F.lit(3), a, b)


def cells_of(digests: DataFrame, cells: int) -> DataFrame:
    """The lookup table of weighted digests: ``cell``, ``n`` and the sums ``sa``, ``sb``, ``sc``; empty cells are absent."""
    width = -(-cells // HASHES)
    at = [(F.pmod(F.xxhash64(F.lit(10 + j), "a", "b"), F.lit(width)) + j * width).alias("cell") for j in range(HASHES)]
    c = _check(F.col("a"), F.col("b"))
    rows = digests.select("a", "b", "n", c.alias("c"), F.explode(F.array(*at)).alias("cell"))
    total = lambda x: F.sum((F.col("n") * F.col(x).cast("decimal(20,0)")).cast(_SUM))
    return _nonzero(rows.groupBy("cell").agg(F.sum("n").alias("n"), total("a").alias("sa"), total("b").alias("sb"), total("c").alias("sc")))


def cancelled(digests: DataFrame, cells: int, rows: int) -> DataFrame:
    """``digests`` as they are where their tasks send fewer cells than ``rows`` digests
    take; else those whose weights don't cancel, once each, after one shuffle of all."""
    seen = digests.select(F.pmod("a", F.lit(BUCKETS)).alias("bucket"), F.spark_partition_id().alias("task")).groupBy("bucket").agg(F.count("*").alias("n"), F.max("task").alias("task"))
    most, last = seen.agg(F.max("n"), F.max("task")).first()
    tasks = (last or 0) + 1
    if tasks * min(cells, HASHES * rows // tasks) * CELL_DIGESTS <= rows:
        return digests
    # with many copies of one digest tasks fold their own first
    met = digests if most > rows * HOT else digests.repartition("a")
    return met.groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n <> 0")


def _nonzero(cells: DataFrame) -> DataFrame:
    return cells.filter("n <> 0 or sa <> 0 or sb <> 0 or sc <> 0")


def pure(cells: DataFrame) -> DataFrame:
    """``a, b, n`` of the digests that are alone in some cell, once each."""
    beyond = F.lit(str(1 << 63)).cast("decimal(20,0)")
    whole = lambda x: (F.col("n") != 0) & (F.abs(x) <= F.abs("n") * beyond) & (F.col(x) % F.col("n") == 0)
    divided = cells.filter(whole("sa") & whole("sb")).select("n", "sc", *[(F.col(x).cast("decimal(38,0)") / F.col("n").cast("decimal(19,0)")).cast("decimal(20,0)").alias(k) for k, x in (("da", "sa"), ("db", "sb"))])
    inside = F.lit(True)
    for k in ("da", "db"):
        inside = inside & (F.col(k) >= -beyond) & (F.col(k) < beyond)
    keys = divided.filter(inside).select(F.col("da").cast("long").alias("a"), F.col("db").cast("long").alias("b"), "n", "sc")
    right = (F.col("n") * _check(F.col("a"), F.col("b")).cast("decimal(20,0)")).cast(_SUM) == F.col("sc")
    return keys.filter(right).select("a", "b", "n").dropDuplicates(["a", "b"])


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written below the shared folder, and its rows, observed on the way."""
    seen = Observation()
    out = held(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, int(seen.get["n"])


def peel(digests: DataFrame, cells: int) -> Peeled:
    """All differing digests, from tables of ``cells`` cells or as many more as it takes."""
    too_small = 0
    while True:
        table, left = _counted(cells_of(digests, cells), "sketch-cells")
        found: Optional[DataFrame] = None
        rounds = 0
        while left:
            keys, n = _counted(pure(table), "sketch-keys")
            if not n:
                break
            rounds += 1
            found = keys if found is None else found.unionByName(keys)
            less = cells_of(keys.withColumn("n", -F.col("n")), cells)
            rest = table.unionByName(less).groupBy("cell").agg(*[F.sum(c).cast("long" if c == "n" else _SUM).alias(c) for c in ("n", "sa", "sb", "sc")])
            table, left = _counted(_nonzero(rest), "sketch-cells")
        if not left:
            if found is None:
                found = digests.sparkSession.createDataFrame([], "a long, b long, n long")
            # a digest taken in two rounds (its copies were told apart wrongly at first) counts once
            return Peeled(found.groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n <> 0"), cells, rounds, too_small)
        too_small += 1
        cells *= GROWTH


def _bits(keys: DataFrame, bits: int) -> DataFrame:
    """``at``, ``bits``: the filter of the digests' ``a``, in pieces of 4 KB."""
    place = F.pmod("a", F.lit(bits))
    return keys.groupBy(F.bitmap_bucket_number(place).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def _maybe(rows: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """``rows`` whose digest ``_da`` may be among ``keys``."""
    place = F.pmod("_da", F.lit(bits))
    of = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(of / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    some = rows.join(F.broadcast(_bits(keys, bits).toDF("_at", "_bits")), F.bitmap_bucket_number(place) == F.col("_at"))
    return some.filter(F.getbit(byte, F.pmod(of, F.lit(8)).cast("int")) == 1).drop("_at", "_bits")


def missing_rows_by_sketch(
    source: DataFrame,
    target: DataFrame,
    exclude: Iterable[str] = (),
    source_filter: Optional[str] = None,
    target_filter: Optional[str] = None,
    with_evidence: bool = False,
    cells: Optional[int] = None,
) -> DataFrame:
    """:func:`missing_rows` with traffic in proportion to the difference.

    ``cells`` is the size of the first lookup table (by default from
    :func:`difference_size`); one that is too small grows.
    """
    columns = common_columns(source, target, exclude)
    if not columns:
        raise NoCommonColumns("no common columns between source and target after exclusions")
    s, t = apply_filter(source, source_filter), apply_filter(target, target_filter)
    digests = signed_digests(s, t, columns)
    if cells is None:
        size, rows = difference_size(digests)
        cells = max(LEAST_CELLS, int(LOAD * size * (1 + 4 * (2 / BUCKETS) ** 0.5)))
        if HASHES * cells > rows > LEAST_CELLS * HASHES:
            return missing_rows(s, t, exclude, with_evidence=with_evidence)
        digests = cancelled(digests, cells, rows)
    keys, found = _counted(peel(digests, cells).keys.select("a", "b"), "sketch-found")
    bits = min(FILTER_BITS, BITS * found + 1)

    def rows_of(df: DataFrame, names: list[str]) -> DataFrame:
        # an inner join of distinct keys: a semi join would be moved below the filter
        a, b = row_digest(df, names)
        return _maybe(df.withColumns({"_da": a, "_db": b}), keys, bits).join(keys.toDF("_da", "_db"), ["_da", "_db"]).drop("_da", "_db")

    names = {c.lower(): c for c in t.columns}
    return missing_rows(rows_of(s, columns), rows_of(t, [names[c.lower()] for c in columns]), exclude, with_evidence=with_evidence)
