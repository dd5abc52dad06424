"""Finding the keys of a table.

Incremental sync needs ``keys``, which nobody states.  :func:`minimal_keys`
finds the smallest sets of columns whose values (null equals null) tell all rows
apart, level by level: sets of one column, then of two, and so on, never a set
that holds a key already found.

Most sets are dismissed without a shuffle of rows: one scan of the table gives
the distinct counts of a whole batch of sets by HyperLogLog, and a set whose
estimate stays well below the number of rows is no key.  (A set also can't be
one if the products of its parts' counts stay below that.)  What remains is
confirmed over all rows: digests of the set's values are grouped, and any that
occurs twice settles it.  A first look groups only some digests: those of one
``SLICES``th of their range, in which equal rows meet, and those of as many rows
by chance, which finds values with many copies.  Nearly all sets that are no key
end there; only the rest moves all its digests, once, and these have no value
with more than some hundred copies, so nothing is folded before that shuffle and
no task of it holds a table of all its rows.  A digest has 128 bits, so over n
rows two different values are taken for one with a probability of about n^2 / 2^129.
"""

from __future__ import annotations

from itertools import combinations
from typing import Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.columns import comparable

#: Sets whose sketches one scan fills.
BATCH = 24
#: Relative deviation of a sketch, and the deviations below the number of rows from which a set is dismissed.
RSD, DEVIATIONS = 0.02, 6
#: Sets that are confirmed by one job.
TOGETHER = 8
#: Of this many digests the first look takes one.
SLICES = 64
#: Digests that a task groups at once.
TASK_DIGESTS = 1 << 20


def _values(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Values and null flags, so that ``(1, null)`` and ``(null, 1)`` differ."""
    return [comparable(df, c) for c in columns] + [F.col(f"`{c}`").isNull() for c in columns]


def distinct_estimates(df: DataFrame, sets: Sequence[Sequence[str]]) -> list[int]:
    """About how many distinct values each set of columns has; one scan for each ``BATCH`` sets."""
    out: list[int] = []
    for lo in range(0, len(sets), BATCH):
        some = sets[lo : lo + BATCH]
        row = df.agg(*[F.approx_count_distinct(F.xxhash64(*_values(df, s)), RSD).alias(f"n{i}") for i, s in enumerate(some)]).first()
        out += [int(row[f"n{i}"]) for i in range(len(some))]
    return out


def _digests(df: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """``i, a, b``: the digest of each row's values of the set with number ``i``."""
    digests = F.array(*[F.struct(F.lit(i).alias("i"), F.xxhash64(F.lit(1), *_values(df, s)).alias("a"), F.xxhash64(F.lit(2), *_values(df, s)).alias("b")) for i, s in enumerate(sets)])
    return df.select(F.inline(digests))


def _first_look(digests: DataFrame) -> DataFrame:
    """The digests of a slice of their range, and some of the rest by chance."""
    return digests.filter((F.pmod("a", F.lit(SLICES)) == 0) | (F.rand(7) < 1 / SLICES))


def _brought_together(digests: DataFrame, n: int) -> DataFrame:
    """All ``n`` digests, equal ones in one partition."""
    usual = int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return digests.repartition(max(usual, -(-n // TASK_DIGESTS)), "a")


def _twice(digests: DataFrame) -> set[int]:
    """Numbers of the sets with a digest that occurs twice."""
    counted = digests.groupBy("i", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    return {r["i"] for r in counted.filter("n > 1").select("i").distinct().collect()}  # a number a set


def confirmed(df: DataFrame, sets: Sequence[Sequence[str]], rows: Optional[int] = None) -> list[bool]:
    """For each set of columns whether no two rows agree on it, ``TOGETHER`` sets
    by one job: a first look at some digests, then all digests of the sets that passed."""
    passed: list[int] = []
    for lo in range(0, len(sets), TOGETHER):
        some = sets[lo : lo + TOGETHER]
        twice = _twice(_first_look(_digests(df, some)))
        passed += [lo + i for i in range(len(some)) if i not in twice]
    if passed and rows is None:
        rows = df.count()
    keys: set[int] = set()
    for lo in range(0, len(passed), TOGETHER):
        some = passed[lo : lo + TOGETHER]
        twice = _twice(_brought_together(_digests(df, [sets[i] for i in some]), rows * len(some)))
        keys |= {at for i, at in enumerate(some) if i not in twice}
    return [i in keys for i in range(len(sets))]


def minimal_keys(df: DataFrame, columns: Optional[Iterable[str]] = None, most: Optional[int] = None) -> list[tuple[str, ...]]:
    """All minimal keys of up to ``most`` columns (None: of any number), smallest
    first, columns in the table's order.

    A table of no or one row has the empty key.  A table whose whole rows
    repeat has none.
    """
    names = [c for c in df.columns if columns is None or c in set(columns)]
    rows = df.count()
    if rows <= 1:
        return [()]
    found: list[tuple[str, ...]] = []
    # the most values a set can have, by the sketches of its parts
    above: dict[tuple[str, ...], float] = {}
    slack = 1 + DEVIATIONS * RSD
    for size in range(1, min(len(names), most or len(names)) + 1):
        sets = [s for s in combinations(names, size) if not any(set(k) <= set(s) for k in found)]
        if not sets:
            break
        if size == 2 and not found and not confirmed(df, [names], rows)[0]:
            return []  # whole rows repeat: no set can tell them apart
        if size > 1:
            def bound(s: tuple[str, ...]) -> float:
                return min((above.get(s[:i] + s[i + 1 :], float("inf")) * above.get((s[i],), float("inf")) for i in range(size)), default=float("inf"))

            hopeless = {s for s in sets if bound(s) < rows}
            above.update({s: bound(s) for s in hopeless})
            sets = [s for s in sets if s not in hopeless]
        likely = []
        for s, n in zip(sets, distinct_estimates(df, sets)):
            above[s] = min(rows, n * slack)
            if n * slack >= rows:
                likely.append(s)
        found += [s for s, ok in zip(likely, confirmed(df, likely, rows)) if ok]
    return found


def keys_table(tables: dict[str, DataFrame], most: Optional[int] = None) -> DataFrame:
    """One row a minimal key: ``table_name``, ``key_columns`` (comma-joined) and ``key_size``."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, ",".join(k), len(k)) for name, df in tables.items() for k in minimal_keys(df, most=most)]
    return spark.createDataFrame(rows, "table_name string, key_columns string, key_size int")
