"""What changed in a row, without a key.

``missing_rows`` says that a row is gone and that another has come; this module
says which belong together, and which cells differ.  A row is the set of
its (column, value) tokens.  Two rows of ``m`` columns that differ in at most
``c`` cells share ``m - c`` tokens or more, so in one order of all tokens, those
of fewest possible pairs first, they share one of their first ``c + 1``: an inverted index over these alone finds every such pair.

A token on many rows of both sides is never joined.  Its rows are told apart
by it and a second token, again the rarest ``c + 1`` of each row, and so on; rows
that still are many when they share ``m - c`` tokens are alike in all that
counts and are paired in order, one with one.

Candidates are matched stably: a pair is made when each row is the other's best,
by the number of equal cells and then by how rare the equal values are; both
leave, and the rest go on.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablesync.functions.columns import comparable
from tablesync.operators.reconcile import MISSING_IN_SOURCE, MISSING_IN_TARGET, NoCommonColumns, common_columns, missing_rows
from tablesync.sources.storage import held

#: Pairs that one token may make; beyond it takes another token to tell its rows apart.
MOST_PAIRS = 10_000
#: Rows of one token that are paired in order by one task.
ORDERED = 4096


def token_rows(missing: DataFrame, columns: list[str]) -> DataFrame:
    """Missing rows of both sides: ``side``, ``rid``, ``row`` and ``tokens`` (a hash a column)."""
    token = [F.xxhash64(F.lit(i), comparable(missing, c), F.col(f"`{c}`").isNull()) for i, c in enumerate(columns)]
    rows = missing.where(F.col("issue_type").isin(MISSING_IN_TARGET, MISSING_IN_SOURCE))
    side = F.when(F.col("issue_type") == MISSING_IN_TARGET, F.lit("s")).otherwise(F.lit("t"))
    return rows.select(side.alias("side"), F.monotonically_increasing_id().alias("rid"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.array(*token).alias("tokens"))


def _counted(entries: DataFrame) -> DataFrame:
    """``token`` and its rows on either side; only tokens of both sides can be shared."""
    n = entries.groupBy("token").agg(F.count_if(F.col("side") == "s").alias("sn"), F.count_if(F.col("side") == "t").alias("tn"))
    return n.select("token", "sn", "tn", (F.col("sn").cast("double") * F.col("tn")).alias("pairs"))


def _rarest(entries: DataFrame, by: list[str], least: int) -> DataFrame:
    """The ``least`` rarest tokens of each row (of each ``by``), with their counts.
    Tokens of one side come first: they take up what may differ."""
    ranked = entries.join(_counted(entries), "token")
    best = ranked.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list(F.struct("pairs", "token", "sn", "tn", "rest"))), 1, least).alias("some"))
    return best.select(*by, F.inline("some")).where("pairs > 0")


def candidates(rows: DataFrame, width: int, most_changed: int) -> DataFrame:
    """Distinct ``s, t`` (row ids): all pairs that differ in at most ``most_changed`` cells are among them."""
    least = most_changed + 1
    tokens = F.col("tokens")
    each = F.explode(F.transform(tokens, lambda x, i: F.struct(x.alias("token"), F.filter(tokens, lambda y, j: j != i).alias("rest")))).alias("e")
    entries = rows.select("side", "rid", each).select("side", "rid", "e.*")
    found: list[DataFrame] = []
    for used in range(1, width - most_changed + 1):
        keys = held(_rarest(entries, ["side", "rid"] if used == 1 else ["side", "rid", "base"], least), "cell-tokens")
        few = keys.where(F.col("pairs") <= MOST_PAIRS)
        found.append(_joined(few.where("side = 's'"), few.where("side = 't'"), ["token"]))
        many = keys.where(F.col("pairs") > MOST_PAIRS)
        if many.isEmpty():
            break
        if used == width - most_changed:
            # alike in all that counts: by number, in parts of a hot token
            part = F.pmod(F.xxhash64("rid"), F.ceil(F.greatest("sn", "tn") / ORDERED))
            placed = many.select("side", "rid", "token", part.alias("part")).distinct()
            placed = placed.withColumn("at", F.row_number().over(W.partitionBy("side", "token", "part").orderBy("rid")))
            found.append(_joined(placed.where("side = 's'"), placed.where("side = 't'"), ["token", "part", "at"]))
            break
        rest = F.col("rest")
        more = F.explode(F.transform(rest, lambda x, i: F.struct(F.xxhash64("token", x).alias("token"), F.filter(rest, lambda y, j: j != i).alias("rest")))).alias("e")
        entries = many.select("side", "rid", F.col("token").alias("base"), more).select("side", "rid", "base", "e.*")
    return reduce(DataFrame.unionByName, found).distinct()


def _joined(s: DataFrame, t: DataFrame, on: list[str]) -> DataFrame:
    return s.select(*on, F.col("rid").alias("s")).join(t.select(*on, F.col("rid").alias("t")), on).select("s", "t")


def _scored(pairs: DataFrame, rows: DataFrame, width: int, most_changed: int) -> DataFrame:
    """``s, t`` and ``score`` (equal cells, then their rarity) of the pairs that differ in few enough cells."""
    n = _counted(rows.select("side", F.explode("tokens").alias("token")))
    # rare values weigh more; those of one side only can't be equal
    weight = rows.select("side", "rid", F.posexplode("tokens").alias("at", "token")).where("side = 's'").join(n.where("pairs > 0"), "token")
    weights = weight.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("at", F.log1p("pairs").alias("w")))).alias("weights"))
    s = rows.where("side = 's'").join(weights, "rid", "left").select(F.col("rid").alias("s"), F.col("tokens").alias("st"), "weights")
    t = rows.where("side = 't'").select(F.col("rid").alias("t"), F.col("tokens").alias("tt"))
    equal = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.get("st", i) == F.get("tt", i))
    both = pairs.join(s, "s").join(t, "t").withColumn("equal", equal).where(F.size("equal") >= width - most_changed)
    rarity = F.aggregate("equal", F.lit(0.0), lambda a, i: a - F.coalesce(F.element_at("weights", i), F.lit(0.0)))
    # sums of doubles in one order: both rows see the same figure; ids decide what is left
    return both.select("s", "t", F.struct(F.size("equal").alias("equal"), F.round(rarity, 9).alias("rarity"), (-F.col("s")).alias("a"), (-F.col("t")).alias("b")).alias("score"))


def matched(pairs: DataFrame) -> DataFrame:
    """A stable matching of scored pairs: ``s, t``, each row at most once."""
    found: Optional[DataFrame] = None
    left = held(pairs, "cell-pairs")
    while not left.isEmpty():
        best = lambda own, other: left.groupBy(own).agg(F.max_by(other, "score").alias(other))  # noqa: E731, B023
        made = held(best("s", "t").join(best("t", "s"), ["s", "t"]), "cell-matches")
        found = made if found is None else found.unionByName(made)
        left = held(left.join(made.select("s"), "s", "left_anti").join(made.select("t"), "t", "left_anti"), "cell-pairs")
    return found if found is not None else pairs.select("s", "t")


def paired_rows(missing: DataFrame, columns: list[str], most_changed: int = 2) -> DataFrame:
    """Rows of :func:`missing_rows` that are each other's changed form: ``source``
    and ``target`` (structs of ``columns``) and ``changed`` (column names)."""
    width = len(columns)
    most = min(most_changed, width - 1)
    rows = held(token_rows(missing, columns), "cell-rows")
    pairs = matched(_scored(candidates(rows, width, most), rows, width, most))
    s = rows.where("side = 's'").select(F.col("rid").alias("s"), F.col("row").alias("source"), F.col("tokens").alias("st"))
    t = rows.where("side = 't'").select(F.col("rid").alias("t"), F.col("row").alias("target"), F.col("tokens").alias("tt"))
    names = F.array(*[F.lit(c) for c in columns])
    changed = F.filter(names, lambda c, i: F.get("st", i) != F.get("tt", i))
    return pairs.join(s, "s").join(t, "t").select("source", "target", changed.alias("changed"))


def _text(side: str, columns: list[str]) -> Column:
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.col(side)[c].cast("string"))])


def changed_cells(source: DataFrame, target: DataFrame, exclude: Iterable[str] = (), most_changed: int = 2) -> DataFrame:
    """One row a changed cell of rows that are on one side each and differ in at
    most ``most_changed`` cells: ``source``, ``target`` (the whole rows),
    ``column_name``, ``source_value`` and ``target_value`` (as text, null for null).

    Rows without a partner are missing, not changed, and have no row here.
    """
    columns = common_columns(source, target, exclude)
    if not columns:
        raise NoCommonColumns("no common columns between source and target after exclusions")
    pairs = paired_rows(missing_rows(source, target, exclude), columns, most_changed)
    cells = pairs.select("source", "target", F.explode("changed").alias("column_name"))
    value = lambda side: F.element_at(_text(side, columns), F.col("column_name")).alias(f"{side}_value")
    return cells.select("source", "target", "column_name", value("source"), value("target"))
