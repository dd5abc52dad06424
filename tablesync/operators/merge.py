"""Three-way merge of metadata facts (M2, M7).

A two-way plan sees that source and target differ, not who edited.  With the
state that both had after the last sync as a third input, an edit on the source
is told from one on the target: what only one side edited is taken from that
side, what both edited alike is agreed, and what they edited differently is a
conflict, which is reported and settled by a rule.

All three tables are tagged, unioned and grouped by the facts' keys in one
shuffle, copies folded before it; nothing is joined, so a hot key makes no pairs.
Keys match null-safe, and a null value is a value: only a missing row is no fact.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.metadata import KEEP, SET, UNSET

SIDES = ("base", "source", "target")


def _same(a: str, b: str) -> Column:
    """Whether a fact is alike on two sides: there with one value, or on neither."""
    return (F.col(f"in_{a}") == F.col(f"in_{b}")) & F.col(f"{a}_value").eqNullSafe(F.col(f"{b}_value"))


def three_way_plan(source: DataFrame, target: DataFrame, base: DataFrame, keys: Sequence[str], value_col: str, prefer: str = "target") -> DataFrame:
    """One row a fact: keys, ``origin`` (``unchanged``, ``source``, ``target``,
    ``both`` or ``conflict``: who edited it since ``base``), ``action`` on the
    target (``keep``, ``set``, ``unset``), the final value in ``value_col`` (null
    where the fact is gone), and the three sides' values.

    Conflicts are settled for the side that ``prefer`` names (``source`` or
    ``target``).  A fact that a side holds more than once counts with its largest value.
    """
    if prefer not in ("source", "target"):
        raise ValueError(f"prefer is source or target, not {prefer!r}")
    parts = [df.select(*keys, F.col(value_col).alias("_v"), F.lit(side).alias("_side")) for side, df in zip(SIDES, (base, source, target))]
    here = lambda side: F.col("_side") == side
    facts = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(*keys).agg(
        *[F.coalesce(F.bool_or(here(s)), F.lit(False)).alias(f"in_{s}") for s in SIDES], *[F.max(F.when(here(s), F.col("_v"))).alias(f"{s}_value") for s in SIDES]
    )
    by_source, by_target = ~_same("base", "source"), ~_same("base", "target")
    origin = (
        F.when(by_source & by_target, F.when(_same("source", "target"), F.lit("both")).otherwise(F.lit("conflict")))
        .when(by_source, F.lit("source")).when(by_target, F.lit("target")).otherwise(F.lit("unchanged"))
    )
    facts = facts.withColumn("origin", origin)
    takes = (F.col("origin") == "source") | ((F.col("origin") == "conflict") & F.lit(prefer == "source"))
    there = F.when(takes, F.col("in_source")).otherwise(F.col("in_target"))
    value = F.when(takes, F.col("source_value")).otherwise(F.col("target_value"))
    action = F.when(~takes, F.lit(KEEP)).when(F.col("in_source"), F.lit(SET)).otherwise(F.lit(UNSET))
    # a fact that neither side holds any more needs nothing done and leaves no row of a plan to apply
    return facts.select(*keys, "origin", action.alias("action"), value.alias(value_col), there.alias("remains"), *[f"{s}_value" for s in SIDES])


def merged_facts(plan: DataFrame, keys: Sequence[str], value_col: str) -> DataFrame:
    """The facts that a plan leaves: the target's new state, and the base of the next sync."""
    return plan.where("remains").select(*keys, value_col)
