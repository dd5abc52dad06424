"""Operator 12: quality rules with adaptive limits.

A text's words are runs of characters but space and tab to carriage return.  Some
rules are fixed (fewer than ``LEAST_WORDS`` words; more than a fifth of the
words in five-word windows that the text repeats).  The others have no fixed
cutoff: of all texts that pass the fixed rules, each rule's measure goes into a
quantile sketch of the text's language and source, and the limits follow from
the sketch's quantiles.

The sketch counts values in buckets whose ends grow by ``GROWTH``, so a quantile
is right within half of that; two sketches merge by adding their counts, as
``merged`` does to get a language's from its sources'.  A sketch is a small table that can be stored
and added to later, and gives the same answer in whatever order rows came.

A limit lies ``SPREAD`` times the way from the median to the outer quantile
beyond the latter, and no nearer than the rule's ``slack``, so a
group without outliers loses nothing.  A group of fewer than ``LEAST_ROWS``
texts takes the limits of its language, or of all texts if that is small too.
Texts get their limits by a join on language and source, and stay if all
measures lie inside.

Texts are measured once, row by row, into a narrow table; only numbers are
shuffled, counts folded before that.  Only DataFrame functions run on the executors.

Defined cases: null is the empty text, which fails (it has no ten words); null
languages and sources are groups of their own; repeated rows each count; an
empty table has no rows and no limits; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
SYMBOLS = "#*$%&|<>"
MARKS = "!?;:\"()[]{}=+/\\~^_@"
SPACE = r"\x20\x09-\x0D"

#: Ratio of a bucket's ends.
GROWTH = 1.02
#: Outer and middle quantiles, and how far beyond the outer ones a limit lies.
LOW, MIDDLE, HIGH, SPREAD = 0.1, 0.5, 0.9, 3.0
#: Texts that a group's own limits take.
LEAST_ROWS = 200
_ZERO = -(1 << 31)


@dataclass(frozen=True)
class Rule:
    """A measure of a text, whether it is limited below and above, and the least
    distance between a limit and the outer quantile."""

    name: str
    value: Column
    slack: float
    low: bool = False
    high: bool = True


def rules() -> list[Rule]:
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return [
        Rule("word_length", F.col("word_chars") / per_word, 1.0, low=True),
        Rule("symbols", F.col("n_symbols") / per_word, 0.1),
        Rule("marks", F.col("n_marks") / per_word, 0.25),
        Rule("capitals", F.col("n_capitals") / per_word, 0.2),
        Rule("dup_lines", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.2),
        Rule("stutter", F.col("n_stutter") / per_word, 0.1),
    ]


# ------------------------------------------------------------------ measures
def _occurrences(text: Column, characters: str) -> Column:
    """How often any of some ASCII characters stands in a text."""
    size = F.octet_length(text)
    return sum((size - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in characters), F.lit(0)).cast("long")


def _covered(spots: Column) -> Column:
    """Words under windows that begin at the rising places ``spots``."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
    step = lambda a, p: F.struct((a["words"] + p + WINDOW - F.greatest(p, a["end"])).alias("words"), (p + WINDOW).alias("end"))
    return F.aggregate(spots, start, step, lambda a: a["words"]).cast("long")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Key, groups (as ``g0``, ``g1``) and the counts that the rules are made of."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    own = [F.col(c).alias(f"g{i}") for i, c in enumerate(groups)]
    held = ["doc_id", *[f"g{i}" for i in range(len(groups))]]
    df = docs.select(F.col(key).alias("doc_id"), *own, said.alias("said"))
    with_word = F.filter(F.split("said", "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))
    df = df.select(*held, "said", F.regexp_extract_all("said", F.lit(f"[^{SPACE}]+"), F.lit(0)).alias("words"), with_word.alias("lines"))
    capital = lambda w: (F.length(w) > 1) & (w == F.upper(w)) & (w != F.lower(w))
    df = df.select(
        *held, "words", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _occurrences(F.col("said"), SYMBOLS).alias("n_symbols"), _occurrences(F.col("said"), MARKS).alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", capital)).cast("long").alias("n_capitals"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    stutter = F.filter("hashes", lambda h, i: (i > 0) & (h == F.get("hashes", i - 1)))
    df = df.withColumn("n_stutter", F.size(stutter).cast("long"))
    counts = [c for c in df.columns if c not in ("words", "hashes")]
    # equal windows have equal hashes; most texts repeat none and end here
    window = F.filter(F.transform("hashes", lambda h, i: F.when(i + WINDOW <= F.size("hashes"), F.xxhash64(*[F.get("hashes", i + j) for j in range(WINDOW)]))), lambda h: h.isNotNull())
    df = df.select(*counts, "words", window.alias("windows"))
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    nothing = F.array().cast("array<struct<h:bigint,at:int>>")
    df = df.select(*counts, "words", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(placed)).otherwise(nothing).alias("placed"))
    # neighbours of one hash are compared word by word

    def same(a: Column, b: Column) -> Column:
        alike = a["h"] == b["h"]
        for j in range(WINDOW):
            alike = alike & (F.get("words", a["at"] + j) == F.get("words", b["at"] + j))
        return F.coalesce(alike, F.lit(False))

    twice = F.filter("placed", lambda x, i: same(x, F.get("placed", i - 1)) | same(x, F.get("placed", i + 1)))
    df = df.select(*counts, F.sort_array(F.transform(twice, lambda x: x["at"])).alias("spots"))
    return df.select(*counts, _covered(F.col("spots")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


# ------------------------------------------------------------------ sketches
def sketched(values: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The sketch of ``rule, value`` rows: ``n`` values a bucket."""
    bucket = F.when(F.col("value") > 0, F.ceil(F.log("value") / F.log(F.lit(GROWTH))).cast("int")).otherwise(_ZERO)
    return values.groupBy(*groups, "rule", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sketches added up over all but ``groups``."""
    return sketch.groupBy(*groups, "rule", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, groups: Sequence[str], at: dict[str, float]) -> DataFrame:
    """The sketch's number of values, and for each name its quantile, per group and rule."""
    whole = W.partitionBy(*groups, "rule")
    upto = whole.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    df = sketch.withColumn("upto", F.sum("n").over(upto)).withColumn("rows", F.sum("n").over(whole))
    # the middle of a bucket, by the ratio of its ends
    middle = F.when(F.col("bucket") > _ZERO, 2 * F.pow(F.lit(GROWTH), F.col("bucket")) / (GROWTH + 1)).otherwise(0.0)
    found = [F.min(F.when(F.col("upto") >= F.ceil(q * F.col("rows")), F.struct("bucket", middle.alias("value"))))["value"].alias(name) for name, q in at.items()]
    return df.groupBy(*groups, "rule").agg(F.max("rows").alias("rows"), *found)


def limits(sketch: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``low_<rule>`` and ``high_<rule>`` of each group (null: no limit), one row a group, and its ``rows``."""
    q = quantiles(sketch, groups, {"low": LOW, "middle": MIDDLE, "high": HIGH})
    out = []
    for r in rules():
        mine = F.col("rule") == r.name
        step = lambda outer: F.greatest(F.abs(F.col(outer) - F.col("middle")) * SPREAD, F.lit(r.slack))
        if r.low:
            out.append(F.max(F.when(mine, F.col("low") - step("low"))).alias(f"low_{r.name}"))
        if r.high:
            out.append(F.max(F.when(mine, F.col("high") + step("high"))).alias(f"high_{r.name}"))
    return q.groupBy(*groups).agg(F.max("rows").alias("rows"), *out)


def adaptive_limits(rows: DataFrame, groups: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Limits for every group of measured ``rows``, its own or a larger group's, and their names."""
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), r.value.cast("double").alias("value")) for r in rules()]))
    values = rows.filter(~base_failed()).select(*groups, each.alias("v")).select(*groups, "v.*")
    sketch = materialise(sketched(values, groups), "rule-sketches")
    # groups whose texts all fail the fixed rules have a row as well
    out = rows.select(*groups).distinct()
    found: list[list[Column]] = []
    for n in range(len(groups), -1, -1):
        some = list(groups[:n])
        mine = limits(merged(sketch, some), some)
        names = [c for c in mine.columns if c.startswith(("low_", "high_"))]
        mine = mine.select(*[F.col(c).alias(f"{c}_") for c in some], F.col("rows").alias(f"rows_{n}"), *[F.col(c).alias(f"{c}_{n}") for c in names])
        on = F.lit(True)
        for c in some:
            on = on & F.col(c).eqNullSafe(F.col(f"{c}_"))
        out = out.join(mine, on, "left").drop(*[f"{c}_" for c in some]) if some else out.join(mine, F.lit(1) == F.lit(1), "left")
        found.append([(F.coalesce(F.col(f"rows_{n}"), F.lit(0)) >= LEAST_ROWS) if n else F.lit(True), n])
    chosen = []
    for c in names:
        pick = None
        for enough, n in found:
            pick = F.when(enough, F.col(f"{c}_{n}")) if pick is None else pick.when(enough, F.col(f"{c}_{n}"))
        chosen.append(pick.alias(c))
    return out.select(*groups, *chosen), names


def inside(names: Sequence[str]) -> Column:
    """Whether all measures lie within the limits."""
    value = {r.name: r.value for r in rules()}
    ok = F.lit(True)
    for c in names:
        side, rule = c.split("_", 1)
        ok = ok & F.coalesce(value[rule] >= F.col(c) if side == "low" else value[rule] <= F.col(c), F.lit(True))
    return ok


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: Sequence[str] = ("lang", "source")) -> DataFrame:
    """The measures of every row, ``base_failed`` and ``kept``."""
    own = [f"g{i}" for i in range(len(groups))]
    rows = materialise(measured(docs, key, text, groups), "rule-measures")
    table, names = adaptive_limits(rows, own)
    table = table.select(*[F.col(c).alias(f"{c}_") for c in own], *names)
    on = F.lit(True)
    for c in own:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}_"))
    out = rows.join(table, on, "left").withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & inside(names)).drop(*[f"{c}_" for c in own])


def rule_report(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: Sequence[str] = ("lang", "source")) -> DataFrame:
    return judged(docs, key, text, groups).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
