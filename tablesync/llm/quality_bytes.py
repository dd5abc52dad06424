"""Operator 10 over bytes: the quality classifier of the pipeline.

:mod:`.quality` models words in order; its n-grams shuffle many times the input
(figures in the README), more than a pipeline of five stages may.  This one needs
little more than the texts, but sees no more than four bytes, so most texts of one
word said again and again pass it.  The model is an interpolated modified Kneser-Ney model of order 4 over UTF-8
bytes, one for each language, counted over all trusted texts (labelled good
and not toxic).  Bytes as tokens keep marks, case and digits, hold any
language, and an n-gram is its own exact key.

Training: tasks count 4-grams with map-side sums, a shuffle by n-gram adds
them up; lower orders count distinct left neighbours; discounts come from the
counts of counts of each language and order; a row of the model holds, for one
n-gram, its discounted probability and, as a context, its back-off weight.

Scoring: documents are dealt into blocks of some MB; a block asks for the
distinct n-grams it holds, the requests are joined with the sharded model, and
what was found comes back to the block, which scores its documents byte by
byte.  No task or driver ever holds the model.

Decision: a language's threshold is ``SLACK`` times the ``QUANTILE`` of the
perplexities of its trusted texts.  A text goes if its perplexity is above the
threshold by more than chance explains: its mean log loss less twice the
standard error (which is large for short texts) must still be above.

Defined cases: null and empty texts have no perplexity and stay; a null
language is a language of its own; texts of a language without trusted text
have no threshold and stay; a document with labels that disagree isn't
trusted; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_worker, materialise, partitions_for, text_pieces

ORDER = 4
#: The slack is the least, by quarters, that kept over 99.5 % of held-out good texts in both halves of the labels of sf0.1.
QUANTILE, SLACK = 0.99, 1.25
#: Trusted ids (16 bytes each) up to which they are broadcast; beyond, the join shuffles.
TRUSTED_BROADCAST = 2_000_000
#: Bytes of stored input that make a block.
BLOCK_BYTES = 8 << 20
#: Bytes of text whose n-grams are worked on at once.
PIECE_BYTES = 1 << 19
BEGIN, END = 0xFF, 0xFE  # bytes that UTF-8 never holds
SYMBOLS = 257


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends in each byte of each row and in its end mark, and where rows start."""
    n = np.diff(off)
    rows = len(n)
    padded = np.full(len(data) + ORDER * rows, BEGIN, np.uint32)
    own = np.arange(len(data)) + np.repeat(np.arange(rows) * ORDER + ORDER - 1, n)
    ends = off[1:] + np.arange(rows) * ORDER + ORDER - 1
    padded[own] = data
    padded[ends] = END
    at = np.sort(np.concatenate([own, ends]))
    gram = padded[at]
    for i in range(1, ORDER):
        gram = gram | (padded[at - i] << np.uint32(8 * i))
    return gram, off[:-1] + np.arange(rows)


def _suffix(gram: np.ndarray, n: int) -> np.ndarray:
    return gram & np.int64((1 << 8 * n) - 1)


def _key(gram: np.ndarray, n: int) -> np.ndarray:
    return np.int64(n << 32) | gram


def _by_language(langs: pa.Array) -> Iterator[tuple[str, pa.Array]]:
    found = langs.dictionary_encode()
    for code, name in enumerate(found.dictionary.to_pylist()):
        yield name, pa.array(np.flatnonzero(found.indices.to_numpy(zero_copy_only=False) == code))


def count_grams(texts: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n``: the 4-grams of all texts (columns ``lang``, ``text``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        for b in batches:
            for lang, rows in _by_language(b.column(0)):
                gram, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)
                for _, _, data, off in text_pieces(b.column(1).take(rows), PIECE_BYTES):
                    g, c = np.unique(_grams(data, off)[0], return_counts=True)
                    gram, inverse = np.unique(np.concatenate([gram, g]), return_inverse=True)
                    n = np.bincount(inverse, np.concatenate([n, c])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    found = texts.select("lang", "text").mapInArrow(work, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(texts: DataFrame) -> DataFrame:
    """The model: ``lang``, ``key`` (length and n-gram), ``alpha``, ``gamma``."""
    level = materialise(count_grams(texts), "lm-counts")
    levels = [level.withColumn("len", F.lit(ORDER))]
    for n in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.col("gram").bitwiseAND((1 << 8 * n) - 1).alias("gram")).agg(F.count("*").alias("n"))
        levels.append(level.withColumn("len", F.lit(n)))
    grams = levels[0]
    for other in levels[1:]:
        grams = grams.unionByName(other)
    counts = [F.sum(F.when(F.col("n") == i, 1).otherwise(0)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    # where counts of counts are missing (tiny corpora), 0.5, 1 and 1.5; 0.1 at least, so that every text has a chance
    cuts = [F.coalesce(F.greatest(F.lit(0.1), F.least(F.lit(float(i)), i - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0.0)))), F.lit(i / 2)) for i in (1, 2, 3)]
    discounts = grams.groupBy("lang", "len").agg(*counts).select("lang", "len", *[c.alias(f"d{i}") for i, c in enumerate(cuts, 1)])
    cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    # a row a language and order
    cutted = grams.join(F.broadcast(discounts), ["lang", "len"]).withColumns({"cut": cut, "context": F.shiftright("gram", 8)})
    contexts = cutted.groupBy("lang", "len", "context").agg(F.sum("n").alias("total"), F.sum("cut").alias("cut_off"))
    alpha = cutted.join(contexts, ["lang", "len", "context"]).select("lang", (F.col("len") * F.lit(1 << 32) + F.col("gram")).alias("key"), ((F.col("n") - F.col("cut")) / F.col("total")).alias("alpha"), F.lit(None).cast("double").alias("gamma"))
    gamma = contexts.select("lang", ((F.col("len") - 1) * F.lit(1 << 32) + F.col("context")).alias("key"), F.lit(None).cast("double").alias("alpha"), (F.col("cut_off") / F.col("total")).alias("gamma"))
    model = alpha.unionByName(gamma).groupBy("lang", "key").agg(F.max("alpha").cast("float").alias("alpha"), F.max("gamma").cast("float").alias("gamma"))
    return materialise(model, "lm-model")


def _requests(docs: DataFrame) -> DataFrame:
    """``block``, ``lang``, ``key``: what the rows of each block need of the model."""
    at = [docs.columns.index(c) for c in ("block", "lang", "text")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        held: dict[tuple[int, str], np.ndarray] = {}
        for b in batches:
            block = b.column(at[0]).to_numpy(zero_copy_only=False)
            for number in np.unique(block):
                rows = pa.array(np.flatnonzero(block == number))
                for lang, some in _by_language(b.column(at[1]).take(rows)):
                    key = (int(number), lang)
                    for _, _, data, off in text_pieces(b.column(at[2]).take(rows.take(some)), PIECE_BYTES):
                        held[key] = np.union1d(held.get(key, np.zeros(0, np.uint32)), _grams(data, off)[0])
            yield from ()
        for (number, lang), gram in held.items():
            gram = gram.astype(np.int64)
            parts = [_key(gram, ORDER)]
            for n in range(ORDER - 1, -1, -1):  # shorter n-grams, and contexts of all
                parts.append(np.unique(np.concatenate([_key(_suffix(gram, n), n), _key(_suffix(gram, n + 1) >> 8, n)])))
            keys = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), number, np.int32)), pa.array([lang] * len(keys), pa.string()), pa.array(keys)], names=["block", "lang", "key"])

    return docs.mapInArrow(work, "block int, lang string, key long")  # a block is in one task, so no row comes twice


def _score_block(docs: pa.Table, model: pa.Table) -> pa.Table:
    free_worker()
    n = docs.num_rows
    mean, low = np.full(n, np.nan), np.full(n, np.nan)
    langs = model.column("lang").combine_chunks() if model.num_rows else pa.array([], pa.string())
    tables = dict(_by_language(langs))
    for lang, rows in _by_language(docs.column("lang").combine_chunks()):
        some = model.take(tables[lang]) if lang in tables else model.slice(0, 0)
        order = np.argsort(some.column("key").to_numpy())
        keys = some.column("key").to_numpy()[order]
        values = {c: some.column(c).to_numpy()[order].astype(float) for c in ("alpha", "gamma")}

        def look(column: str, wanted: np.ndarray, missing: float, keys=keys, values=values) -> np.ndarray:
            if not len(keys):
                return np.full(len(wanted), missing)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            got = np.where(keys[at] == wanted, values[column][at], missing)
            return np.where(np.isnan(got), missing, got)

        rows = rows.to_numpy()
        texts = docs.column("text").combine_chunks().take(pa.array(rows))
        for lo, hi, data, off in text_pieces(texts, PIECE_BYTES):
            gram, start = _grams(data, off)
            kinds, which = np.unique(gram, return_inverse=True)
            kinds = kinds.astype(np.int64)
            p = np.full(len(kinds), 1 / SYMBOLS)
            for k in range(1, ORDER + 1):
                g = _suffix(kinds, k)
                p = look("alpha", _key(g, k), 0.0) + look("gamma", _key(g >> 8, k - 1), 1.0) * p
            loss = -np.log(p)[which]
            count = np.diff(np.append(start, len(gram)))
            total, square = np.add.reduceat(loss, start), np.add.reduceat(loss * loss, start)
            m = total / count
            error = np.sqrt(np.maximum(square / count - m * m, 0) / count)
            filled = np.diff(off) > 0
            mean[rows[lo:hi][filled]] = m[filled]
            low[rows[lo:hi][filled]] = (m - 2 * error)[filled]
    keep = docs.select(["doc_id", "th", "lang", "trusted"])
    return keep.append_column("loss", pa.array(mean, from_pandas=True)).append_column("least_loss", pa.array(low, from_pandas=True))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: ``doc_id``, ``th`` (hash of its text), ``lang``,
    ``perplexity``, ``threshold``, ``trusted`` and ``keep``."""
    kind = docs.schema[key].dataType.simpleString()
    said = F.col(text).cast("string")
    good = labels.groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"), F.count("quality").alias("n"), F.count("*").alias("all"))
    good = good.filter("q = 1 and t = 0 and n = all and doc_id is not null").select("doc_id", F.lit(True).alias("trusted"))
    if good.count() <= TRUSTED_BROADCAST:
        good = F.broadcast(good)
    held = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(said, F.lit("")).alias("text"), F.xxhash64(said).alias("th"))
    held = held.join(good, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    model = train(held.filter("trusted and text != ''"))
    blocks = partitions_for(docs, BLOCK_BYTES, 8)
    dealt = held.withColumn("block", F.pmod(F.xxhash64("doc_id", "th"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    found = _requests(dealt).join(model, ["lang", "key"]).select("block", "lang", "key", "alpha", "gamma")
    scored = dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_score_block, f"doc_id {kind}, th long, lang string, trusted boolean, loss double, least_loss double")
    scored = materialise(scored, "lm-scores")
    # losses in thousandths: a bounded number of values for the exact quantile
    limits = scored.filter("trusted").groupBy("lang").agg(F.percentile(F.round("loss", 3), QUANTILE).alias("limit")).withColumn("limit", F.col("limit") + F.log(F.lit(SLACK)))
    out = scored.join(F.broadcast(limits), "lang", "left")  # a row a language
    return out.select(
        "doc_id", "th", "lang", F.exp("loss").alias("perplexity"), F.exp("limit").alias("threshold"), "trusted",
        F.coalesce(F.col("least_loss") <= F.col("limit"), F.lit(True)).alias("keep"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    bad = score(docs, labels, key, text, lang).filter("not keep").select(F.col("doc_id").alias("rejected id"), F.col("th").alias("rejected text")).distinct()
    same = F.col(key).eqNullSafe(F.col("rejected id")) & F.xxhash64(F.col(text).cast("string")).eqNullSafe(F.col("rejected text"))
    return docs.join(bad, same, "left_anti")
