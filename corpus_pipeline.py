"""A training-corpus pipeline of five of the operators in ``tablesync.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.

1. quality classifier, by its model over bytes: documents that it rejects go
2. line dedup: repeated multi-line chunks, and repeated passages of two lines or
   more and over 50 words, are cut from texts; a document that loses its last line goes
3. n-gram Jaccard join: of each class of near copies the document with the
   smallest id stays (texts without words are no copies of each other)
4. benchmark decontamination: documents that hold a passage of an item go
5. SentencePiece: ids, and the text that they decode to

Columns that no stage uses are carried along, whatever their names and values;
the last stage's own (``ids``, ``n_tokens``, ``decoded``) replace columns of these names.

Defined cases: a null or empty text passes stages 1 and 2 as it is, has no words in
3 and 4 and no ids in 5, and so stays; null ids are ids (smallest of all in 2, never
the one that is kept in 3 while its class has another); rows that repeat id and text
become one in stage 3, unless they have no words; of a class of near copies with
one smallest id the text with the least hash stays; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import load, materialise
from tablesync.llm.decontaminate import find_benchmark
from tablesync.llm.jaccard import jaccard_classes
from tablesync.llm.linededup import PASSAGE_WORDS, dedup_lines
from tablesync.llm.pieces import with_pieces
from tablesync.llm.quality_bytes import keep_good
from tablesync.llm.queries import vocabulary

#: No SQL: a perplexity model, rolling hashes and a tokenizer decide.
ORACLE_SQL = None

#: Columns that stages work on.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def carried(stage):
    """A stage that sees its own columns by name and all others by number, so that
    none of their names meets one that an operator uses inside."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        out = stage(spark, docs.toDF(*[c if c in OWN else f"carried_{i}" for i, c in enumerate(names)]), sf_dir)
        return out.toDF(*names, *out.columns[len(names) :])

    return run_stage


@carried
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, load(spark, sf_dir, "labels"))


@carried
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs, passage_words=PASSAGE_WORDS)
    emptied = (F.col("line_dedup.n_removed") > 0) & (F.col("line_dedup.n_removed") == F.col("line_dedup.n_lines"))
    out = out.filter(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        cut = F.col("line_dedup.n_removed") > 0
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@carried
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class, with the smallest id (of several texts of that id
    the one with the least hash); rows without words all stay."""
    classes = jaccard_classes(docs).filter("size > 0").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    one = classes.groupBy("class_key").agg(F.min(F.struct("ih", "th")).alias("one")).distinct().select(F.col("one.ih").alias("kept id"), F.col("one.th").alias("kept text"))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), F.lit(False))
    is_kept = (F.xxhash64("doc_id") == F.col("kept id")) & (F.xxhash64("text") == F.col("kept text"))
    chosen = docs.filter(~wordless).join(one, is_kept, "left_semi").dropDuplicates(["doc_id", "text"])
    return chosen.unionByName(docs.filter(wordless))


@carried
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_benchmark(docs, load(spark, sf_dir, "benchmark"))
    return found.filter(F.size("hit.spans") == 0).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_pieces(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontaminated), ("SentencePiece", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = materialise(docs, f"pipeline-{at}")
    return docs
