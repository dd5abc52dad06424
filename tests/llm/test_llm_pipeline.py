"""The pipeline against the plain versions of its stages, one after the other."""

import math
import random
from collections import defaultdict

import pytest
import sentencepiece
from llm_helpers import SF001, cut_passages, documents, edge_docs, jaccard, mean_byte_losses, windows_hit, words
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_pipeline_equals_plain_stages(spark):
    from tablesync.llm.quality_bytes import score

    df = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    lang = {r["doc_id"]: r["lang"] for r in df.collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0}
    limit = {r["lang"]: r["threshold"] for r in score(df, labels).select("lang", "threshold").distinct().collect()}
    rows = documents()
    losses = mean_byte_losses([(lang[d], t) for d, t in rows], [(lang[d], t) for d, t in rows if d in good])
    rows = [r for r, (_, least) in zip(rows, losses) if least is None or limit[lang[r[0]]] is None or least <= math.log(limit[lang[r[0]]])]
    before = dict(rows)
    rows = [(d, t) for d, t in cut_passages(rows) if t or t == before[d]]
    rows = [r for r, (d, _, least, _) in zip(rows, jaccard(rows)) if d == least or not words(r[1])]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    rows = [r for r, hit in zip(rows, windows_hit(rows, items)) if not hit[2]]
    sp = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.vocabulary("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF001).collect()}
    assert set(got) == {d for d, _ in rows}
    for d, t in rows:
        assert got[d]["text"] == t and got[d]["ids"] == sp.encode(t) and got[d]["decoded"] == sp.decode(sp.encode(t))
        assert got[d]["n_chars"] == len(t) and got[d]["n_tokens"] == len(got[d]["ids"])


CARRIED = ["hit", "th", "__th", "line_dedup", "block", "__hit", "kept id", "rejected id", "rejected text", "carried_3", "perplexity", "ids"]


def test_stages_on_odd_rows(spark):
    docs = edge_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    # a value of its own in every column of every row, to be found beside the row's id and text
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(" "), F.xxhash64(F.coalesce("text", F.lit("none"))).cast("string")) for c in CARRIED})
    before = defaultdict(list)
    for r in docs.collect():
        before[r["th"]].append(r)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF001)
        kept = [c for c in docs.columns if n < 4 or c != "ids"]
        assert out.columns == docs.columns if n < 4 else out.columns == [*kept, "ids", "n_tokens", "decoded"], name
        rows = out.collect()
        assert 0 < len(rows) <= docs.count(), name
        for r in rows:
            changes = {"text", "n_chars"} if n == 1 else set()
            assert any(all(r[c] == was[c] for c in kept if c not in changes) for was in before[r["th"]]), name
        assert stage(spark, docs.limit(0), SF001).count() == 0


def test_repeated_passages_go_whole_in_stage_2(spark):
    r = random.Random(11)
    lines = lambda n, words: "\n".join(" ".join(f"w{r.randrange(10**6)}" for _ in range(words)) for _ in range(n))
    rows, planted = [], []
    for n in range(2, 7):
        for _ in range(20):
            passage = lines(n, -(-60 // n))
            for _ in range(2):
                planted.append((len(rows), passage))
                rows.append((len(rows), f"{lines(r.randint(1, 3), 12)}\n{passage}\n{lines(r.randint(1, 3), 12)}"))
    out = {x["doc_id"]: x["text"] for x in corpus_pipeline.lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF001).collect()}
    assert len(out) == len(rows)
    for (first, passage), (second, _) in zip(planted[::2], planted[1::2]):
        assert passage in out[first] and not any(line in out[second] for line in passage.split("\n"))
