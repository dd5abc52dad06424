"""Operator 5: removal of repeated multi-line chunks.

A text is cut into lines, lines are hashed, and a rolling hash over the last
``WINDOW`` line hashes chooses where a chunk ends (about every ``SPREAD`` lines,
after two lines at least; a single last line joins the chunk before it).  So
boundaries depend on nearby lines only, and an inserted or lost line moves no
boundary further on.

Chunks of two lines or more that hold more than white space are counted over
all documents.  A chunk stays in the document with the smallest id (null is
smaller than all) and goes from all others; inside one document only its first
occurrence stays.

Whether a chunk is found depends on what surrounds it, so ``passage_words``
asks for repeated passages as well, wherever they begin and end: every two
neighbouring lines are counted like a chunk, and a longest run of lines whose
neighbours repeat goes if it has more than that many words.  So a passage of
two lines or more and more words, in one piece in a document of a smaller id,
goes as a whole.  Then a last chunk is also tried without its joined line.

Either way each line that goes stays in a document of a smaller id, or earlier
in its own: what is removed points to an equal line there, and so on to one
that isn't removed.

Counting goes by a hash of the lines' hashes.  Of what repeats, the texts
themselves are compared too: a hash that stands for two different texts,
should that ever happen, removes nothing.

Copies are folded before each shuffle; a document's own list of repeated
hashes is the longest list that is ever gathered.

Defined cases: null text stays null; a text without line feeds stays; rows of
the same id count as one document for what they share; columns but id and text
are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SPREAD = 2, 2
#: Words beyond which the queries remove repeated passages of any boundaries.
PASSAGE_WORDS = 50
_ODD = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1

Span = tuple[int, int]


def _hash(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _line_hashes(lines: list[str]) -> list[bytes]:
    return [_hash(line.encode("utf-8", "surrogatepass")) for line in lines]


def _key(hashes: list[bytes]) -> tuple[int, int]:
    """The hash of some lines."""
    h = _hash(b"".join(hashes))
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _spans(hashes: list[bytes]) -> list[Span]:
    """First line and last line + 1 of each chunk, in order."""
    out, start, before = [], 0, []
    for i, h in enumerate(hashes):
        before = [*before, int.from_bytes(h[:8], "little")][-WINDOW:]
        rolling = 0
        for b in before:
            rolling = (rolling * _ODD + b) & _ALL
        if i - start >= 1 and (rolling * _ODD & _ALL) >> 40 & (SPREAD - 1) == 0:
            out.append((start, i + 1))
            start = i + 1
    if start < len(hashes):
        out.append((start, len(hashes)))
    if len(out) > 1 and out[-1][1] - out[-1][0] == 1:
        out[-2:] = [(out[-2][0], out[-1][1])]
    return out


def chunks_of(text: str) -> list[list[str]]:
    """The lines of each chunk of a text, in order."""
    lines = text.split("\n")
    return [lines[a:b] for a, b in _spans(_line_hashes(lines))]


def _counted(chunk: list[str]) -> bool:
    return len(chunk) > 1 and any(line.strip() for line in chunk)


class _Cut:
    """A text's lines, chunks, and what is counted of them: ``chunks`` and, if asked for, ``pairs``, by place."""

    def __init__(self, text: str, passages: bool):
        self.lines = text.split("\n")
        hashes = _line_hashes(self.lines)
        self.spans = _spans(hashes)
        tried = list(self.spans)
        if passages and tried[-1][1] - tried[-1][0] > 2:
            tried.append((tried[-1][0], tried[-1][1] - 1))
        self.chunks = {s: _key(hashes[s[0] : s[1]]) for s in tried if _counted(self.lines[s[0] : s[1]])}
        pairs = [(i, i + 2) for i in range(len(self.lines) - 1)] if passages else []
        self.pairs = {s: _key(hashes[s[0] : s[1]]) for s in pairs if _counted(self.lines[s[0] : s[1]])}

    def said(self, span: Span) -> str:
        return "\n".join(self.lines[span[0] : span[1]])

    def counted(self) -> list[tuple[Span, tuple[int, int]]]:
        return [*self.chunks.items(), *self.pairs.items()]

    def removed(self, gone: set[tuple[int, int]], words: int | None) -> list[bool]:
        """For each line, whether it goes if what has the hashes ``gone`` does."""
        n = len(self.lines)
        out, repeated = [False] * n, [False] * n
        for found, marks in ((self.chunks, out), (self.pairs, repeated)):
            first: dict[tuple[int, int], Span] = {}
            for s, k in found.items():
                # here once is enough
                if k in gone or (k in first and self.said(first[k]) == self.said(s)):
                    marks[s[0] : s[1]] = [True] * (s[1] - s[0])
                first.setdefault(k, s)
        a = 0
        while a < n:
            b = a
            while b < n and repeated[b]:
                b += 1
            if b > a and sum(len(line.split()) for line in self.lines[a:b]) > words:
                out[a:b] = [True] * (b - a)
            a = b + 1
        return out


def _key_rows(docs: DataFrame, passages: bool) -> DataFrame:
    """``doc_id``, ``th`` and hash ``h1, h2`` of what is counted of each row, once each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                row, h1, h2 = [], [], []
                for r, text in enumerate(part.column(2).to_pylist()):
                    if not text or "\n" not in text:
                        continue
                    for k in dict.fromkeys(k for _, k in _Cut(text, passages).counted()):
                        row.append(r)
                        h1.append(k[0])
                        h2.append(k[1])
                at = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=["doc_id", "th", "h1", "h2"])

    kind = docs.schema["__id"].dataType.simpleString()
    return docs.select("__id", "__th", "__text").mapInArrow(work, f"doc_id {kind}, th long, h1 long, h2 long")


def _text_rows(held: DataFrame, at: int, passages: bool) -> DataFrame:
    """Hash ``h1, h2`` and ``said``, the text, of what is in the list of each row (its last column)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                h1, h2, said = [], [], []
                for text, listed in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist()):
                    if not listed:
                        continue
                    cut, wanted = _Cut(text, passages), {(g["h1"], g["h2"]) for g in listed}
                    for k, t in dict.fromkeys((k, cut.said(s)) for s, k in cut.counted() if k in wanted):
                        h1.append(k[0])
                        h2.append(k[1])
                        said.append(t)
                yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(said, pa.string())], names=["h1", "h2", "said"])

    return held.mapInArrow(work, "h1 long, h2 long, said string")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", passage_words: int | None = None) -> DataFrame:
    """``docs`` with its text less the repeated chunks (and, with ``passage_words``,
    the repeated passages of more words than that), and the columns
    ``n_lines``, ``n_chunks`` and ``n_removed`` (lines) in ``line_dedup``, a struct
    (a column of that name is replaced)."""
    docs = docs.drop("line_dedup")
    names, passages = docs.columns, passage_words is not None
    said, ident = f"_{names.index(text)}", f"_{names.index(key)}"
    # by number, so that no name of the input clashes with one used here
    held = docs.toDF(*[f"_{i}" for i in range(len(names))]).withColumn(said, F.col(said).cast("string"))
    columns = held.columns
    held = held.withColumns({"__id": F.col(ident), "__text": F.col(said), "__th": F.xxhash64(said)})
    rows = _key_rows(held, passages)
    # one row a hash; a null id comes before all, so it keeps what it has
    many = rows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("keeper"), (F.count("doc_id") < F.count("*")).alias("by_null")).filter("n > 1")
    many = many.select("h1", "h2", F.when(~F.col("by_null"), F.col("keeper")).alias("keeper"))
    listed = rows.join(many, ["h1", "h2"]).withColumn("goes", ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # rows of one id and text are alike, so their lists are too; the id goes by its hash as it may be null
    listed = listed.groupBy(F.xxhash64("doc_id").alias("__ih"), F.col("th").alias("__th")).agg(F.collect_set(F.struct("h1", "h2", "goes")).alias("__listed"))
    held = held.withColumn("__ih", F.xxhash64("__id")).join(listed, ["__ih", "__th"], "left")
    held = held.select(*columns, "__listed")
    at, out = columns.index(said), len(columns)
    # hashes of two texts: none unless blake2b fails, so one row with an empty list
    two = _text_rows(held, at, passages).groupBy("h1", "h2", "said").count().groupBy("h1", "h2").agg(F.count("*").alias("texts")).filter("texts > 1")
    held = held.crossJoin(F.broadcast(two.agg(F.collect_list(F.struct("h1", "h2")).alias("__two"))))
    kind = "struct<n_lines:int,n_chunks:int,n_removed:int>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for whole, listed, two in zip(b.column(at).to_pylist(), b.column(out).to_pylist(), b.column(out + 1).to_pylist()):
                if whole is None:
                    texts.append(None)
                    counts.append({"n_lines": 0, "n_chunks": 0, "n_removed": 0})
                    continue
                cut = _Cut(whole, passages)
                gone = {(g["h1"], g["h2"]) for g in listed or () if g["goes"]} - {(g["h1"], g["h2"]) for g in two}
                removed = cut.removed(gone, passage_words)
                texts.append("\n".join(line for line, r in zip(cut.lines, removed) if not r))
                counts.append({"n_lines": len(cut.lines), "n_chunks": len(cut.spans), "n_removed": sum(removed)})
            made = b.columns[:out]
            made[at] = pa.array(texts, pa.string())
            counted = pa.array(counts, pa.struct([(n, pa.int32()) for n in ("n_lines", "n_chunks", "n_removed")]))
            yield pa.RecordBatch.from_arrays([*made, counted], names=[*columns, "line_dedup"])

    schema = ", ".join([f"{c} {held.schema[c].dataType.simpleString()}" for c in columns] + [f"line_dedup {kind}"])
    return held.mapInArrow(work, schema).toDF(*names, "line_dedup")


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", passage_words: int | None = None) -> DataFrame:
    """Id, counts and the text that stays of every document."""
    out = dedup_lines(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), passage_words=passage_words)
    return out.select("doc_id", F.col("line_dedup.n_lines").alias("n_lines"), F.col("line_dedup.n_chunks").alias("n_chunks"), F.col("line_dedup.n_removed").alias("n_removed"), "text")
