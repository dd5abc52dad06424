"""Operator 8: count-only Viterbi over a unigram vocabulary.

Gives the number of tokens that the ``tokenizers`` library's Unigram model
makes of a text, without making the tokens: spaces become word marks, each
word is taken by itself with the mark in front (Metaspace, always prepended),
cut where no entry spans two neighbouring characters (only if the scores are
whole numbers, so that no sum rounds); Aho-Corasick enumerates the
vocabulary's matches, and dynamic programming over positions carries the best score and the number of tokens on that path.

Tie rules are the library's: a path replaces another only when its score is
greater, and paths come by their start, so of equal paths to a position the
one whose last token starts first stays.  A character that is no entry by
itself may be taken as unknown, at the least score of the vocabulary minus 10;
each unknown character counts as its UTF-8 bytes (byte fallback).

Vocabulary: the pieces and scores of a SentencePiece model file.
Defined cases: null and the empty text have 0 tokens; repeated rows give
repeated results; other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import gc
import hashlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_cache
from .pieces import model_bytes

#: Words kept by a Python worker (results don't depend on it).
CACHE_WORDS = 600_000
MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value


class UnigramCounter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in {p: s for p, s in vocabulary if p}.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        #: neighbours inside some entry; elsewhere a text can be cut, exactly so only if sums of scores don't round
        self.inner = {p[i : i + 2] for p, _ in vocabulary for i in range(len(p) - 1)}
        self.whole = all(float(s).is_integer() and abs(s) < 2**32 for _, s in vocabulary)
        self.words, self.words_before = {}, {}
        self.units: dict[str, int] = {}

    def count(self, unit: str) -> int:
        """Tokens of the best path through ``unit``."""
        n = len(unit)
        starts: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for last, (size, score) in self.automaton.iter(unit):
            starts[last - size + 1].append((size, score))
        best: list[float | None] = [None] * (n + 1)
        tokens = [0] * (n + 1)
        best[0] = 0.0
        for at in range(n):
            here, made = best[at], tokens[at] + 1
            single = False
            for size, score in starts[at]:
                end, score = at + size, score + here
                if best[end] is None or score > best[end]:
                    best[end], tokens[end] = score, made
                single = single or size == 1
            if not single:
                score = self.unknown + here
                if best[at + 1] is None or score > best[at + 1]:
                    best[at + 1], tokens[at + 1] = score, tokens[at] + len(unit[at].encode())
        return tokens[n]

    def _word(self, word: str) -> int:
        made = self.words_before.get(word)
        if made is None:
            made = self._units(MARK + word) if self.whole else self.count(MARK + word)
        if len(word) <= 64:
            if len(self.words) > CACHE_WORDS // 2:
                self.words, self.words_before = {}, self.words
            self.words[word] = made
        return made

    def _units(self, word: str) -> int:
        inner, known, total, lo, n = self.inner, self.units, 0, 0, len(word)
        for i in range(1, n + 1):
            if i == n or word[i - 1 : i + 1] not in inner:
                unit = word[lo:i]
                made = known.get(unit)
                if made is None:
                    made = self.count(unit)
                    if len(known) > CACHE_WORDS // 2:
                        known.clear()
                    if len(unit) <= 64:
                        known[unit] = made
                total += made
                lo = i
        return total

    def text_count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        words = (text[1:] if text[0] == MARK else text).split(MARK)
        known, make = self.words.get, self._word
        return sum([known(w) or make(w) for w in words])


def piece_vocabulary(proto: bytes) -> list[tuple[str, float]]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.vocab_size())]


def token_counts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``n_tokens`` (long) of every whole text."""
    proto = model_bytes(docs, model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(200_000, 20, 100)
        raw = proto.value
        m = worker_cache("unigram " + hashlib.sha256(raw).hexdigest(), lambda: UnigramCounter(piece_vocabulary(raw)))
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                n = [m.text_count(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64())], names=[key, "n_tokens"])

    df = docs.select(key, F.col(text).cast("string").alias("text"))
    return df.mapInArrow(work, f"`{key}` {df.schema[0].dataType.simpleString()}, n_tokens long")
