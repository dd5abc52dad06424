"""Operator 4: exact SentencePiece encoding and decoding by backtracking.

A text is cut where no piece of the vocabulary spans two neighbouring
characters (there no merge can ever happen), and each unit is encoded by
itself.  Encoding a unit goes left to right: take the longest piece that
starts here (all matches come from one Aho-Corasick pass), accept it when it
can stand after the piece before it, else try its next shorter prefix, else
step back; a bitfield remembers positions that lead nowhere.  Two pieces can
stand side by side when merging their joined text from single characters
gives the same two pieces again.  A merge-type encoding is the only sequence
of pieces whose neighbours all pass that check.

Defined cases: null is the empty text; the empty text has no ids; a character
outside the vocabulary becomes its UTF-8 bytes; repeated rows give repeated
results; other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import gc
import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, worker_cache

#: Units kept by a Python worker; the table starts anew beyond it (results don't depend on it).
CACHE_UNITS = 200_000
SPACE = "▁"


class PieceModel:
    """Vocabulary of a merge-type SentencePiece model with byte fallback."""

    def __init__(self, proto: bytes, small: bool = False):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        #: smaller tables of units and neighbours, for more time: beside workers of other steps
        self.small = small
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_id)}
        self.piece_of: dict[int, str] = {}
        for i in range(sp.vocab_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                p = sp.id_to_piece(i)
                self.id_of[p], self.score[p], self.piece_of[i] = i, sp.get_score(i), p
        self.inner = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}
        #: no piece goes on with a space after another character, so words can be looked up whole
        self.cut_at_space = all(pair[1] != SPACE or pair[0] == SPACE for pair in self.inner)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p in self.id_of:
            if self._merge(p) == [p]:  # a piece that merging never makes is no candidate
                self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.beside: dict[tuple[str, str], bool] = {}
        self.same = {p: p for p in self.id_of}  # one string of each piece for all the tables
        self.shorter: dict[str, str] = {}
        #: piece or character, unit, word: (its ids after commas, bytes they decode to); of the last two, the younger and the older half
        self.one: dict[str, tuple[str, bytes]] = {}
        self.units, self.units_before = {}, {}
        self.words, self.words_before = {}, {}

    # ---- merging from single characters: only on the joined text of two pieces
    def _merge(self, text: str) -> list[str]:
        parts, score = list(text), self.score
        none = float("-inf")
        pair = [score.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pair and (best := max(pair)) != none:
            i = pair.index(best)  # the leftmost of equals
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = score.get(parts[i - 1] + parts[i], none)
            if i < len(pair):
                pair[i] = score.get(parts[i] + parts[i + 1], none)
        return parts

    def _fits(self, left: str, right: str) -> bool:
        if len(self.beside) > CACHE_UNITS // (2 if self.small else 1):
            self.beside.clear()
        same = self.same.get
        ok = self.beside[same(left, left), same(right, right)] = self._merge(left + right) == [left, right]
        return ok

    def _shorter(self, piece: str) -> str:
        """The longest proper prefix that is a candidate, a single character at least; empty if there is none."""
        got = self.shorter.get(piece)
        if got is None:
            got = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if n == 1 or piece[:n] in self.automaton), "")
            self.shorter[piece] = got
        return got

    def split(self, unit: str) -> list[str]:
        """The pieces of a unit, by backtracking; a character outside the vocabulary stands for itself."""
        n = len(unit)
        longest = [1] * n
        for last, size in self.automaton.iter(unit):
            at = last - size + 1
            if size > longest[at]:
                longest[at] = size
        open_ends = (1 << (n + 1)) - 1  # bit i: no dead end is known at i
        out: list[str] = []
        known, fits = self.beside, self._fits
        at, piece, left = 0, unit[: longest[0]], ""
        while at < n:
            while piece:
                end = at + len(piece)
                if open_ends >> end & 1:
                    ok = not left or known.get((left, piece))
                    if ok is None:
                        ok = fits(left, piece)
                    if ok:
                        break
                piece = self.shorter.get(piece)
                if piece is None:
                    piece = self._shorter(unit[at:end])
            if piece:
                out.append(piece)
                at, left = end, piece
                piece = unit[at : at + longest[at]] if at < n else ""
            else:
                open_ends &= ~(1 << at)
                piece = out.pop()
                at -= len(piece)
                left = out[-1] if out else ""
        return out

    def _one(self, piece: str) -> tuple[str, bytes]:
        i = self.id_of.get(piece)
        ids = [i] if i is not None else [self.byte_id[b] for b in piece.encode()]
        made = ("".join([f",{i}" for i in ids]), (piece if i is None else piece.replace(SPACE, " ")).encode())
        if len(self.one) > CACHE_UNITS:
            self.one.clear()
        self.one[piece] = made
        return made

    def _split(self, unit: str) -> tuple[str, bytes]:
        """The ids of a unit after commas, and the bytes they decode to."""
        one, make = self.one, self._one
        got = [one.get(p) or make(p) for p in self.split(unit)]
        return "".join([g[0] for g in got]), b"".join([g[1] for g in got])

    def _unit(self, unit: str) -> tuple[str, bytes]:
        """The same, from the table of units or into it."""
        made = self.units.get(unit) or self.units_before.get(unit) or self._split(unit)
        if len(unit) <= 64:
            if len(self.units) > CACHE_UNITS // (8 if self.small else 2):
                self.units, self.units_before = {}, self.units
            self.units[unit] = made
        return made

    def _run(self, run: str, whole: bool = True) -> tuple[str, bytes]:
        """The same of any text, unit by unit; a run that is one unit enters the table only if ``whole``."""
        inner, lo, got = self.inner, 0, []
        for i in range(1, len(run)):
            if run[i - 1 : i + 1] not in inner:
                got.append(self._unit(run[lo:i]))
                lo = i
        if not (lo or whole):
            return self._split(run)
        got.append(self._unit(run[lo:]))
        return got[0] if len(got) == 1 else ("".join([g[0] for g in got]), b"".join([g[1] for g in got]))

    def _word(self, word: str) -> tuple[str, bytes]:
        """The same of a word after one space."""
        made = self.words_before.get(word) or self._run(SPACE + word, False)  # words have a table of their own
        if len(word) <= 64:
            if len(self.words) > CACHE_UNITS // 2:
                self.words, self.words_before = {}, self.words
            self.words[word] = made
        return made

    def _raw(self, ids: list[int]) -> bytes:
        """Bytes of the pieces in a row, byte pieces as such."""
        return b"".join(bytes([self.byte_of[i]]) if i in self.byte_of else self.piece_of[i].replace(SPACE, " ").encode() for i in ids)

    def _parts(self, text: str) -> list[tuple[str, bytes]]:
        if not text:
            return []
        words = text.split(" ")
        if self.cut_at_space and "" not in words and SPACE not in text:
            make = self._word
            return [self.words.get(w) or make(w) for w in words]
        return [self._run(SPACE + text.replace(" ", SPACE))]

    def encode(self, text: str) -> list[int]:
        return [int(i) for part in self._parts(text) for i in part[0][1:].split(",")]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control ids give nothing, and bytes that are no UTF-8 each become U+FFFD."""
        return _text(self._raw([i for i in ids if i in self.byte_of or i in self.piece_of]))

    def both(self, text: str) -> tuple[str, str]:
        """The ids, each after a comma, and the text that they decode to."""
        parts = self._parts(text)
        return "".join([p[0] for p in parts]), _text(b"".join([p[1] for p in parts]))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, sha256 of the ids joined by commas, sha256 of the decoded text."""
        ids, decoded = self.both(text)
        return ids.count(","), hashlib.sha256(ids[1:].encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def _text(raw: bytes) -> str:
    """The decoded text without the space that encoding put in front."""
    raw = raw[1:] if raw[:1] == b" " else raw
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode(errors="replace")


def model_bytes(df: DataFrame, path: str):
    """The model file (a vocabulary of fixed size), read once and broadcast."""
    with open(path, "rb") as f:
        proto = f.read()
    if len(proto) > 64 << 20:
        raise ValueError("a vocabulary file of more than 64 MB isn't broadcast")
    return df.sparkSession.sparkContext.broadcast(proto)


def _worker(proto, small: bool = False) -> PieceModel:
    gc.set_threshold(200_000, 20, 100)  # the tables hold a million objects, none in cycles
    raw = proto.value
    give_back()
    return worker_cache(f"pieces {small} " + hashlib.sha256(raw).hexdigest(), lambda: PieceModel(raw, small))


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every whole text."""
    proto = model_bytes(docs, model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _worker(proto)
        for b in batches:
            ids = [m.encode(t or "") for t in b.column(1).to_pylist()]
            off = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.fromiter((i for x in ids for i in x), np.int32, int(off[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(off, flat)], names=[key, "ids"])

    df = docs.select(key, F.col(text).cast("string").alias("text"))
    return df.mapInArrow(work, f"`{key}` {df.schema[0].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """``key`` and ``text`` of every row of ids (null: empty)."""
    proto = model_bytes(encoded, model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _worker(proto)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=[key, "text"])

    df = encoded.select(key, F.col("ids").cast("array<int>").alias("ids"))
    return df.mapInArrow(work, f"`{key}` {df.schema[0].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every whole text in one pass: ``key``, ``n_tokens``,
    ``ids_sha256`` (decimal ids joined by commas) and ``decoded_sha256``."""
    proto = model_bytes(docs, model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _worker(proto)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                got = [m.digest(t or "") for t in part.column(1).to_pylist()]
                n, ids, dec = zip(*got)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(dec, pa.string())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    df = docs.select(key, F.col(text).cast("string").alias("text"))
    return df.mapInArrow(work, f"`{key}` {df.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def with_pieces(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded`` (the text that the ids
    give) of every whole text; columns of these names are replaced."""
    proto = model_bytes(docs, model_path)
    docs = docs.drop("ids", "n_tokens", "decoded").withColumn(text, F.col(text).cast("string"))
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _worker(proto, small=True)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids, decoded = zip(*[m.both(t or "") for t in part.column(at).to_pylist()])
                off = np.concatenate([[0], np.cumsum([x.count(",") for x in ids])]).astype(np.int32)
                flat = np.fromstring("".join(ids)[1:], np.int32, sep=",") if off[-1] else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(off, flat), pa.array(np.diff(off).astype(np.int64)), pa.array(decoded, pa.string())], names=[*part.schema.names, "ids", "n_tokens", "decoded"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["ids array<int>", "n_tokens long", "decoded string"])
    return docs.mapInArrow(work, schema)
