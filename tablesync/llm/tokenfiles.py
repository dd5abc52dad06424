"""Operator 7: token ids as flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned and sorted by id; each task encodes its
documents and writes three flat files, little-endian and without headers, so
they can be memory-mapped:

* ``part-N.tokens``: ids, 2 bytes each if all ids of the vocabulary fit, else 4
* ``part-N.docs``: per document its 64-bit id and then, for all, a byte that is 1 for a null id
* ``part-N.offsets``: per document the number of ids of all documents before
  it in the whole set, unsigned 64 bit, and at last where the part ends

A first job writes ids and local counts; partition bases are prefix sums of
the parts' totals (one row a part), and a second small job writes offsets.
Files are written under another name and moved into place, so a task that is
run again replaces its own output.

A tokenizer that leaves spaces out of its tokens gives a text the ids of the
parts between spaces and line feeds, so a worker keeps the ids of words it has
seen; :func:`drops_spaces` reads that from the tokenizer's own file, and other
tokenizers encode whole texts.

Defined cases: null is the empty text, which has the end id only; a null id
sorts first; equal ids are ordered by the text's hash; repeated rows are
documents of their own; other columns are ignored; an empty table makes no files.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions_for, text_pieces, worker_cache
from .pieces import model_bytes

#: Bytes of input that one part is made of, by the optimizer's estimate.
PART_BYTES = 32 << 20
#: Words kept by a Python worker (results don't depend on it).
CACHE_WORDS = 600_000
#: Bytes of text whose words are told apart at once.
WORD_PIECE = 4 << 20


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a Hadoop-style URI, and the path in it."""
    uri = re.sub(r"^file:/+", "/", uri)
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def publish(fs: pafs.FileSystem, aside: str, final: str) -> None:
    """Move a finished file into place, over what an earlier attempt left there."""
    try:
        fs.move(aside, final)
    except OSError:  # stores whose move doesn't replace
        fs.delete_file(final)
        fs.move(aside, final)


def put(folder: str, name: str, data: bytes) -> None:
    fs, base = open_fs(folder)
    fs.create_dir(base, recursive=True)
    aside = f"{base}/.{name}.{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(aside) as out:
        out.write(data)
    publish(fs, aside, f"{base}/{name}")


def flat(folder: str, name: str, kind: str) -> np.ndarray:
    """A flat file as an array: memory-mapped if it is on a mounted file system."""
    fs, base = open_fs(folder)
    path = f"{base}/{name}"
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _parts(step: dict | None, inner: str) -> list[dict]:
    return [] if step is None else [p for one in step[inner] for p in _parts(one, inner)] if step.get("type") == "Sequence" else [step]


def drops_spaces(raw: bytes) -> bool:
    """Whether a tokenizer's ids are those of the parts between spaces and line feeds:
    known steps of normalisation that look at no neighbour across a space, and a
    first step of splitting that leaves spaces out of every token."""
    model = json.loads(raw)
    for step in _parts(model.get("normalizer"), "normalizers"):
        spaces = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if step["type"] not in ("NFC", "Lowercase") and not spaces:
            return False
    if any(set(t["content"]) & set(" \n") or t["lstrip"] or t["rstrip"] or t["single_word"] for t in model.get("added_tokens") or ()):
        return False
    first = (_parts(model.get("pre_tokenizer"), "pretokenizers") or [{"type": None}])[0]
    if first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]:
        pattern = re.sub(r"\[\^\\s(?:\\p\{\w+\}|\w)*\]", "", first["pattern"].get("Regex", " "))
        # what is left of the pattern, negated classes without white space aside, has nothing that matches a space
        return not re.search(r" |\.|\[\^|\\[sWDPnNXRvh]|\\x", pattern)
    return first["type"] in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")


#: Fixed value: a usual pattern of tokens, in which runs of letters and of marks are apart.
LETTERS_AND_MARKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CODE = np.arange(256)
_UPPER = (_CODE >= 65) & (_CODE <= 90)
_LETTER = _UPPER | ((_CODE >= 97) & (_CODE <= 122))
_MARK = (_CODE > 32) & (_CODE < 127) & ~_LETTER & ~((_CODE >= 48) & (_CODE <= 57)) & (_CODE != 39)


def more_alike(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with fewer distinct words and the same ids under ``LETTERS_AND_MARKS``
    and a lower-casing tokenizer: A-Z before an ASCII character (which nothing
    composes with) in lower case, and a space between ASCII letters and marks but the apostrophe."""
    plain = np.append(data[1:] < 128, True)
    data = np.where(_UPPER[data] & plain, data + 32, data).astype(np.uint8)
    letter, mark = _LETTER[data], _MARK[data]
    cut = np.flatnonzero((letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1
    # between two texts a space stands after the first's end
    return np.insert(data, cut, 32), off + np.searchsorted(cut, off, "right")


class WordEncoder:
    """Ids of texts.  Where the tokenizer drops spaces, each distinct word of a
    piece is looked up once, and ids are gathered from the table of words seen."""

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(raw)
        self.kind = id_kind(self.tokenizer)
        self.by_word = drops_spaces(raw)
        model = json.loads(raw)
        first = (_parts(model.get("pre_tokenizer"), "pretokenizers") or [{}])[0]
        lowered = any(step["type"] == "Lowercase" for step in _parts(model.get("normalizer"), "normalizers"))
        self.alike = self.by_word and lowered and first.get("pattern") == {"Regex": LETTERS_AND_MARKS}
        self.added = [t["content"].lower().encode() for t in model.get("added_tokens") or ()]
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, self.kind), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _add(self, words: list[str]) -> None:
        """Encode words on end, as one text is far cheaper than its words, and tell their ids apart by where they begin."""
        lines = [words[lo : lo + 256] for lo in range(0, len(words), 256)]
        for lo in range(0, len(lines), 16):
            some = lines[lo : lo + 16]
            for line, e in zip(some, self.tokenizer.encode_batch([" ".join(w) for w in some], add_special_tokens=False)):
                long = np.fromiter(map(len, line), np.int64, len(line)) + 1
                begin = np.fromiter((o[0] for o in e.offsets), np.int64)
                owner = np.searchsorted(np.cumsum(long), begin, "right")
                flat, size = np.array(e.ids, self.kind), np.bincount(owner, minlength=len(line))
                row, n = len(self.rows), len(self.rows) + len(line)
                while n > len(self.start):
                    self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
                while self.used + len(flat) > len(self.ids):
                    self.ids = np.resize(self.ids, 2 * len(self.ids))
                self.start[row:n], self.size[row:n] = self.used + np.cumsum(size) - size, size
                self.ids[self.used : self.used + len(flat)] = flat
                self.used += len(flat)
                self.rows.update(zip(line, range(row, n)))

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of some texts on end, and how many each has, piece by piece."""
        if not self.by_word:
            for lo in range(0, len(texts), 256):
                some = [t or "" for t in texts.slice(lo, 256).to_pylist()]
                made = [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                yield np.concatenate(made), np.array([len(m) for m in made], np.int64)
            return
        for _, _, data, off in text_pieces(texts, WORD_PIECE):
            low = data.tobytes().lower() if self.alike else b""
            # an added token, or what looks like one, is not to be cut or changed
            if self.alike and not any(t in low for t in self.added):
                data, off = more_alike(data, off)
            data = np.where(data == 10, 32, data).astype(np.uint8)
            # offsets of 64 bits: a single text may be longer than 2 GB
            said = pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data))
            words = pc.split_pattern(said, " ")
            coded = words.flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            if len(self.rows) + len(distinct) > CACHE_WORDS:
                self._forget()
            self._add([w for w in distinct if w not in self.rows])
            row = np.fromiter(map(self.rows.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
            size = self.size[row]
            upto = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(self.start[row] - upto[:-1], size) + np.arange(upto[-1])
            yield self.ids[at], np.diff(upto[words.offsets.to_numpy()])


def id_kind(tokenizer) -> str:
    return "<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


@dataclass(frozen=True)
class TokenFiles:
    """A written set: its folder, the ids' type, and (part, documents, ids, ids before) of each part."""

    folder: str
    kind: str
    parts: list[tuple[int, int, int, int]]


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int, key: str = "doc_id", text: str = "text") -> TokenFiles:
    """Encode every whole text, append ``end_id``, and write the set below ``folder``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    raw = model_bytes(docs, tokenizer_path)
    kind = id_kind(Tokenizer.from_file(tokenizer_path))
    end = np.array(end_id, kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_cache("words " + hashlib.sha256(raw.value).hexdigest(), lambda: WordEncoder(raw.value))
        part = TaskContext.get().partitionId()
        ids, tokens, counts = [], None, []
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        aside = f"{base}/.part-{part:06d}.tokens.{TaskContext.get().taskAttemptId()}"
        for b in batches:
            tokens = tokens or fs.open_output_stream(aside)
            ids.append(b.column(0))
            for made, size in enc.encode(b.column(1)):
                tokens.write(np.insert(made, np.cumsum(size), end).tobytes())
                counts.append(size + 1)
        if tokens is None:
            return
        tokens.close()
        publish(fs, aside, f"{base}/part-{part:06d}.tokens")
        keys = pa.chunked_array(ids).combine_chunks()
        null = np.asarray(keys.is_null().to_numpy(zero_copy_only=False), np.uint8)
        put(folder, f"part-{part:06d}.docs", np.asarray(keys.fill_null(0).to_numpy(zero_copy_only=False), "<i8").tobytes() + null.tobytes())
        sizes = np.concatenate(counts)
        put(folder, f"part-{part:06d}.counts", sizes.astype("<u8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(sizes)], pa.int64()), pa.array([int(sizes.sum())], pa.int64())], names=["part", "docs", "ids"])

    df = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")).withColumn("h", F.xxhash64("t"))
    n = partitions_for(docs, PART_BYTES)
    sorted_docs = df.repartitionByRange(n, "k", "h").sortWithinPartitions("k", "h").select("k", "t")
    written = sorted(tuple(r) for r in sorted_docs.mapInArrow(work, "part int, docs long, ids long").collect())  # a row a part
    base, parts = 0, []
    for part, n_docs, n_ids in written:
        parts.append((part, n_docs, n_ids, base))
        base += n_ids

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts = flat(folder, f"part-{part:06d}.counts", "<u8")
                put(folder, f"part-{part:06d}.offsets", (np.concatenate([[0], np.cumsum(counts)]).astype("<u8") + np.uint64(start)).astype("<u8").tobytes())
            yield b

    _part_rows(spark, parts).select("part", "start").mapInArrow(offsets, "part int, start long").write.format("noop").mode("overwrite").save()
    return TokenFiles(folder, kind, parts)


def _part_rows(spark: SparkSession, parts: list[tuple[int, int, int, int]]) -> DataFrame:
    return spark.createDataFrame(parts, "part int, docs long, ids long, start long").repartition(max(1, len(parts)), "part")


def read_tokens(spark: SparkSession, files: TokenFiles, digest: bool = False) -> DataFrame:
    """Per document of a written set: ``doc_id``, ``start``, ``n_tokens`` and
    ``ids`` (array of long), or with ``digest`` their ``ids_crc32`` instead."""
    folder, kind = files.folder, files.kind

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tokens = flat(folder, f"part-{part:06d}.tokens", kind)
                off = flat(folder, f"part-{part:06d}.offsets", "<u8").astype(np.int64)
                raw = flat(folder, f"part-{part:06d}.docs", "u1")
                keys = pa.array(np.frombuffer(raw[: 8 * n].tobytes(), "<i8"), mask=np.frombuffer(raw[8 * n :].tobytes(), "u1").astype(bool))
                for lo in range(0, n, 4096):
                    hi = min(n, lo + 4096)
                    local = off[lo : hi + 1] - off[0]
                    if digest:
                        last = pa.array([zlib.crc32(tokens[a:z].astype("<u4").tobytes()) for a, z in zip(local, local[1:])], pa.int64())
                    else:
                        last = pa.ListArray.from_arrays((local - local[0]).astype(np.int32), tokens[local[0] : local[-1]].astype(np.int64))
                    yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.array(off[lo:hi]), pa.array(np.diff(local)), last], names=["doc_id", "start", "n_tokens", "last"])

    rows = _part_rows(spark, files.parts).select("part", "docs")
    out = rows.mapInArrow(work, "doc_id long, start long, n_tokens long, last " + ("long" if digest else "array<long>"))
    return out.withColumnRenamed("last", "ids_crc32" if digest else "ids")
