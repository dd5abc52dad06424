"""Operator 2: benchmark decontamination by Wu-Manber search over words.

A window is a run of ``width`` words of an item (an item of fewer words, but
not none, is one window).  The windows of each length make one searcher:

* blocks of two words; a shift table, indexed by a block's hash, says how far
  the search can move on before a window could end (entries that share a slot
  keep the smaller shift);
* where the shift is 0, the block selects a bucket of windows that end in it,
  ordered by the hash of their other words;
* a window whose hash is equal is compared with the document word by word.

Documents are cut into lanes of a few hundred window ends; all lanes of a
batch move on together, so every step is one operation over arrays.

Windows are broadcast in blocks of items of at most ``BLOCK_BYTES`` of text
(by its measured size).  A larger benchmark is searched block by block: what
one pass found is written to the shared folder with the documents and the next
pass adds to it.

Defined cases: null text has no words; a null item id is named "" ; repeated
items count once; repeated documents give repeated rows; other columns of
either table are ignored, so their names cannot clash; an empty benchmark hits
nothing.
"""

from __future__ import annotations

import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix, text_pieces, string_bytes, word_hashes, worker_cache

#: Bytes of benchmark text whose windows are broadcast at once.
BLOCK_BYTES = 8 << 20
#: Window ends that a lane covers.
LANE = 256


def _fold(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position."""
    h = np.full(len(at), n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[at + i])
    return h


class Searcher:
    """Windows of one length."""

    def __init__(self, length: int, words: list[np.ndarray], texts: list[bytes], owners: list[list[int]]):
        self.length, self.block = length, min(2, length)
        rows = np.stack(words)
        flat, at = rows.ravel(), np.arange(len(rows)) * length
        self.bits = max(10, min(22, int(np.ceil(np.log2(8 * len(rows) * length)))))
        far = length - self.block + 1
        self.shift = np.full(1 << self.bits, far, np.int64)
        for end in range(self.block - 1, length):
            slots = self._slot(flat, at + end)
            np.minimum.at(self.shift, slots, length - 1 - end)
        tail = self._suffix(flat, at + length - 1)
        head = _fold(flat, at, length - self.block)
        order = np.lexsort((head, tail))
        self.tail, first = np.unique(tail[order], return_index=True)
        self.first = np.append(first, len(order))
        # suffix and prefix hash in one key, so that a crowded bucket is searched and not walked
        self.key = mix(tail[order] ^ mix(head[order]))
        by_key = np.argsort(self.key, kind="stable")
        self.key, self.rows = self.key[by_key], rows[order][by_key]
        self.texts = [texts[i] for i in order[by_key]]
        self.owners = [owners[i] for i in order[by_key]]

    def _suffix(self, words: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _fold(words, end - self.block + 1, self.block)

    def _slot(self, words: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._suffix(words, end) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, words: np.ndarray, word_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence; whole rows, never across two."""
        n = np.diff(word_off)
        ends = np.maximum(n - self.length + 1, 0)
        lanes = -(-ends // LANE)
        row = np.repeat(np.arange(len(n)), lanes)
        lane = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = word_off[row] + self.length - 1 + lane * LANE
        stop = np.minimum(at + LANE, word_off[row + 1])
        found_at, found = [], []
        while len(at):
            suffix = self._suffix(words, at)
            shift = self.shift[(suffix >> np.uint64(64 - self.bits)).astype(np.int64)]
            here = np.flatnonzero(shift == 0)
            if len(here):
                in_bucket = np.searchsorted(self.tail, suffix[here])
                here = here[self.tail[np.minimum(in_bucket, len(self.tail) - 1)] == suffix[here]]
            if len(here):
                end = at[here]
                key = mix(suffix[here] ^ mix(_fold(words, end - self.length + 1, self.length - self.block)))
                lo, hi = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
                for depth in range(int((hi - lo).max(initial=0))):  # equal keys: one window, but for collisions
                    some = np.flatnonzero(lo + depth < hi)
                    window, first = lo[some] + depth, end[some] - self.length + 1
                    same = (words[first[:, None] + np.arange(self.length)] == self.rows[window]).all(axis=1)
                    found_at.append(first[same])
                    found.append(window[same])
            at = at + np.maximum(shift, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)


class Benchmark:
    """Searchers for all window lengths of some items."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.names = [name for name, _ in items]
        data, off = string_bytes(pa.array([text for _, text in items], pa.string()))
        words, start, end, word_off = word_hashes(data, off)
        lower = np.array([chr(c).lower().encode()[0] if c < 128 else c for c in range(256)], np.uint8)
        raw = lower[data].tobytes()
        by: dict[int, dict[bytes, tuple[np.ndarray, list[int]]]] = {}
        for item in range(len(items)):
            a, z = int(word_off[item]), int(word_off[item + 1])
            length = min(width, z - a)
            if not length:
                continue
            strings = [raw[s:e] for s, e in zip(start[a:z], end[a:z])]
            for i in range(z - a - length + 1):
                window = by.setdefault(length, {}).setdefault(b" ".join(strings[i : i + length]), (words[a + i : a + i + length], []))
                if not window[1] or window[1][-1] != item:
                    window[1].append(item)
        self.searchers = [Searcher(n, [w for w, _ in ws.values()], list(ws), [o for _, o in ws.values()]) for n, ws in sorted(by.items())]


def _search_rows(bench: Benchmark, texts: pa.Array) -> Iterator[tuple[int, int, list[tuple[int, int]], set[str]]]:
    """(row, words, hit runs of words, items) of every row."""
    lower = worker_cache("lower", lambda: bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    for lo, hi, data, off in text_pieces(texts):
        words, start, end, word_off = word_hashes(data, off)
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for s in bench.searchers:
            first, window = s.search(words, word_off)
            row = np.searchsorted(word_off, first, "right") - 1
            for f, w, r in sorted(zip(first.tolist(), window.tolist(), row.tolist())):
                said = b" ".join([data[a:b].tobytes() for a, b in zip(start[f : f + s.length], end[f : f + s.length])]).translate(lower)
                if said == s.texts[w]:
                    spans.setdefault(r, []).append((f - int(word_off[r]), f - int(word_off[r]) + s.length))
                    items.setdefault(r, set()).update(bench.names[o] for o in s.owners[w])
        n = np.diff(word_off)
        for r in range(hi - lo):
            yield lo + r, int(n[r]), _merged(spans.get(r, [])), items.get(r, set())


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def find_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with the column ``hit`` (one of that name is replaced): struct of ``n_words``, ``spans``
    (array of (first word, word after the last), merged) and ``items`` (sorted names)."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("name"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("said")).distinct()
    size = items.agg(F.sum(F.octet_length("said") + 64)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    held = docs.withColumns({text: F.col(text).cast("string"), "__hit": F.lit(None).cast("struct<n_words:bigint,spans:array<struct<first:bigint,stop:bigint>>,items:array<string>>")})
    for block in range(blocks):
        mine = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("name", "said"), F.lit(blocks)) == block)
        held = _one_block(held, [tuple(r) for r in mine.collect()], width, text)
        if block < blocks - 1:
            held = materialise(held, "decontaminate")
    return held.drop("hit").withColumnRenamed("__hit", "hit")


def _one_block(held: DataFrame, items: list[tuple[str, str]], width: int, text: str) -> DataFrame:
    sent = held.sparkSession.sparkContext.broadcast(sorted(items))
    token = uuid.uuid4().hex
    at, out = held.columns.index(text), held.columns.index("__hit")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_benchmark = worker_cache("benchmark", dict)
        if token not in held_benchmark:  # a worker keeps the last one only
            held_benchmark.clear()
            held_benchmark[token] = Benchmark(sent.value, width)
        bench = held_benchmark[token]
        for b in batches:
            made = []
            earlier = b.column(out).to_pylist() if b.column(out).null_count < b.num_rows else [None] * b.num_rows
            for row, n, spans, names in _search_rows(bench, b.column(at)):
                if earlier[row]:
                    spans = _merged(spans + [(s["first"], s["stop"]) for s in earlier[row]["spans"]])
                    names = names | set(earlier[row]["items"])
                made.append({"n_words": n, "spans": [{"first": a, "stop": z} for a, z in spans], "items": sorted(names)})
            columns = b.columns
            columns[out] = pa.array(made, b.schema.field(out).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return held.mapInArrow(work, held.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The digest of :func:`find_benchmark`: words, words hit, items and their sha256 per document."""
    found = find_benchmark(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), benchmark)
    n_hit = F.aggregate("hit.spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["first"])
    return found.select(
        "doc_id", F.col("hit.n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("hit.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit.items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
