"""Helpers shared by the operators: loading, Arrow batches, words as numpy arrays."""

from __future__ import annotations

import ctypes
import hashlib
import mmap
import sys
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tablesync.session import work_dir
from tablesync.sources.tables import load

__all__ = ["load", "work_dir", "materialise", "worker_cache", "free_worker", "give_back", "text_pieces", "word_hashes", "run_hashes", "exact_values", "mix", "shingle_hashes", "partitions_for"]

#: Bytes of text that a kernel works on at once; a longer document is one piece of its own.
PIECE_BYTES = 1 << 21
#: Bytes whose prefix sums are held at once (one longer word makes a longer run).
RUN_BYTES = 1 << 20


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back: cuts
    lineage, and a lost executor only costs its own tasks."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame, part_bytes: int, least: int | None = None) -> int:
    """A number of partitions of about ``part_bytes`` each by the optimizer's
    estimate, at least ``least`` (by default the session's shuffle partitions), and
    these partitions where the optimizer can't tell (tables from memory).  Results never depend on it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least or usual, min(100_000, -(-size // part_bytes))) if size < 1 << 60 else usual


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """One object for each Python worker, kept from task to task."""
    held = sys.__dict__.setdefault("_tablesync_llm", {})
    if name not in held:
        held[name] = make()
    return held[name]


def free_worker(spare: int = 0) -> None:
    """Drop what earlier tasks of other operators keep in this Python worker:
    word tables of tokenizers are large, and workers live on.  A worker that holds no more
    than ``spare`` bytes keeps what it has freed for its next task."""
    held = sys.__dict__.setdefault("_tablesync_llm", {})
    names = [n for n in held if n.startswith(("pieces ", "unigram ", "words "))]
    for name in names:
        del held[name]
    if names or not spare or _resident() > spare:
        give_back()


def _resident() -> float:
    """Bytes of memory that this worker holds; without end where the system doesn't tell."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * mmap.PAGESIZE
    except OSError:
        return float("inf")


def give_back() -> None:
    """Memory that this Python worker has freed goes back to the system (where the C
    library can do that): workers of earlier steps live on beside the next one's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# ------------------------------------------------------------------ Arrow
def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_pieces(col: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of whole rows of about ``limit`` bytes."""
    data, off = string_bytes(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


# ------------------------------------------------------------------ words
def _tables() -> dict[str, np.ndarray]:
    code = np.arange(256)
    lower = code.astype(np.uint8)
    lower[65:91] += 32
    word = ((code >= 48) & (code <= 57)) | ((code >= 65) & (code <= 90)) | ((code >= 97) & (code <= 122)) | (code >= 128)
    seed = b"".join(hashlib.blake2b(bytes([int(c)]), digest_size=8).digest() for c in lower)
    exact = b"".join(hashlib.blake2b(bytes([int(c)]), digest_size=8).digest() for c in code)
    base = 0x9E3779B97F4A7C15
    powers = np.full(RUN_BYTES + 1, base, np.uint64)
    powers[0] = 1
    inverse = np.full(RUN_BYTES + 1, pow(base, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    with np.errstate(over="ignore"):
        return {
            "lower": lower, "word": word, "value": np.frombuffer(seed, np.uint64).copy(), "exact": np.frombuffer(exact, np.uint64).copy(),
            "powers": np.cumprod(powers), "inverse": np.cumprod(inverse),
        }


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the rows in ``data``: 64-bit hash, first byte, byte after the
    last, and where each row's words start.  A word is a run of digits, letters
    a-z (A-Z lower-cased) and characters beyond ASCII."""
    t = worker_cache("word tables", _tables)
    inside = t["word"][data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[edge[:n]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edge[1:]] = False
    end = np.flatnonzero(inside & ~after) + 1
    return mix(run_hashes(data, start, end, t["value"])), start, end, np.searchsorted(start, off)


def exact_values() -> np.ndarray:
    """A value of each byte that tells capitals from small letters."""
    return worker_cache("word tables", _tables)["exact"]


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A hash (before :func:`mix`) of each run of bytes, from a value of each byte."""
    t = worker_cache("word tables", _tables)
    out = np.empty(len(start), np.uint64)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(start):
            a = start[lo]
            hi = max(lo + 1, int(np.searchsorted(end, a + RUN_BYTES, "right")))
            run = data[a : end[hi - 1]]
            m = len(run)
            if m <= RUN_BYTES:
                powers, inverse = t["powers"][:m], t["inverse"]
            else:  # one word longer than a run
                powers, inverse = np.cumprod(np.concatenate([[1], np.full(m - 1, t["powers"][1], np.uint64)]).astype(np.uint64)), t["inverse"]
            sums = np.zeros(m + 1, np.uint64)
            np.cumsum(value[run] * powers, out=sums[1:])
            s, e = start[lo:hi] - a, end[lo:hi] - a
            out[lo:hi] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
            lo = hi
    return out


def shingle_hashes(words: np.ndarray, word_off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words of each row, and where each row's start.
    A row of fewer words, but not none, is one shingle."""
    n = np.diff(word_off)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    s_off = np.concatenate([[0], np.cumsum(count)])
    if not s_off[-1]:
        return np.zeros(0, np.uint64), s_off
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(s_off[-1]) - s_off[row] + word_off[row]
    length = np.minimum(n, k)[row]
    with np.errstate(over="ignore"):
        h = length.astype(np.uint64)
        for i in range(k):
            w = words[np.minimum(at + i, len(words) - 1)]
            if int(length.min()) > i:
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
            else:
                h = np.where(length > i, mix(h * np.uint64(0x9E3779B97F4A7C15) + w), h)
    return h, s_off
