"""Operator 1: n-gram Jaccard join by chosen paths.

Texts become sets of hashes of five-word shingles; rows with equal sets are one
class from the start (copies are never paired).  Then, in each of ``RUNS``
runs, classes are split by a shared token that is sampled anew at every level
(the token that is least under that level's hash, so two sets of similarity s
choose the same one with probability s).  A bucket of ``SMALL`` classes or
fewer is a leaf, others are split again, ``LEVELS`` levels at most.  Runs
repeat until a pair at the threshold that always sinks to the last level is
missed by all of them with a probability of less than 1 - ``RECALL``:
10 runs of 3 levels.

Leaves are compared by sketches (a byte of each sampled token) into stars, and
the stars' connected components are clusters that a link can't leave.  Last, all
pairs inside a cluster are verified by the exact sizes of intersections.  A
bucket or cluster that is too large for one task is cut into parts, and every
pair of parts is a task of its own, so no pair is left out.  Tasks give one row
a class (its links and the smallest class it is joined with), never pairs.

Defined cases: a text of one to four words is one shingle; null texts and
texts without words have no links and are classes of their own; repeated rows
are copies; ids may repeat or be null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_worker, materialise, shingle_hashes, text_pieces, word_hashes, worker_cache
from .components import components

SHINGLE, LEVELS, RECALL = 5, 3, 0.999
#: Threshold as a fraction, so that verification needs no rounding.
NUMERATOR, DENOMINATOR = 4, 5
RUNS = math.ceil(math.log(1 - RECALL) / math.log(1 - (NUMERATOR / DENOMINATOR) ** LEVELS))
TOKENS = RUNS * LEVELS
#: Classes of a bucket that is compared at once; parts that large buckets and clusters are cut into.
SMALL, SKETCH_PART, TEXT_PART = 256, 1024, 256
#: Equal sketch bytes of two sets that may be a pair: of 30 at a similarity of 0.8, fewer have a probability of about 1e-5.
ALIKE = 14 * TOKENS // 30


def _sampling() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    return r.integers(0, 1 << 63, TOKENS, dtype=np.uint64), r.integers(0, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of every row."""
    for lo, hi, data, off in text_pieces(texts):
        words, _, _, word_off = word_hashes(data, off)
        shingles, s_off = shingle_hashes(words, word_off, SHINGLE)
        for r in range(hi - lo):
            yield lo + r, np.unique(shingles[s_off[r] : s_off[r + 1]])


def _set_key(s: np.ndarray) -> tuple[int, int]:
    h = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def signatures(docs: DataFrame) -> DataFrame:
    """Of every row (``doc_id``, ``text``): ``ih`` and ``th`` (hashes of id and text), key of its set, size, sampled tokens."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        seed, odd = worker_cache("jaccard sampling", _sampling)
        for b in batches:
            for start in range(0, b.num_rows, 1024):
                part = b.slice(start, 1024)
                k1, k2, size, tokens = [], [], [], np.zeros((part.num_rows, TOKENS), np.uint64)
                with np.errstate(over="ignore"):
                    for r, s in _sets(part.column(3)):
                        a, z = _set_key(s)
                        k1.append(a)
                        k2.append(z)
                        size.append(len(s))
                        for lo in range(0, len(s), 4096):
                            low = ((s[lo : lo + 4096] ^ seed[:, None]) * odd[:, None]).min(axis=1)
                            tokens[r] = np.minimum(tokens[r], low) if lo else low
                lists = pa.ListArray.from_arrays(np.arange(0, part.num_rows * TOKENS + 1, TOKENS, dtype=np.int32), pa.array(tokens.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(size, pa.int32()), lists], names=["doc_id", "ih", "th", "k1", "k2", "size", "tokens"])

    rows = docs.select("doc_id", F.xxhash64("doc_id").alias("ih"), F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(work, f"doc_id {kind}, ih long, th long, k1 long, k2 long, size int, tokens array<long>")


def _leaves(classes: DataFrame) -> DataFrame:
    """``bucket``, ``class``, ``n`` (classes in the bucket) of all runs."""

    def paths(r):
        first = r * LEVELS
        step = [F.xxhash64(r, *[F.get("tokens", first + i) for i in range(n)]).alias(f"p{n}") for n in range(1, LEVELS + 1)]
        return F.struct(*step)

    here = classes.select("class", F.explode(F.transform(F.sequence(F.lit(0), F.lit(RUNS - 1)), paths)).alias("p")).select("class", "p.*")
    out = None
    for level in range(1, LEVELS + 1):
        counts = here.groupBy(f"p{level}").agg(F.count("*").alias("n")).filter("n > 1")
        here = materialise(here.join(counts, f"p{level}"), "chosen-paths")
        leaf = here if level == LEVELS else here.filter(F.col("n") <= SMALL)
        leaf = leaf.select(F.col(f"p{level}").alias("bucket"), "class", "n")
        out = leaf if out is None else out.unionByName(leaf)
        here = here.filter(F.col("n") > SMALL).drop("n", f"p{level}")
    return out


def _tasks(rows: DataFrame, group: str, part: int) -> DataFrame:
    """Rows with ``task`` and ``side``: a group of ``n`` rows is one task, or one for each pair of its parts."""
    parts = F.ceil(F.col("n") / part).cast("int")
    own = F.pmod(F.xxhash64("class", F.lit(17)), parts).cast("int")
    rows = rows.withColumns({"parts": parts, "own": own}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumns({"task": F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other")), "side": (F.col("own") > F.col("other")).cast("int")}).drop("own", "other")


def _by_task(compare: Callable[[pa.Table], list]) -> Callable:
    """A function of batches that are sorted by ``task`` (the first column): calls
    ``compare`` with each task's rows and gives what it returns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for b in batches:
            task = b.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1), len(task)]
            made = []
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and task[lo] != current:
                    made += compare(pa.Table.from_batches(held))
                    held = []
                current = task[lo]
                held.append(b.slice(lo, hi - lo))
            yield _star_rows(made)
        if held:
            yield _star_rows(compare(pa.Table.from_batches(held)))

    return work


def _star_rows(made: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.int64()) for i in range(3)], names=["class", "root", "links"])


def _roots(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the smallest id of its component."""
    root = ids.copy()
    most = np.iinfo(np.int64).max
    while True:
        least = np.minimum(root, np.where(near, root[None, :], most).min(axis=1, initial=most))
        if (least == root).all():
            return root
        root = least


def _compare_sketches(rows: pa.Table) -> list[tuple[int, int, int]]:
    ids = rows.column("class").to_numpy()
    side = rows.column("side").to_numpy()
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(ids), TOKENS)
    near = np.zeros((len(ids), len(ids)), bool)
    for lo in range(0, len(ids), 128):
        alike = np.zeros((min(128, len(ids) - lo), len(ids)), np.uint8)
        for t in range(TOKENS):
            alike += sketch[lo : lo + 128, t, None] == sketch[None, :, t]
        near[lo : lo + 128] = alike >= ALIKE
    np.fill_diagonal(near, False)
    if side.any():
        near &= side[:, None] != side[None, :]
    return [(int(i), int(r), 0) for i, r in zip(ids, _roots(near, ids)) if i != r]


def _compare_texts(rows: pa.Table) -> list[tuple[int, int, int]]:
    """Links of each class (in rows of the input) and the smallest class it is joined with."""
    ids, copies = rows.column("class").to_numpy(), rows.column("copies").to_numpy()
    side, k1, k2 = (rows.column(c).to_numpy() for c in ("side", "k1", "k2"))
    sets: dict[int, np.ndarray] = {}
    place: dict[int, int] = {}
    for r, s in _sets(rows.column("text").combine_chunks()):
        # of rows that share the id, the one whose set it is
        if int(ids[r]) not in sets and _set_key(s) == (k1[r], k2[r]):
            sets[int(ids[r])], place[int(ids[r])] = s, r
    if not place:
        return []
    keep = np.array([place[i] for i in sorted(place)])
    ids, copies, side = ids[keep], copies[keep], side[keep]
    size = np.array([len(sets[i]) for i in ids.tolist()])
    token = np.concatenate([sets[i] for i in ids.tolist()])
    row = np.repeat(np.arange(len(ids)), size)
    _, column, count = np.unique(token, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    some = shared[column]
    row, column = row[some], number[column[some]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(ids), len(ids)), np.float64)
    total = int(shared.sum())
    for lo in range(0, total, 4096):
        a, z = np.searchsorted(column, [lo, lo + 4096])
        held = np.zeros((len(ids), min(4096, total - lo)), np.float32)
        held[row[a:z], column[a:z] - lo] = 1
        both += held @ held.T
    either = size[:, None] + size[None, :] - both
    near = both * DENOMINATOR >= either * NUMERATOR
    np.fill_diagonal(near, False)
    if side.any():
        near &= side[:, None] != side[None, :]
    links, roots = near @ copies, _roots(near, ids)
    return [(int(i), int(r), int(n)) for i, r, n in zip(ids, roots, links) if n]


def jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``ih``, ``th``, ``size`` (shingles), ``class_id`` (smallest id of
    its class), ``class_key`` (the same for all rows of a class) and ``n_links``
    (other rows at or above the threshold)."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = materialise(signatures(docs), "jaccard-rows")
    classes = rows.filter("size > 0").groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.min(F.struct("ih", "th")).alias("row"), F.first("tokens").alias("tokens"))
    classes = classes.select("k1", "k2", "copies", "first_id", "row.ih", "row.th", "tokens", F.monotonically_increasing_id().alias("class"))
    classes = materialise(classes, "jaccard-classes")

    sketch = F.unhex(F.array_join(F.transform("tokens", lambda t: F.substring(F.hex(F.shiftright(t, 8).bitwiseAND(0xFF) + 0x100), 2, 2)), ""))
    leaves = _leaves(classes).join(classes.select("class", sketch.alias("sketch")), "class")
    tasks = _tasks(leaves, "bucket", SKETCH_PART).select("task", "side", "class", "sketch")
    stars = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_by_task(_compare_sketches), "class long, root long, links long")
    clusters = components(stars.select(F.col("class").alias("u"), F.col("root").alias("v")))

    members = clusters.select(F.col("node").alias("class"), F.col("root").alias("cluster")).unionByName(clusters.select(F.col("root").alias("class"), F.col("root").alias("cluster")).distinct())
    sizes = clusters.groupBy(F.col("root").alias("cluster")).agg((F.count("*") + 1).alias("n"))
    members = members.join(sizes, "cluster").join(classes.select("class", "copies", "ih", "th", "k1", "k2"), "class")
    # one row stands for a class; rows that repeat id and text fold before the shuffle
    texts = docs.select(F.xxhash64("doc_id").alias("ih"), F.xxhash64("text").alias("th"), "text").dropDuplicates(["ih", "th"]).join(members, ["ih", "th"])
    tasks = _tasks(texts, "cluster", TEXT_PART).select("task", "side", "class", "copies", "k1", "k2", "text")
    linked = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_by_task(_compare_texts), "class long, root long, links long")
    linked = materialise(linked, "jaccard-links")

    # most clusters are one task, whose roots are final; the rest is joined up here
    roots = components(linked.select(F.col("class").alias("u"), F.col("root").alias("v")))
    links = linked.groupBy("class").agg(F.sum("links").alias("links"))
    known = classes.join(links, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
    known = known.select("k1", "k2", "first_id", F.coalesce("root", "class").alias("class_key"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = known.groupBy("class_key").agg(F.min("first_id").alias("class_id"))
    known = known.drop("first_id").join(named, "class_key")
    out = rows.filter("size > 0").join(known, ["k1", "k2"]).select("doc_id", "ih", "th", "size", "class_id", "class_key", "n_links")
    # without shingles: each a class of its own, by a key that no class has
    alone = rows.filter("size = 0").select("doc_id", "ih", "th", "size", F.col("doc_id").alias("class_id"), (-1 - F.monotonically_increasing_id()).alias("class_key"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def jaccard_report(docs: DataFrame) -> DataFrame:
    return jaccard_classes(docs).select("doc_id", F.col("size").cast("long").alias("n_shingles"), "class_id", "n_links")
