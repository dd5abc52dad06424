"""Operator 10: quality classifier by perplexity under a Kneser-Ney model.

The model is an interpolated modified Kneser-Ney model of order 3 over words,
marks, numbers and line ends in their own case, one for each language and fold,
counted over all trusted texts (labelled good and not toxic).

Folds: a text's hash puts it in one of two folds.  The trusted texts of a fold
train its model; every text, trusted or not, is scored by the model of the other
fold.  So no text is scored by a model that saw it, and the quantiles of trusted
texts are those of held-out texts.

Counts and requests meet by key: a task folds the trigrams of its trusted texts, and
for each block of texts the distinct n-grams that it asks for; a shuffle by parts of
the key (the first two words for trigrams, the last two for pairs) brings both to
one place, which adds up, looks up and answers with counts alone, in the order
of the block's distinct keys, so that no model is written and no key comes back
(a block numbers its n-grams in that order and reads the answers by number).
Discounts come from the counts of counts of each model and order.  An n-gram's key is
made of 64-bit hashes of its words, turned and combined; beside the key of two words
the third one of a trigram stands by the upper 48 bits of its hash.

The key space is gone through in a few turns, and each one's shuffles leave the disks
when its answers are written: each turn reads the texts again and moves its share
(later ones less, as answers stay).  A pair of words is asked for as the context of
what follows it, and by itself only where the text ends.
Lower orders count distinct left neighbours; words get their figures last, from those
of their pairs.

Scoring: the texts of a block are brought together, in a few deals, make their distinct
keys again and read the answers beside them, word by word.  No task or driver
ever holds the model.

Decision, by two perplexities of a text: its own, and its own over the one that
it has under the model's lowest order, which knows words and no order.  The
second is high where neighbours never meet in trusted text, as in one word said
again and again.  A language's limits are ``QUANTILE`` of what its trusted texts
reach by both, plus ``SLACK``.  What is compared is the mean log loss less twice
its standard error (which is large for short texts), so that a text goes only if
chance does not explain it.

Defined cases: null and empty texts have no perplexity and stay; a null
language is a language of its own; texts of a language without trusted text
have no threshold and stay; where only one fold of a language has trusted text,
the other's texts are scored by that fold, and that fold's by no model, under
which each word is as unlikely as an unseen one; a document with labels that
disagree isn't trusted; repeated rows give repeated results; other columns are
ignored.
"""

from __future__ import annotations

import struct
from functools import reduce
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exact_values, free_worker, materialise, mix, partitions_for, run_hashes, text_pieces, worker_cache

ORDER = 3
#: Of trusted texts of a language within each limit (so that both together cost 0.5 %), and
#: the slack above it (in nats: a factor of 1.16 of perplexity).
QUANTILE, SLACK = 0.9975, 0.15
#: Chance of a word that no trusted text holds, beneath all orders.
UNSEEN = 1e-6
#: Trusted ids (16 bytes each) up to which they are broadcast; beyond, the join shuffles.
TRUSTED_BROADCAST = 2_000_000
#: Bytes of stored input up to which keys have one turn, the most turns, and the most deals of texts.
TURN_BYTES, TURNS, DEALS = 16 << 20, 5, 2
#: Of two turns, the share of parts that the later one takes of the earlier one's: answers stay on the disks
#: beside the next turn's shuffles (0.6 and 4.6 times the stored input, all turns together).
LATER = 0.88
#: Bytes of stored input that make a part of the keys, and a block of texts.
PART_BYTES, BLOCK_BYTES = 8 << 20, 16 << 20
#: Bytes of text whose n-grams are worked on at once.
PIECE_BYTES = 1 << 18
#: Bytes that a Python worker may hold from one group of rows to the next: to give memory back and take it again costs time.
SPARE = 320 << 20
#: Rows that wait until they are folded.
FOLD_ROWS = 1 << 19
#: Hashes of what stands before and after a text.
BEGIN, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEFB1D4E2B)
TURN = 21
#: What is kept of the hash of a word beside a key that tells the two others (planes of zeros take no room).
UPPER = np.uint64(0xFFFFFFFFFFFF0000)


def _classes() -> np.ndarray:
    """Of each byte: 1 letters (and all beyond ASCII), 2 digits, 3 line ends, 4 marks, 0 other white space."""
    kind = np.full(256, 4, np.uint8)
    kind[[9, 11, 12, 13, 32]] = 0
    kind[10] = 3
    kind[48:58] = 2
    kind[65:91] = kind[97:123] = kind[128:] = 1
    return kind


def _run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of bytes, eight bytes at a time (of runs beyond 64 bytes all at once)."""
    length = end - start
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", wide.data, strides=(1,))
    first = lambda n: np.uint64((1 << 64) - 1) >> (64 - 8 * np.minimum(n, 8)).view(np.uint64)  # noqa: E731  a mask of n bytes, of eight at most
    with np.errstate(over="ignore"):
        out = mix((eight[start] & first(length)) + length.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        some = np.flatnonzero((length > 8) & (length <= 64))
        begin, left = start[some], length[some]
        while len(some):
            begin, left = begin + 8, left - 8
            out[some] = mix(out[some] + (eight[begin] & first(left)) * np.uint64(0xD6E8FEB86659FD93))
            more = np.flatnonzero(left > 8)
            some, begin, left = some[more], begin[more], left[more]
        some = np.flatnonzero(length > 64)
        if len(some):
            out[some] = mix(run_hashes(data, start[some], end[some], exact_values()))
    return out


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of one class of bytes, and where those of each row start."""
    kind = np.frombuffer(data.tobytes().translate(worker_cache("byte classes", lambda: _classes().tobytes())), np.uint8)
    edge = np.ones(len(data) + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[off] = True
    at = np.flatnonzero(edge)
    solid = np.flatnonzero(kind[at[:-1]])
    start, end = at[solid], at[solid + 1]
    return _run_hashes(data, start, end), np.searchsorted(start, off)


def _padded(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between marks of each row's begin and end, where words and ends stand in them, and where rows start."""
    words, word_off = _words(data, off)
    rows = len(off) - 1
    padded = np.full(len(words) + ORDER * rows, BEGIN, np.uint64)
    token = np.ones(len(padded), bool)
    begins = word_off[:-1] + ORDER * np.arange(rows)
    for i in range(ORDER - 1):
        token[begins + i] = False
    ends = word_off[1:] + ORDER * np.arange(rows) + ORDER - 1
    at = np.flatnonzero(token)
    token[ends] = False
    padded[token] = words
    padded[ends] = END
    return padded, at, word_off[:-1] + np.arange(rows)


def _trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The three words that end in each word of each row and in its end, and where rows start."""
    padded, at, start = _padded(data, off)
    return padded[at - 2], padded[at - 1], padded[at], start


def _then(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a context followed by a word."""
    return ((context << np.uint64(TURN)) | (context >> np.uint64(64 - TURN))) ^ word


#: The context of a text's first word, which is no pair that ends in a word.
NOWHERE = _then(BEGIN, BEGIN)


def _groups(col: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    values = col.to_numpy(zero_copy_only=False)
    for one in np.unique(values):
        yield int(one), pa.array(np.flatnonzero(values == one))


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key; parts follow the order of keys."""
    return ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


# ------------------------------------------------------------------ packed rows
def _starts(*cols: np.ndarray) -> np.ndarray:
    """Which of the sorted rows differ from the one before."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return new


def _argsort(key: np.ndarray) -> np.ndarray:
    """The order of keys (equal ones as they stand): one plain sort of the upper bits of each key
    beside its place; then those whose upper bits don't tell are ordered among themselves."""
    bits = np.uint64(len(key).bit_length())
    packed = np.sort(key >> bits << bits | np.arange(len(key), dtype=np.uint64))
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    got = key[order]
    wrong = np.flatnonzero(got[1:] < got[:-1])
    if len(wrong):
        run = np.cumsum(_starts(packed >> bits))
        mixed = np.zeros(run[-1] + 1, bool)
        mixed[run[wrong]] = True
        some = np.flatnonzero(mixed[run])
        order[some] = order[some][np.argsort(got[some], kind="stable")]
    return order


def _order(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by ``keys``, and which of the ordered rows differ from the one before.
    Only rows that agree so far are ordered by the next key, by their run and its upper bits at once."""
    order = _argsort(keys[0])
    new = _starts(keys[0][order])
    for key in keys[1:]:
        alone = new.copy()
        alone[:-1] &= new[1:]
        at = np.flatnonzero(~alone)
        run, value = np.cumsum(new[at], dtype=np.uint64), key[order[at]]
        if not len(at):
            break
        bits = np.uint64(int(run[-1]).bit_length())
        by = _argsort(run << np.uint64(64) - bits | value >> bits)
        if np.any((run[by][1:] == run[by][:-1]) & (value[by][1:] < value[by][:-1])):
            by = np.lexsort((value, run))
        order[at] = order[at][by]
        new[at[1:]] |= value[by][1:] != value[by][:-1]
    return order, new


def _ranks(order: np.ndarray, new: np.ndarray, counted: np.ndarray | None = None) -> np.ndarray:
    """Of each row, which of the distinct ones it is (of those with a row that is ``counted``)."""
    kind = np.int32 if len(order) < 1 << 31 else np.int64
    number = np.cumsum(new, dtype=kind) - kind(1)
    if counted is not None and len(order):
        number = (np.cumsum(np.logical_or.reduceat(counted[order], np.flatnonzero(new)), dtype=kind) - kind(1))[number]
    out = np.empty(len(order), kind)
    out[order] = number
    return out


def _numbers(values: np.ndarray) -> np.ndarray:
    """Of each of some values that are often the same, which of the distinct ones it is, in their order."""
    found = pa.array(values).dictionary_encode()
    distinct = found.dictionary.to_numpy()
    rank = np.empty(len(distinct), np.int32)
    rank[np.argsort(distinct)] = np.arange(len(distinct))
    return rank[found.indices.to_numpy()]


def _fold(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of ``keys`` in their order, with the sums of ``sums`` over equal ones."""
    if len(keys) == 1 and not sums:
        only = np.sort(keys[0])
        return [only[_starts(only)]], []
    order, new = _order(keys)
    at = np.flatnonzero(new)
    first = order[at]
    return [k[first] for k in keys], [np.add.reduceat(s[order], at) if len(at) else s for s in sums]


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


def _spread(n: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Of the counts of each run: their sum, and how many are 1, 2, and 3 or more."""
    return [_sums(n, at), _sums(n == 1, at), _sums(n == 2, at), _sums(n > 2, at)]


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers from 0 as planes of bytes, compressed."""
    x = np.ascontiguousarray(x).astype("<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<QB", len(x), width) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(b: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", b)
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(pa.decompress(b[9:], n * width, codec="zstd"), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def _pack_rows(keys: list[np.ndarray]) -> list[bytes]:
    """Sorted distinct rows: of each column its values where they change, and how many follow on each of the column before."""
    out, before = [], np.flatnonzero(_starts(keys[0]))
    out.append(_pack(np.diff(keys[0][before], prepend=np.uint64(0))))
    for i in range(1, len(keys)):
        new = _starts(*keys[: i + 1])
        out += [_pack(_sums(new, before)), _pack(keys[i][new])]
        before = np.flatnonzero(new)
    return out


def _unpack_rows(packed: list[bytes]) -> list[np.ndarray]:
    keys = [np.cumsum(_unpack(packed[0]), dtype=np.uint64)]
    for n, values in zip(packed[1::2], packed[2::2]):
        keys = [*[np.repeat(k, _unpack(n).astype(np.int64)) for k in keys], _unpack(values)]
    return keys


def _find(held: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where ``wanted`` stands in ``held`` (sorted), -1 where it doesn't."""
    if not len(held):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
    return np.where(held[at] == wanted, at, -1)


def _pairs_finder(held: list[np.ndarray]) -> Callable[[list[np.ndarray]], np.ndarray]:
    """The same for rows of two columns: looked up by the number of the first and the upper bits of the second."""
    new = _starts(held[0])
    first = held[0][new]
    join = lambda of, second: of.astype(np.uint64) << np.uint64(40) | second >> np.uint64(24)
    codes = join(np.cumsum(new) - 1, held[1])
    if len(first) >= 1 << 24 or np.any(codes[1:] == codes[:-1]):  # upper bits don't tell: all words are numbered
        numbers = np.unique(held[1])
        codes = _find(first, held[0]) * len(numbers) + _find(numbers, held[1])
    else:
        numbers = None

    def find(wanted: list[np.ndarray]) -> np.ndarray:
        out, of = np.full(len(wanted[0]), -1), _find(first, wanted[0])
        some = np.flatnonzero(of >= 0)
        if numbers is None:
            at = _find(codes, join(of[some], wanted[1][some]))
            right = np.flatnonzero(at >= 0)
            right = right[held[1][at[right]] == wanted[1][some[right]]]
            out[some[right]] = at[right]
            return out
        word = _find(numbers, wanted[1][some])
        some, word = some[word >= 0], word[word >= 0]
        out[some] = _find(codes, of[some] * len(numbers) + word)
        return out

    return find


def _at(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    return np.where(found < 0, 0, values[found]) if len(values) else np.zeros(len(found), np.int64)


# ------------------------------------------------------------------ counting and looking up
#: What a row brings to a part: trigrams by context, what is asked of those; distinct trigrams
#: by their last two words, what is asked of those; figures of words, what is asked of those.
TRIGRAMS, ASK_TRIGRAMS, PAIRS, ASK_PAIRS, WORDS, ASK_WORDS, STATS = range(7)
MOVED = "kind int, model long, block long, part int, x array<binary>, s array<long>"
MOVED_ARROW = pa.schema([("kind", pa.int32()), ("model", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("x", pa.list_(pa.binary())), ("s", pa.list_(pa.int64()))])


def _slices(key: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    part = _part(key, parts)
    at = np.flatnonzero(_starts(part))
    for lo, hi in zip(at, np.append(at[1:], len(part))):
        yield int(part[lo]), slice(lo, hi)


def _cut(turns: int, parts: int) -> list[int]:
    """The first part of each turn, and the end of the last: each has one at least, later ones have fewer."""
    upto = np.cumsum(LATER ** np.arange(turns))
    return [0, *(int(x) for x in np.arange(1, turns + 1) + np.round((parts - turns) * upto / upto[-1]))]


def _send(texts: DataFrame, first: int, end: int, parts: int, wordparts: int) -> DataFrame:
    """What all texts bring to one turn, the parts from ``first`` to before ``end`` of ``parts``: trusted
    ones their n-grams, and each block the distinct n-grams that it asks for; in a turn
    without parts, its words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker(SPARE)
        held: dict[tuple[int, int, int], list[tuple[list[np.ndarray], list[np.ndarray]]]] = {}

        def joined(runs: list) -> tuple[list[np.ndarray], list[np.ndarray]]:
            return _fold(*[[np.concatenate(c) for c in zip(*[r[i] for r in runs])] for i in (0, 1)])

        def keep(kind: int, model: int, block: int, keys: list[np.ndarray], counted: bool = False) -> None:
            if len(keys[0]):
                runs = held.setdefault((kind, model, block), [])
                runs.append((keys, [np.ones(len(keys[0]), np.int64)] if counted else []))
                if sum(len(r[0][0]) for r in runs[1:]) > max(FOLD_ROWS, len(runs[0][0][0])):
                    runs[:] = [joined(runs)]

        # the least key of this turn, and how far it goes
        least, most = (-(-(part << 32) // parts) << 32 for part in (first, end))
        least, most = np.uint64(least % (1 << 64)), np.uint64(max(0, most - least - 1))
        for b in batches:
            for ask, rows in _groups(b.column("ask")):
                for block, some in _groups(b.column("block").take(rows)):
                    mine = rows.take(some)
                    trusted = b.column("trusted").take(mine).to_numpy(zero_copy_only=False)
                    train = b.column("train")[mine[0].as_py()].as_py()
                    for lo, hi, data, off in text_pieces(b.column("text").take(mine), PIECE_BYTES):
                        padded, at, start = _padded(data, off)
                        if first == end:
                            keep(ASK_WORDS, ask, block, [padded])
                            continue
                        stands = np.diff(np.append(start, len(at)))  # words and end of each row
                        word = np.zeros(len(padded) + 1, bool)
                        word[at] = True
                        told = np.append(np.repeat(trusted[lo:hi], stands + ORDER - 1), False) & word
                        pairs = _then(padded[:-1], padded[1:])
                        here = np.flatnonzero(pairs - least <= most)
                        context = here[word[here + 2]]
                        keys, told_of = [pairs[context], padded[context + 2] & UPPER], told[context + 2]
                        keep(ASK_TRIGRAMS, ask, block, keys)
                        keep(TRIGRAMS, train, 0, [k[told_of] for k in keys], True)
                        pair = here[told[here + 1]]
                        keep(PAIRS, train, 0, [padded[pair], padded[pair + 1], padded[pair - 1] & UPPER])
                        # a pair of words is a context that is asked for already, unless the text ends there
                        last = pairs[at[np.cumsum(stands) - 1] - 1]
                        keep(ASK_PAIRS, ask, block, [last[last - least <= most]])
            yield from ()
        for (kind, model, block), runs in held.items():
            keys, n = joined(runs)
            spread = keys[0]
            if kind == PAIRS:
                part = _part(_then(keys[0], keys[1]), parts)
                order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
                keys = [k[order] for k in keys]
                spread = _then(keys[0], keys[1])
            out = []
            for part, of in _slices(spread, wordparts if kind == ASK_WORDS else parts):
                x = _pack_rows([k[of] for k in keys]) + [_pack(c[of]) for c in n]
                out.append({"kind": kind, "model": model, "block": block, "part": part, "x": x, "s": None})
            yield pa.RecordBatch.from_pylist(out, schema=MOVED_ARROW)

    return texts.select("ask", "train", "block", "trusted", "text").mapInArrow(work, MOVED)


def _answer(wordparts: int) -> Callable[[pa.Table], pa.Table]:
    """Of one part and model: the counts, what was asked of them (in the order of the
    block's distinct keys), counts of counts and, of pairs, their words' figures."""

    def work(t: pa.Table) -> pa.Table:
        free_worker(SPARE)
        model, part = t.column("model")[0].as_py(), t.column("part")[0].as_py()
        kinds, blocks = t.column("kind").to_numpy(), t.column("block").to_numpy()
        out: list[dict] = []

        def rows(kind: int, counted: int = 0) -> list[np.ndarray]:
            got = []
            for i in np.flatnonzero(kinds == kind):
                x = t.column("x")[int(i)].as_py()
                n = len(x) - counted
                got.append([*_unpack_rows(x[:n]), *[_unpack(c).astype(np.int64) for c in x[n:]]])
            return [np.concatenate(c) for c in zip(*got)]

        def tell(kind: int, block: int, told: list[np.ndarray], to: int = part) -> None:
            out.append({"kind": kind, "model": model, "block": block, "part": to, "x": [_pack(c) for c in told], "s": None})

        def stats(order: int, n: np.ndarray) -> None:
            out.append({"kind": STATS, "model": model, "block": 0, "part": part, "x": [], "s": [order, *[int((n == i).sum()) for i in (1, 2, 3, 4)], int((n > 2).sum()), int(n.sum())]})

        def asked(kind: int) -> Iterator[tuple[int, list[np.ndarray]]]:
            of = np.flatnonzero(kinds == kind)
            for block in np.unique(blocks[of]):
                got = [_unpack_rows(t.column("x")[int(i)].as_py()) for i in of[blocks[of] == block]]
                yield int(block), _fold([np.concatenate(c) for c in zip(*got)], [])[0] if len(got) > 1 else got[0]

        none = np.zeros(0, np.uint64)
        (context, word), (n,) = _fold(got[:2], got[2:]) if (got := rows(TRIGRAMS, 1)) else ([none, none], [none.astype(np.int64)])
        at = np.flatnonzero(_starts(context))
        spread, contexts = _spread(n, at), context[at]
        find = _pairs_finder([context, word])
        if len(n):
            stats(3, n)
        wanted: dict[int, np.ndarray] = {}
        for block, keys in asked(ASK_TRIGRAMS):
            wanted[block] = asks = keys[0][_starts(keys[0])]
            of = _find(contexts, asks)
            tell(ASK_TRIGRAMS, block, [_at(n, find(keys)), *[_at(s, of) for s in spread]])

        first, second, _ = _fold(got, [])[0] if (got := rows(PAIRS)) else [none] * 3
        at = np.flatnonzero(_starts(first, second))
        first, second, n = first[at], second[at], np.diff(np.append(at, len(first)))
        if len(n):
            stats(2, n)
            at = np.flatnonzero(_starts(first))
            words, uses = np.unique(second, return_counts=True)
            ((every,), _) = _fold([np.concatenate([first[at], words])], [])
            told = [_at(s, _find(first[at], every)) for s in _spread(n, at)] + [_at(uses, _find(words, every))]
            for to, of in _slices(every, wordparts):
                tell(WORDS, 0, [np.diff(every[of], prepend=np.uint64(0)), *[c[of] for c in told]], to)
        last = _then(first, second)
        order = _argsort(last)
        last, n = last[order], n[order]
        for block, (keys,) in asked(ASK_PAIRS):
            ((wanted[block],), _) = _fold([np.concatenate([wanted.get(block, none), keys])], [])
        for block, keys in wanted.items():
            tell(ASK_PAIRS, block, [_at(n, _find(last, keys[keys != NOWHERE]))])

        (words,), told = _fold(got[:1], got[1:]) if (got := rows(WORDS, 5)) else ([none], [none.astype(np.int64)] * 5)
        if len(words):
            stats(1, told[4][told[4] > 0])
        for block, (keys,) in asked(ASK_WORDS):
            of = _find(words, keys)
            tell(ASK_WORDS, block, [_at(c, of) for c in told])
        return pa.Table.from_pylist(out, schema=MOVED_ARROW)

    return work


def _kept(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialise`, after which the shuffles of this step leave the disks."""
    conf, name_of = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name_of, "false")
    conf.set(name_of, "true")
    try:
        return materialise(df, name)
    finally:
        conf.set(name_of, before)


def _cuts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """The discounts of counts 1, 2 and 3 or more, from counts of counts (whole where these
    are missing, as in tiny corpora); 0.1 at least, so that every text has a chance."""
    n, y = [n1, n2, n3, n4], n1 / (n1 + 2 * n2) if n1 + 2 * n2 else None
    return [max(0.1, min(float(i), i - (i + 1) * y * n[i] / n[i - 1])) if y is not None and n[i - 1] else float(i) for i in (1, 2, 3)]


def _score_block(docs: pa.Table, found: pa.Table) -> pa.Table:
    free_worker(SPARE)
    pieces, said, stand, tokens, length = [], [], [], 0, 0
    for lo, hi, data, off in text_pieces(docs.column("text").combine_chunks(), PIECE_BYTES):
        padded, at, start = _padded(data, off)
        pieces.append((lo, hi, np.diff(off) > 0, start, slice(tokens, tokens + len(at))))
        said.append(padded)
        stand.append(at + length)
        tokens, length = tokens + len(at), length + len(padded)
    said.append(np.full(1, BEGIN))
    padded, at = np.concatenate(said), np.concatenate(stand)
    del said, stand
    # of each word its number among the block's distinct ones, and so of trigrams, and of pairs as pairs and as contexts
    word = _numbers(padded)
    of1, of2 = word[at], word[at - 1]
    del word
    # rows are the pairs of words, beside the word that follows: none does (real is false) where the text ends
    place = np.zeros(len(padded), np.int32 if len(padded) < 1 << 31 else np.int64)
    place[at - 2] = place[at - 1] = 1
    rows = np.flatnonzero(place)
    place[rows] = np.arange(len(rows))
    first, second = place[at - 2], place[at - 1]
    real = np.zeros(len(rows), bool)
    real[first] = True
    pairs = _then(padded[rows], padded[rows + 1])
    del place
    order, new = _order([pairs, padded[rows + 2] & UPPER])
    del padded, at, rows
    ordered = pairs[order]
    trigram, start_of = _ranks(order, new, real)[first], _starts(ordered)
    before, pair = _ranks(order, start_of, real)[first], _ranks(order, start_of, pairs != NOWHERE)[second]
    del order, new, ordered, start_of, pairs, real, first, second
    kinds = found.column("kind").to_numpy()
    by_part = np.argsort(found.column("part").to_numpy(), kind="stable")

    def told(kind: int) -> list[np.ndarray]:
        got = [[_unpack(c).astype(np.int64) for c in found.column("x")[int(i)].as_py()] for i in by_part if kinds[i] == kind]
        return [np.concatenate(c) for c in zip(*got)]

    stats = {s[0]: s[1:] for s in docs.column("stats")[0].as_py() or []}

    def level(order: int, n: np.ndarray, spread: list) -> list[np.ndarray]:
        """What is left of each count, and of each context its sum and the share of the lower order."""
        cuts = np.array([0, *_cuts(*stats.get(order, [0] * 6)[:4])])
        total = np.maximum(spread[0], 1)
        gamma = np.where(spread[0] > 0, (spread[1] * cuts[1] + spread[2] * cuts[2] + spread[3] * cuts[3]) / total, 1).astype(np.float32)
        return [(n - cuts[np.minimum(n, 3)]).astype(np.float32), total, gamma]

    m1, m2, _, _, more, total = stats.get(1, [0] * 6)
    *spread2, n1 = told(ASK_WORDS)
    left, total1, gamma = level(1, n1, [np.full(1, x) for x in (total, m1, m2, more)])
    p1 = left.astype(float) / total1 + gamma.astype(float) * UNSEEN
    log1 = np.log(p1)
    left2, total2, gamma2 = level(2, *told(ASK_PAIRS), spread2)
    n3, *spread3 = told(ASK_TRIGRAMS)
    left3, total3, gamma3 = level(3, n3, spread3)
    del n1, spread2, n3, spread3
    out = {c: np.full(docs.num_rows, np.nan) for c in ("loss", "least_loss", "excess", "least_excess")}
    for lo, hi, filled, start, mine in pieces:
        i = of1[mine]
        p, alone = p1[i], log1[i]
        i = of2[mine]
        p = left2[pair[mine]].astype(float) / total2[i] + gamma2[i].astype(float) * p
        i = before[mine]
        p = left3[trigram[mine]].astype(float) / total3[i] + gamma3[i].astype(float) * p
        count = np.diff(np.append(start, len(p)))
        p = np.log(p)
        for name, each in (("loss", -p), ("excess", alone - p)):
            mean = np.add.reduceat(each, start) / count
            error = np.sqrt(np.maximum(np.add.reduceat(each * each, start) / count - mean * mean, 0) / count)
            out[name][lo:hi][filled] = mean[filled]
            out[f"least_{name}"][lo:hi][filled] = (mean - 2 * error)[filled]
    scored = docs.select(["doc_id", "th", "lang", "trusted"])
    for name, of in out.items():
        scored = scored.append_column(name, pa.array(of, from_pandas=True))
    return scored


def _files(docs: DataFrame) -> DataFrame:
    """``docs`` with the hash of the file that holds a row, where Spark knows it: texts of a
    file share a block, so a task's requests fold.  Any other dealing is as right."""
    try:
        return docs.select("*", F.xxhash64("_metadata.file_path").alias("stored in"))
    except AnalysisException:
        return docs.withColumn("stored in", F.lit(0).cast("long"))


def _losses(held: DataFrame, kind: str, turns: int, parts: int) -> DataFrame:
    """The losses of all texts; ``parts`` are those of all turns."""
    texts = held.withColumn("trusted", F.col("trusted") & (F.col("text") != ""))
    cuts, wordparts = _cut(turns, parts), -(-parts // turns)
    answer = lambda moved: moved.groupBy("part", "model").applyInArrow(_answer(wordparts), MOVED)
    answers = [_kept(answer(_send(texts, lo, hi, parts, wordparts)), "lm-answers") for lo, hi in zip(cuts, cuts[1:])]
    figures = reduce(DataFrame.unionByName, [a.filter(F.col("kind") == WORDS) for a in answers])
    answers.append(_kept(answer(_send(texts, parts, parts, parts, wordparts).unionByName(figures)), "lm-answers"))
    found = reduce(DataFrame.unionByName, answers)
    one = F.col("s")
    stats = found.filter(F.col("kind") == STATS).groupBy("model", one[0].alias("len")).agg(*[F.sum(one[i]).alias(f"s{i}") for i in range(1, 7)])
    stats = stats.groupBy("model").agg(F.collect_list(F.array("len", *[f"s{i}" for i in range(1, 7)])).alias("stats"))
    dealt = held.select("doc_id", "th", "lang", "trusted", "text", "block", F.col("ask").alias("model")).join(F.broadcast(stats), "model", "left")  # a row a model
    losses = "loss double, least_loss double, excess double, least_excess double"
    found, scored, deals = found.filter(F.col("kind").isin(ASK_TRIGRAMS, ASK_PAIRS, ASK_WORDS)), [], min(turns, DEALS)
    for i in range(deals):
        mine = F.pmod("block", F.lit(deals)) == i
        pairs = dealt.filter(mine).groupBy("model", "block").cogroup(found.filter(mine).groupBy("model", "block"))
        scored.append(_kept(pairs.applyInArrow(_score_block, f"doc_id {kind}, th long, lang string, trusted boolean, {losses}"), "lm-scores"))
    return reduce(DataFrame.unionByName, scored)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: ``doc_id``, ``th`` (hash of its text, whose lowest bit is its
    fold), ``lang``, ``perplexity`` and ``threshold``, ``order_perplexity`` (over
    that without order) and ``order_threshold``, ``trusted`` and ``keep``; ``worst``
    and ``worst_order`` are what is compared with the thresholds."""
    kind = docs.schema[key].dataType.simpleString()
    said = F.col(text).cast("string")
    good = labels.groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"), F.count("quality").alias("n"), F.count("*").alias("all"))
    good = good.filter("q = 1 and t = 0 and n = all and doc_id is not null").select("doc_id", F.lit(True).alias("trusted"))
    if good.count() <= TRUSTED_BROADCAST:
        good = F.broadcast(good)
    turns = min(TURNS, partitions_for(docs, TURN_BYTES, 1))
    parts = max(4 * turns, partitions_for(docs, PART_BYTES, 1))
    blocks = partitions_for(docs, BLOCK_BYTES * max(1, len(docs.inputFiles())), 1)
    held = _files(docs).select(F.col(key).alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(said, F.lit("")).alias("text"), F.xxhash64(said).alias("th"), "stored in")
    held = held.join(good, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    fold, deal = F.col("th").bitwiseAND(1), F.pmod(F.xxhash64("doc_id", "th"), F.lit(blocks))
    held = held.withColumns({"train": F.xxhash64("lang", fold), "ask": F.xxhash64("lang", 1 - fold), "block": F.xxhash64("stored in", deal)})
    scored = _losses(held, kind, turns, parts)
    # losses in thousandths: a bounded number of values for the exact quantiles
    top = lambda of: (F.percentile(F.round(of, 3), QUANTILE) + SLACK)
    limits = scored.filter("trusted").groupBy("lang").agg(top("least_loss").alias("limit"), top("least_excess").alias("order_limit"))
    out = scored.join(F.broadcast(limits), "lang", "left")  # a row a language
    told = {"perplexity": "loss", "threshold": "limit", "worst": "least_loss", "order_perplexity": "excess", "order_threshold": "order_limit", "worst_order": "least_excess"}
    return out.select(
        "doc_id", "th", "lang", "trusted", *[F.exp(of).alias(name) for name, of in told.items()],
        F.coalesce((F.col("least_loss") <= F.col("limit")) & (F.col("least_excess") <= F.col("order_limit")), F.lit(True)).alias("keep"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    bad = score(docs, labels, key, text, lang).filter("not keep").select(F.col("doc_id").alias("rejected id"), F.col("th").alias("rejected text")).distinct()
    same = F.col(key).eqNullSafe(F.col("rejected id")) & F.xxhash64(F.col(text).cast("string")).eqNullSafe(F.col("rejected text"))
    return docs.join(bad, same, "left_anti")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result of :func:`score` with rounded figures."""
    figures = ("perplexity", "threshold", "order_perplexity", "order_threshold")
    return score(docs, labels).select("doc_id", "lang", *[F.round(c, 3).alias(c) for c in figures], "trusted", "keep")
