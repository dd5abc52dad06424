"""The ten operators against plain-Python versions and the libraries they must equal."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import EDGE, EDGE_SCHEMA, SF001, cut_lines, cut_passages, documents, edge_docs, jaccard, mean_losses, same, windows_hit, words
from pyspark.sql import functions as F

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


# ------------------------------------------------------------------ 1
def test_jaccard_join(spark, docs):
    from tablesync.llm.jaccard import jaccard_report

    same(jaccard_report(docs), jaccard(documents()))
    same(jaccard_report(edge_docs(spark).filter("doc_id is not null or text is not null")), jaccard(EDGE))
    assert jaccard_report(empty(spark)).count() == 0


def test_jaccard_join_of_a_large_group_in_parts(spark, monkeypatch):
    import tablesync.llm.jaccard as J

    for name in ("SMALL", "SKETCH_PART", "TEXT_PART"):
        monkeypatch.setattr(J, name, 8)
    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[0][1]) for i in range(20)] + [rows[1]] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(J.jaccard_report(df), jaccard(rows))


def test_components(spark):
    from tablesync.llm.components import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


# ------------------------------------------------------------------ 2
ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (2, "short passage of an item"), (2, "short passage of an item"), (3, None), (4, " ., "), (None, "one"), (10, "long " * 9), (5, "long long LONG tail")]


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_decontamination(spark, docs, monkeypatch, block):
    import tablesync.llm.decontaminate as D

    monkeypatch.setattr(D, "BLOCK_BYTES", block)

    def told(rows, items):
        return [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in windows_hit(rows, items)]

    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    same(D.contamination(edge_docs(spark), items), told(EDGE, ITEMS))
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    if block > 1000:
        same(D.contamination(docs, bench), told(documents(), [tuple(r) for r in bench.select("item_id", "text").collect()]))
    assert D.contamination(empty(spark), items).count() == 0
    assert D.contamination(docs, items.limit(0)).filter("contaminated or n_items > 0").count() == 0


# ------------------------------------------------------------------ 3
def licenses(rows):
    from tablesync.llm.licenses import rules

    out = []
    for d, t in rows:
        ws = words(t)
        text, at, pos = " ".join(ws), {}, 0
        for i, w in enumerate(ws):
            at[pos] = i
            pos += len(w) + 1
        found, base = [], []
        for r in rules():
            for m in re.finditer(f"(?:(?<=^)|(?<= ))(?=({r.pattern})(?: |$))", text):
                i = at[m.start()]
                found.append((i, -(i + len(m[1].split(" ")) - 1), -r.priority, r.label, r.confidence))
                base += [(i, r.label)] * r.base
        reach, kept = -1, []
        for _, last, _, label, sure in sorted(found):
            if -last > reach:
                reach = -last
                kept.append((label, sure))
        labels = sorted({b for _, b in base})
        out.append((d, len(ws), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None), ",".join(labels), ",".join(sorted({k for k, _ in kept} | set(labels))), max((s for _, s in kept), default=0.0)))
    return out


LICENSED = [
    (1, "Licensed under the Apache License, Version 2.0 (the License)."), (2, "GNU General Public License version 3; GNU Lesser General Public License v2.1"),
    (3, "mit license mit license MIT LICENSE mit licenses"), (4, "SPDX-License-Identifier: GPL-3.0-or-later"), (5, "cc by cc-by-sa 4.0 CC BY 4.0 xcc by"),
    (6, "Ämit license ßcc by"), (7, "the licens. All rights reserved. Copyright (c) 2024"), (8, "gnu general public gnu general public license"), (9, "KMIT License " * 50),
]


def test_license_scan(spark, docs):
    from tablesync.llm.licenses import license_report, rules

    assert len(rules()) > 300 and sum(r.base for r in rules()) == 4
    same(license_report(docs), licenses(documents()))
    rows = EDGE + [(100 + i, t) for i, t in LICENSED]
    same(license_report(edge_docs(spark, rows)), licenses(rows))
    assert license_report(empty(spark)).count() == 0


FUSED = {"GPLv3": "gpl-3.0", "GPLv2+": "gpl-2.0", "gpl3": "gpl-3.0", "LGPLv2.1": "lgpl-2.1", "LGPLv2": "lgpl-2.0", "lgpl3": "lgpl-3.0", "AGPLv3": "agpl-3.0", "Apache2": "apache-2.0", "MPLv2.0": "mpl-2.0", "EPLv2": "epl-2.0"}
UNNAMED = [
    ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software', "mit"),
    ("furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "bsd"),
    ("in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE AUTHORS", "bsd-2-clause"),
    ("Neither the name of the firm nor the names of its contributors may be used to endorse or promote products derived from this software without", "bsd-3-clause"),
    ("3. All advertising materials mentioning features or use of this software must display the following acknowledgement:", "bsd-4-clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above", "isc"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED", "0bsd"),
    ("This software is provided 'as-is', without any express or implied warranty. In no event", "zlib"),
    ('Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT', "apache-2.0"),
    ("You may convey verbatim copies of the Program's source code as you receive it, in any medium", "gpl-3.0"),
    ("Covered Software is provided under this License on an 'as is' basis, without warranty of any kind, either expressed, implied, or statutory", "mpl-2.0"),
]


def least_matches(pattern):
    """Texts that a rule's pattern finds with all its optional parts left out, one for each alternative."""
    import itertools
    from re import _parser

    def made(parts):
        return ["".join(c) for c in itertools.product(*[one(op, arg) for op, arg in parts])]

    def one(op, arg):
        match str(op):
            case "LITERAL":
                return [chr(arg)]
            case "IN":
                return [chr(arg[0][1][0])] if str(arg[0][0]) == "RANGE" else [chr(c) for _, c in arg]
            case "MAX_REPEAT":
                return [t * arg[0] for t in made(arg[2])]
            case "SUBPATTERN":
                return made(arg[3])
            case "BRANCH":
                return [t for parts in arg[1] for t in made(parts)]
        raise AssertionError(op)

    return made(_parser.parse(pattern))


def test_licenses_by_their_texts_and_fused_names(spark):
    from tablesync.llm.licenses import BODIES, WINDOW, license_report, rules

    told = [(f"the code is {t} here", label) for t, label in FUSED.items()] + UNNAMED + [(t, label) for label, sentences in BODIES.items() for s in sentences for t in least_matches(s)]
    rows = [(i, t) for i, (t, _) in enumerate(told)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_report(df).collect()}
    for i, (t, label) in enumerate(told):
        assert label in got[i]["labels"].split(",") and got[i]["score"] >= 0.8, (t, label)
    same(license_report(df), licenses(rows))
    assert all(max(len(t.split()) for t in least_matches(r.pattern)) <= WINDOW for r in rules())


def test_the_gate_lets_every_rule_through(spark):
    from tablesync.llm.licenses import GATES, license_report, rules

    assert all(g.isalnum() for g in GATES)  # in one word, as marks and line ends may stand between words
    for r in rules():
        for t in least_matches(r.pattern):
            assert re.fullmatch(r.pattern, t) and any(g in t for g in GATES), (r, t)
    rows = [(i, f"{notice}mit no attribution") for i, notice in enumerate(["", "Released under ", "distributed under ", "available under "])]
    same(license_report(spark.createDataFrame(rows, "doc_id long, text string")), licenses(rows))


def test_license_scan_runs_no_python(docs):
    from tablesync.llm.licenses import license_report

    plan = license_report(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ------------------------------------------------------------------ 4
def piece_texts():
    r = random.Random(3)
    from tablesync.llm.pieces import PieceModel

    with open(PIECES, "rb") as f:
        raw = f.read()
    m = PieceModel(raw)
    known = list(m.id_of)
    texts = [t for _, t in EDGE] + [" " * n + s for n in range(1, 40) for s in ("", "a", "the x")] + [t for _, t in documents()]
    texts += ["".join(r.choice(known) for _ in range(r.randint(1, 8))).replace("▁", " ") for _ in range(1500)]
    texts += ["".join(r.choice("abethinors .,'()#*<>[]_01\n\té▁") for _ in range(r.randint(1, 40))) for _ in range(1500)]
    return raw, m, texts


def test_pieces_equal_the_library():
    import sentencepiece

    raw, m, texts = piece_texts()
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    for t in texts:
        ids = sp.encode(t or "")
        assert m.encode(t or "") == ids, t
        assert m.decode(ids) == sp.decode(ids), t
    r = random.Random(4)
    for _ in range(300):
        ids = [r.randrange(sp.vocab_size()) for _ in range(r.randint(0, 12))]
        assert m.decode(ids) == sp.decode(ids), ids


def test_piece_operators(spark):
    import sentencepiece

    from tablesync.llm.pieces import decode, encode, round_trip, with_pieces

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    told = []
    for d, t in EDGE:
        ids = sp.encode(t or "")
        told.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    same(round_trip(edge_docs(spark), PIECES), told)
    coded = encode(edge_docs(spark), PIECES)
    same(coded.select("doc_id", F.size("ids")), [(d, n) for d, n, _, _ in told])
    same(decode(coded, PIECES), [(d, sp.decode(sp.encode(t or ""))) for d, t in EDGE])
    whole = with_pieces(edge_docs(spark), PIECES)
    assert {"hit", "th", "__th", "ids", "n_tokens", "decoded"} <= set(whole.columns)
    same(whole.select("doc_id", "text", "decoded"), [(d, t, sp.decode(sp.encode(t or ""))) for d, t in EDGE])
    assert round_trip(empty(spark), PIECES).count() == 0


def test_piece_tables_stay_small(monkeypatch):
    from tablesync.llm import pieces

    raw, _, texts = piece_texts()
    m = pieces.PieceModel(raw, small=True)
    monkeypatch.setattr(pieces, "CACHE_UNITS", 800)
    r = random.Random(6)
    texts = texts[:300] + ["".join(r.choice("aeioulnrst#1(") for _ in range(r.randint(2, 12))) + " z" for _ in range(4000)]
    for t in texts:
        ids, decoded = m.both(t or "")
        coded = m.encode(t or "")
        assert ids == "".join(f",{i}" for i in coded) and decoded == m.decode(coded), t
    assert len(m.units) <= 101 and len(m.units_before) <= 101 and len(m.words) <= 401 and len(m.words_before) <= 401
    assert len(m.beside) <= 401 and len({id(p) for pair in m.beside for p in pair}) <= len({p for pair in m.beside for p in pair}) + 100


def test_pieces_of_a_column_equal_encode_and_decode(spark):
    from tablesync.llm.pieces import decode, encode, with_pieces

    coded = encode(edge_docs(spark), PIECES)
    whole = with_pieces(edge_docs(spark), PIECES)
    same(whole.select("doc_id", "ids", "n_tokens"), [(r["doc_id"], r["ids"], len(r["ids"])) for r in coded.collect()])
    same(whole.select("doc_id", "decoded"), [tuple(r) for r in decode(coded, PIECES).collect()])


# ------------------------------------------------------------------ 5
def test_line_dedup(spark, docs):
    from tablesync.llm.linededup import dedup_lines, line_report

    same(line_report(docs).select("doc_id", "text"), cut_lines(documents()))
    r = random.Random(1)
    shared = "\n".join(f"shared line {i}" for i in range(12))
    rows = EDGE + [(200 + i, "\n".join(f"own {r.random()}" for _ in range(i % 3)) + "\n" + shared + "\ntail " + str(i)) for i in range(30)]
    out = dedup_lines(edge_docs(spark, rows))
    same(out.select("doc_id", "text"), cut_lines(rows))
    assert out.columns[:4] == ["doc_id", "text", "lang", "source"] and "__th" in out.columns
    # most of the passage goes from all documents but one, whatever stands before it
    assert sum("shared line 6" in (t or "") for _, t in cut_lines(rows)) == 1
    assert dedup_lines(empty(spark)).count() == 0
    # as registered, with passages of any boundaries
    same(line_report(docs, passage_words=50).select("doc_id", "text"), cut_passages(documents()))
    for words in (5, 50):
        some = rows + [(400 + i, "\n".join([f"p {r.random()}"] * (i % 2) + [f"passage {n} " + "w " * 20 for n in range(2 + i % 4)] + [f"q {r.random()}"])) for i in range(20)]
        same(dedup_lines(edge_docs(spark, some), passage_words=words).select("doc_id", "text"), cut_passages(some, words))


def test_exact_copies_lose_their_last_line_too(spark):
    from tablesync.llm.linededup import chunks_of, dedup_lines

    texts = ["\n".join(f"line {n} of text {i}" for n in range(2 + i % 9)) for i in range(60)]
    assert all(len(c) > 1 for t in texts for c in chunks_of(t)) and chunks_of("one") == [["one"]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert got[i]["text"] == t
        assert got[100 + i]["text"] == "" and got[100 + i]["line_dedup"]["n_removed"] == got[100 + i]["line_dedup"]["n_lines"]


def test_passages_of_few_lines_between_other_neighbours(spark):
    from tablesync.llm.linededup import PASSAGE_WORDS, dedup_lines

    r = random.Random(3)

    def line(n):
        return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))

    rows, planted, doc = [], {}, 0
    for size in (2, 3, 4, 5):
        for _ in range(10):
            passage = [line(PASSAGE_WORDS // size + 1) for _ in range(size)]
            for at in range(4):
                own = [line(9) for _ in range(6)]
                rows.append((doc, "\n".join(own[:at] + passage + own[at:])))
                planted[doc] = (passage, own, at)
                doc += 1
    # as long, but short of the words; and one line, which no chunk is
    few, lone = [line(5) for _ in range(4)], line(80)
    for at in (1, 2, 3):
        own = [line(9) for _ in range(6)]
        rows.append((doc + at, "\n".join([*own[:at], *few, *own[at:at + 1], lone, *own[at + 1:]])))
    got = {r["doc_id"]: r["text"].split("\n") for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), passage_words=PASSAGE_WORDS).collect()}
    for d, (passage, own, at) in planted.items():
        assert got[d] == (own if d % 4 else own[:at] + passage + own[at:])
    assert all(lone in got[doc + at] for at in (1, 2, 3))
    # whatever goes from a document stays in one of a smaller id
    for d, t in rows:
        assert all(line in got[d] or any(line in got[e] for e in got if e < d) for line in t.split("\n"))


# ------------------------------------------------------------------ 6
def top(rows, k):
    vecs = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in [x for n, x in enumerate(vecs) if x not in vecs[:n]]:
        if q % 50 == 0:
            got = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vecs if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(got[:k])]
    return out


def test_top_products(spark, monkeypatch):
    import tablesync.llm.topk as K

    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    same(K.top_products(df, lambda i: i % 50 == 0, 5), top(rows, 5))
    r = np.random.default_rng(2)
    some = [(i, [float(np.float32(x)) for x in r.normal(size=3) * 10.0 ** r.integers(-3, 3)]) for i in range(220)]
    some += [(300, [0.0, 0.0, 0.0]), (301, None), (302, [1.0, None, 2.0]), (350, [float("nan"), 1.0, 1.0]), (351, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (400, [1.0]), (401, [2.0]), (450, []), (451, [])]
    some += [(1000 + i, some[50][1]) for i in range(12)] + [(-50, some[50][1]), (1000, some[50][1])]
    other = spark.createDataFrame([(i, v, "x") for i, v in some], "vec_id long, embedding array<float>, v string").repartition(3)
    monkeypatch.setattr(K, "BLOCK", 2)
    monkeypatch.setattr(K, "SEEDS", 4)
    same(K.top_products(other, lambda i: i % 50 == 0, 5), top(some, 5))
    assert K.top_products(other.limit(0), lambda i: i % 50 == 0, 5).count() == 0


# ------------------------------------------------------------------ 7
def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    from tablesync.llm.tokenfiles import flat, read_tokens, write_tokens

    t = Tokenizer.from_file(WORDS)
    rows = sorted(documents())
    told, start, data = [], 0, []
    for d, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        told.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        data += ids
    files = write_tokens(docs, WORDS, str(tmp_path / "a"), 2)
    same(read_tokens(spark, files, digest=True), told)
    assert np.concatenate([flat(files.folder, f"part-{p[0]:06d}.tokens", files.kind) for p in files.parts]).tolist() == data
    assert files.kind == "<u2" and all(flat(files.folder, f"part-{p[0]:06d}.offsets", "<u8")[0] == p[3] for p in files.parts)

    files = write_tokens(edge_docs(spark), WORDS, str(tmp_path / "b"), 2)
    got = sorted(read_tokens(spark, files).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] + sorted(d for d, _ in EDGE if d is not None)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(d), t.encode(x or "", add_special_tokens=False).ids + [2]) for d, x in EDGE)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    assert read_tokens(spark, write_tokens(empty(spark), WORDS, str(tmp_path / "c"), 2)).count() == 0


def test_ids_by_word_are_those_of_whole_texts(monkeypatch):
    import json

    import pyarrow as pa
    import tablesync.llm.tokenfiles as T
    from tokenizers import Tokenizer

    with open(WORDS, "rb") as f:
        raw = f.read()
    r = random.Random(7)
    odd = ["H\u0331 T\u0308. Y\u030a A\u0301B", "don't.It's 'S we'LL'd", "<|ENDOFTEXT|>a <|startoftext|>.", "I\u0307.İ\u212a", None, "", "\n \n", "x" * 70000 + "." + "y"]
    signs = [32, 32, 10, 9, 0xA0, 0x2028, 39, 46, 95, 124, 60, 62, 65, 72, 90, 97, 115, 116, 48, 0x130, 0x17F, 0x301, 0x308, 0x331, 0xE9, 0xDF, 0x1100, 0x1161, 0x1F600]
    odd += ["".join(chr(r.choice(signs)) for _ in range(r.randrange(40))) for _ in range(5000)]
    model = json.loads(raw)
    model["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] += "| "
    spaced = json.dumps(model).encode()
    assert T.drops_spaces(raw) and not T.drops_spaces(spaced)
    for words, piece, one in ((600_000, 4 << 20, raw), (50, 3000, raw), (600_000, 4 << 20, spaced)):
        monkeypatch.setattr(T, "CACHE_WORDS", words)
        monkeypatch.setattr(T, "WORD_PIECE", piece)
        texts = odd if one is raw else odd[:50]
        made = list(T.WordEncoder(one).encode(pa.array(texts)))
        ids, size = np.concatenate([i for i, _ in made]), np.concatenate([n for _, n in made])
        upto = np.concatenate([[0], np.cumsum(size)])
        whole = Tokenizer.from_buffer(one)
        for t, a, z in zip(texts, upto, upto[1:]):
            assert ids[a:z].tolist() == whole.encode(t or "", add_special_tokens=False).ids, t


# ------------------------------------------------------------------ 8
def test_token_counts(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from tablesync.llm.unigram import UnigramCounter, piece_vocabulary, token_counts

    raw, _, texts = piece_texts()
    pieces = piece_vocabulary(raw)
    for vocabulary in (pieces, [(p, -math.log(i + 1) / 3) for i, (p, _) in enumerate(pieces)]):
        lib = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
        lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        mine = UnigramCounter(vocabulary)
        for t in texts:
            assert mine.text_count(t or "") == len(lib.encode(t or "", add_special_tokens=False).ids), t
    whole = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    whole.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    same(token_counts(edge_docs(spark), PIECES), [(d, len(whole.encode(t or "", add_special_tokens=False).ids)) for d, t in EDGE])
    assert token_counts(empty(spark), PIECES).count() == 0


# ------------------------------------------------------------------ 9
def test_shards(spark):
    from tablesync.llm.shards import shard_documents

    r = random.Random(8)
    rows = [(i, "copy of one text") for i in range(1500)] + [(2000 + i, "t" * r.randint(0, 60) + str(i)) for i in range(3000)] + EDGE[:8]
    df = edge_docs(spark, rows)
    got = shard_documents(df, 10).collect()
    by = defaultdict(list)
    for g in got:
        by[g["shard"]].append(g)
        assert g["law"] == "bytes" and g["grown_shard"] is None
    same(spark.createDataFrame([(g["doc_id"], g["size"], g["text_crc32"]) for g in got], "a long, b long, c long"), [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows])
    assert all(sorted(g["slot"] for g in v) == list(range(len(v))) for v in by.values()) and set(by) == set(range(10))
    sizes = [sum(g["size"] for g in v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 0.04 * sum(sizes) / 10 + 200
    # equal texts are in one shard, or divided at its bounds only
    where = defaultdict(set)
    for g in got:
        where[g["text_crc32"]].add(g["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 9
    again = {(g["doc_id"], g["text_crc32"]): (g["shard"], g["slot"]) for g in shard_documents(df.repartition(5), 10).collect() if g["doc_id"] != 1}
    assert all(again[g["doc_id"], g["text_crc32"]] == (g["shard"], g["slot"]) for g in got if g["doc_id"] != 1)
    # one row a thousand times over half of the table
    many = [(5, "the same row")] * 2000 + [(10 + i, f"other {i} " * 3) for i in range(1000)]
    sizes = defaultdict(int)
    slots = defaultdict(list)
    for g in shard_documents(spark.createDataFrame(many, "doc_id long, text string").repartition(4), 8).collect():
        sizes[g["shard"]] += g["size"]
        slots[g["shard"]].append(g["slot"])
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 0.05 * sum(sizes.values()) / 8 + 100
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert shard_documents(empty(spark), 40).count() == 0
    assert len(shard_documents(df.limit(3), 40).collect()) == 3


def test_shards_run_no_python(docs):
    from tablesync.llm.shards import shard_documents

    assert not re.search("Python|Arrow|Pandas", shard_documents(docs, 40)._jdf.queryExecution().toString())


# ------------------------------------------------------------------ 10
def test_quality_model(spark):
    from tablesync.llm.quality import SLACK, score

    rows = documents()
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    lang = {r["doc_id"]: r["lang"] for r in df.select("doc_id", "lang").collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0}
    got = {r["doc_id"]: r for r in score(df, labels).collect()}
    assert len(got) == len(rows) and {r["th"] & 1 for r in got.values()} == {0, 1}
    # a text is scored by the model of the fold that it isn't in
    told = mean_losses([((lang[d], 1 - (got[d]["th"] & 1)), t) for d, t in rows], [((lang[d], got[d]["th"] & 1), t) for d, t in rows if d in good])
    for (d, _), (loss, least, excess, least_excess) in zip(rows, told):
        assert got[d]["perplexity"] == pytest.approx(math.exp(loss), rel=1e-4) and got[d]["order_perplexity"] == pytest.approx(math.exp(excess), rel=1e-4)
        assert got[d]["worst"] == pytest.approx(math.exp(least), rel=1e-3) and got[d]["worst_order"] == pytest.approx(math.exp(least_excess), rel=1e-3)
        assert got[d]["trusted"] == (d in good)
        if got[d]["threshold"] is not None:
            assert got[d]["keep"] == (got[d]["worst"] <= got[d]["threshold"] and got[d]["worst_order"] <= got[d]["order_threshold"])
    # limits: the quantile of what trusted texts of the language reach, and the slack
    for one in set(lang.values()):
        reached = sorted(least for (d, _), (_, least, _, _) in zip(rows, told) if d in good and lang[d] == one and least is not None)
        limit = {r["threshold"] for r in got.values() if r["lang"] == one}
        place = 0.9975 * (len(reached) - 1)
        low, high = reached[int(place)], reached[min(int(place) + 1, len(reached) - 1)]
        assert len(limit) == 1 and math.log(limit.pop()) == pytest.approx(low + (place - int(place)) * (high - low) + SLACK, abs=2e-3)


def test_quality_keeps_good_and_rejects_most_bad_texts(spark):
    """Held out: models and thresholds come from half of the labels."""
    from tablesync.llm.quality import score

    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    judged = score(df, labels.filter(half == 0)).join(labels.filter(half == 1), "doc_id")
    kept = {(r["quality"], r["keep"]): r["n"] for r in judged.groupBy("quality", "keep").agg(F.count("*").alias("n")).collect()}
    assert kept[1, True] / (kept[1, True] + kept.get((1, False), 0)) > 0.995
    assert kept[0, False] / (kept[0, True] + kept[0, False]) > 0.6


def test_quality_by_kind_of_bad_text(spark):
    """Held out, each half of the labels in turn; toxic texts are good ones here."""
    from tablesync.llm.quality import score

    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half, count = F.pmod(F.xxhash64("doc_id"), F.lit(2)), defaultdict(int)
    text = {r["doc_id"]: (r["text"] or "").split() for r in df.select("doc_id", "text").collect()}
    for one in (0, 1):
        for r in score(df, labels.filter(half == one)).join(labels.filter(half != one), "doc_id").select("doc_id", "quality", "keep").collect():
            w = text[r["doc_id"]]
            kind = "good" if r["quality"] else "repeated" if len(w) > 3 and len(set(w)) <= max(2, len(w) // 20) else "other"
            count[kind, r["keep"]] += 1
    rejected = {kind: count[kind, False] / (count[kind, False] + count[kind, True]) for kind in ("good", "repeated", "other")}
    assert rejected["good"] < 0.005 and rejected["repeated"] > 0.6 and rejected["other"] > 0.87, dict(count)


def test_quality_leaves_little_on_disk_in_any_number_of_turns(spark, monkeypatch):
    """Models and requests are not kept: what stays is less than the input, and turns change nothing."""
    import os

    from tablesync.llm import quality
    from tablesync.session import checkpoint_root

    def kept() -> int:
        top = checkpoint_root(spark).removeprefix("file:")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names if "/lm-" in d)

    sf = "/root/testdata/sf0.01"
    df, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    before = kept()
    one = sorted(map(tuple, quality.quality_report(df, labels).collect()))
    assert kept() - before < 1.5 * os.path.getsize(f"{sf}/documents.parquet")
    monkeypatch.setattr(quality, "TURN_BYTES", 500_000)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 300_000)
    assert sorted(map(tuple, quality.quality_report(df, labels).collect())) == one


def random_keys(n, distinct, columns, low=False):
    r = np.random.default_rng(n + distinct + columns)
    some = [r.integers(0, 1 << 64, distinct, dtype=np.uint64) for _ in range(columns)]
    return [c[r.integers(0, distinct, n)] & np.uint64(0xFFFF if low else (1 << 64) - 1) for c in some]


def test_quality_folds_equal_plain_ones():
    from tablesync.llm.quality import _fold, _pairs_finder

    for n, distinct in ((0, 1), (1, 1), (2, 1), (900, 6), (3000, 700), (3000, 90_000)):
        for columns in (1, 2, 3):
            for low in (False, True):  # keys that differ in their lowest bits only are told apart as well
                keys = random_keys(n, distinct, columns, low)
                n_of = Counter(zip(*[k.tolist() for k in keys]))
                got, (sums,) = _fold(keys, [np.ones(n, np.int64)])
                assert list(zip(*[k.tolist() for k in got])) == sorted(n_of) and sums.tolist() == [n_of[k] for k in sorted(n_of)]
                assert all((a == b).all() for a, b in zip(got, _fold(keys, [])[0]))
                if columns == 2 and n:
                    wanted = [np.concatenate([a, b]) for a, b in zip(keys, random_keys(50, 50, 2, low))]
                    place = {k: i for i, k in enumerate(sorted(n_of))}
                    assert _pairs_finder(got)(wanted).tolist() == [place.get(k, -1) for k in zip(*[k.tolist() for k in wanted])]


def test_quality_fold_takes_less_than_a_plain_sort():
    import time

    from tablesync.llm.quality import _fold

    def seconds(f):
        began = time.process_time()
        f()
        return time.process_time() - began

    keys = random_keys(600_000, 400_000, 2)
    assert min(seconds(lambda: _fold(keys, [])) for _ in range(3)) < min(seconds(lambda: np.lexsort(keys[::-1])) for _ in range(3))


def test_quality_looks_up_no_word_in_a_block(monkeypatch):
    """A block reads its answers by number: nothing is searched for."""
    import pyarrow as pa

    from tablesync.llm import quality
    from tablesync.llm.common import string_bytes

    texts = ["a b c a b c", "", "a b\nd", "c c c"]
    docs = pa.table({"doc_id": [1, 2, 3, 4], "th": [1, 2, 3, 4], "lang": ["en"] * 4, "trusted": [True] * 4, "text": texts, "stats": pa.array([[[i, 4, 3, 2, 1, 1, 12] for i in (1, 2, 3)]] * 4, pa.list_(pa.list_(pa.int64())))})
    w1, w2, w3, _ = quality._trigrams(*string_bytes(docs.column("text")))
    n3, n2, n1 = len(quality._fold([quality._then(w1, w2), w3], [])[0][0]), len(np.unique(quality._then(w2, w3))), len(np.unique(np.concatenate([w2, w3])))
    contexts = len(np.unique(quality._then(w1, w2)))
    told = {quality.ASK_TRIGRAMS: [np.arange(n3) % 4, *[np.full(contexts, x) for x in (9, 2, 2, 1)]], quality.ASK_PAIRS: [np.arange(n2) % 3], quality.ASK_WORDS: [*[np.full(n1, x) for x in (9, 2, 2, 1)], np.arange(n1) % 3]}
    found = pa.Table.from_pylist([{"kind": k, "model": 0, "block": 0, "part": 0, "x": [quality._pack(c) for c in x], "s": None} for k, x in told.items()], schema=quality.MOVED_ARROW)

    def refuse(*_):
        raise AssertionError("a word was searched for")

    monkeypatch.setattr(quality, "_find", refuse)
    monkeypatch.setattr(quality, "_pairs_finder", refuse)
    scored = quality._score_block(docs, found).to_pylist()
    assert [r["loss"] is None for r in scored] == [False, True, False, False] and all(r["loss"] > 0 for r in scored if r["loss"])


def test_quality_asks_for_no_pair_twice():
    """Pairs of words are asked for as contexts of trigrams, alone only where a text ends; turns share all parts."""
    import pyarrow as pa

    from tablesync.llm import quality
    from tablesync.llm.common import string_bytes

    class Texts:
        def select(self, *_):
            return self

        def mapInArrow(self, work, _):
            return work

    r = random.Random(5)
    texts = [" ".join(r.choice(["a", "b", "c7", "d,", "\n", "Élan"]) for _ in range(r.randrange(40))) for _ in range(90)] + ["", "a", "\n"]
    trusted = [r.random() < 0.4 for _ in texts]
    batch = pa.RecordBatch.from_pydict({"ask": [1] * len(texts), "train": [2] * len(texts), "block": [3] * len(texts), "trusted": trusted, "text": texts})
    w1, w2, w3, start = quality._trigrams(*string_bytes(batch.column("text")))
    told = np.repeat(trusted, np.diff(np.append(start, len(w3))))

    def rows(*cols):
        return Counter(zip(*[c.tolist() for c in cols]))

    for turns in (1, 2, 5):
        got = defaultdict(Counter)
        cuts = quality._cut(turns, 20)
        for lo, hi in zip(cuts, cuts[1:]):
            for b in quality._send(Texts(), lo, hi, 20, 4)(iter([batch])):
                for row in b.to_pylist():
                    assert lo <= row["part"] < hi
                    n = len(row["x"]) - (row["kind"] == quality.TRIGRAMS)
                    keys = quality._unpack_rows(row["x"][:n])
                    times = quality._unpack(row["x"][-1]).tolist() if row["kind"] == quality.TRIGRAMS else [1] * len(keys[0])
                    for key, k in zip(zip(*[c.tolist() for c in keys]), times):
                        got[row["kind"]][key] += k
        asked = rows(quality._then(w1, w2), w3 & quality.UPPER)
        assert got[quality.ASK_TRIGRAMS] == Counter(asked.keys())
        assert got[quality.TRIGRAMS] == rows(quality._then(w1, w2)[told], (w3 & quality.UPPER)[told])
        assert got[quality.PAIRS] == Counter(rows(w2[told], w3[told], (w1 & quality.UPPER)[told]).keys())
        ends = np.append(start[1:], len(w3)) - 1
        assert got[quality.ASK_PAIRS] == Counter(rows(quality._then(w2, w3)[ends]).keys())
        contexts = {k for k, _ in asked} - {int(quality.NOWHERE)}
        assert contexts | {k for k, in got[quality.ASK_PAIRS]} == set(quality._then(w2, w3).tolist())


def test_quality_orders_as_plain_sorts_do_and_turns_take_all_parts():
    from tablesync.llm.quality import _argsort, _cut

    for n, distinct in ((0, 1), (1, 1), (900, 6), (3000, 90_000)):
        for low in (False, True):
            (key,) = random_keys(n, distinct, 1, low)
            assert (_argsort(key) == np.argsort(key, kind="stable")).all()
    for turns, parts in ((1, 1), (1, 4), (5, 5), (5, 20), (5, 61), (5, 3000)):
        cuts = _cut(turns, parts)
        took = np.diff(cuts)
        assert len(took) == turns and cuts[0] == 0 and cuts[-1] == parts and took.min() >= 1
        assert turns == parts or turns == 1 or took[0] > took[-1]


def test_quality_keeps_freed_memory_up_to_a_limit(monkeypatch):
    """A small worker keeps freed memory for its next task; a large one, or one that held tables of others, gives it back."""
    from tablesync.llm import common

    gave = []
    monkeypatch.setattr(common, "give_back", lambda: gave.append(1))
    monkeypatch.setattr(common, "_resident", lambda: 200)
    common.free_worker(300)
    assert not gave
    common.worker_cache("words of another", dict)
    common.free_worker(300)
    common.free_worker(100)
    common.free_worker()
    assert len(gave) == 3


def test_quality_words_of_all_lengths():
    """Hashes tell words apart, wherever they stand and however long they are."""
    from tablesync.llm.quality import _words

    r = random.Random(8)
    said = ["".join(r.choice("abé") for _ in range(n)) for n in range(1, 140)] + ["a" * n for n in range(1, 140)] + ["\0", "\0\0", "7", "\n", "é" * 70_000]
    rows = [" ".join(r.sample(said, 40)) for _ in range(60)] + ["", " ", "\t \r"] + said
    off = np.cumsum([0] + [len(t.encode()) for t in rows])
    hashes, start = _words(np.frombuffer("".join(rows).encode(), np.uint8), off)
    by_word, by_hash = defaultdict(set), defaultdict(set)
    for t, lo, hi in zip(rows, start, start[1:]):
        found = re.findall("[a-zé]+|[0-9]+|\n+|\0+", t)
        assert len(found) == hi - lo
        for w, h in zip(found, hashes[lo:hi].tolist()):
            by_word[w].add(h)
            by_hash[h].add(w)
    assert len(by_word) == len(set(said)) and all(len(x) == 1 for x in [*by_word.values(), *by_hash.values()])


def test_quality_edges(spark):
    from tablesync.llm.quality import keep_good, score

    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (9, 1, None), (None, 1, 0), (7, 1, 0), (7, 0, 0), (8, None, 0)], "doc_id long, quality int, toxic int")
    got = score(edge_docs(spark), labels).collect()
    assert len(got) == len(EDGE)
    assert {r["doc_id"] for r in got if r["trusted"]} == {1, 9}
    assert all(r["keep"] for r in got if r["perplexity"] is None or r["threshold"] is None)
    assert all(r["perplexity"] > 0 for r in got if r["perplexity"] is not None)
    kept = keep_good(edge_docs(spark), labels)
    assert kept.columns == edge_docs(spark).columns and kept.count() == sum(r["keep"] for r in got)
    assert score(edge_docs(spark), labels.limit(0)).filter("keep").count() == len(EDGE)
    assert score(empty(spark), labels).count() == 0
