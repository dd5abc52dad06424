"""Merkle manifest, quality rules and whitening against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_helpers import EDGE, EDGE_SCHEMA, SF001, edge_docs, same
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


# ------------------------------------------------------------------ 11
def H(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H(*["-" if f is None else f"{len(str(f).encode('utf-8'))}:{f}" for f in fields])


def path(nodes, i):
    """(left, right) siblings level by level, and the node on top."""
    out = []
    while len(nodes) > 1:
        lo = i // 8 * 8
        out.append((nodes[lo:i], nodes[i + 1 : lo + 8]))
        nodes, i = [H(*nodes[a : a + 8]) for a in range(0, len(nodes), 8)], i // 8
    return out, nodes[0]


def manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for members in by.values():
        members.sort(key=lambda m: m[:3])
    subroots = [path([m[2] for m in by[g]], 0)[1] for g in langs]
    out = []
    for at, g in enumerate(langs):
        above, root = path(subroots, at)
        nodes = [m[2] for m in by[g]]
        for i, (_, _, own, r) in enumerate(by[g]):
            siblings, subroot = path(nodes, i)
            siblings = siblings + above
            now = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                now = leaf(r, r["text"] if r["text"] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
            for left, right in siblings:
                now = H(*left, now, *right)
            out.append((r["doc_id"], own, subroot, root, H(*[d for left, right in siblings for d in left + right]), now, now == root))
    return out


@pytest.mark.parametrize("lift", [4, 1, 2])
def test_manifest(spark, docs, monkeypatch, lift):
    import tablesync.llm.merkle as M

    monkeypatch.setattr(M, "LIFT", lift)
    monkeypatch.setattr(M, "BLOCK", 8**lift)
    expected = manifest(docs.collect())
    same(M.manifest_report(docs), expected)
    assert {r[-1] for r in expected} == {True, False}
    odd = edge_docs(spark)
    same(M.manifest_report(odd), manifest(odd.collect()))
    assert M.manifest_report(odd.limit(0)).collect() == []
    one = odd.filter("doc_id = 7")
    got = M.manifest_report(one).collect()[0]
    assert got["leaf"] == got["subroot"] == got["root"] and got["proof_sha256"] == H()


def test_manifest_of_many_groups_and_copies(spark, monkeypatch):
    import tablesync.llm.merkle as M

    monkeypatch.setattr(M, "LIFT", 2)
    monkeypatch.setattr(M, "BLOCK", 64)
    r = random.Random(3)
    # a hot language, many small ones, a row that repeats, and ids that repeat with other texts
    rows = [(i, "hot", "s", 1, f"Text {i}") for i in range(700)] + [(1000 + i, f"l{i}", None, None, "X") for i in range(70)]
    rows += [(5, "hot", "s", 1, "Same Row")] * 90 + [(6, "hot", "s", 1, f"Other {r.random()}") for _ in range(20)] + [(None, None, None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long, text string").repartition(5)
    same(M.manifest_report(df), manifest(df.collect()))


def test_states_before_each_slot_are_those_of_hashlib():
    import tablesync.llm.merkle as M
    from tablesync.llm.sha256 import absorb, finish, hex_text

    digests = np.frombuffer(hashlib.shake_256(b"x").digest(32 * 21), np.uint8).reshape(21, 32)
    made, states = M.parents_of(digests)
    said = [bytes(d).hex() for d in digests]
    assert [bytes(d).hex() for d in made] == [H(*said[i : i + 8]) for i in range(0, 21, 8)]
    # a state resumed over what is left of the run gives the parent
    for parent, size in ((0, 8), (2, 5)):
        for slot in range(size):
            now = states[parent, slot][None]
            for child in digests[8 * parent + slot : 8 * parent + size]:
                now = absorb(now, hex_text(child[None]))
            assert bytes(finish(now, [size])[0]) == bytes(made[parent])


# ------------------------------------------------------------------ 12
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = TOKEN.findall(text)
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    lines = [line for line in text.split("\n") if TOKEN.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words)


REPEATED = [
    (200, "a b c d e a b c d e"), (201, "a a a a a a a"), (202, "a b c d e f a b c d e g " + " ".join(f"w{i}" for i in range(60))), (203, "x\x0by\x0cz\rq\tw\n\n \nx\x0by"),
    (204, " ".join(["p q r s t u"] * 3 + [f"v{i}" for i in range(200)])), (205, "é ü \x1c   x y ## $$ %%"), (206, "same line\nsame line\n same line\n\n\nsame line"), (207, "Q " * 20000),
]


def test_rule_measures(spark, docs):
    from tablesync.llm.rules import rule_report

    got = {r["doc_id"]: tuple(r)[1:7] for r in rule_report(docs).collect()}
    assert got == {r["doc_id"]: measures(r["text"]) for r in docs.collect()}
    rows = EDGE + REPEATED
    out = rule_report(edge_docs(spark, rows))
    same(out.select(*out.columns[:7]), [(d, *measures(t)) for d, t in rows])
    assert out.filter("kept and base_failed").count() == 0
    assert rule_report(edge_docs(spark).limit(0)).collect() == []


def test_sketch_quantiles_and_merging(spark):
    from tablesync.llm import rules as R

    r = random.Random(1)
    rows = [(f"g{i % 3}", "a", r.lognormvariate(0, 2) if i % 10 else 0.0) for i in range(30000)]
    df = spark.createDataFrame(rows, "g string, rule string, value double")
    whole = R.sketched(df, ["g"])
    at = {"p": 0.05, "q": 0.5, "r": 0.9}
    for got in R.quantiles(R.merged(whole, []), [], at).collect():
        values = sorted(v for _, _, v in rows)
        for name, q in at.items():
            exact = values[math.ceil(q * len(values)) - 1]
            assert abs(got[name] - exact) <= 0.011 * exact
    # parts merged in any order are the sketch of the whole
    parts = [R.sketched(df.filter(f"value {op} 1"), ["g"]) for op in (">", "<=")]
    key = ["g", "rule", "bucket"]
    for a, b in (parts, parts[::-1]):
        same(R.merged(a.unionByName(b), ["g"]).select(*key, "n"), [tuple(x) for x in whole.select(*key, "n").collect()])


def test_adaptive_limits_follow_language_and_source(spark):
    from tablesync.llm.rules import judged

    r = random.Random(2)

    def text(symbol, length):
        return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(length - 1, length + 1))) + (" #" if r.random() < symbol else "") for _ in range(80))

    # one source writes many symbols, one long words: neither is an outlier at home, but is in the other
    rows = [(i, "x", "tags", text(0.5, 5)) for i in range(300)] + [(1000 + i, "x", "prose", text(0, 5)) for i in range(300)] + [(2000 + i, "y", "prose", text(0, 12)) for i in range(300)]
    rows += [(5000, "x", "prose", text(0.5, 5)), (5001, "x", "prose", text(0, 12)), (5002, "y", "prose", text(0, 5)), (5003, "x", "tags", text(0.5, 5)), (5004, "x", "new", text(0, 5)), (5005, None, None, text(0, 5))]
    out = {d["doc_id"]: d["kept"] for d in judged(spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")).collect()}
    assert not any(out[i] for i in (5000, 5001, 5002)) and all(out[i] for i in (5003, 5004, 5005))
    assert sum(not kept for i, kept in out.items() if i < 5000) == 0


def test_rules_keep_clean_texts_and_reject_junk(spark):
    from tablesync.llm.rules import judged

    sf = SF001.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    told = judged(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").filter("n_words >= 10")
    share = {r["quality"]: r["share"] for r in told.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.975 and share[0] < 0.05


# ------------------------------------------------------------------ 13
def scaled(row):
    return [math.floor(256 * float(c)) for c in row]


def whitened(rows, k=4):
    """(row, component) -> (n, deviation, |whitened|, explained) by an eigenvalue solver."""
    fit = np.array(sorted({tuple(scaled(v)) for v in rows}))
    n, sums = len(fit), fit.sum(axis=0)
    a = fit - sums / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > 1e-11 * max(values[0], 1e-300)).sum())
    out = {}
    for i, v in enumerate(rows):
        x = np.array(scaled(v))
        for c in range(min(k, rank)):
            out[i, c + 1] = (n, sum((n * int(p) - int(s)) ** 2 for p, s in zip(x, sums)), abs((x - sums / n) @ vectors[:, c]) / math.sqrt(values[c]), values[c] / values.sum())
    return out


def agree(got, ids, rows):
    expected = whitened(rows)
    mine = [r for r in got if r["vec_id"] in set(ids)]
    assert len(mine) == len(expected)
    for r in mine:
        n, deviation, w, share = expected[ids.index(r["vec_id"]), r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(abs(r["whitened"]) - w) < 1e-6 and abs(r["explained"] - share) < 1e-8 and r["identity_error"] < 1e-8


def test_whitening(spark):
    from tablesync.llm.whitening import whitened_rows

    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    agree(whitened_rows(df).collect(), [i for i, _ in rows], [v for _, v in rows])


def test_whitening_of_odd_vectors(spark):
    from tablesync.llm.whitening import whitened_rows

    r = np.random.default_rng(4)
    flat = (np.floor(r.normal(size=(300, 2)) @ r.normal(size=(2, 6)) * 100) / 256).tolist()
    flat = [[*v, 0.0, v[0]] for v in flat] + [[1.0] * 8] * 200  # a constant and a repeated dimension, a hot vector
    pair, lone = [[1.5, 2.5], [1.5, 2.5], [0.5, 2.5]], [[3.0, 4.0, 5.0]] * 4
    inf, nan = float("inf"), float("nan")
    bad = [None, [], [1.0, None], [nan, 1.0], [inf, 1.0], [-inf] * 8]
    rows = [(i, v, "e") for i, v in enumerate(flat)] + [(1000 + i, v, "e") for i, v in enumerate(pair)] + [(2000 + i, v, "e") for i, v in enumerate(lone)] + [(3000 + i, v, "e") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string").repartition(4)
    got = whitened_rows(df).collect()
    agree(got, list(range(len(flat))), flat)
    agree(got, [1000, 1001, 1002], pair)
    assert {g["vec_id"] for g in got} == {*range(len(flat)), 1000, 1001, 1002}
    assert whitened_rows(df.limit(0)).collect() == []
    twice = whitened_rows(df.filter("vec_id < 100").unionByName(df.filter("vec_id = 7").withColumn("vec_id", F.lit(None).cast("long"))))
    assert twice.filter("vec_id is null").count() == twice.filter("vec_id = 7").count() > 0


def test_ill_conditioned_vectors_and_large_deviations(spark):
    import tablesync.llm.whitening as Wh

    r = np.random.default_rng(5)
    wide = np.floor(r.normal(size=(400, 5)) * np.array([1e9, 1e6, 1e4, 1e2, 3.0]))
    ids = list(range(400))
    df = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in zip(ids, wide)], "vec_id long, embedding array<double>")
    got = Wh.whitened_rows(df).collect()
    a = np.unique(wide, axis=0)
    values = np.linalg.svd(a - a.mean(axis=0), compute_uv=False) ** 2 / len(a)
    for g in got:
        assert abs(g["explained"] - values[g["component"] - 1] / values.sum()) <= 1e-4 * g["explained"] and g["identity_error"] < 1e-4
    assert {g["component"] for g in got} == {1, 2, 3, 4} and len(got) == 1600
    assert all(g["deviation"] is None or g["deviation"] >= 0 for g in got) and any(g["deviation"] is None for g in got)
