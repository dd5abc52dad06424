"""Plain-Python versions of what the operators find, for small tables."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow.parquet as pq

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def documents():
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]


#: Nulls, empty and long texts, ties, repeated rows, odd characters, and columns that the operators use themselves.
EDGE = [
    (1, "alpha beta gamma delta epsilon zeta\neta theta iota kappa lambda mu\nnu xi"),
    (1, "alpha beta gamma delta epsilon zeta\neta theta iota kappa lambda mu\nnu xi"),
    (2, "Alpha beta gamma delta epsilon zeta\neta theta iota kappa lambda mu\nnu xi"),
    (None, "alpha beta gamma delta epsilon zeta\neta theta iota kappa lambda mu\nnu xi"),
    (3, None), (4, ""), (5, " "), (6, "\n\n\n"), (7, "one"), (8, "one"), (9, "MIT License and cc by, cc-by 4.0"),
    (10, "KK 한국어 \U0001f600 ▁x  y\t\x00z café café"), (11, "<s> </s> <unk> <0x0A> <|endoftext|> it's 'stuff"),
    (12, "long " * 30000 + "tail"), (2**53 + 1, "x" * 100000), (-7, "a­b × 1 2 3"), (13, "short passage of an item"),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hit string, th long, __th string, line_dedup string, block int, n_tokens string"


def edge_docs(spark, rows=EDGE):
    return spark.createDataFrame([(i, t, None if n % 3 else "en", None, None, "h", None, "t", "l", n, None) for n, (i, t) in enumerate(rows)], EDGE_SCHEMA).repartition(3)


def key(row):
    return repr(row)


def same(df, expected):
    """Rows of a DataFrame against tuples, in any order."""
    got = sorted((tuple(r) for r in df.collect()), key=key)
    assert got == sorted(expected, key=key)


def jaccard(rows, k=5):
    """(doc_id, links, class id) by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and (least.get(root(i)) is None or d < least[root(i)]):
            least[root(i)] = d
    return [(d, len(sets[i]), least.get(root(i)), links[i]) for i, (d, _) in enumerate(rows)]


def cut_lines(rows):
    """(doc_id, text) after line dedup, document by document in order of id; a null id comes first."""
    from tablesync.llm.linededup import chunks_of

    def counted(c):
        return len(c) > 1 and any(line.strip() for line in c)

    keeper = {}
    for d, t in rows:
        for c in chunks_of(t) if t else []:
            if counted(c):
                at = "\n".join(c)
                rank = (d is not None, d)
                if at not in keeper or rank < keeper[at]:
                    keeper[at] = rank
    out = []
    for d, t in rows:
        kept, seen = [], set()
        for c in chunks_of(t) if t is not None else []:
            at = "\n".join(c)
            if counted(c) and (at in seen or keeper[at] != (d is not None, d)):
                continue
            seen.add(at)
            kept += c
        out.append((d, "\n".join(kept) if t is not None else None))
    return out


def cut_passages(rows, least=50):
    """(doc_id, text) after line dedup that also removes repeated passages of more
    than ``least`` words: by the texts themselves, without hashes."""
    from tablesync.llm.linededup import chunks_of

    def places(t):
        lines, spans, a = t.split("\n"), [], 0
        for c in chunks_of(t):
            spans.append((a, a + len(c)))
            a += len(c)
        if spans[-1][1] - spans[-1][0] > 2:
            spans.append((spans[-1][0], spans[-1][1] - 1))
        said = lambda s: "\n".join(lines[s[0] : s[1]])
        counted = lambda s: s[1] - s[0] > 1 and said(s).strip() != ""
        return lines, [(s, said(s)) for s in spans if counted(s)], [((i, i + 2), said((i, i + 2))) for i in range(len(lines) - 1) if counted((i, i + 2))]

    keeper = {}
    for d, t in rows:
        rank = (d is not None, d)
        for _, said in [x for part in places(t)[1:] for x in part] if t and "\n" in t else []:
            if said not in keeper or rank < keeper[said]:
                keeper[said] = rank
    out = []
    for d, t in rows:
        if not t or "\n" not in t:
            out.append((d, t))
            continue
        lines, chunks, pairs = places(t)
        gone, marked = set(), set()
        for found, marks in ((chunks, gone), (pairs, marked)):
            seen = set()
            for s, said in found:
                if said in seen or keeper[said] != (d is not None, d):
                    marks.update(range(*s))
                seen.add(said)
        for i in range(len(lines)):
            if i in marked and i - 1 not in marked:
                end = next(j for j in range(i, len(lines) + 1) if j not in marked)
                if sum(len(line.split()) for line in lines[i:end]) > least:
                    gone.update(range(i, end))
        out.append((d, "\n".join(line for i, line in enumerate(lines) if i not in gone)))
    return out


def windows_hit(rows, items, width=10):
    """(doc_id, n_words, n_hit, item names) by looking at every place."""
    wins = {}
    for name, t in items:
        w = words(t)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(n, {}).setdefault(tuple(w[i : i + n]), set()).add("" if name is None else str(name))
    out = []
    for d, t in rows:
        w, hit, names = words(t), set(), set()
        for n, own in wins.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in own:
                    hit.update(range(i, i + n))
                    names |= own[tuple(w[i : i + n])]
        out.append((d, len(w), len(hit), sorted(names)))
    return out


def mean_byte_losses(rows, trusted):
    """(loss, least loss) of each (lang, text) under a Kneser-Ney model of the bytes of the trusted ones."""
    import math

    models = {}
    for lang in {lang for lang, _ in rows}:
        level = {4: Counter()}
        for own, t in trusted:
            if own == lang and t:
                b = b"\xff" * 3 + t.encode() + b"\xfe"
                level[4].update(b[i - 3 : i + 1] for i in range(3, len(b)))
        for n in (3, 2, 1):
            level[n] = Counter(g[1:] for g in level[n + 1])
        alpha, gamma = {}, {}
        for n, grams in level.items():
            c = [0] + [sum(v == i for v in grams.values()) for i in (1, 2, 3, 4)]
            y = c[1] / (c[1] + 2 * c[2]) if c[1] + 2 * c[2] else None
            cut = [0.0] + [max(0.1, min(float(i), i - (i + 1) * y * c[i + 1] / c[i])) if c[i] and y is not None else i / 2 for i in (1, 2, 3)]
            total, off = Counter(), Counter()
            for g, v in grams.items():
                total[g[:-1]] += v
                off[g[:-1]] += cut[min(v, 3)]
            alpha.update({g: (v - cut[min(v, 3)]) / total[g[:-1]] for g, v in grams.items()})
            gamma.update({(n, h): off[h] / total[h] for h in total})
        models[lang] = alpha, gamma
    out = []
    for lang, t in rows:
        if not t:
            out.append((None, None))
            continue
        alpha, gamma = models[lang]
        b, losses = b"\xff" * 3 + t.encode() + b"\xfe", []
        for i in range(3, len(b)):
            p = 1 / 257
            for n in (1, 2, 3, 4):
                g = b[i - n + 1 : i + 1]
                p = alpha.get(g, 0) + gamma.get((n, g[:-1]), 1) * p
            losses.append(-math.log(p))
        m = sum(losses) / len(losses)
        out.append((m, m - 2 * math.sqrt(max(0, sum(x * x for x in losses) / len(losses) - m * m) / len(losses))))
    return out


def mean_losses(rows, trusted):
    """For each (group, text): mean loss, mean loss less two errors, and both of the
    loss over that of the lowest order, under a Kneser-Ney trigram model of the
    trusted texts of the group."""
    import math

    token = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|\n+|[^ \t\n\r\f\vA-Za-z0-9\x80-\xff]+")
    padded = lambda t: [None, None, *token.findall(t.encode()), 0]
    models = {}
    for group in {group for group, _ in rows}:
        level = {3: Counter()}
        for own, t in trusted:
            if own == group and t:
                b = padded(t)
                level[3].update(zip(b, b[1:], b[2:]))
        for n in (2, 1):
            level[n] = Counter(g[1:] for g in level[n + 1])
        alpha, gamma = {}, {}
        for n, grams in level.items():
            c = [0] + [sum(v == i for v in grams.values()) for i in (1, 2, 3, 4)]
            y = c[1] / (c[1] + 2 * c[2]) if c[1] + 2 * c[2] else None
            cut = [0.0] + [max(0.1, min(float(i), i - (i + 1) * y * c[i + 1] / c[i])) if c[i] and y is not None else i / 2 for i in (1, 2, 3)]
            total, off = Counter(), Counter()
            for g, v in grams.items():
                total[g[:-1]] += v
                off[g[:-1]] += cut[min(v, 3)]
            alpha.update({g: (v - cut[min(v, 3)]) / total[g[:-1]] for g, v in grams.items()})
            gamma.update({(n, h): off[h] / total[h] for h in total})
        models[group] = alpha, gamma
    out = []
    for group, t in rows:
        if not t:
            out.append((None,) * 4)
            continue
        alpha, gamma = models[group]
        b, losses, excesses = padded(t), [], []
        for i in range(2, len(b)):
            chances = [1e-6]
            for n in (1, 2, 3):
                g = tuple(b[i - n + 1 : i + 1])
                chances.append(alpha.get(g, 0) + gamma.get((n, g[:-1]), 1) * chances[-1])
            losses.append(-math.log(chances[3]))
            excesses.append(math.log(chances[1] / chances[3]))
        told = []
        for some in (losses, excesses):
            m = sum(some) / len(some)
            told += [m, m - 2 * math.sqrt(max(0, sum(x * x for x in some) / len(some) - m * m) / len(some))]
        out.append(tuple(told))
    return out
