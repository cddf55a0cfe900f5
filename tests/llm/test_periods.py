"""Periodic runs against direct comparison of all words."""

import hashlib
import random
import zlib

import numpy as np

from millrace.llm.periods import collapse_runs, extensions, grammar, run_digests, with_periodic_tails


def brute(w, least=6, times=4):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def kept(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sample(seed):
    draw = random.Random(seed)
    out = []
    for _ in range(300):
        kinds, n = draw.choice([1, 2, 3, 5, 60]), draw.choice([0, 1, 5, 6, 7, 20, 90, 250])
        w = [draw.choice("abcdefghijé") * draw.randint(1, 1 + kinds // 10) if kinds > 10 else "xyzuv"[draw.randrange(min(kinds, 5))] for _ in range(n)]
        if n > 10 and draw.random() < 0.7:
            a = draw.randrange(n)
            p = 1 + draw.randrange(max(1, (n - a) // 3))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        out.append(w)
    return out


def test_extensions_on_both_sides():
    rng = np.random.default_rng(5)
    for kinds in (2, 3, 40):
        body = np.concatenate([rng.integers(0, kinds, 150), np.tile(rng.integers(0, kinds, 7), 20), np.zeros(60, np.int64)])
        text = np.concatenate([[kinds], body, [kinds + 1]])
        levels = grammar(text)
        i = rng.integers(0, len(text) - 1, 3000)
        j = rng.integers(0, len(text), 3000)
        i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]

        def same(a, b):
            n = 0
            while b + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            return n

        assert extensions(levels, i, j).tolist() == [same(a, b) for a, b in zip(i, j)]
        back, turned = [x.mirrored() for x in levels], text[::-1]
        text, keep = turned, text
        assert extensions(back, i, j).tolist() == [same(a, b) for a, b in zip(i, j)]
        text = keep


def test_runs_against_brute_force(spark):
    docs = [(k, " \t\n"[k % 3].join(w)) for k, w in enumerate(sample(1))]
    docs += [(None, "a b " * 9), (None, None), (5, "a a a a a a"), (5, "a a a a a a"), (6, ""), (7, " \n ")]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, runs int, n_words string").repartition(4)
    want = []
    for i, t in docs:
        w = (t or "").split()
        runs = brute(w)
        want.append((i, len(w), runs, kept(w, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in collapse_runs(table).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    other = [(r.doc_id, [tuple(x) for x in r.runs]) for r in collapse_runs(table, least=10, times=5).collect()]
    assert sorted(other, key=repr) == sorted([(i, brute((t or "").split(), 10, 5)) for i, t in docs], key=repr)


def test_digests_with_periodic_tails(spark):
    docs = [(k, " ".join(w)) for k, w in enumerate(sample(2))]
    want = []
    for i, t in docs:
        w, h = t.split(), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
        runs = brute(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        said = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(runs), *four, sha(said), sha(kept(w, runs))))
    got = run_digests(with_periodic_tails(spark.createDataFrame(docs, "doc_id bigint, text string")))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted(want, key=repr)


def test_a_very_long_text(spark):
    words = [f"w{i % 90}" for i in range(300_000)] + ["end"] + ["again"] * 100_000
    row = collapse_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id bigint, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 90), (300_001, 100_000, 1)]
    assert row.collapsed == " ".join([*words[:90], "end", "again"])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert run_digests(with_periodic_tails(docs)).collect() == []
