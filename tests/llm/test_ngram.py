"""Language-model scores against brute force."""

import math
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from millrace.llm import ngram
from millrace.llm.ngram import discounts, language_scores
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(docs):
    toks = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + [None]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    c, big = Counter(), Counter()
    for i, t in docs:
        if not out(i):
            ws = toks(t)
            c.update(ws)
            big.update(zip(["<s>", *ws], ws))
    cont, follow, total = Counter(w for _, w in big), {}, Counter()
    for (a, _), n in big.items():
        total[a] += n
        follow.setdefault(a, [0, 0, 0])[min(n, 3) - 1] += 1
    times = lambda xs: [sum(x == k for x in xs) for k in (1, 2, 3, 4)]
    d, low = discounts(times(big.values())), discounts(times(cont.values()))
    N, V, B = sum(c.values()), len(c), len(big)
    rest = sum(low[min(x, 3) - 1] for x in cont.values()) / B if B else 1.0

    def p(a, w):
        q = (cont[w] - low[min(cont[w], 3) - 1] if cont[w] else 0) / max(B, 1) + rest / (V + 1)
        if not total[a]:
            return q
        n = big[a, w]
        return ((n - d[min(n, 3) - 1] if n else 0) + sum(x * y for x, y in zip(d, follow[a])) * q) / total[a]

    for i, t in docs:
        ws = toks(t)
        base = sum(math.log10((c[w] + 0.5) / (N + 0.5 * (V + 1))) for w in ws)
        yield i, out(i), len(ws), sum(c[w] > 0 for w in ws), N, base, sum(math.log10(p(a, w)) for a, w in zip(["<s>", *ws], ws))


def same(df, docs):
    key = lambda r: repr((r[0], r[2], r[5]))[:30]
    got, want = sorted((tuple(r) for r in df.collect()), key=key), sorted(brute(docs), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return got


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_scores_match_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    got = same(language_scores(spark.read.parquet(f"{FOLDER}/documents.parquet")), docs)
    query = [tuple(r) for r in QUERIES["op10_language_scores"](spark, FOLDER).collect()]
    assert [r[:5] for r in sorted(query)] == [r[:5] for r in sorted(got)]
    assert all(a[5:] == pytest.approx(b[5:], abs=6e-7) for a, b in zip(sorted(query), sorted(got)))  # six decimals
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than the base on unseen texts


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "a b a b a"), (3, "a b a b a"), (None, "x y"), (5, "A\tb \x0b c"), (6, "the cat " * 400), (7, " ".join(f"w{i}" for i in range(20_000)))]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, held_out int, score string")
    same(language_scores(df), docs)
    assert language_scores(df.limit(0)).count() == 0
    only = [(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    same(language_scores(spark.createDataFrame(only, "doc_id long, text string")), only)


def test_a_shard_is_summed_as_its_rows_come(spark, monkeypatch):
    rows = [(0, 7, 3, 2), (0, 7, 3, 5_000_000_000), (0, 9, 3, 1), (2, 1, 1, 1)]
    packed = [ngram._packed(s, np.array([w], np.uint64), np.array([n], np.int64), np.array([k], np.int64), np.zeros(0)) for s, w, k, n in rows]
    want = [(0, [7, 9], [5_000_000_002, 1], [6, 3]), (2, [1], [1], [1])]
    for held in (1, 1 << 20):
        monkeypatch.setattr(ngram, "MERGED_BYTES", held)
        got = [(s, w.tolist(), n.tolist(), k.tolist()) for s, ((w,), (n, k)) in ngram._by_shard(iter([ngram._batch(packed[:1]), ngram._batch(packed[1:])]), ngram._word_rows)]
        assert got == want


def test_a_lost_model_file_raises(spark):
    docs = spark.createDataFrame([("a b a c",), ("b a d",)], "text string")
    model = ngram.learn(docs)
    assert model.worded and model.followed
    whole = ngram.scores(model, ngram.Tables(model), [b"a b", b"never seen"])
    assert len(whole) == 2
    for kind, shards in (("words", model.worded), ("bigrams", model.followed)):
        path = f"{model.folder.removeprefix('file:')}/{kind}-{min(shards)}"
        os.rename(path, path + ".gone")
        with pytest.raises(FileNotFoundError):
            ngram.scores(model, ngram.Tables(model), [b"a b c d", b"d a"])
        os.rename(path + ".gone", path)
