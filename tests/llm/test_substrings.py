"""Substring dedup against brute force."""

import hashlib
import os
import random
import re

import duckdb
import pytest

from millrace.llm import substrings
from millrace.llm.queries import QUERIES
from millrace.llm.substrings import SuffixAutomaton, without_repeats

FOLDER = "/root/testdata/sf0.001"


def brute(docs, k):
    first = {}
    cut = [(i, re.findall(rb"[^ \t-\r]+", (t or "").encode())) for i, t in docs]
    for i, ws in cut:
        for j in range(len(ws) - k + 1):
            if i is not None:
                key = tuple(ws[j : j + k])
                first[key] = min(i, first.get(key, i))
    for i, ws in cut:
        gone = set()
        for j in range(len(ws) - k + 1):
            if i is not None and first[tuple(ws[j : j + k])] < i:
                gone.update(range(j, j + k))
        yield i, len(ws), len(gone), b" ".join(w for j, w in enumerate(ws) if j not in gone).decode()


def check(spark, docs, k, limit):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, start string")
    got = [tuple(r) for r in without_repeats(df, window=k, limit=limit).collect()]
    assert sorted(got, key=repr) == sorted(brute(docs, k), key=repr)
    return got


@pytest.mark.parametrize("k,limit", [(3, 1), (5, 1000), (12, 2), (12, 1000)])
def test_random_documents(spark, k, limit):
    rng = random.Random(k)
    pool = [[rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(30)] for _ in range(6)]
    docs = []
    for i in range(60):
        ws = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(pool)
            a = rng.randint(0, 20)
            ws += p[a : a + rng.randint(1, 25)] + [rng.choice("abc") for _ in range(rng.randint(0, 3))]
        docs.append((rng.choice([i, i, 7, None]), rng.choice([" ", "\n", "\t "]).join(ws)))
    docs += [(100, None), (101, ""), docs[3], docs[3], (102, docs[3][1]), (103, " ".join(f"w{i}" for i in range(9000))), (104, " ".join(f"w{i}" for i in range(9000)))]
    assert any(r[2] for r in check(spark, docs, k, limit))


@pytest.mark.parametrize("limit", [1, 150, 1_000_000])
def test_texts_that_repeat_few_words(spark, limit, monkeypatch):
    """One context each, as long as the text: whole, shorter, longer and shifted ones."""
    monkeypatch.setattr(substrings, "HANDED", 16)
    docs = [(i, " ".join(["a", "b", "c"][(i + j) % 3] for j in range(n))) for i, n in enumerate([40, 90, 40, 11, 12, 300, 299, 300])]
    docs += [(20, " ".join(["z"] * 80)), (21, "y " + " ".join(["z"] * 200)), (22, " ".join(["z"] * 15)), (19, " ".join(f"u{j}" for j in range(40))), (23, " ".join(f"u{j}" for j in range(30)))]
    assert any(r[2] for r in check(spark, docs, 12, limit))


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_automaton():
    rng = random.Random(1)
    for _ in range(50):
        seqs = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 40))] for _ in range(4)]
        a = SuffixAutomaton()
        for s in seqs:
            a.add(s)
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(60)]
        for k in (1, 3, 6):
            have = {tuple(s[i : i + k]) for s in seqs for i in range(len(s) - k + 1)}
            assert a.matches(text, k) == [i for i in range(len(text) - k + 1) if tuple(text[i : i + k]) in have]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_matches_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    want = sorted((i, n, r, hashlib.sha256(t.encode()).hexdigest()) for i, n, r, t in brute(docs, 50))
    assert sorted(tuple(r) for r in QUERIES["op5_substring_dedup"](spark, FOLDER).collect()) == want
