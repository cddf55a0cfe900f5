"""Token counts against a direct encoding, and scans of other flat files."""

import base64
import os
import random

import duckdb
import numpy as np
import pytest
import tiktoken

from millrace.llm import tokens
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def encoder():
    with open(tokens.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_counts_match_direct_encoding(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    e = encoder()
    want = sorted((i, len(e.encode_ordinary(t))) for i, t in docs)
    assert sorted(tuple(r) for r in QUERIES["op1_token_counts"](spark, FOLDER).collect()) == want


@pytest.mark.parametrize("block", [2, 10, 64, 8 << 20])
def test_odd_rows_over_many_blocks(spark, block):
    docs = [(1, None), (2, ""), (-3, "a"), (None, "null id"), (5, "x " * 300), (5, "x " * 300), (2**63 - 1, "ü\x00 end"), (-(2**63), "low"), (0, "zero")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, path int, block string").repartition(3)
    e = encoder()
    got = tokens.scan_tokens(spark, tokens.write_tokens(df), header=tokens.HEADER, block=block).select("doc_id", "n_tokens")
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr((i, len(e.encode_ordinary(t or "")))) for i, t in docs)
    assert tokens.token_counts(df.limit(0)).count() == 0


@pytest.mark.parametrize("width", [2, 4])
def test_flat_files_without_header(spark, tmp_path, width):
    rng = random.Random(width)
    want = []
    for name in ("a.bin", "b.bin", "c.bin", "d.bin"):
        ids = [rng.choice([7, 7, 1, 2, 3, 4]) for _ in range(rng.randint(1, 90))] + ([7] if name < "c" else [5])
        ids = [] if name == "d.bin" else ids
        (tmp_path / name).write_bytes(np.array(ids, f"<u{width}").tobytes())
        n, k = 0, 0
        for i, x in enumerate(ids):
            n += x != 7
            if x == 7 or i == len(ids) - 1:
                want.append((name, k, n))
                n, k = 0, k + 1
    got = tokens.scan_tokens(spark, str(tmp_path), width=width, separator=7, block=12)
    assert sorted((r.path[-5:], r.ordinal, r.n_tokens) for r in got.collect()) == sorted(want)
