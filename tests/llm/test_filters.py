"""Decontamination, dedup, near copies, toxicity and mixing against brute force and on odd rows."""

import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import components as components_of
from millrace.llm import decontaminate, exact, mixing, simhash, toxicity
from millrace.llm.components import components
from millrace.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
LONG = " ".join(f"w{i}" for i in range(30_000))
ODD = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two", "b"), (4, "one two", "b"), (5, "onetwo ", "b"), (None, "one two", "b"), (7, LONG, None), (8, LONG + " ", "c"), (None, "null id", "c"), (9, "Ünï çode ÄÖ \x00 x", "a")]


@pytest.fixture(scope="module")
def odd(spark):
    schema = "doc_id long, text string, source string, digest int, content string, rank string, bits string, k int, size string, rest int"
    return spark.createDataFrame([(a, b, c, 1, "x", "y", "z", 2, "s", 3) for a, b, c in ODD], schema)


def read(name):
    return duckdb.sql(f"SELECT * FROM '{FOLDER}/{name}.parquet'").fetchall()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def contaminated(text, items):
    doc, hit, ids = words(text), set(), set()
    for item, body in items:
        ws = words(body)
        for i in range(max(1, len(ws) - 12) if ws else 0):
            w = ws[i : i + 13]
            for j in range(len(doc) - len(w) + 1):
                if doc[j : j + len(w)] == w:
                    hit.update(range(j, j + len(w)))
                    ids.add(str(item))
    ids = sorted(ids)
    return len(doc), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(doc)


def test_decontamination_matches_brute_force(spark):
    items = [(i, t) for i, t in read("benchmark")]
    docs = {r[0]: r[1] for r in read("documents")}
    got = QUERIES["op2_decontamination"](spark, FOLDER).collect()
    assert len(got) == len(docs) and any(r.contaminated for r in got)
    grams = {tuple(w[i : i + 13]) for w in (words(t) for _, t in items) for i in range(max(1, len(w) - 12))}
    for r in got:
        doc = words(docs[r.doc_id])
        want = contaminated(docs[r.doc_id], items) if any(tuple(doc[i : i + 13]) in grams for i in range(len(doc))) else (len(doc), 0, 0, hashlib.sha256(b"").hexdigest(), False)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want


@pytest.mark.parametrize("shard", [10, 8_000_000])
def test_decontamination_short_items_and_shards(spark, odd, shard, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    items = [(1, "two"), (2, "ONE, two!"), (2, "one two"), (None, "null"), (3, None), (4, "..."), (5, " ".join(f"w{i}" for i in range(70, 95))), (6, "a"), (7, "w5 w6 w7")]
    df = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontaminate.contamination(odd, df).drop("items"))
    known = [(i, t) for i, t in items if t]
    want = []
    for i, t, _ in ODD:
        n, h, _, _, c = contaminated(t, known)
        ids = sorted({str(k) for k, b in known if k is not None and contaminated(t, [(k, b)])[1]})
        want.append((i, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), c))
    assert got == sorted(want, key=repr)
    assert decontaminate.drop_contaminated(odd, df).columns == odd.columns
    assert decontaminate.drop_contaminated(odd, df.limit(0)).count() == len(ODD)
    assert decontaminate.contamination(odd.limit(0), df).count() == 0


def test_decontamination_of_many_shards(spark, monkeypatch):
    """More shards than a task holds, documents that wait for them, a third of all items alike."""
    for name, value in (("SHARD_BYTES", 4000), ("HELD_BYTES", 3000), ("KEPT", 2)):
        monkeypatch.setattr(decontaminate, name, value)
    rng = np.random.default_rng(2)
    text = lambda n: " ".join(f"v{i}" for i in rng.integers(0, 300, n))
    items = [(i, "same words of a test that many items hold " * 3 if i % 3 == 0 else text(int(rng.integers(1, 40)))) for i in range(120)]
    docs = [(i, text(60) + (" " + items[int(rng.integers(0, 120))][1] if i % 2 else "")) for i in range(80)]
    bank = spark.createDataFrame(items + items[:30], "item_id long, text string").repartition(3)
    assert len(decontaminate._stored(bank, "item_id", "text")) > 2 * decontaminate.KEPT
    got = rows(decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), bank).drop("items"))
    assert got == sorted([(i, *contaminated(t, items)) for i, t in docs], key=repr)


def test_shards_are_held_in_bounds(spark):
    bank = spark.createDataFrame([(i, f"item number {i}") for i in range(6)], "item_id long, text string")
    names = [n for i in range(6) for n in decontaminate._stored(bank.where(f"item_id = {i}"), "item_id", "text")]
    shards = decontaminate.Shards(names, 13)
    for turn in range(2):
        seen = [sorted(p for s in tables for p in s.patterns) for tables in shards]
        assert len(shards.held) == decontaminate.KEPT and sorted(seen) == [[f" item number {i} ".encode()] for i in range(6)]


def test_decontamination_very_long_word(spark):
    blob = "x" + "ab1" * 23_333
    docs = spark.createDataFrame([(1, f"see {blob} here"), (2, f"{blob} {blob[:-1]}c"), (3, blob + "d"), (4, f"a {blob[:40_000]} {blob} b")], "doc_id long, text string")
    items = spark.createDataFrame([(7, blob)], "item_id long, text string")
    got = rows(decontaminate.contamination(docs, items).select("doc_id", "n_words", "n_hit", "contaminated"))
    assert len(blob) == 70_000 and got == [(1, 3, 1, True), (2, 2, 1, True), (3, 1, 0, False), (4, 4, 1, True)]


def test_searcher_random():
    rng = random.Random(5)
    for _ in range(60):
        patterns = {(" " + " ".join(rng.choice(["a", "bb", "abc"]) for _ in range(rng.randint(1, 9))) + " ").encode(): [1] for _ in range(12)}
        data = (" " + " ".join(rng.choice(["a", "bb", "abc", "zz"]) for _ in range(4000)) + " ").encode()
        want = sorted((m.start(), p) for p in patterns for m in re.finditer(b"(?=" + re.escape(p) + b")", data))
        m = min(map(len, patterns))
        assert sorted(decontaminate.Searcher(patterns).find(data)) == want and m


def keep(docs):
    out, groups = [], {}
    for i, t, *_ in docs:
        groups.setdefault(re.sub(r"[ \t-\r]", "", t or ""), []).append((i, len(t or "")))
    for s, g in groups.items():
        best = min(g, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        first = True
        for x in g:
            out.append((x[0], best[0], len(g), x == best and first, hashlib.sha256(s.encode()).hexdigest()))
            first = first and x != best
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, odd, weak):
    digest = (lambda c: (F.length(c) % 3).cast("string")) if weak else exact.sha256
    assert rows(exact.exact_groups(odd, digest=digest, salts=3)) == keep(ODD)
    docs = read("documents")
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(7)
    assert rows(exact.exact_groups(df, digest=digest)) == keep(docs)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_keeps_all_columns(spark, odd, weak, monkeypatch):
    if weak:  # several contents share a digest
        monkeypatch.setattr(exact, "sha256", lambda c: (F.length(c) % 3).cast("string"))
    kept = exact.drop_exact_copies(odd)
    assert kept.columns == odd.columns
    assert rows(kept.select("doc_id")) == sorted(((r[0],) for r in keep(ODD) if r[3]), key=repr)
    assert exact.exact_groups(odd.limit(0)).count() == 0
    assert exact.drop_exact_copies(odd.limit(0)).count() == 0


def mark(text):
    ws = (text or "").encode().lower().split()
    grams = [b" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([b" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def linked(docs):
    marks = sorted({mark(t) for _, t, *_ in docs})
    root = {m: m for m in marks}

    def top(m):
        while root[m] != m:
            m = root[m]
        return m

    for i, a in enumerate(marks):
        for b in marks[:i]:
            if bin(a ^ b).count("1") <= 3:
                root[top(a)] = top(b)
    least = {}
    for i, t, *_ in docs:
        r = top(mark(t))
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    return sorted(((i, f"{mark(t):016x}", least[top(mark(t))]) for i, t, *_ in docs), key=repr)


def test_simhash_matches_brute_force(spark, odd):
    assert rows(simhash.simhash_groups(odd)) == linked(ODD)
    assert rows(QUERIES["op6_simhash"](spark, FOLDER)) == linked(read("documents"))
    assert simhash.simhash_groups(odd.limit(0)).count() == 0
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x) for x in {r[2] for r in linked(ODD)})


@pytest.mark.parametrize("bucket", [3, 1000])
def test_links_join_hot_buckets(spark, bucket):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    marks = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)} | {base ^ (i << 30) for i in range(200)}
    signed = {m - (1 << 64) if m >> 63 else m for m in marks}
    links = simhash.near_links(spark.createDataFrame([(m,) for m in signed], "bits long"), bucket)
    assert all(bin((r.a ^ r.b) & ((1 << 64) - 1)).count("1") <= 3 for r in links.collect())
    got = {r.node: r.root for r in components(links).collect()}
    root = {m: m for m in signed}

    def top(m):
        while root[m] != m:
            m = root[m]
        return m

    for a in signed:
        for b in signed:
            if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert {m: got.get(m, m) for m in signed} == {m: top(m) for m in signed}


def test_components_of_a_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(301)}
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [2, 10_000])
def test_components_with_hubs(spark, hot, monkeypatch):
    monkeypatch.setattr(components_of, "HOT_ROWS", hot)
    # Two hubs, one with the least and one with the greatest id of its group, 30,000 neighbours each, and short chains.
    n = 30_000
    star = spark.range(1, n + 1).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    upper = spark.range(n + 1, 2 * n + 1).select(F.col("id").alias("a"), F.lit(3 * n).cast("long").alias("b"))
    chains = spark.range(0, 900).select((F.col("id") + 4 * n).alias("a"), (F.col("id") + F.when(F.col("id") % 3 == 2, 0).otherwise(1) + 4 * n).alias("b"))
    found = {r.node: r.root for r in components(star.unionByName(upper).unionByName(chains)).collect()}
    want = {i: 0 for i in range(n + 1)} | {i: n + 1 for i in [*range(n + 1, 2 * n + 1), 3 * n]}
    assert found == want | {4 * n + i: 4 * n + i - i % 3 for i in range(900)}


def test_hot_keys_are_not_shuffled(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(components_of, "HOT_ROWS", 100)
    spark.range(0, 40_000, 1, 16).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    rows.groupBy("k").agg(F.count("*").alias("n"), F.min("x").alias("least")).write.parquet(f"{tmp_path}/table")
    table = spark.read.parquet(f"{tmp_path}/table")
    out = components_of.met(rows, table, "k")
    assert sorted(out.columns) == ["k", "least", "x"]
    assert out.where("k = -1").count() == 13_334 and out.count() == 40_000
    assert out.where("least != CASE WHEN k = -1 THEN 0 ELSE x END").isEmpty()
    shares = [r["count"] for r in out.where("k = -1").groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) > 1 and max(shares) < 13_334 / 2
    assert components_of.met(rows.limit(0), table.limit(0), "k").isEmpty()


def test_near_copies_with_repeated_ids_are_chosen_by_content(spark):
    docs = [(1, "same words here", "b"), (1, "same words here", "a"), (2, "same words here", "c"), (None, None, "x"), (None, "", "y"), (None, "", None)]
    kept = [rows(simhash.drop_near_copies(spark.createDataFrame(d, "doc_id long, text string, rest string").repartition(n))) for d, n in ((docs, 1), (docs[::-1], 3))]
    assert kept[0] == kept[1] and len(kept[0]) == 2


def test_toxicity_on_held_out_labels(spark):
    folder = FOLDER.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    fitted = labels.where("doc_id % 4 != 0")
    got = toxicity.toxicity(docs, fitted).join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    clean = [r.rejected for r in got if r.toxic == 0]
    toxic = [r.rejected for r in got if r.toxic == 1]
    assert len(got) > 900 and sum(clean) <= 0.005 * len(clean) and sum(toxic) >= 0.8 * len(toxic)


def test_rare_marks_are_learned():
    rng = random.Random(4)
    docs = [[f"w{rng.randrange(40)}" for _ in range(12)] + ([f"mark{i % 5}"] if i < 20 else []) for i in range(400)]
    labels = np.array([[rng.randrange(2), int(i < 20)] for i in range(400)])
    chain = toxicity.build(pa.array([sorted(set(d)) for d in docs], pa.list_(pa.string())), labels, ["quality", "toxic"])
    rejected = [chain.probabilities(" ".join(d).encode())[1] > toxicity.THRESHOLD for d in docs]
    assert rejected == [i < 20 for i in range(400)]  # each mark stands in 4 rows


def test_fit_converges():
    rng = np.random.default_rng(6)
    x = rng.random((300, 60)) < 0.1
    x[:, 30:] = x[:, :30]  # repeated columns
    y = (x[:, :3].sum(1) + rng.normal(0, 0.4, 300) > 0.7).astype(float)
    rows = toxicity.Rows(np.nonzero(x)[1], x.sum(1), 60, rng.random((300, 1)))
    for strength in (5e-2, 5e-3, 2e-4):
        w = toxicity._lasso(rows, y, strength)
        slope, pull = rows.gradient(toxicity._sigmoid(rows.margins(w)) - y), strength * (np.arange(62) < 61)
        off = np.where(w == 0, np.maximum(np.abs(slope) - pull, 0), np.abs(slope + pull * np.sign(w)))
        assert off.max() <= 1.01 * toxicity.TOLERANCE * strength


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (4, None, 1), (None, 1, 1), (7, 0, None), (7, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(odd, labels)
    assert got.count() == len(ODD) and got.where("p_toxic is null or p_quality is null").count() == 0
    assert toxicity.drop_toxic(odd, labels.limit(0)).count() == len(ODD)
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


def test_mixing_odd_rows(spark, odd):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        assert r.size == len((dict(zip(range(len(ODD)), ODD)) and next(t for i, t, _ in ODD if i == r.doc_id and len((t or "").split()) == r.size) or "").split())
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for rs in by.values():
        assert sum(r.taken for r in rs) == int(rs[0].target) and rs[0].source_size == sum(r.size for r in rs)
    assert rows(mixing.mix_sources(odd)) == sorted((tuple(r) for r in got), key=repr)
    assert mixing.mix_sources(odd.limit(0)).count() == 0


def test_targets_share_the_excess(spark):
    df = spark.createDataFrame([("1a", 1), ("1b", 1000), ("1c", 10), ("2", 0)], "skey string, source_size long")
    got = {r.skey: r.target for r in mixing.targets(df).collect()}
    assert got["1a"] == 3 and got["1c"] == 30 and got["2"] == 0 and got["1b"] == 1011 - 33


def test_sql_names():
    assert set(SQL) <= set(QUERIES)
