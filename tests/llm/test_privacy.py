"""Private data: patterns against a plain reading, disclosure against its formula, sanitised texts."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from millrace.llm.privacy import PATTERNS, base_spans, disclosing_terms, private_digests, private_spans, running_sums, sanitise

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def card(draw):
    digits = "".join(str(draw.randrange(10)) for _ in range(draw.choice([14, 15, 17, 18, 19])))
    whole = next(digits + c for c in "0123456789" if luhn(digits + c))
    return "".join(c + draw.choice(["", "", " ", "-"]) for c in whole[:-1]) + whole[-1]


def test_patterns(spark):
    draw = random.Random(3)
    signs = "ab1234567890..@@--++ ()%é🎈\n_"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 80))) for _ in range(6000)]
    texts += ["".join(draw.choice([card(draw), draw.choice(signs)]) for _ in range(6)) for _ in range(1500)]
    texts += [None, "", "256.1.1.1 0255.01.1.1 1.2.3.4.5.6.7.8", "a@b.c_d@e.f a@b a@b.c. x@y.z@w.v", "1 22  333 4444-5555-6666-7779"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    got = {r.doc_id: [tuple(s) for k in PATTERNS for s in r[k]] for r in base_spans(docs.fillna("")).collect()}
    assert all(got[i] == plain(t) for i, t in enumerate(texts))
    assert sum(map(len, got.values())) > 500


def test_long_runs_take_linear_time(spark):
    long = ["a" * 2_000_000, "1" * 2_000_000, "1 " * 1_000_000, "+" * 500_000, "+1" * 500_000, "1." * 800_000, "x@" + "y." * 500_000 + "z", "a@b.c " * 100_000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id bigint, text string").repartition(8)
    rows = {r.doc_id: r for r in base_spans(docs).select("doc_id", *[F.size(k).alias(k) for k in PATTERNS]).collect()}
    assert rows[6].email == 1 and rows[7].email == 100_000 and rows[0].email == rows[1].card == 0


def test_running_sums(spark):
    for n in (0, 1, 2, 255, 256, 257, 1000, 70_000):
        assert spark.range(1).select(running_sums(F.sequence(F.lit(1), F.lit(n)).cast("array<bigint>") if n else F.array().cast("array<bigint>"))).first()[0] == [k * (k + 1) // 2 for k in range(1, n + 1)]


def corpus():
    """Texts of random words; a name stands beside one address in six of them and alone in three."""
    draw = random.Random(7)
    common = ["the", "of", "and", "house", "water"]
    prose = lambda n: " ".join(draw.choice(common) if draw.random() < 0.5 else f"w{draw.randrange(3000)}" for _ in range(n))
    docs = [prose(draw.randint(30, 200)) for _ in range(400)]
    for k in range(6):
        docs[k] += f" write Mira Zorvek mira@zorvek.example now {prose(40)}"
    for k in range(6, 9):
        docs[k] = "Zorvek said " + docs[k]
    copied = f"our secretword and {prose(150)} bob@corp.example {prose(60)}"
    docs += [copied] * 30 + [copied.replace("water", f"x{k}", 2 + k % 3) for k in range(20)]  # copies are one witness
    return docs


def test_disclosure_and_spans(spark):
    docs = corpus()
    table = spark.createDataFrame([(k, t, "x", k) for k, t in enumerate(docs)], "doc_id bigint, text string, term string, start int").repartition(6)
    found = {(r.entity, r.term): r for r in disclosing_terms(table, threshold=0.8).collect()}
    assert {t for _, t in found} >= {"Mira", "Zorvek", "write"} and {e for e, _ in found} == {"email:mira@zorvek.example"}
    holding = lambda w: sum(bool(re.search(rf"\b{w}\b", t)) for t in docs)
    for (_, term), r in found.items():
        if " " not in term:
            assert (r.n_entity, r.n_term) == (6, sum(bool(re.search(rf"\b{term}\b", re.sub(PLAIN["email"], " ", t))) for t in docs))
            total = len(docs)
            assert math.isclose(r.share, math.log2(total * r.n_both / (6 * r.n_term)) / math.log2(total / 6))
    assert holding("Zorvek") == 9
    rows = {r.doc_id: r for r in private_spans(table, threshold=0.8).collect()}
    for k, t in enumerate(docs):
        assert [tuple(s) for p in PATTERNS for s in rows[k][p]] == plain(t)
        said = {t[s.start : s.end] for s in rows[k].terms}
        assert said <= {x for _, w in found for x in (w,)}
        assert ("Zorvek" in said) == (k < 9)
    spans = private_spans(table, threshold=0.8).select("doc_id", F.concat(*PATTERNS, "terms").alias("spans"))
    clean = {r.doc_id: r.out for r in table.select("doc_id", "text").join(spans, "doc_id").select("doc_id", sanitise(F.col("text"), F.col("spans")).alias("out")).collect()}
    assert "Zorvek" not in clean[0] and "[EMAIL]" in clean[0] and "zorvek.example" not in clean[0]
    assert clean[7].endswith(docs[7].split("said ")[1]) and clean[300] == docs[300]


def test_sanitise_cuts_at_block_ends(spark):
    text = "é" * 5000 + "SECRET" + "x" * 5000 + "12"
    spans = [("email", 5000, 5006), ("removed", 5002, 5010), ("generalised", 10006, 10008)]
    df = spark.createDataFrame([(text, spans), ("", []), ("ab", [("ip", 0, 2)])], "text string, spans array<struct<kind: string, start: bigint, end: bigint>>")
    assert [r[0] for r in df.select(sanitise(F.col("text"), F.col("spans"))).collect()] == ["é" * 5000 + "[EMAIL]" + "x" * 5000 + "[CODE]", "", "[IP]"]


def test_odd_rows(spark):
    rows = [(None, "a@b.cc", 1), (None, None, 1), (5, "a@b.cc", 1), (5, "a@b.cc", 1), (6, "", 2), (7, "\x01\x01 \x02 a@b.cc \x01", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, email int")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted([tuple(r)[:6] for r in private_digests(docs).collect()], key=repr)
    one, none = (1, 0, 0, 0, sha("email:0:6")), (0, 0, 0, 0, sha(""))
    assert got == sorted([(None, *one), (None, *none), (5, *one), (5, *one), (6, *none), (7, 1, 0, 0, 0, sha("email:5:11"))], key=repr)
    assert private_digests(docs.limit(0)).collect() == []
