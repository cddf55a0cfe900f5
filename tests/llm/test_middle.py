"""Fill-in-the-middle against a direct reading of its rules."""

import hashlib
import re

import pytest

from millrace.llm.middle import _Reader, fill_in_middle, fim_digests, fim_pieces, in_order

SCHEMA = "doc_id bigint, text string, row string, position int, piece string"


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["", None, " ", "one", "é<", "<P", "<S><", "a <M> b", "x<P>y", "ends with <", "\x00\n\r\n", "日本 text 🎈🎈 more", "don't  stop\n" * 40, "Z" * 500, "<" * 300, "<S" * 200, "é" * 333]


@pytest.mark.parametrize("size", [5, 64, 1 << 16])
def test_against_the_rules(spark, size):
    rows = [(i, TEXTS[i % len(TEXTS)], "r", i, "p") for i in range(8 * len(TEXTS))]
    rows += [(None, "no id", "", 0, ""), (None, None, "", 0, ""), (7, "same id", "", 0, ""), (7, "same id", "", 0, ""), (7, "other text", "", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = sorted([(i, *plain(i, t)) for i, t, *_ in rows], key=repr)
    outputs = [tuple(r) for r in fill_in_middle(docs, size=size).collect()]
    assert sorted(outputs, key=repr) == want
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = sorted([(i, *plain(i, t)[:4], sha(plain(i, t)[4]), sha(t)) for i, t, *_ in rows], key=repr)
    assert sorted([tuple(r) for r in fim_digests(docs, size=size).collect()], key=repr) == want


def test_pieces_are_bounded_and_in_order(spark):
    text = "word, " * 50_000 + "L" * 200_000 + "é" * 100_000
    docs = spark.createDataFrame([(i, text) for i in range(6)], "doc_id bigint, text string")
    rows = in_order(fim_pieces(docs, size=4096)).collect()
    assert max(len(r.piece) for r in rows) <= 4096 + 3 and len(rows) > 6 * len(text) // 4096
    whole = {}
    for r in rows:
        assert r.position == len(whole.setdefault(r.row, []))
        whole[r.row].append(bytes(r.piece))
    assert sorted(b"".join(x).decode() for x in whole.values()) == sorted(plain(i, text)[4] for i in range(6))


def test_a_very_long_text(spark):
    text = "many words of all kinds; " * 400_000  # 10 million characters
    row = fim_digests(spark.createDataFrame([(3, text)], "doc_id bigint, text string")).first()
    n, form, a, b, out = plain(3, text)
    assert tuple(row) == (3, n, form, a, b, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_restoration_reads_the_output_alone():
    output = b"<S>tail <P <<P>head<S<M>mid<M"
    for cut in range(1, len(output)):
        reader, parts = _Reader("spm"), {0: b"", 1: b"", 2: b""}
        for k in range(0, len(output), cut):
            for part, piece in reader.read(output[k : k + cut]):
                parts[part] += piece
        for part, piece in reader.close():
            parts[part] += piece
        assert parts == {2: b"tail <P <", 0: b"head<S", 1: b"mid<M"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert fim_digests(docs).collect() == [] and fill_in_middle(docs).collect() == []
