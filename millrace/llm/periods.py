"""Periodic runs of words: recompression into a run-length grammar whose common-extension queries bound each run.

Whole documents go to tasks; a task takes the documents of an Arrow batch a few at a time. Words become numbers, each
document between two numbers of its own. A run of period q and at least four periods covers four consecutive multiples
of q, so equal words at four such places (all periods: a harmonic sum of places) give the candidates; the grammar's
extensions to both sides then give each candidate's exact ends, and no word is compared twice along a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, carried

#: Words of one grammar at most, unless a single document has more.
GROUP_WORDS = 200_000
#: Extensions asked for at once.
ASKED = 1 << 20
RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass
class Level:
    """The text as symbols; `parent` and `first` lead to the next level, where `first` has one entry more than symbols."""

    symbols: np.ndarray
    blocks: bool = False  # the next level compresses blocks of one symbol, else pairs
    parent: np.ndarray | None = None
    first: np.ndarray | None = None

    def mirrored(self) -> Level:
        if self.parent is None:
            return Level(self.symbols[::-1])
        above, n = len(self.first) - 1, len(self.symbols)
        return Level(self.symbols[::-1], self.blocks, (above - 1 - self.parent)[::-1], (n - self.first)[::-1])


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each distinct (a, b)."""
    return np.unique(a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1].astype(np.int32)


def _next(level: Level, heads: np.ndarray, second: np.ndarray, blocks: bool) -> np.ndarray:
    """Link the level to the one whose symbols begin at `heads`; returns its symbols."""
    marks = np.zeros(len(level.symbols), np.int32)
    marks[heads] = 1
    level.blocks, level.parent = blocks, np.cumsum(marks, dtype=np.int32) - 1
    level.first = np.append(heads, len(level.symbols)).astype(np.int32)
    return _named(level.symbols[heads], second)


def grammar(symbols: np.ndarray) -> list[Level]:
    """Levels of block and pair compression in turn, until no symbol stands twice."""
    numbered = np.unique(symbols, return_inverse=True)[1]
    levels, rng = [Level(numbered.astype(np.int32))], np.random.default_rng(1)
    while True:
        s = levels[-1].symbols
        heads = np.append(0, np.flatnonzero(s[1:] != s[:-1]) + 1)
        if len(heads) < len(s):
            s = _next(levels[-1], heads, np.diff(heads, append=len(s)), True)
            levels.append(Level(s))
        kinds = int(s.max()) + 1
        if kinds == len(s):
            return levels
        left = rng.integers(0, 2, kinds).astype(bool)[s]
        pairs, turned = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        if np.count_nonzero(turned) > np.count_nonzero(pairs):
            pairs = turned
        if not pairs.any():
            continue  # other sides are drawn
        heads = np.flatnonzero(np.append(True, ~pairs))
        paired = np.append(pairs, False)[heads]
        after = np.where(paired, s[np.minimum(heads + 1, len(s) - 1)] + 1, 0)
        levels.append(Level(_next(levels[-1], heads, after, False)))


def _step(level: Level, a: np.ndarray, b: np.ndarray) -> np.ndarray | int:
    """How far two places with equal symbols may go on together: over the rest of the shorter block, or one symbol."""
    if not level.blocks:
        return 1
    return np.minimum(level.first[level.parent[a] + 1] - a, level.first[level.parent[b] + 1] - b)


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair of places i < j the number of equal symbols from there on. The text must end in a unique symbol."""
    a, b = i.copy(), j.copy()
    stopped = np.zeros(len(i), np.int64)
    rising = np.arange(len(i))
    for n, level in enumerate(levels):
        while True:
            x, y = a[rising], b[rising]
            if level.parent is not None:
                up, vp = level.parent[x], level.parent[y]
                climb = (level.first[up] == x) & (level.first[vp] == y)
            else:
                climb = np.zeros(len(rising), bool)
            same = climb | (level.symbols[x] == level.symbols[y])
            stopped[rising[~same]] = n
            go = rising[same & ~climb]
            if not len(go):
                break
            step = _step(level, a[go], b[go])
            a[go] += step
            b[go] += step
            rising = rising[same]
        rising = rising[climb]
        if not len(rising):
            break
        a[rising], b[rising] = level.parent[a[rising]], level.parent[b[rising]]
    for n in range(len(levels) - 1, -1, -1):
        level = levels[n]
        here = np.flatnonzero(stopped >= n)
        if n + 1 < len(levels):  # from the level above, whose symbols differ
            fell = here[stopped[here] > n]
            a[fell], b[fell] = level.first[a[fell]], level.first[b[fell]]
            while len(fell):
                fell = fell[level.symbols[a[fell]] == level.symbols[b[fell]]]
                step = _step(level, a[fell], b[fell])
                a[fell] += step
                b[fell] += step
    return a - i


def _candidates(text: np.ndarray, ends: np.ndarray, sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, int]]:
    """(places, period): a place and the next three multiples of the period hold the same word. Long documents stand first."""
    longest = int(sizes[0]) if len(sizes) else 0
    holds = len(sizes) - np.searchsorted(sizes[::-1], np.maximum(least, times * np.arange(longest // times + 1)))
    for q in range(1, longest // times + 1):
        grid = text[: ends[holds[q] - 1] : q]
        same = grid[1:] == grid[:-1]
        run = same[2:] & same[1:-1] & same[:-2]
        if run.any():
            yield np.flatnonzero(run) * q, q


def _runs(words: list[np.ndarray], least: int, times: int) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of all runs in documents given as numbers, longest document first."""
    nothing = tuple(np.zeros(0, np.int64) for _ in range(4))
    text, ends, sizes = _joined(words)
    found = list(_candidates(text, ends, sizes, least, times))
    if not found:
        return nothing
    places = np.concatenate([p for p, _ in found])
    periods = np.concatenate([np.full(len(p), q) for p, q in found])
    held = np.searchsorted(ends, places, "right")
    inside = places + 3 * periods < ends[held]
    places, periods, held = places[inside], periods[inside], held[inside]
    if not len(places):
        return nothing
    # Only documents with candidates go into the grammar.
    some, held = np.unique(held, return_inverse=True)
    starts = ends - sizes
    places = places - starts[some][held]
    text, ends, sizes = _joined([words[d] for d in some])
    starts = ends - sizes
    places = places + starts[held]
    levels = grammar(text)
    back = [x.mirrored() for x in levels]
    out = []
    for k in range(0, len(places), ASKED):
        p, q = places[k : k + ASKED], periods[k : k + ASKED]
        right = p + q + extensions(levels, p, p + q)
        left = p - extensions(back, len(text) - p - q, len(text) - p)
        long = right - left >= np.maximum(least, times * q)
        out.append(np.stack([left[long], right[long], q[long]]))
    left, right, q = np.concatenate(out, axis=1)
    order = np.lexsort((q, right, left))  # of one stretch the smallest period counts; others are its multiples
    left, right, q = left[order], right[order], q[order]
    new = np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))[: len(left)]
    left, right, q = left[new], right[new], q[new]
    doc = np.searchsorted(ends, left, "right")
    return some[doc], left - starts[doc], right - left, q


def _joined(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All documents in one text, a number of its own before each and at the end; their ends (exclusive) and sizes."""
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + 1)
    top = max((int(w.max()) + 1 for w in words if len(w)), default=0)
    parts = [x for d, w in enumerate(words) for x in (np.array([top + d]), w)]
    return np.concatenate([*parts, [top + len(words)]]).astype(np.int64), ends, sizes


def _numbered(words: list[list[bytes]]) -> list[np.ndarray]:
    known: dict[bytes, int] = {}
    return [np.fromiter((known.setdefault(w, len(known)) for w in doc), np.int64, len(doc)) for doc in words]


def _kept(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> str:
    """The words without those that a run contains after its first period."""
    open_ = np.zeros(len(words) + 1, np.int64)
    np.add.at(open_, start + period, 1)
    np.add.at(open_, start + length, -1)
    kept = np.cumsum(open_)[:-1] == 0
    return b" ".join(w for w, k in zip(words, kept) if k).decode()


def _groups(batch: pa.RecordBatch, rows: pa.Array) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Rows of a batch with their words, about `GROUP_WORDS` at a time."""
    which: list[int] = []
    words: list[list[bytes]] = []
    size = 0
    for k, text in enumerate(rows):
        which.append(k)
        words.append((text.as_py() or b"").split())
        size += len(words[-1])
        if size >= GROUP_WORDS:
            yield which, words
            which, words, size = [], [], 0
    if which:
        yield which, words


def collapse_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row.

    `runs` has each maximal stretch of words with smallest period q that is `least` words and `times` (4 or more)
    periods long or longer, by start and period; `collapsed` is the text's words, one space between, without those
    that some run contains after its first q words. A null or blank text has no words, no runs and an empty result.
    Rows that repeat ids or texts are treated each for itself; a null id stays null; other columns are ignored.
    """
    if times < 4:
        raise ValueError("times must be 4 or more: candidates come from four places a period apart")
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for which, words in _groups(batch, batch.column("text").cast(pa.binary())):
                order = sorted(range(len(words)), key=lambda d: -len(words[d]))
                numbers = _numbered(words)
                doc, start, length, period = _runs([numbers[d] for d in order], least, times)
                by = np.lexsort((period, start, doc))
                doc, start, length, period = doc[by], start[by], length[by], period[by]
                at = np.searchsorted(doc, np.arange(len(words) + 1))
                place = np.argsort(order)
                lists, texts = [], []
                for d in range(len(words)):
                    s = slice(at[place[d]], at[place[d] + 1])
                    lists.append([{"start": a, "length": b, "period": c} for a, b, c in zip(start[s].tolist(), length[s].tolist(), period[s].tolist())])
                    texts.append(_kept(words[d], start[s], length[s], period[s]))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(which)), pa.array([len(w) for w in words], pa.int64()), pa.array(lists, pa.list_(_RUN)), pa.array(texts, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return carried(docs, id, text).mapInArrow(run, f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string")


def with_periodic_tails(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract's input: in about a tenth of the documents, chosen by crc32 of the id, the words from some place on
    repeat the first p of them. These texts become their words, one space between; others stay. A null id counts as ''."""
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+"), 0)
    h = F.crc32(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")))
    rows = docs.withColumn("h__", h).withColumn("w__", F.when(F.col("h__") % 10 == 0, words))
    n, g = F.size("w__"), F.floor(F.col("h__") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - F.col("a__")) / (3 + g % 8))).cast("int")
    rows = rows.withColumn("a__", F.when(n > 0, a)).withColumn("p__", F.when(n > 0, p))
    tail = F.transform(F.sequence(F.col("a__"), n - 1), lambda i: F.get("w__", F.col("a__") + (i - F.col("a__")) % F.col("p__")))
    repeated = F.array_join(F.concat(F.slice("w__", 1, F.col("a__")), tail), " ")
    return rows.withColumn(text, F.when(F.col("a__").isNotNull(), repeated).otherwise(F.col(f"`{text}`"))).drop("h__", "w__", "a__", "p__")


def run_digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The longest run of each document (ties: smallest start, then period) and digests of all its runs and what is left."""
    found = collapse_runs(docs, id, text)
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))), 1)
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
        F.floor(1000 * -F.col("best.l") / F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
