"""Substring dedup: remove every word inside a 50-word window that also starts in a document with a smaller id.

Suffix automata of reference shards find the matches. One automaton per shard of the corpus, broadcast to all documents,
would grow with the corpus in size and in number, so references are first routed to where they can match: each window
names an anchor, the least hash of its 8-word grams, and equal windows name the same one. Consecutive windows of
one anchor are a context. Contexts that are equal as a whole need no search. Where an anchor has different contexts, they
are a reference shard: they are taken by ascending owner (smallest document holding them), streamed through the automaton
of the contexts before, whose matching statistics of at least 50 words mark their windows, and then added to it.
An anchor whose different contexts hold more than `SHARD_WORDS` words would make an unbounded shard, be they many or, in
texts that repeat a few words, very long: its contexts are cut into their distinct windows, which Spark groups by
their 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordHashes, bounded_batches, mix, texts
from millrace.plans.scratch import materialize

WINDOW = 50
GRAM = 8
#: Words of an anchor's different contexts that one automaton takes (a context has about 70).
SHARD_WORDS = 70_000
#: Windows of hot anchors that a task gathers before it hands them on.
HANDED = 200_000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Rolling:
    """Hashes of all stretches of k words, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (self.base, self.inverse))

    def of(self, h: np.ndarray, k: int) -> np.ndarray:
        self._powers(len(h) + 1)
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.up[: len(h)], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * self.down[: len(h) - k + 1])

    def parts(self, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hashes of the stretches of h that begin at `starts`, each up to the next."""
        self._powers(len(h) + 1)
        return mix(np.add.reduceat(h * self.up[: len(h)], starts) * self.down[starts])


def anchors(h: np.ndarray, rolling: Rolling, window: int) -> np.ndarray:
    """The least gram hash of every window."""
    gram = min(GRAM, window)
    least = rolling.of(h, gram)
    want, have = window - gram + 1, 1
    n = len(h) - window + 1
    while 2 * have <= want:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[:n], least[want - have : want - have + n])


def _contexts(window: int):
    """(doc_id, row, start, size, anchor, context) for every run of windows with one anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rolling = WordHashes(7), Rolling(_BASES[0])
        for batch in batches:
            found = []
            for d, r, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), texts(batch.column("text"))):
                words = text.split()
                if len(words) < window:
                    continue
                h = known.of(words)
                least = anchors(h, rolling, window)
                starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
                size = np.diff(np.r_[starts, len(least)])
                whole = rolling.parts(rolling.of(h, window), starts)
                found.append((np.full(len(starts), d), np.full(len(starts), r), starts, size, least[starts].view(np.int64), mix(whole + size.astype(np.uint64)).view(np.int64)))
            cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(cols, kinds)], ["doc_id", "row", "start", "size", "anchor", "context"])

    return run


_FETCHED = {"anchor": pa.int64(), "context": pa.int64(), "owner": pa.int64(), "words": pa.binary(), "w1": pa.int64(), "w2": pa.int64(), "offsets": pa.list_(pa.int32())}


def _fetched(window: int):
    """Words of each wanted context, or for contexts of hot anchors the hashes of its distinct windows and where they start."""
    step = HANDED

    def plain(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * 4
        n = pa.nulls(len(rows))
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(cols, _FETCHED.values())), *(n.cast(k) for k in list(_FETCHED.values())[4:])], list(_FETCHED))

    def cut(found: list[tuple]) -> pa.RecordBatch:
        keys, first, second, order, sizes = zip(*found)
        names = (np.repeat(np.array(k, np.int64), list(map(len, first))) for k in zip(*keys))
        edges = np.cumsum(np.r_[0, np.concatenate(sizes)]).astype(np.int32)
        offsets = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(order).astype(np.int32)))
        hashes = [np.concatenate(x) for x in (first, second)]
        return pa.RecordBatch.from_arrays([*map(pa.array, names), pa.nulls(len(offsets), pa.binary()), *map(pa.array, hashes), offsets], list(_FETCHED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Rolling(_BASES[0]), Rolling(_BASES[1])
        known, other = WordHashes(7), WordHashes(8)
        for batch in batches:
            rows, found, held = [], [], 0
            for d, text, wanted in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), batch.column("wanted").to_pylist()):
                words = text.split()
                for w in wanted:
                    mine = words[w["start"] : w["start"] + w["size"] + window - 1]
                    if not w["hot"]:
                        rows.append((w["anchor"], w["context"], d, b" ".join(mine)))
                        continue
                    a, b = one.of(known.of(mine), window).view(np.int64), two.of(other.of(mine), window).view(np.int64)
                    order = np.lexsort((b, a))
                    a, b = a[order], b[order]
                    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
                    found.append(((w["anchor"], w["context"], d), a[new], b[new], order, np.diff(np.r_[new, len(a)])))
                    held += len(a)
                    if held >= step:
                        yield cut(found)
                        found, held = [], 0
            yield plain(rows)
            if found:
                yield cut(found)

    return run


class SuffixAutomaton:
    """Of several sequences; states hold the length of their longest string, the suffix link and the moves."""

    def __init__(self):
        self.length, self.link, self.moves = [0], [-1], [{}]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.moves.append(moves)
        return len(self.length) - 1

    def _split(self, p: int, c: bytes, q: int) -> int:
        """The state for the strings that p's longest and c make, where q also holds longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.moves[q]))
        self.link[q] = copy
        while p >= 0 and self.moves[p].get(c) == q:
            self.moves[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[bytes]) -> None:
        last = 0
        for c in words:
            at = self.moves[last].get(c)
            if at is not None:
                last = self._split(last, c, at)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and c not in self.moves[p]:
                self.moves[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, c, self.moves[p][c])
            last = new

    def matches(self, words: list[bytes], least: int) -> list[int]:
        """Where windows of `least` words start that some sequence holds."""
        out, state, size = [], 0, 0
        for i, c in enumerate(words):
            while state and c not in self.moves[state]:
                state = self.link[state]
                size = self.length[state]
            to = self.moves[state].get(c)
            state, size = (0, 0) if to is None else (to, size + 1)
            if size >= least:
                out.append(i - least + 1)
        return out


def _matched(window: int):
    """(anchor, context, offset, size) of windows that a context with a smaller owner holds; rows by anchor, owner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, owner, automaton, waiting = None, None, SuffixAutomaton(), []
        for batch in batches:
            out = []
            for a, c, o, text in zip(*(batch.column(n).to_pylist() for n in ("anchor", "context", "owner", "words"))):
                if a != now:
                    now, automaton, waiting = a, SuffixAutomaton(), []
                elif o != owner:
                    for w in waiting:
                        automaton.add(w)
                    waiting = []
                owner = o
                words = text.split(b" ")
                found = automaton.matches(words, window)
                if len(found) < len(words) - window + 1:
                    waiting.append(words)  # contexts of one owner do not match each other
                if found:
                    f = np.array(found)
                    cuts = np.flatnonzero(np.diff(f) != 1) + 1
                    out.extend((a, c, int(s[0]), len(s)) for s in np.split(f, cuts))
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["anchor", "context", "offset", "size"])

    return run


def _kept(window: int):
    """(doc_id, n_words, n_removed, kept) of documents with their marked runs of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(texts(batch.column("text")), batch.column("spans").to_pylist()):
                words = text.split()
                n = len(words)
                if spans:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, [s["start"] for s in spans], 1)
                    np.add.at(edge, [s["start"] + s["size"] + window - 1 for s in spans], -1)
                    words = [w for w, x in zip(words, np.cumsum(edge)[:n].tolist()) if not x]
                rows.append((n, n - len(words), b" ".join(words).decode()))
            cols = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_words", "n_removed", "kept"])

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digest = pa.array([hashlib.sha256(t).hexdigest() for t in texts(batch.column("kept"))], pa.string())
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("doc_id", "n_words", "n_removed")), digest], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _runs(docs: DataFrame, window: int, limit: int) -> DataFrame:
    """(doc_id, row, start, size): marked runs of windows."""
    runs = materialize(docs.where("doc_id is not null").mapInArrow(_contexts(window), "doc_id long, row long, start int, size int, anchor long, context long"), "contexts")
    every = runs.groupBy("anchor", "context").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), (F.max("size") + (window - 1)).cast("long").alias("words")).repartition("anchor")
    per = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"), F.sum("words").alias("held"), F.min("owner").alias("low"), F.max("last").alias("high")).where("low < high")
    shared = every.join(per, "anchor").select("anchor", "context", "owner", "contexts", "held")
    known = materialize(runs.join(shared, ["anchor", "context"]), "shared-contexts")
    marked = known.where("doc_id > owner").select("doc_id", "row", "start", "size")  # its owner holds the whole context
    own = known.where("contexts > 1 and doc_id = owner")
    wanted = own.groupBy("anchor", "context").agg(F.min(F.struct("doc_id", "row", "start", "size")).alias("at"), F.first("held").alias("held"))
    wanted = wanted.select("at.doc_id", "at.row", F.struct("at.start", "at.size", "anchor", "context", (F.col("held") > limit).alias("hot")).alias("w"))
    wanted = wanted.groupBy("doc_id", "row").agg(F.collect_list("w").alias("wanted"))  # no more than a document's contexts
    found = materialize(docs.join(wanted, ["doc_id", "row"]).select("doc_id", "text", "wanted").mapInArrow(_fetched(window), "anchor long, context long, owner long, words binary, w1 long, w2 long, offsets array<int>"), "context-words")
    searched = found.where("words is not null").select("anchor", "context", "owner", "words").repartition("anchor").sortWithinPartitions("anchor", "owner")
    hits = searched.mapInArrow(_matched(window), "anchor long, context long, offset int, size int")
    single = found.where("words is null")
    first = single.groupBy("w1", "w2").agg(F.min("owner").alias("least"))
    hits = hits.unionByName(single.join(first, ["w1", "w2"]).where("owner > least").select("anchor", "context", F.explode("offsets").alias("offset"), F.lit(1).alias("size")))
    spread = own.select("doc_id", "row", "start", "anchor", "context").join(hits, ["anchor", "context"])
    return marked.unionByName(spread.select("doc_id", "row", (F.col("start") + F.col("offset")).alias("start"), "size"))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, limit: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without words of repeated windows; kept words joined by a space.

    Words are [^\\x20\\x09-\\x0D]+, unchanged. A null text has none; texts under `window` words are kept whole. A
    document without id neither loses words nor counts as a source. Rows that share an id count as one document:
    they never remove from each other. Empty tables give no rows; further columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("row"), body.alias("text"))
    spans = _runs(rows, window, limit).groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "size")).alias("spans"))  # no more than a document's windows
    return rows.join(spans, ["doc_id", "row"], "left").select("doc_id", "text", "spans").mapInArrow(_kept(window), "doc_id long, n_words long, n_removed long, kept string")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """`without_repeats` with the kept text's SHA-256 in place of the text."""
    return without_repeats(docs).mapInArrow(_digested, "doc_id long, n_words long, n_removed long, kept_sha256 string")
