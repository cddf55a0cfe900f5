"""Benchmark decontamination: Wu-Manber search of all items' word windows in whole documents.

Texts become their words (A-Z lowered, other ASCII than 0-9 and a-z is space) with one space between and
around, so a window is a byte string that starts and ends with a space. Windows are put into classes by length. In
a class all share the length m of the shortest; a shift table over hashed blocks says how far a search can move on when
the block at its end stands nowhere in the first m bytes of a window. Where the shift is 0 the block's bucket
gives the windows that end so, and bytes are compared. Many searches run side by side in numpy, each on its own lane.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import WORDS, bounded_batches, carried, map_batches, restored, texts, with_columns
from millrace.llm.store import mapped, put
from millrace.plans.scratch import scratch_path

WINDOW = 13
#: Twice the bytes of item texts that are aimed at for one set of tables.
SHARD_BYTES = 8_000_000
#: Sets of tables that a task holds at once.
KEPT = 2
#: Bytes of documents that wait for each set's turn where there are more.
HELD_BYTES = 64 << 20
TABLE_BITS = 20
LANE = 2048
_ODD = np.uint64(0x9E3779B97F4A7C15)


def spaced(text: bytes) -> bytes:
    """The words with one space between and around; one space if there are none."""
    words = text.translate(WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def windows(text: bytes, size: int = WINDOW) -> Iterator[bytes]:
    words = text.translate(WORDS).split()
    for i in range(max(1, len(words) - size + 1) if words else 0):
        yield b" " + b" ".join(words[i : i + size]) + b" "


class Searcher:
    """Tables of one length class."""

    def __init__(self, patterns: dict[bytes, list[int]]):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.block = b = 8 if m >= 16 else max(2, m // 2)
        self.mask = np.uint64((1 << 8 * b) - 1)
        kind = np.uint8 if m < 250 else np.uint16
        most = min(m - b + 1, np.iinfo(kind).max)  # a smaller shift than could be made misses nothing
        shift = np.full(1 << TABLE_BITS, most, kind)
        self.buckets: dict[bytes, dict[bytes, list[bytes]]] = {}
        for p in patterns:
            blocks = np.array([int.from_bytes(p[i : i + b], "little") for i in range(m - b + 1)], np.uint64)
            np.minimum.at(shift, self.slot(blocks), np.minimum(np.arange(m - b, -1, -1), most).astype(kind))
            self.buckets.setdefault(p[m - b : m], {}).setdefault(p[:m], []).append(p)
        self.shift = shift

    @staticmethod
    def slot(blocks: np.ndarray) -> np.ndarray:
        return (blocks * _ODD) >> np.uint64(64 - TABLE_BITS)

    def find(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        """(start, window) of every occurrence in data."""
        m, b = self.m, self.block
        if len(data) < m:
            return
        at = np.frombuffer(data + bytes(8), np.uint8)
        words = np.lib.stride_tricks.as_strided(at[:8].view(np.uint64), (len(data) + 1,), (1,))
        ends = np.arange(m - b, len(data) - b + 1, LANE)  # each lane's cursor: where the block at the window's end starts
        stops = np.minimum(ends + LANE, len(data) - b + 1)
        found = []
        while len(ends):
            step = self.shift[self.slot(words[ends] & self.mask)]
            hit = step == 0
            if hit.any():
                found.append(ends[hit])
            ends = ends + np.maximum(step, 1)
            live = ends < stops
            if not live.all():
                ends, stops = ends[live], stops[live]
        for end in np.sort(np.concatenate(found)).tolist() if found else ():
            start = end - (m - b)
            for p in self.buckets.get(data[end : end + b], {}).get(data[start : start + m], ()):
                if data.startswith(p, start):
                    yield start, p


def searchers(items: list[tuple[int | None, bytes]], size: int) -> list[Searcher]:
    patterns: dict[bytes, list[int]] = {}
    for item, text in items:
        for w in set(windows(text, size)):
            patterns.setdefault(w, []).append(item)
    classes: dict[int, dict[bytes, list[int]]] = {}
    for w, ids in patterns.items():
        classes.setdefault(len(w).bit_length(), {})[w] = ids
    return [Searcher(classes[k]) for k in sorted(classes)]


def _search(data: bytes, starts: np.ndarray, found: list[Searcher]) -> list[tuple[int, int, int, list[int]]]:
    """(document, first word, words, items) of every occurrence in the joined documents."""
    hits = [(start, p, s.patterns[p]) for s in found for start, p in s.find(data)]
    if not hits:
        return []
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    where = np.array([h[0] for h in hits])
    doc = np.searchsorted(starts, where, "right") - 1
    word = np.searchsorted(spaces, where) - np.searchsorted(spaces, starts[doc])
    return [(d, w, p.count(b" ") - 1, ids) for d, w, (_, p, ids) in zip(doc.tolist(), word.tolist(), hits)]


def _stored(items: DataFrame, item: str, text: str) -> list[str]:
    """The distinct items dealt by hash to files of about SHARD_BYTES / 2 bytes of text, written by tasks."""
    known = items.select(F.col(f"`{item}`").cast("long").alias("i"), F.col(f"`{text}`").cast("string").alias("t")).where("t is not null")
    total = known.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    folder = scratch_path(items.sparkSession, "items")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                for batch in held:
                    out.write_batch(batch)
            name = f"{folder}/{TaskContext.get().partitionId()}"
            put(name, np.frombuffer(sink.getvalue(), np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    dealt = known.distinct().repartition(max(1, -(-2 * total // SHARD_BYTES)), F.xxhash64("i", "t"))
    return sorted(r.name for r in dealt.mapInArrow(write, "name string").collect())


class Shards:
    """Tables of the stored items, a few shards at a time: at most KEPT are held, each is loaded when its turn comes."""

    def __init__(self, names: list[str], size: int):
        self.names, self.size, self.held = names, size, {}

    def __iter__(self) -> Iterator[list[Searcher]]:
        # Those in memory first, so that turning to the next documents loads one shard less.
        for name in sorted(self.names, key=lambda n: n not in self.held):
            if name not in self.held:
                if len(self.held) >= KEPT:
                    del self.held[next(iter(self.held))]
                table = pa.ipc.open_stream(pa.py_buffer(np.asarray(mapped(name, "uint8")))).read_all()
                self.held[name] = searchers(list(zip(table["i"].to_pylist(), texts(table["t"].combine_chunks()))), self.size)
            yield self.held[name]


def _spans(docs: DataFrame, names: list[str], size: int) -> DataFrame:
    """Adds the column `spans` of all occurrences to (doc_id, text, ...)."""
    shards = Shards(names, size)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("item", pa.int64())]))

    def searched(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, spans = [], [[[] for _ in range(b.num_rows)] for b in batches]
        for batch in batches:
            parts = [spaced(t) for t in texts(batch.column("text"))]
            # A zero byte between documents stands in no window.
            ready.append((b"\0".join(parts), np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]))
        for tables in shards:
            for (data, starts), found in zip(ready, spans):
                for d, first, words, ids in _search(data, starts, tables):
                    found[d].extend({"first": first, "words": words, "item": i} for i in ids)
        for batch, found in zip(batches, spans):
            yield with_columns(batch, spans=pa.array(found, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # While all tables fit in memory, batches go through one by one; else several wait for each shard's turn.
        held, many = [], len(names) > KEPT
        for batch in batches:
            held.append(batch)
            if not many or sum(b.nbytes for b in held) >= HELD_BYTES:
                yield from searched(held)
                held = []
        if held:
            yield from searched(held)

    return docs.mapInArrow(run, StructType([*docs.schema, *StructType.fromDDL("spans array<struct<first:long,words:long,item:long>>")]))


_VERDICT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"


def _judged(docs: DataFrame) -> DataFrame:
    """Adds word counts, hits and verdict to (text, spans, ...)."""
    verdict = StructType.fromDDL(_VERDICT)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string())]

    def judge(text: bytes, spans: list[dict]) -> tuple:
        n, hit = len(text.translate(WORDS).split()), 0
        if spans:
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, [s["first"] for s in spans], 1)
            np.add.at(edge, [s["first"] + s["words"] for s in spans], -1)
            hit = int((np.cumsum(edge)[:n] > 0).sum())
        ids = sorted({str(s["item"]) for s in spans if s["item"] is not None})
        return n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0 and 20 * hit >= n, ids

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(t, s or []) for t, s in zip(texts(batch.column("text")), batch.column("spans").to_pylist())]
        return with_columns(batch, **{f.name: pa.array([r[i] for r in rows], kinds[i]) for i, f in enumerate(verdict)})

    return map_batches(docs, step, StructType([*docs.schema, *verdict]))


def _searched(rows: DataFrame, items: DataFrame, item: str, item_text: str, size: int) -> DataFrame:
    bounded_batches(rows.sparkSession)
    return _judged(_spans(rows, _stored(items, item, item_text), size))


def contamination(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items) for every document.

    A window is `size` consecutive words of an item, or all words of a shorter one. A word of a document inside
    any occurrence of a window is hit; from 5 % hit words on it is contaminated. Null and empty texts have no words
    and are clean. Items without words or with a null text match nothing; hits of an item with a null id count as
    hit words, but it is not listed. Repeated rows, of either table, give the same answer each. No items: all clean.

    Items are dealt to files in the shared folder, no item passes through the driver. A task holds the tables of `KEPT` shards
    of about `SHARD_BYTES` / 2 bytes of text; where there are more, `HELD_BYTES` of documents at a time meet one shard after the other.
    """
    judged = _searched(carried(docs, id, text), items, item, item_text, size)
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items")


def drop_contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """The rows of `docs` that `contamination` calls clean, all columns."""
    judged = _searched(carried(docs, id, text, rest=True), items, item, item_text, size)
    return restored(judged.where("not contaminated"), docs, text)
